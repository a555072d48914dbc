"""Token counts of a byte-level BPE tokenizer with a shortcut for whole tokens.

Before any text is read, every string of the vocabulary is encoded alone; those that give
one token are proven and count 1 wherever they stand as a pre-token. Only other pre-tokens
are merged, once for each distinct one.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bytestext import small_batches, tidy

# Fixed value: the pattern by which byte-level tokenizers of this kind split a text before merging.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: So many distinct pre-tokens beyond the proven ones are remembered by a Python worker.
REMEMBERED = 300_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: itself where it is visible Latin-1, else the next code point from 256."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Counts:
    """Counts tokens as the library does, its special strings in a text included."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.pattern = regex.compile(PRE_TOKEN)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.proven = self._prove(set(special))
        self.known = dict(self.proven)

    def _prove(self, special: set[str]) -> dict[str, int]:
        alphabet, strings = byte_alphabet(), []
        for token in self.tokenizer.get_vocab(with_added_tokens=False):
            try:
                text = bytes(alphabet[c] for c in token).decode()
            except (KeyError, UnicodeDecodeError):
                continue  # a part of a character, which no text has alone
            if text not in special and self.pattern.fullmatch(text):
                strings.append(text)
        encoded = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return {s: 1 for s, e in zip(strings, encoded, strict=True) if len(e.ids) == 1}

    def counts(self, texts: list[str]) -> list[int]:
        split, known, base = [], self.known, []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            base.append(len(parts) - 1)
            found = self.pattern.findall(parts[0])
            for part in parts[1:]:
                found += self.pattern.findall(part)
            split.append(found)
        new = list(set().union(*split).difference(known)) if split else []
        if new:
            if len(known) > len(self.proven) + REMEMBERED:
                self.known = known = dict(self.proven)
                new = list(set().union(*split).difference(known))
            encoded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            known.update((s, len(e.ids)) for s, e in zip(new, encoded, strict=True))
        return [n + sum(map(known.__getitem__, found)) for n, found in zip(base, split, strict=True)]


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counts:
    return Counts(path)


def count_tokens(documents: DataFrame, tokenizer: str, limit: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text, and whether it has more than ``limit`` tokens.

    ``tokenizer`` is a path that executors can read. A null text counts as empty, 0 tokens;
    equal rows give equal rows, null ids are kept, other columns are not read. No shuffle.
    """

    def count(batches):
        counts = counter(tokenizer)
        for batch in batches:
            numbers, sizes, group, held = [], [], [], 0
            for text in batch.column(1).to_pylist():
                text = text or ""
                sizes.append(len(text.encode()))
                group.append(text)
                held += len(text)
                if held > 1 << 20:
                    numbers += counts.counts(group)
                    group, held = [], 0
            numbers += counts.counts(group)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(numbers, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    narrow = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    counted = small_batches(narrow).mapInArrow(tidy(count), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
