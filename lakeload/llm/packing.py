"""Best-fit packing of tokenized documents into fixed-length sequences, as a tree of local rounds.

Pieces' lengths are dealt by hash to blocks of bounded size, so that each has the corpus's mix.
Blocks are packed best-fit-decreasing on their own. Nearly full bins are final;
the rest become items of the next round, in which the blocks of several predecessors meet,
until one block is left. A block hands on a bounded number of bins, those with the most
room; all others are final as they stand, so no round and no task grows with the input.
"""

from __future__ import annotations

import functools
import itertools
import string
import zlib
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeload.session import settle

from .bytestext import held, small_batches, tidy

#: Distinct words whose ids a task remembers; beyond that, and from task to task, those met at least so often are kept.
REMEMBERED, OFTEN = 600_000, 2
#: White space as the tokenizer's \s has it; str.split() also cuts at the four separators below 0x20.
ODD = regex.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"[\t-\r \x85\xa0  -     　]+")
BINS = "item long, bin long, offset long, size long, full boolean"


class Places(dict):
    """The number of each word; a new word gets the next one and is put down as to be encoded."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = at = len(self)
        return at


class WordIds:
    """Token ids of texts whose tokenizer drops white space and never merges across it, word by word.

    Each distinct word is encoded once, by the library, and its ids are kept in one flat
    array, so a text is a gather instead of an encoding.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        before, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        whole = any(t.content.isalpha() for t in self.tokenizer.get_added_tokens_decoder().values())
        self.folds = before is not None and not whole and before.normalize_str(string.ascii_uppercase) == string.ascii_lowercase
        self.parts = cut is not None and all(len(cut.pre_tokenize_str("ab" + mark)) == 2 for mark in (*string.punctuation, string.punctuation))
        self.forget()

    def forget(self) -> None:
        self.places = Places()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.begins, self.sizes, self.met = (np.zeros(1 << 16, np.int64) for _ in range(3))
        self.used = 0

    def keep_frequent(self) -> None:
        """Forget the words met less than OFTEN, and start counting anew; all of them if too many are left."""
        known = np.flatnonzero(self.met[: len(self.places)] >= OFTEN)
        words, begins, sizes, ids = list(self.places), self.begins[known], self.sizes[known], self.ids
        self.forget()
        if len(known) > REMEMBERED // 2:
            return
        for k in known.tolist():
            self.places[words[k]] = len(self.places)
        ends = np.cumsum(sizes)
        self.used = int(ends[-1]) if len(ends) else 0
        self._grow()
        self.ids[: self.used] = ids[np.arange(self.used) + np.repeat(begins - ends + sizes, sizes)]
        self.begins[: len(known)], self.sizes[: len(known)] = ends - sizes, sizes

    def _grow(self, more: int = 0) -> None:
        while self.used + more > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.places) > len(self.begins):
            self.begins, self.sizes, self.met = (np.concatenate([a, np.zeros_like(a)]) for a in (self.begins, self.sizes, self.met))

    def learn(self) -> None:
        """Encode the new words: letters, with or without marks after them, as their letters' ids and the marks' ids; others one by one.

        Letters known as a word already, or met twice, are not encoded again, in ASCII whatever their case.
        """
        words, self.places.new = self.places.new, []
        first = len(self.places) - len(words)
        known, fresh = self.places.get, {}
        tails: dict[str, int] = {"": 0}
        plain, roots, ends = [], [], []
        for k, word in enumerate(words):
            root = word.rstrip(string.punctuation) if self.parts else word
            if not root.isalpha():
                continue
            tail = word[len(root) :]
            if self.folds and root.isascii():
                root = root.lower()
            at = known(root, first)
            plain.append(k)
            roots.append(at if at < first else ~fresh.setdefault(root, len(fresh)))
            ends.append(tails.setdefault(tail, len(tails)) if tail else 0)
        begins, sizes, flat = self._together([*fresh])
        if begins is None:  # a letter that lower case turns into more than letters
            plain, roots, ends = [], [], []
            begins, sizes = np.zeros((2, 0), np.int64)
        at, tail = np.array(roots, np.int64), np.array(ends, np.int64)
        # All ids there are to copy from: those kept, those of new letters, those of marks.
        marks = [np.array(i, np.uint32) for i in self._encode([*tails])]
        mark_sizes = np.array([*map(len, marks)], np.int64)
        old = at >= 0
        root_begins, root_sizes = np.zeros((2, len(at)), np.int64)
        root_begins[old], root_sizes[old] = self.begins[at[old]], self.sizes[at[old]]
        root_begins[~old], root_sizes[~old] = self.used + begins[~at[~old]], sizes[~at[~old]]
        mark_begins = self.used + len(flat) + np.cumsum(mark_sizes) - mark_sizes
        source = np.concatenate([self.ids[: self.used], flat, *marks])
        pieces = np.stack([root_sizes, mark_sizes[tail]], axis=1).ravel()
        stops = np.cumsum(pieces)
        copied = source[np.arange(pieces.sum()) + np.repeat(np.stack([root_begins, mark_begins[tail]], axis=1).ravel() - stops + pieces, pieces)]
        other = np.flatnonzero(np.bincount(plain, minlength=len(words)) == 0) if plain else np.arange(len(words))
        encoded = self._encode([words[k] for k in other.tolist()])
        found = np.zeros(len(words), np.int64)
        found[plain] = root_sizes + mark_sizes[tail]
        found[other] = np.fromiter(map(len, encoded), np.int64, len(encoded))
        total = int(found.sum())
        self._grow(total)
        self.ids[self.used : self.used + len(copied)] = copied
        self.ids[self.used + len(copied) : self.used + total] = np.fromiter(itertools.chain.from_iterable(encoded), np.uint32, total - len(copied))
        order = np.concatenate([np.array(plain, np.int64), other])
        self.begins[first + order] = self.used + np.cumsum(found[order]) - found[order]
        self.sizes[first : len(self.places)] = found
        self.used += total

    def _together(self, roots: list[str]) -> tuple[np.ndarray | None, np.ndarray | None, np.ndarray]:
        """Begins, sizes and ids of words of letters, encoded as one text and cut after ids that end a pre-token; no begins if that gives another number."""
        flat = np.array(self._encode([" ".join(roots)])[0], np.uint32)
        stops = np.flatnonzero(self.ends_word[flat]) + 1
        if len(stops) != len(roots):
            return None, None, flat[:0]
        sizes = np.diff(stops, prepend=0)
        return stops - sizes, sizes, flat

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.places) > REMEMBERED:
            self.keep_frequent()
        find, places = self.places.__getitem__, []
        for text in texts:
            words = SPACE.split(text) if ODD.search(text) else text.split()
            places.append(np.fromiter(map(find, words), np.int64, len(words)))
        if self.places.new:
            self.learn()
        if places:
            times = np.bincount(np.concatenate(places), minlength=1)
            self.met[: len(times)] += times
        out = []
        for at in places:
            begin, size = self.begins[at], self.sizes[at]
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            out.append(self.ids[np.arange(total) + np.repeat(begin - ends + size, size)])
        return out


@held
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def cut(documents: DataFrame, tokenizer: str, length: int, end_id: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each piece of each document: its ids' place in the document, their number and CRC.

    Only documents of more than ``length`` ids are cut. ``item`` numbers the pieces.
    """

    def pieces(batches):
        encoder = word_ids(tokenizer)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            begin = 0
            while begin < len(texts):
                end, held = begin, 0
                while end < len(texts) and (end == begin or held < 1 << 20):
                    held += len(texts[end] or "")
                    end += 1
                rows = []
                for doc, found in zip(ids[begin:end], encoder.encode([t or "" for t in texts[begin:end]]), strict=True):
                    found = np.append(found, np.uint32(end_id)).astype("<u4")
                    for piece, at in enumerate(range(0, len(found), length)):
                        part = found[at : at + length]
                        rows.append((doc, piece, at, len(part), zlib.crc32(part.tobytes())))
                begin = end
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), *[pa.int64()] * 3), strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )
        encoder.keep_frequent()

    narrow = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    out = small_batches(narrow).mapInArrow(tidy(pieces, word_ids), "doc_id long, piece int, start long, length long, ids_crc32 long")
    return out.withColumn("item", F.monotonically_increasing_id())


def best_fit(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the bins' sizes; largest items first, each into the fullest bin that has room.

    Open bins stand by their room; the set of rooms in use is one integer of ``length`` bits.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    filled: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(length + 1)]
    rooms = 0
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            which = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, which = length, len(filled)
            filled.append(0)
        bins[k], offsets[k] = which, filled[which]
        filled[which] += size
        room -= size
        by_room[room].append(which)
        rooms |= 1 << room
    return bins, offsets, np.array(filled, np.int64)


def pack(pieces: DataFrame, length: int, fan: int = 8, slack: int = 8, hand_on: int = 20_000, block_pieces: int = 20_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``length`` ids.

    ``pieces`` has to be written already, as it is read more than once. Pieces are dealt to
    blocks of about ``block_pieces`` by a hash of ``item``, however they are stored. ``fan`` blocks meet
    in each round; a bin with at most ``slack`` ids of room is final; a block hands on at
    most ``hand_on`` bins. The number of rounds is the logarithm of the number of blocks.
    """

    def round_of(level: int):
        def one(key: tuple[Any, ...], items: pd.DataFrame) -> pd.DataFrame:
            bins, offsets, filled = best_fit(items["size"].to_numpy(), length)
            final = filled >= length - slack
            roomy = np.argsort(filled, kind="stable")
            final[roomy[hand_on:]] = True
            first = (level << 56) + (int(key[0]) << 26)
            return pd.DataFrame(
                {"item": items["item"].to_numpy(), "bin": first + bins, "offset": offsets, "size": filled[bins], "full": final[bins]}
            )

        return one

    blocks = max(-(-pieces.where(F.col("length") < length).count() // block_pieces), 1)
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block")
    items = pieces.where(F.col("length") < length).select("item", block, F.col("length").alias("size"))
    placed = pieces.where(F.col("length") < length).select("item", F.col("item").alias("_held"), F.lit(0).cast("long").alias("offset"))
    done, level = [], 1
    while True:
        packed = settle(items.groupBy("block").applyInPandas(round_of(level), BINS), "packed")
        step = packed.select(F.col("item").alias("_held"), "bin", F.col("offset").alias("_more"), "full")
        placed = placed.join(step, "_held").select("item", F.col("bin").alias("_held"), (F.col("offset") + F.col("_more")).alias("offset"), "full")
        if blocks == 1:
            done.append(placed.drop("full"))
            break
        placed = settle(placed, "placed")
        done.append(placed.where("full").drop("full"))
        placed = placed.where("NOT full").drop("full")
        blocks = -(-blocks // fan)
        block = F.floor(F.shiftright(F.col("bin").bitwiseAND((1 << 56) - 1), 26) / fan).cast("long")
        items = packed.where("NOT full").select(F.col("bin").alias("item"), block.alias("block"), "size").distinct()
        level += 1
    homes = functools.reduce(DataFrame.union, done)
    whole = pieces.where(F.col("length") == length).withColumns({"sequence_id": F.col("item"), "offset": F.lit(0).cast("long")})
    part = pieces.where(F.col("length") < length).join(homes.withColumnRenamed("_held", "sequence_id"), "item")
    return whole.unionByName(part).drop("block", "item")


def pack_documents(documents: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 0, **ids) -> DataFrame:
    """Pack all documents into sequences of at most ``length`` ids, each document followed by ``end_id``.

    ``tokenizer`` is a file that executors can read, of a tokenizer that drops white space.
    A null or empty text is the end id alone; equal rows are packed each for itself; null ids
    are kept; other columns are not read. Offsets within a sequence have no gap.
    """
    pieces = settle(cut(documents, tokenizer, length, end_id, **ids), "pieces")
    return pack(pieces, length)
