"""Operators 11 to 13 against brute-force versions, on odd rows, large groups and odd sizes."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from lakeload.llm import merkle, periods, suite, superkmers
from llm_cases import AWKWARD
from pyspark.sql import functions as F

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in BLANK.split(text or "") if w]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Operator 11


def kept_words(rows):
    """(n_words, kept text) for rows of (id, text) in order of id."""
    first, out = {}, []
    for at, (_, text) in enumerate(rows):
        own = words(text)
        for k in range(len(own) - 12):
            first.setdefault(tuple(own[k : k + 13]), at)
    for at, (i, text) in enumerate(rows):
        own = words(text)
        gone = set()
        for k in range(len(own) - 12):
            if first[tuple(own[k : k + 13])] < at:
                gone |= set(range(k, k + 13))
        out.append((i, len(own), len(gone), " ".join(w for k, w in enumerate(own) if k not in gone)))
    return out


def family(n, length=60, seed=1):
    """Near copies of one text, a third of them exact copies, others with a changed word or cut short."""
    rng = np.random.default_rng(seed)
    base = [f"w{k}" for k in range(length)]
    rows = []
    for i in range(n):
        own = list(base)
        if i % 3:
            own[rng.integers(length)] = f"x{rng.integers(9)}"
        if i % 7 == 0:
            own = own[int(rng.integers(length)) :]
        rows.append((i, " ".join(own)))
    return rows


def same_kept(df, rows):
    got = sorted((tuple(r) for r in df.collect()), key=str)
    assert got == sorted(kept_words(rows), key=str)


@pytest.mark.parametrize("crowded", [2, superkmers.CROWDED])
def test_windows_of_a_family_are_counted_exactly(spark, documents, crowded, monkeypatch):
    rows = family(200) + [(1000 + i, f"{'so it goes ' * 30}end {i}") for i in range(20)]
    monkeypatch.setattr(superkmers.repeats, "__defaults__", (crowded,))
    same_kept(superkmers.without_repeats(documents(rows)), rows)


def test_every_minimiser_is_reached_and_hot_slots_change_nothing(spark, documents, monkeypatch):
    rows = family(120, seed=5)
    monkeypatch.setattr(superkmers.repeats, "__defaults__", (0,))
    monkeypatch.setattr(superkmers, "hot_slots", lambda documents: np.arange(1 << superkmers.SLOT_BITS))
    same_kept(superkmers.without_repeats(documents(rows).repartition(5)), rows)


def test_odd_rows_of_words(spark, documents):
    rows = [(i, t) for i, t in AWKWARD if i is not None and i != 4] + [(10, "so it goes " * 20_000), (11, "so it goes " * 7)]
    rows.sort()
    same_kept(superkmers.without_repeats(documents(rows)), rows)
    out = {(r.doc_id, r.n_words): r.n_removed for r in superkmers.without_repeats(documents(AWKWARD + AWKWARD)).collect()}
    assert out[(9, 60_000)] in (0, 60_000) and out[(None, 0)] == 0
    assert superkmers.without_repeats(documents([])).count() == 0


def test_repeated_ids_follow_by_text_and_one_stays(spark, documents):
    text = " ".join(f"w{k}" for k in range(20))
    got = sorted(r.n_removed for r in superkmers.without_repeats(documents([(1, text)] * 5 + [(None, text)])).collect())
    assert got == [0, 20, 20, 20, 20, 20]


def test_super_k_mers_hold_every_window_once():
    rng = np.random.default_rng(3)
    hashes, of_row = rng.integers(0, 5, 400).astype(np.uint64) * np.uint64(977), np.array([0, 0, 12, 25, 25, 200, 400])
    for m in superkmers.MINIMISERS:
        row, bucket, _, low, more = superkmers.cut(hashes, of_row, m)
        seen = [(r, a + k) for r, a, n in zip(row, low, more, strict=True) for k in range(n + 1)]
        assert seen == [(r, k) for r, n in enumerate(np.diff(of_row)) for k in range(n - 12)]
        by_window = {}
        for r, b, a, n in zip(row, bucket, low, more, strict=True):
            for k in range(a, a + n + 1):
                by_window.setdefault(hashes[of_row[r] + k : of_row[r] + k + 13].tobytes(), set()).add(b)
        assert all(len(b) == 1 for b in by_window.values())


# Operator 12


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    """Root and, for each leaf, the (left, right) of every level."""
    level, paths, node = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for k, n in enumerate(node):
            run = n - n % 16
            paths[k].append(("".join(level[run:n]), "".join(level[n + 1 : run + 16])))
        level = [sha("".join(level[k : k + 16])) for k in range(0, len(level), 16)]
        node = [n // 16 for n in node]
    return level[0], paths


def brute_manifest(rows, change=lambda r: None):
    """rows: (key, tree, values); sorted as the operator does."""
    by = {}
    for key, source, values in rows:
        by.setdefault(source, []).append((key, sha("".join(map(field, values))), change((key, source, values))))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    tops = {s: tree([leaf for _, leaf, _ in by[s]]) for s in order}
    root, over = tree([tops[s][0] for s in order])
    out = []
    for s, above in zip(order, over, strict=True):
        for (key, leaf, claim), path in zip(by[s], tops[s][1], strict=True):
            folded = claim or leaf
            for left, right in path + above:
                folded = sha(left + folded + right)
            out.append((key, leaf, tops[s][0], root, "".join(a + b for a, b in path + above), folded, folded == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [[1], [16, 17, 1], [0, 257, 4096], [4097, 3], [9000, 256, 2]])
def test_trees_of_many_sizes(spark, sizes):
    rows = [(k * 7 - 3, None if s == 1 else f"é{s}", ("x" * (k % 5), None)) for s, n in enumerate(sizes) for k in range(n)]
    df = spark.createDataFrame([(k, s, a, b, 0) for k, s, (a, b) in rows], "doc_id long, source string, a string, b string, pos int")
    claim = F.when(F.col("doc_id") % 10 == 0, merkle.leaf(F.lit("false")))
    got = merkle.manifest(df, ["a", "b"], tampered=claim)
    want = brute_manifest(rows, lambda r: sha(field("false")) if r[0] % 10 == 0 else None)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_many_trees_have_a_tree_of_their_own(spark):
    rows = [(k, f"s{k % 5000}", (k,)) for k in range(5200)]
    df = spark.createDataFrame([(k, s, v) for k, s, (v,) in rows], "doc_id long, source string, a long")
    assert sorted((tuple(r) for r in merkle.manifest(df, ["a"]).collect()), key=str) == brute_manifest(rows)


def test_odd_rows_of_a_manifest(spark, documents):
    rows = documents(AWKWARD + AWKWARD[:5])
    want = brute_manifest([(r.doc_id, r.source, (r.doc_id, r.source, r.lang, r.n_chars, r.text)) for r in rows.collect()])
    got = merkle.manifest(rows, suite.LEAF).collect()
    assert sorted((tuple(r) for r in got), key=str) == want and all(r.verified for r in got)
    assert merkle.manifest(documents([]), suite.LEAF).count() == 0


# Operator 13


def brute_runs(own):
    best = {}
    for q in range(1, len(own) // 4 + 1):
        k = 0
        while k + q < len(own):
            end = k
            while end + q < len(own) and own[end] == own[end + q]:
                end += 1
            if end > k and end - k + q >= max(6, 4 * q):
                best.setdefault((k, end - k + q), q)
            k = max(end, k + 1)
    return sorted((s, n, q) for (s, n), q in best.items())


def brute_collapsed(own, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(own) if k not in gone)


def brute_loop(doc_id, own):
    if doc_id is None or not own:
        return own
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return own
    g, n = h // 10, len(own)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [own[a + (k - a) % p] if k >= a else own[k] for k in range(n)]


def test_cover_reaches_every_difference():
    cover = set(periods.COVER)
    assert {(a - b) % periods.PERIOD for a in cover for b in cover} == set(range(periods.PERIOD))


@pytest.mark.parametrize("kinds", [1, 2, 40])
def test_extensions_agree_with_comparison(kinds):
    rng = np.random.default_rng(kinds)
    symbols = np.append(np.tile(rng.integers(0, kinds, 170), 3), kinds)
    ahead = periods.Extensions(symbols)
    a = rng.integers(0, len(symbols) - 1, 3000)
    b = rng.integers(a + 1, len(symbols))
    own = symbols.tolist()
    want = [next(k for k in range(len(own)) if j + k == len(own) or own[i + k] != own[j + k]) for i, j in zip(a, b, strict=True)]
    assert ahead(a, b).tolist() == want


def test_runs_agree_with_every_period_tried(spark, documents, monkeypatch):
    rng = np.random.default_rng(2)
    rows = list(AWKWARD[:8]) + [(9, "so it goes " * 700)]
    for i in range(150):
        own = []
        for _ in range(rng.integers(0, 6)):
            own += [f"w{k}" for k in rng.integers(0, rng.integers(1, 4), rng.integers(1, 30))] * int(rng.integers(1, 9))
        rows.append((100 + i, " ".join(own)))
    monkeypatch.setattr(periods, "POINTS", 500)
    got = periods.with_runs(documents(rows)).collect()
    assert len(got) == len(rows)
    want = []
    for i, text in rows:
        runs = brute_runs(words(text))
        want.append((i, len(words(text)), sorted(runs, key=lambda r: (r[0], r[2])), brute_collapsed(words(text), runs)))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=str) == sorted(want, key=str)


def test_a_very_long_text_of_one_word(spark, documents):
    out = periods.with_runs(documents([(1, "x " * 100_000), (2, "y")])).collect()
    assert {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed) for r in out} == {1: ([(0, 100_000, 1)], "x"), 2: ([], "y")}
    assert periods.with_runs(documents([])).count() == 0


def digest_of(doc_id, text):
    own = brute_loop(doc_id, words(text))
    runs = sorted(brute_runs(own), key=lambda r: (r[0], r[2]))
    best = None
    for s, n, q in runs:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *head, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(brute_collapsed(own, runs)))


def test_digests_of_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    got = suite.op13_harmonic_runs(spark, sf).collect()
    want = [digest_of(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, got)) == sorted(want) and sum(r.n_runs > 0 for r in got) > 5


def test_loops_of_odd_rows(spark, documents):
    rows = [(i, t) for i in range(40) for t in ("a b c d e f g", None, " ", "one")] + [(None, "a b"), (-3, "a b c d")]
    got = periods.digest(periods.with_runs(periods.looped(documents(rows)))).collect()
    assert sorted(map(tuple, got), key=str) == sorted((digest_of(*r) for r in rows), key=str)
