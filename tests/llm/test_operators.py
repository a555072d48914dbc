"""Every numbered operator against a brute-force version, and on awkward and empty tables."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import AWKWARD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeload.llm import bytestext, chat, decontam, forest, packing, quality, shards, spots, suffixes, tokens, urls
from lakeload.llm.suite import RULES

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def prose(n, seed, words=400):
    draw = random.Random(seed)
    names = ["".join(draw.choice("abcdeiorst") for _ in range(draw.randint(1, 9))) for _ in range(words)]
    return [" ".join(draw.choice(names) for _ in range(draw.randint(1, 120))) for _ in range(n)]


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def shingle_bag(words):
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1 if words else 0)))


# Words and hashes.


def test_words_and_shingles_of_a_batch_are_those_of_each_text():
    import pyarrow as pa

    texts = [t for _, t in AWKWARD[:12]] + prose(20, 1)
    data, bounds = bytestext.flat(pa.array(texts, pa.string()))
    starts, ends, of_row = bytestext.words(data, bounds)
    hashes = bytestext.span_hashes(data, starts, ends)
    runs, begins = bytestext.shingles(hashes, of_row)
    seen = {}
    for k, text in enumerate(texts):
        found = [bytes(data[a:b]).decode() for a, b in zip(starts[of_row[k] : of_row[k + 1]], ends[of_row[k] : of_row[k + 1]], strict=True)]
        assert [lower(w) for w in found] == split(text)
        bag = shingle_bag(split(text))
        assert begins[k + 1] - begins[k] == sum(bag.values())
        for i, h in enumerate(runs[begins[k] : begins[k + 1]].tolist()):
            key = tuple(split(text)[i : i + 5])
            assert seen.setdefault(h, key) == key


# 1


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, position int, rendered string")


def collapsed(rows):
    talks = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        talks[conv].append(((turn is not None, turn or 0), (role is not None, role or ""), (text is not None, text or ""), role, text))
    talks = {c: tuple((r, t) for *_, r, t in sorted(v, key=lambda x: x[:3])) for c, v in talks.items()}
    kept = {}
    for c in sorted(talks, key=lambda c: (c is None, c or 0)):
        own = talks[c]
        if not any(o[: len(own)] == own and (len(o) > len(own) or d in kept) for d, o in talks.items() if d != c):
            kept[c] = own
    return kept


def test_snapshots_collapse_to_maximal_conversations(spark):
    draw, rows = random.Random(2), []
    for conv in range(60):
        talk = [(draw.choice(["user", "assistant"]), draw.choice("abc")) for _ in range(draw.randint(1, 4))]
        rows += [(conv, k, r, t, 0, "") for k, (r, t) in enumerate(talk)]
    rows += [(100, k, "user", f"long {k}", 0, "") for k in range(500)] + [(101, k, "user", f"long {k}", 0, "") for k in range(300)]
    rows += [(None, 0, None, None, 0, ""), (None, None, "user", "", 0, ""), (200, 1, "user", "tie", 0, ""), (200, 1, "user", "tie", 0, ""), (201, 0, None, "x", 0, ""), (202, 0, "x", None, 0, "")]
    out = chat.format_chats(chats(spark, rows)).collect()
    got = collections.defaultdict(list)
    for r in sorted(out, key=lambda r: r.position):
        assert r.position == len(got[r.conv_id])
        got[r.conv_id].append(r.rendered)
    assert {c: v for c, v in got.items()} == {c: [f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in v] for c, v in collapsed(rows).items()}
    assert 101 not in got and len(got[100]) == 500
    assert chat.format_chats(chats(spark, [])).count() == 0


# 2


def test_attention_learns_from_bag_labels_and_repeats_itself(spark, documents):
    draw, good, rows, labels = random.Random(3), prose(150, 4), [], []
    for k, text in enumerate(good):
        bad = k % 3 == 0
        noise = " ".join(w.upper() + "!!" for w in text.split()[:30])
        rows.append((k, text + " " + noise if bad else text))
        labels.append((k, int(not bad), 0))
    labels += [(None, 1, 0), (3, None, 0), (99_999, 0, 0)]
    docs, marks = documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.train(docs, marks)
    out = {r.doc_id: r for r in quality.score(docs, model).collect()}
    for doc, r in out.items():
        assert r.held_out == (zlib.crc32(str(doc).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.5)
    tested = [(r.predicted, int(d % 3 != 0)) for d, r in out.items() if r.held_out]
    assert sum(p == y for p, y in tested) >= 0.9 * len(tested)
    again = quality.train(docs, marks.orderBy(F.rand(draw.randint(1, 9))))
    assert all(np.array_equal(model.weights[k], again.weights[k]) for k in model.weights)
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, r in out.items() if r.score >= 0.5}


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(5)
    features, begins = draw.random((9, quality.FEATURES)).astype(np.float32), np.array([0, 2, 3, 9])
    y = np.array([1, 0, 1], np.float32)
    model = quality.fit(features, begins, y, steps=1)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    loss = lambda: -np.mean(np.log(np.where(y == 1, q := model.scores(features, begins), 1 - q)))
    for name, gradient in model.gradients(features, begins, y).items():
        weight = model.weights[name]
        at = tuple(draw.integers(0, s) for s in weight.shape)
        weight[at] += 1e-5
        up = loss()
        weight[at] -= 2e-5
        down = loss()
        weight[at] += 1e-5
        assert abs((up - down) / 2e-5 - gradient[at]) < 1e-4, name


# 3


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.partition("://")[2]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = lower(host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_urls_are_split_and_ruled(spark):
    draw = random.Random(6)
    odd = [None, "", "no scheme", "://", "http://", "http://ORG", "http://org/", "http://a.org?x=/", "http://xorg/", "a://b://c/d", "http://Example.ORG/en/12#x", "https://é.com/de/ü?q", "http://com/fr/", "http://x.com/de", "http://u@h:80/p\nq"]
    made = [f"http{draw.choice(['', 's'])}://{draw.choice(['a.', 'm.b.', ''])}{draw.choice(['example.org', 'x.com', 'y.net'])}/{draw.choice(['es', 'en', 'fr', 'de'])}/{draw.randint(0, 30)}{draw.choice(['', '?a=1&b=2', '#t'])}" for _ in range(300)]
    rows = [(k, u, "h", "x", 0.0) for k, u in enumerate(odd + made)] + [(0, odd[0], "h", "x", 0.0), (None, "http://org/x", None, None, None)]
    out = urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string, host string, score double"), RULES, trees=3).collect()
    assert len(out) == len(rows)
    known = dict(enumerate(odd + made))
    for r in out:
        host, path, rule, verdict = judged(known.get(r.page_id, "http://org/x"))
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))


def test_trees_learn_lexical_rules(spark):
    draw = random.Random(7)
    rows = []
    for k in range(900):
        bad = k % 2
        tail = "".join(draw.choice("0123456789") for _ in range(14)) + "?a=1&b=2&c=3" if bad else "/".join(draw.choice(["news", "about", "story"]) for _ in range(3))
        rows.append((f"http://{draw.choice('abc')}.net/{tail}", bad))
    df = urls.with_features(urls.with_rules(spark.createDataFrame(rows, "url string, y long"), [])).withColumn("held", F.crc32(F.col("url").cast("binary")) % 3 == 1)
    model = urls.fit(df.where("NOT held"), trees=4)
    out = model.binned(df.where("held")).select("y", (model.margin() > 0).cast("long").alias("p")).collect()
    assert sum(r.y == r.p for r in out) >= 0.95 * len(out)
    assert urls.fit(df.where("y = 1")).trees == [] and urls.fit(df.where("url IS NULL")).trees == []
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), RULES).count() == 0


# 4


def without_repeats(rows, length=100):
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = True
            seen.add(window)
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum())
        out.append((doc, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeated_texts(seed, n=60):
    draw = random.Random(seed)
    passages = [p + "é" * 20 for p in prose(6, seed, 50)]
    texts = []
    for k in range(n):
        parts = [draw.choice(prose(1, seed * 100 + k)), *draw.sample(passages, draw.randint(0, 3))]
        draw.shuffle(parts)
        texts.append(" ".join(parts))
    return texts + [texts[3], texts[3][5:], "ab" * 200, "ab" * 150 + "c" * 300, "y" * 99, "z" * 100, "z" * 101]


@pytest.mark.parametrize("common", [10**9, 3])
def test_repeated_strings_go_but_their_first_place(spark, documents, monkeypatch, common):
    monkeypatch.setattr(suffixes, "COMMON", common)
    monkeypatch.setattr(suffixes, "SHARD", 700)
    monkeypatch.setattr(suffixes, "COLLECTION", 5_000)
    rows = list(enumerate(repeated_texts(8)))
    got = sorted(tuple(r) for r in suffixes.deduplicated(documents(rows)).collect())
    assert got == sorted(without_repeats(rows))


def test_transforms_merge_to_the_repeats_of_the_whole():
    draw = np.random.default_rng(9)
    strings = [draw.integers(1, 4, draw.integers(60, 200)).astype(np.uint16) for _ in range(12)]
    strings += [np.concatenate([strings[0][:70], strings[1][:80]]), strings[2]]
    shards_ = [np.concatenate([np.append(s, 0) for s in strings[k : k + 5]]).astype(np.uint16) for k in range(0, len(strings), 5)]
    places, block = suffixes.merged(shards_)
    text = np.concatenate(shards_)
    held = collections.defaultdict(set)
    for k in range(len(text) - suffixes.DEPTH + 1):
        window = text[k : k + suffixes.DEPTH]
        if window.all():
            held[window.tobytes()].add(k)
    got = collections.defaultdict(set)
    for p, b in zip(places.tolist(), block.tolist(), strict=True):
        got[b].add(p)
    whole = {frozenset(s) for s in got.values() if text[min(s) : min(s) + suffixes.DEPTH].all()}
    assert whole == {frozenset(s) for s in held.values() if len(s) > 1}


def test_rows_of_equal_ids_and_cut_characters(documents):
    line = " ".join(prose(3, 23))[:150]
    rows = [(1, "xé" + line), (1, "xé" + line), (None, "é" + line), (2, "©" + line)]
    out = suffixes.deduplicated(documents(rows)).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in out) == [(152, 151), (152, 152), (153, 0), (153, 153)]
    texts = suffixes.with_texts_cut(documents(rows))
    assert texts.columns == documents(rows).columns
    assert sorted(r.text for r in texts.collect()) == ["", "", "", "xé" + line]


# 5


def spot_set(text):
    words = [w for w in re.split(r"[^\w]|_", (text or "").lower()) if w]
    content = [(i, w) for i, w in enumerate(words) if w not in spots.ANCHORS]
    out = set()
    for i, w in enumerate(words):
        if w in spots.ANCHORS:
            chain = [c for j, c in content if j > i][:2]
            if len(chain) == 2:
                out.add((w, *chain))
    return out or ({("whole", *words)} if words else set())


def alike(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_spots_of_edits_and_next_documents(documents):
    draw = random.Random(10)
    words = [*spots.ANCHORS, *prose(1, 11)[0].split(), "Ünï", "x1"]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randint(0, 80))) for _ in range(70)] + ["", None, "the", "lonely"]
    texts += [texts[0], texts[5], texts[5]]
    ids = draw.sample(range(-50, 500), len(texts))
    rows = sorted(zip(ids, texts, strict=True))
    out = sorted(spots.edits(documents(rows)).collect(), key=lambda r: r.doc_id)
    prints = {}
    for k, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = out[k]
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (doc, len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - alike(spot_set(text), spot_set(edited))) < 1e-9
        assert abs(r.near_next - alike(spot_set(text), spot_set(following))) < 1e-9
        for t, p in ((text, r.fingerprint), (edited, r.edited_fingerprint)):
            assert prints.setdefault(frozenset(spot_set(t)), p) == p
    assert len(set(prints.values())) == len(prints)


def test_spot_search_finds_what_brute_force_does(documents):
    texts = prose(60, 12, 30)
    texts = [t.replace(" a", " the a").replace(" s", " of s") for t in texts]
    texts += [t + " more of it and so on" for t in texts[:20]] + texts[:5]
    df = spots.with_spots(documents(list(enumerate(texts))).select("doc_id", "text"), "text", "spots")
    asked = df.where("doc_id % 3 = 0")
    got = {(r.query_id, r.doc_id): r.likeness for r in spots.search(asked, df).collect()}
    sets = [spot_set(t) for t in texts]
    want = {(i, j): alike(sets[i], sets[j]) for i, j in itertools.product(range(0, len(texts), 3), range(len(texts))) if sets[i] and sets[j] and alike(sets[i], sets[j]) >= 0.75}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


# 6


def grouped(rows):
    sets = {d: set(shingle_bag(split(t))) for d, t in rows}
    home = {d: d for d in sets}

    def find(d):
        while home[d] != d:
            d = home[d]
        return d

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            a, b = sorted((find(a), find(b)))
            home[b] = a
    return {d: (len(sets[d]), find(d), d == find(d)) for d in sets}


def copies(seed, n=40):
    draw, out = random.Random(seed), []
    for text in prose(n, seed):
        out.append(text)
        words = text.split()
        for _ in range(draw.randint(0, 4)):
            words = list(words)
            for _ in range(max(1, len(words) // 50)):
                words[draw.randrange(len(words))] = draw.choice(["changed", "words"])
            out.append(" ".join(words))
    draw.shuffle(out)
    return out


@pytest.mark.parametrize("crowded", [2_000, 4])
def test_forest_links_what_brute_force_links(documents, monkeypatch, crowded):
    monkeypatch.setattr(forest, "CROWDED", crowded)
    rows = list(enumerate([*copies(13), "one two", "One  TWO", "", None, " ", "one two three four five", "same", "same"]))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in forest.near_duplicates(documents(rows)).collect()}
    assert got == grouped(rows)
    kept = forest.one_of_each(documents(rows))
    assert {r.doc_id for r in kept.collect()} == {d for d, g in got.items() if g[2]}


@pytest.mark.parametrize("crowded", [2_000, 20])
def test_forest_links_pairs_within_a_template_family(documents, monkeypatch, crowded):
    monkeypatch.setattr(forest, "CROWDED", crowded)
    template, texts = " ".join(f"common{k}" for k in range(124)), []
    for k in range(130):  # 0.6 alike with the family, 0.76 with one other
        shared = " ".join(f"pair{k}x{j}" for j in range(19))
        texts += [f"{template} {shared} " + " ".join(f"own{k}x{side}x{j}" for j in range(21)) for side in "ab"]
    texts += [template + f" last{k}" for k in range(60)]
    random.Random(24).shuffle(texts)
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in forest.near_duplicates(documents(rows)).collect()}
    assert got == grouped(rows)


def test_chains_join_into_one_component(spark):
    pairs = [((k, 0), (k + 1, 0)) for k in range(200)] + [((500, 1), (501, 0)), ((500, 1), (499, 7))]
    df = spark.createDataFrame(pairs, "a struct<doc_id:bigint,th:bigint>, b struct<doc_id:bigint,th:bigint>")
    got = {tuple(r.node): tuple(r.home) for r in forest.components(df).collect()}
    assert got == {**{(k, 0): (0, 0) for k in range(1, 201)}, (500, 1): (499, 7), (501, 0): (499, 7)}


def test_links_after_the_first_are_joined_between_components_alone(spark, monkeypatch):
    """Nodes whose component is known stay out of the rounds, and links that are stars take none."""
    kind = "struct<doc_id:bigint,th:bigint>"
    n = lambda k: (k, 0)
    rounds, settle = [], forest.settle
    monkeypatch.setattr(forest, "settle", lambda df, label: rounds.append(label) or settle(df, label))
    parents = spark.createDataFrame([(n(k), n(k + 1)) for k in range(100)] + [(n(200), n(201)), (n(200), n(202)), (n(300), n(301))], f"a {kind}, b {kind}")
    homes = forest.rooted(parents)
    first = {**{k: 0 for k in range(1, 101)}, 201: 200, 202: 200, 301: 300}
    found = lambda df: sorted((r.node.doc_id, r.home.doc_id) for r in df.collect())
    assert found(homes) == sorted(first.items()) == found(forest.joined(homes, parents.limit(0)))
    assert len(rounds) <= 9  # the logarithm of the longest chain
    more = spark.createDataFrame([(n(202), n(301)), (n(100), n(300)), (n(400), n(50)), (n(500), n(501))], f"a {kind}, b {kind}")
    joined = found(forest.joined(homes, more))
    assert joined == sorted({**{k: 0 for k in range(1, 101)}, 200: 0, 201: 0, 202: 0, 300: 0, 301: 0, 400: 0, 501: 500}.items())
    rounds.clear()
    stars = spark.createDataFrame([(n(1), n(0)), (n(0), n(2)), (n(5), n(7))], f"a {kind}, b {kind}")
    assert found(forest.components(stars)) == [(1, 0), (2, 0), (7, 5)]
    assert len(rounds) == 1


# 7


def test_words_alike_but_for_case_and_marks_are_encoded_once(monkeypatch):
    given, encode = [], packing.WordIds._encode
    monkeypatch.setattr(packing.WordIds, "_encode", lambda self, texts: given.extend(texts) or encode(self, texts))
    words = packing.WordIds(WORD_BPE)
    texts = ["Zebra zebra, ZEBRA!! zebra", "zEbra. (zebra Ähre ähre. don't AB's <|ENDOFTEXT|> <|endoftext|>. ΣΑΣ. x1.", "Zebra? ... 's", "İa. zebra;"]
    plain = [e.ids for e in words.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert [w.tolist() for text in texts for w in words.encode([text])] == plain
    assert sum(w == "zebra" for text in given for w in text.lower().rstrip(",.!?").split()) == 1, given
    words.keep_frequent()
    assert [w.tolist() for w in words.encode(texts)] == plain


def test_a_worker_lets_go_of_words_when_another_step_begins():
    encoder = packing.word_ids(WORD_BPE)
    list(bytestext.tidy(lambda batches: batches, packing.word_ids)([]))
    assert packing.word_ids(WORD_BPE) is encoder
    list(bytestext.tidy(lambda batches: batches)([]))
    assert packing.word_ids.cache_info().currsize == 0


def test_packing_is_whole_gapless_and_tight(documents):
    texts = [t * k for k, t in enumerate(prose(150, 14), 1) for t in [t[:400]] if k % 3] + ["", None, "x<|endoftext|>y", "Straße ΑΣ İ"]
    rows = list(enumerate(texts))
    tokenizer = Tokenizer.from_file(WORD_BPE)
    out = packing.pack_documents(documents(rows), WORD_BPE, length=256).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    total = 0
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        pieces = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in pieces] == [(k, at, min(256, len(ids) - at)) for k, at in enumerate(range(0, len(ids), 256))]
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for rows_ in by_sequence.values():
        at = 0
        for r in sorted(rows_, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    assert len(by_sequence) <= 1.03 * -(-total // 256) + 1


def test_residual_rounds_meet_across_blocks(spark):
    draw = random.Random(15)
    rows = [(k, k % 50, k, 0, 0, draw.randint(1, 100), 0) for k in range(3_000)]
    df = spark.createDataFrame(rows, "doc_id long, block long, item long, piece int, start long, length long, ids_crc32 long")
    out = packing.pack(df, 100, fan=4, slack=0, hand_on=30).collect()
    filled = collections.Counter()
    for r in out:
        filled[r.sequence_id] += r.length
    assert sorted(r.doc_id for r in out) == list(range(3_000)) and max(filled.values()) <= 100
    alone = sum(len(packing.best_fit(np.array([r[5] for r in rows if r[1] == b]), 100)[2]) for b in range(50))
    whole = len(packing.best_fit(np.array([r[5] for r in rows]), 100)[2])
    assert whole <= len(filled) < alone


@pytest.mark.parametrize("block_pieces", [20_000, 1_000])
def test_packing_of_a_corpus_stored_by_length_is_as_tight_as_the_wholes(spark, block_pieces):
    sizes = [1_200] * 5_000 + [800] * 5_000
    rows = [(k, k // 1_000, k, 0, 0, s, 0) for k, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "doc_id long, block long, item long, piece int, start long, length long, ids_crc32 long")
    out = packing.pack(df, 2048, block_pieces=block_pieces) if block_pieces < 20_000 else packing.pack(df, 2048)
    filled = collections.Counter()
    for r in out.collect():
        filled[r.sequence_id] += r.length
    assert sum(filled.values()) == sum(sizes) and max(filled.values()) <= 2048
    assert len(filled) <= 1.03 * len(packing.best_fit(np.array(sizes), 2048)[2])


def test_best_fit_takes_the_fullest_bin():
    bins, offsets, filled = packing.best_fit(np.array([5, 7, 3, 2, 10]), 10)
    assert bins.tolist() == [2, 1, 1, 2, 0] and filled.tolist() == [10, 10, 7] and offsets.tolist() == [0, 0, 7, 5, 0]


# 8


def test_counts_are_the_librarys(documents):
    texts = prose(40, 16) + ["it's 'S don't  x\n\n y", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "日本語 ½²Ⅻ \U0001f600", "  　\x1c\x85 ", "", None, "tab\t\tend "]
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    out = {r.doc_id: r for r in tokens.count_tokens(documents(list(enumerate(texts))), BYTE_BPE, 100).collect()}
    for k, text in enumerate(texts):
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert (out[k].n_bytes, out[k].n_tokens, out[k].over_limit) == (len((text or "").encode()), n, n > 100)


def test_proven_tokens_are_single():
    counts = tokens.Counts(BYTE_BPE)
    assert len(counts.proven) > 45_000 and counts.counts(random.Random(17).sample(sorted(counts.proven), 50)) == [1] * 50


# 9


def leaking(rows, items):
    out = {}
    for (doc, text), (item, passage) in itertools.product(rows, items):
        words, own = split(text), split(passage)
        bag, size, best = shingle_bag(own), len(own), (0, 0)
        for i in range(len(words) - size + 1 if own else 0):
            there = shingle_bag(words[i : i + size])
            shared = sum((bag & there).values())
            best = max(best, (shared / (sum(bag.values()) + sum(there.values()) - shared), -i))
        if best[0] >= 0.75:
            out[doc, item] = (best[0], -best[1])
    return out


@pytest.mark.parametrize("at_once", [20_000, 3])
def test_leaks_are_those_of_brute_force(spark, documents, monkeypatch, at_once):
    monkeypatch.setattr(decontam, "ITEMS_AT_ONCE", at_once)
    draw = random.Random(18)
    passages = [" ".join((t + " " + t).split()[: draw.randint(8, 60)]) for t in prose(10, 19)]
    items = [*enumerate(passages), (20, "short item"), (21, None), (22, ""), (23, passages[0])]
    rows = []
    for k, text in enumerate(prose(50, 20)):
        words = text.split()
        if k % 2:
            leak = draw.choice(passages).split()
            for _ in range(draw.choice([0, 0, 1, 2])):
                leak[draw.randrange(len(leak))] = "edited"
            at = draw.randint(0, len(words))
            words[at:at] = leak if k % 3 else [w.upper() for w in leak]
        rows.append((k, " ".join(words)))
    rows += [(90, "this is a short item indeed"), (91, None), (92, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in decontam.leaks(documents(rows), benchmark).collect()}
    want = leaking(rows, [i for i in items if i[1]])
    assert got == want and len(want) > 10
    kept = decontam.clean(documents(rows), benchmark)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in want}
    assert decontam.leaks(documents(rows), benchmark.limit(0)).count() == 0


def test_documents_shorter_than_an_item_leak_as_a_whole(spark, documents):
    items = [(k, " ".join((t + " " + t).split()[: 20 + 4 * k])) for k, t in enumerate(prose(30, 25))] + [(40, "so it goes " * 30), (41, "a b c")]
    rows = []
    for k, text in items:
        words = text.split()
        for cut in (1, len(words) // 10, len(words) // 5, len(words) // 3):
            rows += [(len(rows), " ".join(words[cut:]).upper()), (len(rows) + 1, " ".join(words[: len(words) - cut])), (len(rows) + 2, " ".join(words[cut : len(words) - 1]))]
    want = leaking(rows, items)
    for (doc, text), (item, passage) in itertools.product(rows, items):
        words, bag = split(text), shingle_bag(split(passage))
        there = shingle_bag(words)
        shared, united = sum((bag & there).values()), sum((bag | there).values())
        if len(words) < len(split(passage)) and 100 * shared >= 75 * united:
            want[doc, item] = (shared / united, 0)
    assert sum(s < 1 for s, _ in want.values()) > 100
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in decontam.leaks(documents(rows), benchmark).collect()} == want
    assert {r.doc_id for r in decontam.clean(documents(rows), benchmark).collect()} == {d for d, _ in rows} - {d for d, _ in want}


# 10


def jumped(key, shards_):
    key, b, j = key % 2**64, -1, 0
    while j < shards_:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_shards_move_only_to_the_new_one(documents):
    rows = [(draw, t) for draw, t in zip(random.Random(21).sample(range(-(10**12), 10**12), 300), prose(300, 22), strict=True)] + AWKWARD[:8]
    out = shards.assign(documents(rows), 8).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32) for r in out) == sorted((d is not None, d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    slots = collections.defaultdict(list)
    for r in out:
        key = -1 if r.doc_id is None else r.doc_id
        assert (r.shard, r.grown_shard, r.law) == (jumped(key, 8), jumped(key, 9), "key") and r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


# All of them on awkward and on empty tables.

ON_DOCUMENTS = {
    "quality": lambda d: quality.score(d, quality.fit(np.zeros((0, quality.FEATURES), np.float32), np.zeros(1, np.int64), np.zeros(0))),
    "repeats": suffixes.deduplicated,
    "spots": spots.edits,
    "forest": forest.near_duplicates,
    "packing": lambda d: packing.pack_documents(d, WORD_BPE),
    "tokens": lambda d: tokens.count_tokens(d, BYTE_BPE, 512),
    "shards": lambda d: shards.assign(d, 8),
    "texts_cut": suffixes.with_texts_cut,
}


@pytest.mark.parametrize("name", sorted(ON_DOCUMENTS))
def test_awkward_and_empty_tables(documents, name):
    out = ON_DOCUMENTS[name](documents(AWKWARD)).collect()
    ids = collections.Counter(r.doc_id for r in out)
    assert set(ids) == {d for d, _ in AWKWARD}
    if name != "packing":
        assert ids == collections.Counter(d for d, _ in AWKWARD)
    assert ON_DOCUMENTS[name](documents([])).count() == 0
