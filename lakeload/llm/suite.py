"""The numbered queries over the given tables, with their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.session import table

from . import chat, decontam, forest, merkle, packing, periods, quality, shards, spots, suffixes, superkmers, tokens, urls

RULES = [
    urls.Rule("allow", "org/"),
    urls.Rule("block", "example.org/es/"),
    urls.Rule("block", "example.org/en/1"),
    urls.Rule("allow", "com/fr/"),
    urls.Rule("block", "com/de/"),
]


def op1_chat_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return chat.format_chats(table(spark, sf, "conversations"))


OP1_SQL = """
WITH turns AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS position
  FROM conversations
), said AS (
  SELECT conv_id, position, md5(coalesce('r' || role, '') || chr(31) || coalesce('t' || text, '')) AS h FROM turns
), prefixes AS (
  SELECT conv_id, position, string_agg(h, '') OVER (PARTITION BY conv_id ORDER BY position) AS so_far,
         count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM said
), ends AS (
  SELECT so_far, min(conv_id) AS conv_id, any_value(n_turns) AS n_turns, count(*) AS n_copies
  FROM prefixes WHERE position + 1 = n_turns GROUP BY so_far
), kept AS (
  SELECT * FROM ends WHERE so_far NOT IN (SELECT so_far FROM prefixes WHERE position + 1 < n_turns)
)
SELECT t.conv_id, t.position, k.n_turns, k.n_copies, t.role,
       '<|im_start|>' || coalesce(t.role, '') || chr(10) || coalesce(t.text, '') || '<|im_end|>' || chr(10) AS rendered
FROM turns t JOIN kept k ON t.conv_id IS NOT DISTINCT FROM k.conv_id
"""


def op2_attention_quality(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    return quality.score(documents, quality.train(documents, table(spark, sf, "labels")))


def op3_url_trees(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge(table(spark, sf, "pages"), RULES)


def op4_merged_transforms(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.deduplicated(table(spark, sf, "documents"))


OP4_SQL = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), windows AS (
  SELECT doc_id, s, substr(h, 2 * s + 1, 200) AS w FROM (SELECT doc_id, h, unnest(range(n - 99)) AS s FROM docs WHERE n >= 100)
), repeats AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY w ORDER BY doc_id, s) AS o FROM windows) WHERE o > 1
), reached AS (
  SELECT doc_id, s, max(s + 100) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM repeats
), islands AS (
  SELECT doc_id, s, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS island FROM reached
), runs AS (
  SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM islands GROUP BY doc_id, island
), kept AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f, a AS t FROM runs
  UNION ALL
  SELECT d.doc_id, coalesce(max(r.b), 0), d.n FROM docs d LEFT JOIN runs r USING (doc_id) GROUP BY d.doc_id, d.n
), gone AS (
  SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id
), texts AS (
  SELECT doc_id, sha256(unhex(string_agg(substr(h, CAST(2 * f + 1 AS BIGINT), CAST(2 * (t - f) AS BIGINT)), '' ORDER BY f))) AS kept_sha256
  FROM kept JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256
FROM docs d JOIN texts USING (doc_id) LEFT JOIN gone USING (doc_id)
"""


def op5_spot_signatures(spark: SparkSession, sf: str) -> DataFrame:
    return spots.edits(table(spark, sf, "documents"))


def op6_lsh_forest(spark: SparkSession, sf: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf, "documents"))


# Words and shingles as two queries read them.
GRAMS_SQL = r"""
  SELECT {id}, list_transform(range(1, greatest(len(ws) - 3, 2)), lambda i: array_to_string(ws[i:i + 4], ' ')) AS gs, len(ws) AS n_words
  FROM (
    SELECT {id}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
    FROM {table}
  ) WHERE len(ws) > 0
"""

OP6_SQL = f"""
WITH RECURSIVE grams AS (
  SELECT DISTINCT doc_id, unnest(gs) AS g FROM ({GRAMS_SQL.format(id="doc_id", table="documents")})
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, node) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.node
), homes AS (
  SELECT doc_id, min(node) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM homes LEFT JOIN sizes USING (doc_id)
"""


def op7_residual_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op9_simhash_windows(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


OP9_SQL = f"""
WITH docs AS (
  {GRAMS_SQL.format(id="doc_id", table="documents")}
), places AS (
  SELECT doc_id, unnest(gs) AS g, unnest(range(len(gs))) AS pos, len(gs) AS n FROM docs
), items AS (
  {GRAMS_SQL.format(id="item_id", table="benchmark")}
), counts AS (
  SELECT item_id, g, len AS m, n_words, count(*) AS c
  FROM (SELECT item_id, unnest(gs) AS g, len(gs) AS len, n_words FROM items) GROUP BY ALL
), begins AS (
  SELECT DISTINCT doc_id, item_id, m, n_words, b
  FROM (SELECT p.doc_id, p.n, c.item_id, c.m, c.n_words, unnest(range(p.pos - c.m + 1, p.pos + 1)) AS b FROM places p JOIN counts c ON p.g = c.g)
  WHERE b >= 0 AND b + m <= n
), windows AS (
  SELECT s.doc_id, s.item_id, s.m, s.n_words, s.b, p.g, count(*) AS w
  FROM begins s JOIN places p ON p.doc_id = s.doc_id AND p.pos >= s.b AND p.pos < s.b + s.m GROUP BY ALL
), alike AS (
  SELECT w.doc_id, w.item_id, w.m, w.n_words, w.b, sum(least(w.w, c.c)) AS shared
  FROM windows w JOIN counts c ON c.item_id = w.item_id AND c.g = w.g GROUP BY ALL
), scored AS (
  SELECT *, shared / (2 * m - shared) AS similarity FROM alike WHERE 100 * shared >= 75 * (2 * m - shared)
)
SELECT doc_id, item_id, max(similarity) AS similarity, CAST(arg_min(b, (-similarity, b)) AS BIGINT) AS first_word, CAST(any_value(n_words) AS BIGINT) AS n_words
FROM scored GROUP BY doc_id, item_id
"""


def op10_jump_shards(spark: SparkSession, sf: str) -> DataFrame:
    return shards.assign(table(spark, sf, "documents"), 8)


def op11_super_kmers(spark: SparkSession, sf: str) -> DataFrame:
    kept = superkmers.without_repeats(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(ws[s:s + 12], ' ') AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS s FROM docs WHERE len(ws) >= 13)
), repeats AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY w) AS first FROM windows) WHERE doc_id > first
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS i FROM repeats
), places AS (
  SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM docs
), kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t, count(*) AS n FROM places ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""


LEAF = ["doc_id", "source", "lang", "n_chars", "text"]
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_level_strings(spark: SparkSession, sf: str) -> DataFrame:
    """A manifest checked against texts of which a fifth has lost its capitals."""
    small = merkle.leaf(*[F.translate("text", CAPITALS, SMALL) if c == "text" else F.col(c) for c in LEAF])
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = merkle.manifest(table(spark, sf, "documents"), LEAF, tampered=F.when(touched, small))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def _tree_sql(name: str, levels: int) -> str:
    """Levels of a tree over {name}_0 (tree, pos, d, c nodes of the tree), each with what flanks its nodes in their run of 16."""
    ctes = []
    for k in range(levels):
        side = "string_agg(d, '') OVER (PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN {})"
        ctes.append(f"""{name}_flanks_{k} AS (
  SELECT tree, pos, c, coalesce({side.format("UNBOUNDED PRECEDING AND 1 PRECEDING")}, '') AS l, coalesce({side.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")}, '') AS r FROM {name}_{k}
), {name}_{k + 1} AS (
  SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM (
    SELECT tree, pos // 16 AS pos, CASE WHEN any_value(c) > 1 THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE any_value(d) END AS d FROM {name}_{k} GROUP BY tree, pos // 16
  )
)""")
    return ", ".join(ctes)


def _fold_sql(name: str, levels: int, before: str, at: str) -> str:
    """Steps of every row of {before} up that tree; ``at`` is its leaf's place there."""
    ctes = []
    for k in range(levels):
        ctes.append(f"""{name}_at_{k} AS (
  SELECT b.* REPLACE (CASE WHEN c > 1 THEN sha256(l || f || r) ELSE f END AS f, CASE WHEN c > 1 THEN proof || l || r ELSE proof END AS proof)
  FROM {before if k == 0 else f"{name}_at_{k - 1}"} b JOIN {name}_flanks_{k} n ON n.tree = b.{"tree" if name == "low" else "whole"} AND n.pos = b.{at} // {16**k}
)""")
    return ", ".join(ctes)


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


OP12_SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce('s' || source, '') AS tree, 0 AS whole, sha256({" || ".join(_field_sql(c) for c in LEAF)}) AS leaf,
         sha256({" || ".join(_field_sql(f"translate(text, '{CAPITALS}', '{SMALL}')" if c == "text" else c) for c in LEAF)}) AS small,
         xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
           lambda x: list_transform(range(8), lambda k: (ascii(x) >> k) & 1)))),
           lambda h, b: xor(h >> 1, CASE WHEN xor(h, b) & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS pos FROM docs
), low_0 AS (
  SELECT tree, pos, leaf AS d, count(*) OVER (PARTITION BY tree) AS c FROM placed
), {_tree_sql("low", 6)}, tops AS (
  SELECT tree AS own, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS rank FROM low_6
), high_0 AS (
  SELECT 0 AS tree, rank AS pos, subroot AS d, count(*) OVER () AS c FROM tops
), {_tree_sql("high", 4)}, claims AS (
  SELECT p.*, t.subroot, t.rank, CASE WHEN crc % 5 = 0 THEN small ELSE leaf END AS f, '' AS proof FROM placed p JOIN tops t ON t.own = p.tree
), {_fold_sql("low", 6, "claims", "pos")}, {_fold_sql("high", 4, "low_at_5", "rank")}
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = d AS verified FROM high_at_3 CROSS JOIN high_4
"""


def op13_harmonic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return periods.digest(periods.with_runs(periods.looped(table(spark, sf, "documents"))))


KEYS = {
    "op1_chat_snapshots": (op1_chat_snapshots, OP1_SQL),
    "op2_attention_quality": (op2_attention_quality, None),
    "op3_url_trees": (op3_url_trees, None),
    "op4_merged_transforms": (op4_merged_transforms, OP4_SQL),
    "op5_spot_signatures": (op5_spot_signatures, None),
    "op6_lsh_forest": (op6_lsh_forest, OP6_SQL),
    "op7_residual_packing": (op7_residual_packing, None),
    "op8_token_counts": (op8_token_counts, None),
    "op9_simhash_windows": (op9_simhash_windows, OP9_SQL),
    "op10_jump_shards": (op10_jump_shards, None),
    "op11_super_kmers": (op11_super_kmers, OP11_SQL),
    "op12_level_strings": (op12_level_strings, OP12_SQL),
    "op13_harmonic_runs": (op13_harmonic_runs, None),
}
