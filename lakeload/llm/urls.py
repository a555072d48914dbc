"""URL verdicts: rules first, gradient-boosted trees on lexical features for the rest. Built-in functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NUMBERS = ["f_length", "f_host_length", "f_depth", "f_labels", "f_digits", "f_entropy", "f_parameters"]
SUFFIXES = ["f_host_suffix", "f_path_suffix"]
FEATURES = NUMBERS + SUFFIXES
SUFFIX_BUCKETS = 1024


@dataclass(frozen=True)
class Rule:
    """``text`` is host/path-start as ``org/`` or ``example.org/en/1``."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def parts(url: Column) -> tuple[Column, Column]:
    """Host, in lower case, and path; both empty without a ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("url")))
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, UPPER, LOWER), path


def with_rules(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add host, path, and the longest rule that fits with its verdict; both null where none fits."""
    host, path = parts(F.col("url"))
    out = pages.withColumns({"host": host, "path": path})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, F.lit(r.text)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return out.withColumns({"rule": rule, "rule_verdict": verdict})


def with_features(pages: DataFrame) -> DataFrame:
    """Lexical features of the URL; a null URL has those of the empty one. Suffixes are hashed into a fixed number of buckets."""
    url = F.coalesce(F.col("url"), F.lit(""))
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    share = lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size
    letters = F.array_distinct(F.split(url, ""))
    entropy = F.aggregate(F.filter(letters, lambda c: c != ""), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    suffix = lambda text: F.pmod(F.xxhash64(text), F.lit(SUFFIX_BUCKETS)).cast("int")
    return pages.withColumns(
        {
            "f_length": F.length(url).cast("double"),
            "f_host_length": F.length("host").cast("double"),
            "f_depth": F.size(F.filter(F.split("path", "/"), lambda c: c != "")).cast("double"),
            "f_labels": F.size(F.split("host", r"\.")).cast("double"),
            "f_digits": F.length(F.regexp_replace(url, "[^0-9]", "")) / size,
            "f_entropy": F.round(entropy, 6),
            "f_parameters": F.size(F.filter(F.split(query, "&"), lambda c: c != "")).cast("double"),
            "s_host": suffix(F.substring_index("host", ".", -1)),
            "s_path": suffix(F.regexp_extract("path", r"(\.[A-Za-z0-9]{1,5}|/)$", 1)),
        }
    )


@dataclass
class Tree:
    """A split on a bin, or a leaf's value."""

    feature: str | None = None
    bin: int = 0
    low: Tree | None = None
    high: Tree | None = None
    value: float = 0.0

    def column(self) -> Column:
        if self.feature is None:
            return F.lit(self.value)
        return F.when(F.col(self.feature) <= self.bin, self.low.column()).otherwise(self.high.column())


@dataclass
class Model:
    edges: dict[str, list[float]]
    shares: DataFrame
    base: float
    trees: list[Tree] = field(default_factory=list)

    def binned(self, pages: DataFrame) -> DataFrame:
        """Replace features by bin numbers. The suffix shares have one row for each bucket, so they are broadcast."""
        for kind in ("host", "path"):
            one = self.shares.where(F.col("kind") == kind).select(F.col("bucket").alias(f"s_{kind}"), F.col("share").alias(f"f_{kind}_suffix"))
            pages = pages.join(F.broadcast(one), f"s_{kind}", "left")
        pages = pages.fillna(0.5, SUFFIXES)
        return pages.withColumns({f: _bin(F.col(f), self.edges[f]) for f in FEATURES}).drop("s_host", "s_path")

    def margin(self) -> Column:
        out = F.lit(self.base)
        for tree in self.trees:
            out = out + tree.column()
        return out


def _bin(value: Column, edges: list[float]) -> Column:
    out = F.lit(0)
    for edge in edges:
        out = out + (value > edge).cast("int")
    return out


def fit(labelled: DataFrame, trees: int = 12, depth: int = 2, bins: int = 8, rate: float = 0.3, ridge: float = 1.0) -> Model:
    """Boost trees on labelled URLs (features and ``y``, 1 to block), all of them.

    Rows that fall into the same bins are one weighted row after the first pass, so each
    level of a tree is one small aggregate; what reaches the driver is a sum for each node,
    feature and bin. Without rows, or of one class alone, the smoothed base rate is the model.
    """
    wanted = [i / bins for i in range(1, bins)]
    total = labelled.agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"), *[F.percentile_approx(f, wanted, 10_000).alias(f) for f in NUMBERS]
    ).first()
    n, y = total["n"], total["y"] or 0
    prior = (y + 1) / (n + 2)
    kinds = [F.struct(F.lit(k).alias("kind"), F.col(f"s_{k}").alias("bucket")) for k in ("host", "path")]
    shares = labelled.select("y", F.inline(F.array(*kinds))).groupBy("kind", "bucket")
    shares = settle(shares.agg(F.round((F.sum("y") + 10 * prior) / (F.count(F.lit(1)) + 10), 6).alias("share")), "suffixes")
    edges = {f: sorted(set(total[f] or [])) for f in NUMBERS} | {f: [i / bins for i in range(1, bins)] for f in SUFFIXES}
    model = Model(edges, shares, math.log(prior / (1 - prior)))
    if not 0 < y < n:
        return model
    cells = settle(model.binned(labelled).groupBy(*FEATURES).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")), "cells")
    for _ in range(trees):
        model.trees.append(_grow(cells, model.margin(), depth, rate, ridge))
    return model


def _grow(cells: DataFrame, margin: Column, depth: int, rate: float, ridge: float) -> Tree:
    """One tree, level by level: each level sums gradients by node, feature and bin and splits where the gain is largest."""
    p = 1 / (1 + F.exp(-margin))
    root, leaves = Tree(), []
    level: list[tuple[Tree, Column]] = [(root, F.lit(True))]
    for d in range(depth + 1):
        node = F.lit(None).cast("int")
        for k, (_, there) in enumerate(level):
            node = F.when(there, F.lit(k)).otherwise(node)
        rows = cells.select(node.alias("node"), (F.col("y") - F.col("n") * p).alias("g"), (F.col("n") * p * (1 - p)).alias("h"), *FEATURES)
        pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in FEATURES])
        sums = rows.where("node IS NOT NULL").select("node", "g", "h", F.inline(pairs)).groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        found = sums.collect()
        following = []
        for k, (tree, there) in enumerate(level):
            own = [r for r in found if r["node"] == k]
            g, h = (sum(r[c] for r in own if r["feature"] == FEATURES[0]) for c in "gh")
            tree.value = round(rate * g / (h + ridge), 9)
            best = _best(own, g, h, ridge) if d < depth else None
            if best:
                tree.feature, tree.bin = best
                tree.low, tree.high = Tree(), Tree()
                at = F.col(tree.feature) <= tree.bin
                following += [(tree.low, there & at), (tree.high, there & ~at)]
            else:
                leaves.append(tree)
        level = following
        if not level:
            break
    return root


def _best(sums, g: float, h: float, ridge: float) -> tuple[str, int] | None:
    gain, choice = 1e-6, None
    for f in FEATURES:
        left_g = left_h = 0.0
        for r in sorted((r for r in sums if r["feature"] == f), key=lambda r: r["bin"])[:-1]:
            left_g, left_h = left_g + r["g"], left_h + r["h"]
            now = left_g**2 / (left_h + ridge) + (g - left_g) ** 2 / (h - left_h + ridge) - g**2 / (h + ridge)
            if now > gain + 1e-9:
                gain, choice = now, (f, r["bin"])
    return choice


def judge(pages: DataFrame, rules: list[Rule], **how) -> DataFrame:
    """Verdict of every page: its longest rule's, else the model's, trained on the pages that rules decide.

    Returns page_id, host, path, rule, verdict and score (of block). Null and odd URLs are
    judged by the model; repeated rows give repeated rows; other columns are not read.
    """
    base = with_features(with_rules(pages.select("page_id", F.col("url").cast("string").alias("url")), rules))
    labelled = base.where("rule_verdict IS NOT NULL").withColumn("y", (F.col("rule_verdict") == "block").cast("long"))
    labelled = settle(labelled.select("y", *NUMBERS, "s_host", "s_path"), "labelled")
    model = fit(labelled, **how)
    score = 1 / (1 + F.exp(-model.margin()))
    out = model.binned(base).withColumn("score", score)
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
