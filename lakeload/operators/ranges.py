"""Ranges of about equal rows for parallel readers, however the values of the split column are spread.

Ranges of equal width leave most readers idle on a gapped or skewed key. Here the cut points are
quantiles from Spark's mergeable KLL sketch, and a value that alone is more than half a reader's
share is taken out of the ranges: it is read by itself, cut by a second column where it is
heavier than one share.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

WHOLE = ("tinyint", "smallint", "int", "bigint")
#: Quantiles taken for each reader: a value is known to be hot by the number of them that it holds.
STEPS = 16
#: A sketch of K = 64 per reader knows ranks to about a tenth of a reader's share.
K_PER_READER, SMALLEST_K, LARGEST_K = 64, 400, 65_535
LONG_DIGITS = 18


@dataclass(frozen=True)
class Scale:
    """How values of one column type are laid out on whole numbers, and written back as SQL."""

    kind: str
    digits: int = 0

    def position(self, column: str) -> Column:
        col = F.col(column)
        if self.kind in WHOLE:
            return col.cast("bigint")
        if self.kind == "date":
            return F.unix_date(col).cast("bigint")
        if self.kind.startswith("timestamp"):
            return F.unix_micros(col.cast("timestamp"))
        # Wider decimals are placed by their leading digits; the ranges themselves compare the column as it is.
        if self.wide:
            return F.floor(col.cast("double") * F.lit(10.0**self.digits)).cast("bigint")
        return (col * F.lit(Decimal(10**self.digits))).cast("bigint")

    @property
    def wide(self) -> bool:
        return self.kind.startswith("decimal") and int(self.kind[8:-1].split(",")[0]) > LONG_DIGITS

    def literal(self, position: int, vendor: str = "spark") -> str:
        if self.kind == "date":
            day = dt.date(1970, 1, 1) + dt.timedelta(days=position)
            return f"CAST('{day.isoformat()}' AS DATE)" if vendor == "sqlserver" else f"DATE '{day.isoformat()}'"
        if self.kind.startswith("timestamp"):
            at = (dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=position)).isoformat(sep=" ", timespec="microseconds")
            named = "TIMESTAMP_NTZ" if self.kind == "timestamp_ntz" and vendor == "spark" else "TIMESTAMP"
            return f"CAST('{at}' AS DATETIME2)" if vendor == "sqlserver" else f"{named} '{at}'"
        if self.kind.startswith("decimal"):
            return format(Decimal(position).scaleb(-self.digits), "f")
        return str(position)


def scale_of(df: DataFrame, column: str) -> Scale:
    """The scale of a whole number, decimal, date or time column; other columns are refused."""
    kinds = dict(df.dtypes)
    if column not in kinds:
        raise ValueError(f"split column {column} is not one of: {', '.join(df.columns)}")
    kind = kinds[column]
    if kind.startswith("decimal"):
        precision, scale = (int(x) for x in kind[8:-1].split(","))
        return Scale(kind, scale - max(0, precision - LONG_DIGITS))
    if kind in (*WHOLE, "date", "timestamp", "timestamp_ntz"):
        return Scale(kind)
    raise ValueError(f"split column {column} is {kind}; a number, date or time is needed")


@dataclass(frozen=True)
class Part:
    """One reader's rows. Bounds are half open; without a lower or upper bound the part is open there.

    ``only`` is the hot value the part is about; ``without`` are the hot values that its range
    leaves to other parts. ``nulls`` adds the rows without a value. ``inner`` bounds the second column.
    """

    lower: int | None = None
    upper: int | None = None
    only: int | None = None
    without: tuple[int, ...] = ()
    nulls: bool = False
    nulls_only: bool = False
    inner: Part | None = None

    def sql(self, column: str, scale: Scale, second: str | None = None, inner: Scale | None = None, vendor: str = "spark") -> str:
        """The part as a filter over already quoted column names."""
        value = lambda p: scale.literal(p, vendor)
        if self.nulls_only:
            said = f"{column} IS NULL"
        elif self.only is not None:
            said = f"{column} = {value(self.only)}"
        else:
            bounds = [f"{column} >= {value(self.lower)}"] if self.lower is not None else []
            bounds += [f"{column} < {value(self.upper)}"] if self.upper is not None else []
            bounds += [f"{column} NOT IN ({', '.join(map(value, self.without))})"] if self.without else []
            said = " AND ".join(bounds) or f"{column} IS NOT NULL"
            if self.nulls:
                said = f"({said} OR {column} IS NULL)"
        if self.inner is not None:
            said = f"{said} AND {self.inner.sql(second, inner, vendor=vendor)}"
        return said


def _grid(position: Column, n: int) -> Column:
    """Quantiles at STEPS ranks for each of n readers, from one mergeable sketch; NULL where there is no value."""
    k = min(LARGEST_K, max(SMALLEST_K, K_PER_READER * n))
    ranks = F.array(*[F.lit((i + 0.5) / (n * STEPS)) for i in range(n * STEPS)])
    return F.when(F.count(position) > 0, F.kll_sketch_get_quantile_bigint(F.kll_sketch_agg_bigint(position, F.lit(k)), ranks))


def _cut(grid: list[int], n: float, exact: bool) -> tuple[list[Part], dict[int, float]]:
    """Ranges of one share each over a grid of quantiles, and the hot values left out with their shares of all rows.

    A share is 1/n of the grid. Only a scale that tells values apart exactly has hot values.
    """
    weight: dict[int, int] = {}
    for v in grid:
        weight[v] = weight.get(v, 0) + 1
    share = len(grid) / n
    hot = {v: w for v, w in weight.items() if exact and w > share / 2}
    cuts, held, rest = [], 0.0, len(grid) - sum(hot.values())
    wanted = max(1, -(-rest // max(1, int(share))))
    each = rest / wanted if rest else 1.0
    for v in sorted(set(weight) - set(hot)):
        if held >= each * (len(cuts) + 1) - 0.5 and len(cuts) < wanted - 1:
            cuts.append(v)
        held += weight[v]
    ends = [None, *cuts, None]
    parts = []
    for low, high in zip(ends, ends[1:]):
        inside = tuple(sorted(v for v in hot if (low is None or v >= low) and (high is None or v < high)))
        parts.append(Part(low, high, without=inside))
    return parts, {v: w / len(grid) for v, w in hot.items()}


def even_parts(df: DataFrame, column: str, n: int, second: str | None = None) -> list[Part]:
    """Parts of about ``1/n`` of the rows each, every row in exactly one of them, also rows that come later.

    ``second`` is a column that cuts hot values further, and NULLs where they are many; without
    it a hot value is one part, however heavy. Two passes at most: one sketch of the column, and
    one of the second column over the rows of hot values alone. What reaches the driver is
    STEPS * n quantiles, and as many for each value heavier than a share, of which there are at
    most n.
    """
    if n < 1:
        raise ValueError("at least one reader is needed")
    scale, inner = scale_of(df, column), scale_of(df, second) if second else None
    p = scale.position(column)
    total, known, grid = df.agg(F.count("*"), F.count(p), _grid(p, n)).first()
    nulls = (total - known) / total if total else 0.0
    parts, hot = _cut(grid, n * (known / total), not scale.wide) if grid else ([Part()], {})
    shares: dict[int | None, float] = {v: s * known / total for v, s in hot.items()}
    if nulls <= 0.25 / n:
        parts[0] = Part(parts[0].lower, parts[0].upper, without=parts[0].without, nulls=True)
    else:
        shares[None] = nulls
    heavy = {v: s for v, s in shares.items() if s * n > 1.25 and second}
    inside: dict[int | None, list[Part]] = {}
    if heavy:
        named = [v for v in heavy if v is not None]
        held = F.col(column).isNull() if None in heavy else F.lit(False)
        if named:
            held = held | F.expr(f"`{column}` IN ({', '.join(map(scale.literal, named))})")
        readers = max(2, round(max(heavy.values()) * n + 0.49))
        found = df.where(held).groupBy(p.alias("p")).agg(_grid(inner.position(second), readers).alias("grid"), F.count(second).alias("known"), F.count("*").alias("total"))
        for p_, grid_, known_, total_ in found.collect():
            if known_:
                m = max(2, round(heavy[p_] * n + 0.49)) * known_ / total_
                ranged, again = _cut(grid_, max(1.0, m), not inner.wide)
                ranged[0] = Part(ranged[0].lower, ranged[0].upper, without=ranged[0].without, nulls=True)
                inside[p_] = ranged + [Part(only=v) for v in sorted(again)]
    for v in sorted(shares, key=lambda v: (v is None, v)):
        whole = Part(nulls_only=True) if v is None else Part(only=v)
        cut = inside.get(v, [None])
        parts += [Part(only=whole.only, nulls_only=whole.nulls_only, inner=i) for i in cut]
    return parts


def filters(df: DataFrame, column: str, n: int, second: str | None = None, vendor: str = "spark", names: tuple[str, str] | None = None) -> list[str]:
    """``even_parts`` as SQL filters, for Spark or in a vendor's words over ``names`` as that vendor quotes them.

    ``df`` may be the lake's copy of the vendor's table: the outer ranges are open, so rows that
    have come since are read too, in the range they belong to.
    """
    scale, inner = scale_of(df, column), scale_of(df, second) if second else None
    outer, within = names or (f"`{column}`", f"`{second}`")
    return [part.sql(outer, scale, within, inner, vendor) for part in even_parts(df, column, n, second)]


def measured(df: DataFrame, parts: list[str]) -> DataFrame:
    """One row: all rows, those in exactly one part, and the rows of the largest part, from one scan."""
    member = [F.coalesce(F.expr(s), F.lit(False)).cast("bigint") for s in parts]
    rows = df.select(F.array(*member).alias("m"))
    counted = [F.sum(F.element_at("m", i)).alias(f"_{i}") for i in range(1, len(parts) + 1)]
    once = F.count_if(F.aggregate("m", F.lit(0).cast("bigint"), lambda a, x: a + x) == 1)
    return rows.agg(F.count("*").alias("n_rows"), once.alias("n_once"), *counted).select(
        "n_rows", "n_once", F.coalesce(F.array_max(F.array(*[f"_{i}" for i in range(1, len(parts) + 1)])), F.lit(0)).alias("largest")
    )
