"""Exact quantiles without gathering the values of a column.

A column whose number of distinct values is small (checked, not assumed) is counted per value; the place of a rank then
follows from a running sum over the distinct values. For the others a sketch (``percentile_approx``) proposes cut points
near the wanted rank, one scan counts the rows below and at every cut point, and the open interval that holds the rank is
narrowed again until few enough rows are left to look at. Each step keeps about one row in a thousand and shuffles
sketches only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_DISTINCT = 100_000
MAX_ROWS_LEFT = 20_000
_ACCURACY = 10_000
_STEP = 2.0 / _ACCURACY


class _Rank:
    """The search for the value at one rank (counted from 0) of one column."""

    def __init__(self, column: str, rank: int, rows: int):
        self.column, self.rank = column, rank
        self.below = 0  # rows at or under the lower end of the interval
        self.left = rows  # rows strictly inside the interval
        self.low: float | None = None
        self.high: float | None = None
        self.value: float | None = None

    def inside(self):
        value = F.col(self.column)
        kept = value.isNotNull()
        if self.low is not None:
            kept = kept & (value > self.low)
        if self.high is not None:
            kept = kept & (value < self.high)
        return F.when(kept, value)

    def cut_shares(self) -> list[float]:
        share = (self.rank - self.below + 0.5) / self.left
        return sorted({min(1.0, max(0.0, share + d)) for d in (-_STEP, 0.0, _STEP)})

    def narrow(self, cuts: list[tuple[float, int, int]]) -> None:
        """``cuts`` holds (value, rows inside below it, rows inside up to it); all refer to the current interval."""
        offset, inside, low, high, under, upto = self.rank - self.below, self.left, self.low, self.high, 0, self.left
        for value, less, less_or_equal in sorted(cuts):
            if less <= offset < less_or_equal:
                self.value = value
                return
            if less_or_equal <= offset and less_or_equal >= under:
                low, under = value, less_or_equal
            if less > offset and less <= upto:
                high, upto = value, less
        self.low, self.high = low, high
        self.below += under
        self.left = upto - under
        if self.left >= inside:
            raise RuntimeError(f"no progress in the quantile search on {self.column}")


def _narrow_all(df: DataFrame, ranks: list[_Rank]) -> None:
    """One round: ranks that share column and interval share one sketch and its cut points."""
    together: dict[tuple, list[_Rank]] = {}
    for r in ranks:
        together.setdefault((r.column, r.low, r.high), []).append(r)
    sets = list(together.values())
    shares = [sorted({x for r in same for x in r.cut_shares()}) for same in sets]
    row = df.agg(
        *[F.percentile_approx(same[0].inside(), x, _ACCURACY).alias(f"q{i}") for i, (same, x) in enumerate(zip(sets, shares))]
    ).first()
    cuts = [sorted(set(row[f"q{i}"])) for i in range(len(sets))]
    counts = df.agg(
        *[
            F.count(F.when(test, 1)).alias(f"c{i}_{j}_{kind}")
            for i, same in enumerate(sets)
            for j, cut in enumerate(cuts[i])
            for kind, test in (("lt", same[0].inside() < cut), ("le", same[0].inside() <= cut))
        ]
    ).first()
    for i, same in enumerate(sets):
        for r in same:
            r.narrow([(c, counts[f"c{i}_{j}_lt"], counts[f"c{i}_{j}_le"]) for j, c in enumerate(cuts[i])])


def _search(df: DataFrame, ranks: list[_Rank]) -> None:
    while open_ranks := [r for r in ranks if r.value is None and r.left > MAX_ROWS_LEFT]:
        _narrow_all(df, open_ranks)
    last = [r for r in ranks if r.value is None]
    if not last:
        return
    slots = F.array(*[F.struct(F.lit(i).alias("slot"), r.inside().alias("value")) for i, r in enumerate(last)])
    # At most MAX_ROWS_LEFT values per slot are left, which the search above has counted.
    found = (
        df.select(F.explode(slots).alias("s"))
        .where(F.col("s.value").isNotNull())
        .groupBy("s.slot", "s.value")
        .agg(F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    for i, r in enumerate(last):
        seen = r.below
        for value, rows in sorted((f["value"], f["rows"]) for f in found if f["slot"] == i):
            seen += rows
            if seen > r.rank:
                r.value = value
                break


def _count_values(df: DataFrame, ranks: dict[str, list[int]]) -> dict[tuple[str, int], float]:
    """The values at the given ranks of columns with few distinct values."""
    columns = list(ranks)
    pairs = F.array(*[F.struct(F.lit(i).alias("slot"), F.col(c).alias("value")) for i, c in enumerate(columns)])
    wanted = F.array(*[F.array(*[F.lit(r).cast("long") for r in ranks[c]]) for c in columns])
    counts = (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("slot", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("upto", F.sum("rows").over(Window.partitionBy("slot").orderBy("value")))
        .withColumn("ranks", F.element_at(wanted, F.col("slot") + 1))
    )
    hit = lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("rows"))
    found = counts.select("slot", "value", F.explode(F.filter("ranks", hit)).alias("rank")).collect()
    return {(columns[f["slot"]], f["rank"]): f["value"] for f in found}


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], max_distinct: int = MAX_DISTINCT
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation of the non-null values; ``None`` for a column without any."""
    columns, shares = list(columns), list(shares)
    if not columns:
        return {}
    df = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    row = df.agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.approx_count_distinct(c).alias(f"d_{c}") for c in columns],
    ).first()
    places = {c: [share * (row[f"n_{c}"] - 1) for share in shares] for c in columns if row[f"n_{c}"]}
    ranks = {c: sorted({k for p in ps for k in (math.floor(p), math.ceil(p))}) for c, ps in places.items()}

    few = {c: r for c, r in ranks.items() if row[f"d_{c}"] <= max_distinct}
    values = _count_values(df, few) if few else {}
    searches = [_Rank(c, k, row[f"n_{c}"]) for c, r in ranks.items() if c not in few for k in r]
    if searches:
        _search(df, searches)
        values.update({(r.column, r.rank): r.value for r in searches})

    result: dict[str, list[float | None]] = {c: [None] * len(shares) for c in columns}
    for c, ps in places.items():
        for i, p in enumerate(ps):
            low, high = values[c, math.floor(p)], values[c, math.ceil(p)]
            result[c][i] = low + (high - low) * (p - math.floor(p))
    return result


def approx_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> dict[str, list[float | None]]:
    """One scan; rank error below one in ten thousand, no interpolation."""
    columns = list(columns)
    if not columns:
        return {}
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(shares), _ACCURACY).alias(c) for c in columns]).first()
    return {c: list(row[c]) if row[c] is not None else [None] * len(shares) for c in columns}


def quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], exact: bool = True
) -> dict[str, list[float | None]]:
    return exact_quantiles(df, columns, shares) if exact else approx_quantiles(df, columns, shares)
