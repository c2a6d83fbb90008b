"""Order-dependent columns that never need a whole group, or the whole table, in one task.

A Spark window partition is computed by one task. That is right for ordinary groups, which all share one hash shuffle.
A group that holds more than ``hot_rows`` rows (or the whole table, if there are no group columns) is cut into segments:

1. the rows are range-partitioned by (group, order) and written to the shared folder together with their segment number,
2. the window runs per (group, segment),
3. what a segment needs from the rows before it is carried over: the last few rows for lags and rolling frames, the last
   known value for a forward fill, a row count for numbering. These carry tables hold a few rows per segment.

The order columns, ascending with nulls last, must identify a row within its group; else the result is not defined.
Rows whose group key is null belong to no group: they are kept, spread over many tasks, and get null.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketloom.session import durable

HOT_ROWS = 500_000
# More range partitions than this are a burden of their own; above 12.5 billion rows the segments grow.
MAX_SEGMENTS = 200_000
_NULL_SPREAD = 4096

SEGMENT, HALO, SPREAD = "__segment", "__halo", "__spread"


def ascending(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def descending(order: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_first() for c in order]


def order_key(order: Sequence[str]) -> Column:
    """One comparable value per row that sorts like ``ascending(order)``."""
    return F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"null_{c}"), F.col(c))])


def has_group(groups: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(g).isNotNull() for g in groups], F.lit(True))


def _spread_nulls(df: DataFrame, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    spread = F.when(has_group(groups), F.lit(0)).otherwise(F.pmod(F.xxhash64(*order), F.lit(_NULL_SPREAD)).cast("int"))
    return df.withColumn(SPREAD, spread)


def hot_groups(df: DataFrame, groups: Sequence[str], hot_rows: int) -> tuple[DataFrame | None, int]:
    """The groups above ``hot_rows`` rows, as a stored table, and how many rows they hold together.

    There are rows / hot_rows of them at most. The table is joined as its size asks for; nothing of it goes to the driver.
    """
    counted = df.where(has_group(groups)).groupBy(*groups).agg(F.count(F.lit(1)).alias("__rows"))
    found = durable(counted.where(F.col("__rows") > hot_rows), "hot-groups")
    rows = found.agg(F.sum("__rows")).first()[0]
    return (found.select(*groups), rows) if rows else (None, 0)


def segmented(df: DataFrame, groups: Sequence[str], order: Sequence[str], rows: int, hot_rows: int) -> DataFrame:
    """``df`` range-partitioned by (group, order), written out, with the segment number of every row."""
    # An eighth of what one task may take, so that the segments spread evenly over the cores.
    count = max(2, min(MAX_SEGMENTS, -(-rows // max(1, hot_rows // 8))))
    ranged = df.repartitionByRange(count, *ascending([*groups, *order]))
    return durable(ranged.withColumn(SEGMENT, F.spark_partition_id()), "segments")


def _window(groups: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*groups).orderBy(*ascending(order))


def _halo(cut: DataFrame, groups: Sequence[str], order: Sequence[str], lookback: int) -> DataFrame:
    """For every (group, segment) the ``lookback`` rows of its group just before it, tagged with that segment.

    Each segment keeps a buffer of its last ``lookback`` rows and hands it to the next one. Where segments are shorter than that,
    buffers are first merged with those one, two, four, ... segments before until all are full, so every row of the small buffer
    table meets one other by an ordinary join, and no task sees more than a few buffers of a group.
    """
    keys = [*groups, SEGMENT]
    backwards = Window.partitionBy(*keys).orderBy(*descending(order))
    tails = cut.withColumn("__back", F.row_number().over(backwards)).where(F.col("__back") <= lookback)
    row = F.struct(*[F.col(c) for c in cut.columns])
    held = F.array_sort(F.collect_list(F.struct("__back", row.alias("row"))), lambda a, b: b["__back"] - a["__back"])
    own = durable(tails.groupBy(*keys).agg(F.transform(held, lambda x: x["row"]).alias("__buffer")), "tails")
    # A group's segments follow one another; one without rows has an empty buffer.
    spans = own.groupBy(*groups).agg(F.min(SEGMENT).alias("__first"), F.max(SEGMENT).alias("__last"))
    along = spans.select(*groups, "__first", F.explode(F.sequence("__first", "__last")).alias(SEGMENT))
    none = F.array().cast(own.schema["__buffer"].dataType)
    buffers = along.join(own, keys, "left").withColumn("__buffer", F.coalesce("__buffer", none))
    step = 1
    while not buffers.where((F.size("__buffer") < lookback) & (F.col(SEGMENT) - step >= F.col("__first"))).isEmpty():
        before = buffers.select(*groups, (F.col(SEGMENT) + step).alias(SEGMENT), F.col("__buffer").alias("__before"))
        both = F.concat(F.coalesce("__before", none), "__buffer")
        last = F.slice(both, F.greatest(F.size(both) - lookback, F.lit(0)) + 1, F.lit(lookback))
        buffers = durable(buffers.join(before, keys, "left").withColumn("__buffer", last).drop("__before"), "buffers")
        step *= 2
    rows = buffers.select((F.col(SEGMENT) + 1).alias("__next"), F.explode("__buffer").alias("__row"))
    return rows.select(
        *[F.col("__next").alias(c) if c == SEGMENT else F.col(f"__row.{c}").alias(c) for c in cut.columns]
    )


def _split(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], hot_rows: int
) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows for the ordinary path, segmented rows); either may be None."""
    if not groups:
        rows = df.count()
        if rows <= hot_rows:
            return df, None
        return None, segmented(df, groups, order, rows, hot_rows)
    keys, rows = hot_groups(df, groups, hot_rows)
    if keys is None:
        return df, None
    hot = segmented(df.join(keys, list(groups), "left_semi"), groups, order, rows, hot_rows)
    # Rows without a group match no key, so the anti join keeps them on the ordinary path.
    return df.join(keys, list(groups), "left_anti"), hot


def ordered_columns(
    df: DataFrame,
    order: Sequence[str],
    outputs: dict[str, Callable[[WindowSpec], Column]],
    lookback: int,
    groups: Sequence[str] = (),
    totals: dict[str, Callable[[WindowSpec | None], Column]] | None = None,
    hot_rows: int = HOT_ROWS,
    running: dict[str, Callable[[WindowSpec], Column]] | None = None,
) -> DataFrame:
    """Add columns over the current and at most ``lookback`` earlier rows of the group.

    ``outputs`` maps a new name to a function from the ordered window to the column. ``totals`` maps a new name to a
    function from the unordered group window to the column; called with ``None`` it must give the plain aggregate.
    ``running`` maps a name to a column over the ordered window that ``outputs`` may use and that is dropped afterwards; in a group
    that is cut into segments it starts ``lookback`` rows before each, so outputs may use differences of it only.
    """
    groups, totals, running = list(groups), totals or {}, running or {}
    plain, cut = _split(df, groups, order, hot_rows)
    names = [*df.columns, *outputs, *totals]
    parts = []

    if plain is not None:
        spread = _spread_nulls(plain, groups, order) if groups else plain
        keys = [*groups, SPREAD] if groups else []
        ordered = _window(keys, order)
        result = spread.withColumns({n: make(ordered) for n, make in running.items()})
        result = result.withColumns({n: make(ordered) for n, make in outputs.items()})
        if totals:
            whole = Window.partitionBy(*keys)
            result = result.withColumns({n: make(whole) for n, make in totals.items()})
        if groups:
            known = has_group(groups)
            result = result.withColumns({n: F.when(known, F.col(n)) for n in (*outputs, *totals)})
        parts.append(result.select(*names))

    if cut is not None:
        halo = _halo(cut, groups, order, lookback)
        rows = cut.withColumn(HALO, F.lit(False)).unionByName(halo.withColumn(HALO, F.lit(True)))
        ordered = _window([*groups, SEGMENT], order)
        result = rows.withColumns({n: make(ordered) for n, make in running.items()})
        result = result.withColumns({n: make(ordered) for n, make in outputs.items()}).where(~F.col(HALO))
        if totals:
            # One row per hot group, so at most as many rows as there are hot groups.
            stats = durable(cut.groupBy(*groups).agg(*[make(None).alias(n) for n, make in totals.items()]), "totals")
            result = result.join(stats, groups, "left")
        parts.append(result.select(*names))

    return reduce(DataFrame.unionByName, parts)


def row_numbers(
    df: DataFrame,
    order: Sequence[str],
    name: str = "row_number",
    groups: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Number the rows of each group, or of the whole table, from 1 in the given order."""
    groups = list(groups)
    plain, cut = _split(df, groups, order, hot_rows)
    parts = []
    if plain is not None:
        spread = _spread_nulls(plain, groups, order) if groups else plain
        keys = [*groups, SPREAD] if groups else []
        number = F.row_number().over(_window(keys, order)).cast("long")
        parts.append(spread.withColumn(name, F.when(has_group(groups), number)).select(*df.columns, name))
    if cut is not None:
        before = Window.partitionBy(*groups).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
        offsets = durable(
            cut.groupBy(*groups, SEGMENT)
            .agg(F.count(F.lit(1)).alias("__rows"))
            .select(*groups, SEGMENT, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")),
            "offsets",
        )
        local = F.row_number().over(_window([*groups, SEGMENT], order))
        numbered = cut.withColumn("__local", local).join(offsets, [*groups, SEGMENT])
        parts.append(numbered.withColumn(name, F.col("__local") + F.col("__offset")).select(*df.columns, name))
    return reduce(DataFrame.unionByName, parts)


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    order: Sequence[str],
    groups: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Replace a null by the last known value before it in the group, or in the whole table."""
    groups, columns = list(groups), list(columns)
    plain, cut = _split(df, groups, order, hot_rows)
    parts = []

    def filled(part: DataFrame, keys: Sequence[str]) -> DataFrame:
        past = _window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
        # Computed under new names: a fill must not see another column's filled values as order keys.
        new = part.withColumns({f"__filled_{c}": F.last(c, ignorenulls=True).over(past) for c in columns})
        if groups:
            new = new.withColumns(
                {f"__filled_{c}": F.when(has_group(groups), F.col(f"__filled_{c}")).otherwise(F.col(c)) for c in columns}
            )
        return new

    def finish(part: DataFrame) -> DataFrame:
        return part.select(*[F.col(f"__filled_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])

    if plain is not None:
        spread = _spread_nulls(plain, groups, order) if groups else plain
        parts.append(finish(filled(spread, [*groups, SPREAD] if groups else [])))
    if cut is not None:
        key = order_key(order)
        last_known = cut.groupBy(*groups, SEGMENT).agg(
            *[F.max_by(c, F.when(F.col(c).isNotNull(), key)).alias(f"__last_{c}") for c in columns]
        )
        before = Window.partitionBy(*groups).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
        carry = durable(
            last_known.select(
                *groups,
                SEGMENT,
                *[F.last(f"__last_{c}", ignorenulls=True).over(before).alias(f"__carry_{c}") for c in columns],
            ),
            "carry",
        )
        result = filled(cut, [*groups, SEGMENT]).join(carry, [*groups, SEGMENT], "left")
        result = result.withColumns(
            {f"__filled_{c}": F.coalesce(F.col(f"__filled_{c}"), F.col(f"__carry_{c}")) for c in columns}
        )
        parts.append(finish(result))
    return reduce(DataFrame.unionByName, parts)
