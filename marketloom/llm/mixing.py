"""Mixing sources to target weights by Pfair scheduling.

A source is read in a hashed order and cut into blocks of ``block_bytes`` (a document belongs to the block in which it
begins; its size is its UTF-8 bytes plus 8). The mix is a sequence of slots of one block each. Block k of a source of weight w
is released at slot floor(k / w) and must be placed before its deadline ceil((k + 1) / w); in every slot the released block
with the earliest deadline is placed (ties: the first source by name). With weights that add up to 1 all deadlines are met, so
after any number of slots a source is less than one block away from its weight.

Weights are whole shares of ``resolution`` (2**31: a weight is met to 1/2**31, and the least one is that), so rounding moves a source
by less than a block in two thousand million slots. A block has ``block_bytes``, or the least whole multiple of it with which the mix has
at most ``max_slots`` slots (2**22: blocks grow from 64 GB of mix on, to 24 MB at 100 TB). So the slots are a list of bounded length at
every size: the driver goes through it once with two heaps (a few seconds at most), and every block finds its slot by its number in a
broadcast table of it, 4 bytes a slot and 16 MB at most. If the shares repeat sooner (they have a common divisor), the list is one cycle.

The mix ends when every source has been read whole once. Sources whose weight is above their share of the data are
read again by then (``epoch`` counts from 0), so no document is left out and the weights hold to the end.

Without given weights a source's is its bytes, rounded up to whole blocks, to the power of ``power`` (below 1), which raises small
sources. So the source of most blocks is the last to be read whole, and one of fewer blocks, even of a few bytes, makes no other
source come again: with B blocks in the largest, a source of n is read (B / n) ** (1 - power) times, rounded up by a block. Given
weights need not add up to 1; every source of the table needs one, and one far below its share of the data makes the others come again.

Defined results: documents without a source are a source of their own (null); missing and empty texts have size 8; repeated
rows are rows of their own, in any order among themselves; an empty table gives no rows. More sources than ``resolution``,
a source without a positive weight, and one whose given weight is so small that the others must fill ``max_slots`` slots before its
single block raise ValueError. Columns of the input keep their names; columns of the schedule replace
columns of the same name.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import bucket_count, ranked

RESOLUTION, BLOCK_BYTES, POWER = 1 << 31, 16_384, 0.8
#: Slots that the driver works out and broadcasts at most.
MAX_SLOTS = 1 << 22
#: Slots of one row of the broadcast table.
PART = 4096
SCHEDULE = ["size", "offset", "epoch", "block", "release", "deadline", "position"]


def size_of(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 8).cast("long")


def shares(weights: list[float], resolution: int) -> list[int]:
    """Whole shares that add up to ``resolution``, nearest to ``weights`` by largest remainders, 1 at least."""
    if len(weights) > resolution:
        raise ValueError(f"{len(weights)} sources need a resolution of as many slots at least, not {resolution}")
    if any(not w > 0 for w in weights):
        raise ValueError("weights must be positive")
    spare = resolution - len(weights)
    ideal = [max(0.0, w / sum(weights) * resolution - 1) for w in weights]
    scale = spare / sum(ideal) if sum(ideal) > 0 else 0.0
    parts = [x * scale for x in ideal]
    out = [int(x) for x in parts]
    order = sorted(range(len(parts)), key=lambda i: (out[i] - parts[i], i))
    for i in order[: spare - sum(out)]:
        out[i] += 1
    return [x + 1 for x in out]


def slots(parts: list[int], length: int) -> list[np.ndarray]:
    """The slots below ``length`` of each source's blocks, earliest deadline first, for weights ``parts`` / sum(parts)."""
    total = sum(parts)
    owner = np.empty(length, np.int32)
    done = [0] * len(parts)
    ready = [(-(-total // p), i) for i, p in enumerate(parts)]
    heapq.heapify(ready)
    later: list[tuple[int, int]] = []
    for t in range(length):
        while later and later[0][0] <= t:
            i = heapq.heappop(later)[1]
            heapq.heappush(ready, (-(-(done[i] + 1) * total // parts[i]), i))
        i = heapq.heappop(ready)[1]
        owner[t] = i
        done[i] += 1
        heapq.heappush(later, (done[i] * total // parts[i], i))
    order = np.argsort(owner, kind="stable")
    return np.split(order, np.cumsum(done)[:-1])


def schedule(
    docs: DataFrame,
    size: Column,
    weights: dict[str | None, float] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    resolution: int = RESOLUTION,
    block_bytes: int = BLOCK_BYTES,
    power: float = POWER,
    max_slots: int = MAX_SLOTS,
) -> DataFrame:
    """``docs``, each row once per epoch, with ``size``, ``offset`` (bytes of the source before it), ``epoch``, ``block``
    (over all epochs), ``release``, ``deadline`` and ``position`` (its slot)."""
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in SCHEDULE]
    rows = docs.withColumn("size", size).select(*[F.col(f"`{c}`") for c in kept], "size")
    totals = rows.groupBy(F.col(source_col).alias("source")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    totals = totals.orderBy(F.col("source").asc_nulls_last()).collect()
    if not totals:
        empty = rows.withColumn("offset", F.lit(0).cast("long")).withColumn("epoch", F.lit(0).cast("long"))
        return empty.withColumns({c: F.lit(0).cast("long") for c in SCHEDULE[3:]}).select(*kept, *SCHEDULE)
    while True:
        blocks = [-(-t["bytes"] // block_bytes) for t in totals]
        wanted = [float(n * block_bytes) ** power if weights is None else weights.get(t["source"], 0.0) for n, t in zip(blocks, totals)]
        parts = shares(wanted, resolution)
        common = math.gcd(*parts)
        parts, total = [p // common for p in parts], resolution // common
        length = max(-(-n * total // p) for n, p in zip(blocks, parts, strict=True))
        if min(length, total) <= max_slots:
            break
        if max(blocks) == 1:
            raise ValueError(f"a weight is so small that its source's one block needs {length} slots, more than {max_slots}")
        block_bytes *= -(-length // max_slots)
    found = slots(parts, min(length, total))
    whole, rest = divmod(length, total)
    placed = [whole * p + int(np.searchsorted(own, rest)) if whole else len(own) for p, own in zip(parts, found, strict=True)]
    sources = spark.createDataFrame(
        [(i, t["source"], p, n, m) for i, (t, p, n, m) in enumerate(zip(totals, parts, blocks, placed, strict=True))],
        "__own int, __source string, __share long, __blocks long, __placed long",
    )
    plan = spark.createDataFrame(
        [(i, k // PART, own[k : k + PART].tolist()) for i, own in enumerate(found) for k in range(0, len(own), PART)],
        "__index int, __part long, __slots array<int>",
    )

    order = F.xxhash64(F.col(id_col), F.lit("mix"))
    buckets = bucket_count(sum(t["rows"] for t in totals))
    rows = rows.withColumn("__order", order).withColumn("__bucket", F.pmod("__order", F.lit(buckets)).cast("int"))
    rows = ranked(rows, [source_col], "__bucket", [F.col("__order"), F.col(id_col), F.col("size")], "offset", F.col("size"))
    # One row a source here, MAX_SLOTS numbers at most below.
    rows = rows.join(F.broadcast(sources), F.col(source_col).eqNullSafe(F.col("__source")))
    rows = rows.withColumn("__first", F.floor(F.col("offset") / F.lit(block_bytes)).cast("long"))
    last = F.floor((F.col("__placed") - 1 - F.col("__first")) / F.col("__blocks")).cast("long")
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    rows = rows.withColumn("block", F.col("__first") + F.col("epoch") * F.col("__blocks"))
    # Whole numbers only: a quotient of longs would be a double.
    turn = F.expr(f"block % __share div {PART}")
    rows = rows.join(F.broadcast(plan), (F.col("__own") == F.col("__index")) & (turn == F.col("__part")))
    return rows.select(
        *[F.col(f"`{c}`") for c in kept],
        "size",
        "offset",
        "epoch",
        "block",
        F.expr(f"block * {total}L div __share").alias("release"),
        F.expr(f"((block + 1) * {total}L + __share - 1) div __share").alias("deadline"),
        F.expr(f"block div __share * {total}L + __slots[int(block % __share % {PART})]").alias("position"),
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` in the order of the mix: range-partitioned and sorted by position, so that written files hold that order."""
    rows = docs.select(
        F.struct("*").alias("__row"), size_of(F.col(text_col)).alias("__size"), F.col(id_col).alias("__id"), F.col(source_col).alias("__src")
    )
    rows = schedule(rows, F.col("__size"), id_col="__id", source_col="__src", **options)
    order = ["position", "offset"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("__row.*")
