"""Balanced label propagation: linked documents move to the shard where most of their neighbours are, under quotas.

Documents are linked by a key, here their whole text: all documents with one key are neighbours of each other. The links of
a key are never written out as pairs; a key is a node between its documents, and each step joins documents with their keys.

1. Every linked document starts in a shard given by its hash. The documents of a key that start in the same shard (and, for
   a key with very many documents, the same chunk) have the same neighbours and always move together: they are one unit.
2. In each round a key looks at how many of its documents each shard holds and names the fullest one that has room. Units
   elsewhere ask to move there if it holds more of their neighbours than their own shard does (ties go by a hash, so that two
   documents don't keep swapping). A shard admits requests in a hashed order while its quota lasts; nothing else moves. The
   rounds end when no request is admitted, or when STALL rounds in a row have not raised the number of linked pairs that share a shard;
   the placement with the most is kept. That number only grows between these, so the rounds end by themselves.
3. Documents without links have no preference. They fill what the quotas leave.

The law is ``rows``: the quota of a shard is its exact number of rows, so sizes differ by one at most, whatever the groups
are. A group larger than a quota is spread over as few shards as have room.

Defined results: a missing text has 0 bytes, checksum 0 and the key of the empty text; repeated rows are rows of their own;
an empty table gives no rows; with fewer rows than shards the last shards stay empty; a missing identifier is allowed. Other
columns of the input are not read.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import bucket_count, ranked
from marketloom.session import durable

SHARDS = 24
#: Rounds without a gain that end the propagation.
STALL, SLACK = 3, 0.05
BUCKETS = 512
#: The documents of a key that move together at most (about).
CHUNK_ROWS = 1_000


def documents_by_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, key): the rows to shard; the key is the digest of the whole text."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("key"),
    )


def _units(linked: DataFrame, shards: int) -> DataFrame:
    """Documents with their unit: (key, chunk, origin)."""
    return linked.withColumn(
        "chunk", F.pmod(F.xxhash64("row", F.lit("chunk")), F.ceil(F.col("n_key") / CHUNK_ROWS).cast("long")).cast("int")
    ).withColumn("origin", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))


def _tie(shard: Column) -> Column:
    return F.xxhash64("key", shard)


def _grants(asked: list[tuple[int, int, int]], room: list[int]) -> list[tuple[int, int, int]]:
    """(from, to, rows) that may move, for the rows that ask to (shards x shards numbers): swaps first, then into free room,
    which a move frees up in turn where it comes from."""
    want = {(a, b): n for a, b, n in asked}
    given = {(a, b): min(n, want.get((b, a), 0)) for (a, b), n in want.items()}
    room = list(room)
    while True:
        moved = 0
        for (a, b), n in sorted(want.items()):
            more = min(n - given[a, b], room[b])
            if more > 0:
                given[a, b] += more
                room[b] -= more
                if a >= 0:
                    room[a] += more
                moved += more
        if not moved:
            return [(a, b, n) for (a, b), n in given.items() if n]


def propagate(units: DataFrame, quotas: list[int], rounds: int | None = None) -> DataFrame:
    """``units`` (key, chunk, origin, n) with the column ``shard``; -1 is no shard yet. ``rounds`` may end it earlier.

    A shard may hold SLACK more than its quota meanwhile, which keeps moves possible when nearly everything is linked; what is
    above the quota in the end is dealt out with the documents that have no links.
    """
    shards = F.array(*[F.lit(i) for i in range(len(quotas))])
    # The first placement may exceed a quota only if nearly everything is linked: such units wait.
    state = _admit(units.withColumn("shard", F.lit(-1)).withColumn("target", F.col("origin")), quotas)
    swaps, best_state, most, stalled = False, state, _together(state), 0
    for number in itertools.count() if rounds is None else range(rounds):
        held = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # a row a shard
        room = [max(0, math.ceil(q * (1 + SLACK)) - held.get(i, 0)) for i, q in enumerate(quotas)]
        votes = state.groupBy("key", "shard").agg(F.sum("n").alias("votes"))
        # Once open shards draw no more, a round asks for full ones too, where only a swap can help.
        open_shards = [i for i, q in enumerate(quotas) if swaps or held.get(i, 0) < q]
        free = F.array_contains(F.array(*[F.lit(i) for i in open_shards]).cast("array<int>"), F.col("shard"))
        named = F.struct(F.col("votes"), _tie(F.col("shard")).alias("tie"), F.col("shard").alias("target"))
        best = votes.groupBy("key").agg(F.max(F.when(free, named)).alias("best"))
        here = votes.select("key", "shard", F.col("votes").alias("here"))
        asked = state.join(here, ["key", "shard"]).join(best, "key")
        better = (F.col("best.votes") > F.col("here")) | (
            (F.col("best.votes") == F.col("here")) & (F.col("best.tie") > _tie(F.col("shard")))
        )
        # A unit without a shard whose key has no open one asks for the next shard in a hashed order.
        anywhere = F.element_at(shards, (F.pmod(F.xxhash64("key", "chunk", F.lit(number)), F.lit(len(quotas))) + 1).cast("int"))
        target = F.when(F.col("shard") < 0, F.coalesce("best.target", anywhere)).when(better, F.col("best.target"))
        asked = asked.withColumn("target", F.when(target != F.col("shard"), target)).drop("best", "here")
        state = _admit(asked, room)
        idle = state.where("moved").isEmpty()
        if idle and (swaps or len(open_shards) == len(quotas)):
            break
        swaps, together = idle, _together(state)
        stalled += 1
        if together > most:
            best_state, most, stalled = state, together, 0
        elif stalled == STALL:
            break
    return best_state


def _together(state: DataFrame) -> int:
    """Ordered pairs of linked documents (each with itself too) that share a shard."""
    held = state.where("shard >= 0").groupBy("key", "shard").agg(F.sum("n").cast("decimal(19,0)").alias("n"))
    return int(held.agg(F.sum(F.col("n") * F.col("n")).alias("n")).first()["n"] or 0)


def _admit(asked: DataFrame, room: list[int]) -> DataFrame:
    """Moves units to their ``target`` in a hashed order of keys, as far as the shards' room and swaps allow; a stored table."""
    spark = asked.sparkSession
    asked = durable(asked.drop("moved").withColumn("bucket", F.pmod(F.xxhash64("key", "chunk"), F.lit(BUCKETS)).cast("int")), "asked")
    moves = asked.where(F.col("target").isNotNull())
    wanted = moves.groupBy("shard", "target").agg(F.sum("n").alias("n")).collect()  # shards x shards rows at most
    grants = spark.createDataFrame(_grants([tuple(r) for r in wanted], room), "shard int, target int, grant long")
    pair = ["shard", "target"]
    sums = moves.groupBy(*pair, "bucket").agg(F.sum("n").alias("sum"))
    along = Window.partitionBy(*pair).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("sum").over(along), F.lit(0))).drop("sum").join(grants, pair)
    inside = Window.partitionBy(*pair, "bucket").orderBy("key", "chunk", "origin")
    run = F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    # shards x shards x BUCKETS rows at most, and no more than there are requests.
    taken = moves.withColumn("run", run).join(sums, [*pair, "bucket"], "left")
    fits = F.coalesce(F.col("before") + F.col("run") <= F.col("grant"), F.lit(False))
    settled = taken.withColumn("shard", F.when(fits, F.col("target")).otherwise(F.col("shard"))).withColumn("moved", fits)
    columns = ["key", "chunk", "origin", "n", "shard", "moved"]
    stay = asked.where(F.col("target").isNull()).withColumn("moved", F.lit(False))
    return durable(settled.select(columns).unionByName(stay.select(columns)), "units")


def shard_documents(rows: DataFrame, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """``rows`` (id, size, text_crc32, key) with ``law``, ``shard`` and ``slot`` (gapless from 0 within a shard)."""
    rows = durable(rows.withColumn("row", F.monotonically_increasing_id()), "rows")  # numbers are stored, so they stay
    total = rows.count()
    quotas = [total // shards + (i < total % shards) for i in range(shards)]
    groups = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n_key")).where("n_key > 1")
    marked = durable(rows.join(groups, "key", "left"), "marked")
    linked, single = marked.where("n_key is not null"), marked.where("n_key is null")

    members = _units(linked, shards)
    units = members.groupBy("key", "chunk", "origin").agg(F.count(F.lit(1)).alias("n"))
    placed = propagate(units, quotas, rounds)
    homes = placed.where("shard >= 0").select("key", "chunk", "origin", "shard")
    homed = durable(members.join(homes, ["key", "chunk", "origin"], "left"), "homed")

    # Documents without links, and the few linked ones that found no room, fill the shards up.
    buckets = bucket_count(total)
    bucket = F.pmod(F.xxhash64("key", "chunk"), F.lit(buckets)).cast("int")
    names = ["id", "size", "text_crc32", "key", "row"]
    settled = homed.where("shard is not null").select(*names, "shard", bucket.alias("bucket"))
    settled = durable(ranked(settled, ["shard"], "bucket", [F.col("key"), F.col("row")], "slot"), "settled")
    quota = F.element_at(F.array(*[F.lit(q) for q in quotas]), F.col("shard") + 1)
    rest = single.select(names).unionByName(homed.where("shard is null").select(names))
    rest = rest.unionByName(settled.where(F.col("slot") >= quota).select(names))
    settled = settled.where(F.col("slot") < quota)
    held = {r["shard"]: r["n"] for r in settled.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a shard
    rest = rest.withColumn("bucket", F.pmod(F.xxhash64("row", F.lit("fill")), F.lit(buckets)).cast("int"))
    rest = ranked(rest, [], "bucket", [F.col("row")], "place")
    first, place, slot = 0, F.col("place"), None
    shard = None
    for i, quota in enumerate(quotas):
        free = quota - held.get(i, 0)
        here = place < first + free
        shard = F.when(here, F.lit(i)) if shard is None else shard.when(here, F.lit(i))
        at = place - first + held.get(i, 0)
        slot = F.when(here, at) if slot is None else slot.when(here, at)
        first += free
    rest = rest.withColumn("shard", shard).withColumn("slot", slot)
    columns = ["id", "size", "text_crc32", "key", F.lit("rows").alias("law"), F.col("shard").cast("int"), F.col("slot").cast("long")]
    return settled.select(columns).unionByName(rest.select(columns))


def cut_links(placed: DataFrame) -> DataFrame:
    """One row: linked pairs, and how many of them lie in two shards. Pairs are counted, not made."""
    per = placed.groupBy("key", "shard").agg(F.count(F.lit(1)).alias("n"))
    pairs = lambda n: n * (n - 1) / 2
    keys = per.groupBy("key").agg(pairs(F.sum("n")).alias("all"), F.sum(pairs(F.col("n"))).alias("kept"))
    return keys.agg(F.sum("all").cast("long").alias("links"), F.sum(F.col("all") - F.col("kept")).cast("long").alias("cut"))
