"""SimHash near duplicates by the generalised pigeonhole principle.

Fingerprints. Words are what stands between white space after A-Z became a-z; a shingle is ``SHINGLE`` words joined by a
space, repeats included; a bit of the fingerprint is 1 if it is set in over half of the shingles' XXH64 hashes (seed 42).

Links: fingerprints that differ in at most ``MAX_BITS`` bits. Documents with one fingerprint are one node.

1. Bits that are correlated over all fingerprints are put into one partition, so that the partitions are as independent as
   the data allow.
2. If the thresholds t_i of the partitions satisfy sum(t_i + 1) = MAX_BITS + 1, two linked fingerprints differ in at most
   t_i bits of some partition i (t_i = -1: it is not looked at). A dynamic program gives each partition its threshold so
   that the estimated work is least; the estimate for t = 0 is the exact count of pairs that agree in the partition, over all
   fingerprints, and grows with t as the bits' frequencies say. The number of partitions is chosen by the same estimate.
3. Probe and verify. Every fingerprint is indexed under its bits in each used partition, and probes all values that differ
   from these in at most t_i bits. A bucket is the fingerprints that meet under one value; whole distances are compared in
   it, and it returns a spanning forest of its links rather than all pairs: the components are the same, and the rows stay
   fewer than the probes. Buckets of more than BUCKET fingerprints are first cut by the same principle over the bits
   left, again and again; nothing is capped.
4. Components over these links by star operations on stored tables.

Defined results: missing and empty texts, and texts of white space, have fingerprint zero and link like any other; fewer
words than a shingle are one shingle; repeated rows each get a row; a missing identifier is larger than any other (a component
of such rows only has none); an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.components import components
from marketloom.session import durable

BITS, SHINGLE, MAX_BITS = 64, 3, 3
SEED = 42
#: Fingerprints that are compared with each other in one task.
BUCKET = 20_000
_STEP = 1 << 16
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, as an unsigned number."""
    from xxhash import xxh64_intdigest

    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return 0
    size = min(shingle, len(found))
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    total, counts = len(found) - size + 1, np.zeros(BITS, np.int64)
    for at in range(0, total, _STEP):
        till = min(at + _STEP, total)
        cuts = zip(starts[at:till].tolist(), ends[at + size - 1 : till + size - 1].tolist(), strict=True)
        hashes = np.fromiter((xxh64_intdigest(joined[s:e], SEED) for s, e in cuts), np.uint64, till - at)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << int(j) for j in np.flatnonzero(2 * counts > total))


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of each text as a (signed) long."""

    # Arrow arrays are read text by text: a batch is not copied into Python objects as a whole.
    @F.arrow_udf("long")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(np.array([simhash(t.as_py(), shingle) for t in batch], np.uint64).view(np.int64))

    return of(text)


# Partitions and thresholds


def co_occurrence(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and the 64 x 64 counts of bits that are set together."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            bits = _bits(batch["fp"].to_numpy()).astype(np.float32)
            total += bits.T @ bits
        yield pd.DataFrame({"cell": np.arange(BITS * BITS), "n": total.ravel().astype(np.int64)})

    cells = prints.select("fp").mapInPandas(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(BITS * BITS)
    for row in cells.collect():  # 4096 rows, however many fingerprints
        counts[row["cell"]] = row["n"]
    return prints.count(), counts.reshape(BITS, BITS)


def _bits(prints: np.ndarray) -> np.ndarray:
    return np.unpackbits(prints.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlated_parts(n: int, counts: np.ndarray, parts: int) -> list[list[int]]:
    """``parts`` groups of bits of equal size (one more at most), each grown by the bit most correlated with it."""
    p = np.diag(counts) / max(n, 1)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    corr = np.abs(np.divide(counts / max(n, 1) - np.outer(p, p), spread, out=np.zeros_like(counts), where=spread > 0))
    np.fill_diagonal(corr, 0)
    left, out = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        order = sorted(left)
        first = max(order, key=lambda i: (corr[i, order].sum(), -i))
        part = [first]
        left.remove(first)
        while len(part) < size:
            best = max(sorted(left), key=lambda i: (corr[i, part].mean(), -i))
            part.append(best)
            left.remove(best)
        out.append(sorted(part))
    return out


def _distance_shares(agree: np.ndarray, most: int) -> np.ndarray:
    """P(two fingerprints differ in at most t of these bits) for t = 0..most, bits taken as independent."""
    exact = np.zeros(most + 1)
    exact[0] = 1.0
    for a in agree:
        exact = exact * a + np.concatenate(([0.0], exact[:-1])) * (1 - a)
    return np.cumsum(exact)


def allocate(work: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = budget and the least total work; ``work[i][t + 1]``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for costs in work:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for spent in range(budget - used + 1):
                now = (cost + costs[spent], [*chosen, spent - 1])
                if used + spent not in nxt or now[0] < nxt[used + spent][0]:
                    nxt[used + spent] = now
        best = nxt
    return best[budget]


def plan_parts(prints: DataFrame, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """The partitions to probe, with their thresholds."""
    n, counts = co_occurrence(prints)
    p = np.diag(counts) / max(n, 1)
    agree = p * p + (1 - p) * (1 - p)
    options = {m: correlated_parts(n, counts, m) for m in (2, 3, 4)}
    flat = [(m, i, part) for m, parts in options.items() for i, part in enumerate(parts)]
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(_mask(part)))).alias("v")) for k, (_, _, part) in enumerate(flat)])
    same = prints.select(F.explode(keys).alias("x")).groupBy("x.k", "x.v").agg(F.count(F.lit(1)).alias("c"))
    same = {r["k"]: float(r["s"]) for r in same.groupBy("k").agg(F.sum(F.col("c").cast("double") * F.col("c")).alias("s")).collect()}
    found = []
    for m, parts in options.items():
        work = []
        for k, (mm, _, part) in enumerate(flat):
            if mm != m:
                continue
            shares = _distance_shares(agree[part], max_bits)
            probes = np.cumsum([math.comb(len(part), t) for t in range(max_bits + 1)])
            pairs = same.get(k, 0.0) * shares / max(shares[0], 1e-300)
            work.append([0.0, *(n * probes * 4 + np.minimum(pairs, float(n) * n)).tolist()])
        cost, chosen = allocate(work, max_bits + 1)
        found.append((cost, m, [(part, t) for part, t in zip(parts, chosen, strict=True) if t >= 0]))
    return min(found, key=lambda x: (x[0], x[1]))[2]


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


# Probe and verify


def _entry(k: int, value: Column):
    return lambda f: F.struct(F.lit(k).alias("part"), value.bitwiseXOR(f).alias("value"), (f == 0).alias("home"))


def _probes(plan: list[tuple[list[int], int]]) -> Column:
    """(part, value, index) entries of one fingerprint: under its own value as index entry, under all near values as probe."""
    out = []
    for k, (part, t) in enumerate(plan):
        flips = [_signed(_mask(list(c))) for d in range(t + 1) for c in itertools.combinations(part, d)]
        value = F.col("fp").bitwiseAND(F.lit(_signed(_mask(part))))
        flips = F.from_json(F.lit(str(flips)), "array<bigint>") if len(flips) > 1 else F.array(F.lit(0).cast("bigint"))
        out.append(F.transform(flips, _entry(k, value)))
    return F.concat(*out) if len(out) > 1 else out[0]


def _forest(prints: np.ndarray, home: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest over the pairs (home, any) at most ``max_bits`` apart."""
    root = np.arange(len(prints))
    links = []
    for i in np.flatnonzero(home):
        near = np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= max_bits)
        for r in np.unique(root[near]):
            if r != root[i]:
                j = near[root[near] == r][0]
                links.append((int(i), int(j)))
                root[root == r] = root[i]
    return links


def _bucket_links(max_bits: int):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Buckets arrive sorted, one after the other; a bucket may span batches."""
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = held["bucket"].iloc[-1]
            done = held["bucket"] != last
            if done.any():
                yield _links(held[done], max_bits)
                held = held[~done].reset_index(drop=True)
        if held is not None:
            yield _links(held, max_bits)

    return of


def _links(rows: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    prints, home = rows["fp"].to_numpy(), rows["home"].to_numpy()
    edges = np.flatnonzero(np.diff(rows["bucket"].to_numpy()) != 0) + 1
    a, b = [], []
    for lo, hi in zip(np.concatenate(([0], edges)), np.concatenate((edges, [len(rows)])), strict=True):
        part, own = prints[lo:hi].view(np.uint64), home[lo:hi]
        if hi - lo < 2 or not own.any():
            continue
        for i, j in _forest(part, own, max_bits):
            a.append(prints[lo + i])
            b.append(prints[lo + j])
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def links(prints: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` whose components are those of all links."""
    prints = durable(prints.select("fp").distinct(), "fingerprints")
    if prints.isEmpty():
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    plan = plan_parts(prints, max_bits)
    probes = prints.select("fp", F.explode(_probes(plan)).alias("p")).select("fp", "p.*")
    probes = probes.select("fp", "home", F.xxhash64("part", "value").alias("bucket"), F.lit(0).alias("depth"))
    # Only buckets with an index entry and one more entry can hold a link; the rest is most of the probes.
    sizes = probes.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("any_home"))
    sizes = sizes.where("n > 1 and any_home").select("bucket", "n")
    todo = durable(probes.join(sizes, "bucket"), "buckets")
    out = None
    depth = 0
    while True:
        small = todo.where(F.col("n") <= bucket).select("bucket", "fp", "home")
        found = small.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(_bucket_links(max_bits), "a long, b long")
        found = durable(found.distinct(), "links")
        out = found if out is None else out.unionByName(found)
        big = todo.where(F.col("n") > bucket)
        if big.isEmpty():
            return out.distinct()
        depth += 1
        todo = durable(_cut(big, max_bits, depth), "buckets")


def _cut(big: DataFrame, max_bits: int, depth: int) -> DataFrame:
    """Large buckets cut once more: two linked fingerprints agree on one of max_bits + 1 more parts of the bits.

    The parts are dealt anew at every depth (bits in a hashed order), and a part is added to what a bucket agrees on, so the
    buckets shrink until a bucket's fingerprints are few; they are distinct, so they can't agree on all bits.
    """
    order = np.random.default_rng(depth).permutation(BITS)
    parts = [_signed(_mask([int(b) for b in order[k :: max_bits + 1]])) for k in range(max_bits + 1)]
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for k, m in enumerate(parts)])
    cut = big.select("fp", "home", "bucket", F.explode(keys).alias("x"))
    cut = cut.select("fp", "home", F.xxhash64("bucket", "x.k", "x.v").alias("bucket"))
    sizes = cut.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("any_home"))
    return cut.join(sizes.where("n > 1 and any_home").select("bucket", "n"), "bucket")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per input row: (id, fp, root, component): the fingerprint as a long, its component's smallest fingerprint, and the
    smallest identifier reachable."""
    rows = docs.select(F.col(id_col).alias("id"), fingerprints(F.col(text_col), shingle).alias("fp"))
    rows = durable(rows, "simhash")
    nodes = durable(rows.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    found = components(links(nodes, max_bits))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = durable(rooted.select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return rows.join(rooted.join(least, "root").select("fp", "root", "component"), "fp").select("id", "fp", "root", "component")
