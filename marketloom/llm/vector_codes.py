"""Product codes of vectors, each part assigned to its nearest codebook entry through a geometric near-neighbour access tree.

Components become integers ``floor(scale * x)``; vectors are cut into ``parts`` equal consecutive parts, each with a codebook of up
to ``entries`` entries that starts as that part of the smallest identifiers' vectors. A round assigns every part and moves every
used entry to the componentwise floor of its parts' mean.

The tree (GNAT) over a codebook: a node takes a few entries far from one another as split points, gives the others to the nearest of
them, and stores for each split point the range of distances to each child's members. A query measures the split points; a child is
left out as a whole if the ball around the query that holds the nearest entry so far lies strictly outside one of these ranges.
Ranges, radii and distances are rounded outwards, so rounding never leaves out an entry that could win or tie; the entries that are
measured compare by integer squared distance and then by index, so ties are exact. Whole batches go down the tree together.

The codebooks are small (parts x entries) whatever the table's size and live on the driver; a round adds the parts up in the tasks,
which return one row for each entry's component. Sums are exact: they travel in limbs of 40 bits.

Defined results: a row whose vector is missing or holds a missing, NaN or infinite component is dropped. Of the rest, the length of
the smallest identifier's vector holds: a vector of another length, or any vector if that length cannot be cut into equal parts, has
a missing code and error. Rows with a missing identifier come last in the order of identifiers; rows that repeat one are ordered by
their vectors, and every row gets its own result. Fewer rows than entries make smaller codebooks; an empty table gives no rows.
Integers of any size are exact (large ones take a plain scan of the codebook); an error, or a sum over a label, beyond 64 bits is
missing. Only the three named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.session import durable

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
SPLITS = 4  # split points of a node
#: Larger than any rounding error of a converted, rooted and subtracted distance.
_MARGIN = 2.0**-48
_LIMB = 40
_MOST = 2**63 - 1


class Gnat:
    """A node over ``members`` (indexes into ``entries``), which are int64 rows whose squared distances fit 62 bits."""

    def __init__(self, entries: np.ndarray, members: Sequence[int]):
        rows = entries[list(members)]
        # Far from one another: each next split point is the member farthest from those before it.
        chosen = [0]
        near = _squared(rows, rows[0])
        while len(chosen) < min(SPLITS, len(members)) and near.max() > 0:
            chosen.append(int(np.argmax(near)))
            near = np.minimum(near, _squared(rows, rows[chosen[-1]]))
        self.splits = [members[c] for c in chosen]
        self.points = rows[chosen]
        apart = np.sqrt(np.array([_squared(rows, p) for p in self.points], np.float64))
        own = np.argmin(apart, axis=0)
        self.children: list[Gnat | None] = []
        self.low = np.zeros((len(chosen), len(chosen)))
        self.high = np.zeros((len(chosen), len(chosen)))
        for j, c in enumerate(chosen):
            inside = [m for m in range(len(members)) if own[m] == j and m not in chosen]
            self.children.append(Gnat(entries, [members[m] for m in inside]) if inside else None)
            if inside:
                self.low[:, j] = apart[:, inside].min(axis=1) * (1 - _MARGIN)
                self.high[:, j] = apart[:, inside].max(axis=1) * (1 + _MARGIN)

    def search(self, queries: np.ndarray, at: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        """Betters ``best`` (squared distances) and ``index`` of the queries ``at`` by the entries of this node."""
        mine = queries[at]
        measured = np.empty((len(self.splits), len(at)))
        for i, (e, point) in enumerate(zip(self.splits, self.points)):
            d = _squared(mine, point)
            old = best[at]
            better = (d < old) | ((d == old) & (e < index[at]))
            best[at[better]], index[at[better]] = d[better], e
            measured[i] = np.sqrt(d.astype(np.float64))
        for j, child in enumerate(self.children):
            if child is None:
                continue
            radius = np.sqrt(best[at].astype(np.float64)) * (1 + _MARGIN)
            too_far = measured * (1 - _MARGIN) - radius > self.high[:, j, None]
            too_near = measured * (1 + _MARGIN) + radius < self.low[:, j, None]
            left = at[~(too_far | too_near).any(axis=0)]
            if len(left):
                child.search(queries, left, best, index)


def _squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    apart = rows - point
    return np.einsum("ij,ij->i", apart, apart)


class Codebook:
    """The entries of one part, as lists of whole numbers."""

    def __init__(self, entries: list[list[int]]):
        self.entries = entries
        self.largest = max((abs(x) for e in entries for x in e), default=0)
        self.tree = Gnat(np.array(entries, np.int64), range(len(entries))) if entries and self.fits(0) else None

    def fits(self, largest: int) -> bool:
        """Whether squared distances to rows with components up to ``largest`` fit 62 bits."""
        return len(self.entries[0]) * (self.largest + largest) ** 2 < 2**62

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry, ties to the lower index; ``rows`` are int64 or Python's numbers."""
        index = np.full(len(rows), len(self.entries), np.int64)
        largest = int(max(abs(int(rows.max())), abs(int(rows.min())))) if rows.size else 0
        if self.tree is not None and self.fits(largest):
            best = np.full(len(rows), np.iinfo(np.int64).max, np.int64)
            self.tree.search(rows.astype(np.int64), np.arange(len(rows)), best, index)
            return index, best
        best = np.empty(len(rows), object)
        for r, row in enumerate(rows):
            found = [sum((int(a) - b) ** 2 for a, b in zip(row, e)) for e in self.entries]
            best[r] = min(found)
            index[r] = found.index(best[r])
        return index, best


def whole_numbers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), exactly, for a matrix of finite floats; of Python's numbers where 62 bits do not do."""
    wide = vectors.astype(np.float64)
    if not wide.size or np.abs(wide).max() < 2.0**62 / scale:
        # A power of two scales a float without rounding.
        return np.floor(wide * scale).astype(np.int64)
    exact = np.empty(wide.shape, object)
    for i, x in enumerate(wide.flat):
        top, bottom = float(x).as_integer_ratio()
        exact.flat[i] = top * scale // bottom
    return exact


def _matrix(column: pa.Array, length: int, scale: int) -> np.ndarray:
    return whole_numbers(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length), scale)


def _limbs(value: int) -> list[int]:
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << _LIMB) - 1)))
        value >>= _LIMB
    return out or [0]


def _sums(books: list[list[list[int]]], length: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds up the parts of each entry in one task; place -1 counts them."""
    width = length // len(books)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelf = [Codebook(b) for b in books]
        total = [[[0] * (width + 1) for _ in b] for b in books]
        for batch in batches:
            rows = _matrix(batch.column(0), length, scale)
            for p, book in enumerate(shelf):
                mine = rows[:, p * width : (p + 1) * width]
                index, _ = book.assign(mine)
                for e in np.unique(index):
                    chosen = mine[index == e]
                    # A batch of int64 rows below 2**62 could overflow only with larger numbers, which add up as Python's.
                    wide = chosen.dtype == object or not chosen.size or np.abs(chosen).max() >= 2**40
                    added = chosen.astype(object).sum(axis=0) if wide else chosen.sum(axis=0)
                    sums = total[p][e]
                    sums[width] += len(chosen)
                    for k in range(width):
                        sums[k] += int(added[k])
        out = [
            (p, e, -1 if k == width else k, i, limb)
            for p, b in enumerate(total)
            for e, sums in enumerate(b)
            if sums[width]
            for k, value in enumerate(sums)
            for i, limb in enumerate(_limbs(value))
        ]
        columns = list(zip(*out)) if out else [[]] * 5
        names = ["part", "entry", "place", "limb", "value"]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names)

    return of


def _moved(books: list[list[list[int]]], rows: list) -> list[list[list[int]]]:
    """The next codebooks from the summed rows (part, entry, place, limb, value)."""
    sums: dict[tuple[int, int], dict[int, int]] = {}
    for r in rows:
        places = sums.setdefault((r["part"], r["entry"]), {})
        places[r["place"]] = places.get(r["place"], 0) + (r["value"] << (_LIMB * r["limb"]))
    return [
        [[sums[p, e][k] // sums[p, e][-1] for k in range(len(entry))] if (p, e) in sums else entry for e, entry in enumerate(book)]
        for p, book in enumerate(books)
    ]


def codebooks(kept: DataFrame, length: int, parts: int, entries: int, rounds: int, scale: int) -> list[list[list[int]]]:
    """Codebooks by part, entry and place, fitted on all rows of ``kept`` (id, vector), vectors of ``length``."""
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    width = length // parts
    start = whole_numbers(np.array([r["vector"] for r in first], np.float64).reshape(len(first), length), scale)
    books = [[[int(x) for x in row[p * width : (p + 1) * width]] for row in start] for p in range(parts)]
    schema = "part long, entry long, place long, limb long, value long"
    for _ in range(rounds):
        sums = kept.select("vector").mapInArrow(_sums(books, length, scale), schema)
        # One row for each component of an entry, however large the table.
        rows = sums.groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value")).collect()
        books = _moved(books, rows)
    return books


def books_digest(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def _coder(books: list[list[list[int]]], length: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    width = length // len(books)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelf = [Codebook(b) for b in books]
        for batch in batches:
            rows = _matrix(batch.column("vector"), length, scale)
            codes = np.empty((batch.num_rows, len(books)), np.int64)
            found = []
            for p, book in enumerate(shelf):
                codes[:, p], apart = book.assign(rows[:, p * width : (p + 1) * width])
                found.append(apart)
            if all(f.dtype == np.int64 and (not f.size or f.max() <= _MOST // len(books)) for f in found):
                errors = pa.array(sum(found))
            else:
                exact = sum(f.astype(object) for f in found)
                errors = pa.array([e if e <= _MOST else None for e in exact], pa.int64())
            digits = codes.astype(np.uint8).tobytes().hex()
            hexes = [digits[i : i + 2 * len(books)] for i in range(0, len(digits), 2 * len(books))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(hexes), errors], ["id", "label", "code", "error"])

    return of


def vector_codes(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) for every row with a whole vector; see the module's docstring."""
    if not 0 < entries <= 256 or scale <= 0 or scale & (scale - 1):
        raise ValueError("codes have two digits for each part, and the scale is a power of two")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    wrong = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = durable(rows.where(F.col("vector").isNotNull() & ~wrong), "vectors")
    smallest = kept.orderBy(F.col("id").asc_nulls_last(), "vector").select(F.size("vector").alias("n")).first()
    length = smallest["n"] if smallest else 0
    usable = F.lit(length % parts == 0) & (F.size("vector") == length)
    same = kept.where(usable)
    books = codebooks(same, length, parts, entries, rounds, scale) if smallest and length % parts == 0 else []
    schema = T.StructType([kept.schema["id"], kept.schema["label"]])
    schema = schema.add("code", T.StringType()).add("error", T.LongType())
    missing = kept.where(~usable).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = missing if not books else same.mapInArrow(_coder(books, length, scale), schema).unionByName(missing)
    coded = durable(coded, "codes")
    # Stored, so that its size decides how it is joined; a hot label is added up in the tasks before the shuffle.
    sums = durable(coded.groupBy("label").agg(F.try_sum("error").alias("label_error")), "label-errors")
    sums = sums.withColumnRenamed("label", "__label")
    found = coded.join(sums, F.col("label").eqNullSafe(F.col("__label")), "left")
    return found.select("id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def oracle(table: str = "embeddings", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same codes in plain SQL, with every distance measured, for tables whose identifiers are unique."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r, len(embedding) // {parts} AS width,
  list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
FROM {table} WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """x AS MATERIALIZED (SELECT r, CAST((place - 1) // width AS BIGINT) AS part, CAST((place - 1) % width AS BIGINT) AS place, v[place] AS x
FROM (SELECT r, v, width, unnest(range(1, len(v) + 1)) AS place FROM kept))""",
        f"c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, place, x FROM x WHERE r <= {entries})",
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""a{k} AS MATERIALIZED (SELECT r, part, min(d * {entries} + entry) AS m FROM (SELECT x.r, x.part, c.entry,
  sum((x.x - c.x) * (x.x - c.x)) AS d FROM x JOIN c{k} c ON c.part = x.part AND c.place = x.place GROUP BY ALL) GROUP BY ALL)"""
        )
        if k < rounds:
            steps.append(
                f"""c{k + 1} AS MATERIALIZED (SELECT c.part, c.entry, c.place,
  CASE WHEN s.n IS NULL THEN c.x ELSE CAST((s.s - ((s.s % s.n) + s.n) % s.n) // s.n AS BIGINT) END AS x
FROM c{k} c LEFT JOIN (SELECT x.part, a.m % {entries} AS entry, x.place, sum(x.x) AS s, count(*) AS n
  FROM x JOIN a{k} a ON a.r = x.r AND a.part = x.part GROUP BY ALL) s ON s.part = c.part AND s.entry = c.entry AND s.place = c.place)"""
            )
    steps.append(
        f"""coded AS (SELECT r, string_agg(printf('%02x', CAST(m % {entries} AS BIGINT)), '' ORDER BY part) AS code,
  CAST(sum(m // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY r)"""
    )
    steps.append(f"books AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) AS digest FROM c{rounds})")
    return f"""WITH {",\n".join(steps)}
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM kept JOIN coded USING (r) CROSS JOIN books"""
