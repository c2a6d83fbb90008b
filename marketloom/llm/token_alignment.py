"""How two tokenizers cut the same texts: groups of tokens that end together, and how firmly token pairs belong together.

Each text is encoded by a byte-level file (A, with a space put before the text) and a piece model (B, which adds that space itself).
Both give the byte offsets where their tokens end. The shorter of the two lists drives a galloping intersection: for each of its
ends, steps that double and then a binary search find the place in the longer list. Offsets in both lists cut the text into groups;
their ranks in the lists give each group's tokens on either side, and a group's last tokens are the pair that it links.

Links are counted over all texts: tasks add their pairs up before the shuffle, so a pair that every text holds costs one row for
each task. For each text the counts of its links are then looked up. Counts of frequent pairs, at most ``FREQUENT`` of them however
large the table, are broadcast; a text's other pairs are joined to their counts by pair. Both give the same result.

Tokens that Python holds at once are those of one text and of ``TOKENS`` more.

Defined results: a missing or empty text, and one whose tokens on either side do not spell the space and the text (a text with U+2581,
for example), has no tokens: zeros and an empty digest. Special strings inside texts are plain text. Repeated rows each count and
each get a row; missing identifiers stay missing; an empty table gives no rows; only the two named columns are read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.llm.common import unsafe
from marketloom.session import durable

#: Pairs whose counts are broadcast: 24 bytes each.
FREQUENT = 1 << 19
TOKENS = 1 << 19
_B_BITS = 24
_NONE = np.empty(0, np.int64)
#: Numbers of the shorter list that go into the longer one together.
BLOCK = 256
#: Fixed value: the pattern by which byte-level files cut words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the numbers that two increasing lists share, in the first list and in the second.

    The shorter list goes into the longer one in blocks: the block's last number gallops on from where the block before ended, by
    steps that double and a binary search between the last two, and the block's numbers are then searched in what it passed.
    """
    if len(a) > len(b):
        places = common_ends(b, a)
        return places[1], places[0]
    here, there = [_NONE], [_NONE]
    at, n = 0, len(b)
    for start in range(0, len(a), BLOCK):
        block = a[start : start + BLOCK]
        last, low, step = block[-1], at, BLOCK
        while low + step < n and b[low + step] < last:
            low += step
            step += step
        end = min(low + step + 1, n)
        end = low + int(b[low:end].searchsorted(last, "right"))
        passed = b[at:end]
        if len(passed):
            place = passed.searchsorted(block)
            place[place == len(passed)] = 0
            same = np.flatnonzero(passed[place] == block)
            here.append(same + start)
            there.append(place[same] + at)
        at = end
    return np.concatenate(here), np.concatenate(there)


class Aligner:
    def __init__(self, spec: str, model: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(spec)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=model)
        data = json.loads(spec)
        # Byte-level form: the printable bytes stand for themselves, the others for the characters from 256 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte = {chr(b): b for b in plain}
        byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in byte.values())}
        vocab = data["model"]["vocab"]
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(byte[c] for c in token)
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode("utf-8")
            for i, piece in enumerate(self.b.id_to_piece(list(range(self.b.get_piece_size()))))
        ]
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        # Every token's digits with each of the marks that may follow them; a group is written `a,a|b,b;`.
        n, m = len(self.a_bytes), len(self.b_bytes)
        self.marked = [f"{i}{mark}" for size, marks in ((n, ",|"), (m, ",;")) for mark in marks for i in range(size)]
        self.places = (0, n, 2 * n, 2 * n + m)
        self.quick = self._quick(data)

    def _quick(self, data: dict):
        """The same merges in a faster library, or None if the file is not of the kind that both read alike.

        There a token's identifier is its rank; so the file's identifiers must be bytes first and then its merges in their order,
        each making a token of its own.
        """
        import tiktoken

        cut, model = data.get("pre_tokenizer") or {}, data["model"]
        ranked = [model["vocab"]["".join(pair.split(" ") if isinstance(pair, str) else pair)] for pair in model["merges"]]
        kind = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
        options = ("continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "dropout")
        alike = kind and not data.get("normalizer") and not any(model.get(x) for x in options)
        if not alike or ranked != list(range(256, 256 + len(ranked))) or any(len(x) != 1 for x in self.a_bytes[:256]):
            return None
        ranks = {x: i for i, x in enumerate(self.a_bytes[: 256 + len(ranked)])}
        return tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode_a(self, text: str) -> np.ndarray:
        """Identifiers of the space and the text. Only texts whose characters every version of Unicode sorts alike are encoded by
        the faster library."""
        if self.quick and not unsafe(text):
            return self.quick.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64)
        return np.array(self.a.encode(" " + text, add_special_tokens=False).ids, np.int64)

    def spells(self, a: np.ndarray, raw: bytes) -> bool:
        if self.quick:
            # Merges keep all bytes, and every byte has a token of its own.
            return int(self.a_sizes[a].sum()) == len(raw)
        return b"".join(map(self.a_bytes.__getitem__, a.tolist())) == raw

    def align(self, text: str | None) -> tuple[np.ndarray, ...]:
        """Identifiers of both sides, and the places of the tokens that end together; empty if a side does not spell the text."""
        if not text:
            return (_NONE,) * 4
        raw = b" " + text.encode("utf-8")
        a, pieces = self.encode_a(text), self.b.encode(text)
        if not self.spells(a, raw) or b"".join(map(self.b_bytes.__getitem__, pieces)) != raw:
            return (_NONE,) * 4
        b = np.array(pieces, np.int64)
        return a, b, *common_ends(self.a_sizes[a].cumsum(), self.b_sizes[b].cumsum())

    def written(self, a: np.ndarray, b: np.ndarray, here: np.ndarray, there: np.ndarray) -> str:
        """The groups as text: identifiers of A, a bar, identifiers of B, groups parted by semicolons."""
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[here], last_b[there] = 1, 1
        # A token of A stands behind the tokens of B of all groups before its own, one of B behind those of A of its own too.
        group_a = np.concatenate(([0], np.cumsum(last_a)[:-1]))
        group_b = np.concatenate(([0], np.cumsum(last_b)[:-1]))
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.concatenate(([0], there + 1))[group_a]] = a + np.array(self.places[:2])[last_a]
        order[np.arange(len(b)) + (here + 1)[group_b]] = b + np.array(self.places[2:])[last_b]
        return "".join(map(self.marked.__getitem__, order.tolist()))[:-1]


@lru_cache(maxsize=2)
def _aligner(spec: str, model: bytes) -> Aligner:
    """One for each worker process and pair of files."""
    return Aligner(spec, model)


def _encoder(shared, width: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*shared.value)
        names = ["row", "id", "n_a", "n_b", "n_groups", "groups_sha256", "links"]
        for batch in batches:
            first, held = 0, 0
            rows: list[tuple] = []
            for k, value in enumerate(batch.column("text")):
                a, b, here, there = aligner.align(value.as_py())
                digest = hashlib.sha256(aligner.written(a, b, here, there).encode()).hexdigest() if len(here) else ""
                links = np.concatenate([a[here], b[there]]).astype(width).tobytes()
                rows.append((len(a), len(b), len(here), digest, links))
                held += len(a) + len(b)
                if held >= TOKENS or k + 1 == batch.num_rows:
                    n_a, n_b, n_groups, digests, packed = zip(*rows)
                    own = [batch.column(c).slice(first, len(rows)) for c in ("row", "id")]
                    counts = [pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups)]
                    strings = [pa.array(digests, pa.string()), pa.array(packed, pa.binary())]
                    yield pa.RecordBatch.from_arrays([*own, *counts, *strings], names)
                    first, held, rows = k + 1, 0, []

    return of


def _pair(links: pa.Scalar, width: str) -> np.ndarray:
    """One number for each link of a row: A's identifier, then B's in the low bits."""
    both = np.frombuffer(links.as_buffer(), width).astype(np.int64)
    n = len(both) // 2
    return both[:n] << _B_BITS | both[n:]


def _parts(batch: pa.RecordBatch, width: str) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Rows of a batch a few at a time, of about ``TOKENS`` links together: (first row, pairs of each)."""
    first, held, rows = 0, 0, []
    for k, links in enumerate(batch.column("links")):
        rows.append(_pair(links, width))
        held += len(rows[-1])
        if held >= TOKENS or k + 1 == batch.num_rows:
            yield first, rows
            first, held, rows = k + 1, 0, []


def _count_pairs(width: str):
    """(pair, n): links of one task, added up over about ``4 * TOKENS`` links at a time."""

    def rows(parts: list[np.ndarray]) -> pa.RecordBatch:
        pair, n = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], ["pair", "n"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for _, part in _parts(batch, width):
                held += part
                size += sum(map(len, part))
                if size >= 4 * TOKENS:
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)

    return of


def pair_counts(encoded: DataFrame, width: str) -> DataFrame:
    """(pair, n, best): how many links hold each pair, and whether no other pair of the same B token is held more often."""
    found = encoded.select("links").mapInArrow(_count_pairs(width), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = durable(found, "pairs")
    b = F.col("pair").bitwiseAND((1 << _B_BITS) - 1)
    # One row for each B token of the vocabulary.
    most = durable(found.groupBy(b.alias("b")).agg(F.max("n").alias("most")), "most")
    return found.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _frequent(counts: DataFrame, most: int) -> int:
    """The smallest power of two such that at most ``most`` pairs are held that often."""
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("pairs")).collect()
    total, least = 0, 64
    for row in sorted(sizes, key=lambda r: -r["k"]):  # at most 63 rows
        total += row["pairs"]
        if total > most:
            break
        least = row["k"]
    return 1 << min(least, 62)


def _look_up(shared, width: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = shared.value
        for batch in batches:
            for first, rows in _parts(batch, width):
                links = np.concatenate(rows)
                row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
                place = np.searchsorted(pairs, links)
                place[place == len(pairs)] = 0
                known = pairs[place] == links if len(pairs) else np.zeros(len(links), bool)
                total, firm = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
                np.add.at(total, row[known], counts[place[known]])
                np.add.at(firm, row[known], best[place[known]].astype(np.int64))
                # A text's other pairs, each with its number of links.
                other, n = np.unique(np.stack([row[~known], links[~known]]), axis=1, return_counts=True)
                starts = np.searchsorted(other[0], np.arange(len(rows) + 1)).astype(np.int32)
                value = pa.StructArray.from_arrays([pa.array(other[1]), pa.array(n.astype(np.int64))], ["pair", "links"])
                rest = pa.ListArray.from_arrays(pa.array(starts), value)
                own = batch.column("row").slice(first, len(rows))
                yield pa.RecordBatch.from_arrays([own, pa.array(firm), pa.array(total), rest], ["row", "n_best", "count_sum", "rest"])

    return of


def link_counts(encoded: DataFrame, counts: DataFrame, width: str, frequent: int = FREQUENT) -> DataFrame:
    """(row, n_best, count_sum) for every row of ``encoded``."""
    least = _frequent(counts, frequent)
    # At most ``frequent`` rows.
    top = counts.where(F.col("n") >= least).orderBy("pair").toArrow()
    held = tuple(top.column(c).to_numpy() for c in ("pair", "n", "best"))
    shared = encoded.sparkSession.sparkContext.broadcast(held)
    schema = "row long, n_best long, count_sum long, rest array<struct<pair: long, links: long>>"
    found = durable(encoded.select("row", "links").mapInArrow(_look_up(shared, width), schema), "links")
    rest = found.select("row", F.inline("rest")).join(counts.where(F.col("n") < least), "pair")
    rest = rest.groupBy(F.col("row").alias("__row")).agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("__best"), F.sum(F.col("links") * F.col("n")).alias("__sum")
    )
    joined = found.join(rest, F.col("row") == F.col("__row"), "left")
    both = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
    return joined.select("row", both("n_best", "__best"), both("count_sum", "__sum"))


def aligned(
    docs: DataFrame, path_a: str, path_b: str, frequent: int = FREQUENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, links) for every row of ``docs``.

    ``links`` holds the identifiers of the linked A tokens and then those of the B tokens, in little-endian numbers of 2 bytes each
    (4, if a vocabulary needs more). The files are read by the driver and sent to the tasks.
    """
    spark = docs.sparkSession
    with open(path_a, encoding="utf-8") as f, open(path_b, "rb") as g:
        spec, model = f.read(), g.read()
    aligner = _aligner(spec, model)
    width = "<u2" if max(len(aligner.a_bytes), len(aligner.b_bytes)) <= 1 << 16 else "<u4"
    shared = spark.sparkContext.broadcast((spec, model))  # vocabularies: their size does not depend on the table
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["row"], rows.schema["id"]])
    for name, kind in (("n_a", "long"), ("n_b", "long"), ("n_groups", "long"), ("groups_sha256", "string"), ("links", "binary")):
        schema = schema.add(name, kind)
    encoded = durable(rows.mapInArrow(_encoder(shared, width), schema), "aligned")
    counts = durable(pair_counts(encoded, width), "pair-counts")
    links = link_counts(encoded, counts, width, frequent).withColumnRenamed("row", "__row")
    found = encoded.join(links, F.col("row") == F.col("__row"))
    # Tokens are never empty, so one token of either side ends at each common offset: a group has one link.
    return found.select(
        "id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256", "links"
    )
