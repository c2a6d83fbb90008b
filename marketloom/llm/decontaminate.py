"""Benchmark decontamination: windows of test words, looked up in a broadcast hash set, verified, and removed.

Words are runs of digits, lower-case letters and characters beyond ASCII, after A-Z became a-z. A window is ``WINDOW``
consecutive words of an item; an item of fewer words, but not none, is one window.

1. The scan. A window of L words that occurs in a document holds one of the document's grams that start at every m-th word
   and are L - m + 1 words long (m = L / 2), wherever it begins. So a fifth of the positions has to be looked up: each
   document is cut into these grams once per window length that the benchmark has, and their hashes are looked up in the
   hash set of all grams inside benchmark windows. The set is broadcast while its counted rows are at most BROADCAST_ROWS;
   beyond that the join shuffles. No window is missed, and a document without a hit holds none.
2. The verification. Documents with a hit are cut into all their windows, which are joined with the benchmark's windows on
   the text itself. Their union gives the hit words.
3. The removal: ``clean_documents`` drops contaminated documents, ``cut_spans`` drops the hit words' spans from their texts.

Defined results: a missing or empty text has no words; an item without words has no window; an item that occurs twice counts
once; repeated documents each get a row; empty tables give no rows, or no hits. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import ascii_lower
from marketloom.session import durable

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Hashes that may be broadcast: 16 bytes each, so 64 MB at most.
BROADCAST_ROWS = 4_000_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _every(n: Column, step: int, size: int) -> Column:
    """Starts (from 0) of the grams of ``size`` words at every ``step``-th word."""
    last = F.floor((n - size) / step).cast("int")
    return F.when(n >= size, F.transform(F.sequence(F.lit(0), last), lambda i: i * step)).otherwise(F.array().cast("array<int>"))


def _slices(starts: Column, size: int) -> Column:
    """The hashes of ``size`` words from each start."""
    return F.transform(starts, lambda i: F.xxhash64(F.slice("words", i + 1, size)))


def _texts(starts: Column, size: int) -> Column:
    def window(i: Column) -> Column:
        text = F.array_join(F.slice("words", i + 1, size), " ")
        return F.struct(i.alias("start"), F.lit(size).alias("length"), text.alias("window"))

    return F.transform(starts, window)


def _gram(length: int) -> tuple[int, int]:
    """(step, size) with size + step - 1 <= length."""
    step = max(1, length // 2)
    return step, length - step + 1


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, length, window): the distinct windows of every item; a window is its words joined by a space."""
    cut = items.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("words"))
    cut = cut.withColumn("n", F.size("words")).where("n > 0").withColumn("length", F.least("n", F.lit(window)))
    starts = F.sequence(F.lit(0), F.col("n") - F.col("length"))
    texts = F.transform(starts, lambda i: F.array_join(F.slice("words", i + 1, F.col("length")), " "))
    return cut.select("item", "length", F.explode(F.array_distinct(texts)).alias("window")).distinct()


def _grams(windows: DataFrame, lengths: list[int]) -> DataFrame:
    """The hashes of all grams inside the windows."""
    split = windows.select("length", F.split("window", " ").alias("words")).withColumn("n", F.size("words"))
    hashes = None
    for length in lengths:
        size = _gram(length)[1]
        own = _slices(_every(F.col("n"), 1, size), size)
        hashes = F.when(F.col("length") == length, own) if hashes is None else hashes.when(F.col("length") == length, own)
    return split.select(F.explode(hashes).alias("gram")).distinct()


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> tuple[DataFrame, DataFrame]:
    """(documents, spans).

    documents: a row per input row with ``doc`` (its id), ``text_hash``, ``n_words``, ``n_hit``, ``n_items``, ``items``
    (sorted as strings). spans: (doc, text_hash, start, end) of the disjoint runs of hit words, counted in words.
    """
    windows = durable(benchmark_windows(items, item_col, item_text, window), "windows")
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # ``window`` rows at most
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))

    cut = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("words", words(F.col("text")))
    n = F.size("words")
    hashes = F.array().cast("array<bigint>")
    for length in lengths:
        step, size = _gram(length)
        hashes = F.concat(hashes, _slices(_every(n, step, size), size))
    looked = cut.select("row", "doc", "text_hash", n.alias("n_words"), hashes.alias("grams"))
    looked = looked.select("row", "doc", "text_hash", "n_words", F.explode_outer("grams").alias("gram"))
    if lengths:
        grams = durable(_grams(windows, lengths), "grams").withColumn("found", F.lit(1))
        bounded = grams.count() <= BROADCAST_ROWS
        looked = looked.join(F.broadcast(grams) if bounded else grams, "gram", "left")
    else:
        looked = looked.withColumn("found", F.lit(None).cast("int"))
    scanned = durable(
        looked.groupBy("row").agg(
            F.first("doc").alias("doc"),
            F.first("text_hash").alias("text_hash"),
            F.first("n_words").alias("n_words"),
            F.max("found").alias("found"),
        ),
        "scanned",
    )

    # Stored, so that its size decides whether the texts are shuffled to look it up.
    suspects = scanned.where("found = 1").select(F.col("doc").alias("__doc"), F.col("text_hash").alias("__hash")).distinct()
    suspects = durable(suspects, "suspects")
    same = F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__hash"))
    again = rows.join(suspects, same, "left_semi")
    again = again.withColumn("words", words(F.col("text"))).withColumn("n", F.size("words"))
    every = F.array().cast("array<struct<start:int,length:int,window:string>>")
    for length in lengths:
        every = F.concat(every, _texts(_every(F.col("n"), 1, length), length))
    every = again.select("doc", "text_hash", F.explode(every).alias("w")).select("doc", "text_hash", "w.*")
    texts = windows.select("length", "window").distinct()
    bounded = windows.count() <= BROADCAST_ROWS // 16
    # Repeated documents have the same hits.
    hits = durable(every.join(F.broadcast(texts) if bounded else texts, ["length", "window"]).distinct(), "hits")

    along = Window.partitionBy("doc", "text_hash").orderBy("start", F.desc("length"))
    reach = F.max(F.col("start") + F.col("length")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    runs = hits.withColumn("reach", reach).withColumn(
        "run", F.sum(F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)).over(along)
    )
    spans = runs.groupBy("doc", "text_hash", "run").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("length")).alias("end")
    )
    spans = spans.drop("run")
    hit = spans.groupBy("doc", "text_hash").agg(F.sum(F.col("end") - F.col("start")).cast("long").alias("n_hit"))
    found = hits.select("doc", "text_hash", "length", "window").distinct().join(windows, ["length", "window"])
    found = found.groupBy("doc", "text_hash").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    hit = hit.withColumnsRenamed({"doc": "__doc", "text_hash": "__hash"})
    found = found.withColumnsRenamed({"doc": "__doc", "text_hash": "__hash"})
    # A missing text has no hash of its own (the seed of the hash), and no hits.
    out = scanned.join(hit, same, "left").drop("__doc", "__hash").join(found, same, "left").drop("__doc", "__hash")
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return (
        out.select(
            "doc",
            "text_hash",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.size(items_found).cast("long").alias("n_items"),
            items_found.alias("items"),
        ),
        spans,
    )


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated ones."""
    found, _ = contamination(docs, items, id_col, text_col)
    dirty = found.where("n_hit > 0").select(F.col("doc").alias("__doc"), F.col("text_hash").alias("__hash")).distinct()
    dirty = durable(dirty, "contaminated")
    same = F.col(id_col).eqNullSafe(F.col("__doc")) & (F.xxhash64(F.col(text_col)) == F.col("__hash"))
    return docs.join(dirty, same, "left_anti")


def cut_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with hit words, and what stands between two of one span, taken out of the text."""
    _, spans = contamination(docs, items, id_col, text_col)
    spans = spans.groupBy("doc", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("__spans"))
    spans = spans.withColumnsRenamed({"doc": "__doc", "text_hash": "__hash"})
    same = F.col(id_col).eqNullSafe(F.col("__doc")) & (F.xxhash64(F.col(text_col)) == F.col("__hash"))
    joined = docs.join(spans, same, "left").drop("__doc", "__hash")
    # Pieces alternate: what is between words, then a word; lower case only decides where words are.
    text = F.coalesce(F.col(text_col), F.lit(""))
    gap = F.regexp_extract_all(text, F.lit(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    first_is_word = F.coalesce(F.get("__pieces", F.lit(0)).rlike(r"^[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"), F.lit(False))
    joined = joined.withColumn("__pieces", F.when(F.col("__spans").isNotNull(), gap)).withColumn(
        "__lead", F.when(first_is_word, 0).otherwise(1)
    )

    def keep(piece: Column, i: Column) -> Column:
        at = i - F.col("__lead")
        word = F.floor(at / 2).cast("int")
        is_word = (at >= 0) & (at % 2 == 0)
        inside = F.exists(
            "__spans",
            lambda s: F.when(is_word, (s["start"] <= word) & (word < s["end"])).otherwise(
                (s["start"] <= word) & (word + 1 < s["end"]) & (at >= 0)
            ),
        )
        return ~inside

    cut = F.array_join(F.filter("__pieces", keep), "")
    return joined.withColumn(text_col, F.when(F.col("__spans").isNotNull(), cut).otherwise(F.col(text_col))).drop(
        "__spans", "__pieces", "__lead"
    )
