"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed byte pairs and triples of its lower-cased letters (everything else is a word gap): damped
counts times inverse document frequency, scaled to length one. Each language is clustered into ``CENTROIDS`` centroids by
spherical k-means, and a text takes the language of the centroid with the largest cosine, whole texts throughout.

Fitting takes a bounded sample: about ``SAMPLE`` labelled documents per language, drawn by a hash of identifier and text.
Its vectors stay in the tasks; the driver gets one row per gram bucket and one per centroid.

Rejection is by distance. Short texts lie farther from any centroid than long ones, so the largest distance allowed depends
on length: a text must be at least ``SLACK`` times as similar to its centroid as the least similar training document that is
about as long or longer. Texts shorter than all of these pass. Texts without a letter (a character of a Unicode letter category) are rejected.

Defined results: a missing text and one without letters are ``und`` with score 0; if nothing can be learned all are ``und``;
rows with a missing label teach nothing; repeated rows each get a row; an empty table gives no rows. The score is the cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.session import durable

BUCKETS = 4096  # for each gram length
CENTROIDS, SAMPLE, SLACK = 4, 1000, 0.5
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_GAPS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_STEP = 1 << 20


def has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed byte pairs and triples of a text's words, with one gap before, between and after them."""
    words = text.lower().encode("utf-8", "surrogatepass").translate(_GAPS).split()
    raw = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    counts = np.zeros(2 * BUCKETS, np.float64)
    for at in range(0, max(len(raw) - 1, 0), _STEP):
        b = raw[at : at + _STEP + 2].astype(np.uint32)
        pairs = b[: min(_STEP, len(b) - 1)] * 256 + b[1 : 1 + min(_STEP, len(b) - 1)]
        counts[:BUCKETS] += np.bincount((pairs * np.uint32(2654435761) >> np.uint32(8)) % BUCKETS, minlength=BUCKETS)
        if len(b) > 2:
            m = min(_STEP, len(b) - 2)
            triples = (b[:m] * 256 + b[1 : 1 + m]) * 256 + b[2 : 2 + m]
            counts[BUCKETS:] += np.bincount((triples * np.uint32(2654435761) >> np.uint32(8)) % BUCKETS, minlength=BUCKETS)
    return counts


def _vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    size = np.linalg.norm(v)
    return (v / size if size > 0 else v).astype(np.float32)


def _centroids(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the mean's farthest members, so it is the same every time."""
    mean = vectors.mean(axis=0)
    centres = [vectors[int(np.argmax(vectors @ mean))]]
    while len(centres) < min(k, len(vectors)):
        near = np.max(vectors @ np.array(centres).T, axis=1)
        centres.append(vectors[int(np.argmin(near))])
    centres = np.array(centres)
    for _ in range(rounds):
        own = np.argmax(vectors @ centres.T, axis=1)
        for c in range(len(centres)):
            if (own == c).any():
                # A product with the membership adds the members up without a copy of them.
                m = (own == c).astype(np.float32) @ vectors
                centres[c] = m / max(np.linalg.norm(m), 1e-12)
    return centres


class LanguageModel:
    def __init__(self, idf: np.ndarray, languages: list[str], centres: np.ndarray, least: np.ndarray):
        self.idf, self.languages, self.centres, self.least = idf, languages, centres, least

    def bin(self, counts: np.ndarray) -> int:
        return min(int(np.log2(counts[:BUCKETS].sum() + 1)), len(self.least) - 1)

    def predict(self, texts) -> tuple[list[str], list[float], list[bool]]:
        langs, scores, rejected = [], [], []
        for text in texts:
            if not self.languages or not has_letter(text):
                langs.append(UNKNOWN), scores.append(0.0), rejected.append(True)
                continue
            counts = gram_counts(text)
            cosines = self.centres @ _vector(counts, self.idf)
            best = int(np.argmax(cosines))
            score = float(min(max(cosines[best], 0.0), 1.0))
            langs.append(self.languages[best]), scores.append(score), rejected.append(score < self.least[self.bin(counts)])
        return langs, scores, rejected


def _sample(train: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` rows of each language, by a hash; rarer languages whole."""
    sizes = train.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("n"))
    drawn = F.pmod(F.xxhash64("id", "text", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    # As many rows as there are languages.
    return train.join(F.broadcast(sizes), "lang").where(drawn < share).select("lang", "text")


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE, k: int = CENTROIDS
) -> LanguageModel:
    """Learns from the rows of ``docs`` that have a language and a letter; pass only rows that may be learned from."""
    train = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    train = train.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sample = durable(_sample(train, per_language), "sample")

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(2 * BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                if has_letter(text):
                    total += gram_counts(text) > 0
                    n += 1
        yield pd.DataFrame({"gram": np.arange(-1, 2 * BUCKETS), "n": np.concatenate(([n], total))})

    found = sample.select("text").mapInPandas(frequencies, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(2 * BUCKETS + 1)
    for row in found.collect():  # a row per gram bucket
        counts[row["gram"] + 1] = row["n"]
    n, df = counts[0], counts[1:]
    idf = np.log((1 + n) / (1 + df)) + 1

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        texts = sorted(t for t in group["text"] if has_letter(t))
        if not texts:
            return pd.DataFrame({"lang": [], "centre": [], "least": []}, dtype=object)
        # The one large array of a task: a row for each text of the sample.
        vectors = np.empty((len(texts), 2 * BUCKETS), np.float32)
        bins = np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            counts = gram_counts(text)
            vectors[i] = _vector(counts, idf)
            bins[i] = int(np.log2(counts[:BUCKETS].sum() + 1))
        centres = _centroids(vectors, k)
        near = np.max(vectors @ centres.T, axis=1)
        least = [float(near[bins == b].min()) if (bins == b).any() else 2.0 for b in range(32)]
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centre": [c.tobytes() for c in centres], "least": [least] * len(centres)})

    # A group is the bounded sample of one language.
    rows = sample.groupBy("lang").applyInPandas(cluster, "lang string, centre binary, least array<double>").collect()
    rows = sorted(rows, key=lambda r: (r["lang"], bytes(r["centre"])))
    centres = np.array([np.frombuffer(bytes(r["centre"]), np.float32) for r in rows]).reshape(len(rows), 2 * BUCKETS)
    least = np.min([r["least"] for r in rows], axis=0) if rows else np.zeros(32)
    # The least similar document of a length or longer ones; nothing is asked of texts shorter than all of them.
    seen = np.flatnonzero(least <= 1)
    floor = np.minimum.accumulate(np.minimum(least, 1.0)[::-1])[::-1] * SLACK
    floor[: seen[0] if len(seen) else len(floor)] = 0.0
    return LanguageModel(idf, [r["lang"] for r in rows], centres, floor)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> Column:
    """Struct column (lang, score, rejected) for ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    # Arrow arrays are read text by text: a batch is not copied into Python objects as a whole.
    @F.arrow_udf("lang string, score double, rejected boolean")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            langs, scores, rejected = shared.value.predict(t.as_py() for t in batch)
            columns = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.StructArray.from_arrays(columns, ["lang", "score", "rejected"])

    return of(F.col(text_col))
