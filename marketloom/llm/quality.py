"""Quality scores from pairwise preferences: a Bradley-Terry model on features of the whole text.

P(a is preferred to b) = sigmoid(w . (x_a - x_b)). Every document of label 1 is preferred to ``OPPONENTS`` documents of
label 0 (dealt round by round, so that all of them take part), and w minimises the logistic loss of these
feature differences with a ridge term, by Newton steps, whose sums are added up in the tasks. A document's raw score is w . x.

The cut is a quantile of scores: the share of label 0 among the labelled rows is the share of them that should fall below.
The score in 0..1 is sigmoid(raw - cut + logit(0.7)), so the cut lies at 0.7.

Fitting takes all labelled rows that have a document; the driver holds FEATURES numbers squared. Scoring reads every whole text.

Defined results: missing and empty texts have the features of a text without words, and a score; labels other than 0 and 1
teach nothing; equal label rows count once, a document with both labels is two rows, and of texts that repeat a
labelled identifier the smallest (of given features, the smallest) is learned from; without rows of both labels every score is 0.5; repeated rows each get
a row; an empty table gives no rows. Labels, language, source and identifier are never features.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.operators.ordering import row_numbers
from marketloom.operators.quantiles import exact_quantiles
from marketloom.session import durable

OPPONENTS, RIDGE, CUT = 8, 1.0, 0.7
DIGITS = 9
_LETTERS = re.compile(r"[^\W\d_]+")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGIT = re.compile(r"\d")
_SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()\-]")
_PUNCT = re.compile(r"[.,;:!?'\"()\-]")
_MARK = re.compile(r"[!?]{2,}")
_STOP = re.compile(r"[.!?](?:\s|$)")
FEATURES = 24


def features(text: str | None) -> np.ndarray:
    """Shape of a text: how much it repeats itself, what characters it is made of, how words, lines and sentences run."""
    out = np.zeros(FEATURES)
    text = text or ""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return out
    lower = [w.lower() for w in words]
    counts = Counter(lower)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(len, _LETTERS.findall(text)))
    lengths = np.fromiter(map(len, words), np.float64, n)
    pairs = Counter(zip(lower, lower[1:], strict=False))
    raw = text.encode("utf-8", "surrogatepass")
    symbols = len(_SYMBOL.findall(text))
    out[0] = 1.0
    out[1] = math.log1p(n)
    out[2] = letters / chars
    out[3] = len(_UPPER.findall(text)) / max(letters, 1)
    out[4] = len(_DIGIT.findall(text)) / chars
    out[5] = math.log1p(100 * symbols / n)
    out[6] = math.log1p(100 * len(_PUNCT.findall(text)) / n)
    out[7] = len(_MARK.findall(text)) / n
    out[8] = lengths.mean()
    out[9] = lengths.std()
    out[10] = math.log(len(counts)) / math.log(n + 1)
    out[11] = max(counts.values()) / n
    out[12] = sum(a == b for a, b in zip(lower, lower[1:], strict=False)) / n
    out[13] = sum(c - 1 for c in pairs.values()) / n
    out[14] = len(set(lines)) / max(len(lines), 1)
    out[15] = math.log1p(n / max(len(lines), 1))
    out[16] = sum(len(w) == 1 and not w.isalnum() for w in words) / n
    out[17] = sum(w.isupper() for w in words) / n
    out[18] = sum(not w[-1].isalnum() for w in words) / n
    out[19] = sum(not w[0].isalnum() for w in words) / n
    out[20] = math.log1p(n / (1 + len(_STOP.findall(text))))
    out[21] = len(zlib.compress(raw, 1)) / len(raw)
    out[22] = max(np.bincount(np.frombuffer(raw, np.uint8))) / len(raw)
    out[23] = sum(any(not c.isalnum() for c in w[1:-1]) for w in words) / n
    return out


class QualityModel:
    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, cut: float, fitted: bool = True):
        self.mean, self.scale, self.weights, self.cut, self.fitted = mean, scale, weights, cut, fitted

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights

    def scores(self, texts) -> np.ndarray:
        return self.scores_of([features(t) for t in texts] if self.fitted else texts)

    def scores_of(self, shapes) -> np.ndarray:
        """The scores of texts by their features."""
        if not self.fitted or not len(shapes):
            return np.full(len(shapes), 0.5)
        z = self.raw(np.array(list(shapes))) - self.cut + math.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


class Dealt:
    """A stored table of feature rows (n, z), numbered from 0."""

    def __init__(self, rows: DataFrame, size: int):
        self.rows, self.size = rows, size

    def __len__(self) -> int:
        return self.size


def bradley_terry(good, bad, opponents: int = OPPONENTS, ridge: float = RIDGE) -> np.ndarray:
    """Weights of the preference model from pairs (good, bad) of feature rows: two arrays, or two ``Dealt`` tables."""
    rounds = max(opponents, -(-len(bad) // max(len(good), 1)))
    if isinstance(good, Dealt):
        pairs = durable(_pairs(good, bad, rounds), "pairs")
        return _newton(lambda w: _added_up(pairs, w), FEATURES, ridge)
    i = np.arange(len(good) * rounds)
    diff = good[i % len(good)] - bad[(i + i // len(good)) % len(bad)]
    return _newton(lambda w: newton_sums(diff, w), diff.shape[1], ridge)


def newton_sums(diff: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Gradient and second derivatives of the logistic loss over differences that should be positive, one under the other."""
    p = 1 / (1 + np.exp(-np.clip(diff @ w, -60, 60)))  # of the pair as it is
    return np.vstack([diff.T @ (p - 1), (diff * (p * (1 - p))[:, None]).T @ diff])


def _newton(sums: Callable[[np.ndarray], np.ndarray], size: int, ridge: float) -> np.ndarray:
    w = np.zeros(size)
    for _ in range(30):
        found = sums(w)
        step = np.linalg.solve(found[1:] + ridge * np.eye(size), found[0] + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _pairs(good: Dealt, bad: Dealt, rounds: int) -> DataFrame:
    """(diff): every row of label 1 against its opponents of label 0, by their numbers."""
    each = good.rows.select("z", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(rounds - 1).cast("long"))).alias("r"))
    each = each.select("z", ((F.col("r") * len(good) + F.col("n") + F.col("r")) % len(bad)).alias("n"))
    against = bad.rows.select("n", F.col("z").alias("other"))
    return each.join(against, "n").select(F.zip_with("z", "other", lambda a, b: a - b).alias("diff"))


def _added_up(pairs: DataFrame, w: np.ndarray) -> np.ndarray:
    """``newton_sums`` over a stored table of pairs; each task gives one matrix of FEATURES + 1 rows."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((FEATURES + 1, FEATURES))
        for batch in batches:
            if len(batch):
                total += newton_sums(np.stack(batch["diff"].to_numpy()), w)
        yield pd.DataFrame({"place": np.arange(total.size), "v": total.ravel()})

    cells = pairs.mapInPandas(add, "place int, v double").groupBy("place").agg(F.array_sort(F.collect_list("v")).alias("v"))
    # Added in order of size, so that the sums don't depend on which task was first.
    out = np.zeros((FEATURES + 1, FEATURES))
    for r in cells.select("place", F.aggregate("v", F.lit(0.0), lambda a, b: a + b).alias("v")).collect():
        out[r["place"] // FEATURES, r["place"] % FEATURES] = r["v"]
    return out


def shape(text_col: str) -> Column:
    """``features`` as a column."""

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    return of(F.col(text_col))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", shape_col: str | None = None
) -> QualityModel:
    """Learns from all ``labels`` (id, label) that have a document; pass only rows that may be learned from.

    ``shape_col`` names a column of ``docs`` that holds the texts' features, if they are known; texts are not read then.
    """
    none = QualityModel(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0, False)
    rows = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1) and id is not null")
    own = docs.select(F.col(id_col).alias("id"), F.col(shape_col or text_col).alias("x")).join(rows.distinct(), "id")
    # One text for each label, however often documents repeat its identifier.
    own = own.groupBy("id", "label").agg(F.min("x").alias("x"))
    found = durable(own.withColumn("x", F.col("x") if shape_col else shape("x")), "learned")
    sizes = {r["label"]: r["n"] for r in found.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return none
    cells = [F.col("x")[i] for i in range(FEATURES)]
    # Sums depend in their last bits on how the rows lie; what is learned is rounded, so that it does not.
    row = found.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cells)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cells)]).first()
    mean, scale = (np.array([row[f"{k}{i}"] for i in range(FEATURES)]).round(DIGITS) for k in "ms")
    model = QualityModel(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(FEATURES), 0.0)

    @F.pandas_udf("array<double>")
    def scaled(batch: pd.Series) -> pd.Series:
        return pd.Series([np.clip((x - model.mean) / model.scale, -6, 6) for x in batch])

    dealt = found.select("id", "label", F.xxhash64("id").alias("deal"))
    numbers = row_numbers(dealt, ["deal", "id"], "n", ["label"]).select("id", "label", (F.col("n") - 1).alias("n"))
    found = durable(found.select("id", "label", scaled("x").alias("z")).join(numbers, ["id", "label"]), "scaled")
    good, bad = (Dealt(found.where(F.col("label") == k).select("n", "z"), sizes[k]) for k in (1, 0))
    model.weights = bradley_terry(good, bad).round(DIGITS)
    weights = F.array(*[F.lit(float(w)) for w in model.weights])
    raw = F.aggregate(F.zip_with("z", weights, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    raw = durable(found.select(raw.alias("raw")), "raw")
    # Between the last row that should fall below and the next one, of all labelled rows.
    last = sum(sizes.values()) - 1
    model.cut = float(np.mean(exact_quantiles(raw, ["raw"], [(sizes[0] - 1) / last, sizes[0] / last])["raw"]))
    return model


def quality_scores(docs: DataFrame, model: QualityModel, text_col: str = "text", shape_col: str | None = None) -> Column:
    """The score of every text, or of the features in ``shape_col``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(shared.value.scores_of(batch) if shape_col else shared.value.scores(batch))

    return of(F.col(shape_col or text_col))
