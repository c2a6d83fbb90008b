import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import language_id, quality
from marketloom.llm.common import held_out, table
from marketloom.llm.queries import QUERIES
from tests.llm.frames import docs_of, edge_rows, empty_docs, long_text

SF = "/root/testdata/sf0.01"


def test_held_out(spark):
    import zlib

    df = spark.createDataFrame([(i,) for i in (0, 5, 17, 123456, None)], "doc_id long")
    got = {r.doc_id: r.h for r in df.withColumn("h", held_out(F.col("doc_id"), 3, 1)).collect()}
    assert got == {i: zlib.crc32(str("" if i is None else i).encode()) % 3 == 1 for i in got}


def test_languages_of_documents_not_learned_from(spark):
    docs = table(spark, SF, "documents")
    out = QUERIES["op8_nearest_centroid"](spark, SF)
    rows = out.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 250
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.99 * len(rows)
    assert not any(r.rejected for r in rows if r.lang == r.lang_pred)
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.fixture(scope="module")
def language_model(spark):
    return language_id.fit(table(spark, SF, "documents").where(~held_out(F.col("doc_id"), 3, 1)))


def test_several_centroids_per_language(language_model):
    assert len(language_model.centres) == 4 * len(set(language_model.languages))
    assert np.allclose(np.linalg.norm(language_model.centres, axis=1), 1, atol=1e-3)


def test_language_edges(spark, language_model):
    rows = [*edge_rows(), (20, "123 !!! 456", None, None), (21, "你好世界" * 50, None, None), (22, "zq xv kjq wvx " * 200, None, None)]
    docs = docs_of(spark, rows)
    out = docs.select("doc_id", "text", language_id.identify(docs, language_model).alias("x")).collect()
    assert len(out) == len(rows)
    for r in out:
        if not language_id.has_letter(r.text):
            assert (r.x.lang, r.x.score, r.x.rejected) == ("und", 0.0, True)
        else:
            assert r.x.lang in ("de", "en", "es", "fr")
    assert {r.doc_id: r.x.rejected for r in out}[21] and {r.doc_id: r.x.rejected for r in out}[22]


def test_nothing_to_learn(spark):
    for docs in (empty_docs(spark), docs_of(spark, [(1, None, "en", None), (2, "text", None, None), (3, "...", "en", None)])):
        model = language_id.fit(docs)
        assert all(r.x.lang == "und" for r in docs.select(language_id.identify(docs, model).alias("x")).collect())


def test_long_texts_are_read_whole():
    text = long_text(300_000)
    counts = language_id.gram_counts(text)
    words = [w for w in "".join(c if c.isascii() and c.islower() else " " for c in text).split()]
    raw = (" " + " ".join(words) + " ").encode()
    assert len(raw) > 1 << 20
    assert counts[: language_id.BUCKETS].sum() == len(raw) - 1 and counts[language_id.BUCKETS :].sum() == len(raw) - 2


def test_quality_of_documents_not_learned_from(spark):
    out = QUERIES["op1_bradley_terry"](spark, SF)
    rows = out.join(table(spark, SF, "labels").select("doc_id", "quality"), "doc_id").where("held_out").collect()
    assert len(rows) > 60
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_bradley_terry_recovers_an_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 4))
    raw = x @ np.array([2.0, -1.0, 0.5, 0.0])
    y = rng.random(600) < 1 / (1 + np.exp(-raw))
    w = quality.bradley_terry(x[y], x[~y])
    assert np.corrcoef(x @ w, raw)[0, 1] > 0.98
    order = np.argsort(x @ w)
    assert y[order[300:]].mean() > y[order[:300]].mean() + 0.3


def test_bradley_terry_is_at_the_minimum():
    rng = np.random.default_rng(2)
    good, bad = rng.normal(0.3, 1, (40, 3)), rng.normal(-0.3, 1, (25, 3))
    w = quality.bradley_terry(good, bad, opponents=5)
    i = np.arange(40 * 5)
    diff = good[i % 40] - bad[(i + i // 40) % 25]
    loss = lambda v: np.log1p(np.exp(-(diff @ v))).sum() + 0.5 * quality.RIDGE * v @ v
    assert all(loss(w) <= loss(w + d) + 1e-9 for d in rng.normal(0, 1e-2, (50, 3)))


def test_quality_edges(spark):
    good, bad = "Plain words in a calm sentence number {}.", "BUY!! NOW!! {} $$$ ### %%%"
    rows = [(i, (good if i % 2 else bad).format(i) * 5) for i in range(60)] + [(100 + i, r[1]) for i, r in enumerate(edge_rows())]
    docs = docs_of(spark, rows)
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(60)] + [(0, 0, 1), (1, None, 0), (None, 1, 0), (999, 1, 0), (2, 7, 0)], "doc_id long, quality int, toxic int"
    )
    model = quality.fit(docs, labels)
    out = docs.select("doc_id", "text", quality.quality_scores(docs, model).alias("score")).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all((r.score >= 0.7) == bool(r.doc_id % 2) for r in out if r.doc_id < 60)
    flat = quality.fit(docs, labels.where("quality = 1"))
    assert {r.score for r in docs.select(quality.quality_scores(docs, flat).alias("score")).collect()} == {0.5}
    none = empty_docs(spark)
    assert none.select(quality.quality_scores(none, model)).collect() == []


def test_a_labelled_identifier_that_repeats_is_learned_from_once(spark, monkeypatch):
    good, bad = "Plain words in a calm sentence number {}.", "BUY!! NOW!! {} $$$ ### %%%"
    docs = docs_of(spark, [(i, (good if i % 2 else bad).format(i) * 5) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    hot = docs.where("doc_id = 3").crossJoin(spark.range(20_000)).drop("id")
    hot_docs, hot_labels = docs.unionByName(hot.select(*[c for c in docs.columns if c != "id"]).withColumn("id", F.lit(0).cast("long"))), labels.union(
        labels.where("doc_id = 4").crossJoin(spark.range(100_000)).drop("id")
    )
    seen = []
    learn = quality.bradley_terry
    monkeypatch.setattr(quality, "bradley_terry", lambda a, b: seen.append((len(a), len(b))) or learn(a, b))
    once, many = quality.fit(docs, labels), quality.fit(hot_docs, hot_labels)
    assert seen == [(30, 30)] * 2
    assert (once.weights == many.weights).all() and once.cut == many.cut


def test_number_characters_are_no_letters(spark):
    texts = ["²", "½ ①", "Ⅷ", "_ 12 %", "́", "ß", "語", "ʰ"]
    assert [language_id.has_letter(t) for t in texts] == [False] * 5 + [True] * 3
    train = docs_of(spark, [(i, f"the cat and the dog {i}", "en", "a") for i in range(5)])
    model = language_id.fit(train)
    docs = docs_of(spark, [(i, t) for i, t in enumerate(texts[:5])])
    assert all(r.x.lang == "und" for r in docs.select(language_id.identify(docs, model).alias("x")).collect())


def test_quality_learns_from_every_labelled_row(spark, monkeypatch):
    good, bad = "Plain words in a calm sentence number {}.", "BUY!! NOW!! {} $$$ ### %%%"
    docs = docs_of(spark, [(i, (good if i % 3 else bad).format(i)) for i in range(15_000)])
    labels = docs.select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"))
    seen = []
    learn = quality.bradley_terry
    monkeypatch.setattr(quality, "bradley_terry", lambda a, b: seen.append((len(a), len(b))) or learn(a, b))
    model = quality.fit(docs, labels)
    assert seen == [(10_000, 5_000)]
    out = docs.select("doc_id", quality.quality_scores(docs, model).alias("score")).where((F.col("score") >= 0.7) != (F.col("doc_id") % 3 != 0))
    assert out.count() == 0


def test_quality_pairs_of_tables_and_of_arrays_are_the_same(spark):
    rng = np.random.default_rng(3)
    good, bad = rng.normal(0.3, 1, (40, quality.FEATURES)), rng.normal(-0.3, 1, (25, quality.FEATURES))
    table_of = lambda x: quality.Dealt(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "n long, z array<double>"), len(x))
    for a, b in ((good, bad), (bad[:3], good)):
        assert np.allclose(quality.bradley_terry(a, b), quality.bradley_terry(table_of(a), table_of(b)), atol=1e-9)
