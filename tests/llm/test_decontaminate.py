import pytest

from marketloom.llm import decontaminate
from marketloom.llm.decontaminate import clean_documents, contamination, cut_spans
from tests.llm.frames import bench_words, docs_of, edge_rows, empty_docs, plain_contamination

ITEMS = "item_id long, text string, words string, gram long, doc string"


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "w", 1, "d") for r in rows], ITEMS)


def check(spark, rows, items):
    found, spans = contamination(docs_of(spark, rows), items_of(spark, items))
    got = sorted(((r.doc, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()), key=str)
    want = plain_contamination([(r[0], r[1]) for r in rows], items)
    assert got == sorted(want, key=str)
    per = {}
    for s in spans.collect():
        per[(s.doc, s.text_hash)] = per.get((s.doc, s.text_hash), 0) + s.end - s.start
    hits = {(r.doc, r.text_hash): r.n_hit for r in found.collect() if r.n_hit}
    assert per == hits


PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"


def test_windows_at_every_offset(spark):
    w = PASSAGE.split()
    rows = [(i, " ".join([*["pad"] * i, *w[: 8 + i % 9], "end"])) for i in range(20)]
    rows += [(50, PASSAGE.upper() + "! " + PASSAGE), (51, " ".join(w[:5] + ["x"] + w[5:]))]
    check(spark, rows, [(1, PASSAGE), (2, " ".join(w[3:14])), (10, "unrelated " * 12)])


@pytest.mark.parametrize("size", range(1, 10))
def test_short_items_are_one_window(spark, size):
    w = PASSAGE.split()
    rows = [(i, " ".join([*["pad"] * i, *w[2 : 2 + size + i % 2 - (i % 3 == 0)], "end"])) for i in range(12)]
    check(spark, rows, [(4, " ".join(w[2 : 2 + size])), (5, PASSAGE)])


def test_edges(spark):
    items = [(1, "the QUICK brown fox"), (2, None), (3, ""), (4, "... !!"), (None, "lazy dog"), (1, "the QUICK brown fox"), (9, "你好")]
    rows = edge_rows()
    found, _ = contamination(docs_of(spark, rows), items_of(spark, items))
    got = sorted(((r.doc, r.n_words, r.n_hit) for r in found.collect()), key=str)
    want = plain_contamination([(r[0], r[1]) for r in rows], [i for i in items if i[1]])
    assert got == sorted((w[:3] for w in want), key=str)


def test_empty_tables(spark):
    items = items_of(spark, [(1, PASSAGE)])
    assert contamination(empty_docs(spark), items)[0].collect() == []
    found, spans = contamination(docs_of(spark, edge_rows()), items_of(spark, []))
    assert {r.n_hit for r in found.collect()} == {0} and spans.collect() == []


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    check(spark, [(i, PASSAGE if i % 2 else "clean words " * 9) for i in range(30)], [(1, PASSAGE)])


def test_documents_and_spans_go(spark):
    rows = [(1, f"Keep this. {PASSAGE}, and that."), (2, "nothing here"), (None, PASSAGE), (3, None)]
    docs, items = docs_of(spark, rows), items_of(spark, [(1, PASSAGE)])
    assert sorted(r.doc_id for r in clean_documents(docs, items).collect()) == [2, 3]
    cut = cut_spans(docs, items)
    assert cut.columns == docs.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert bench_words(texts[1]) == ["keep", "this", "and", "that"] and texts[2] == "nothing here" and texts[3] is None
    assert bench_words(texts[None]) == []


def test_no_python_on_the_way(spark):
    plan = clean_documents(docs_of(spark, edge_rows()), items_of(spark, [(1, PASSAGE)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
