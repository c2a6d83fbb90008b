import json
import tempfile
from collections import Counter

import pytest

import corpus_pipeline
from marketloom.llm.common import table
from tests.llm.frames import DOCS, docs_of, edge_rows, empty_docs, plain_components, plain_contamination, plain_simhash

SF = "/root/testdata/sf0.001"


def run_stages(spark, docs, sf_dir=SF):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        path = tempfile.mkdtemp(prefix="marketloom-test-") + "/stage"
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


@pytest.fixture(scope="module")
def stages(spark):
    return run_stages(spark, table(spark, SF, "documents"))


def rows_of(df):
    return Counter(tuple(r) for r in df.select(corpus_pipeline.COLUMNS).collect())


def test_columns(stages):
    assert all(df.columns == corpus_pipeline.COLUMNS for df in stages[:-1])


def test_language_stage_keeps_clean_documents(stages):
    before, after = rows_of(stages[0]), rows_of(stages[1])
    assert after == before


def test_one_document_of_each_component_stays(stages):
    docs = {r.doc_id: r for r in stages[1].collect()}
    roots = plain_components({d: plain_simhash(r.text) for d, r in docs.items()})
    assert {r.doc_id for r in stages[2].collect()} == set(roots.values())


def test_contaminated_documents_go(spark, stages):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    rows = plain_contamination([(r.doc_id, r.text) for r in stages[2].collect()], items)
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(d for d, _, hit, _ in rows if not hit)
    assert any(hit for _, _, hit, _ in rows)


def test_mix_keeps_every_document(stages):
    before, after = rows_of(stages[3]), rows_of(stages[4])
    assert set(after) == set(before) and all(after[r] >= before[r] for r in before)
    once = Counter(r.source for r in stages[3].collect())
    again = Counter(r.source for r in stages[4].collect())
    # The largest source is read once, small ones more often.
    assert min(again[s] / once[s] for s in once) < 1.5


def test_shards(stages):
    rows = stages[5].collect()
    assert len(rows) == stages[4].count()
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.get(i, 0) for i in range(24)) <= 1


def test_run_is_the_stages_one_after_the_other(spark, stages):
    mine = Counter((r.doc_id, r.size, r.text_crc32) for r in corpus_pipeline.run(spark, SF).collect())
    assert mine == Counter((r.doc_id, r.size, r.text_crc32) for r in stages[5].collect())


@pytest.mark.parametrize("kind", ["edges", "empty"])
def test_odd_inputs(spark, kind):
    """Missing values, empty and long texts, repeated rows, clashing columns, an empty table."""
    learn = [(1000 + i, f"the quick brown fox jumps over dog number {chr(97 + i % 26) * 4} and some more words here", "en", "a") for i in range(60)]
    rows = [*edge_rows(), *learn]
    out = run_stages(spark, docs_of(spark, rows) if kind == "edges" else empty_docs(spark))
    if kind == "empty":
        assert all(df.count() == 0 for df in out[1:])
        return
    kept = Counter(r.doc_id for r in out[1].collect())
    assert kept[2] == 2 and kept[None] == 1 and kept[4] == kept[5] == kept[3] == 0
    assert max(Counter(r.doc_id for r in out[2].collect()).values()) == 1
    roots = {}
    for r in out[1].collect():
        roots.setdefault(plain_simhash(r.text), r)
    classes = plain_components({fp: fp for fp in roots})
    assert out[2].count() == len(set(classes.values()))


def test_a_table_of_repeated_identifiers(spark):
    rows = [(1, "one text of its own kind"), (1, "quite another text with other words"), (None, "lonely words without any name"), (None, "lonely words without any name")]
    out = corpus_pipeline.simhash_near_dedup(spark, docs_of(spark, rows), SF).collect()
    assert Counter(r.doc_id for r in out) == {1: 2, None: 1}


def test_no_oracle_is_claimed():
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == json.loads(
        '["language ID", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights", "sharding"]'
    )
    assert "text" in DOCS
