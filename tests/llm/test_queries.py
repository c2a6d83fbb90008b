import math

import pytest

import __spark_entry__ as entry
from marketloom.llm.common import table
from marketloom.llm.queries import ORACLES, QUERIES
from tests.compare import TYPES, assert_same, connect
from tests.llm.frames import plain_components, plain_contamination, plain_simhash

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    assert_same(QUERIES[name](spark, SF), connect(SF), ORACLES[name])


def test_all_are_registered():
    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert "boolean" in TYPES


def test_decontamination_against_a_plain_version(spark):
    import hashlib

    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    want = {d: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in plain_contamination(docs, items)}
    got = QUERIES["op6_ngram_set"](spark, SF).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == want
    assert any(w[1] for w in want.values())


def test_simhash_against_a_plain_version(spark):
    prints = {r.doc_id: plain_simhash(r.text) for r in table(spark, SF, "documents").collect()}
    roots = plain_components(prints)
    want = {d: (f"{fp:016x}", roots[d]) for d, fp in prints.items()}
    got = QUERIES["op9_simhash_pigeonhole"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want


def test_mix_is_fair_on_the_whole_table(spark):
    rows = QUERIES["op3_pfair_mix"](spark, SF).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in table(spark, SF, "documents").collect()}
    assert all(r.release <= r.position < r.deadline for r in rows)
    slots = {}
    for r in rows:
        assert slots.setdefault(r.position, r.source) == r.source


def test_shards_follow_the_law(spark):
    rows = QUERIES["op4_label_propagation"](spark, SF).collect()
    slots = {}
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {len(s) for s in slots.values()} <= {math.floor(len(rows) / 24), math.ceil(len(rows) / 24)}


def test_preferences_cover_every_conversation(spark):
    rows = QUERIES["op7_preference_pairs"](spark, SF).collect()
    turns = table(spark, SF, "conversations").collect()
    assert {r.conv_id for r in rows} == {t.conv_id for t in turns}
    assert {r.conv_id for r in rows if r.usable} == {t.conv_id for t in turns if t.role == "assistant"}
