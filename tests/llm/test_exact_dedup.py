import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from marketloom.llm import exact_dedup
from marketloom.llm.exact_dedup import exact_duplicates
from tests.llm.frames import docs_of, edge_rows, empty_docs


def plain(rows):
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        stays = ids.index(keep)
        for k, i in enumerate(ids):
            out.append((i, keep, len(ids), k == stays, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_edges(spark):
    rows = edge_rows()
    assert found(exact_duplicates(docs_of(spark, rows))) == plain(rows)


def test_empty(spark):
    assert exact_duplicates(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("hot", [3, 10_000])
def test_hot_groups_give_the_same(spark, monkeypatch, hot):
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", hot)
    monkeypatch.setattr(exact_dedup.hot_keys, "__defaults__", (hot,))
    rows = [(i, "same text" if i % 3 == 0 else f"text {i % 7}" if i % 3 == 1 else f"own {i}") for i in range(200)]
    assert found(exact_duplicates(docs_of(spark, rows))) == plain(rows)


def test_copies_without_identifiers_or_with_one_are_spread(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.hot_keys, "__defaults__", (50,))
    rows = [(None, "same") for _ in range(600)] + [(7, "same") for _ in range(300)] + [(8, "same"), (9, "own")]
    df = docs_of(spark, rows)
    assert found(exact_duplicates(df)) == plain(rows)
    none = [(None, "same") for _ in range(400)]
    assert found(exact_duplicates(docs_of(spark, none))) == plain(none)
    keyed = df.select("doc_id", F.xxhash64("text").alias("h")).withColumn("row", F.monotonically_increasing_id())
    hot = exact_dedup.hot_keys(keyed, "h")
    salts = exact_dedup.salted(keyed.where("doc_id is null"), hot, "h", "row").groupBy("__salt").count().collect()
    assert len(salts) == 19 and max(r["count"] for r in salts) <= 3 * 600 / 19


def test_texts_that_share_a_long_start(spark):
    rows = [(i, "x" * 5000 + str(i % 4)) for i in range(20)]
    assert found(exact_duplicates(docs_of(spark, rows))) == plain(rows)


def test_plan_sorts_in_ranges_without_python(spark):
    plan = exact_duplicates(docs_of(spark, edge_rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
