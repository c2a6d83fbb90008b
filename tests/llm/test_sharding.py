import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from marketloom.llm import sharding
from marketloom.llm.sharding import cut_links, documents_by_text, shard_documents
from tests.llm.frames import docs_of, edge_rows, empty_docs


def law(rows, shards):
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(i, 0) for i in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_edges(spark):
    rows = edge_rows()
    out = shard_documents(documents_by_text(docs_of(spark, rows)), 5).collect()
    law(out, 5)
    want = sorted(((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows), key=str)
    assert sorted(((r.id, r.size, r.text_crc32) for r in out), key=str) == want


def test_empty_and_fewer_rows_than_shards(spark):
    assert shard_documents(documents_by_text(empty_docs(spark))).collect() == []
    law(shard_documents(documents_by_text(docs_of(spark, [(1, "a"), (2, "a"), (3, "b")]))).collect(), 24)


def test_small_groups_come_together(spark):
    rows = [(i, f"text {i // 3}" if i < 300 else f"own {i}") for i in range(1000)]
    df = shard_documents(documents_by_text(docs_of(spark, rows)), 8)
    out = df.collect()
    law(out, 8)
    links, cut = cut_links(df).first()
    by_key = defaultdict(list)
    for r in out:
        by_key[bytes(r.key)].append(r.shard)
    pairs = sum(a != b for s in by_key.values() for i, a in enumerate(s) for b in s[:i])
    assert links == 300 and cut == pairs == 0


def test_large_group_takes_few_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 10)
    rows = [(i, "same" if i % 3 == 0 else f"own {i}") for i in range(900)]
    out = shard_documents(documents_by_text(docs_of(spark, rows)), 9).collect()
    law(out, 9)
    same = zlib.crc32(b"same")
    held = Counter(r.shard for r in out if r.text_crc32 == same)
    assert sum(held.values()) == 300 and len(held) <= 5  # 3 at best; chunks of 10 don't fill a quota quite


def test_everything_linked(spark):
    out = shard_documents(documents_by_text(docs_of(spark, [(i, f"t{i % 4}") for i in range(203)])), 24).collect()
    law(out, 24)


def test_rounds_cut_less_even_when_everything_is_linked(spark):
    rows = docs_of(spark, [(i, f"text {i % 40}") for i in range(400)])
    cuts = [cut_links(shard_documents(documents_by_text(rows), 6, rounds)).first()["cut"] for rounds in (0, 2, 12)]
    assert cuts[0] > cuts[1] > cuts[2] and cuts[2] < cuts[0] / 2


def test_rounds_end_by_themselves_and_keep_the_best(spark):
    rows = docs_of(spark, [(i, f"text {i % 40}") for i in range(400)])
    rows = documents_by_text(rows)
    early, late = (cut_links(shard_documents(rows, 6, rounds)).first()["cut"] for rounds in (12, None))
    assert late <= early


def test_rows_survive_with_clashing_columns(spark):
    df = docs_of(spark, edge_rows()).withColumn("shard", F.lit("x")).withColumn("law", F.lit(1))
    assert shard_documents(documents_by_text(df)).count() == len(edge_rows())
