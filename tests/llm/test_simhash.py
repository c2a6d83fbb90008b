import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import simhash
from marketloom.llm.components import components
from marketloom.llm.simhash import allocate, correlated_parts, links, near_duplicates
from tests.llm.frames import Sets, docs_of, edge_rows, empty_docs, plain_components, plain_simhash


def unsigned(x):
    return x & ((1 << 64) - 1)


def check(spark, rows):
    out = near_duplicates(docs_of(spark, rows)).collect()
    prints = {r[1]: plain_simhash(r[1]) for r in rows}
    class_of = plain_components({k: v for k, v in enumerate(prints.values())})
    where = {t: class_of[k] for k, t in enumerate(prints)}
    ids = {}
    for doc, text, *_ in rows:
        ids.setdefault(where[text], []).append(doc)
    least = {c: min((i for i in v if i is not None), default=None) for c, v in ids.items()}
    want = sorted(((r[0], prints[r[1]], least[where[r[1]]]) for r in rows), key=str)
    assert sorted(((r.id, unsigned(r.fp), r.component) for r in out), key=str) == want


def test_edges(spark):
    check(spark, edge_rows())


def test_empty(spark):
    assert near_duplicates(empty_docs(spark)).collect() == []


def test_near_copies(spark):
    rng = random.Random(5)
    words = [f"word{i}" for i in range(400)]
    rows = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(150)]
        for k in range(6):
            text = list(base)
            for _ in range(k):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((g * 10 + k, " ".join(text)))
    check(spark, rows)


def test_long_text_in_steps(monkeypatch):
    text = " ".join(f"a{i % 211} b{i % 17}" for i in range(3000))
    want = plain_simhash(text)
    monkeypatch.setattr(simhash, "_STEP", 100)
    assert simhash.simhash(text) == want


@pytest.mark.parametrize("bucket", [40, 20_000])
def test_links_have_the_components_of_all_pairs(spark, bucket):
    rng = random.Random(3)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            fp = centre
            for b in rng.sample(range(64), rng.randrange(0, 5)):
                fp ^= 1 << b
            prints.add(fp)
    prints |= {rng.getrandbits(64) for _ in range(200)} | {rng.getrandbits(12) for _ in range(40)}
    signed = [(simhash._signed(x),) for x in prints]
    found = links(spark.createDataFrame(signed, "fp long"), bucket=bucket).collect()
    assert all((unsigned(r.a) ^ unsigned(r.b)).bit_count() <= 3 for r in found)
    assert len(found) < 12 * len(prints)
    sets = Sets()
    for r in found:
        sets.join(unsigned(r.a), unsigned(r.b))
    want = plain_components({x: x for x in prints})
    classes = lambda f: {frozenset(y for y in prints if f(y) == f(x)) for x in prints}
    assert classes(sets.find) == classes(want.get)


def test_thresholds_add_up_and_cost_least():
    work = [[0, 5, 50, 500, 5000], [0, 90, 91, 92, 93], [0, 2, 4, 900, 9000]]
    cost, chosen = allocate(work, 4)
    assert sum(t + 1 for t in chosen) == 4
    best = min(work[0][a] + work[1][b] + work[2][c] for a in range(5) for b in range(5) for c in range(5) if a + b + c == 4)
    assert cost == best == sum(w[t + 1] for w, t in zip(work, chosen))


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (500, 64))
    for j in range(8):
        bits[:, 8 * j + 1] = bits[:, 8 * j]
    parts = correlated_parts(500, (bits.T @ bits).astype(float), 4)
    assert sorted(sum(parts, [])) == list(range(64))
    own = {b: i for i, p in enumerate(parts) for b in p}
    assert sum(own[8 * j] == own[8 * j + 1] for j in range(8)) >= 7


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (200, 200), (7, 300), (-5, 101)]
    sets = Sets()
    for a, b in edges:
        sets.join(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: sets.find(x) for e in edges for x in e if x != 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_spark_hash_is_the_contract_hash(spark):
    import xxhash

    for text in ("", "a b c", "über " * 20):
        got = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
        assert unsigned(got) == xxhash.xxh64_intdigest(text.encode(), 42)
