from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm.mixing import RESOLUTION, mixed, schedule, shares, size_of, slots
from tests.llm.frames import docs_of, edge_rows, empty_docs


def plain_cycle(parts):
    """Earliest deadline first, slot by slot."""
    total, done, out = sum(parts), [0] * len(parts), []
    for t in range(total):
        ready = [(-(-(k + 1) * total // p), i) for i, (k, p) in enumerate(zip(done, parts)) if k < p and k * total // p <= t]
        _, i = min(ready)
        out.append((i, done[i], t))
        done[i] += 1
    return out


@pytest.mark.parametrize("parts", [[1], [3, 1], [7, 2, 1], [1, 1, 1, 1], [13, 40, 29, 5, 13]])
def test_slots_are_edf_and_fair(parts):
    got = sorted(((i, k, int(t)) for i, own in enumerate(slots(parts, sum(parts))) for k, t in enumerate(own)), key=lambda r: r[2])
    assert got == plain_cycle(parts)
    total, done = sum(parts), Counter()
    for i, k, t in got:
        assert k * total // parts[i] <= t < -(-(k + 1) * total // parts[i])
        done[i] += 1
        assert all(abs(done[j] - parts[j] * (t + 1) / total) < 1 for j in range(len(parts)))


def test_shares():
    assert shares([1, 1, 2], 100) == [25, 25, 50]
    assert sum(shares([0.001, 5, 3], 10)) == 10 and min(shares([0.001, 5, 3], 10)) == 1
    with pytest.raises(ValueError):
        shares([1, 0], 10)
    with pytest.raises(ValueError):
        shares([1] * 11, 10)


def run(spark, rows, **options):
    docs = docs_of(spark, rows)
    return schedule(docs, size_of(F.col("text")), **options).collect()


def test_weights_hold_and_nothing_is_left_out(spark):
    rows = [(i, "x" * (50 + i % 90), "en", "big" if i % 4 else "small") for i in range(600)]
    out = run(spark, rows, weights={"big": 0.5, "small": 0.5}, resolution=20, block_bytes=500)
    assert {r.doc_id for r in out} == set(range(600))
    assert all(r.release <= r.position < r.deadline for r in out)
    blocks = defaultdict(set)
    for r in out:
        blocks[r.source].add(r.position)
    length = max(max(s) for s in blocks.values()) + 1
    for t in range(1, length):
        for s in blocks.values():
            assert abs(sum(p < t for p in s) - t / 2) < 1.01
    again = Counter((r.source, r.doc_id) for r in out)
    assert max(n for (s, _), n in again.items() if s == "big") == 1 and max(n for (s, _), n in again.items() if s == "small") >= 3
    assert not {p for p in blocks["big"]} & {p for p in blocks["small"]}


def test_blocks_are_cut_by_bytes(spark):
    rows = [(i, "y" * 92, "en", "a") for i in range(50)]
    out = run(spark, rows, block_bytes=1000)
    assert sorted(r.offset for r in out) == [100 * i for i in range(50)]
    assert all(r.block == r.offset // 1000 and r.epoch == 0 for r in out)


def test_edges(spark):
    rows = edge_rows()
    out = run(spark, rows, block_bytes=64)
    once = Counter((r.doc_id, r.text, r.source) for r in out if r.epoch == 0)
    assert once == Counter((r[0], r[1], r[3]) for r in rows)
    assert run(spark, [(1, "a", "en", "s")])[0].position == 0
    assert schedule(empty_docs(spark), size_of(F.col("text"))).collect() == []
    with pytest.raises(ValueError):
        run(spark, rows, weights={"a": 1.0})


def test_mixed_returns_the_rows_in_order(spark):
    docs = docs_of(spark, [(i, "z" * 80, "en", f"s{i % 3}") for i in range(90)])
    out = mixed(docs, block_bytes=200, resolution=30)
    assert out.columns == docs.columns
    where = {r.doc_id: r.position for r in schedule(docs, size_of(F.col("text")), block_bytes=200, resolution=30).collect()}
    at = [where[r.doc_id] for r in out.collect()]
    assert at == sorted(at) and len(at) == 90
    assert out.first()["size"] == "s"


def test_no_python_on_the_way(spark):
    plan = schedule(docs_of(spark, edge_rows()), size_of(F.col("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("weights", [[0.4, 0.3, 0.1, 0.07, 0.05, 0.03, 0.02, 0.0171, 0.0129], [1 / 3, 0.3, 0.2, *[0.0003 + i * 1e-7 for i in range(300)]]])
def test_a_long_mix_keeps_to_the_given_weights(weights):
    length, whole = 200_000, sum(weights)
    found = slots(shares(weights, RESOLUTION), length)
    assert sum(map(len, found)) == length
    for w, own in zip(weights, found, strict=True):
        # Just before and just after each of its blocks a source is furthest from its weight.
        k = range(len(own))
        assert all(abs(k_ - w / whole * t) < 1.01 and abs(k_ + 1 - w / whole * (t + 1)) < 1.01 for k_, t in zip(k, own.tolist(), strict=True))
        assert abs(len(own) - w / whole * length) < 1.01


def test_ten_million_slots_of_hundreds_of_sources_keep_to_their_weights():
    weights = [0.4, 0.25, 0.2, *[0.0002 + i * 1e-6 for i in range(300)]]
    length, whole = 10_000_000, sum(weights)
    found = slots(shares(weights, RESOLUTION), length)
    assert sum(map(len, found)) == length
    for w, own in zip(weights, found, strict=True):
        k, share = np.arange(len(own)), w / whole
        # Shares meet a weight to 1/2**31, which is 0.005 blocks here.
        assert np.abs(k - share * own).max() < 1.01 and np.abs(k + 1 - share * (own + 1)).max() < 1.01


@pytest.mark.parametrize("weights", [None, {"a": 0.61, "b": 0.39}])
def test_blocks_grow_when_the_slots_would_be_too_many(spark, weights):
    rows = [(i, "x" * 92, "en", "a" if i % 3 else "b") for i in range(900)]
    out = run(spark, rows, weights=weights, block_bytes=100, max_slots=100)
    assert max(r.position for r in out) < 100 and {r.doc_id for r in out} == set(range(900))
    assert all(r.release <= r.position < r.deadline for r in out)
    sizes = defaultdict(Counter)
    for r in out:
        sizes[r.source][r.position] += r.size
    # One size of block, a multiple of the given one, for all sources.
    assert len({max(c.values()) for c in sizes.values()}) == 1
    assert not set(sizes["a"]) & set(sizes["b"])


def test_a_weight_that_no_list_of_slots_can_meet(spark):
    with pytest.raises(ValueError, match="one block"):
        run(spark, [(1, "x", "en", "a"), (2, "y", "en", "b")], weights={"a": 1.0, "b": 1e-6}, max_slots=1000)


def test_more_sources_than_a_thousand_and_a_hot_one(spark):
    rows = [(i, "x" * 92, "en", "hot") for i in range(6000)] + [(6000 + i, "x" * 92, "en", f"s{i:04}") for i in range(1100)]
    out = run(spark, rows, block_bytes=100, power=1.0)
    # Weights are the bytes, so all are read once; a weight's last bit may add a slot.
    assert 7100 <= len(out) <= 7102 and {r.doc_id for r in out if r.epoch == 0} == set(range(7100))
    assert sorted(r.position for r in out) == list(range(len(out)))
    assert all(r.release <= r.position < r.deadline for r in out)


def test_a_tiny_source_does_not_make_the_others_come_again(spark):
    rows = [(i, "x" * 300, "en", "big") for i in range(4000)] + [(9000, "tiny", "en", "small")]
    out = run(spark, rows, block_bytes=2000)
    assert len(out) <= 2 * len(rows)
    epochs = Counter(r.doc_id for r in out)
    assert epochs.keys() == {r[0] for r in rows} and max(epochs[i] for i in range(4000)) <= 2
    assert all(r.release <= r.position < r.deadline for r in out)


def test_the_largest_source_is_read_once_whatever_the_others_hold(spark):
    sizes = {"a": 900, "b": 300, "c": 40, "d": 3, "e": 1}
    rows = [(f"{s}{i}", "y" * 492, "en", s) for s, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame([(i, t, s) for i, t, _, s in rows], "doc_id string, text string, source string")
    out = schedule(docs, size_of(F.col("text")), block_bytes=500).collect()
    read = Counter(r.source for r in out)
    # Blocks of one document each: a source of n blocks comes (900 / n) ** 0.2 times, to a block.
    for s, n in sizes.items():
        assert abs(read[s] - n * (900 / n) ** 0.2) <= 1.5
