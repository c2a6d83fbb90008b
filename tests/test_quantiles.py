import random

import numpy as np
import pytest

from marketloom.operators import quantiles as q

SHARES = [0.0, 0.25, 0.5, 0.75, 1.0]


@pytest.mark.parametrize("kind", ["unique", "ties", "half", "edge"])
@pytest.mark.parametrize("max_distinct", [0, 100_000])
def test_exact(spark, monkeypatch, kind, max_distinct):
    monkeypatch.setattr(q, "MAX_ROWS_LEFT", 20)
    rng = random.Random(3)
    n = 5003
    make = {
        "unique": lambda i: rng.random() * 1e6 - 5e5,
        "ties": lambda i: float(rng.randrange(9)),
        "half": lambda i: 42.5 if i % 2 else rng.random() * 100,
        "edge": lambda i: 100.0 if i > n // 4 else float(i),
    }[kind]
    values = [make(i) for i in range(n)]
    data = [(v,) for v in values] + [(None,)] * 100
    df = spark.createDataFrame(data, "v double").repartition(4)
    found = q.exact_quantiles(df, ["v"], SHARES, max_distinct)["v"]
    assert found == pytest.approx(list(np.quantile(values, SHARES)), rel=1e-12)


def test_empty_and_null(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert q.exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [1.0]}
    assert q.exact_quantiles(df.limit(0), ["a"], [0.5]) == {"a": [None]}
    assert q.exact_quantiles(df, [], [0.5]) == {}


def test_approximate(spark):
    df = spark.range(100_000).selectExpr("cast(id as double) as v")
    assert q.quantiles(df, ["v"], [0.5], exact=False)["v"][0] == pytest.approx(50_000, abs=100)
