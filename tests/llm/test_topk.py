import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from playmart.llm import topk
from tests.conftest import tuples

DDL = "vec_id bigint, embedding array<double>"


def brute(rows, k, asked):
    ok = [(i, [int(np.floor(256 * c)) for c in v]) for i, v in rows
          if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for at, (q, x) in enumerate(ok):
        if q is None or not asked(q):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(x, y)), i is None, i or 0, i)
                         for other, (i, y) in enumerate(ok) if other != at))
        out += [(q, r, i, -s) for r, (s, _, _, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def found(spark, rows, k=5, lists=2, step=3):
    df = spark.createDataFrame(rows, DDL)
    got = topk.search(df, F.col("vec_id") % step == 0, k, lists=lists)
    return sorted(tuples(got, "query_id", "rank", "vec_id", "score"), key=str)


@pytest.mark.parametrize("lists", [1, 2, 3, 8, 50])
def test_equals_brute_force(spark, lists):
    rng = random.Random(lists)
    rows = [(k, [rng.gauss(0, 1) for _ in range(8)]) for k in range(120)]
    rows += [(200 + k, [rng.gauss(-3, 1) for _ in range(8)]) for k in range(60)]  # negative scores
    rows += [(300 + k, [0.5] * 8) for k in range(90)]                             # ties
    assert found(spark, rows, lists=lists) == brute(rows, 5, lambda q: q % 3 == 0)


def test_cells_of_many_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(topk, "ASKED", 7)
    monkeypatch.setattr(topk, "HELD", 11)
    rng = random.Random(4)
    rows = [(k, [float(rng.randrange(-2, 3)) for _ in range(5)]) for k in range(150)]
    assert found(spark, rows, k=4) == brute(rows, 4, lambda q: q % 3 == 0)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(3, [1.0, 2.0]), (3, [1.0, 2.0]), (None, [1.0, 2.0]), (6, None), (9, [nan, 0.0]),
            (12, [inf, 0.0]), (15, [None, 0.0]), (18, [2.0]), (21, []), (1, [-1.0, -1.0]),
            (3, [5.0, 5.0])]
    assert found(spark, rows) == brute(rows, 5, lambda q: q % 3 == 0)
    assert found(spark, rows, k=50) == brute(rows, 50, lambda q: q % 3 == 0)
    one = spark.createDataFrame([(0, [1.0], 1, 2)], DDL + ", score int, q int")
    assert topk.search(one, F.col("vec_id") == 0).count() == 0     # no other row
    assert topk.search(one.limit(0), F.col("vec_id") == 0).count() == 0
    none = spark.createDataFrame([(1, [1.0]), (2, [2.0])], DDL)
    assert topk.search(none, F.col("vec_id") % 50 == 0).count() == 0


def test_large_components_are_exact(spark):
    rows = [(k, [float(k * 10**5 + 1), 1.0, float(7 * k)]) for k in range(40)]
    assert found(spark, rows) == brute(rows, 5, lambda q: q % 3 == 0)


def test_cutoff_collects_few_entries_and_loses_none():
    """What reaches a bound reaches its share in a list, whatever the signs."""
    rng = np.random.default_rng(0)
    parts = rng.integers(-1000, 1000, (3, 5, 4000))
    total = parts.sum(0)
    bound = np.sort(total, axis=1)[:, -6]
    import pyarrow as pa
    seen = set()
    for lst in parts:
        pick = topk.reaching(3)(pa.chunked_array([pa.array(bound)]), [(0, lst)])
        for q, c, s in pick:
            seen |= set(zip(q.tolist(), c.tolist()))
    for q in range(5):
        assert all((q, c) in seen for c in np.flatnonzero(total[q] >= bound[q]))
