import math

import numpy as np
import pytest

from changeloom.llm import topk


def plain(rows: list[tuple], k: int, every: int) -> list[tuple]:
    used = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, q) in enumerate(used):
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for n, (j, v) in enumerate(used) if n != at and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def got(vectors, **options) -> list[tuple]:
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(vectors, **options).collect())


@pytest.mark.parametrize("block", [7, 1000])
def test_agrees_with_all_products(spark, block, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(0, 0.3, 9).astype(np.float32).astype(float).tolist()) for k in range(260)]
    rows += [(400 + k, rows[50][1]) for k in range(30)]  # one vector many times
    rows += [(10, rows[3][1]), (10, rows[3][1])]  # repeated rows
    rows += [(500, None), (510, []), (520, []), (530, [1.0] * 4), (531, [-3.0, 900.5, 0.0, 1e-9]), (540, [0.1, None] + [0.0] * 7)]
    rows += [(550, [math.nan] + [0.0] * 8), (560, [math.inf] + [0.0] * 8), (None, [0.5] * 9), (570, [0.0] * 9)]
    docs = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    original = topk.index
    monkeypatch.setattr(topk, "index", lambda v, **o: original(v, **o | {"block_rows": block}))
    rows = [(r["vec_id"], r["embedding"]) for r in docs.collect()]
    assert got(docs, every=10) == plain(rows, 5, 10)


def test_fewer_rows_than_asked_for(spark):
    docs = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, -1.0])], "vec_id long, embedding array<double>")
    assert got(docs) == [(0, 1, 1, 256 * 256)]
    assert got(docs.filter("vec_id = 0")) == [] and got(docs.limit(0)) == []


def test_sums_of_bitmaps_are_the_products():
    rng = np.random.default_rng(1)
    values, queries = rng.integers(-300, 300, (130, 5)), rng.integers(-70, 70, (6, 5))
    queries[0] = 0
    sums, base = topk.add_up(*topk.slices_of(values), queries)
    total = sum(topk.unpack(s)[:, :130].astype(np.int64) << w for w, s in enumerate(sums)) + base[:, None]
    assert (total == queries @ values.T).all()


def test_vectors_with_huge_components_take_part(spark):
    rng = np.random.default_rng(6)
    rows = [(k, rng.normal(0, 3, 3).tolist()) for k in range(60)]
    huge = [[float(1 << 20), 0.0, 1.0], [-3e6, 0.5, 2e6], [2.0**21, 2.0**21, 0.25], [2.0**21, 2.0**21, 0.25], [5.5e6, 1.0, -7e6]]
    rows += [(i, v) for i, v in zip((100, 110, 101, 101, 103), huge, strict=True)] + [(120, [4e6, 1.0]), (7, [-4e6, 0.0, 0.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(docs, every=10) == plain(rows, 5, 10)
    assert got(docs.filter("vec_id >= 100"), every=10) == plain([r for r in rows if r[0] >= 100], 5, 10)


def test_many_dimensions_do_not_overflow(spark):
    rows = [(k, [1e6 if k % 2 else -1e6] * 400) for k in range(4)]
    with pytest.raises(Exception, match="64 bits"):
        got(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=2)
    small = [(k, [3e5 * (1 + k)] * 200) for k in range(3)]
    assert got(spark.createDataFrame(small, "vec_id long, embedding array<double>"), every=2) == plain(small, 5, 2)
