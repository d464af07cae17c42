import numpy as np
import pytest

from quotelane.llm import neighbours

SCHEMA = "vec_id long, embedding array<double>, score string, row string, v string"


def brute(rows, k):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for n, (i, v) in enumerate(usable):
        if i % 20:
            continue
        scores = sorted((-float(sum(a * b for a, b in zip(v, w))), j) for m, (j, w) in enumerate(usable)
                        if m != n and len(w) == len(v))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("tiles", [None, (4, 16, 8)])
def test_equals_brute_force(spark, monkeypatch, tiles):
    if tiles:
        for name, value in zip(("QUERY_TILE", "CANDIDATE_TILE", "STEP"), tiles):
            monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=5) * 10.0 ** rng.integers(-3, 4)).round(3).tolist()) for i in range(160)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, rows[0][1]), (20, rows[3][1])]  # ties, a repeated id
    rows += [(220, None), (221, []), (222, [0.0] * 5), (223, [1.0, None, 1.0, 1.0, 1.0]), (224, [float("nan")] * 5),
             (225, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (240, [1.0, 2.0]), (241, [2.0, 1.0]), (None, [1.0] * 5)]
    frame = spark.createDataFrame([(i, v, "s", "r", "v") for i, v in rows], SCHEMA)
    found = neighbours.nearest(frame, k=7)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, 7)


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(50, 1500)), rng.normal(size=(70, 1500))
    product, error = neighbours.bounded_products(*neighbours.quantised(x), *neighbours.quantised(y))
    assert (np.abs(product - x @ y.T) <= error).all() and (error < np.abs(x).sum() / 10).all()


def test_few_candidates_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0], "", "", ""), (1, [0.5, 1.0], "", "", "")], SCHEMA)
    assert [tuple(r) for r in neighbours.nearest(frame).collect()] == [(0, 1, 1, 0.5)]
    assert neighbours.nearest(frame.where("false")).collect() == []
    assert neighbours.nearest(frame.where("vec_id = 1")).collect() == []
