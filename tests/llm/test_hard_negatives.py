"""op11 against brute force in exact integers, its bounds and its cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.llm_tools import duck, rows
from panelcast.llm import hard_negatives as H, q_hard_negatives

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(table, is_anchor, positives=5, negatives=10):
    top = 2 ** 63 - 1
    good = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v in table
            if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for aid in sorted({r[0] for r in good if is_anchor(r[0])}):
        _, label, a = min((r for r in good if r[0] == aid), key=lambda r: r[1])
        scored = [(-max(-top, min(top, sum(x * y for x, y in zip(a, v)))), i, l) for i, l, v in good if i != aid]
        for ps, pid, _ in sorted(r for r in scored if r[2] == label)[:positives]:
            fit = sorted((s, i) for s, i, l in scored if l != label and 30 * -ps <= 100 * -s <= 90 * -ps)[:negatives]
            out += [(aid, pid, k + 1, i, -ps, -s) for k, (s, i) in enumerate(fit)]
    return sorted(out)


def result(df, **more):
    return sorted(tuple(r) for r in H.mine(df, F.col("vec_id") % 10 == 0, **more).collect())


def clustered(rng, n, dim=8, labels=4):
    centres = rng.normal(size=(labels, dim))
    return [(i, int(k), (centres[k] + 0.7 * rng.normal(size=dim)).astype(np.float32).tolist()) for i, k in enumerate(rng.integers(0, labels, n))]


@pytest.mark.parametrize("sizes", [(256, 16384, 65536), (7, 40, 9)])
def test_against_brute_force(spark, monkeypatch, sizes):
    for name, size in zip(("WINDOW", "SLICE", "GROUP"), sizes):
        monkeypatch.setattr(H, name, size)
    table = clustered(np.random.default_rng(1), 400)
    assert result(spark.createDataFrame(table, SCHEMA)) == brute(table, lambda i: i % 10 == 0)


def test_ties_repeats_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    table = clustered(rng, 60, dim=3) + [(100 + i, i % 2, [0.5, -0.25, 0.125]) for i in range(80)]  # one vector eighty times
    table += [table[3], table[70], (20, 0, [1.0, 1.0, 1.0]), (20, 3, [9.0, 1.0, 1.0])]
    table += [(200, 1, [0.0, 0.0, 0.0]), (201, 1, []), (202, 2, [1.0]), (203, 1, [0.1, None, 0.2]), (204, 1, [float("nan")] * 3), (205, 0, [float("inf"), 0.0, 0.0]),
              (206, None, [1.0, 1.0, 1.0]), (None, 1, [1.0, 1.0, 1.0]), (207, 1, None), (210, 2, [-1e-30, 0.4, 0.4]), (-10, 0, [-0.3, 0.2, 0.1])]
    frame = spark.createDataFrame(table, SCHEMA).selectExpr("*", "1 AS packed", "2 AS near", "'x' AS vector", "3 AS g", "4 AS s", "5 AS no")
    table = [(i, l, v) for i, l, v in table]
    # the repeated anchor 20 is taken once, with its least label and vector
    assert result(frame) == brute(table, lambda i: i % 10 == 0)


def test_large_components_stay_exact(spark):
    rng = random.Random(3)
    table = [(i, i % 3, [rng.uniform(-1, 1) * 10.0 ** rng.choice([0, 6, 7, 12]) for _ in range(5)]) for i in range(90)]
    frame = spark.createDataFrame(table, "vec_id long, label int, embedding array<double>")
    assert result(frame) == brute(table, lambda i: i % 10 == 0)


def test_empty_and_lonely_tables(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []
    assert result(spark.createDataFrame([(10, 1, [1.0, 2.0])], SCHEMA)) == []
    assert result(spark.createDataFrame([(10, 1, [1.0]), (11, 1, [1.0]), (20, 2, None)], SCHEMA)) == []


def test_bounds_hold_and_leave_windows_out():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 16)) * 300
    m = np.floor(np.concatenate([c + 20 * rng.normal(size=(64, 16)) for c in centres]))
    refs = H.directions(m)
    norm, angle = H.angles(m, refs)
    bounds = np.stack([np.concatenate([[norm[a:a + 64].min(), norm[a:a + 64].max()], angle[a:a + 64].min(0), angle[a:a + 64].max(0)]) for a in range(0, len(m), 64)])
    low, high = H.score_bounds(norm, angle, bounds)
    score = (m @ m.T).reshape(len(m), -1, 64)
    assert (score.max(2) <= high).all() and (score.min(2) >= low).all()
    own = np.repeat(np.arange(6), 64)
    best = score.max((1, 2))
    assert (high < 0.9 * best[:, None])[own[:, None] != np.arange(6)].mean() > 0.5  # most other clusters need no scoring


def test_query_matches_sql_on_moved_labels(spark, sf):
    table = [(i, int(l), v) for i, l, v in clustered(np.random.default_rng(6), 350, labels=3)]
    folder = sf(embeddings=spark.createDataFrame(table, SCHEMA))
    got = q_hard_negatives.op11(spark, folder).toPandas()
    assert len(got) and rows(got) == rows(duck(q_hard_negatives.SQL, folder))
