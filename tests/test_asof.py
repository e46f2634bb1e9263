"""Nearest-match join and sketches against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelcast.functions import sketches as SK
from panelcast.functions.quantiles import exact_quantiles
from panelcast.operators.asof import nearest_match

D0 = dt.date(2015, 1, 1)
LEFT, RIGHT = "k int, j string, d date, row int", "k int, j string, e date, id int, note string"


def brute(left, right, direction, tolerance):
    out = []
    for k, j, d, row in left:
        best = None
        for rk, rj, e, i, note in right:
            if None in (k, j, d, rk, rj, e) or (k, j) != (rk, rj):
                continue
            days = (e - d).days
            if direction == "backward" and days > 0 or direction == "forward" and days < 0 or tolerance is not None and abs(days) > tolerance:
                continue
            best = min(best or (10 ** 9,), (abs(days), i, e, note, days))
        out.append((row, *((best[2], best[1], best[3], best[4]) if best else (None,) * 4)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("direction", ["nearest", "backward", "forward"])
@pytest.mark.parametrize("tolerance, bucket", [(None, 364), (20, 7), (None, 1)])
def test_against_brute_force(spark, direction, tolerance, bucket):
    rng = random.Random(f"{direction}{tolerance}{bucket}")
    day = lambda span: D0 + dt.timedelta(days=rng.randrange(-span, span))
    key = lambda: (0 if rng.random() < 0.6 else rng.choice([1, 2, None]), rng.choice("ab") if rng.random() < 0.95 else None)
    left = [(*key(), day(300) if rng.random() < 0.95 else None, n) for n in range(250)]
    right = [(*key(), day(260) if rng.random() < 0.95 else None, n, f"n{n % 7}") for n in rng.sample(range(1000), 90)]
    got = nearest_match(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT).repartition(5), ["k", "j"], "d", "e", ["e", "id", "note"],
                        tie="id", direction=direction, tolerance_days=tolerance, bucket_days=bucket)
    assert got.columns == ["k", "j", "d", "row", "e", "id", "note", "days"]
    assert sorted([(r["row"], r["e"], r["id"], r["note"], r["days"]) for r in got.collect()], key=repr) == brute(left, right, direction, tolerance)


def test_repeated_left_rows_empty_sides_and_clashes(spark):
    left = spark.createDataFrame([(1, "a", D0, 1)] * 3, LEFT)
    right = spark.createDataFrame([(1, "a", D0, 5, "x"), (1, "a", D0, 4, "y")], RIGHT)
    got = nearest_match(left, right, ["k", "j"], "d", "e", ["id"], tie="id").collect()
    assert [(r["id"], r["days"]) for r in got] == [(4, 0)] * 3
    assert [r["id"] for r in nearest_match(left, right.limit(0), ["k", "j"], "d", "e", ["id"]).collect()] == [None] * 3
    assert nearest_match(left.limit(0), right, ["k", "j"], "d", "e", ["id"]).count() == 0
    with pytest.raises(ValueError):
        nearest_match(left, right, ["k"], "d", "e", ["j"])


def test_a_hot_key_is_split_by_time(spark):
    left = spark.range(40_000).select(F.lit(1).alias("k"), F.date_add(F.lit(D0), (F.col("id") % 4000).cast("int")).alias("d"), "id")
    right = spark.range(50).select(F.lit(1).alias("k"), F.date_add(F.lit(D0), (F.col("id") * 80).cast("int")).alias("e"))
    got = nearest_match(left, right, ["k"], "d", "e", ["e"], direction="backward", bucket_days=30)
    assert "hashpartitioning(_k0" in got._jdf.queryExecution().toString() and "_b" in got._jdf.queryExecution().toString()
    assert got.count() == 40_000 and got.filter(F.col("days") != -(F.datediff("d", F.lit(D0)) % 80)).count() == 0


def test_sketches_merge_within_the_stated_rank_error(spark):
    rng = random.Random(1)
    values = [rng.paretovariate(1.1) if rng.random() < 0.7 else 3.0 for _ in range(30_000)] + [None] * 50
    df = spark.createDataFrame([(i % 3, i % 40, v) for i, v in enumerate(values)], "g int, w int, v double")
    parts = SK.sketch_by(df, "v", ["g", "w"])
    for by, rows in ((["g"], [[v for i, v in enumerate(values) if i % 3 == g and v is not None] for g in range(3)]), ([], [[v for v in values if v is not None]])):
        got = SK.sketch_quantiles(SK.merge_sketches(parts, by), [0.0, 0.1, 0.5, 0.99, 1.0], by).collect()
        assert len(got) == 5 * len(rows)
        for r in got:
            own = rows[r["g"] if by else 0]
            below, upto = sum(v < r["value"] for v in own) / len(own), sum(v <= r["value"] for v in own) / len(own)
            assert r["n"] == len(own) and max(below - r["prob"], r["prob"] - upto) <= SK.rank_error()
    empty = SK.sketch_by(df.filter("v IS NULL"), "v", ["g"])
    assert {(r["value"], r["n"]) for r in SK.sketch_quantiles(empty, [0.5], ["g"]).collect()} == {(None, 0)}


def test_global_quantiles_need_no_join(spark):
    rng = random.Random(2)
    values = [rng.choice([rng.gauss(0, 1e6), 7.0, -1e-9]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, "v", [0.0, 0.3, 0.5, 0.99, 1.0], bins=16).collect()}
    own = sorted(values)
    for p, v in got.items():
        at = p * (len(own) - 1)
        low = int(at)
        want = own[low] + (at - low) * (own[min(low + 1, len(own) - 1)] - own[low])
        assert abs(v - want) <= 1e-9 * max(1, abs(want))
