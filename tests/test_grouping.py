"""Grouping sets, top rows, percentiles, sketches, frames and snapshot differences: brute force, hot groups, plans."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from test_plans import FORBIDDEN, plan
from vulnlake import operators as op
from vulnlake.operators import grouping


def test_grouping_sets_tell_null_groups_from_totals(spark):
    rows = [(1, "x", 5), (1, None, 7), (None, None, 1), (2, "x", 2), (2, "x", 3)]
    df = spark.createDataFrame(rows, "a int, b string, v int")
    got = Counter((r.a, r.b, r.set_id, r.n, r.total) for r in op.cube(df, ["a", "b"], F.count(F.lit(1)).alias("n"), F.sum("v").alias("total")).collect())
    want = Counter()
    for keep in ((0, 1), (0,), (1,), ()):
        groups = defaultdict(list)
        for r in rows:
            groups[tuple(r[k] if k in keep else None for k in (0, 1))].append(r[2])
        set_id = sum(1 << k for k in (0, 1) if k not in keep)
        want.update((*g, set_id, len(v), sum(v)) for g, v in groups.items())
    assert got == want
    text = plan(op.grouping_sets(df, [["a", "b"], []], F.count(F.lit(1)).alias("n")))
    assert "Expand" in text and not any(f in text for f in FORBIDDEN)
    assert [(r.set_id, r.n) for r in op.grouping_sets(df, [["a"], []], F.count(F.lit(1)).alias("n")).where("set_id = 1").collect()] == [(1, 5)]


def test_top_per_group_limits_before_the_shuffle(spark):
    hot = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string")))
    df = spark.range(0, 9000, numPartitions=6).select(hot.alias("g"), (F.col("id") * 7919 % 9001).alias("v"))
    top = op.top_per_group(df, ["g"], [F.desc("v")], 4)
    text = plan(top)
    assert len(re.findall(r"^\(\d+\) WindowGroupLimit", text, re.M)) == 2  # each task's own before the exchange, and behind it
    groups = defaultdict(list)
    for r in df.collect():
        groups[r.g].append(r.v)
    want = {(g, k + 1, v) for g, vs in groups.items() for k, v in enumerate(sorted(vs, reverse=True)[:4])}
    assert {(r.g, r["rank"], r.v) for r in top.collect()} == want


@pytest.mark.parametrize("seed,slices", [(0, 1), (1, 5), (2, 40)])
def test_percentiles_equal_brute_force(spark, seed, slices):
    rng = random.Random(seed)
    rows = [(rng.choices(["hot", None, "a", "b"], [6, 1, 2, 2])[0], rng.choice([None, *[rng.choice([rng.random(), rng.randrange(4)])] * 20])) for _ in range(800)]
    rows += [("one", 3.5), ("none", None)]
    shares = [0.0, 0.1, 0.25, 0.5, 2 / 3, 0.99, 1.0]
    df = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in rows], "g string, v double")
    groups = defaultdict(list)
    for g, v in rows:
        if v is not None:
            groups[g].append(float(v))
    want = {(g, p, sorted(vs)[max(1, len(vs) - math.floor(len(vs) - p * len(vs))) - 1], len(vs)) for g, vs in groups.items() for p in shares}
    assert {(r.g, r.share, r.value, r.n) for r in op.exact_percentiles(df, ["g"], "v", shares, slices=slices).collect()} == want
    whole = op.exact_percentiles(df, [], "v", [0.5], slices=slices).collect()
    every = sorted(v for vs in groups.values() for v in vs)
    assert [(r.value, r.n) for r in whole] == [(every[math.ceil(len(every) / 2) - 1], len(every))]
    assert op.exact_percentiles(df.limit(0), ["g"], "v", [0.5]).count() == 0


def test_a_hot_group_of_distinct_values_is_cut_into_slices(spark, tmp_dir, monkeypatch):
    df = spark.range(0, 6000, numPartitions=4).select(F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 9).cast("string")).alias("g"), F.col("id").alias("v"))
    monkeypatch.setattr(grouping, "scratch_path", lambda s, label: f"{tmp_dir}/{label}")
    out = op.exact_percentiles(df, ["g"], "v", [0.5], slices=12)
    rows = spark.read.parquet(f"{tmp_dir}/histogram").groupBy("g", "_slice").count().collect()
    assert len({r["_slice"] for r in rows if r.g == "hot"}) >= 6 and max(r["count"] for r in rows) < 1500
    assert not any(f in plan(out) for f in FORBIDDEN) and out.count() == 4


def test_sketches_unite_to_the_sketch_of_all(spark):
    df = spark.range(0, 60000, numPartitions=4).select((F.col("id") % 20).cast("int").alias("day"), (F.col("id") * 31 % 17000).alias("k"))
    daily = op.distinct_sketches(df, ["day"], "k")
    total = op.united_distinct(daily).first()
    assert total.n_rows == 60000 and abs(total.estimate - 17000) <= grouping.SKETCH_ERROR * 17000
    some = op.united_distinct(daily.where("day < 7"), [(F.col("day") % 2).alias("odd")]).collect()
    for r in some:
        exact = df.where(f"day < 7 and day % 2 = {r.odd}").select("k").distinct().count()
        assert abs(r.estimate - exact) <= grouping.SKETCH_ERROR * exact + 1
    assert daily.count() == 20 and op.united_distinct(daily.limit(0)).first().estimate == 0


def test_moving_ranges_and_gaps(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), None if rng.random() < 0.05 else date(2024, 1, 1) + timedelta(rng.randrange(120)), rng.choice([None, 1.0, 2.0]))
            for _ in range(150)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    daily = op.daily_rows(df, "d", ["k"], value="v")
    got = {(r.k, r.day): r for r in op.activity_gaps(op.moving_average(daily, 30, ["k"]), ["k"]).collect()}
    n = Counter((k, d) for k, d, _ in rows if d is not None)
    assert set(got) == set(n)
    for (k, d), r in got.items():
        near = [(e, c) for (g, e), c in n.items() if g == k and 0 <= (d - e).days < 30]
        before, after = max((e for g, e in n if g == k and e < d), default=None), min((e for g, e in n if g == k and e > d), default=None)
        assert (r.n_rows, r.rows_in_range, r.active_days) == (n[k, d], sum(c for _, c in near), len(near)) and r.rows_per_day == r.rows_in_range / 30
        assert r.days_since == (None if before is None else (d - before).days) and r.days_until == (None if after is None else (after - d).days)
        assert r.change == (None if before is None else n[k, d] - n[k, before])
        assert r.n_values == sum(1 for g, e, v in rows if (g, e) == (k, d) and v is not None)


def test_snapshot_differences_of_many_rows_nulls_and_hot_keys(spark):
    shape = "k string, a string, b string"
    old = [("same", "1", None), ("swapped", None, "1"), ("twice", "1", "1"), ("twice", "1", "1"), ("gone", "x", "x"), (None, "n", "n"), ("order", "1", "2"), ("order", "3", "4")]
    new = [("same", "1", None), ("swapped", "1", None), ("twice", "1", "1"), ("new", None, None), (None, "n", "m"), ("order", "3", "4"), ("order", "1", "2")]
    hot = [("hot", str(k), "h") for k in range(3000)]
    odf, ndf = spark.createDataFrame(old + hot, shape), spark.createDataFrame(new + hot[::-1], shape)
    diff = op.snapshot_diff(odf, ndf, "k")
    assert {(r.k, r.change, r.rows_before, r.rows_after) for r in diff.collect()} == {
        ("swapped", "changed", 1, 1), ("twice", "changed", 2, 1), ("gone", "removed", 1, 0), ("new", "added", 0, 1), (None, "changed", 1, 1)}
    text = diff._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in text and "partial_sum" in text
    assert op.snapshot_diff(odf, odf, "k").count() == 0 and op.snapshot_diff(odf.limit(0), ndf, "k").where("change <> 'added'").count() == 0
    assert op.snapshot_diff(odf, ndf, "k", compare=["a"]).where("k = 'same'").count() == 0
