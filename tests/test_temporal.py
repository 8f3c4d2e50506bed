"""As-of join, interval join and sessions against brute force, with a hot key and edge rows; their plans."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from test_plans import FORBIDDEN, plan
from test_skew import final_plan, small_skewed_partitions
from vulnlake import operators as op
from vulnlake.operators import temporal

T0 = datetime(2024, 1, 1)
BIG = 40 * 86400


def at(seconds):
    return None if seconds is None else T0 + timedelta(seconds=seconds)


def frames(spark, seed, n=600):
    """Left and right rows; key ``hot`` has a third of each, many times tie, some keys and times are NULL."""
    rng = random.Random(seed)
    key = lambda: rng.choices(["hot", None, *"abcdefgh"], [10, 1, *[2] * 8])[0]
    time = lambda: rng.choices([rng.randrange(0, 400) * 600, None, rng.randrange(BIG)], [10, 1, 5])[0]
    left = [(i, key(), time()) for i in range(n)]
    right = [(key(), time(), rng.choice([None, 1.0, 2.5, 7.0]), i % 7) for i in range(n)]
    return (left, right, spark.createDataFrame([(i, k, at(t)) for i, k, t in left], "id int, k string, t timestamp"),
            spark.createDataFrame([(k, at(t), s, m) for k, t, s, m in right], "k string, since timestamp, score double, m int"))


def brute_asof(left, right):
    low = lambda v: (v is not None, v or 0)  # noqa: E731  NULL is the smallest
    out = []
    for i, k, t in left:
        fit = [] if k is None or t is None else [(u, low(s), m, s) for rk, u, s, m in right if rk == k and u is not None and u <= t]
        u, _, m, s = max(fit, default=(None, 0, None, None), key=lambda x: x[:3])
        out.append((i, k, at(t), at(u), s, m))
    return Counter(out)


@pytest.mark.parametrize("seed,slices", [(0, 1), (1, 4), (2, 37)])
def test_asof_equals_brute_force(spark, seed, slices):
    left, right, ldf, rdf = frames(spark, seed)
    want = brute_asof(left, right)
    got = op.asof_join(ldf, rdf, "k", "t", "since", slices=slices)
    assert got.columns == ["id", "k", "t", "since", "score", "m"]
    assert Counter(tuple(r) for r in got.collect()) == want
    inner = op.asof_join(ldf, rdf, "k", "t", "since", how="inner", slices=slices)
    assert Counter(tuple(r) for r in inner.collect()) == Counter({r: n for r, n in want.items() if r[3] is not None})


def test_asof_cuts_a_hot_key_into_slices(spark, tmp_dir, monkeypatch):
    _, _, ldf, rdf = frames(spark, 5, n=3000)
    monkeypatch.setattr(temporal, "scratch_path", lambda s, label: f"{tmp_dir}/{label}")
    text = plan(op.asof_join(ldf, rdf, "k", "t", "since", slices=12))
    assert not any(f in text for f in FORBIDDEN)
    rows = spark.read.parquet(f"{tmp_dir}/asof").groupBy("_k0", "_slice").count().collect()
    total = sum(r["count"] for r in rows)
    assert len({r["_slice"] for r in rows if r["_k0"] == "hot"}) >= 4
    assert max(r["count"] for r in rows) <= 3 * total / 12


def test_asof_cuts_a_hot_time_into_slices(spark, tmp_dir, monkeypatch):
    """All rows of one key at one time: the right ones still come before every left one."""
    ldf = spark.range(2000).select(F.col("id"), F.lit("k").alias("k"), F.lit(T0).alias("t"))
    rdf = spark.range(2000).select(F.lit("k").alias("k"), F.lit(T0).alias("since"), F.col("id").alias("v"))
    monkeypatch.setattr(temporal, "scratch_path", lambda s, label: f"{tmp_dir}/{label}")
    assert {r.v for r in op.asof_join(ldf, rdf, "k", "t", "since", slices=8).collect()} == {1999}
    assert spark.read.parquet(f"{tmp_dir}/asof").select("_slice").distinct().count() >= 6


@pytest.mark.parametrize("first", [0, 7, 1000])
def test_asof_takes_the_largest_of_a_time_from_earlier_slices(spark, first):
    """The middle one of three slices has right and left rows of the time; the largest right row may lie before it."""
    ldf = spark.range(900).select(F.col("id"), F.lit("k").alias("k"), F.lit(T0).alias("t"))
    rdf = spark.range(first, first + 900).select(F.lit("k").alias("k"), F.lit(T0).alias("since"), F.col("id").alias("v"))
    assert {r.v for r in op.asof_join(ldf, rdf, "k", "t", "since", slices=3).collect()} == {first + 899}


def test_asof_empty_sides_and_clashes(spark):
    _, _, ldf, rdf = frames(spark, 3, n=20)
    assert {r.score for r in op.asof_join(ldf, rdf.limit(0), "k", "t", "since").collect()} == {None}
    assert op.asof_join(ldf.limit(0), rdf, "k", "t", "since").count() == 0
    with pytest.raises(ValueError, match="both sides: id"):
        op.asof_join(ldf, rdf.withColumn("id", F.lit(1)), "k", "t", "since")


def interval_frames(spark, seed, n=400):
    rng = random.Random(seed)
    key = lambda: rng.choices(["hot", None, *"abcd"], [4, 1, *[2] * 4])[0]
    points = [(i, key(), rng.choice([None, *[rng.randrange(BIG)] * 9])) for i in range(n)]
    spans = []
    for j in range(n):
        a = rng.choice([None, *[rng.randrange(BIG)] * 9])
        length = rng.choice([0, 1, 60, 3600, 86400, 20 * 86400, -5])
        spans.append((j, key(), a, None if a is None or j % 17 == 0 else a + length))
    spans += [(n + i, k, t, t) for i, k, t in points[:20]]  # bounds count
    return (points, spans, spark.createDataFrame([(i, k, at(t)) for i, k, t in points], "id int, k string, t timestamp"),
            spark.createDataFrame([(j, k, at(a), at(z)) for j, k, a, z in spans], "span int, k string, a timestamp, z timestamp"))


@pytest.mark.parametrize("seed", range(2))
def test_interval_join_equals_brute_force(spark, seed):
    points, spans, pdf, sdf = interval_frames(spark, seed)
    inside = [(i, k, j, sk) for i, k, t in points for j, sk, a, z in spans if None not in (t, a, z) and a <= t <= z]
    got = op.interval_join(pdf, sdf, "t", "a", "z", on="k")
    assert Counter((r.id, r.span) for r in got.collect()) == Counter((i, j) for i, k, j, sk in inside if k is not None and k == sk)
    free = op.interval_join(pdf.drop("k"), sdf.drop("k"), "t", "a", "z")
    assert Counter((r.id, r.span) for r in free.collect()) == Counter((i, j) for i, _, j, _ in inside)


def test_interval_join_is_an_equi_join_and_splits_a_hot_bucket(spark):
    j = F.col("id")
    points = spark.range(0, 30000, numPartitions=8).select(j, F.timestamp_seconds(F.when(j % 5 > 0, 1_700_000_000).otherwise(1_600_000_000 + j * 977)).alias("t"))
    spans = spark.range(0, 200).select(j.alias("span"), F.timestamp_seconds(1_600_000_000 + j * 140_000).alias("a"),
                                       F.timestamp_seconds(1_600_000_000 + j * 140_000 + 3600).alias("z"))
    spans = spans.unionByName(spark.createDataFrame([(999, "2023-11-14 22:13:20", "2023-11-14 22:13:20")], "span long, a string, z string").select(
        "span", F.col("a").cast("timestamp").alias("a"), F.col("z").cast("timestamp").alias("z")))
    with small_skewed_partitions(spark):
        df = op.interval_join(points, spans, "t", "a", "z")
        counts = Counter(r.span for r in df.collect())
        text = final_plan(df)
    assert counts[999] == 24000 and "skew=true" in text and "SortMergeJoin" in text and not any(f in text for f in FORBIDDEN)


def test_interval_join_of_empty_sides(spark):
    _, _, pdf, sdf = interval_frames(spark, 0, n=30)
    assert op.interval_join(pdf, sdf.limit(0), "t", "a", "z", on="k").count() == 0
    assert op.interval_join(pdf.limit(0), sdf, "t", "a", "z", on="k").count() == 0


def brute_sessions(rows, gap):
    out, by = [], {}
    for k, t, v in rows:
        if t is not None:
            by.setdefault(k, []).append((t, v))
    for k, own in by.items():
        own.sort()
        run = [own[0]]
        for x in own[1:]:
            if x[0] - run[-1][0] > gap:
                out.append((k, run))
                run = []
            run.append(x)
        out.append((k, run))
    return Counter((k, at(r[0][0]), at(r[-1][0]), at(r[-1][0] + gap), len(r), sum(v for _, v in r)) for k, r in out)


@pytest.mark.parametrize("seed,gap,per_slice", [(0, 600, 4096), (1, 7200, 3), (2, 86400, 1)])
def test_sessions_equal_brute_force_and_sparks_own(spark, monkeypatch, seed, gap, per_slice):
    monkeypatch.setattr(temporal, "SLICE_BUCKETS", per_slice)
    rng = random.Random(seed)
    rows = [(rng.choices(["hot", None, "a", "b"], [3, 1, 2, 2])[0], rng.choice([None, *[rng.randrange(BIG // 20) * rng.choice([1, 20])] * 9]), rng.randrange(5))
            for _ in range(700)]
    rows += [("edge", t, 1) for t in (0, gap, 2 * gap + 1, 4 * gap, 5 * gap)]  # exactly the gap apart: one session
    df = spark.createDataFrame([(k, at(t), v) for k, t, v in rows], "k string, t timestamp, v int")
    got = op.sessions(df, "k", "t", gap, sums=["v"])
    assert Counter(tuple(r) for r in got.collect()) == brute_sessions(rows, gap)
    own = df.groupBy("k", F.session_window("t", f"{gap} seconds").alias("w")).count().select("k", "w.start", "w.end", "count")
    assert Counter(tuple(r) for r in got.select("k", "session_start", "session_end", "n_rows").collect()) == Counter(tuple(r) for r in own.collect())
    assert op.sessions(df.limit(0), "k", "t", gap).count() == 0


def test_sessions_collapse_rows_before_the_shuffle(spark):
    df = spark.range(0, 50000, numPartitions=4).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") % 1000).alias("t"))
    out = op.sessions(df, "k", "t", 3600)
    text = plan(out)
    assert out.collect()[0].n_rows == 50000 and not any(f in text for f in FORBIDDEN)
    assert "partial_min" in text and "session_window" not in text


@pytest.mark.parametrize("seed", range(3))
def test_interval_totals_equal_the_grouped_pairs(spark, seed):
    """Repeated and NULL groups, keys and times, backward intervals, odd numbers; no pair is made for them."""
    rng = random.Random(seed)
    when = lambda: rng.choice([None] + [f"2024-01-01 00:00:{s:02d}" for s in range(30)])
    key = lambda: rng.choice(["a", "a", "b", None])
    odd = [None, 1.0, 2.0, -3.0] + [float("nan"), float("inf"), float("-inf")] * (seed > 0)
    points = spark.createDataFrame([(key(), when(), rng.choice(odd), rng.choice([None, 1, 5])) for _ in range(120)],
                                   "k string, t string, x double, y int").withColumn("t", F.to_timestamp("t"))
    spans = spark.createDataFrame([(key(), rng.choice([1, 2, 3, 4, 5, None]), when(), when()) for _ in range(40)], "k string, id int, a string, z string")
    spans = spans.withColumns({"a": F.to_timestamp("a"), "z": F.to_timestamp("z")})
    for on in ("k", ()):
        p, s = (points, spans) if on else (points.drop("k"), spans.drop("k"))
        pairs = op.interval_join(p, s, "t", "a", "z", on=on)
        want = pairs.groupBy("id").agg(F.count(F.lit(1)).alias("n_pairs"), F.sum("x").alias("sum_x"), F.sum("y").alias("sum_y"), F.min("t").alias("first_t"))
        got = op.interval_join(p, s, "t", "a", "z", on=on, by="id", sums=["x", "y"])
        assert got.dtypes == want.dtypes
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) != []
    assert "_until" not in got.columns and op.interval_join(points.limit(0), spans, "t", "a", "z", on="k", by="id").count() == 0


def test_interval_totals_do_not_grow_with_the_pairs(spark):
    """Every point lies in every interval: two million pairs, and no operator passes on more rows than both sides have."""
    n, m = 2000, 1000
    points = spark.range(n).select(F.timestamp_seconds(F.col("id") + 1000).alias("t"))
    spans = spark.range(m).select("id", F.timestamp_seconds(F.lit(0)).alias("a"), F.timestamp_seconds(F.lit(9999)).alias("z"))
    got = op.interval_join(points, spans, "t", "a", "z", by="id")
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" not in text and "_level" not in text
    assert {(r.n_pairs, r.first_t.timestamp()) for r in got.collect()} == {(n, 1000.0)} and got.count() == m
