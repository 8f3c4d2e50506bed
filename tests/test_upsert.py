"""Upsert: equals a full rebuild, repeats change nothing, untouched partitions keep their files."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from vulnlake.sources import latest_per_key, read_table, upsert_table

SHAPE = "cve_id string, data_year int, updated int, text string"


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}


def load(spark, rows):
    return spark.createDataFrame(rows, SHAPE)


def up(spark, path, rows):
    return upsert_table(spark, path, load(spark, rows), "cve_id", ["updated"], "data_year")


def rows_of(df):
    return sorted((r.cve_id, r.data_year, r.updated, r.text) for r in df.select("cve_id", "data_year", "updated", "text").collect())


def full_rebuild(deliveries):
    best = {}
    for row in deliveries:
        rank = (row[2] is not None, row[2] or 0, (row[1] is not None, row[1] or 0), row[3])
        if row[0] not in best or rank > best[row[0]][0]:
            best[row[0]] = rank, row
    return sorted(r for _, r in best.values())


@pytest.mark.parametrize("seed", range(2))
def test_loads_in_any_order_equal_a_full_rebuild(spark, tmp_dir, seed):
    """Versions come late, twice and under a hot key; those of one key differ, so that the winner is one row."""
    rng = random.Random(seed)
    deliveries = [(f"CVE-{y}-{n}", y, rng.choice([None, *range(50)]) if n else v, "x") for y in (2020, 2021, 2022) for n in range(8) for v in range(9)]
    deliveries = [(k, y, u, f"{k}@{u}") for k, y, u, _ in deliveries]
    rng.shuffle(deliveries)
    path, seen = f"{tmp_dir}/t", []
    for part in (deliveries[:90], deliveries[90:95], deliveries[95:], deliveries[:40]):
        up(spark, path, part)
        seen += part
        assert rows_of(read_table(spark, path)) == full_rebuild(seen)


def test_only_touched_partitions_are_rewritten(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    base = [(f"CVE-{y}-{n}", y, 1, "first") for y in (2020, 2021, 2022) for n in range(20)]
    assert up(spark, path, base) == {"inserted": 60, "updated": 0, "partitions": 3}
    before = files(path)
    done = up(spark, path, [("CVE-2021-3", 2021, 2, "second"), ("CVE-2021-99", 2021, 1, "new"), ("CVE-2022-5", 2022, 0, "older")])
    assert done == {"inserted": 1, "updated": 1, "partitions": 1}
    after = files(path)
    assert {f: t for f, t in before.items() if "2021" not in f.rsplit("/", 2)[1]} == {f: t for f, t in after.items() if "2021" not in f.rsplit("/", 2)[1]}
    assert not set(before) & {f for f in after if "data_year=2021" in f}
    got = {r[0]: r[3] for r in rows_of(read_table(spark, path))}
    assert (got["CVE-2021-3"], got["CVE-2021-99"], got["CVE-2022-5"], len(got)) == ("second", "new", "first", 61)


def test_the_same_changes_again_write_nothing(spark, tmp_dir):
    path, changes = f"{tmp_dir}/t", [("a", 2020, 5, "x"), ("b", None, None, "no year")]
    up(spark, path, changes)
    before = files(path)
    assert up(spark, path, changes) == {"inserted": 0, "updated": 0, "partitions": 0} and files(path) == before
    assert up(spark, path, [("b", None, 1, "dated")]) == {"inserted": 0, "updated": 1, "partitions": 1}
    assert rows_of(read_table(spark, path).fillna(0, ["data_year"])) == [("a", 2020, 5, "x"), ("b", 0, 1, "dated")]
    assert up(spark, path, []) == {"inserted": 0, "updated": 0, "partitions": 0}


def test_refused_changes_leave_the_table_alone(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    up(spark, path, [("a", 2020, 5, "x")])
    before = files(path)
    with pytest.raises(ValueError, match="another data_year"):
        up(spark, path, [("a", 2021, 6, "moved")])
    with pytest.raises(ValueError, match="without cve_id"):
        up(spark, path, [(None, 2021, 6, "lost")])
    with pytest.raises(ValueError, match="columns"):
        upsert_table(spark, path, load(spark, [("a", 2020, 6, "x")]).withColumn("more", F.lit(1)), "cve_id", ["updated"], "data_year")
    assert files(path) == before


def test_latest_per_key_ships_one_row_of_a_hot_key_per_task(spark):
    df = spark.range(0, 4000, numPartitions=4).select(F.lit("hot").alias("cve_id"), F.lit(2020).alias("data_year"),
                                                      F.col("id").cast("int").alias("updated"), F.lit("x").alias("text"))
    out = latest_per_key(df, "cve_id", ["updated"])
    assert [r.updated for r in out.collect()] == [3999]
    assert "partial_max" in out._jdf.queryExecution().toString()


def test_query_computes_its_records_once(spark, monkeypatch):
    """The first load and both repeats read stored records; what makes them runs once."""
    from vulnlake.plans import catalog

    sf, made = "/root/testdata/sf0.001", spark.sparkContext.accumulator(0)
    core = catalog.B.core_twin(spark, sf)

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    monkeypatch.setattr(catalog, "_core", lambda spark, d: core.mapInArrow(counted, core.schema))
    rows = catalog.QUERIES["u1_upsert_core"](spark, sf).count()
    assert rows == made.value == core.count()


def test_latest_rows_are_sorted_by_a_hash_of_the_key_first(spark):
    df = load(spark, [("CVE-2020-1", 2020, 1, "a"), ("CVE-2020-1", 2020, 2, "b"), (None, 2020, 1, "c")])
    best = latest_per_key(df, "cve_id", ["updated"])
    assert best.columns == df.columns and rows_of(best.where("cve_id is not null")) == [("CVE-2020-1", 2020, 2, "b")] and best.count() == 2
    assert "Sort [_groupingexpression" in best._jdf.queryExecution().executedPlan().toString()
