"""Tumbling counts of a stream: several batches equal the batch result, late rows stay out, restarts repeat nothing."""

from __future__ import annotations

import glob
import os
from datetime import datetime, timedelta

from vulnlake.streaming import read_window_counts, run_available, start_window_counts, tumbling_counts

T0 = datetime(2024, 1, 1)
SHAPE = "id long, ts timestamp, kind string, v long"


def rows(spark, *specs):
    return spark.createDataFrame([(i, None if m is None else T0 + timedelta(minutes=m), k, i) for i, m, k in specs], SHAPE)


def counts(df):
    return tumbling_counts(df, "ts", "10 minutes", "30 minutes", keys=["kind"], id="id", sums=["v"])


def run(spark, root, *loads, max_files=None):
    for load in loads:
        load.coalesce(1).write.mode("append").parquet(f"{root}/src")
    reader = spark.readStream.schema(SHAPE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    run_available([start_window_counts(counts(reader.parquet(f"{root}/src")), f"{root}/out", f"{root}/ckpt")])
    return state(read_window_counts(spark, f"{root}/out", ["kind"]))


def state(df):
    return {((r.window_start - T0).total_seconds() // 60, r.kind): (r.n_rows, r.sum_v) for r in df.collect()}


def loads(spark):
    return [rows(spark, *[(i, i, "ab"[i % 2]) for i in range(40)], (900, None, "a")),
            rows(spark, *[(i, i, "ab"[i % 2]) for i in range(30, 80)]),  # ids 30-39 once more, within the watermark
            rows(spark, *[(i, i, "ab"[i % 2]) for i in range(80, 120)], (1000, 55, "a"))]  # 55: behind the end, not the watermark


def test_batches_equal_the_batch_result(spark, tmp_dir):
    parts = loads(spark)
    got = run(spark, tmp_dir, *parts, max_files=1)
    assert got == state(counts(parts[0].union(parts[1]).union(parts[2])))
    assert sum(n for n, _ in got.values()) == 121
    batches = glob.glob(f"{tmp_dir}/out/batch=*")
    assert len(batches) >= 3  # it did run in several batches


def test_late_rows_are_left_out(spark, tmp_dir):
    parts = loads(spark)
    run(spark, tmp_dir, *parts[:2])
    got = run(spark, tmp_dir, parts[2])
    late = run(spark, tmp_dir, rows(spark, (2000, 5, "a"), (2001, 119, "a")))  # the watermark stands at 89 minutes
    got[(110, "a")] = (got[(110, "a")][0] + 1, got[(110, "a")][1] + 2001)
    assert late == got


def test_a_restart_from_the_checkpoint_repeats_nothing(spark, tmp_dir):
    parts = loads(spark)
    first = run(spark, tmp_dir, parts[0])
    assert run(spark, tmp_dir) == first  # nothing new
    run(spark, tmp_dir, parts[1])
    whole = run(spark, tmp_dir, parts[2])
    assert whole == state(counts(parts[0].union(parts[1]).union(parts[2])))
    # as if the last batch had failed before its commit was noted: it runs again and replaces its folder
    commits = sorted(f for f in os.listdir(f"{tmp_dir}/ckpt/commits") if f.isdigit())
    for name in (commits[-1], f".{commits[-1]}.crc"):
        if os.path.exists(f"{tmp_dir}/ckpt/commits/{name}"):
            os.unlink(f"{tmp_dir}/ckpt/commits/{name}")
    assert run(spark, tmp_dir) == whole
