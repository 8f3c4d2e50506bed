from __future__ import annotations


import corpus_pipeline as cp
import pyarrow as pa
from pyspark.sql import functions as F
from test_decontaminate import brute_force as contaminated_rows
from test_near_dedup import brute_force as near_rows
from test_packing import check as check_packing
from tests_llm_tools import docs_of, table_rows  # noqa: F401
from tokenizers import Tokenizer
from vulnlake.llm.common import BATCH_ROWS, stored, table
from vulnlake.llm.packing import default_tokenizer
from vulnlake.llm.quality import classify
from vulnlake.llm.secret_ledger import find_secrets

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_every_stage_equals_brute_force_on_its_own_input(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    before = rows_of(docs)
    labels = dict(table_rows(SF, "labels", "doc_id, quality"))
    for name, stage in cp.STAGES[:-1]:
        out = stored(stage(spark, docs, SF), "test-stage")
        assert out.columns == columns
        after = rows_of(out)
        if name == "quality classifier":
            good = {r.doc_id for r in classify(docs, table(spark, SF, "labels")).collect() if r.predicted}
            assert after == [r for r in before if r[0] in good]
            assert all(labels.get(i) != 0 for i, _ in after)
        elif name == "near-dedup":
            kept = {r[0] for r in near_rows(before) if r[3]}
            assert after == [r for r in before if r[0] in kept]
        elif name == "benchmark decontamination":
            bad = {r[0] for r in contaminated_rows(before, table_rows(SF, "benchmark", "item_id, text")) if r[5]}
            assert bad and after == [r for r in before if r[0] not in bad]
        else:
            assert [i for i, _ in after] == [i for i, _ in before]
            for (_, a), (_, b) in zip(after, before):
                if find_secrets(b):
                    assert "[SECRET]" in a and not any(b[s:e] in a for _, s, e in find_secrets(b))
                else:
                    assert a == b
            assert all(r.n_chars == len(r.text) for r in out.collect())
        docs, before = out, after
    packed = cp.STAGES[-1][1](spark, docs, SF).collect()
    check_packing(packed, dict(before), Tokenizer.from_file(default_tokenizer()), 2048)
    whole = cp.run(spark, SF)
    assert sorted(map(tuple, whole.select("doc_id", "piece", "start", "length", "ids_crc32").collect())) == sorted(
        (r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)


def test_stages_take_nulls_copies_and_nothing(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (None, "no id password=abcdefgh1"), (3, "same words as the next one here"), (4, "same words as the next one here"),
                    (5, "y" * 100_000)])
    clashing = ["__x", "statistics", "bad_id", "bad_hash", "__spans", "__blob", "spans", "blob", "starts", "ends", "text_hash", "contaminated", "kept", "component_id"]
    docs = docs.withColumns({c: F.lit(f"clash {c}") for c in clashing})
    for rows in (docs, docs.limit(0), docs.drop("n_chars")):
        df = rows
        for _, stage in cp.STAGES[:-1]:
            df = stored(stage(spark, df, SF), "test-edge")
            assert df.columns == rows.columns
            assert all(r[c] == f"clash {c}" for r in df.collect() for c in clashing)
        assert cp.STAGES[-1][1](spark, df, SF).count() >= df.count()
    assert len(cp.STAGES) == 5


def test_stages_hand_rows_to_python_in_small_batches(spark):
    """Whole texts and shingle sets wait outside the heap, a batch at a time, on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    given, docs = spark.conf.get(key), table(spark, SF, "documents")
    rows = spark.range(0, 3000, 1, 1)

    def sizes():
        seen = rows.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n bigint").collect()
        return max(r.n for r in seen), sum(r.n for r in seen)

    try:
        for _, stage in cp.STAGES:
            for value, most in (("10000", BATCH_ROWS), ("0", BATCH_ROWS), ("100", 100)):
                spark.conf.set(key, value)
                stage(spark, docs.limit(3), SF)
                assert sizes() == (most, 3000)
    finally:
        spark.conf.set(key, given)
