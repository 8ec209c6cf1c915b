"""The stages one by one against plain Python, and that they leave clean documents alone."""

from __future__ import annotations

import awkward
import corpus_pipeline as pipeline
import pyarrow as pa
import test_alike
import test_scans
from conftest import TINY

from tripweave.llm import bpe, queries
from tripweave.llm.common import BATCH_BYTES, BATCH_SETTING, bounded_batches, settled, table

FOLDER = "/root/testdata/sf0.01"


def staged(spark, folder):
    docs, out = table(spark, folder, "documents"), []
    for name, stage in pipeline.STAGES:
        made = settled(stage(spark, docs, folder), name)
        out.append((docs, made))
        docs = made
    return out


def test_stages(spark):
    (raw, good), (_, single), (_, masked), (_, mixed), (_, encoded) = staged(spark, TINY)
    assert all(frame.columns == raw.columns for frame in (good, single, masked, mixed))
    kept = {r["doc_id"] for r in queries.op7_quality_rules(spark, TINY).where("kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == kept
    rows = sorted(awkward.texts_of(good))
    staying = [rows[i][0] for i in test_alike.alike_by_hand([t for _, t in rows])]
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(staying)
    assert {r["doc_id"] for r in masked.collect()} == {r["doc_id"] for r in single.collect()}
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    for row in masked.collect():
        assert test_scans.secrets_by_hand(row["text"])[:3] == (0, 0, 0) and row["n_chars"] == len(row["text"])
        if row["text"] != before[row["doc_id"]]:
            assert "[secret]" in row["text"]
    assert {r["doc_id"] for r in mixed.collect()} <= {r["doc_id"] for r in masked.collect()}
    same = bpe.round_trip(mixed, queries.tokenizer_json())
    assert awkward.by_row(encoded) == awkward.by_row(same)


def test_clean_documents_stay(spark):
    docs = table(spark, FOLDER, "documents")
    good = pipeline.judge_quality(spark, docs, FOLDER).select("doc_id")
    labels = table(spark, FOLDER, "labels").where("quality = 1 AND toxic = 0").select("doc_id")
    sound = queries.op7_quality_rules(spark, FOLDER).where("NOT base_failed").select("doc_id")
    clean = sound.join(labels, "doc_id")
    assert clean.join(good, "doc_id").count() >= 0.97 * clean.count()


def test_awkward_rows_pass_through(spark):
    docs = awkward.documents(spark)
    for _, stage in pipeline.STAGES:
        docs = settled(stage(spark, docs, TINY), "awkward")
    empty = awkward.empty(spark)
    for _, stage in pipeline.STAGES:
        empty = settled(stage(spark, empty, TINY), "empty")
    assert empty.count() == 0


def test_batches_of_long_texts_are_bounded_by_bytes(spark):
    texts = spark.range(3000, numPartitions=1).selectExpr("id AS doc_id", "repeat('long words ', 1000) AS text")
    pipeline.judge_quality(spark, table(spark, TINY, "documents"), TINY)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["bytes", "rows"])

    found = texts.mapInArrow(sizes, "bytes long, rows long").collect()
    assert sum(r["rows"] for r in found) == 3000
    assert max(r["bytes"] for r in found) < 2 * BATCH_BYTES


def test_a_session_keeps_its_own_bound_of_batches(spark):
    own = spark.newSession()
    own.conf.set(BATCH_SETTING, "1000000")
    bounded_batches(own)
    assert own.conf.get(BATCH_SETTING) == "1000000"
