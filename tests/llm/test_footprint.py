"""What travels to a join, and what the driver holds at once."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from marketloom.llm import near_dedup, toxicity


def test_texts_travel_to_the_confirmation_once(spark):
    texts = spark.createDataFrame([(b"a", "one two three four"), (b"b", "one two three four five")], "node binary, text string")
    pairs = spark.createDataFrame([(b"a", b"b")], "hub binary, node binary")
    found = near_dedup.confirmed(pairs, texts, 50)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"text#\d+\]?, false|LogicalRDD \[node#\d+, text#\d+\]", plan)) == 1, plan
    assert [tuple(bytes(v) for v in r) for r in found.collect()] == [(b"a", b"b")]


def test_examples_are_left_out_a_few_at_a_time(monkeypatch):
    asked, real = [], toxicity.Examples.nearest

    def nearest(self, rows, *others):
        asked.append(int(rows[-1]) + 1)
        return real(self, rows, *others)

    monkeypatch.setattr(toxicity.Examples, "nearest", nearest)
    n = 5 * toxicity.ROWS
    rng = np.random.default_rng(1)
    rows, slots = np.repeat(np.arange(n), 3), np.concatenate([np.sort(rng.choice(40, 3, replace=False)) for _ in range(n)])
    index = toxicity.pack(np.ones(40), rows, slots, np.ones(len(rows)), np.arange(n) % 2.0, np.ones(n), np.arange(n))
    assert max(asked) <= toxicity.ROWS and np.isfinite(index.left_out).all()


def test_stages_send_texts_to_python_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["bytes"])

    docs = spark.range(0, 9000, 1, 1).select(F.repeat(F.lit("x"), 2000).alias("text"))
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        found = corpus_pipeline.in_small_batches(lambda _, rows, __: rows.mapInArrow(sizes, "bytes long"))(spark, docs, "")
        assert found.agg(F.max("bytes")).first()[0] < 1.1 * corpus_pipeline.BATCH_BYTES
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
    assert all(hasattr(stage, "__wrapped__") for _, stage in corpus_pipeline.STAGES)
