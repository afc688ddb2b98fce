"""The pipeline, stage by stage, against plain versions of its decisions."""

import os
import zlib

from pyspark.sql import functions as F

import corpus_pipeline
from pageloom.llm import queries, toxicity
from pageloom.llm.common import shared_base
from tests.llm.test_similar import slow_roots


def test_stages(spark, sf):
    docs = queries.table(spark, sf, "documents")
    model = queries.toxicity_model(spark, docs, sf)
    score = toxicity.Scorer(model)
    now = {r.doc_id: r.text for r in docs.collect()}
    step = corpus_pipeline.drop_toxic(spark, docs, sf)
    now = {i: t for i, t in now.items() if score([t])[0] < 0.5}
    assert {r.doc_id: r.text for r in step.collect()} == now and step.columns == docs.columns
    step = corpus_pipeline.drop_near_duplicates(spark, step, sf)
    ids = sorted(now)
    roots = slow_roots([now[i] for i in ids])
    now = {i: now[i] for k, i in enumerate(ids) if roots[k] == k}
    assert {r.doc_id for r in step.collect()} == set(now) and step.columns == docs.columns
    step = corpus_pipeline.drop_contaminated(spark, step, sf)
    hit = {r.doc_id for r in queries.op7_decontamination(spark, sf).where("contaminated").collect()}
    now = {i: t for i, t in now.items() if i not in hit}
    assert {r.doc_id for r in step.collect()} == set(now) and step.columns == docs.columns
    step = corpus_pipeline.redact_secrets(spark, step, sf)
    masked = {r.doc_id: r for r in step.collect()}
    assert set(masked) == set(now) and step.columns == docs.columns and all(r.n_chars == len(r.text) for r in masked.values())
    packed = corpus_pipeline.pack(spark, step, sf).collect()
    assert {r.doc_id for r in packed} == set(now)
    before = {*os.listdir(shared_base(spark).removeprefix("file://"))}
    whole = corpus_pipeline.run(spark, sf)
    left = {*os.listdir(shared_base(spark).removeprefix("file://"))} - before
    assert sorted(x.rpartition("-")[0] for x in left) == sorted(n.replace(" ", "-") for n, _ in corpus_pipeline.STAGES)
    assert whole.count() == len(packed) and set(whole.columns) >= {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"}
    assert zlib.crc32(b"") == 0


def test_odd_rows(spark, sf):
    docs = queries.table(spark, sf, "documents").limit(3)
    more = F.lit(1).alias("a.b")  # a name that needs quoting
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "no id", "en", "s", 5), (1, "twice here", "en", "s", 10), (1, "twice here", "en", "s", 10), (2, "", "en", "s", 0), (3, None, "en", "s", None)], docs.schema).select("*", more)
    docs = docs.select("*", more)
    out = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, sf)
        assert out.columns == docs.columns, name
    assert out.where("doc_id = 1").count() == 1 and out.where("doc_id is null").count() == 2 and out.where("doc_id in (2, 3)").count() == 1
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.where("false"), sf).count() == 0
