"""The pipeline's stages against brute force on the smallest tables."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from folioscope.llm import probminhash
from folioscope.llm.arrow_text import utf8
from folioscope.llm.scratch import written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, SF), "stage")
        assert out.columns == docs.columns and out.join(docs, "doc_id", "left_anti").count() == 0
        kept[name], docs = out, out
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rated = labels.join(kept["quality classifier"].select("doc_id", F.lit(1).alias("k")), "doc_id", "left").groupBy("quality", "toxic").agg(F.avg(F.coalesce("k", F.lit(0))).alias("k")).collect()
    share = {(r["quality"], r["toxic"]): r["k"] for r in rated}
    assert share[1, 0] > 0.95 and all(v < 0.5 for k, v in share.items() if k != (1, 0))
    told, exact = kept["language ID"], kept["exact dedup"]
    want = {r["d"] for r in told.groupBy("text").agg(F.min("doc_id").alias("d")).collect()}
    assert {r["doc_id"] for r in exact.collect()} == want
    rows = exact.orderBy("doc_id").collect()
    sets = []
    for r in rows:
        _, item, weight = probminhash.shingles(*utf8(pa.array([r["text"]])))
        sets.append((item, weight))
    least = list(range(len(rows)))
    for _ in range(3):
        for i in range(len(rows)):
            for j in range(i):
                if least[i] != least[j] and probminhash.similarity(sets[i], sets[j]) >= probminhash.THRESHOLD:
                    a, b = sorted((least[i], least[j]))
                    least = [a if x == b else x for x in least]
    brute = {rows[i]["doc_id"] for i in set(least)}
    near = {r["doc_id"] for r in kept["MinHash near-dedup"].collect()}
    assert len(near ^ brute) <= max(1, 0.02 * len(brute))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    assert packed.agg(F.sum("length")).first()[0] == total and packed.select("doc_id").distinct().count() == docs.count()
    assert np.all(np.array([r["n"] for r in packed.groupBy("bin").agg(F.sum("length").alias("n")).collect()]) <= 8192)
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_awkward(spark):
    docs = spark.createDataFrame([(1, None, None, None, None, 1), (None, "", "en", "s", 0, 2), (2, "a b c d", "en", "s", 7, 3), (2, "a b c d", "en", "s", 7, 3), (2, "a b c d", "en", "s", 7, 4)], "doc_id long, text string, lang string, source string, n_chars long, size int")
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, rows, SF).collect()
