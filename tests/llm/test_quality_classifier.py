"""The quality classifier: held-out accuracy, the densities by hand, and edge rows."""

import math
import zlib

import numpy as np
import pytest

from wordloom.llm import quality_classifier as qc


@pytest.fixture(scope="module")
def scored(spark, sf):
    return {r.doc_id: r for r in qc.op11_quality_classifier(spark, sf).collect()}


def test_held_out_accuracy(spark, sf, scored):
    docs = {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert set(scored) == docs
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.doc_id in docs}
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(scored[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in scored)
    right = [scored[i].predicted == labels[i] for i in held]
    assert len(held) > 10 and sum(right) >= 0.95 * len(right)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored.values())


def test_the_fit_reads_labels_of_the_other_folds_only(spark, sf, scored):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(qc.fold(F.col("doc_id")) == qc.HELD_OUT, 1 - F.col("quality")).otherwise(F.col("quality")))
    docs = docs.withColumn("x", qc.measured(F.col("text")))
    one, two = qc.fit(docs, labels), qc.fit(docs.drop("lang", "source"), flipped)
    for y in (0, 1):
        assert np.allclose(one.means[y], two.means[y]) and np.allclose(one.whiten[y], two.whiten[y])


def test_densities_by_hand():
    rnd = np.random.default_rng(2)
    x = {0: rnd.normal(0, 2, (400, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0], [0, 0, 3]]), 1: rnd.normal(1, 1, (900, 3))}
    model = qc.discriminant({y: (len(v), v.sum(0), v.T @ v) for y, v in x.items()}, shrink=0.2, flatten=0.3)
    centred = {y: v - v.mean(0) for y, v in x.items()}
    pooled = sum(c.T @ c for c in centred.values()) / 1300
    pooled = 0.7 * pooled + 0.3 * np.diag(np.diag(pooled)) + qc.FLOOR**2 * np.eye(3)
    at = rnd.normal(0.5, 2, (50, 3))
    log = {}
    for y, c in centred.items():
        cov = 0.8 * (c.T @ c + qc.ROWS * pooled) / (len(c) + qc.ROWS) + 0.2 * pooled
        gap = at - x[y].mean(0)
        log[y] = math.log(len(c) / 1300) - 0.5 * np.log(np.linalg.det(cov)) - 0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap)
    assert np.allclose(model.score(at), 1 / (1 + np.exp(log[0] - log[1])))


def test_statistics():
    s = dict(zip(qc.STATISTICS, qc.statistics("One two two 12 ### !\n\nÉa. Ab\nx |\nx |".encode())))
    assert s["words"] == math.log1p(12) and s["lines"] == math.log1p(4)
    assert s["symbols"] == qc._odds(3, 24 + 1) and s["digits"] == qc._odds(2, 25) and s["separators"] == qc._odds(2, 25)
    assert s["upper"] == qc._odds(2, 14) and s["repeated_next"] == qc._odds(1, 12) and s["repeated_lines"] == qc._odds(1, 4)
    assert s["commonest"] == qc._odds(2, 12) and s["bare"] == qc._odds(4, 12) and s["distinct"] == math.log(10 / math.sqrt(13))
    assert all(map(math.isfinite, qc.statistics(b""))) and all(map(math.isfinite, qc.statistics(b"  \n")))
    assert len(qc.statistics(b"word " * 500_000)) == len(qc.STATISTICS)


def test_edges(spark):
    good, bad = "A line of plain words here.\n" * 3, "!!! ### $$$ " * 9
    rows = [(i, good + str(i), "x") for i in range(40)] + [(100 + i, bad * (1 + i % 3), None) for i in range(30)]
    rows += [(200, None, "y"), (201, "", "y"), (201, "", "y"), (None, good, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k string")
    labels = spark.createDataFrame(
        [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(30)] + [(None, 1), (5, None), (6, 7), (999, 0), (7, 0)], "doc_id long, quality int"
    )
    from pyspark.sql import functions as F

    docs = docs.withColumn("x", qc.measured(F.col("text")))

    def scores(model):
        return {(r.doc_id, r.text): r.s for r in docs.select("doc_id", "text", qc.quality_score(F.col("x"), model, spark).alias("s")).collect()}

    made = scores(qc.fit(docs, labels))
    assert made[3, good + "3"] > 0.5 > made[101, bad * 2] and made[200, None] == made[201, ""] and 0 <= made[201, ""] <= 1
    assert set(scores(qc.fit(docs, labels.where("quality = 1"))).values()) == {1.0}
    assert set(scores(qc.fit(docs, labels.limit(0))).values()) == {0.5}
    none = docs.limit(0).select(qc.quality_score(F.col("x"), qc.fit(docs.limit(0), labels), spark))
    assert none.count() == 0
