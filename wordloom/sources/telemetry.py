"""Step metrics: append, read back, and unfold files of parallel arrays."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STEP_FIELDS = "run_id long, step long, epoch long, loss double, grad_norm double, accuracy double, lr double"

# Decimals kept per metric, and the array names in a metrics file.
DECIMALS = {"loss": 4, "grad_norm": 4, "accuracy": 4, "lr": 8}
ARRAYS = {"loss": "trainLosses", "grad_norm": "gradNorms", "accuracy": "trainAccuracies", "lr": "learningRates"}


def _rounded(steps: DataFrame) -> DataFrame:
    return steps.withColumns({c: F.round(c, d) for c, d in DECIMALS.items() if c in steps.columns})


def append_steps(steps: DataFrame, path: str) -> None:
    """Append step rows, partitioned by run. Each task writes what it has: a long run is not
    gathered first."""
    _rounded(steps).write.mode("append").partitionBy("run_id").parquet(path)


def append_batch(steps: DataFrame, path: str, batch: int) -> None:
    """Append a numbered batch of step rows so that it counts once, however often it is run.

    Rows go to a folder of their own; then the batch's line in the manifest names that folder. A batch
    that stopped half-way has no line and is not read; one that is run again gets another folder, and
    its line then names that one. Readers never see two folders of one batch.
    """
    attempt = uuid.uuid4().hex
    _rounded(steps).write.parquet(f"{path}/rows/batch={batch}/attempt={attempt}")
    line = steps.sparkSession.createDataFrame([(attempt,)], "attempt string").coalesce(1)
    line.write.mode("overwrite").parquet(f"{path}/manifest/batch={batch}")


def write_batches(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what has arrived, micro-batch by micro-batch, each exactly once."""
    query = stream.writeStream.foreachBatch(lambda df, number: append_batch(df, path, number))
    query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_batches(spark: SparkSession, path: str, without: int | None = None) -> DataFrame:
    """The step rows of all batches in the manifest, or of all but one."""
    known = spark.read.schema("attempt string, batch long").parquet(f"{path}/manifest")
    known = known if without is None else known.where(F.col("batch") != without)
    rows = spark.read.schema(f"{STEP_FIELDS}, batch long, attempt string").parquet(f"{path}/rows")
    return rows.join(known, ["batch", "attempt"], "left_semi").drop("batch", "attempt")


def read_metrics_files(
    spark: SparkSession, path: str, since: str | None = None, metrics=("loss", "grad_norm", "accuracy", "lr"), lines: bool = False
) -> DataFrame:
    """(run_id, epoch, pos, metrics) of metrics files, JSON objects of parallel arrays, that lie in
    folders run_id=.../epoch=.... `since` (yyyy-mm-ddThh:mm:ss) leaves out files not written after it.

    With `lines`, a file holds one object a line, of as many epochs as there are, which names its epoch;
    folders are run_id=... only. So the number of files does not grow with the number of epochs."""
    if lines:
        reader = spark.read.schema("value string, run_id long")
        read = (reader if since is None else reader.option("modifiedAfter", since)).format("text").load(path)
        epoch = F.from_json("value", "epoch long")["epoch"]
        return unfold(read.select("value", "run_id", epoch.alias("epoch")), F.col("value"), ["run_id", "epoch"], metrics)
    reader = spark.read.schema("value string, run_id long, epoch long").option("wholetext", True)
    files = (reader if since is None else reader.option("modifiedAfter", since)).format("text").load(path)
    return unfold(files, F.col("value"), ["run_id", "epoch"], metrics)


def append_new(steps: DataFrame, path: str, batch: int) -> None:
    """Append the step rows beyond what other batches have of their run and epoch.

    A metrics file is written anew with longer arrays as training goes on; read again, only what was
    added is appended. What is already there is told from the sink itself, so a batch that runs
    again after a failure finds the same rows, and nothing is lost or kept twice.
    """
    spark = steps.sparkSession
    try:
        had = read_batches(spark, path, without=batch).groupBy("run_id", "epoch").agg(F.max("step").alias("_had"))
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return append_batch(steps, path, batch)
    fresh = steps.join(had, ["run_id", "epoch"], "left").where(F.col("_had").isNull() | (F.col("step") > F.col("_had")))
    append_batch(fresh.select(steps.columns), path, batch)


def read_steps(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STEP_FIELDS).parquet(path)


def metrics_schema(metrics=tuple(ARRAYS)) -> str:
    return "struct<" + ",".join(f"{ARRAYS[m]}:array<double>" for m in metrics) + ">"


def unfold(files: DataFrame, json_text: Column, keys: list[str], metrics=tuple(ARRAYS)) -> DataFrame:
    """(keys, pos, one column per metric) from JSON objects of parallel arrays; arrays that are shorter
    or missing give nulls."""
    doc, none = F.from_json(json_text, metrics_schema(metrics)), F.array().cast("array<double>")
    rows = files.select(*keys, doc.alias("_d")).select(
        *keys, F.posexplode_outer(F.arrays_zip(*[F.coalesce(f"_d.{ARRAYS[m]}", none).alias(m) for m in metrics])).alias("pos", "_z")
    )
    return rows.where("_z is not null").select(*keys, F.col("pos").cast("long").alias("pos"), *[F.col(f"_z.{m}").alias(m) for m in metrics])


def latest_state(states: DataFrame, runs: DataFrame, default: dict[str, object]) -> DataFrame:
    """The state columns at the highest step of every run; `default` where a run has none.

    One aggregate, combined before the shuffle: no run is gathered or sorted as a whole.
    """
    cols = [c for c in default if c != "step"]
    last = states.groupBy("run_id").agg(F.max("step").alias("step"), *[F.max_by(c, "step").alias(c) for c in cols])
    return runs.join(last, "run_id", "left").withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in default.items()})
