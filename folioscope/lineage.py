"""Plans cut where a table is used many times over."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share. A local session that names none gets one of its own; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="folioscope-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and read from the checkpoint folder, where it stays until its frame is no longer used, if the session cleans checkpoints."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def placed(df: DataFrame, by: str, order: str, name: str = "place") -> DataFrame:
    """``df`` with the place of each row, from 0, among those of the same ``by`` in the ``order``, which has no ties.

    No task needs all rows of one ``by``: ranges of rows are numbered by themselves and each begins where those before it end.
    """
    ranged = df.repartitionByRange(by, order).sortWithinPartitions(by, order).withColumn("_at", F.monotonically_increasing_id())
    ranged = cut(ranged.withColumn("_range", F.expr("_at div 8589934592")))
    first = ranged.groupBy(by, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = first.select(F.col(by).alias("_by"), F.col("_range").alias("_of"), "_first", before.alias("_before"))
    both = ranged.join(starts, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_range") == F.col("_of")))
    return both.withColumn(name, F.col("_before") + F.col("_at") - F.col("_first")).drop("_at", "_range", "_first", "_by", "_of", "_before")
