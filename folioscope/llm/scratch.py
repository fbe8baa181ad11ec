"""Tables that cut lineage, and connected components built on them.

A table is written as Parquet below ``spark.checkpoint.dir``, the folder that every executor shares, so a lost executor costs a
re-read and nothing else. Tests, which set no such folder, get one of their own for the session.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_WRITTEN: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where a local session leaves it unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="folioscope-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it where ``df`` has a column of that name or one that continues it."""
    while any(c.lower().startswith(name) for c in df.columns):
        name += "_"
    return name


def numbering(df: DataFrame, id_col: str) -> DataFrame | None:
    """(key, id): a number for each id of ``df`` that isn't null, written; None where ids are integers and so numbers already."""
    if df.schema[id_col].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        return None
    keys = df.select(F.col(id_col).alias("key")).filter("key is not null").distinct()
    return written(keys.withColumn("id", F.monotonically_increasing_id()), "numbers")


def least_ids(found: DataFrame, numbers: DataFrame | None) -> DataFrame:
    """(id, group_id) of ``found(id, root)`` with the ids that ``numbers`` stand for; ``group_id`` is the least id of a root's."""
    if numbers is None:
        return found.select("id", F.col("root").alias("group_id"))
    named = written(found.join(numbers, "id").select("root", "key"), "named")
    return named.join(named.groupBy("root").agg(F.min("key").alias("group_id")), "root").select(F.col("key").alias("id"), "group_id")


def clear_scratch() -> None:
    """Delete every table ``written`` made. Only for when no result that reads one is still to be computed."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session is gone, and its folder is the cluster's to clean
            continue


atexit.register(clear_scratch)


def drawn(df: DataFrame, key: Column, most: int) -> DataFrame:
    """At most ``most`` rows of ``df``, those of least hash of ``key``.

    A bound on the hash draws about as many before anything is sorted, so what is sorted in one place doesn't grow with the input.
    """
    n = df.count()
    hashed = F.xxhash64(key)
    if n > most:
        df = df.filter(hashed <= F.lit(min(2**63 - 1, int(min(1.0, (most * 1.1 + 100) / n) * 2**64) - 2**63)))
    return df.orderBy(hashed, key).limit(most)


MOST_BITS = 27


def among(key: Column, keys: DataFrame) -> Column:
    """Whether ``key`` may be in the one column of ``keys``: true wherever it is, and seldom elsewhere.

    Rows that aren't can be told before a join, so that the join needn't shuffle them. The bits that are broadcast are 16 for each of ``keys`` and at
    most 2**27, 16 MB; with many more keys than that more rows go to the join, and its result is the same.
    """
    n = keys.count()
    if not n:
        return F.lit(False)
    bits = min(MOST_BITS, max(10, int(16 * n).bit_length()))
    place = F.pmod(F.xxhash64(F.col(keys.columns[0])), F.lit(1 << bits))
    rows = keys.select(place.alias("p")).selectExpr("p div 64 AS w", "shiftleft(cast(1 AS bigint), cast(p % 64 AS int)) AS b").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[rows.column("w").to_numpy()] = rows.column("b").to_numpy()
    shared = keys.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def held(p: pd.Series) -> pd.Series:
        at = p.to_numpy()
        return pd.Series(((shared.value[at >> 6] >> (at & 63)) & 1).astype(bool))

    return held(F.pmod(F.xxhash64(key), F.lit(1 << bits)))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(id, root) for each vertex of the undirected ``edges(a, b)``; ``root`` is the least id of the component.

    Alternating large-star and small-star rounds, each a group-by over the remaining edges, so rounds grow with the logarithm of
    the diameter and no vertex's neighbours are ever gathered in one row. Self loops and repeats are allowed; nulls are dropped.
    """
    e = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).dropna()
    vertices = e.select(F.col("a").alias("id")).union(e.select("b")).distinct()
    e = written(e.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    seen = None
    while True:
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        e = small.filter("b <> m").select("b", "m").union(small.select("a", "m")).toDF("a", "b").filter("a <> b").distinct()
        e = written(e, label)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return vertices.join(e.toDF("id", "root"), "id", "left").select("id", F.coalesce("root", "id").alias("root"))
