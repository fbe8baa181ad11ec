"""Repeated records of one paper merged to one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(value: str, seq: str) -> Column:
    """The value of the last row in which it is neither null nor empty."""
    some = F.col(value).isNotNull() & (F.col(value).cast("string") != "")
    return F.max_by(F.when(some, F.col(value)), F.when(some, F.col(seq)))


def united(values: str) -> Column:
    """The distinct values of all rows' arrays, sorted, without nulls and empty ones."""
    return F.array_sort(F.filter(F.array_distinct(F.flatten(F.collect_list(values))), lambda x: x.isNotNull() & (x != "")))


def metadata(records: DataFrame, key: str, seq: str, scalars: list[str], sets: list[str], flag: str | None = None) -> DataFrame:
    """One row of each key: last non-empty scalars, sorted unions of sets, and whether ``flag`` was ever true."""
    out = [latest(c, seq).alias(c) for c in scalars] + [united(c).alias(c) for c in sets]
    if flag:
        out.append(F.coalesce(F.bool_or(flag), F.lit(False)).alias(flag))
    return records.groupBy(key).agg(*out)


def first_kept(records: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """The records whose key isn't there yet: insert if absent."""
    return records.join(existing.select(key).distinct(), key, "left_anti")


def known_ids(kept: DataFrame, discarded: DataFrame) -> DataFrame:
    """The distinct ids under which kept and discarded papers (stem, paper_id, base_name) go."""
    both = kept.select("stem", "paper_id", "base_name").union(discarded.select("stem", "paper_id", "base_name"))
    return both.select(F.explode(F.array("stem", "paper_id", "base_name")).alias("id")).filter("id IS NOT NULL AND id <> ''").distinct()


def discard_buckets(discards: DataFrame, mode: str = "gap-rag") -> DataFrame:
    """(bucket_date, mode, moved_count): discards of a mode by the date on which they were made."""
    own = discards.filter(F.col("mode") == mode)
    return own.groupBy(F.to_date("modified").cast("string").alias("bucket_date"), "mode").agg(F.count(F.lit(1)).alias("moved_count"))
