"""URL filters as a sort-merge range join.

A URL's canonical key is its host's labels in reverse, each ended by a comma, then its path. A rule for a host, or for a host and a path,
is then a prefix of the keys it covers, an interval in key order. Pages and rules are cut into ranges of keys, rules going to every
range that their interval touches, and each range is sorted and swept once with a stack of the rules active: nested
intervals close in the order opposite to that in which they open, so the top of the stack is always the most specific rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.arrow_text import map_batches
from folioscope.llm.scratch import drawn

AFTER = "\U0010ffff"  # ends the interval of a prefix


def canonical_key(url: Column) -> Column:
    """``http://WWW.a.example.com:80/x?q#f`` gives ``com,example,a,/x``; null for a null or a URL without a host.

    Scheme, user, port, query, fragment, a leading ``www.`` and a dot at the host's end are dropped; the host is lowered, the path is not.
    """
    rest = F.regexp_replace(F.trim(url), r"^(?i)(?:[a-z][a-z0-9+.\-]*:)?//", "")
    rest = F.regexp_replace(rest, r"[?#].*$", "")
    host = F.regexp_replace(F.substring_index(rest, "/", 1), r"^.*@", "")
    host = F.lower(F.regexp_replace(F.regexp_replace(host, r":[0-9]*$", ""), r"\.$", ""))
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.when(F.instr(rest, "/") > 0, F.substring(rest, F.instr(rest, "/"), F.length(rest))).otherwise("/")
    labels = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(F.length(host) > 0, F.concat(labels, F.lit(","), path))


def rule_key(rule: Column) -> Column:
    """A host (``spam.example``, with all hosts below it) or host and path prefix (``a.example/x``, that host alone) as a prefix of keys."""
    key = canonical_key(F.concat(F.lit("//"), rule))
    return F.when(F.instr(rule, "/") > 0, key).otherwise(F.regexp_replace(key, "/$", ""))


def rules_table(spark: SparkSession, rules: list[tuple[int, str, str]]) -> DataFrame:
    """(rule_id, rule, action) rows."""
    return spark.createDataFrame(rules, "rule_id long, rule string, action string")


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by range and key, rules before pages of the same key. State runs on over batches and begins anew with each range."""
    stack: list[tuple[str, int, str]] = []
    where = None
    for batch in batches:
        ids, keys, ranges, rule, action = (batch.column(c).to_pylist() for c in ("id", "key", "range", "rule_id", "action"))
        row, got, what, depth = [], [], [], []
        for i, key in enumerate(keys):
            if ranges[i] != where:
                where, stack = ranges[i], []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if rule[i] is not None:
                if not stack or stack[-1][0] != key:  # of rules with one key the first, that of the least id, stands
                    stack.append((key, rule[i], action[i]))
            else:
                row.append(i)
                got.append(stack[-1][1] if stack else None)
                what.append(stack[-1][2] if stack else "allow")
                depth.append(len(stack))
        at = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("key").take(at), pa.array(got, pa.int64()), pa.array(what, pa.string()), pa.array(depth, pa.int32())], names=["id", "key", "rule_id", "action", "depth"])


def matched(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url", ranges: int | None = None, sample: int = 20_000) -> DataFrame:
    """(id, key, rule_id, action, depth) of each page: the most specific rule that covers it and how many distinct prefixes do.

    ``rules`` has rule_id, rule and action; of rules with the same key the one of the least rule_id counts. A page that none covers has
    a null rule, action ``allow`` and depth 0, and so has a null URL or one without a host, whose key is null. Rules with a null rule
    or no host are ignored. Repeated pages give repeated rows; other columns are ignored, whatever their names. A URL of any length is one key. ``sample`` keys set the ends
    of the ranges, which affects the balance of the work and no result; they reach the driver and the tasks, so long URLs cost memory there.
    """
    spark = pages.sparkSession
    keyed = pages.select(F.col(id_col).alias("id"), canonical_key(F.col(url_col)).alias("key"))
    kind = keyed.schema["id"].dataType.simpleString()
    have = keyed.filter("key is not null")
    given = rules.select(rule_key(F.col("rule")).alias("key"), F.col("rule_id").cast("long").alias("rule_id"), "action").filter("length(key) > 0 and rule_id is not null")
    given = given.groupBy("key").agg(F.min_by("action", "rule_id").alias("action"), F.min("rule_id").alias("rule_id"))
    n = ranges or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # a bounded sample of the keys: those of least hash, whole ties kept apart by the key
    keys = sorted(r[0] for r in drawn(have.select("key", "id"), F.struct("key", "id"), sample).select("key").collect())
    ends = np.array([keys[len(keys) * i // n] for i in range(1, n)] if keys else [], object)
    shared = spark.sparkContext.broadcast(ends)

    # a key that many rows have ends several ranges; its rows are dealt out over them, and the rules that cover it go to all
    @F.pandas_udf("int")
    def of(key: pd.Series) -> pd.Series:
        low, high = (np.searchsorted(shared.value, key.to_numpy(), side) for side in ("left", "right"))
        return pd.Series(np.where(high > low, low + 1 + np.arange(len(key)) % np.maximum(high - low, 1), high).astype(np.int32))

    @F.pandas_udf("int")
    def first(key: pd.Series) -> pd.Series:
        low, high = (np.searchsorted(shared.value, key.to_numpy(), side) for side in ("left", "right"))
        return pd.Series(np.minimum(low + 1, high).astype(np.int32))

    @F.pandas_udf("int")
    def last(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, key.to_numpy(), "right").astype(np.int32))

    placed = have.select("id", "key", of("key").alias("range"), F.lit(None).cast("long").alias("rule_id"), F.lit(None).cast("string").alias("action"))
    spread = given.select("key", first("key").alias("low"), last(F.concat("key", F.lit(AFTER))).alias("high"), "rule_id", "action")
    spread = spread.select(F.lit(None).cast(kind).alias("id"), "key", F.explode(F.sequence("low", "high")).alias("range"), "rule_id", "action")
    rows = placed.union(spread).repartition(F.col("range")).sortWithinPartitions("range", "key", F.col("rule_id").asc_nulls_last())
    swept = map_batches(rows, _sweep, f"id {kind}, key string, rule_id long, action string, depth int")
    none = keyed.filter("key is null").select("id", "key", F.lit(None).cast("long").alias("rule_id"), F.lit("allow").alias("action"), F.lit(0).alias("depth"))
    return swept.union(none).withColumnRenamed("id", id_col)

