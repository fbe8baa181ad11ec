"""State of papers: a registry folded from events, stages told from artifacts, and messages about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.text import doi

PREFIX = "papers:"


def processing_status(event: Column, stage: Column) -> Column:
    """The processing status that an event sets, null if none."""
    return F.when((event == "started") & (stage == "processing"), "processing").when((event == "done") & (stage == "processing"), "completed").when((event == "done") & (stage == "processing_failed"), "failed")


def index_status(event: Column, stage: Column) -> Column:
    return F.when((event == "done") & (stage == "rag"), "indexed").when((event == "done") & (stage == "rag_error"), "error")


def state(events: DataFrame) -> DataFrame:
    """(paper_id, status_proc, status_rag, last_event) of events (paper_id, ts, seq, event, stage).

    The last event that sets a status decides it; all others only touch the paper. A status that none sets is ``pending``. Each task folds its own
    events first, so one row a paper is shuffled.
    """
    p, r = processing_status(F.col("event"), F.col("stage")), index_status(F.col("event"), F.col("stage"))
    at = F.struct("ts", "seq")
    one = events.groupBy("paper_id").agg(F.max_by(p, F.when(p.isNotNull(), at)).alias("p"), F.max_by(r, F.when(r.isNotNull(), at)).alias("r"), F.max("ts").alias("last_event"))
    return one.select("paper_id", F.coalesce("p", F.lit("pending")).alias("status_proc"), F.coalesce("r", F.lit("pending")).alias("status_rag"), "last_event")


def upserted(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows (paper_id, doi, prefix, status_proc, status_rag, last_event): a new DOI fills or replaces only where it isn't null, a prefix always."""
    e, i = existing.alias("e"), incoming.alias("i")
    both = e.join(i, "paper_id", "full")
    new = F.col("i.prefix").isNotNull()
    return both.select(
        "paper_id", F.coalesce("i.doi", "e.doi").alias("doi"), F.coalesce("i.prefix", "e.prefix").alias("prefix"), F.coalesce("e.status_proc", F.lit("pending")).alias("status_proc"),
        F.coalesce("e.status_rag", F.lit("pending")).alias("status_rag"), F.when(new, F.col("i.last_event")).otherwise(F.col("e.last_event")).alias("last_event"),
    )


def last_records(lines: DataFrame) -> DataFrame:
    """The last row of each DOI in its normal form, of rows with doi and line_no."""
    last = Window.partitionBy("_doi").orderBy(F.desc("line_no"))
    return lines.withColumn("_doi", doi(F.col("doi"))).withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n", "doi").withColumnRenamed("_doi", "doi")


def stage_status(papers: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Per base_name which artifacts are there; completed needs docling, filtered, final and claims, heuristics the middle two."""
    kinds = ["pdf", "metadata", "docling", "filtered", "final", "claims"]
    have = artifacts.groupBy("base_name").agg(*[F.bool_or(F.col("kind") == k).alias(k) for k in kinds])
    out = papers.select("base_name").join(have, "base_name", "left").select("base_name", *[F.coalesce(k, F.lit(False)).alias(k) for k in kinds])
    return out.withColumn("heuristics", F.col("filtered") & F.col("final")).withColumn("completed", F.col("docling") & F.col("heuristics") & F.col("claims"))


def pending(status: DataFrame) -> DataFrame:
    return status.filter(~F.col("completed") & ~F.col("heuristics"))


def funnel(counts: DataFrame) -> DataFrame:
    """(stage, n, rate_from_previous, rate_from_first) in percent of (pos, stage, n), of which there are a few; null after 0."""
    w = Window.orderBy("pos")
    share = lambda base: F.when(base > 0, 100.0 * F.col("n") / base)
    return counts.select("stage", "n", share(F.lag("n").over(w)).alias("rate_from_previous"), share(F.first("n").over(w)).alias("rate_from_first"))


def envelopes(events: DataFrame) -> DataFrame:
    """(channel, id, body) of events (event_type, paper_id, ts, payload MAP): the prefix is put once, the payload overrides the time and an id of its own stays."""
    channel = F.when(F.col("event_type").startswith(PREFIX), F.col("event_type")).otherwise(F.concat(F.lit(PREFIX), "event_type"))
    base = F.create_map(F.lit("timestamp"), F.unix_timestamp("ts").cast("string"))
    own = F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key("payload", k)), F.col("payload"))
    body = F.when(F.map_contains_key("payload", "id") | F.col("paper_id").isNull(), own).otherwise(F.map_concat(own, F.create_map(F.lit("id"), F.col("paper_id"))))
    entries = F.array_sort(F.map_entries(body))
    return events.select(channel.alias("channel"), F.col("paper_id").alias("id"), F.to_json(F.map_from_entries(entries)).alias("body"))
