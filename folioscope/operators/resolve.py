"""Which paper a file is: names matched by DOI, by title, and by part of a title."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.text import doi_within, match_key, parsed_base_name, title_hint
from folioscope.lineage import cut
from folioscope.operators.containment import contained

LEAD = 8


def _cited(candidates: DataFrame, by: str) -> DataFrame:
    """(by, base_name, c): the most citations of each. A null count is -1."""
    return candidates.groupBy(by, "base_name").agg(F.max(F.coalesce("citations", F.lit(-1))).alias("c"))


def preferred(candidates: DataFrame, by: str) -> DataFrame:
    """(by, base_name): the one candidate, or the one with strictly most citations; none on a tie. A null count is -1."""
    own = _cited(candidates, by)
    rank = Window.partitionBy(by).orderBy(F.desc("c"), "base_name")
    lead = own.withColumn("r", F.row_number().over(rank)).withColumn("n", F.lead("c").over(rank)).filter("r = 1 AND (n IS NULL OR n < c)")
    return lead.select(by, "base_name")


def exact_titles(items: DataFrame, records: DataFrame) -> DataFrame:
    """(item, base_name) where the title keys are equal.

    Whatever an item's other keys are, its first two candidates are among the first two of a key, so no more of each key meet the items.
    """
    rank = Window.partitionBy("key").orderBy(F.desc("c"), "base_name")
    first = _cited(records.filter("key <> ''"), "key").withColumn("r", F.row_number().over(rank)).filter("r <= 2")
    both = items.select("item", "key").filter("key <> ''").join(first.select("key", "base_name", F.col("c").alias("citations")), "key")
    return preferred(both, "item")


def partial_pairs(items: DataFrame, records: DataFrame) -> DataFrame:
    """(item, base_name, score, citations): one key within the other, the score being the shorter's length, best for each base name."""
    items, records = cut(items.select("item", "key")), cut(records.select("base_name", "key", "citations"))
    a = contained(items.select(F.col("item").alias("id"), "key"), records.select(F.col("base_name").alias("id"), "key")).select(F.col("sid").alias("item"), F.col("lid").alias("base_name"), "score")
    b = contained(records.select(F.col("base_name").alias("id"), "key"), items.select(F.col("item").alias("id"), "key")).select(F.col("lid").alias("item"), F.col("sid").alias("base_name"), "score")
    cited = records.groupBy("base_name").agg(F.max(F.coalesce("citations", F.lit(-1))).alias("citations"))
    return a.union(b).groupBy("item", "base_name").agg(F.max("score").alias("score")).join(cited, "base_name")


def partial_titles(items: DataFrame, records: DataFrame) -> DataFrame:
    """(item, base_name, score): the only one, or one that leads by 8, or of those with the top score the most cited."""
    pairs = cut(partial_pairs(items, records))
    w = Window.partitionBy("item")
    best = pairs.withColumn("top", F.max("score").over(w)).withColumn("second", F.nth_value("score", 2).over(w.orderBy(F.desc("score"), "base_name").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    clear = best.filter(f"score = top AND (second IS NULL OR top - second >= {LEAD})").select("item", "base_name", "score")
    tied = preferred(best.filter(f"score = top AND second IS NOT NULL AND top - second < {LEAD}"), "item").join(best.select("item", "base_name", "score").distinct(), ["item", "base_name"])
    return clear.union(tied.select("item", "base_name", "score"))


def resolved(files: DataFrame, metadata: DataFrame, bib: DataFrame, relations: DataFrame) -> DataFrame:
    """(file, base_name, strategy) of each name: named already (``legacy`` where its document id stands before), a known DOI within it, then by title the bibliography, relations and metadata.

    ``metadata`` has doi, base_name, key and citations, ``bib`` doi and key, ``relations`` base_name and key. Later strategies see only
    names that earlier ones left, so the costly ones run on few. One that none settles has a null base name and strategy.
    """
    f = files.select("file", F.regexp_replace("file", r"(?i)\.pdf$", "").alias("stem"))
    p = parsed_base_name(F.col("stem"))
    f = f.withColumn("named", F.when(p["format"] == "doi", F.col("stem")).when(p["format"] == "legacy", F.concat(F.lit("doi-"), p["doi_slug"]))).withColumn("doi", doi_within(F.col("stem"))).withColumn("key", match_key(title_hint(F.col("stem"))))
    known = metadata.select("doi", "base_name").distinct()
    one = f.filter("named IS NOT NULL").select("file", F.col("named").alias("base_name"), F.when(F.col("stem") == F.col("named"), "named").otherwise("legacy").alias("strategy"))
    left = f.filter("named IS NULL")
    two = left.join(known, "doi").select("file", "base_name", F.lit("doi").alias("strategy"))
    two, left = cut(two), cut(left.join(two, "file", "left_anti"))
    cited = metadata.groupBy("doi", "base_name").agg(F.max("citations").alias("citations"))
    sources = [("bib", bib.join(cited, "doi").select("base_name", "key", "citations")), ("relations", relations.join(cited.drop("doi"), "base_name", "left").select("base_name", "key", "citations")), ("metadata", metadata.select("base_name", "key", "citations"))]
    out = one.union(two)
    for name, records in sources:
        items = left.select(F.col("file").alias("item"), "key")
        got = cut(exact_titles(items, records).select(F.col("item").alias("file"), "base_name", F.lit(f"{name}_exact").alias("strategy")))
        left = cut(left.join(got, "file", "left_anti"))
        part = cut(partial_titles(left.select(F.col("file").alias("item"), "key"), records).select(F.col("item").alias("file"), "base_name", F.lit(f"{name}_partial").alias("strategy")))
        left = cut(left.join(part, "file", "left_anti"))
        out = out.union(got).union(part)
    return out.union(left.select("file", F.lit(None).cast("string"), F.lit(None).cast("string")))


def match_audit(found: DataFrame) -> DataFrame:
    """(bucket, n): total, already_doi, legacy, matched and unmatched, 0 where there is none."""
    s = F.col("strategy")
    row = found.agg(F.count(F.lit(1)).alias("total"), F.count_if(s == "named").alias("already_doi"), F.count_if(s == "legacy").alias("legacy"), F.count_if(~s.isin("named", "legacy")).alias("matched"), F.count_if(s.isNull()).alias("unmatched"))
    return row.unpivot([], ["total", "already_doi", "legacy", "matched", "unmatched"], "bucket", "n")


def rename_plan(found: DataFrame) -> DataFrame:
    """(source, target, status) of copying each file to its name by DOI; the last source by name wins a target."""
    last = F.max("file").over(Window.partitionBy("base_name"))
    return found.select(F.col("file").alias("source"), F.when(F.col("base_name").isNotNull(), F.concat("base_name", F.lit(".pdf"))).alias("target"), F.when(F.col("base_name").isNull(), "unmatched").when(F.col("file") == last, "copied").otherwise("overwritten").alias("status"))

