"""Papers to start citation searches from, and the state of those searches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.text import doi, normalized


def keyword_hit(text: Column, keyword: str) -> Column:
    """Whether the normalised text has the phrase, or for a single word a token that begins with it."""
    padded = F.concat(F.lit(" "), text)
    return F.contains(text, F.lit(keyword)) if " " in keyword else F.contains(padded, F.lit(" " + keyword))


def matched_keywords(text: Column, keywords: list[str]) -> Column:
    """The keywords that hit, in their order. The dictionary is small, so it's an expression and not a join."""
    return F.array_compact(F.array(*[F.when(keyword_hit(text, k), F.lit(k)) for k in keywords]))


def citations(x: Column) -> Column:
    """A count, 0 for null or what isn't one."""
    return F.coalesce(x.cast("string").try_cast("int"), F.lit(0))


def keyword_seeds(metadata: DataFrame, explored: DataFrame, keywords: list[str], least: int = 100) -> DataFrame:
    """(doi, title, citation_count, matched_keywords) of papers not explored yet; rows that repeat a DOI stay."""
    m = metadata.select(doi(F.col("doi")).alias("doi"), "title", citations(F.col("citation_count")).alias("citation_count"))
    m = m.filter((F.col("doi") != "") & (F.col("citation_count") >= least))
    m = m.join(explored.select(doi(F.col("doi")).alias("doi")).distinct(), "doi", "left_anti")
    m = _with_text(m).filter(_any(F.col("text"), keywords))
    hits = m.withColumn("m", matched_keywords(F.col("text"), keywords))
    return hits.select("doi", "title", "citation_count", F.array_join("m", "; ").alias("matched_keywords"))


def gap_seeds(papers: DataFrame, unclassified: DataFrame, metadata: DataFrame, explored: DataFrame, topics: list[tuple[str, list[str]]], least: int = 100) -> DataFrame:
    """(doi, title, citation_count, matched_topics, source_bucket, score): 100,000 a topic, 25,000 for an unclassified paper, and its citations.

    The title is that of the metadata where it has one, the citations are its own alone, and of rows that share a DOI the best stays,
    an unclassified one before a classified one.
    """
    rows = unclassified.select(doi(F.col("doi")).alias("doi"), "title", F.lit(0).alias("p")).unionByName(papers.select(doi(F.col("doi")).alias("doi"), "title", F.lit(1).alias("p")))
    rows = rows.filter("doi <> ''").join(explored.select(doi(F.col("doi")).alias("doi")).distinct(), "doi", "left_anti")
    known = metadata.select(doi(F.col("doi")).alias("doi"), F.col("title").alias("own"), citations(F.col("citation_count")).alias("c"))
    known = known.groupBy("doi").agg(F.max_by("own", F.struct("c", "own")).alias("own"), F.max("c").alias("c"))
    rows = rows.join(known, "doi", "left").select("doi", F.when(F.coalesce("own", F.lit("")) != "", F.col("own")).otherwise(F.col("title")).alias("title"), F.coalesce("c", F.lit(0)).alias("citation_count"), "p").filter(F.col("citation_count") >= least)
    rows = _with_text(rows)
    hit = [F.when(_any(F.col("text"), terms), F.lit(name)) for name, terms in topics]
    rows = rows.filter(_any(F.col("text"), [t for _, terms in topics for t in terms])).withColumn("m", F.array_compact(F.array(*hit))).drop("text")
    rows = rows.withColumn("score", 100_000 * F.size("m") + F.when(F.col("p") == 0, 25_000).otherwise(0) + F.col("citation_count"))
    best = rows.groupBy("doi").agg(F.max_by(F.struct("title", "citation_count", "m", "p", "score"), F.struct("score", -F.col("p"), "title")).alias("b"))
    return best.select("doi", "b.title", "b.citation_count", F.array_join("b.m", "; ").alias("matched_topics"), F.when(F.col("b.p") == 0, "unclassified").otherwise("papers").alias("source_bucket"), "b.score")


def _with_text(rows: DataFrame) -> DataFrame:
    """With the normalised title as ``text``. It comes from a generator of one element, which filters aren't pushed through: the optimizer would
    put the whole expression in the place of each term's ``text``."""
    return rows.select("*", F.explode(F.array(normalized(F.coalesce("title", F.lit(""))))).alias("text"))


def _any(text: Column, terms: list[str]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | keyword_hit(text, t)
    return out


def first_seen(rows: DataFrame, key: str, pos: str) -> DataFrame:
    """One row of each key, with its first place."""
    return rows.groupBy(key).agg(F.min(pos).alias(pos))


def frontier(queue: DataFrame, done: DataFrame) -> DataFrame:
    """(doi, pos) of the queue's DOIs that aren't done, each at its first place."""
    own = queue.select(doi(F.col("doi")).alias("doi"), "pos").filter("doi <> '' AND NOT startswith(doi, '#')")
    return first_seen(own, "doi", "pos").join(done.select(doi(F.col("doi")).alias("doi")).distinct(), "doi", "left_anti")


def cited_enough(edges: DataFrame, least_citations: int, least_year: int) -> DataFrame:
    """Edges whose paper has an id, citations and a year of at least the bounds; a null counts as 0."""
    return edges.filter(F.col("paper").isNotNull() & (F.coalesce("citations", F.lit(0)) >= least_citations) & (F.coalesce("year", F.lit(0)) >= least_year))


def storage_state(papers: DataFrame, kept: DataFrame, discarded: DataFrame) -> DataFrame:
    """(paper, state): kept before discarded before new."""
    flag = lambda df, name: df.select("paper").distinct().withColumn(name, F.lit(True))
    both = papers.join(flag(kept, "k"), "paper", "left").join(flag(discarded, "d"), "paper", "left")
    return both.select("paper", F.when(F.col("k"), "kept").when(F.col("d"), "discarded").otherwise("new").alias("state"))


def batches(rows: DataFrame, by: str, order: str, size: int = 20) -> DataFrame:
    """(by, batch_no, n): how many rows each batch of ``size`` of a seed has."""
    place = F.row_number().over(Window.partitionBy(by).orderBy(order))
    return rows.select(by, F.floor((place - 1) / size).alias("batch_no")).groupBy(by, "batch_no").agg(F.count(F.lit(1)).alias("n"))


def merged_decisions(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """(id, decision, reason): the last valid decision on each row; ``uncertain`` where there is none. Decisions on unknown ids fall away."""
    valid = decisions.filter(F.col("decision").isin("keep", "drop", "uncertain"))
    last = valid.groupBy("id").agg(F.max_by(F.struct("decision", "reason"), "pos").alias("d"))
    return rows.select("id").join(last, "id", "left").select("id", F.coalesce("d.decision", F.lit("uncertain")).alias("decision"), F.when(F.col("d").isNull(), "missing_from_model_output").otherwise(F.col("d.reason")).alias("reason"))
