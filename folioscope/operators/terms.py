"""Terms and topics of paper titles.

``papers`` is a DataFrame of paper_id and title, and where told year, doi, journal and citation_count. Topics are a small dictionary, kept
as rows (topic, topic_pos, keyword, keyword_pos, term) made on the driver and joined by hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscope.functions.scoring import candidate_score, citation_weight
from folioscope.functions.text import ngrams, normalized, title_tokens

REGIONS = ("global", "worldwide", "national", "international", "european", "american")


def topic_rows(spark: SparkSession, topics: dict[str, list[str]]) -> DataFrame:
    """The dictionary as rows; of a topic's keywords with one term the first stands, and one without a term is an error."""
    rows = [(t, i, k, j) for i, (t, words) in enumerate(topics.items()) for j, k in enumerate(words)]
    made = spark.createDataFrame(rows, "topic string, topic_pos int, keyword string, keyword_pos int").withColumn("term", F.array_join(title_tokens(F.col("keyword")), " "))
    made = made.withColumn("term", F.when(F.col("term") == "", F.raise_error(F.concat(F.lit("keyword without a term: "), "keyword")).cast("string")).otherwise(F.col("term")))
    first = Window.partitionBy("topic", "term").orderBy("keyword_pos")
    return made.withColumn("n", F.row_number().over(first)).filter("n = 1").drop("n")


def within_years(papers: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    """Papers of the years from ``low`` to ``high``; a null year stays only where there is no bound."""
    if low is not None:
        papers = papers.filter(F.col("year") >= low)
    return papers if high is None else papers.filter(F.col("year") <= high)


def paper_terms(papers: DataFrame, low: int = 1, high: int = 3) -> DataFrame:
    """(paper_id, term, times) for the runs of ``low`` to ``high`` title words. Rows that repeat an id count once each."""
    # the tokens are a column of their own, for an expression inside a lambda would be worked out again for each element
    one = papers.select("paper_id", title_tokens(F.coalesce("title", F.lit(""))).alias("t")).select("paper_id", F.explode(ngrams(F.col("t"), low, high)).alias("term"))
    return one.groupBy("paper_id", "term").agg(F.count(F.lit(1)).alias("times"))


def term_stats(terms: DataFrame) -> DataFrame:
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"), F.sum("times").alias("total_freq"))


def ranked(stats: DataFrame, top: int | None = None) -> DataFrame:
    """By document frequency and total frequency, both falling, then term; ``top`` of 0 is none and of None all."""
    out = stats.orderBy(F.desc("doc_freq"), F.desc("total_freq"), "term")
    return out if top is None else out.limit(top)


def term_index(terms: DataFrame) -> DataFrame:
    """(term, paper_ids): the sorted ids of the papers that have it."""
    return terms.groupBy("term").agg(F.array_sort(F.collect_list("paper_id")).alias("paper_ids"))


def topic_matches(terms: DataFrame, topics: DataFrame) -> DataFrame:
    """(paper_id, topic, topic_pos, keywords): a topic matches where one of its terms is a run of title words."""
    hit = terms.select("paper_id", "term").join(F.broadcast(topics), "term")
    return hit.groupBy("paper_id", "topic", "topic_pos").agg(F.array_sort(F.collect_set("keyword")).alias("keywords"))


def paper_topics(papers: DataFrame, matches: DataFrame) -> DataFrame:
    """(paper_id, title, matched_topics, matched_terms) as ``a; b`` and ``a:k1, k2; b:k3`` in the dictionary's order, empty without a match."""
    got = matches.groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("topic_pos", "topic", "keywords"))).alias("m"))
    joined = papers.select("paper_id", "title").join(got, "paper_id", "left")
    text = lambda f: F.coalesce(F.array_join(F.transform("m", f), "; "), F.lit(""))
    return joined.select("paper_id", "title", text(lambda x: x["topic"]).alias("matched_topics"), text(lambda x: F.concat(x["topic"], F.lit(":"), F.array_join(x["keywords"], ", "))).alias("matched_terms"))


def topic_stats(papers: DataFrame, matches: DataFrame) -> DataFrame:
    """(topic, paper_count, relative_frequency) with the share of all rows of ``papers``, 0 where there are none."""
    total = papers.agg(F.count(F.lit(1)).alias("n"))
    counts = matches.groupBy("topic").agg(F.count_distinct("paper_id").alias("paper_count"))
    return counts.crossJoin(F.broadcast(total)).select("topic", "paper_count", F.when(F.col("n") > 0, F.col("paper_count") / F.col("n")).otherwise(0.0).alias("relative_frequency"))


def cooccurrence(matches: DataFrame) -> DataFrame:
    """(topic_a, topic_b, pair_count) of unordered pairs of topics of one paper: pairs come from a paper's own list, not from a join."""
    own = matches.groupBy("paper_id").agg(F.array_sort(F.collect_set("topic")).alias("t")).filter(F.size("t") > 1)
    pairs = own.select(F.posexplode("t").alias("p", "topic_a"), "t").select("topic_a", F.explode(F.expr("slice(t, p + 2, size(t))")).alias("topic_b"))
    return pairs.groupBy("topic_a", "topic_b").agg(F.count(F.lit(1)).alias("pair_count"))


def unclassified(papers: DataFrame, matches: DataFrame) -> DataFrame:
    return papers.join(matches.select("paper_id").distinct(), "paper_id", "left_anti")


def unmapped(stats: DataFrame, topics: DataFrame, least: int = 2, top: int | None = None) -> DataFrame:
    """Terms of at least ``least`` papers that no topic has."""
    rest = stats.filter(F.col("doc_freq") >= least).join(F.broadcast(topics.select("term").distinct()), "term", "left_anti")
    return rest if top is None else ranked(rest, top)


def summary(papers: DataFrame, matches: DataFrame) -> DataFrame:
    all_, hit = papers.agg(F.count(F.lit(1)).alias("paper_count")), matches.agg(F.count_distinct("paper_id").alias("classified_paper_count"))
    return all_.crossJoin(hit).withColumn("unclassified_paper_count", F.col("paper_count") - F.col("classified_paper_count"))


def excluded_term(term, excluded: tuple[str, ...] = ()):  # type: ignore[no-untyped-def]
    """Whether a term is unfit as a candidate: told so, a year in it, a number at either end, or only names of regions."""
    t = F.split(term, " ")
    number = lambda w: w.rlike("^[0-9]+$")
    only = (F.size(t) >= 2) & F.forall(t, lambda w: w.isin(*REGIONS))
    return term.isin(*excluded) | F.exists(t, lambda w: w.rlike("^[0-9]{4}$")) | number(F.element_at(t, 1)) | number(F.element_at(t, -1)) | only


def _numbered(papers: DataFrame) -> DataFrame:
    """(paper_id, nth, title, w, same): papers told apart by id, title and weight, those of an id numbered in that order; ``same`` is how many rows each stands for."""
    # as many partitions as told, for their terms are many times the titles, by whose size adaptive execution would merge them
    parts = int(papers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = papers.select("paper_id", "title", citation_weight(F.col("citation_count")).alias("w")).repartition(parts, "paper_id")
    one = rows.groupBy("paper_id", "title", "w").agg(F.count(F.lit(1)).alias("same"))
    return one.withColumn("nth", F.row_number().over(Window.partitionBy("paper_id").orderBy("title", "w")))


def _occurrences(numbered: DataFrame, low: int, high: int, excluded: tuple[str, ...]) -> DataFrame:
    """(paper_id, nth, w, same, term, first): each time that a candidate stands in a title; ``first`` marks one of those in the same title.

    A title's terms are sorted within its row, so no title is sent along with its terms.
    """
    keys = ["paper_id", "nth", "w", "same"]
    rows = numbered.select(*keys, title_tokens(F.coalesce("title", F.lit(""))).alias("t")).select(*keys, F.sort_array(ngrams(F.col("t"), low, high)).alias("s"))
    before = F.slice(F.concat(F.array(F.lit(None).cast("string")), "s"), F.lit(1), F.size("s"))
    marked = F.zip_with("s", before, lambda x, y: F.struct(x.alias("term"), (y.isNull() | (x != y)).alias("first")))
    # an outer explode, as from an inner one Spark infers a filter that makes the terms a second time
    rows = rows.select(*keys, F.explode_outer(marked).alias("x")).select(*keys, "x.term", "x.first")
    return rows.filter(F.col("term").isNotNull() & ~excluded_term(F.col("term"), excluded))


def _scored(rows: DataFrame, least: int) -> DataFrame:
    stats = rows.groupBy("term").agg(F.count_if("first").alias("doc_freq"), F.sum("same").alias("total_freq"), F.sum(F.when(F.col("first"), F.col("w"))).alias("citation_weight")).filter(F.col("doc_freq") >= least)
    return stats.select("term", F.size(F.split("term", " ")).alias("n_tokens"), "doc_freq", "total_freq", F.round("citation_weight", 4).alias("citation_weight"), F.round(candidate_score(F.col("doc_freq"), F.col("total_freq"), F.col("citation_weight")), 4).alias("combined_score"))


def candidate_scores(papers: DataFrame, *, low: int = 2, high: int = 3, least: int = 2, excluded: tuple[str, ...] = ()) -> DataFrame:
    """``candidate_terms`` without examples, which cost most."""
    return _scored(_occurrences(_numbered(papers), low, high, excluded), least)


def candidate_terms(papers: DataFrame, *, low: int = 2, high: int = 3, least: int = 2, excluded: tuple[str, ...] = (), examples: int = 3, top: int | None = None) -> DataFrame:
    """(term, n_tokens, doc_freq, total_freq, citation_weight, combined_score, example_titles), the examples the first titles by paper_id.

    Terms carry which papers are their examples. Those that have the same ones are gathered, and titles are fetched once for each such
    group, for terms of a long title are many and nearly all in the same papers; only the result repeats titles by term.
    """
    numbered = _numbered(papers)
    rows = _occurrences(numbered, low, high, excluded)
    out = _scored(rows, least)
    if top is not None:
        out = out.orderBy(F.desc("combined_score"), F.desc("doc_freq"), F.desc("citation_weight"), "term").limit(top)
    order = Window.partitionBy("term").orderBy("paper_id", "nth")
    # Spark pushes the bound on row_number below the shuffle, so a frequent term sends a few papers from each task
    few = rows.filter("first").select("term", "paper_id", "nth").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= examples)
    few = few.groupBy("term").agg(F.array_sort(F.collect_list(F.struct("place", "paper_id", "nth"))).alias("of"))
    groups = out.join(few, "term").groupBy("of").agg(F.collect_list(F.struct(*out.columns)).alias("terms"))
    sent = groups.select("of", "terms", F.explode_outer("of").alias("x")).select("of", F.when(F.col("x.place") == 1, F.col("terms")).alias("terms"), "x.*")
    titles = numbered.select(F.col("paper_id").alias("_id"), F.col("nth").alias("_nth"), "title")
    found = sent.join(titles, F.col("paper_id").eqNullSafe(F.col("_id")) & (F.col("nth") == F.col("_nth"))).groupBy("of")
    found = found.agg(F.flatten(F.collect_list("terms")).alias("terms"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "title"))), lambda x: x["title"]), " | ").alias("example_titles"))
    return found.select(F.explode_outer("terms").alias("x"), "example_titles").select("x.*", "example_titles")


def draft_topics(candidates: DataFrame, rules: list[tuple[str, list[str]]], *, least: int = 2, most: int = 10) -> DataFrame:
    """(topic, keyword, keyword_pos): terms go to the first rule that has a pattern within them, and a rule of fewer than ``least`` gives its terms back.

    Which rules fall away decides what later ones get, so rules are settled in order; each step counts within the cluster and the driver
    sees one number. All matched terms are used up, the first ``most`` are keywords.
    """
    left, out = candidates.select("term").distinct(), None
    for topic, patterns in rules:
        hit = F.lit(False)
        for p in patterns:
            hit = hit | F.contains(F.col("term"), normalized(F.lit(p)))
        mine = left.filter(hit)
        if mine.limit(least).count() < least:
            continue
        got = mine.orderBy("term").limit(most).withColumn("keyword_pos", F.row_number().over(Window.orderBy("term")))
        got = got.select(F.lit(topic).alias("topic"), F.col("term").alias("keyword"), "keyword_pos")
        out, left = got if out is None else out.union(got), left.filter(~hit)
    return out if out is not None else candidates.sparkSession.createDataFrame([], "topic string, keyword string, keyword_pos int")
