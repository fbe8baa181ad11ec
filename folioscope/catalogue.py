"""Queries over the supplied tables, by name, with DuckDB SQL for the same rows.

The tables stand for a paper collection: documents are papers whose title is their first line, their characters are citations; parts
are papers with short titles; events are stage events of papers; orders of a customer are repeated records of one paper.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import text as T
from folioscope.lineage import shared_folder
from folioscope.operators import bibliography, claims, merge, registry, resolve, sections, seeds, source_documents, terms
from folioscope.plans import oracles
from folioscope.streaming import registry as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = oracles.SQL

TOPICS = oracles.TOPICS
RULES = oracles.RULES


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def titled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as papers."""
    d = read(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("paper_id"), F.substring_index("text", "\n", 1).alias("title"), F.col("source").alias("journal"), F.col("n_chars").alias("citation_count"))


def short_papers(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as papers with years."""
    p = read(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("paper_id"), F.col("p_name").alias("title"), (F.lit(1970) + F.col("p_size")).alias("year"), F.floor("p_retailprice").cast("int").alias("citation_count"), F.col("p_brand").alias("journal"))


@query
def term_stats(spark: SparkSession, sf: str) -> DataFrame:
    return terms.term_stats(terms.paper_terms(titled(spark, sf)))


@query
def term_index(spark: SparkSession, sf: str) -> DataFrame:
    found = terms.term_index(terms.paper_terms(titled(spark, sf)))
    return found.select("term", F.array_join(F.transform("paper_ids", lambda i: i.cast("string")), ",").alias("paper_ids"))


def _matches(spark: SparkSession, sf: str) -> DataFrame:
    return terms.topic_matches(terms.paper_terms(short_papers(spark, sf)), terms.topic_rows(spark, TOPICS))


@query
def paper_topics(spark: SparkSession, sf: str) -> DataFrame:
    return terms.paper_topics(short_papers(spark, sf), _matches(spark, sf))


@query
def topic_stats(spark: SparkSession, sf: str) -> DataFrame:
    return terms.topic_stats(short_papers(spark, sf), _matches(spark, sf))


@query
def topic_cooccurrence(spark: SparkSession, sf: str) -> DataFrame:
    return terms.cooccurrence(_matches(spark, sf))


@query
def unclassified_papers(spark: SparkSession, sf: str) -> DataFrame:
    return terms.unclassified(short_papers(spark, sf), _matches(spark, sf)).select("paper_id", "title", "year", "journal")


@query
def unmapped_terms(spark: SparkSession, sf: str) -> DataFrame:
    return terms.unmapped(terms.term_stats(terms.paper_terms(short_papers(spark, sf))), terms.topic_rows(spark, TOPICS))


@query
def audit_summary(spark: SparkSession, sf: str) -> DataFrame:
    return terms.summary(short_papers(spark, sf), _matches(spark, sf))


@query
def papers_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return terms.within_years(short_papers(spark, sf), 1990, 2005).select("paper_id", "title", "year")


@query
def candidate_terms(spark: SparkSession, sf: str) -> DataFrame:
    return terms.candidate_terms(titled(spark, sf)).drop("citation_weight", "combined_score")


@query
def candidate_scores(spark: SparkSession, sf: str) -> DataFrame:
    found = terms.candidate_scores(titled(spark, sf))
    return found.select("term", F.round("citation_weight", 1).alias("citation_weight"), F.round("combined_score", 1).alias("combined_score"))


@query
def draft_topics(spark: SparkSession, sf: str) -> DataFrame:
    return terms.draft_topics(terms.candidate_scores(short_papers(spark, sf), low=1, high=2), RULES)


def _doi(column: str) -> F.Column:  # type: ignore[name-defined]
    return F.concat(F.lit("https://doi.org/10.5555/D"), F.col(column).cast("string"))


@query
def keyword_seeds(spark: SparkSession, sf: str) -> DataFrame:
    m = titled(spark, sf).withColumn("doi", _doi("paper_id"))
    done = read(spark, sf, "labels").filter("quality = 0").select(_doi("doc_id").alias("doi"))
    return seeds.keyword_seeds(m, done, oracles.KEYWORDS, 200)


@query
def gap_seeds(spark: SparkSession, sf: str) -> DataFrame:
    m = titled(spark, sf).withColumn("doi", _doi("paper_id"))
    labels = read(spark, sf, "labels")
    done = labels.filter("quality = 0").select(_doi("doc_id").alias("doi"))
    open_ = m.join(labels.filter("toxic = 1").select(F.col("doc_id").alias("paper_id")).distinct(), "paper_id", "left_semi")
    return seeds.gap_seeds(m.select("doi", "title"), open_.select("doi", "title"), m, done, oracles.GAP_TOPICS, 200)


@query
def seed_frontier(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    queue = o.select(_doi("o_custkey").alias("doi"), F.col("o_orderkey").alias("pos"))
    return seeds.frontier(queue, o.filter("o_orderstatus = 'F'").select(_doi("o_custkey").alias("doi")))


@query
def doi_normalise(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "pages").select("page_id", F.col("url").alias("raw"))
    made = p.withColumns({"doi": T.doi(F.col("raw")), "slug": T.doi_slug(F.col("raw")), "base_name": T.base_name(F.col("raw"))})
    return made.withColumn("format", T.parsed_base_name(F.col("base_name"))["format"])


def _items(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("item"), T.match_key(F.col("text")).alias("key"))


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select(F.concat(F.lit("doi-"), F.col("doc_id")).alias("base_name"), T.match_key(F.col("text")).alias("key"), F.col("n_chars").alias("citations"))


@query
def title_match_exact(spark: SparkSession, sf: str) -> DataFrame:
    p = short_papers(spark, sf)
    items = p.filter("year > 2015").select(F.col("paper_id").cast("string").alias("item"), T.match_key(F.col("title")).alias("key"))
    records = p.filter("year <= 1980").select(F.concat(F.lit("doi-"), "paper_id").alias("base_name"), F.col("citation_count").alias("citations"), T.match_key(F.concat("title", F.lit("!"))).alias("key"))
    return resolve.exact_titles(items, records)


@query
def title_match_partial(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.partial_titles(_items(spark, sf), _records(spark, sf))


@query
def title_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.partial_pairs(_items(spark, sf), _records(spark, sf))


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    d = titled(spark, sf).withColumn("base_name", F.concat(F.lit("doi-10.5555-d"), F.col("paper_id").cast("string"))).withColumn("doi", F.concat(F.lit("10.5555/d"), F.col("paper_id").cast("string")))
    meta = d.select("doi", "base_name", T.match_key(F.col("title")).alias("key"), F.col("citation_count").alias("citations"))
    i, name = F.col("paper_id"), F.col("title")
    file = F.when(i % 10 == 5, F.concat(F.lit("D"), i.cast("string"), F.lit("__"), "base_name", F.lit(".pdf"))).when(i % 5 == 0, F.concat("base_name", F.lit(".pdf"))).when(i % 5 == 1, F.concat(F.lit("copy of 10.5555/d"), i.cast("string"), F.lit("_.pdf"))).when(i % 5 == 2, F.concat(F.lit("A - 2004 - "), name, F.lit(".pdf"))).when(i % 5 == 3, F.concat(F.substring(name, 1, 60), F.lit(".PDF"))).otherwise(F.concat(F.lit("scan "), i.cast("string"), F.lit(".pdf")))
    files = d.select(file.alias("file")).distinct()
    bib = d.filter("paper_id % 2 = 0").select("doi", T.match_key(name).alias("key"))
    relations = d.filter("paper_id % 3 = 0").select("base_name", T.match_key(name).alias("key"))
    return resolve.resolved(files, meta, bib, relations)


@query
def resolve_cascade(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf)


@query
def match_audit(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.match_audit(_resolved(spark, sf))


@query
def rename_plan(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.rename_plan(_resolved(spark, sf))


@query
def citation_filter(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("seed"), F.col("l_partkey").alias("paper"), F.floor("l_extendedprice").cast("int").alias("citations"), F.year("l_shipdate").alias("year"))
    return seeds.cited_enough(e, 40_000, 1995)


@query
def storage_state(spark: SparkSession, sf: str) -> DataFrame:
    labels = read(spark, sf, "labels").select(F.col("doc_id").alias("paper"), "quality")
    return seeds.storage_state(read(spark, sf, "documents").select(F.col("doc_id").alias("paper")), labels.filter("quality = 1"), labels.filter("quality = 0"))


@query
def selection_batches(spark: SparkSession, sf: str) -> DataFrame:
    return seeds.batches(read(spark, sf, "orders"), "o_custkey", "o_orderkey", 5)


@query
def decision_merge(spark: SparkSession, sf: str) -> DataFrame:
    labels = read(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "keep").when(F.col("toxic") == 1, "bad").otherwise("drop").alias("decision"), F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("reason"), F.col("doc_id").alias("pos"))
    return seeds.merged_decisions(read(spark, sf, "documents").select(F.col("doc_id").alias("id")), labels)


@query
def metadata_merge(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderpriority")).alias("journal"), F.when(F.col("o_orderkey") % 2 == 0, F.year("o_orderdate")).alias("year"), F.array("o_orderstatus", F.lit("")).alias("parents"), F.array("o_orderpriority").alias("seeds"), (F.col("o_totalprice") > 400_000).alias("is_seed"))
    m = merge.metadata(o, "key", "seq", ["journal", "year"], ["parents", "seeds"], "is_seed")
    return m.withColumns({"parents": F.array_join("parents", ","), "seeds": F.array_join("seeds", ",")})


@query
def discard_merge(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "conversations").filter("conv_id IS NOT NULL")
    rows = c.select(F.col("conv_id").alias("key"), F.col("turn").alias("seq"), F.when(F.col("role") == "user", F.sha2("text", 256)).alias("selection"), F.array("role").alias("parents"))
    m = merge.metadata(rows.groupBy("key", "seq").agg(F.max("selection").alias("selection"), F.flatten(F.collect_list("parents")).alias("parents")), "key", "seq", ["selection"], ["parents"])
    return m.withColumn("parents", F.array_join("parents", ","))


@query
def discard_buckets(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").select(F.col("ts").alias("modified"), F.when(F.col("event_type") == "error", "gap-rag").otherwise("other").alias("mode"))
    return merge.discard_buckets(e)


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return sections.lines_of(read(spark, sf, "documents"))


@query
def heading_signals(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf).select("doc_id", F.col("ord").alias("line_no"), T.heading_signal(F.col("line")).alias("signal"))
    return rows.filter("signal IS NOT NULL")


def _headings(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of at most three words as headings: of one word at the top, else by their number of letters."""
    rows = _lines(spark, sf).withColumn("w", T.word_count(F.col("line"))).filter("w BETWEEN 1 AND 3")
    return rows.select("doc_id", "ord", F.col("line").alias("title"), (F.length("line") % 4).cast("int").alias("raw"))


@query
def heading_levels(spark: SparkSession, sf: str) -> DataFrame:
    return sections.heading_levels(_headings(spark, sf)).select("doc_id", "ord", "level")


def _sections(spark: SparkSession, sf: str) -> DataFrame:
    lines = _lines(spark, sf).withColumn("w", T.word_count(F.col("line")))
    items = lines.select("doc_id", "ord", F.col("w").between(1, 3).alias("is_heading"), F.col("line").alias("text"), (F.col("w") > 200).alias("furniture"))
    text = sections.section_text(items).filter("section_ord IS NOT NULL").select("doc_id", F.col("section_ord").alias("ord"), "title", "text")
    levels = sections.heading_levels(_headings(spark, sf)).select("doc_id", "ord", "level")
    return sections.section_tree(text.join(levels, ["doc_id", "ord"]))


@query
def section_text(spark: SparkSession, sf: str) -> DataFrame:
    lines = _lines(spark, sf).withColumn("w", T.word_count(F.col("line")))
    items = lines.select("doc_id", "ord", F.col("w").between(1, 3).alias("is_heading"), F.col("line").alias("text"), (F.col("w") > 200).alias("furniture"))
    return sections.section_text(items)


@query
def section_tree(spark: SparkSession, sf: str) -> DataFrame:
    return _sections(spark, sf).select("doc_id", "ord", "level", "parent_ord", "section_id")


@query
def rule_filtered_sections(spark: SparkSession, sf: str) -> DataFrame:
    return sections.rule_filtered(_sections(spark, sf)).select("doc_id", "section_id", "title")


def _decisions(rows: DataFrame) -> DataFrame:
    return rows.filter("ord % 3 <> 1").select("doc_id", "section_id", F.when(F.col("ord") % 3 == 0, "drop").otherwise("keep").alias("decision"))


@query
def llm_filtered_sections(spark: SparkSession, sf: str) -> DataFrame:
    rows = _sections(spark, sf)
    return sections.classifier_filtered(rows, _decisions(rows)).select("doc_id", "section_id", "decision")


@query
def final_sections(spark: SparkSession, sf: str) -> DataFrame:
    return sections.final(_sections(spark, sf)).select("doc_id", "section_id", F.md5("text").alias("text_md5"))


@query
def table_render(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem")
    cell = lambda pos, col, text: F.struct((F.col("l_partkey") * 3 + pos).alias("pos"), F.lit(col).alias("col"), text.alias("text"))
    cells = li.select(F.col("l_orderkey").alias("table_id"), F.col("l_linenumber").alias("row"), F.explode(F.array(cell(0, 0, F.col("l_returnflag")), cell(1, 2, F.col("l_partkey").cast("string")), cell(2, 2, F.when(F.col("l_partkey") % 2 == 0, F.lit(" even ")).otherwise(F.lit(" "))))).alias("c"))
    return sections.table_rows(cells.select("table_id", F.col("c.pos").alias("pos"), "row", F.col("c.col").alias("col"), (F.col("row") + 1).alias("end_row"), F.lit(3).alias("end_col"), F.col("c.text").alias("text")))


@query
def claims_prompt_sections(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "text"))
    top = d.select("doc_id", "ord", F.when(F.col("ord") % 2 == 0, F.concat(F.lit("Part "), F.col("ord").cast("string"))).otherwise("").alias("title"), "text", F.array(F.col("ord").cast("bigint")).alias("path"))
    return sections.prompt_sections(top).select("doc_id", F.md5("sections_text").alias("sections_md5"), "available_sections")


def _claim_docs(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select("doc_id", "text", F.col("n_chars").alias("citations"))


@query
def claim_limits(spark: SparkSession, sf: str) -> DataFrame:
    return claims.limits(_claim_docs(spark, sf))


@query
def claim_gate(spark: SparkSession, sf: str) -> DataFrame:
    labels = read(spark, sf, "labels")
    return claims.gates(_claim_docs(spark, sf), labels.filter("toxic = 1"), labels.filter("quality = 1"), 500)


@query
def claim_validation(spark: SparkSession, sf: str) -> DataFrame:
    full = ", ".join(f'"{k}": "x"' for k in claims.KEYS if k not in ("keywords", "statistics", "confidence"))
    good = "[{" + full + ', "keywords": ["a"], "statistics": {"p_value": "0.1"}, "confidence": 0.9}]'
    k = F.col("doc_id") % 5
    out = F.when(k == 0, F.lit(good)).when(k == 1, F.replace(F.lit(good), F.lit('"confidence": 0.9'), F.lit('"confidence": "high"'))).when(k == 2, F.replace(F.lit(good), F.lit('"arm": "x", '), F.lit(""))).when(k == 3, F.lit("{}")).otherwise(F.lit("no json"))
    return claims.validated(read(spark, sf, "documents").select("doc_id", out.alias("output")))


def stage_events(spark: SparkSession, sf: str) -> DataFrame:
    return _staged(read(spark, sf, "events"))


def _staged(e: DataFrame) -> DataFrame:
    stage = F.create_map(*[F.lit(x) for p in oracles.STAGES.items() for x in (p[0], p[1][1])])
    event = F.create_map(*[F.lit(x) for p in oracles.STAGES.items() for x in (p[0], p[1][0])])
    return e.select(F.col("user_id").alias("paper_id"), "ts", F.col("event_id").alias("seq"), event[F.col("event_type")].alias("event"), stage[F.col("event_type")].alias("stage"))


@query
def registry_state(spark: SparkSession, sf: str) -> DataFrame:
    return registry.state(stage_events(spark, sf))


@query
def stage_status(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select(F.concat(F.lit("doi-"), "doc_id").alias("base_name"), "doc_id", "lang")
    labels = read(spark, sf, "labels").select(F.concat(F.lit("doi-"), "doc_id").alias("base_name"), "quality", "toxic")
    kind = lambda df, k: df.select("base_name", F.lit(k).alias("kind"))
    have = kind(d, "metadata").union(kind(d.filter("lang = 'en'"), "pdf")).union(kind(d.filter("doc_id % 2 = 0"), "docling")).union(kind(labels, "filtered")).union(kind(labels.filter("quality = 1"), "final")).union(kind(labels.filter("toxic = 0"), "claims"))
    return registry.stage_status(d, have)


@query
def pending_papers(spark: SparkSession, sf: str) -> DataFrame:
    return registry.pending(stage_status(spark, sf)).select("base_name")


@query
def stage_funnel(spark: SparkSession, sf: str) -> DataFrame:
    s = stage_status(spark, sf)
    n = s.agg(*[F.count_if(k).alias(k) for k in ("metadata", "pdf", "final", "claims")]).unpivot([], ["metadata", "pdf", "final", "claims"], "stage", "n")
    return registry.funnel(n.withColumn("pos", F.array_position(F.array(*map(F.lit, ("metadata", "pdf", "final", "claims"))), F.col("stage"))))


@query
def event_envelope(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events")
    payload = F.when(F.col("event_id") % 3 == 0, F.create_map(F.lit("id"), F.lit("own"), F.lit("kind"), F.col("event_type"))).otherwise(F.create_map(F.lit("kind"), F.col("event_type")))
    kind = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("papers:"), "event_type")).otherwise(F.col("event_type"))
    return registry.envelopes(e.select(kind.alias("event_type"), F.col("user_id").cast("string").alias("paper_id"), "ts", payload.alias("payload")))


@query
def bibtex_entries(spark: SparkSession, sf: str) -> DataFrame:
    p = short_papers(spark, sf)
    records = p.select(F.format_string("part%08d", "paper_id").alias("paper_id"), F.concat("title", F.lit(" & 100%")).alias("title"), F.when(F.col("paper_id") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("Ann "), F.initcap(F.substring_index("title", " ", 1))))).alias("authors"), "year", F.when(F.col("paper_id") % 2 == 0, F.col("journal")).alias("journal"), F.concat(F.lit("10.5555/"), "paper_id").alias("doi"), F.col("paper_id").alias("ord"))
    return bibliography.entries(bibliography.cite_keys(bibliography.base_keys(records)))


@query
def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


@query
def abstract_preview(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select("doc_id", T.preview(F.col("text"), 40).alias("preview"))


@query
def ingest_unique(spark: SparkSession, sf: str) -> DataFrame:
    """The first paper of each content."""
    return content_hash(spark, sf).groupBy("sha256").agg(F.min("doc_id").alias("doc_id"))


@query
def source_items(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a parser's JSON, a text item each line, and read back in order."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("x"), T.word_count(x).alias("w")))
    label = lambda w: F.when(w.between(1, 3), "section_header").when(w > 200, "page_header").otherwise("text")
    item = lambda l: F.struct(label(l["w"]).alias("label"), l["x"].alias("text"), F.when(l["w"].between(1, 3), (F.length(l["x"]) % 4).cast("int")).alias("level"))
    body = F.struct(F.transform("xs", lambda _, k: F.struct(F.concat(F.lit("#/texts/"), k.cast("string")).alias("$ref"))).alias("children"))
    # each row is a document by itself, so nothing is shuffled and rows that repeat an id stay apart
    docs = read(spark, sf, "documents").select("doc_id", lines.alias("xs"))
    docs = docs.select("doc_id", F.to_json(F.struct(F.transform("xs", item).alias("texts"), body.alias("body"))).alias("source"))
    return source_documents.linearized(docs).select("doc_id", "ord", "is_heading", "raw", "furniture", F.md5("text").alias("text_md5"), "signal")


@query
def source_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a parser's JSON: their lines as a list, a group and two tables, a picture, and references to nothing."""
    li = read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag"))).alias("xs"))
    text = lambda label, x: F.struct(F.lit(label).alias("label"), x.alias("text"))
    ref = lambda kind, n: F.struct(F.concat(F.lit(f"#/{kind}/"), n.cast("string")).alias("$ref"))
    texts = F.concat(F.array(text("caption", F.concat(F.lit("Order  "), F.col("l_orderkey").cast("string")))), F.transform("xs", lambda x: text("list_item", F.concat(F.lit(" part  "), x["l_partkey"].cast("string")))), F.array(text("footnote", F.lit("as  shipped"))))
    lines = F.transform("xs", lambda x, i: ref("texts", i + 1))
    group = lambda label: F.struct(F.lit(label).alias("label"), lines.alias("children"))
    table = F.struct(F.array(ref("texts", F.lit(0))).alias("captions"), F.array(ref("texts", F.size("xs") + 1)).alias("footnotes"), F.transform("xs", lambda x: F.struct(F.array(F.to_json(F.struct(x["l_linenumber"].alias("text"))), x["l_returnflag"], F.lit(" ")).alias("cells"))).alias("rows"))
    cell = lambda x, i: F.struct(i.alias("start_row_offset_idx"), (i + 1).alias("end_row_offset_idx"), F.lit(1).alias("start_col_offset_idx"), F.lit(2).alias("end_col_offset_idx"), x["l_partkey"].cast("string").alias("text"))
    grid = F.struct(F.lit("Grid").alias("label"), F.struct(F.transform("xs", cell).alias("table_cells")).alias("data"))
    shown = [("groups", 0), ("groups", 1), ("tables", 0), ("tables", 1), ("pictures", 0), ("texts", 99_999), ("key_value_items", 0)]
    whole = F.struct(texts.alias("texts"), F.array(group("list"), group("section")).alias("groups"), F.array(F.struct(F.lit("p").alias("label"))).alias("pictures"), F.array(F.struct(F.lit("k").alias("label"))).alias("key_value_items"), F.struct(F.array(*[ref(k, F.lit(n)) for k, n in shown]).alias("children")).alias("body"))
    # the two tables have different fields, so they are put into the JSON as text
    tables = F.concat(F.lit('{"tables":['), F.to_json(table), F.lit(","), F.to_json(grid), F.lit("],"))
    docs = li.select(F.col("l_orderkey").alias("doc_id"), F.concat(tables, F.substring(F.to_json(whole), 2, 1 << 30)).alias("source"))
    return source_documents.linearized(docs).select("doc_id", "ord", "ref", "text")


@query
def ranked_terms(spark: SparkSession, sf: str) -> DataFrame:
    """The fifty most frequent terms, in order."""
    return terms.ranked(term_stats(spark, sf), 50)


@query
def known_ids(spark: SparkSession, sf: str) -> DataFrame:
    labels = read(spark, sf, "labels").select(F.concat(F.lit("s"), "doc_id").alias("stem"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("p"), "doc_id")).alias("paper_id"), F.lit("").alias("base_name"), "quality")
    return merge.known_ids(labels.filter("quality = 1"), labels.filter("quality = 0"))


@query
def first_kept(spark: SparkSession, sf: str) -> DataFrame:
    return merge.first_kept(read(spark, sf, "documents").select("doc_id", "lang"), read(spark, sf, "labels"), "doc_id")


@query
def registry_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Papers in the registry, and labels as what comes in about some of them."""
    d = read(spark, sf, "documents")
    old = d.filter("doc_id % 3 > 0").select(F.col("doc_id").alias("paper_id"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("10.1/"), "doc_id")).alias("doi"), F.lit("old/").alias("prefix"), F.lit("completed").alias("status_proc"), F.lit(None).cast("string").alias("status_rag"), F.lit(1).alias("last_event"))
    new = read(spark, sf, "labels").select(F.col("doc_id").alias("paper_id"), F.when(F.col("quality") == 1, F.concat(F.lit("10.2/"), "doc_id")).alias("doi"), F.lit("new/").alias("prefix"), F.lit(2).alias("last_event"))
    return registry.upserted(old, new)


@query
def registry_records(spark: SparkSession, sf: str) -> DataFrame:
    """The last line of each DOI."""
    o = read(spark, sf, "orders").select(_doi("o_custkey").alias("doi"), F.col("o_orderkey").alias("line_no"), F.col("o_orderstatus").alias("status"))
    return registry.last_records(o)


@query
def registry_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The registry folded from the events as a stream of files."""
    events = spark.readStream.schema(read(spark, sf, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return streams.run_to_folder(streams.running_state(_staged(events)), shared_folder(spark))


@query
def name_parts(spark: SparkSession, sf: str) -> DataFrame:
    """What file names and fields of text tell: a title, a DOI, a year, a value or none."""
    d = titled(spark, sf).select("paper_id", "title", F.col("paper_id").cast("string").alias("i"))
    name = F.when(F.col("paper_id") % 3 == 0, F.concat(F.lit("Ann - 20"), F.lpad((F.col("paper_id") % 100).cast("string"), 2, "0"), F.lit(" - Title "), "i", F.lit("__from-raw-pdf-2024-01-02"))).when(F.col("paper_id") % 3 == 1, F.concat(F.lit("see doi:10.5555/A."), "i", F.lit("., 1"), F.lpad((F.col("paper_id") % 1000).cast("string"), 3, "0"))).otherwise(F.element_at(F.array(*map(F.lit, (" None ", "nan", "", "x_y & z", "NULL"))), (F.col("paper_id") % 5 + 1).cast("int")))
    d = d.withColumn("name", name)
    return d.select("paper_id", T.title_hint(F.col("name")).alias("hint"), T.doi_within(F.col("name")).alias("doi"), T.optional(F.col("name")).alias("value"), T.year_within(F.col("name")).alias("year"), T.latex(F.col("name")).alias("latex"), T.legacy_base_name(F.col("i"), F.col("name")).alias("legacy"))


@query
def cut_abstracts(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select("doc_id", F.md5(T.cut_abstract(F.col("text"), 300)).alias("abstract_md5"))
