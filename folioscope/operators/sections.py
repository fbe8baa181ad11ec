"""Section trees of documents as flat rows.

A heading or block is a row (doc_id, ord, ...) in reading order. A section has its path, the ``ord`` of each section from the root down to
itself, so cutting a tree needs no recursion: whatever holds of an ancestor holds of an element of the path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.text import is_abstract, section_title, short_upper, without_definitions, word_count

DROP = ("abstract", "introduction", "discussion", "conclusion", "conclusions", "references")
KEEP = ("method", "methods", "result", "results")
LEAST_WORDS = 10


def heading_levels(headings: DataFrame) -> DataFrame:
    """Rows (doc_id, ord, title, raw) with ``level``: the raw level if above 1; 2 for a short capital heading after an abstract; else 1.

    An abstract heading begins that state, a capital heading leaves it and any other ends it.
    """
    before = Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    raw = F.coalesce("raw", F.lit(1))
    event = F.when(raw > 1, False).when(is_abstract(F.col("title")), True).when(short_upper(F.col("title")), F.lit(None)).otherwise(False)
    state = F.coalesce(F.last("event", ignorenulls=True).over(before), F.lit(False))
    level = F.when(raw > 1, raw).when(is_abstract(F.col("title")), 1).when(short_upper(F.col("title")) & F.col("state"), 2).otherwise(1)
    return headings.withColumn("event", event).withColumn("state", state).withColumn("level", level.cast("int")).drop("event", "state")


def section_text(items: DataFrame) -> DataFrame:
    """(doc_id, section_ord, title, text) of items (doc_id, ord, is_heading, text, furniture): blocks join the latest heading before them.

    Blocks before the first heading make the preamble, of a null ``section_ord``. Blank blocks and furniture are left out.
    """
    body = items.filter(~F.coalesce("furniture", F.lit(False)))
    w = Window.partitionBy("doc_id").orderBy("ord")
    at = body.withColumn("section_ord", F.last(F.when(F.col("is_heading"), F.col("ord")), ignorenulls=True).over(w))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("is_heading") & (F.trim("text") != ""), F.struct("ord", F.trim("text").alias("t"))))), lambda x: x["t"]), "\n\n")
    return at.groupBy("doc_id", "section_ord").agg(F.max(F.when(F.col("is_heading"), F.trim("text"))).alias("title"), text.alias("text"))


def section_tree(headings: DataFrame) -> DataFrame:
    """Rows (doc_id, ord, level, ...) with ``parent_ord``, ``path`` and ``section_id``.

    A section's parent is the nearest heading before it of a smaller level. A document's headings are folded once with a stack, which is a
    section's path, and ids go in reading order.
    """
    others = [c for c in headings.columns if c not in ("doc_id", "ord", "level")]
    own = F.array_sort(F.collect_list(F.struct("ord", "level", *others)))
    row = "struct<ord:bigint,level:int>"
    fold = F.expr(
        f"aggregate(hs, struct(cast(array() AS array<{row}>) AS stack, cast(array() AS array<array<bigint>>) AS paths),"
        " (s, h) -> struct(concat(filter(s.stack, x -> x.level < h.level), array(struct(cast(h.ord AS bigint) AS ord, cast(h.level AS int) AS level))) AS stack,"
        " concat(s.paths, array(concat(transform(filter(s.stack, x -> x.level < h.level), x -> x.ord), array(cast(h.ord AS bigint))))) AS paths), s -> s.paths)"
    )
    docs = headings.groupBy("doc_id").agg(own.alias("hs")).withColumn("paths", fold)
    flat = docs.select("doc_id", F.posexplode(F.arrays_zip("hs", "paths")).alias("n", "z"))
    path = F.col("z.paths")
    return flat.select("doc_id", "z.hs.*", path.alias("path"), F.when(F.size(path) > 1, F.element_at(path, -2)).alias("parent_ord"), F.format_string("sec_%03d", F.col("n") + 1).alias("section_id"))


def title_drops(title: Column, paper_title: Column | None = None) -> Column:
    """Whether a title alone drops its section: the paper's own, or one with a dropping word and no keeping one."""
    t = section_title(F.coalesce(title, F.lit("")))
    w = F.split(t, " ")
    drop = F.arrays_overlap(w, F.array(*map(F.lit, DROP))) & ~F.arrays_overlap(w, F.array(*map(F.lit, KEEP)))
    if paper_title is None:
        return drop
    return drop | F.coalesce((t != "") & (t == section_title(paper_title)), F.lit(False))


def has_content(text: Column) -> Column:
    return F.contains(text, F.lit("Table:")) | (word_count(text) > LEAST_WORDS)


def pruned(sections: DataFrame, dropped: Column, content: Column) -> DataFrame:
    """Sections that aren't below or at a dropped one and that have content or a descendant left that has.

    Each document's sections are told from its own list of paths: one gathering by document, no join.
    """
    doc = Window.partitionBy("doc_id")
    rows = sections.withColumn("_drop", F.coalesce(dropped, F.lit(False))).withColumn("_gone", F.collect_set(F.when(F.col("_drop"), F.col("ord").cast("bigint"))).over(doc))
    rows = rows.withColumn("_ok", F.coalesce(content, F.lit(False)) & ~F.arrays_overlap("path", "_gone"))
    rows = rows.withColumn("_live", F.array_distinct(F.flatten(F.collect_list(F.when(F.col("_ok"), F.col("path"))).over(doc))))
    return rows.filter(F.array_contains("_live", F.col("ord").cast("bigint"))).drop("_drop", "_gone", "_ok", "_live")


def rule_filtered(sections: DataFrame, paper_title: Column | None = None) -> DataFrame:
    return pruned(sections, title_drops(F.col("title"), paper_title), has_content(F.coalesce("text", F.lit(""))))


def classifier_filtered(sections: DataFrame, decisions: DataFrame) -> DataFrame:
    """Sections none of whose path is dropped, with the decision on each; a missing one is ``uncertain`` and keeps.

    ``decisions`` has doc_id, section_id, decision and reason.
    """
    rows = sections.join(decisions, ["doc_id", "section_id"], "left").withColumn("decision", F.coalesce("decision", F.lit("uncertain")))
    gone = F.collect_set(F.when(F.col("decision") == "drop", F.col("ord").cast("bigint"))).over(Window.partitionBy("doc_id"))
    return rows.withColumn("_gone", gone).filter(~F.arrays_overlap("path", "_gone")).drop("_gone")


def final(sections: DataFrame) -> DataFrame:
    """Texts freed of definitions, then sections without content dropped."""
    clean = sections.withColumn("text", without_definitions(F.coalesce("text", F.lit(""))))
    return pruned(clean, F.lit(False), has_content(F.col("text")))


def table_rows(cells: DataFrame) -> DataFrame:
    """(table_id, row_no, row_text) of cells (table_id, pos, row, col, end_row, end_col, text): later cells overwrite, blank rows fall away.

    A table is as large as its cells' ends say; cells outside of it are ignored and missing ones are blank.
    """
    size = Window.partitionBy("table_id")
    at = cells.withColumn("rows", F.max("end_row").over(size)).withColumn("cols", F.max("end_col").over(size)).filter("row >= 0 AND col >= 0 AND row < rows AND col < cols")
    some = at.filter("trim(text) <> ''").groupBy("table_id", "row", "col", "cols").agg(F.max_by(F.trim("text"), F.struct("pos", "text")).alias("t"))
    lines = some.groupBy("table_id", "row", "cols").agg(F.map_from_entries(F.collect_list(F.struct("col", "t"))).alias("m"))
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.col("cols") - 1), lambda c: F.coalesce(F.col("m")[c], F.lit(""))), " | ")
    return lines.select("table_id", F.col("row").alias("row_no"), text.alias("row_text"))


def prompt_sections(sections: DataFrame) -> DataFrame:
    """(doc_id, sections_text, available_sections): each top section as ``## title`` and its tree's text, in order; empty ones are left out."""
    own = F.trim(F.coalesce("text", F.lit("")))
    title = F.trim(F.coalesce("title", F.lit("")))
    rows = sections.withColumn("root", F.element_at("path", 1)).withColumn("own", own)
    # a heading counts where something at or below it has text
    doc = Window.partitionBy("doc_id")
    rows = rows.withColumn("live", F.array_distinct(F.flatten(F.collect_list(F.when(own != "", F.col("path"))).over(doc)))).filter(F.array_contains("live", F.col("ord").cast("bigint")))
    head = F.when(F.size("path") == 1, F.concat(F.lit("## "), F.when(title != "", title).otherwise("Untitled Section"), F.lit("\n"))).when(title != "", F.concat(title, F.lit("\n"))).otherwise("")
    # where a section has no text of its own its first subsection follows its title at once
    piece = F.concat(head, F.col("own"))
    tops = rows.groupBy("doc_id", "root").agg(F.array_sort(F.collect_list(F.struct("ord", F.when(F.col("own") == "", F.regexp_replace(piece, "\n$", "\n")).otherwise(F.concat(piece, F.lit("\n\n"))).alias("p")))).alias("ps"), F.max(F.when(F.size("path") == 1, F.when(title != "", title).otherwise("Untitled Section"))).alias("name"))
    tops = tops.select("doc_id", "root", "name", F.rtrim(F.regexp_replace(F.array_join(F.transform("ps", lambda x: x["p"]), ""), "\n+$", "")).alias("text"))
    listed = tops.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("root", "name", "text"))).alias("s"))
    return listed.select("doc_id", F.array_join(F.transform("s", lambda x: x["text"]), "\n\n").alias("sections_text"), F.array_join(F.transform("s", lambda x: x["name"]), ", ").alias("available_sections"))


def lines_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, ord, line) of each line."""
    return docs.select("doc_id", F.posexplode(F.split(text, "\n")).alias("ord", "line"))

