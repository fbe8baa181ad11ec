"""BibTeX entries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.functions.text import latex, year_within
from folioscope.lineage import cut, placed


def base_keys(records: DataFrame) -> DataFrame:
    """Records (paper_id, title, authors, year, journal, doi, ord) that have a DOI, with ``year`` as text and ``base``, the key before collisions.

    It is the first author's last name and the year, else the id's first eight characters.
    """
    y = year_within(F.coalesce(F.col("year").cast("string"), F.lit("")))
    first = F.element_at(F.filter(F.split(F.get("authors", F.lit(0)), r"(?U)\s+"), lambda w: w != ""), -1)
    name = F.regexp_replace(first, "[^a-zA-Z0-9]", "")
    made = F.when((F.size("authors") > 0) & (y != "") & name.isNotNull(), F.concat(name, y)).otherwise(F.substring(F.coalesce("paper_id", F.lit("paper")), 1, 8))
    return records.filter("doi IS NOT NULL AND doi <> ''").withColumn("year", y).withColumn("base", made)


def cite_keys(keyed: DataFrame) -> DataFrame:
    """``citekey``: in the order of ``ord`` each record gets its base, or the base with the first of 1, 2, ... behind it that no record before it has.

    A base's records mostly have a key to themselves, which is told from their place. Only where a base may be what another base and a number make do records of several bases
    depend on each other; those, which are few, are settled one after the other within what is left of their base without its last digits.
    """
    sizes = cut(keyed.groupBy("base").agg(F.count(F.lit(1)).alias("n")))
    digits = F.length(F.regexp_extract("base", "([0-9]+)$", 1))
    tails = sizes.filter((digits > 0) & (F.length("base") > 1)).select("base", "n", F.explode(F.sequence(F.lit(1), F.least(digits, F.length("base") - 1, F.lit(18)))).alias("k"))
    tails = tails.select("base", "n", F.expr("left(base, length(base) - k)").alias("front"), F.expr("right(base, k)").alias("tail")).filter("NOT startswith(tail, '0') AND front <> ''")
    reach = tails.groupBy("front").agg(F.sum("n").alias("others"))
    fronts = sizes.select(F.col("base").alias("front"), F.col("n").alias("own")).filter("own > 1")
    edges = tails.join(fronts, "front").join(reach, "front").filter("CAST(tail AS BIGINT) <= own + others")
    tangled = cut(edges.select(F.col("base").alias("tangled")).union(edges.select("front")).distinct())
    rows = placed(keyed, "base", "ord", "n")
    alone = rows.join(tangled, F.col("base") == F.col("tangled"), "left_anti")
    alone = alone.withColumn("citekey", F.when(F.col("n") == 0, F.col("base")).otherwise(F.concat("base", F.col("n").cast("string")))).drop("n")
    rest = keyed.join(tangled, F.col("base") == F.col("tangled"), "left_semi").withColumn("_stem", F.regexp_replace("base", "[0-9]+$", ""))
    schema = T.StructType([*keyed.schema.fields, T.StructField("citekey", T.StringType())])
    return alone.select(*keyed.columns, "citekey").union(rest.groupBy("_stem").applyInPandas(_in_turn, schema))


def _in_turn(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.drop(columns="_stem").sort_values("ord")
    used, tried, keys = set(), {}, []
    for base in rows["base"]:
        key = base
        while key in used:
            tried[base] = tried.get(base, 0) + 1
            key = f"{base}{tried[base]}"
        used.add(key)
        keys.append(key)
    return rows.assign(citekey=keys)


def entries(keyed: DataFrame) -> DataFrame:
    """(citekey, entry)."""
    line = lambda name, value: F.concat(F.lit(f"  {name} = {{"), value, F.lit("}"))
    authors = F.array_join(F.transform("authors", latex), " and ")
    journal = latex(F.col("journal"))
    lines = F.array_compact(F.array(line("title", latex(F.col("title"))), line("author", authors), line("year", F.col("year")), F.when(journal != "", line("journal", journal)), line("doi", F.col("doi"))))
    return keyed.select("citekey", F.concat(F.lit("@article{"), "citekey", F.lit(",\n"), F.array_join(lines, ",\n"), F.lit("\n}")).alias("entry"))
