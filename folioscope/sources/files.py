"""Papers, lists, metadata, bibliographies and registries read from files, and artifacts written to them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscope.functions.text import doi, match_key, normalized, optional

PAPER = "paper_id string, title string, year string, doi string, journal string, citation_count string"
METADATA = "paperId string, document_id string, title string, year int, citationCount int, doi string, arxiv string, pdf_url string, abstract string, parent_papers array<string>, seed_papers array<string>, is_seed_paper boolean, authors array<string>, journal string, venue string, publication_title string"


def papers(spark: SparkSession, path: str) -> DataFrame:
    """A CSV, JSONL or NDJSON of papers; a row without an id or title, a year that is none, and another suffix are errors."""
    suffix = Path(path).suffix.lower()
    if suffix == ".csv":
        raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    elif suffix in (".jsonl", ".ndjson"):
        raw = spark.read.schema(PAPER).option("mode", "FAILFAST").json(path)
    else:
        raise ValueError(f"no reader for {suffix or path}")
    have = {c.lower() for c in raw.columns}
    for c in ("year", "doi", "journal", "citation_count"):
        raw = raw if c in have else raw.withColumn(c, F.lit(None).cast("string"))
    need = lambda c: F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.raise_error(F.lit(f"a row has no {c}")).cast("string")).otherwise(F.trim(c))
    blank = lambda c: F.when(F.trim(c) != "", F.trim(c))
    return raw.select(need("paper_id").alias("paper_id"), need("title").alias("title"), blank("year").cast("int").alias("year"), blank("doi").alias("doi"), blank("journal").alias("journal"), blank("citation_count").try_cast("int").alias("citation_count"))


def citation_rows(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of citations as papers ``citation-row-N``; rows without a title are left out but counted."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    numbered = raw.rdd.zipWithIndex().map(lambda x: (*x[0], x[1] + 1)).toDF([*raw.columns, "_n"]) if raw.columns else raw
    return numbered.filter("trim(title) <> ''").withColumn("paper_id", F.concat(F.lit("citation-row-"), F.col("_n").cast("string"))).drop("_n")


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(line, pos) of a text file, blank lines and those that begin with ``#`` left out, each at its first place."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("pos", "line")).select(F.trim("line").alias("line"), "pos")
    return rows.filter("line <> '' AND NOT startswith(line, '#')").groupBy("line").agg(F.min("pos").alias("pos"))


def doi_list(spark: SparkSession, path: str, fallback: str | None = None) -> DataFrame:
    """(doi, pos); where the file is missing the fallback alone, or an error without one."""
    if not Path(path).exists():
        if fallback is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([(fallback, 0)], "doi string, pos int").withColumn("doi", doi(F.col("doi")))
    return listed(spark, path).groupBy(doi(F.col("line")).alias("doi")).agg(F.min("pos").alias("pos"))


def keywords(spark: SparkSession, path: str) -> list[str]:
    """The normalised terms of a dictionary file in order, without repeats; an error if there are none."""
    rows = listed(spark, path).select(normalized(F.col("line")).alias("k"), "pos").filter("k <> ''").groupBy("k").agg(F.min("pos").alias("pos")).orderBy("pos").collect()
    if not rows:
        raise ValueError(f"no terms in {path}")
    return [r["k"] for r in rows]


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata records of a folder of JSON files, flat or below ``metadata``, with ``file``; malformed files are left out."""
    raw = spark.read.schema(f"metadata struct<{METADATA.replace(' ', ':').replace(',:', ',')}>, {METADATA}").option("multiLine", True).option("mode", "PERMISSIVE").option("pathGlobFilter", "*.json").json(path)
    names = [x.strip().split(" ")[0] for x in METADATA.split(", ")]
    flat = raw.select(F.input_file_name().alias("file"), *[F.coalesce(F.col("metadata")[c], F.col(c)).alias(c) for c in names])
    return flat.filter("title IS NOT NULL OR doi IS NOT NULL OR paperId IS NOT NULL")


def metadata_index(records: DataFrame) -> DataFrame:
    """One record of each DOI, that of the last file by name."""
    last = Window.partitionBy("_doi").orderBy(F.desc("file"))
    return records.withColumn("_doi", doi(F.col("doi"))).filter("_doi <> ''").withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n", "doi").withColumnRenamed("_doi", "doi")


def match_records(records: DataFrame) -> DataFrame:
    """(doi, base_name, key, citations) of the records that have a DOI and a title with letters or digits."""
    from folioscope.functions.text import base_name

    rows = records.select(doi(F.col("doi")).alias("doi"), base_name(F.col("doi")).alias("base_name"), match_key(F.col("title")).alias("key"), F.col("citationCount").alias("citations"))
    return rows.filter("doi <> '' AND key <> ''")


_ENTRY = re.compile(r"@\w+\s*\{\s*([^,\s]+)\s*,(.*?)\n\}", re.S)


def bib_field(body: str, name: str) -> str | None:
    """A field's value: in braces, which may nest, in quotes, or bare up to a comma or line end."""
    m = re.search(rf"(?:^|[\s,]){re.escape(name)}\s*=\s*", body, re.I)
    if not m:
        return None
    rest = body[m.end() :]
    if rest.startswith("{"):
        depth = 0
        for i, c in enumerate(rest):
            depth += (c == "{") - (c == "}")
            if depth == 0:
                return rest[1:i].strip()
        return None
    if rest.startswith('"'):
        end = rest.find('"', 1)
        return rest[1:end].strip() if end > 0 else None
    return re.split(r"[,\n]", rest, maxsplit=1)[0].strip() or None


def bibliography(spark: SparkSession, path: str) -> DataFrame:
    """(citekey, doi, title, key) of each entry of BibTeX files. Nested braces aren't regular, so entries are read in Python, a file at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, bib_field(b, "doi"), bib_field(b, "title")) for text in batch["value"] for k, b in _ENTRY.findall(text)]
            yield pd.DataFrame(rows, columns=["citekey", "raw", "title"])

    rows = spark.read.text(path, wholetext=True).mapInPandas(run, "citekey string, raw string, title string")
    return rows.select("citekey", doi(F.col("raw")).alias("doi"), "title", match_key(F.coalesce("title", F.lit(""))).alias("key"))


def relations(spark: SparkSession, path: str) -> DataFrame:
    """(doi, stem, key): up to two names of files for each row of a CSV that relates DOIs to attachments."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    stem = lambda c: F.regexp_replace(F.regexp_extract(F.regexp_replace(optional(F.col(c)), "^storage:", ""), r"([^/\\]+)$", 1), r"\.[^.]+$", "")
    rows = raw.select(doi(F.col("doi")).alias("doi"), F.explode(F.array_compact(F.array_distinct(F.array(stem("attachment_path_raw"), stem("resolved_pdf_path"))))).alias("stem"))
    return rows.filter("doi <> '' AND stem <> ''").withColumn("key", match_key(F.col("stem")))


def hashed_files(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """(path, sha256, modified, length) of binary files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("modified"), "length")


def fetched(spark: SparkSession, dois: DataFrame, fetch: Callable[[str], list[dict]], schema: str) -> DataFrame:
    """What a service gives for each DOI. One task asks, so its rate limit holds; ``fetch`` keeps to it and retries."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([r for d in batch["doi"] for r in fetch(d)])

    return dois.select("doi").coalesce(1).mapInPandas(run, schema)


def write_lines(rows: DataFrame, column: str, path: str, order: list, limit: int | None = None) -> None:
    """The first ``limit`` values in order, one a line, in one file."""
    ordered = rows.orderBy(*order).select(F.col(column).cast("string"))
    (ordered if limit is None else ordered.limit(limit)).coalesce(1).write.mode("overwrite").text(path)


def write_tables(tables: dict[str, DataFrame], folder: str, kind: str = "parquet") -> dict[str, str]:
    """Each table below ``folder`` by name."""
    for name, df in tables.items():
        df.write.mode("overwrite").format(kind).option("header", True).save(f"{folder}/{name}")
    return {name: f"{folder}/{name}" for name in tables}
