"""Parsed papers as they come from a layout parser: JSON whose body refers to texts, groups, tables and pictures by number.

A document is one row, its JSON a variant. References are looked up within the row, so nothing is joined and only what the body shows
is exploded, into one row an item in reading order.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.text import heading_signal

LISTS = ("texts", "groups", "pictures", "tables", "key_value_items")
FURNITURE = ("page_header", "page_footer")


def squeezed(x: Column) -> Column:
    """Trimmed, with white space of any kind as single spaces; an empty text for null."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\s+", " "))


def _text(v: str, path: str) -> str:
    return f"try_variant_get({v}, '{path}', 'string')"


def _refs(v: str, path: str) -> str:
    """The references of a list of objects, in order; objects without one are left out."""
    own = f"coalesce(try_variant_get({v}, '{path}', 'array<variant>'), array())"
    return f"filter(transform({own}, c -> try_variant_get(c, '$[\"$ref\"]', 'string')), r -> r IS NOT NULL)"


def _resolved(ref: str) -> str:
    """What a reference names; null for an unknown list and a number that it hasn't."""
    number = f"try_cast(substring_index({ref}, '/', -1) AS INT)"
    return "CASE " + " ".join(f"WHEN startswith({ref}, '#/{k}/') THEN get({k}, {number})" for k in LISTS) + " END"


def _rendered(value: object) -> str:
    """A cell's text: numbers as they are written, of an object the first field that has any, of a list all of its parts."""
    if isinstance(value, dict):
        for field in ("text", "value", "content", "label", "name"):
            if found := _rendered(value.get(field)):
                return found
        return next((found for field in ("items", "cells", "children") if isinstance(value.get(field), list) and (found := _rendered(value[field]))), "")
    if isinstance(value, list):
        return " ".join(filter(None, map(_rendered, value)))
    return "" if value is None else " ".join(str(value).split())


def _lines(rows: object) -> list[str]:
    """A line for each row that has a cell with text; empty cells fall away."""
    out = []
    for row in rows if isinstance(rows, list) else []:
        cells = (row.get("cells") or row.get("items")) if isinstance(row, dict) else row
        if isinstance(cells, list) and (own := list(filter(None, map(_rendered, cells)))):
            out.append(" | ".join(own))
    return out


def _grid(cells: object) -> list[str]:
    """A line for each row of a grid that has text; a cell stands where it begins, later ones over earlier ones, and empty cells keep their place."""
    cells = [c for c in cells if isinstance(c, dict)] if isinstance(cells, list) else []
    at = lambda c, side, axis: int(c.get(f"{side}_{axis}_offset_idx") or 0)
    height, width = (max((at(c, "end", axis) for c in cells), default=0) for axis in ("row", "col"))
    grid: dict[int, dict[int, str]] = {}
    for c in cells:
        row, col, text = at(c, "start", "row"), at(c, "start", "col"), _rendered(c.get("text"))
        if text and 0 <= row < height and 0 <= col < width:
            grid.setdefault(row, {})[col] = text
    return [" | ".join(grid[row].get(col, "") for col in range(width)) for row in sorted(grid)]


def table_text(table: pd.Series, captions: pd.Series, footnotes: pd.Series) -> pd.Series:
    """A table as its caption, rows and footnotes, a line each. Cells nest without a bound, which no expression follows."""

    def one(raw: str | None, above: list[str], below: list[str]) -> str | None:
        if raw is None:
            return None
        table = json.loads(raw)
        data = table.get("data")
        caption = " ".join(above).strip() or next(filter(None, (_rendered(table.get(k)) for k in ("caption", "text", "name", "label"))), "")
        rows = _lines(table.get("rows")) or _lines(data) or (_grid(data.get("table_cells")) if isinstance(data, dict) else [])
        return "\n".join([f"Table: {caption}"] * bool(caption) + rows + list(below)).strip() or "Table"

    return pd.Series([one(*x) for x in zip(table, captions, footnotes)], dtype=object)


def linearized(docs: DataFrame, source: str = "source") -> DataFrame:
    """(doc_id, ord, ref, is_heading, raw, title, text, signal, furniture) of each item that the body of a document shows, by its place there.

    Headings are section headers, with ``raw``, their level where it is a number; all else is a block with its ``text``: a paragraph, the items of a list with a dash each, those of
    another group, a table, or nothing for a picture. ``signal`` tells a paragraph that looks like a heading. Furniture, the headers and footers of pages, has only its text.
    References to nothing, items of other lists, and a source that isn't JSON give no row.
    """
    lists = [f"coalesce(try_variant_get(v, '$.{k}', 'array<variant>'), array()) AS {k}" for k in LISTS]
    rows = docs.selectExpr("doc_id", f"try_parse_json({source}) AS v").selectExpr("doc_id", *lists, f"{_refs('v', '$.body.children')} AS refs")
    texts = lambda path: f"transform({_refs('i.item', path)}, r -> {_text(f'({_resolved("r")})', '$.text')})"
    item = f"struct(r AS ref, {_resolved('r')} AS item)"
    only = lambda kind, x: f"CASE WHEN startswith(i.ref, '#/{kind}/') THEN {x} END"
    level = "CASE WHEN schema_of_variant(try_variant_get(i.item, '$.level', 'variant')) = 'BIGINT' THEN try_variant_get(i.item, '$.level', 'int') END"
    # an item is read where it is looked up, so what is exploded are plain fields, which later conditions may repeat at no cost
    fields = {
        "ref": "i.ref", "found": "i.item IS NOT NULL", "label": _text("i.item", "$.label"), "own": _text("i.item", "$.text"), "layer": f"{_text('i.item', '$.content_layer')} = 'furniture'", "level": level,
        "children": only("groups", texts("$.children")), "captions": only("tables", texts("$.captions")), "footnotes": only("tables", texts("$.footnotes")), "json": only("tables", "to_json(i.item)"),
    }
    fields_ = "struct(" + ", ".join(f"{x} AS {k}" for k, x in fields.items()) + ")"
    # from an inner explode Spark infers a filter on its list, which it pushes below the parsing, where every reference would parse the document anew
    rows = rows.selectExpr("doc_id", f"transform(transform(refs, r -> {item}), i -> {fields_}) AS items").selectExpr("doc_id", "posexplode_outer(items) AS (ord, i)").filter("i.found").selectExpr("doc_id", "ord", "i.*")
    label, ref = F.col("label"), F.col("ref")
    furniture = F.coalesce("layer", F.lit(False)) | F.coalesce(label.isin(*FURNITURE), F.lit(False))
    heading = ~furniture & F.coalesce(label == "section_header", F.lit(False))
    parts = F.filter(F.transform("children", squeezed), lambda t: t != "")
    named = lambda c: F.filter(F.transform(c, squeezed), lambda t: t != "")
    block = F.when(ref.startswith("#/texts/"), F.col("squeezed")).when(ref.startswith("#/groups/") & F.coalesce(label == "list", F.lit(False)), F.array_join(F.transform(parts, lambda t: F.concat(F.lit("- "), t)), "\n"))
    block = block.when(ref.startswith("#/groups/"), F.array_join(parts, "\n")).when(ref.startswith("#/pictures/"), F.lit("")).otherwise(F.col("table"))
    rows = rows.withColumn("table", F.pandas_udf(table_text, "string")(F.col("json"), named("captions"), named("footnotes")))
    # a paragraph is squeezed once; a signal needs no more than 80 characters of it
    rows = rows.withColumn("squeezed", F.when(ref.startswith("#/texts/") & ~furniture & ~heading, squeezed(F.col("own"))))
    own = F.coalesce("own", F.lit(""))
    out = rows.select(
        "doc_id", "ord", "ref", heading.alias("is_heading"), F.when(heading, F.col("level")).alias("raw"), F.when(heading, F.trim(own)).alias("title"), F.when(furniture | heading, own).otherwise(block).alias("text"),
        F.when(~furniture & (label == "text") & (F.length("squeezed") <= 80), heading_signal(F.col("squeezed"))).alias("signal"), furniture.alias("furniture"),
    )
    return out.filter("furniture OR is_heading OR NOT startswith(ref, '#/key_value_items/')")


def display_title(x: Column) -> Column:
    """A heading as it is shown: of capitals alone each run of letters gets one capital, else as it stands, white space squeezed."""
    clean = squeezed(x)
    runs = F.regexp_extract_all(F.lower(clean), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.when(clean.rlike(r"\p{Lu}") & ~clean.rlike(r"\p{Ll}"), F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 20))), "")).otherwise(clean)
