"""How many claims a paper may give, which papers are sent for extraction, and whether what comes back is valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.scoring import extra_claims
from folioscope.functions.text import estimated_tokens, word_count

BASE = 10
MOST_TOKENS = 7000
KEYS = tuple(
    "arm baseline_value between_group_difference claim_family claim_text comparator comparison_type confidence direction dose duration evidence_span followup_value"
    " intervention_or_exposure keywords outcome population sample_size statistics study_design subgroup support_section timepoint units within_group_change".split()
)
STATISTICS = ("p_value", "confidence_interval", "other")


def limits(docs: DataFrame, fixed: int | None = None) -> DataFrame:
    """(doc_id, word_count, extra_claims, final_claims); a fixed number overrides and leaves no extra."""
    w = docs.select("doc_id", word_count(F.coalesce("text", F.lit(""))).alias("word_count"), "citations")
    if fixed is not None:
        return w.select("doc_id", "word_count", F.lit(None).cast("int").alias("extra_claims"), F.lit(fixed).alias("final_claims"))
    extra = extra_claims(F.col("citations"), F.col("word_count"))
    return w.select("doc_id", "word_count", extra.alias("extra_claims"), (BASE + extra).alias("final_claims"))


def gates(docs: DataFrame, existing: DataFrame, approved: DataFrame | None = None, most: int = MOST_TOKENS) -> DataFrame:
    """(doc_id, estimated_tokens, gate): ``existing`` before ``auto`` (fewer than ``most`` tokens) before ``approved`` and ``review``.

    What exists is told before texts are measured, so nothing is computed for it.
    """
    flag = existing.select("doc_id").distinct().withColumn("e", F.lit(True))
    rows = docs.join(flag, "doc_id", "left")
    rows = rows.withColumn("estimated_tokens", F.when(F.col("e").isNull(), estimated_tokens(F.coalesce("text", F.lit("")))))
    yes: Column = F.lit(False)
    if approved is not None:
        rows = rows.join(approved.select("doc_id").distinct().withColumn("y", F.lit(True)), "doc_id", "left")
        yes = F.coalesce("y", F.lit(False))
    gate = F.when(F.col("e"), "existing").when(F.col("estimated_tokens") < most, "auto").when(yes, "approved").otherwise("review")
    return rows.select("doc_id", "estimated_tokens", gate.alias("gate"))


def validated(outputs: DataFrame) -> DataFrame:
    """(doc_id, valid, reason) of (doc_id, output): the whole array is valid or none of it; ``reason`` names the first claim at fault.

    Parsed as a variant, which tells a missing key from a null one. Texts that aren't JSON, and what isn't an array, are invalid.
    """
    v = outputs.select("doc_id", F.expr("try_parse_json(output)").alias("v"))
    kind = F.expr("schema_of_variant(v)")
    whole = v.select("doc_id", "v", F.coalesce(kind.startswith("ARRAY"), F.lit(False)).alias("is_array"))
    numbered = whole.filter("is_array").selectExpr("doc_id", "posexplode(try_variant_get(v, '$', 'array<variant>')) AS (pos, c)")
    object_ = "schema_of_variant(c) LIKE 'OBJECT%'"
    names = "map_keys(try_variant_get(c, '$', 'map<string,variant>'))"
    text = lambda k: f"(coalesce(schema_of_variant(variant_get(c, '$.{k}')) = 'STRING', false) AND length(trim(try_variant_get(c, '$.{k}', 'string'))) > 0)"
    kind_of = lambda k: f"coalesce(schema_of_variant(variant_get(c, '$.{k}')), 'VOID')"
    required = ", ".join(f"'{k}'" for k in KEYS)
    reason = (
        f"CASE WHEN c IS NULL OR NOT {object_} THEN 'not an object'"
        f" WHEN size(array_except(array({required}), {names})) > 0 THEN concat('missing ', array_join(array_sort(array_except(array({required}), {names})), ', '))"
        + "".join(f" WHEN NOT {text(k)} THEN 'invalid {k}'" for k in ("claim_family", "support_section", "claim_text", "evidence_span"))
        + f" WHEN NOT ({kind_of('confidence')} RLIKE '^(BIGINT|DOUBLE|DECIMAL|FLOAT|BOOLEAN)') THEN 'invalid confidence'"
        f" WHEN NOT ({kind_of('keywords')} LIKE 'ARRAY%') THEN 'invalid keywords'"
        f" WHEN NOT ({kind_of('statistics')} LIKE 'OBJECT%') THEN 'invalid statistics' END"
    )
    faults = numbered.selectExpr("doc_id", "pos", f"{reason} AS why").filter("why IS NOT NULL").groupBy("doc_id").agg(F.min_by(F.concat_ws(" ", F.lit("claim"), F.col("pos"), F.col("why")), "pos").alias("why"))
    joined = whole.join(faults, "doc_id", "left")
    reason_ = F.when(F.col("v").isNull(), "not JSON").when(~F.col("is_array"), "not an array").otherwise(F.col("why"))
    return joined.select("doc_id", reason_.isNull().alias("valid"), reason_.alias("reason"))
