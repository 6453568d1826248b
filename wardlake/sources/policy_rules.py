"""Masking policy rules as they arrive: a map of rule lists keyed by hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_LEVEL = "struct<masking_policy:string>"
RULES_DDL = (
    "map<string,array<struct<rule_id:string,rule_hash:string,"
    f"pending_rule_json:{_LEVEL},success_rule_json:{_LEVEL},failed_rule_json:{_LEVEL},"
    "policy_id:string,role:string,tag_value:string,updated_at:timestamp>>>"
)


def explode_rules(raw: DataFrame, column: str = "items", page: Column | None = None) -> DataFrame:
    """One row per live rule.

    ``column`` holds the map, or its JSON text. Pages may repeat a hash; with
    ``page`` given the entry of the last page is kept. Only the applied
    (success) side of a rule is live; its code arrives as text.
    """
    is_text = dict(raw.dtypes)[column] == "string"
    items = F.from_json(column, RULES_DDL) if is_text else F.col(column)
    number = F.lit(0) if page is None else page
    entries = raw.select(number.alias("_page"), F.explode(items).alias("rule_key", "rules"))
    if page is not None:
        entries = entries.groupBy("rule_key").agg(F.max_by("rules", "_page").alias("rules"))
    rules = entries.select("rule_key", F.explode("rules").alias("r"))
    return rules.select(
        "rule_key", "r.rule_id", "r.policy_id", "r.role", "r.tag_value",
        F.col("r.success_rule_json.masking_policy").try_cast("int").alias("masking_policy"),
        "r.updated_at",
    ).filter(F.col("masking_policy").isNotNull())
