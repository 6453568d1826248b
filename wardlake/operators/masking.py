"""Tag and column masking as one projection per role."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from wardlake.functions import masks
from wardlake.operators.scaling import fan_out_join


@dataclass(frozen=True)
class MaskRule:
    """Who (role) sees values under a tag value (or column) at which level."""

    role: str
    key: str
    level: int

    def __post_init__(self):
        if self.level not in masks.LEVELS:
            raise ValueError(f"masking_policy {self.level} is outside 10000-10009")
        if not self.role or not self.key:
            raise ValueError("role and tag_value are required")


def mask_rules(items: Sequence[Mapping]) -> list[MaskRule]:
    """Checked rules from plain dicts; an empty list is an error."""
    if not items:
        raise ValueError("No rules provided")
    missing = [i for i, r in enumerate(items) if not {"masking_policy", "role", "tag_value"} <= set(r)]
    if missing:
        raise ValueError(f"rules {missing} need masking_policy, role and tag_value")
    return [MaskRule(r["role"], r["tag_value"], int(r["masking_policy"])) for r in items]


def _strictness(level: Column) -> Column:
    order = F.array(*[F.lit(v) for v in masks.STRICTEST_FIRST])
    return F.array_position(order, level)


def column_levels(assignments: DataFrame, rules: DataFrame, role: str, table: str,
                  columns: Sequence[str]) -> dict[str, int | None]:
    """Level per tagged column of one table for one role; None where no rule fits.

    The answer has at most one entry per column of the table, whatever the size
    of the control tables. Several tags on a column: the strictest level wins,
    and a tag without a rule hides the column.
    """
    tagged = assignments.filter((F.col("table_name") == table) & F.col("column_name").isin(*columns))
    mine = rules.filter(F.col("role") == role).select("tag_name", "tag_value", "masking_policy")
    levels = (
        tagged.join(mine, ["tag_name", "tag_value"], "left")
        .withColumn("level", F.coalesce("masking_policy", F.lit(masks.NULL)))
        .groupBy("column_name")
        .agg(
            F.min_by("level", _strictness(F.col("level"))).alias("level"),
            F.bool_or(F.col("masking_policy").isNull()).alias("open"),
        )
    )
    return {r["column_name"]: None if r["open"] else r["level"] for r in levels.collect()}


def project_levels(df: DataFrame, levels: Mapping[str, int | None], salt: str = "",
                   on_nonstring: str = "cast") -> DataFrame:
    """One select that masks the given columns and passes the others."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    unknown = set(levels) - set(fields)
    if unknown:
        raise ValueError(f"columns {sorted(unknown)} are not in the table")
    return df.select(*[
        masks.mask(F.col(n), t, levels[n], salt=salt, on_nonstring=on_nonstring).alias(n)
        if n in levels else F.col(n)
        for n, t in fields.items()
    ])


def levels_for_role(tags: Mapping[str, str], rules: Sequence[MaskRule], role: str) -> dict[str, int | None]:
    """Levels from plain objects: column → tag value, and rules."""
    found: dict[str, int | None] = {}
    for column, value in tags.items():
        hits = [r.level for r in rules if r.role == role and r.key == value]
        found[column] = min(hits, key=masks.STRICTEST_FIRST.index) if hits else None
    return found


def apply_masking(df: DataFrame, tags: Mapping[str, str] | DataFrame, rules: Sequence[MaskRule] | DataFrame,
                  role: str, table: str | None = None, salt: str = "",
                  on_nonstring: str = "cast") -> DataFrame:
    """The table as a role sees it: tag → rule → level; tagged without rule → NULL.

    Control data may be plain objects or DataFrames. Works unchanged on a stream.
    """
    if isinstance(tags, DataFrame):
        levels = column_levels(tags, rules, role, table, df.columns)
    else:
        levels = levels_for_role(tags, rules, role)
    return project_levels(df, levels, salt, on_nonstring)


def mask_by_role_column(df: DataFrame, tags: Mapping[str, str], rules: Sequence[MaskRule],
                        role_of: Column, salt: str = "") -> DataFrame:
    """Masking where the role is a value of the row (custom role provider).

    Every masked column is text, because its level differs from row to row; a
    role without a rule sees NULL.
    """
    roles = sorted({r.role for r in rules})
    types = {f.name: f.dataType for f in df.schema.fields}

    def masked(name: str) -> Column:
        branches = F.lit(None).cast("string")
        for role in reversed(roles):
            level = levels_for_role({name: tags[name]}, rules, role)[name]
            value = masks.mask(F.col(name), types[name], level, salt=salt).cast("string")
            branches = F.when(role_of == role, value).otherwise(branches)
        return branches

    return df.select(*[masked(n).alias(n) if n in tags else F.col(n) for n in df.columns])


def effective_levels(assignments: DataFrame, rules: DataFrame, roles: Sequence[str]) -> DataFrame:
    """Role × tagged column → level; the level is NULL where no rule exists.

    Roles are exploded from a literal list, the rules arrive by equi-join.
    """
    listed = F.explode(F.array(*[F.lit(r) for r in roles])).alias("role")
    return (
        fan_out_join(assignments.select("*", listed), rules.select("tag_name", "tag_value", "role", "masking_policy"),
                     ["tag_name", "tag_value", "role"], "left")
        .select("role", "database_name", "schema_name", "table_name", "column_name",
                "tag_name", "tag_value", "masking_policy")
    )


def masked_views(df: DataFrame, tags: Mapping[str, str], rules: Sequence[MaskRule],
                 roles: Sequence[str], salt: str = "") -> DataFrame:
    """One masked extract per role, in one scan.

    Each row becomes an array with one struct per role, which is exploded: the
    table is read once, not once per role. Masked columns are text in all roles
    unless every role yields the column's own type.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    per_role = {r: levels_for_role(tags, rules, r) for r in roles}

    def out_type(name: str) -> T.DataType:
        texts = any(per_role[r].get(name) in masks.TEXT_LEVELS for r in roles)
        return T.StringType() if name in tags and texts else types[name]

    structs = [
        F.struct(F.lit(role).alias("role"), *[
            (masks.mask(F.col(n), types[n], per_role[role][n], salt=salt) if n in tags else F.col(n))
            .cast(out_type(n)).alias(n)
            for n in df.columns
        ])
        for role in roles
    ]
    return df.select(F.explode(F.array(*structs)).alias("v")).select("v.*")


def match_policies(assignments: DataFrame, policies: DataFrame, database_id: Column) -> DataFrame:
    """Tagged columns with the policy that governs them.

    TAG policies: the tag in upper case, connected, without a database list.
    PUSHDOWN policies: any case, and the column's database must be in the list.
    Tag values stay case-sensitive and are not touched here.
    """
    kind = F.upper("policy_type")
    tag_side = policies.filter(
        (kind == "TAG") & F.col("connected") & F.col("database_ids").isNull()
    ).select("policy_id", "policy_type", F.col("tag").alias("_tag"), F.lit(None).cast("int").alias("_db"))
    push_side = policies.filter(
        (kind == "PUSHDOWN") & (F.size("database_ids") > 0)
    ).select("policy_id", "policy_type", F.lower("tag").alias("_tag"), F.explode("database_ids").alias("_db"))
    by_tag = fan_out_join(assignments.withColumn("_tag", F.upper("tag_name")), tag_side.drop("_db"), ["_tag"])
    by_db = fan_out_join(
        assignments.withColumns({"_tag": F.lower("tag_name"), "_db": database_id}), push_side, ["_tag", "_db"]
    ).drop("_db")
    return by_tag.unionByName(by_db).drop("_tag")


def duplicate_policies(policies: DataFrame) -> DataFrame:
    """Tags that break the one-policy-per-tag rule."""
    tag = F.when(F.upper("policy_type") == "PUSHDOWN", F.lower("tag")).otherwise(F.col("tag"))
    return (
        policies.groupBy(F.upper("policy_type").alias("policy_type"), tag.alias("tag"))
        .agg(F.count(F.lit(1)).alias("policies")).filter("policies > 1")
    )


def mask_column_policy(df: DataFrame, column_rules: Sequence[MaskRule], role: str,
                       salt: str = "") -> DataFrame:
    """Column policies: the rule names the column instead of a tag value."""
    columns = {r.key: r.key for r in column_rules}
    return project_levels(df, levels_for_role(columns, column_rules, role), salt)


def mask_data_types(assignments: DataFrame, catalog: DataFrame, types: Sequence[str]) -> DataFrame:
    """Assignments limited to columns of the listed data types."""
    keys = ["database_name", "schema_name", "table_name", "column_name"]
    wanted = catalog.filter(F.lower("data_type").isin(*[t.lower() for t in types])).select(*keys)
    return assignments.join(wanted, keys, "left_semi")


def union_roles(df: DataFrame, tags: Mapping[str, str], rules: Sequence[MaskRule],
                roles: Sequence[str]) -> DataFrame:
    """Union form of ``masked_views`` for roles with very different projections."""
    parts = [apply_masking(df, tags, rules, r).withColumn("role", F.lit(r)) for r in roles]
    return reduce(lambda a, b: a.unionByName(b), parts)
