"""Access policies: grants from rules, compliance against reality, access requests.

Rules name objects by exact name, prefix, suffix or path. None of the matches is a
nested-loop join: each distinct object name is expanded into the keys under which
a rule could name it, and rules meet them by equi-join. Only prefixes and suffixes
of the lengths that occur in the rules are keys, and a path has a key for each
combination of named parts that occurs in the rules.

Rules stay factored: ``Grants`` holds who a rule is for and which paths it names,
two relations that meet on the rule. Whether an access is covered is asked of
these; only ``expand_grants`` and ``expand_oltp_grants`` write out the product.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wardlake.operators.scaling import fan_out_join, skew_join, tiled_product
from wardlake.session import write_through

# Name conditions and object types of an access rule.
CONDITIONS = ("equals", "starts_with", "ends_with")
OBJECT_TYPES = ("database", "schema", "table", "view")
TABLE_KEYS = ("database_name", "schema_name", "table_name")
GRANT_KEYS = ("role", *TABLE_KEYS, "access")
#: What names an object of a rule: its path, and whether it is a table or a view.
OBJECT_PARTS = (*TABLE_KEYS, "object_type")
COLUMN_PARTS = ("database_name", "schema_name", "table_name", "column_name")

_PART = "struct<name:string,wildcard:boolean>"
RULE_DDL = (
    "rule_id string, "
    "actors array<struct<type:string,condition:string,identifiers:array<string>>>, "
    "objects array<struct<type:string,condition:string,identifiers:array<string>,"
    "fully_qualified_identifiers:array<struct<database:string,schema:string,table:string,view:string>>>>, "
    "access array<struct<name:string>>, "
    "tagged_objects array<struct<check_against:array<string>,"
    "tagged_with:array<struct<database:string,schema:string,name:string,value:string>>,"
    "tag_condition:string>>"
)
OLTP_RULE_DDL = (
    "rule_id string, type string, "
    "actors array<struct<type:string,condition:string,identifiers:array<string>>>, "
    "objects array<struct<type:string,identifiers:array<struct<"
    f"database:{_PART},schema:{_PART},table:{_PART},column:{_PART}>>>>"
)


def match_names(names: DataFrame, name: str, patterns: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Patterns (…, condition, text) with each matching name of a distinct list; columns in ``by`` must agree.

    A name has one key for itself and one for each length of a prefix or suffix that
    occurs in the patterns, so few of its beginnings are written out.
    """
    size = F.char_length("text")
    lengths = patterns.where(size > 0).agg(F.struct(
        F.collect_set(F.when(F.col("condition") == "starts_with", size)).alias("starts"),
        F.collect_set(F.when(F.col("condition") == "ends_with", size)).alias("ends"))).scalar()
    of = F.col(name)
    key = lambda condition, text: F.struct(F.lit(condition).alias("condition"), text.alias("text"))
    occurring = lambda kind: F.filter(f"_lengths.{kind}", lambda n: n <= F.char_length(of))
    keys = F.concat(
        F.array(key("equals", of)),
        F.transform(occurring("starts"), lambda n: key("starts_with", F.left(of, n))),
        F.transform(occurring("ends"), lambda n: key("ends_with", F.right(of, n))))
    found = names.select(*by, name).distinct().filter(F.char_length(name) > 0).select(
        *by, name, lengths.alias("_lengths")).select(*by, name, F.explode(keys).alias("k"))
    return patterns.join(found.select(*by, name, "k.condition", "k.text"), [*by, "condition", "text"]).drop("condition", "text")


def match_paths(rows: DataFrame, paths: DataFrame, parts: Sequence[str]) -> DataFrame:
    """``rows`` with the ``rule_id`` of each path of ``paths`` that names them; a null part of a path names any.

    A row has a key for each combination of named parts that occurs in the paths. A
    row with a null part is named only by paths that leave this part open. The
    distinct paths are written once, since they are counted before they are joined.
    """
    bits = [1 << n for n in range(len(parts))]
    free = reduce(lambda a, b: a + b, [F.when(F.col(p).isNull(), b).otherwise(0) for p, b in zip(parts, bits)])
    wanted = write_through(paths.select(
        "rule_id", free.cast("int").alias("_free"), *[F.coalesce(p, F.lit("")).alias(f"_{p}") for p in parts]).distinct(), "paths")
    occurring = wanted.agg(F.collect_set("_free")).scalar()
    keyed = rows.select("*", F.explode(occurring).alias("_free")).select(
        "*", *[F.when(F.col("_free").bitwiseAND(b) > 0, "").otherwise(F.col(p)).alias(f"_{p}") for p, b in zip(parts, bits)])
    keys = ["_free", *[f"_{p}" for p in parts]]
    return fan_out_join(keyed, wanted, keys).drop(*keys)


@dataclass(frozen=True)
class Grants:
    """Access rules as two relations of distinct rows: ``who`` (rule_id, principal, access) and ``what`` (rule_id and the parts of a path, null for any)."""

    who: DataFrame
    what: DataFrame
    principal: str
    parts: tuple[str, ...]

    def covered(self, asked: DataFrame) -> DataFrame:
        """The distinct rows (principal, access, parts) of ``asked`` that a rule grants.

        The work follows what is asked, not the number of principals times objects.
        """
        keys = [self.principal, "access", *self.parts]
        named = match_paths(asked.select(*keys).distinct(), self.what, self.parts)
        return named.join(self.who, ["rule_id", self.principal, "access"], "left_semi").select(*keys).distinct()

    def written_out(self, objects: DataFrame, columns: Sequence[str]) -> DataFrame:
        """A row for each rule, principal, access and object of a catalog, an object being what ``columns`` tell apart.

        Both sides are distinct before they meet, so the product is, and need not be
        moved again. They are written once, since they are counted before they are joined.
        The product has tiles of few principals and objects, so that files of it repeat
        nearby values and stay small.
        """
        named = write_through(match_paths(objects, self.what, self.parts).select("rule_id", *columns).distinct(), "named")
        who = write_through(self.who.select("rule_id", "access", self.principal), "who")
        return tiled_product(named, who, ["rule_id"])


def rule_roles(rules: DataFrame, roles: DataFrame) -> DataFrame:
    """(rule_id, role): roles that the actors of a rule cover."""
    actors = rules.select("rule_id", F.explode("actors").alias("a")).filter(
        F.lower("a.type") == "role")
    patterns = actors.select("rule_id", F.col("a.condition").alias("condition"),
                             F.explode("a.identifiers").alias("text"))
    return match_names(roles, "role", patterns).select("rule_id", "role").distinct()


def _paths(rows: DataFrame, **parts: Column) -> DataFrame:
    """(rule_id and the four parts of an object), null where a part is not named."""
    null = F.lit(None).cast("string")
    return rows.select("rule_id", *[parts.get(p, null).alias(p) for p in OBJECT_PARTS])


def object_paths(rules: DataFrame, catalog: DataFrame) -> DataFrame:
    """(rule_id, path): what the objects of a rule name, not expanded to the tables below.

    ``catalog`` has one row per table or view with ``object_type``; a rule's prefix or
    suffix is looked up among its names.
    """
    objects = rules.select("rule_id", F.explode("objects").alias("o"))
    kind = F.lower("o.type")
    level = F.when(kind == "database", "database_name").when(kind == "schema", "schema_name").when(
        kind.isin("table", "view"), "table_name")
    named = objects.filter(F.col("o.condition") != "fully_qualified").select(
        "rule_id", kind.alias("type"), level.alias("level"), F.col("o.condition").alias("condition"),
        F.explode("o.identifiers").alias("text"))
    listed = catalog.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("level"), F.col(c).alias("name")) for c in TABLE_KEYS])).alias("n")).select("n.*")
    hits = match_names(listed, "name", named, ["level"])
    at = lambda c: F.when(F.col("level") == c, F.col("name"))
    found = [_paths(hits, object_type=F.when(F.col("level") == "table_name", F.col("type")), **{c: at(c) for c in TABLE_KEYS})]
    paths = objects.filter(F.col("o.condition") == "fully_qualified").select(
        "rule_id", F.explode("o.fully_qualified_identifiers").alias("q"))
    database, schema, table = F.col("q.database"), F.col("q.schema"), F.coalesce("q.table", "q.view")
    whole = paths.filter(database.isNotNull() & (schema.isNotNull() | table.isNull()))
    found.append(_paths(whole, database_name=database, schema_name=schema, table_name=table))
    return reduce(DataFrame.unionByName, found).distinct()


def rule_objects(rules: DataFrame, catalog: DataFrame) -> DataFrame:
    """(rule_id, table): tables and views that the objects of a rule cover."""
    return match_paths(catalog, object_paths(rules, catalog), OBJECT_PARTS).select("rule_id", *TABLE_KEYS).distinct()


def tagged_paths(rules: DataFrame, tags: DataFrame) -> DataFrame:
    """(rule_id, path) by tags on the checked levels.

    ``tags`` holds (level, database_name, schema_name, table_name, tag_database,
    tag_schema, tag_name, tag_value); the columns below the level are NULL. ``or``
    asks for one of the tags, ``and`` for all of them on the same object.
    """
    # Levels that a rule may check.
    levels = {"databases": "database", "schemas": "schema", "tables": "table", "views": "view"}
    level_of = F.create_map(*[F.lit(x) for kv in levels.items() for x in kv])
    blocks = rules.select("rule_id", F.posexplode("tagged_objects").alias("block", "t"))
    wanted = blocks.select(
        "rule_id", "block", F.lower("t.tag_condition").alias("tag_condition"),
        F.size(F.array_distinct("t.tagged_with")).alias("needed"),
        F.explode("t.check_against").alias("check"),
        F.array_distinct("t.tagged_with").alias("tagged_with"),
    ).select(
        "rule_id", "block", "tag_condition", "needed", level_of[F.lower("check")].alias("level"),
        F.posexplode("tagged_with").alias("tag_no", "w"),
    ).select(
        "rule_id", "block", "tag_condition", "needed", "level", "tag_no",
        F.col("w.database").alias("tag_database"), F.col("w.schema").alias("tag_schema"),
        F.col("w.name").alias("tag_name"), F.col("w.value").alias("tag_value"))
    hits = fan_out_join(tags, wanted, ["level", "tag_database", "tag_schema", "tag_name", "tag_value"])
    held = hits.groupBy("rule_id", "block", "tag_condition", "needed", "level", *TABLE_KEYS).agg(
        F.count_distinct("tag_no").alias("present"))
    kept = held.filter((F.col("tag_condition") == "or") | (F.col("present") == F.col("needed")))
    level = F.col("level")
    found = [
        _paths(kept.filter(level == "database"), database_name=F.col("database_name")),
        _paths(kept.filter(level == "schema"), database_name=F.col("database_name"), schema_name=F.col("schema_name")),
        _paths(kept.filter(level.isin("table", "view")), object_type=level, **{c: F.col(c) for c in TABLE_KEYS}),
    ]
    return reduce(DataFrame.unionByName, found).distinct()


def tagged_objects(rules: DataFrame, catalog: DataFrame, tags: DataFrame) -> DataFrame:
    """(rule_id, table) by tags on the checked levels."""
    return match_paths(catalog, tagged_paths(rules, tags), OBJECT_PARTS).select("rule_id", *TABLE_KEYS).distinct()


def access_grants(rules: DataFrame, roles: DataFrame, catalog: DataFrame, tags: DataFrame | None = None) -> Grants:
    """Access rules for roles on databases, schemas, tables and views, factored."""
    paths = object_paths(rules, catalog)
    if tags is not None:
        paths = paths.unionByName(tagged_paths(rules, tags)).distinct()
    access = rules.select("rule_id", F.explode("access").alias("a")).select(
        "rule_id", F.lower("a.name").alias("access")).distinct()
    return Grants(rule_roles(rules, roles).join(access, "rule_id"), paths, "role", OBJECT_PARTS)


def expand_grants(rules: DataFrame, roles: DataFrame, catalog: DataFrame,
                  tags: DataFrame | None = None) -> DataFrame:
    """Concrete grants (rule, role, table, access) of access rules."""
    return access_grants(rules, roles, catalog, tags).written_out(
        catalog.select(*OBJECT_PARTS), TABLE_KEYS).select("rule_id", *GRANT_KEYS)


def oltp_grants(rules: DataFrame, users: DataFrame, case_sensitivity: str = "case_sensitive") -> Grants:
    """OLTP rules for users and groups on column paths, factored.

    A rule's type is its access, ``read`` if it has none. A part of a path that is
    missing or a wildcard names any. Without case sensitivity, paths are in small
    letters, and so must be what is matched against them.
    """
    if case_sensitivity not in ("case_sensitive", "case_insensitive"):
        raise ValueError("case_sensitivity is case_sensitive or case_insensitive")
    fold = (lambda c: c) if case_sensitivity == "case_sensitive" else F.lower
    paths = rules.select("rule_id", F.explode("objects").alias("o")).select("rule_id", F.explode("o.identifiers").alias("i"))
    named = lambda p: F.when(~F.coalesce(F.col(f"i.{p}.wildcard"), F.lit(False)), fold(F.col(f"i.{p}.name")))
    what = paths.select("rule_id", *[named(c.removesuffix("_name")).alias(c) for c in COLUMN_PARTS]).distinct()
    access = F.lower(F.coalesce("type", F.lit("read")))
    actors = rules.select("rule_id", access.alias("access"), F.explode("actors").alias("a")).select(
        "rule_id", "access", F.col("a.type").alias("type"), F.explode("a.identifiers").alias("name"))
    members = users.select("username", F.explode(F.concat(
        F.array(F.struct(F.lit("idp_user").alias("type"), fold(F.col("username")).alias("name"))),
        F.transform(F.coalesce("user_groups", F.array().cast("array<string>")), lambda g: F.struct(
            F.lit("idp_group").alias("type"), fold(g).alias("name"))),
    )).alias("m")).select("username", "m.type", "m.name")
    who = actors.withColumn("name", fold(F.col("name"))).join(members, ["type", "name"]).select("rule_id", "username", "access").distinct()
    return Grants(who, what, "username", COLUMN_PARTS)


def expand_oltp_grants(rules: DataFrame, users: DataFrame, catalog: DataFrame,
                       case_sensitivity: str = "case_sensitive") -> DataFrame:
    """(rule_id, username, column path, access) of OLTP rules."""
    grants = oltp_grants(rules, users, case_sensitivity)
    if case_sensitivity == "case_sensitive":
        out = grants.written_out(catalog.select(*COLUMN_PARTS), COLUMN_PARTS)
    else:  # paths are matched in small letters and given back as they are written
        folded = catalog.select(*[F.lower(c).alias(c) for c in COLUMN_PARTS], *[F.col(c).alias(f"_written_{c}") for c in COLUMN_PARTS])
        out = grants.written_out(folded, [f"_written_{c}" for c in COLUMN_PARTS]).select(
            "rule_id", "username", "access", *[F.col(f"_written_{c}").alias(c) for c in COLUMN_PARTS])
    return out.select("rule_id", "username", *COLUMN_PARTS, "access")


def compliance_check(expected: DataFrame, actual: DataFrame, keys: Sequence[str] = GRANT_KEYS) -> DataFrame:
    """Grants that are missing in reality or exceed the policy.

    Both sides become one grouped table of flags: one shuffle, combined before it,
    and NULL-safe on every key.
    """
    both = expected.select(*keys, F.lit(1).alias("e"), F.lit(0).alias("a")).unionByName(
        actual.select(*keys, F.lit(0).alias("e"), F.lit(1).alias("a")))
    return (
        both.groupBy(*keys).agg(F.max("e").alias("e"), F.max("a").alias("a"))
        .filter(F.col("e") != F.col("a"))
        .select(*keys, F.when(F.col("e") == 1, "missing").otherwise("excess").alias("compliance"))
    )


def can_access(grants: DataFrame, role: str, path: dict[str, str], access: str = "read") -> DataFrame:
    """One row that says whether a role holds an access on a table."""
    rows = grants.filter((F.col("role") == role) & (F.col("access") == access))
    for name, value in path.items():
        rows = rows.filter(F.col(name) == value)
    return rows.agg((F.count(F.lit(1)) > 0).alias("allowed"))


def unauthorised_accesses(accesses: DataFrame, grants: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Audit rows without a covering grant; popular tables and roles are spread."""
    return skew_join(accesses, grants.select(*keys).distinct(), keys, "left_anti")


def uncovered_accesses(accesses: DataFrame, grants: Grants, catalog: DataFrame | None = None) -> DataFrame:
    """Audit rows (principal, access and path) that no rule covers; a write under a read grant is not covered.

    The distinct accesses are looked up in the factored rules, and the rows meet the
    answers in one anti join. ``catalog`` tells tables from views where the rules do.
    """
    keys = [grants.principal, "access", *[p for p in grants.parts if p in accesses.columns]]
    asked = accesses.select(*keys).distinct()
    if "object_type" in grants.parts and "object_type" not in accesses.columns:
        if catalog is None:
            raise ValueError("rules on tables and views need a catalog")
        asked = asked.join(catalog.select(*OBJECT_PARTS).distinct(), list(TABLE_KEYS), "left")
    return skew_join(accesses, grants.covered(asked).select(*keys).distinct(), keys, "left_anti")


# ── access requests ─────────────────────────────────────────────────────────

# The ten states of a request, and what each event leads to.
REQUEST_STATES = (
    "OPEN", "PENDING", "PENDING_APPROVED", "CLOSED_APPROVED", "PENDING_DENIED", "CLOSED_DENIED",
    "PENDING_CANCELLED", "CLOSED_CANCELLED", "CLOSED", "FAILED",
)
ACTION_STATES = {
    "submit": "OPEN", "review": "PENDING",
    "approve": "PENDING_APPROVED", "deny": "PENDING_DENIED", "cancel": "PENDING_CANCELLED",
    "complete_approve": "CLOSED_APPROVED", "complete_deny": "CLOSED_DENIED",
    "complete_cancel": "CLOSED_CANCELLED", "close": "CLOSED", "fail": "FAILED",
}
TERMINAL = ("CLOSED_APPROVED", "CLOSED_DENIED", "CLOSED_CANCELLED", "CLOSED", "FAILED")


def request_state(events: DataFrame, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Current state per request. The first terminal event decides; later ones change nothing.

    One aggregation with partial combine; no window, so a request with very many
    events is not sorted in one task.
    """
    states = F.create_map(*[F.lit(x) for kv in ACTION_STATES.items() for x in kv])
    rows = events.withColumn("_state", states[F.lower("action")]).filter(F.col("_state").isNotNull())
    final = F.col("_state").isin(*TERMINAL)
    when = F.struct(*order)
    verdict = F.struct(F.col("_state").alias("status"), F.col("justification"))
    summary = rows.groupBy("request_id").agg(
        F.min_by(F.when(final, verdict), F.when(final, when)).alias("_first_final"),
        F.max_by(F.when(~final, verdict), F.when(~final, when)).alias("_last_open"),
        F.min_by(F.when(F.col("_state") == "OPEN", F.struct("requester", "justification")),
                 F.when(F.col("_state") == "OPEN", when)).alias("_request"),
    )
    decided = F.coalesce("_first_final", "_last_open")
    return summary.select(
        "request_id", F.col("_request.requester").alias("requester"),
        F.col("_request.justification").alias("requester_justification"),
        decided["status"].alias("status"),
        F.when(decided["status"] != "OPEN", decided["justification"]).alias("reviewer_justification"),
    )


def grants_from_requests(states: DataFrame, requests: DataFrame, roles: DataFrame, catalog: DataFrame) -> DataFrame:
    """Grants of approved requests, each linked to the request it fulfils."""
    approved = states.filter(F.col("status") == "CLOSED_APPROVED").select("request_id")
    rules = write_through(requests.join(approved, "request_id", "left_semi").withColumnRenamed("request_id", "rule_id"), "rules")
    return expand_grants(rules, roles, catalog).withColumnRenamed("rule_id", "request_id")
