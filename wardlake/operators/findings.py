"""Classification jobs, findings, lineage and human review."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wardlake.functions import detectors
from wardlake.operators.common import as_list
from wardlake.operators.rulesets import Classifier, CompiledSet, active_targets
from wardlake.operators.sampling import KEYS, catalog_of, melt_columns, profile_columns, sample_columns, sample_rows
from wardlake.operators.scaling import fan_out_join
from wardlake.session import write_through

SCOPE = ("database_name", "schema_name", "table_name", "column_name", "classifier_name")
#: Decisions of up to so many bytes are sent to all tasks.
DECISION_BYTES = 64 << 20
#: How many scope columns name a column; a finding is one classifier on it.
COLUMN_DEPTH = 4


@dataclass(frozen=True)
class JobOptions:
    """How a job samples and what it evaluates.

    ROW_PERCENT 100 reads everything; ROWS, ROW_COUNT and COMBINED take ``size`` values
    of each column. Rows are told apart by ``row_keys`` of their table, else by all their columns.
    """

    job_id: str = "job"
    job_kind: str = "native"
    condition_types: tuple[str, ...] | None = None
    strategy: str = "ROW_PERCENT"
    size: int = 100
    row_keys: dict = field(default_factory=dict)
    database: str = "tpch"
    schema: str = "main"


def detect_entities(df: DataFrame, column: str, entity_types: Sequence[str] = detectors.ENTITY_TYPES,
                    minimum_score: float = 0.5,
                    plugins: Mapping[str, Callable[[Column], Column]] | None = None,
                    card_digits: tuple[int, int] = detectors.CARD_DIGITS,
                    secret_digits: tuple[int, int] = detectors.SECRET_DIGITS) -> DataFrame:
    """One row per hit with its entity type and score, at or above the minimum.

    A plug-in is a column function, such as a pandas UDF, that yields
    ``array<struct<hit: string, score: int>>`` with the score in hundredths. The least
    and most digits of cards and secrets are those of ``entity_hits``.
    """
    extra = dict(plugins or {})

    def tagged_hits(entity_type: str) -> Column:
        value = F.col(column)
        hits = extra[entity_type](value) if entity_type in extra else detectors.entity_hits(
            value, entity_type, card_digits, secret_digits)
        return F.transform(
            hits,
            lambda h: F.struct(F.lit(entity_type).alias("entity_type"), h["hit"].alias("hit"),
                               h["score"].alias("score")))

    tagged = [tagged_hits(t) for t in dict.fromkeys([*entity_types, *extra])]
    hits = df.select("*", F.explode(F.concat(*tagged)).alias("e"))
    return hits.select(
        *[c for c in df.columns if c != column], "e.entity_type", "e.hit", "e.score"
    ).filter(F.col("score") >= round(minimum_score * 100))


def profiled_catalog(tables: dict[str, DataFrame], compiled: CompiledSet, options: JobOptions,
                     scope: dict[str, list[str]] | None = None) -> DataFrame:
    """Catalog rows with their profile; no table is read when no leaf needs data."""
    chosen = {t: df.columns if scope is None else scope.get(t, []) for t, df in tables.items()}
    chosen = {t: c for t, c in chosen.items() if c}
    if not chosen:
        chosen = {t: [] for t in tables}
    catalogs = [
        catalog_of(tables[t].select(*c), t, options.database, options.schema) for t, c in chosen.items()
    ]
    catalog = reduce(DataFrame.unionByName, catalogs)
    if not compiled.needs_data or options.strategy.upper() == "METADATA":
        empty = {n: F.lit(0).cast("long").alias(n) for n in ("sampled", "non_null", *compiled.counters)}
        return catalog.select("*", *empty.values())

    def values(t: str, c: list[str]) -> DataFrame:
        key = options.row_keys.get(t, tables[t].columns)
        if options.strategy.upper() != "ROW_PERCENT":
            return sample_columns(tables[t], t, options.size, c, key, "0", options.database, options.schema)[1].drop("digest")
        return melt_columns(sample_rows(tables[t], options.strategy, options.size, key), t, c, options.database, options.schema)

    longs = [values(t, c) for t, c in chosen.items() if c]
    profile = profile_columns(reduce(DataFrame.unionByName, longs), compiled.counters)
    counts = ["sampled", "non_null", *compiled.counters]
    return catalog.join(profile.select(*KEYS, *counts), list(KEYS), "left").fillna(0, counts)


def classify(tables: dict[str, DataFrame], classifiers: Sequence[Classifier],
             options: JobOptions = JobOptions(), scope: dict[str, list[str]] | None = None) -> DataFrame:
    """Run a collection over tables: one finding per (column, classifier) that fires.

    One scan per table, one aggregation for all leaves of all classifiers.
    """
    compiled = CompiledSet(classifiers, active_targets(options.job_kind, options.condition_types))
    profile = profiled_catalog(tables, compiled, options, scope)
    verdicts = F.array(*[
        F.struct(
            F.lit(c.name).alias("classifier_name"),
            compiled.result(c.tree).alias("fired"),
            compiled.confidence(c.tree).alias("score"),
        )
        for c in compiled.classifiers
    ])
    return (
        profile.select(F.lit(options.job_id).alias("job_id"), *KEYS, "sampled", "non_null",
                       F.explode(verdicts).alias("v"))
        .filter(F.col("v.fired"))
        .select("job_id", *KEYS, "v.classifier_name", "v.score", "sampled", "non_null")
    )


def ruleset_lineage(tables: dict[str, DataFrame], classifier: Classifier,
                    options: JobOptions = JobOptions()) -> DataFrame:
    """One row per column and tree node: path, target, observed value, result."""
    compiled = CompiledSet([classifier], active_targets(options.job_kind, options.condition_types))
    profile = profiled_catalog(tables, compiled, options)
    nodes = F.explode(F.array(*compiled.trace(classifier.tree))).alias("n")
    return profile.select(F.lit(options.job_id).alias("job_id"), *KEYS,
                          F.lit(classifier.name).alias("classifier_name"), nodes).select(
        "job_id", *KEYS, "classifier_name", "n.path", "n.target", "n.observed", "n.result")


def job_scope(catalog: DataFrame, previous: DataFrame, findings: DataFrame, job_type: str) -> DataFrame:
    """Columns a job has to read: all, the ones not seen yet, or the ones with findings."""
    kind = job_type.upper()
    if kind == "FULL":
        return catalog
    if kind == "INCREMENTAL":
        return catalog.join(previous.select(*KEYS).distinct(), list(KEYS), "left_anti")
    if kind == "RECLASSIFICATION":
        return catalog.join(findings.select(*KEYS).distinct(), list(KEYS), "left_semi")
    raise ValueError("job_type is FULL, INCREMENTAL or RECLASSIFICATION")


# ── prebuilt classifiers ────────────────────────────────────────────────────

MANAGED_STAMP = "2024-01-01T00:00:00Z"
MANAGED = (
    Classifier.of("EMAIL", pattern=detectors.EMAIL_PRESENT, minimum_threshold=1, description="e-mail address"),
    Classifier.of("PHONE", pattern=detectors.PHONE_PRESENT, minimum_threshold=1, description="phone number"),
    Classifier.of("CARD", pattern=r"(?:^|[^0-9])[0-9](?:[ -]?[0-9]){12,18}(?:[^0-9]|$)", minimum_threshold=1,
                  description="payment card number"),
    Classifier.of("SSN", pattern=r"(?:^|[^0-9])" + detectors.SSN + r"(?:[^0-9]|$)",
                  minimum_threshold=1, description="US social security number"),
    Classifier.of("IP", pattern=r"(?:^|[^0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?:[^0-9.]|$)",
                  minimum_threshold=1, description="IPv4 address"),
    Classifier.of("SECRET_TOKEN", pattern=r'"[0-9a-f]{40}"', minimum_threshold=1,
                  description="quoted access token"),
)
MANAGED_COLLECTION = "managed"
_MANAGED_DDL = "classifier_name string, description string, ruleset string, stamp string"


def managed_classifiers(spark: SparkSession) -> DataFrame:
    """The prebuilt set with its version stamp."""
    return spark.createDataFrame(
        [(c.name, c.description, c.ruleset, MANAGED_STAMP) for c in MANAGED], _MANAGED_DDL)


def import_managed(registry: DataFrame, managed: DataFrame) -> DataFrame:
    """Upsert the prebuilt set into a registry of classifiers by name."""
    kept = registry.join(managed.select("classifier_name"), "classifier_name", "left_anti")
    return kept.unionByName(managed, allowMissingColumns=True)


def managed_drift(installed: DataFrame, available: DataFrame) -> DataFrame:
    """Prebuilt classifiers that are missing, removed, or differ in their stamp."""
    a = available.select("classifier_name", F.col("stamp").alias("available_stamp"))
    i = installed.select("classifier_name", F.col("stamp").alias("installed_stamp"))
    return (
        i.join(a, "classifier_name", "full_outer")
        .filter(~F.col("installed_stamp").eqNullSafe(F.col("available_stamp")))
    )


# ── findings ────────────────────────────────────────────────────────────────


def job_summary(findings: DataFrame) -> DataFrame:
    """Detected columns per classifier.

    Columns are first made distinct with their classifier, so that a classifier
    which fires on most columns is counted in parts.
    """
    return (
        findings.select("job_id", *SCOPE).distinct()
        .groupBy("job_id", "classifier_name").agg(F.count(F.lit(1)).alias("columns"))
    )


LEVELS = {"database": 1, "schema": 2, "table": 3, "column": 4, "classifier": 5}


def _status_counts() -> list[Column]:
    return [F.count_if(F.col("status") == s).alias(s) for s in ("approved", "rejected", "pending")]


def findings_level(findings: DataFrame, level: str, path: dict[str, str] | None = None,
                   classifier_name: str | list[str] | None = None, confirmed_status: str | None = None,
                   with_counts: bool = False) -> DataFrame:
    """One of five drill-down levels below a path, optionally with review counts."""
    if level not in LEVELS:
        raise ValueError(f"level is one of {', '.join(LEVELS)}")
    rows = findings
    for name, value in (path or {}).items():
        rows = rows.filter(F.col(name) == value)
    if classifier_name is not None:
        rows = rows.filter(F.col("classifier_name").isin(*as_list(classifier_name)))
    if confirmed_status is not None:
        rows = rows.filter(F.col("status") == confirmed_status.lower())
    measures = [F.count(F.lit(1)).alias("findings"), F.max("score").alias("max_score")]
    return rows.groupBy("job_id", *SCOPE[:LEVELS[level]]).agg(
        *measures, *(_status_counts() if with_counts else []))


def findings_rollup(findings: DataFrame) -> DataFrame:
    """All levels in one pass; ``level`` is 0 for a whole job and 5 for a classifier."""
    rolled = findings.rollup("job_id", *SCOPE).agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("findings"),
        F.max("score").alias("max_score"), *_status_counts())
    level = F.lit(5) - F.bit_count("gid").cast("int")
    return rolled.filter(F.col("job_id").isNotNull()).select(
        "job_id", *SCOPE, level.alias("level"), "findings", "max_score",
        "approved", "rejected", "pending")


# ── review ──────────────────────────────────────────────────────────────────


def _scope_depth() -> Column:
    """How many scope columns a decision names, from the database down."""
    return F.expr(" + ".join(f"int({c} IS NOT NULL)" for c in SCOPE))


def check_decision(**scope: str | None) -> None:
    """A scope names every level above its lowest one."""
    given = [scope.get(c) is not None for c in SCOPE]
    if given != sorted(given, reverse=True):
        raise ValueError("a decision scope needs all levels above its lowest one")


def record_decision(decisions: DataFrame, rows: DataFrame) -> DataFrame:
    """Append decisions; the status is approved or rejected, the scope has no gaps."""
    ok = F.col("confirmed_status").isin("approved", "rejected")
    for upper, lower in zip(SCOPE, SCOPE[1:]):
        ok = ok & (F.col(upper).isNotNull() | F.col(lower).isNull())
    checked = rows.filter(F.when(ok, F.lit(True)).otherwise(
        F.raise_error(F.lit("decision without a proper scope or status")).cast("boolean")))
    return decisions.unionByName(checked, allowMissingColumns=True)


def resolve_status(findings: DataFrame, decisions: DataFrame, ts: Sequence[str] = ("decided_at",),
                   broadcast_bytes: int = DECISION_BYTES) -> DataFrame:
    """Findings with their review status: the most specific scope wins, then the latest.

    Decisions shrink to the latest one per scope, a written table whose bytes are
    counted by depth. Up to ``broadcast_bytes`` in all, the depths from the top down are
    sent to the findings, one lookup each: findings are read once and not moved. Of what
    remains, columns and classifiers meet their few findings in one join (``_deep``).
    Above columns, findings and decisions are sorted together by their path, where a
    scope stands right before all that lies below it, and the scopes above are carried
    along (``_carried``).
    """
    latest = write_through(
        decisions.withColumn("depth", _scope_depth()).groupBy("job_id", *SCOPE, "depth")
        .agg(F.max_by("confirmed_status", F.struct(*ts)).alias("decision")), "decisions")
    path = ["job_id", *SCOPE]
    size = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(c), F.lit(0)) + 16 for c in path])
    measured = {r["depth"]: r["bytes"] for r in latest.groupBy("depth").agg(F.sum(size).alias("bytes")).collect()}
    depths = sorted(measured)
    sent = [d for d in depths if sum(b for e, b in measured.items() if e <= d) <= broadcast_bytes]
    wide, deep = [[d for d in depths if d not in sent and (d >= COLUMN_DEPTH) == below] for below in (False, True)]
    judged = _carried(findings, latest.where(F.col("depth").isin(wide)), wide) if wide else findings
    if deep:
        judged = _deep(judged, latest, deep)
    for d in sent:
        scopes = latest.where(F.col("depth") == d).select(*path[:d + 1], F.col("decision").alias(f"_decision_{d}"))
        judged = judged.join(F.broadcast(scopes), path[:d + 1], "left")
    status = F.coalesce(*[F.col(f"_decision_{d}") for d in reversed(depths)], F.lit("pending"))
    return judged.select(*[F.col(c) for c in findings.columns], status.alias("status"))


def _deep(findings: DataFrame, latest: DataFrame, depths: Sequence[int]) -> DataFrame:
    """Findings with the decisions on their column and on their classifier there, which lie in one row for each column."""
    path = ["job_id", *SCOPE]
    at = lambda d, value: F.when(F.col("depth") == d, value)
    columns = latest.where(F.col("depth").isin(list(depths))).groupBy(*path[:-1]).agg(
        F.max(at(COLUMN_DEPTH, F.col("decision"))).alias("_column"),
        F.map_from_entries(F.collect_list(at(COLUMN_DEPTH + 1, F.when(F.col(path[-1]).isNotNull(), F.struct(path[-1], "decision"))))).alias("_classifiers"))
    found = {COLUMN_DEPTH: F.col("_column"), COLUMN_DEPTH + 1: F.try_element_at("_classifiers", F.col(path[-1]))}
    return findings.join(columns, path[:-1], "left").select(
        *[F.col(c) for c in findings.columns], *[found[d].alias(f"_decision_{d}") for d in depths])


def _carried(findings: DataFrame, latest: DataFrame, depths: Sequence[int]) -> DataFrame:
    """Findings with the decision of each depth that holds for them, by a carry along sorted paths.

    Findings and decisions are cut into ranges of paths, whatever their scopes hold.
    Within a range the last decision of each depth is carried to the rows behind it;
    it holds where it names the beginning of their path. What holds for the first
    path of a range, a row per range and depth, is looked up in the decisions.
    """
    path = ["job_id", *SCOPE]
    kind = findings.select(F.struct(*findings.columns).alias("row")).schema["row"].dataType
    rows = findings.select(*path, F.lit(1).alias("kind"), F.lit(None).cast("int").alias("depth"),
                           F.lit(None).cast("string").alias("decision"), F.struct(*findings.columns).alias("row"))
    both = rows.unionByName(latest.select(*path, F.lit(0).alias("kind"), "depth", "decision", F.lit(None).cast(kind).alias("row")))
    ranged = write_through(both.repartitionByRange(*path, "kind").withColumn("part", F.spark_partition_id()), "paths")
    first = ranged.groupBy("part").agg(F.min(F.struct(*path)).alias("first")).select("part", "first.*")
    begun = first
    for d in depths:
        scopes = latest.where(F.col("depth") == d).select(
            *path[:d + 1], F.struct(*path[:d + 1], F.col("decision").alias("decision")).alias(f"_first_{d}"))
        begun = begun.join(scopes, path[:d + 1], "left")
    begun = begun.select("part", *[f"_first_{d}" for d in depths])
    before = Window.partitionBy("part").orderBy(*[F.asc_nulls_first(c) for c in path], "kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = ranged.select("*", *[
        F.last(F.when((F.col("kind") == 0) & (F.col("depth") == d), F.struct(*path[:d + 1], "decision")), ignorenulls=True)
        .over(before).alias(f"_last_{d}") for d in depths]).where("kind = 1")

    def holds(name: str, d: int) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"{name}.{c}") == F.col(c) for c in path[:d + 1]])

    decided = [F.coalesce(F.when(holds(f"_last_{d}", d), F.col(f"_last_{d}.decision")),
                          F.when(holds(f"_first_{d}", d), F.col(f"_first_{d}.decision"))).alias(f"_decision_{d}") for d in depths]
    # one row for each range
    return carried.join(F.broadcast(begun), "part").select("row", *decided).select("row.*", *[f"_decision_{d}" for d in depths])


def revoke_decisions(decisions: DataFrame, job_id: str, **scope: str | None) -> DataFrame:
    """Decisions without those at the given scope and below."""
    check_decision(**scope)
    inside = F.col("job_id") == job_id
    for name in SCOPE:
        if scope.get(name) is not None:
            inside = inside & F.col(name).eqNullSafe(F.lit(scope[name]))
    return decisions.filter(~inside)


def review_status(findings: DataFrame) -> DataFrame:
    """Review progress per job."""
    return findings.groupBy("job_id").agg(F.count(F.lit(1)).alias("total"), *_status_counts())


def propose_tags(findings: DataFrame, classifier_tags: DataFrame, known_tags: DataFrame) -> DataFrame:
    """Approved findings as tag assignments; flags tags that must be created first."""
    approved = findings.filter(F.col("status") == "approved")
    existing = known_tags.select("tag_name", F.lit(True).alias("_known")).distinct()
    return (
        fan_out_join(
            fan_out_join(approved, classifier_tags, ["classifier_name"])
            .groupBy(*KEYS, "tag_name", "tag_value").agg(F.max("score").alias("score")),
            existing, ["tag_name"], "left")
        .withColumn("tag_missing", F.col("_known").isNull()).drop("_known")
    )
