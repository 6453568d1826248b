"""Classifier rulesets: AND/OR trees over leaf conditions, compiled to columns.

A leaf on data becomes counters in the one profile aggregate and a test on them;
a leaf on metadata becomes a predicate on the catalog. Both end as one boolean
column per tree, NULL where a target is not active.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, functions as F

from wardlake.functions.content import is_format
from wardlake.functions.detectors import entity_hits

# Condition targets, and what each kind of job evaluates by default.
TARGETS = (
    "ROW_DATA", "METADATA", "COLUMN_LOCATION", "GDLP", "SNOWFLAKE_NATIVE", "CONTENT_TYPE",
    "DATA_LENGTH", "COLUMN_SIZE", "AMAZON_COMPREHEND",
)
DEFAULT_TARGETS = {
    "native": ("ROW_DATA",),
    "oltp": ("ROW_DATA",),
    "detector": ("GDLP",),
    "databricks": ("GDLP", "METADATA", "COLUMN_LOCATION", "CONTENT_TYPE"),
}
DETECTOR_TARGETS = ("GDLP", "SNOWFLAKE_NATIVE", "AMAZON_COMPREHEND")
NEEDS_DATA = ("ROW_DATA", "DATA_LENGTH", "CONTENT_TYPE", *DETECTOR_TARGETS)

# Names that a detector leaf may use for the same entity.
ENTITY_ALIASES = {
    "EMAIL_ADDRESS": "EMAIL", "PHONE_NUMBER": "PHONE", "CREDIT_CARD_NUMBER": "CREDIT_DEBIT_NUMBER",
    "US_SOCIAL_SECURITY_NUMBER": "SSN", "AUTH_TOKEN": "SECRET_TOKEN",
}


@dataclass(frozen=True)
class Classifier:
    """A named ruleset; the flat regex form becomes a tree with one leaf."""

    name: str
    ruleset: str
    description: str = ""

    @staticmethod
    def of(name: str, ruleset: dict | str | None = None, pattern: str | None = None,
           minimum_threshold: int | None = None, description: str = "") -> "Classifier":
        if ruleset is None:
            if pattern is None:
                raise ValueError("a classifier needs a compound ruleset or a pattern")
            ruleset = {"target": "ROW_DATA", "pattern": pattern, "comparator": "matches",
                       "minimum_threshold": 0 if minimum_threshold is None else minimum_threshold}
        text = ruleset if isinstance(ruleset, str) else json.dumps(ruleset, sort_keys=True)
        return Classifier(name, text, description)

    @property
    def tree(self) -> dict:
        return json.loads(self.ruleset)


def active_targets(job_kind: str = "native", condition_types: Iterable[str] | None = None) -> frozenset[str]:
    """Targets that a job evaluates. Native jobs keep ROW_DATA and add what is listed."""
    if job_kind not in DEFAULT_TARGETS:
        raise ValueError(f"job_kind is one of {', '.join(DEFAULT_TARGETS)}")
    listed = frozenset(t.upper() for t in (condition_types or ()))
    unknown = listed - frozenset(TARGETS)
    if unknown:
        raise ValueError(f"unknown condition types {sorted(unknown)}")
    base = frozenset(DEFAULT_TARGETS[job_kind])
    if job_kind == "databricks":
        return listed or base
    return base | listed


def leaves(tree: dict) -> list[dict]:
    if "conditions" in tree:
        return [leaf for child in tree["conditions"] for leaf in leaves(child)]
    return [tree]


def _leaf_key(leaf: dict) -> str:
    return json.dumps({k: v for k, v in leaf.items() if k != "negated"}, sort_keys=True)


def _text_test(col: Column, comparator: str, pattern: str) -> Column:
    text, want = F.lower(col), pattern.lower()
    if comparator == "matches":
        return col.rlike("(?i)" + pattern)
    if comparator == "contains":
        return F.contains(text, F.lit(want))
    if comparator == "equals":
        return text == want
    if comparator == "starts_with":
        return text.startswith(want)
    if comparator == "ends_with":
        return text.endswith(want)
    raise ValueError(f"unknown text comparator {comparator!r}")


def _number_test(col: Column, comparator: str, wanted: int) -> Column:
    tests: dict[str, Callable[[], Column]] = {
        "greater_than": lambda: col > wanted,
        "greater_than_or_equal": lambda: col >= wanted,
        "less_than": lambda: col < wanted,
        "less_than_or_equal": lambda: col <= wanted,
        "equals": lambda: col == wanted,
        "not_equals": lambda: col != wanted,
    }
    if comparator not in tests:
        raise ValueError(f"unknown numeric comparator {comparator!r}")
    return tests[comparator]()


def _percent(count: Column) -> Column:
    return F.when(F.col("non_null") > 0, count * 100.0 / F.col("non_null")).otherwise(0.0)


def _entity(leaf: dict) -> str:
    name = (leaf.get("entity_type") or leaf.get("info_type")).upper()
    return ENTITY_ALIASES.get(name, name)


class CompiledSet:
    """All classifiers of a collection against one set of active targets."""

    def __init__(self, classifiers: Iterable[Classifier], active: frozenset[str]):
        self.classifiers = list(classifiers)
        self.active = active
        self._ids: dict[str, str] = {}
        self.counters: dict[str, Column] = {}
        for c in self.classifiers:
            for leaf in leaves(c.tree):
                self._register(leaf)

    @property
    def needs_data(self) -> bool:
        return bool(self.counters)

    def _register(self, leaf: dict) -> None:
        target = leaf.get("target", "").upper()
        if target not in TARGETS:
            raise ValueError(f"unknown target {leaf.get('target')!r}")
        key = _leaf_key(leaf)
        if key in self._ids or target not in self.active or target not in NEEDS_DATA:
            return
        n = f"leaf{len(self._ids)}"
        self._ids[key] = n
        value = F.col("value")
        if target == "ROW_DATA":
            self.counters[n] = F.count_if(value.rlike(leaf["pattern"]))
        elif target == "DATA_LENGTH":
            text = F.trim(value) if leaf.get("trim") else value
            self.counters[n] = F.count_if(
                _number_test(F.octet_length(text), leaf["comparator"], leaf["length"]))
        elif target == "CONTENT_TYPE":
            formats = leaf.get("content_formats") or [leaf["content_format"]]
            for f in formats:
                self.counters[f"{n}_{f.lower()}"] = F.count_if(is_format(value, f))
        else:
            limits = {k: tuple(leaf[k]) for k in ("card_digits", "secret_digits") if k in leaf}
            scores = F.transform(entity_hits(value, _entity(leaf), **limits), lambda h: h["score"])
            total = F.aggregate(scores, F.lit(0), lambda acc, s: acc + s)
            self.counters[f"{n}_hits"] = F.sum(F.coalesce(F.size(scores), F.lit(0)))
            self.counters[f"{n}_score"] = F.sum(F.coalesce(total, F.lit(0)))

    def observed(self, leaf: dict) -> Column:
        """The measured number of a data leaf (percent or mean score); NULL for metadata."""
        target = leaf["target"].upper()
        if target not in self.active or target not in NEEDS_DATA:
            return F.lit(None).cast("double")
        n = self._ids[_leaf_key(leaf)]
        if target == "CONTENT_TYPE":
            formats = leaf.get("content_formats") or [leaf["content_format"]]
            counts = [F.col(f"{n}_{f.lower()}") for f in formats]
            return _percent(F.greatest(*counts) if len(counts) > 1 else counts[0])
        if target in DETECTOR_TARGETS:
            hits = F.col(f"{n}_hits")
            return F.when(hits > 0, F.col(f"{n}_score") / (hits * 100.0)).otherwise(0.0)
        return _percent(F.col(n))

    def leaf_result(self, leaf: dict) -> Column:
        """TRUE, FALSE, or NULL when the leaf's target is not active."""
        target = leaf["target"].upper()
        if target not in self.active:
            return F.lit(None).cast("boolean")
        has_rows = F.col("non_null") > 0
        if target == "ROW_DATA":
            result = has_rows & (self.observed(leaf) >= float(leaf.get("minimum_threshold", 0)))
        elif target == "DATA_LENGTH":
            result = has_rows & (self.observed(leaf) >= float(leaf.get("minimum_threshold", 100)))
        elif target == "CONTENT_TYPE":
            result = has_rows & (self.observed(leaf) >= float(leaf.get("dominance_threshold", 50)))
        elif target in DETECTOR_TARGETS:
            seen = F.col(f"{self._ids[_leaf_key(leaf)]}_hits") > 0
            result = seen & (self.observed(leaf) >= float(leaf.get("minimum_score", 0.5)))
        elif target == "METADATA":
            tests = [F.coalesce(_text_test(F.col(c), leaf["comparator"], leaf["pattern"]), F.lit(False))
                     for c in ("column_name", "description")]
            result = tests[0] | tests[1]
        elif target == "COLUMN_LOCATION":
            wanted = {f"{p}_name": leaf[p] for p in ("database", "schema", "table") if leaf.get(p)}
            if not wanted:
                raise ValueError("COLUMN_LOCATION needs database, schema or table")
            how = leaf.get("comparator", "equals")
            result = reduce(Column.__and__, (_text_test(F.col(c), how, v) for c, v in wanted.items()))
        else:
            test = _number_test(F.col("column_size"), leaf["comparator"], leaf["size"])
            result = F.coalesce(test, F.lit(False))
        if target in NEEDS_DATA:  # a column of which no value was read is unknown, also to a negated leaf
            result = F.when(has_rows, result)
        return ~result if leaf.get("negated") else result

    def result(self, tree: dict) -> Column:
        """The tree as one column in three-valued logic."""
        if "conditions" not in tree:
            return self.leaf_result(tree)
        parts = [self.result(child) for child in tree["conditions"]]
        if not parts:
            raise ValueError("a ruleset node needs conditions")
        operator = tree.get("operator", "AND").upper()
        if operator not in ("AND", "OR"):
            raise ValueError(f"unknown operator {operator!r}")
        folded = reduce(Column.__and__ if operator == "AND" else Column.__or__, parts)
        return ~folded if tree.get("negated") else folded

    def confidence(self, tree: dict) -> Column:
        """The best measured percentage of the data leaves; 100 for metadata alone."""
        scores = []
        for leaf in leaves(tree):
            target = leaf["target"].upper()
            if target in self.active and target in NEEDS_DATA and not leaf.get("negated"):
                value = self.observed(leaf)
                scores.append(value * 100.0 if target in DETECTOR_TARGETS else value)
        if not scores:
            return F.lit(100.0)
        return F.greatest(*scores) if len(scores) > 1 else scores[0]

    def trace(self, tree: dict, path: str = "0") -> list[Column]:
        """One struct per node: path, kind, measured value and result."""

        def state(result: Column) -> Column:
            return (F.when(result.isNull(), "SKIPPED").when(result, "TRUE").otherwise("FALSE"))

        is_group = "conditions" in tree
        kind = tree.get("operator", "AND").upper() if is_group else tree["target"].upper()
        observed = F.lit(None).cast("double") if is_group else self.observed(tree)
        node = F.struct(
            F.lit(path).alias("path"), F.lit(kind).alias("target"),
            observed.alias("observed"), state(self.result(tree)).alias("result"),
        )
        below = [
            s for i, child in enumerate(tree.get("conditions", []))
            for s in self.trace(child, f"{path}.{i}")
        ]
        return [node, *below]


def compile_ruleset(ruleset: dict | str, active: frozenset[str] = frozenset(TARGETS)) -> tuple[Column, dict[str, Column]]:
    """A tree as (result column, profile counters it needs)."""
    classifier = Classifier.of("ruleset", ruleset)
    compiled = CompiledSet([classifier], active)
    return compiled.result(classifier.tree), compiled.counters
