"""Quality rules as a ledger: measure once, keep one failure bit per rule, decide later.

Every rule is evaluated once for a text. The ledger row has the measurements
and a ``bits`` number in which bit *i* says that rule *i* failed. A policy is a
versioned set of rules, that is a mask; applying another version or asking what
a rule alone costs needs the bits only, not the texts.

Null and empty texts have zero words and fail ``few_words``. Repeated rows give
repeated ledger rows. Texts of any length are measured whole: no step is
quadratic in the words of a text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wardlake.llm.columns import let, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``failed`` gets the measurements as a struct and says when the text fails."""

    name: str
    failed: Callable[[Column], Column]


#: The order fixes the bits; append, never reorder.
RULES = (
    Rule("few_words", lambda m: m["n_words"] < 50),
    Rule("repeated_words", lambda m: m["n_repeat_words"] * 100 > m["n_words"] * 50),
    Rule("symbols", lambda m: m["n_symbols"] * 100 > m["n_words"] * 10),
    Rule("capitals", lambda m: m["n_upper"] * 100 > m["word_chars"] * 30),
    Rule("repeated_lines", lambda m: m["n_dup_lines"] * 100 > m["n_lines"] * 50),
    Rule("long_words", lambda m: m["word_chars"] > m["n_words"] * 40),
)


@dataclass(frozen=True)
class Policy:
    """A version of the decision: a text goes if one of these rules failed."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        names = [r.name for r in rules]
        if unknown := set(self.rules) - set(names):
            raise ValueError(f"no such rules: {sorted(unknown)}")
        return sum(1 << names.index(r) for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
STRICT = Policy("v1", tuple(r.name for r in RULES))
POLICIES = {p.version: p for p in (BASE, STRICT)}


def _repeat_words(ws: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    Windows are compared by a 64-bit hash of their words, sorted with their
    places; equal neighbours are repeats. A repeated window covers three words,
    less what the next repeated one covers as well.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(ws) - 3),
        lambda i: F.struct(F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("h"), i.alias("i")),
    )

    def repeated(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        return F.transform(F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - i, F.lit(3)))),
            F.lit(0), lambda total, n: total + n,
        )

    found = let(let(F.sort_array(windows), repeated), lambda at: covered_sorted(at, covered))
    return F.when(F.size(ws) < 3, F.lit(0)).otherwise(found)


def covered_sorted(at: Column, covered: Callable[[Column], Column]) -> Column:
    return F.when(F.size(at) == 0, F.lit(0)).otherwise(let(F.sort_array(at), covered))


def measure(text: Column) -> Column:
    """The measurements of a text as a struct of longs; see ``MEASURES``."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    by_words = let(words(text), lambda ws: F.struct(F.size(ws).alias("n"), _repeat_words(ws).alias("repeat")))
    by_lines = let(lines, lambda ls: F.struct(
        F.size(ls).alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).alias("dup")))
    values = {
        "n_words": lambda w, ln: w["n"],
        "word_chars": lambda w, ln: F.char_length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", "")),
        "n_symbols": lambda w, ln: F.char_length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")),
        "n_upper": lambda w, ln: F.char_length(F.regexp_replace(t, r"[^\p{Lu}]+", "")),
        "n_lines": lambda w, ln: ln["n"],
        "n_dup_lines": lambda w, ln: ln["dup"],
        "n_repeat_words": lambda w, ln: w["repeat"],
    }
    return let(by_words, lambda w: let(by_lines, lambda ln: F.struct(
        *[values[name](w, ln).cast("long").alias(name) for name in MEASURES])))


def failure_bits(measured: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Bit *i* is set if rule *i* fails on the measurements."""
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(rule.failed(measured), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return bits


def entry_of(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """One ledger entry: ``bits`` and the measurements ``m``."""
    return let(measure(text), lambda m: F.struct(failure_bits(m, rules).alias("bits"), m.alias("m")))


def passes(bits: Column, policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    return bits.bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0


def ledger(docs: DataFrame, keys: list[str], text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``keys``, ``bits`` and one column per measurement, a row per row of ``docs``."""
    found = docs.select(*[F.col(k) for k in keys], entry_of(F.col(text), rules).alias("__entry"))
    return found.select(*keys, F.col("__entry.bits").alias("bits"),
                        *[F.col(f"__entry.m.{name}").alias(name) for name in MEASURES])


def apply_policy(entries: DataFrame, policy: Policy, column: str = "kept") -> DataFrame:
    """The ledger with a decision column; the texts are not read again."""
    return entries.withColumn(column, passes(F.col("bits"), policy))


def keep(docs: DataFrame, policy: Policy = STRICT, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the policy, with the columns they came with."""
    return docs.where(passes(entry_of(F.col(text))["bits"], policy))


def ablations(entries: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What each rule of a policy does: rows it fails, rows that it alone rejects, rows kept without it.

    The ledger is first counted by ``bits``, at most 2^rules groups and combined
    before the exchange; everything else is bit arithmetic on those groups.
    """
    mask = policy.mask(rules)
    groups = entries.groupBy(F.col("bits").bitwiseAND(F.lit(mask).cast("long")).alias("b")).agg(F.count("*").alias("n"))
    names = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
        for i, r in enumerate(rules) if r.name in policy.rules
    ])
    each = groups.select("b", "n", F.explode(names).alias("r"))
    hit, rest = F.col("b").bitwiseAND(F.col("r.bit")) != 0, F.col("b").bitwiseAND(F.bitwise_not(F.col("r.bit")))
    total = lambda when: F.sum(F.when(when, F.col("n")).otherwise(F.lit(0)))
    return each.groupBy(F.lit(policy.version).alias("policy"), F.col("r.rule").alias("rule")).agg(
        total(hit).alias("failed"), total(hit & (rest == 0)).alias("rejected_alone"),
        total(rest == 0).alias("kept_without"), total(F.col("b") == 0).alias("kept"),
    )
