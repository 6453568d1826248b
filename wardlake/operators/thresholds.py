"""Access-rate and time-window thresholds over audit rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardlake.operators.scaling import fan_out_join

# Accepted rate units (any case) and their window lengths.
RATE_UNITS = {"MINUTE": "1 minute", "HOUR": "1 hour", "DAY": "1 day"}
WEEKDAYS = ("SUNDAY", "MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY")


def rate_counts(audits: DataFrame, user: str = "consuming_user", ts: str = "event_time",
                units: tuple[str, ...] = tuple(RATE_UNITS)) -> DataFrame:
    """Accesses per user and fixed calendar window, for each unit.

    One partial aggregation covers all units: counts of the smallest unit are
    rolled up into the larger ones, so raw rows are aggregated and shuffled once.
    """
    names = [u.upper() for u in units]
    wrong = [u for u in names if u not in RATE_UNITS]
    if wrong:
        raise ValueError(f"unknown access rate unit {wrong}")
    smallest = min(names, key=list(RATE_UNITS).index)
    base = (
        audits.groupBy(user, F.date_trunc(smallest, ts).alias("_slot"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    per_unit = F.explode(F.array(*[
        F.struct(F.lit(u).alias("unit"), F.date_trunc(u, F.col("_slot")).alias("window_start"))
        for u in names
    ]))
    return (
        base.select(user, "_n", per_unit.alias("w"))
        .groupBy(user, "w.unit", "w.window_start")
        .agg(F.sum("_n").alias("accesses"))
    )


def rate_rules(rules: DataFrame) -> DataFrame:
    """One row per rate threshold of a rule."""
    return rules.select(
        "rule_id", "role", F.explode("access_rate_thresholds").alias("t")
    ).select(
        "rule_id", "role", F.upper("t.access_rate_unit").alias("unit"),
        F.col("t.access_rate_limit").alias("access_rate_limit"), F.col("t.action").alias("action"),
    )


def access_rate_breaches(audits: DataFrame, rules: DataFrame, user: str = "consuming_user",
                         ts: str = "event_time", role: str | None = "executing_role") -> DataFrame:
    """Windows in which a user passed the limit of a rule, with the rule's action.

    With ``role`` given, a rule counts the accesses made under its own role.
    """
    limits = rate_rules(rules)
    if role is None:
        counts, keys = rate_counts(audits, user, ts), ["unit"]
    else:
        keyed = audits.select(F.struct(user, role).alias("_who"), ts)
        counts = rate_counts(keyed, "_who", ts).select(
            F.col(f"_who.{user}").alias(user), F.col(f"_who.{role}").alias("role"),
            "unit", "window_start", "accesses",
        )
        keys = ["role", "unit"]
    return (
        fan_out_join(counts, limits, keys)
        .filter(F.col("accesses") > F.col("access_rate_limit"))
        .select("rule_id", user, "unit", "window_start", "accesses", "access_rate_limit", "action")
    )


def time_window_slots(rules: DataFrame) -> DataFrame:
    """Time-window thresholds cut at midnight: (zone, weekday, [from, to) minute).

    A window whose start lies after its end wraps: it becomes the evening of the
    named day and the morning of the next one. Equal start and end is the whole day.
    """
    t = rules.select("rule_id", F.posexplode("time_window_thresholds").alias("n", "t"))
    start = F.col("t.start_time.hour") * 60 + F.col("t.start_time.minute")
    end = F.col("t.end_time.hour") * 60 + F.col("t.end_time.minute")
    days = F.array(*[F.lit(d) for d in WEEKDAYS])
    base = t.select(
        "rule_id", "n", F.col("t.timezone").alias("zone"), F.col("t.action").alias("action"),
        F.explode("t.day").alias("day_name"), start.alias("s"), end.alias("e"),
    ).withColumn("weekday", F.array_position(days, F.upper("day_name")).cast("int"))
    next_day = F.pmod(F.col("weekday"), F.lit(7)) + 1

    def slot(day, lo, hi):
        return F.struct(day.cast("int").alias("weekday"), lo.alias("lo"), hi.alias("hi"))

    pieces = F.when(
        F.col("s") < F.col("e"), F.array(slot(F.col("weekday"), F.col("s"), F.col("e")))
    ).when(
        F.col("s") == F.col("e"), F.array(slot(F.col("weekday"), F.lit(0), F.lit(1440)))
    ).otherwise(F.array(
        slot(F.col("weekday"), F.col("s"), F.lit(1440)), slot(next_day, F.lit(0), F.col("e")),
    ))
    return base.select("rule_id", "n", "zone", "action", F.explode(pieces).alias("p")).select(
        "rule_id", F.col("n").alias("threshold_no"), "zone", "action", "p.weekday", "p.lo", "p.hi"
    ).distinct()


def time_window_breaches(audits: DataFrame, rules: DataFrame, zones: list[str],
                         ts: str = "event_time") -> DataFrame:
    """Events inside a threshold's local time window, with its action.

    Each event gets one row per zone with its local hour of the week; thresholds
    are spread over the hours they touch, so the match is an equi-join on (zone,
    weekday, hour) and the minute test is a residual filter. These keys have few
    values, so the join spreads each of them.
    """
    slots = time_window_slots(rules).filter("lo < hi").withColumn(
        "hour", F.explode(F.sequence(F.floor(F.col("lo") / 60), F.floor((F.col("hi") - 1) / 60)))
    )
    local = F.explode(F.array(*[
        F.struct(F.lit(z).alias("zone"), F.from_utc_timestamp(ts, z).alias("local")) for z in zones
    ]))
    events = audits.select("*", local.alias("z")).select(
        *audits.columns, F.col("z.zone").alias("zone"),
        F.dayofweek("z.local").alias("weekday"), F.hour("z.local").cast("long").alias("hour"),
        (F.hour("z.local") * 60 + F.minute("z.local")).alias("minute_of_day"),
    )
    return (
        fan_out_join(events, slots, ["zone", "weekday", "hour"])
        .filter((F.col("minute_of_day") >= F.col("lo")) & (F.col("minute_of_day") < F.col("hi")))
        .select(*audits.columns, "rule_id", "threshold_no", "zone", "action")
    )
