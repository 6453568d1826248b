"""Six-field cron expressions (minute hour day month weekday year) as predicates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Names accepted in the weekday and month fields.
DAYS = ("SUN", "MON", "TUE", "WED", "THU", "FRI", "SAT")
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")

BOUNDS = {
    "minute": (0, 59), "hour": (0, 23), "day": (1, 31),
    "month": (1, 12), "weekday": (1, 7), "year": (1970, 2199),
}
NAMES = {
    "month": {n: i + 1 for i, n in enumerate(MONTHS)},
    "weekday": {n: i + 1 for i, n in enumerate(DAYS)},
}


@dataclass(frozen=True)
class CronFields:
    """The allowed values of each field; None means every value."""

    minute: tuple[int, ...] | None
    hour: tuple[int, ...] | None
    day: tuple[int, ...] | None
    month: tuple[int, ...] | None
    weekday: tuple[int, ...] | None
    year: tuple[int, ...] | None

    def matches(self, local: Column) -> Column:
        """True where a local timestamp, cut to the minute, is due."""
        parts = {
            "minute": F.minute(local), "hour": F.hour(local), "day": F.dayofmonth(local),
            "month": F.month(local), "weekday": F.dayofweek(local), "year": F.year(local),
        }
        due = F.lit(True)
        for name, part in parts.items():
            wanted = getattr(self, name)
            if wanted is not None:
                due = due & part.isin(*wanted)
        return due


def _value(text: str, field: str) -> int:
    low, high = BOUNDS[field]
    number = NAMES.get(field, {}).get(text.upper())
    if number is None:
        number = int(text)
    if not low <= number <= high:
        raise ValueError(f"{text!r} is outside {low}-{high} for {field}")
    return number


def _values(text: str, field: str) -> tuple[int, ...] | None:
    if text in ("*", "?"):
        return None
    low, high = BOUNDS[field]
    found: set[int] = set()
    for item in text.split(","):
        body, _, step = item.partition("/")
        if body in ("*", ""):
            first, last = low, high
        elif "-" in body:
            first, last = (_value(v, field) for v in body.split("-", 1))
        else:
            first = _value(body, field)
            last = high if step else first
        stride = int(step) if step else 1
        if stride < 1:
            raise ValueError(f"step in {item!r} must be positive")
        if first > last:
            found.update(range(first, high + 1, stride))
            found.update(range(low, last + 1, stride))
        else:
            found.update(range(first, last + 1, stride))
    return tuple(sorted(found))


def parse_cron(expression: str) -> CronFields:
    """Read a 6-field expression; a 5-field one gets every year."""
    parts = expression.split()
    if len(parts) == 5:
        parts.append("*")
    if len(parts) != 6:
        raise ValueError(f"cron expression {expression!r} needs 6 fields")
    if parts[2] == "?" and parts[4] == "?":
        raise ValueError("'?' may stand for the day or the weekday, not both")
    return CronFields(*(_values(p, f) for p, f in zip(parts, BOUNDS)))
