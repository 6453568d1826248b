"""Shards of near equal bytes by histogram sort.

The rows are ordered by a key of one or more longs. Driver and tasks look for
the splitters together: in each round the tasks count exact bytes and rows below
evenly spaced probes of the open key intervals, the driver keeps the probes that
meet the tolerance and opens the one bin in which each other target lies. Only
counts travel. When every splitter is known, one exchange moves each row to its
place. A key value that holds many rows is split by the next part of the key, so
a group of copies may span shards, and lies together as far as the sizes allow.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardlake.session import write_through

LOWEST = -(1 << 63)
#: The first round counts by the top bits of the first key part, which is 63 bits wide.
COARSE_BITS = 10
COARSE_SHIFT = 63 - COARSE_BITS
#: Probes per open interval and round.
PROBES = 64


@dataclass
class Interval:
    """Keys that begin with ``prefix`` and have ``lo`` to ``hi`` in the next part."""

    prefix: tuple[int, ...]
    lo: int
    hi: int
    bytes_below: int
    rows_below: int
    targets: list[int] = field(default_factory=list)


@dataclass(frozen=True)
class Splitter:
    """The first key of a piece, and what lies below it."""

    key: tuple[int, ...]
    bytes_below: int
    rows_below: int


def text_key(text: Column) -> Column:
    """A 63-bit hash of a text, evenly spread; null counts as empty."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 1)


def find_splitters(keys: DataFrame, parts: list[str], size: str, shards: int, pieces: int,
                   tolerance: float) -> list[Splitter]:
    """Splitters of ``shards * pieces`` near equal ranges, the first at the lowest key.

    ``keys`` has the key ``parts`` and ``size``; the first part lies between 0
    and 2^63 - 1. Splitters between shards are within ``tolerance`` of a shard's
    bytes, those inside a shard within a quarter of a piece, or else at the key
    next to the target.
    """
    bins = sorted(
        keys.groupBy(F.shiftright(F.col(parts[0]), COARSE_SHIFT).alias("bin"))
        .agg(*_counts(parts, size, F.col(parts[0]), F.col(parts[1]) if len(parts) > 1 else F.lit(0)))
        .collect(), key=lambda r: r["bin"])
    total, n = sum(r["bytes"] for r in bins), shards * pieces
    slack = [max(1.0, tolerance * total / shards if j % pieces == 0 else total / n / 4) for j in range(n)]
    found: dict[int, Splitter] = {0: Splitter((0,) + (LOWEST,) * (len(parts) - 1), 0, 0)}
    todo = [Interval((), 0, (1 << 63) - 1, 0, 0, list(range(1, n)))]
    rows = {0: bins}
    while todo:
        todo = [x for i, interval in enumerate(todo)
                for x in _narrow(interval, rows.get(i, []), len(parts), total, n, slack, found)]
        if todo:
            rows = _probe(keys, parts, size, todo)
    out, last = [], found[0]
    for j in range(n):
        last = max(last, found[j], key=lambda s: s.key)
        out.append(last)
    return out


def _counts(parts: list[str], size: str, value: Column, deeper: Column) -> list[Column]:
    return [F.sum(size).alias("bytes"), F.count("*").alias("rows"), F.min(value).alias("lo"), F.max(value).alias("hi"),
            F.min(deeper).alias("next_lo"), F.max(deeper).alias("next_hi")]


def _narrow(at: Interval, bins: list, depth: int, total: int, n: int, slack: list[float],
            found: dict[int, Splitter]) -> list[Interval]:
    """Settle the targets that meet the tolerance; return the bins that must be opened."""
    rest = (LOWEST,) * (depth - len(at.prefix) - 1)
    edges = [Splitter((*at.prefix, at.lo, *rest), at.bytes_below, at.rows_below)]
    for r in bins:
        edges.append(Splitter((*at.prefix, r["hi"] + 1, *rest), edges[-1].bytes_below + r["bytes"], edges[-1].rows_below + r["rows"]))
    sums, opened = [e.bytes_below for e in edges], {}
    for j in at.targets:
        want = total * j / n
        k = min(max(bisect_left(sums, want), 1), len(edges) - 1) if len(edges) > 1 else 0
        near = min(edges[max(k - 1, 0)], edges[k], key=lambda e: abs(e.bytes_below - want))
        one_key = k == 0 or bins[k - 1]["rows"] == 1 or (
            bins[k - 1]["lo"] == bins[k - 1]["hi"] and len(at.prefix) + 1 == depth)
        if abs(near.bytes_below - want) <= slack[j] or one_key:
            found[j] = near
            continue
        r = bins[k - 1]
        if k not in opened:
            same = r["lo"] == r["hi"]
            opened[k] = Interval(
                (*at.prefix, r["lo"]) if same else at.prefix, r["next_lo"] if same else r["lo"],
                r["next_hi"] if same else r["hi"], edges[k - 1].bytes_below, edges[k - 1].rows_below)
        opened[k].targets.append(j)
    return list(opened.values())


def _probe(keys: DataFrame, parts: list[str], size: str, todo: list[Interval]) -> dict[int, list]:
    """Exact counts for each bin of each open interval. At most one interval per piece is open."""
    spark, depth = keys.sparkSession, len(parts)
    data = []
    for i, x in enumerate(todo):
        first = x.prefix[0] if x.prefix else x.lo
        data.append((i, first >> COARSE_SHIFT, len(x.prefix), x.lo, x.hi, *[*x.prefix, *[0] * depth][:depth]))
    names = ["__i", "__coarse", "__level", "__low", "__high", *[f"__p{k}" for k in range(depth)]]
    opened = F.broadcast(spark.createDataFrame(data, ", ".join(f"{c} long" for c in names)))
    value, deeper, inside = F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(False)
    for level, part in enumerate(parts):
        here = opened["__level"] == level
        value = F.when(here, keys[part]).otherwise(value)
        if level + 1 < depth:
            deeper = F.when(here, keys[parts[level + 1]]).otherwise(deeper)
        for k in range(level):
            here = here & (keys[parts[k]] == opened[f"__p{k}"])
        inside = inside | (here & keys[part].between(opened["__low"], opened["__high"]))
    near = keys.join(opened, (F.shiftright(keys[parts[0]], COARSE_SHIFT) == opened["__coarse"]) & inside)
    width = opened["__high"].cast("double") - opened["__low"].cast("double") + 1
    bin_ = F.least(F.lit(PROBES - 1), F.floor((value - opened["__low"]).cast("double") / width * PROBES))
    out: dict[int, list] = {}
    for r in sorted(near.groupBy(F.col("__i").alias("i"), bin_.alias("bin")).agg(*_counts(parts, size, value, deeper)).collect(),
                    key=lambda r: (r["i"], r["bin"])):
        out.setdefault(r["i"], []).append(r)
    return out


def histogram_sort(df: DataFrame, parts: list[str], size: str, shards: int = 40, pieces: int | None = None,
                   tolerance: float = 0.001) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in its shard, in key order).

    ``parts`` name long columns without nulls; the first lies between 0 and
    2^63 - 1, the others within 62 bits. ``pieces`` is the number of tasks that
    write one shard, by default enough for ``spark.sql.shuffle.partitions``
    tasks in all. Columns of ``df`` named ``shard`` or ``slot`` give way. Rows with equal keys lie side by side in any order. An empty
    table gives an empty table.
    """
    spark = df.sparkSession
    pieces = pieces or max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards))
    inner = [f"__k{k}" for k in range(len(parts))]
    keys = write_through(df.select(*[F.col(c).alias(k) for c, k in zip(parts, inner)], F.col(size).alias("__size")), "shard-keys")
    splitters = find_splitters(keys, inner, "__size", shards, pieces, tolerance)
    by_bin: dict[int, list] = {}
    for s in splitters[1:]:
        by_bin.setdefault(min(s.key[0] >> COARSE_SHIFT, (1 << COARSE_BITS) - 1), []).append(s.key)
    data, below = [], 0
    for b in range(1 << COARSE_BITS):
        inside = by_bin.get(b, [])
        data.append((b, below, inside))
        below += len(inside)
    kind = ", ".join(f"c{k}: long" for k in range(len(parts)))
    bins = spark.createDataFrame(data, f"__bin long, __below int, __inside array<struct<{kind}>>")
    starts = F.array(*[F.lit(s.rows_below - splitters[p // pieces * pieces].rows_below) for p, s in enumerate(splitters)])
    mine = F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(parts)])
    placed = (
        df.join(F.broadcast(bins), F.shiftright(F.col(parts[0]), COARSE_SHIFT) == F.col("__bin"))
        .withColumn("__piece", F.col("__below") + F.size(F.filter("__inside", lambda s: s <= mine)))
        .drop("__bin", "__below", "__inside")
    )
    order = Window.partitionBy("__piece").orderBy(*parts)
    return (
        placed.withColumn("__place", F.row_number().over(order))
        .withColumn("shard", F.floor(F.col("__piece") / pieces).cast("int"))
        .withColumn("slot", F.get(starts, F.col("__piece")) + F.col("__place") - 1)
        .drop("__piece", "__place")
    )
