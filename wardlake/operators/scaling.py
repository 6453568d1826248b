"""Building blocks that keep joins and numbering safe on skewed keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wardlake.session import write_through

HOT_SHARE = 0.001
SALTS = 64
#: Pieces of the pairs of a join that a task gets, about.
SPREAD = 4
#: Control tables of up to so many rows are sent to all tasks; they hold names and numbers, a few hundred bytes a row.
BROADCAST_ROWS = 20_000
#: Rows of the two sides of a product that one tile holds at most.
TILE = (256, 256)
#: The second side of a product is sent to all tasks up to so many bytes of text.
TILED_BYTES = 8 << 20


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return True
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    return isinstance(dtype, T.StructType) and any(_has_map(f.dataType) for f in dtype.fields)


def row_salt(df: DataFrame, salts: int) -> Column:
    """A number below ``salts`` from the row's own values: the same on every retry.

    Maps cannot be hashed and are left out.
    """
    columns = [f.name for f in df.schema.fields if not _has_map(f.dataType)]
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int") if columns else F.lit(0)


def hot_keys(df: DataFrame, keys: Sequence[str], hot_share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold more than ``hot_share`` of the rows: fewer than ``1 / hot_share`` of them.

    The counts combine before the shuffle; the total is a sum over the same counts.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows").alias("_total")).scalar()
    return (
        counts.filter(F.col("_rows") > total * F.lit(hot_share))
        .dropna(subset=list(keys)).select(*keys, F.lit(True).alias("_hot"))
    )


def skew_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hot_share: float = HOT_SHARE,
    salts: int = SALTS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join in which heavy keys of ``big`` are spread over many tasks.

    Only the list of hot keys is broadcast, whose length is bounded. Rows of a hot
    key get a salt from the hash of the whole row, the matching lookup rows are
    repeated once per salt, and all other rows keep salt 0. The result equals the
    plain join for inner, left, left_semi and left_anti. Pass ``hot`` when the keys
    can be counted on something cheaper than ``big`` itself.
    """
    keys = list(keys)
    marks = F.broadcast(hot_keys(big, keys, hot_share) if hot is None else hot)
    salted = (
        big.join(marks, keys, "left")
        .withColumn("_salt", F.when(F.col("_hot"), row_salt(big, salts)).otherwise(F.lit(0)))
        .drop("_hot")
    )
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    copies = (
        lookup.join(marks, keys, "left")
        .withColumn("_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0)))))
        .drop("_hot")
    )
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def fan_out_join(
    big: DataFrame,
    control: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    salts: int | None = None,
) -> DataFrame:
    """Equi-join with a control table (rules, tags, policies) on keys that have few values.

    The control table is counted first, up to ``BROADCAST_ROWS``. Within that it is
    broadcast and ``big`` is not shuffled. Beyond, both are shuffled, and a key that
    makes more than one of ``salts`` parts of the pairs is cut (``_pieces``): one side
    of it is dealt out by the hash of its rows and the other repeated, so that the
    hottest key can use the whole cluster and no other rows are repeated. Spark takes
    repeated rows for one, and so must not choose a broadcast of them by their size.
    """
    keys = list(keys)
    if control.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return big.join(F.broadcast(control), keys, how)
    return _cut_join(big, control, keys, how, salts)


def _cut_join(big: DataFrame, control: DataFrame, keys: list[str], how: str, salts: int | None = None) -> DataFrame:
    """``fan_out_join`` beyond a broadcast."""
    tasks = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = F.broadcast(_pieces(big, control, keys, how, salts or SPREAD * tasks))
    # a null key meets nothing, and any task can say so
    lost = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    each = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1))
    of = lambda df, n: F.coalesce(F.pmod(row_salt(df, 1 << 30), n), F.lit(0))
    left = big.join(pieces, keys, "left").withColumn(
        "_big", F.when(lost, row_salt(big, tasks)).otherwise(of(big, F.col("_bigs")))).withColumn("_control", each(F.col("_controls")))
    right = control.join(pieces, keys, "left").withColumn(
        "_control", of(control, F.col("_controls"))).withColumn("_big", each(F.col("_bigs")))
    on = [*keys, "_big", "_control"]
    dealt = [df.drop("_bigs", "_controls").repartition(tasks, *on) for df in (left, right)]
    return dealt[0].join(dealt[1].hint("merge"), on, how).drop("_big", "_control")


def _pieces(big: DataFrame, control: DataFrame, keys: Sequence[str], how: str, parts: int) -> DataFrame:
    """(keys, _bigs, _controls): into how many pieces the rows of a heavy key are cut on either side; at most ``parts`` keys.

    The pairs of a key are counted, a row without any as one. The side with more rows
    is cut, but a control table only where each row may be missed (an inner join).
    """
    count = lambda df, name: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    rows, met = F.col("_rows"), F.coalesce("_met", F.lit(0))
    pairs = count(big, "_rows").join(count(control, "_met"), keys, "inner" if how == "inner" else "left").select(
        *keys, "_rows", met.alias("_met"), (rows.cast("double") * F.greatest(met, F.lit(1))).alias("_pairs"))
    total = pairs.agg(F.sum("_pairs")).scalar()
    n = F.ceil(F.col("_pairs") * parts / total)
    cut = F.lit(how == "inner") & (F.col("_met") > rows)
    return pairs.dropna(subset=list(keys)).filter(F.col("_pairs") * parts > total).select(
        *keys, F.when(cut, 1).otherwise(F.least(n, rows)).cast("int").alias("_bigs"),
        F.when(cut, F.least(n, "_met")).otherwise(1).cast("int").alias("_controls"))


def tiled_product(big: DataFrame, control: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join of two tables on keys of which each makes many pairs, in tiles.

    Written row by row, each row of ``big`` is followed by all rows of ``control``, whose
    values then come again too late for the dictionary and the compression of a file.
    Here few rows of ``control`` meet few of ``big`` before the next ones do: either side
    is gathered in rows of arrays (``TILE``), and a pair of them is a tile. The arrays of
    ``big`` are dealt out evenly to all tasks and those of ``control`` broadcast, up to
    ``BROADCAST_ROWS`` of them and ``TILED_BYTES``; beyond, they are cut as in
    ``fan_out_join``.
    """
    keys, tasks = list(keys), int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = max(1, min(TILE[0], big.count() // (SPREAD * tasks)))
    left, right = _arrays(big, keys, rows, "_left"), _arrays(control, keys, TILE[1], "_right")
    text = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in control.columns])
    arrays, size = right.count(), control.agg(F.sum(text.cast("long"))).first()[0] or 0
    if arrays <= BROADCAST_ROWS and size <= TILED_BYTES:
        tiles = left.repartition(tasks).join(F.broadcast(right), keys)
    else:
        tiles = _cut_join(left, right, keys, "inner")
    # A function over an array is not compiled into one loop with the join below it or the
    # arrays above it, so a task holds the rows of one row of big at a time, not those of its tiles.
    each = tiles.select(*keys, "_right", F.inline(F.transform("_left", lambda row: row)))
    return each.select(*each.drop("_right").columns, F.inline("_right"))


def _arrays(rows: DataFrame, keys: list[str], size: int, name: str) -> DataFrame:
    """(keys, name): up to ``size`` rows of the same keys as a sorted array of what is beside the keys; written once.

    Rows are counted off in ranges of their order, so no key is gathered in one task.
    """
    values = [c for c in rows.columns if c not in keys]
    ranged = rows.repartitionByRange(*keys, *values).sortWithinPartitions(*keys, *values)
    arrays = ranged.withColumn("_array", F.expr(f"monotonically_increasing_id() div {size}")).groupBy(*keys, "_array").agg(
        F.sort_array(F.collect_list(F.struct(*values))).alias(name))
    return write_through(arrays.drop("_array"), "arrays")


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "row_no") -> DataFrame:
    """Gap-free 1-based numbers in a global order without a single-task window.

    Rows are range-partitioned by the order and written with their partition
    number: range bounds come from a sample, so two evaluations could cut
    differently, and the table makes both uses see the same cut. Rows are then
    numbered inside each part and shifted by the sizes of the parts before. The
    only one-task step handles one row per part.
    """
    ranged = write_through(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered")
    local = ranged.withColumn(
        "_local", F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    )
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.withColumn(
        "_before",
        F.coalesce(
            F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).select("_part", "_before")
    return (
        local.join(F.broadcast(before), "_part")
        .withColumn(name, F.col("_local") + F.col("_before"))
        .drop("_part", "_local", "_before")
    )
