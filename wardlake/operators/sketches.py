"""Column profiles as mergeable sketches, stored per job and merged for the next.

A sketch of a column is one row: exact counts, a HyperLogLog sketch of its values,
KLL sketches of its lengths and of its numbers, and a bottom-k sample of its values.
Every part of it merges, so an incremental job reads its new rows only and adds its
sketches to the stored ones; the result is as good as one over all rows. All
aggregates combine before the shuffle and hold a bounded state for each column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardlake.operators.sampling import KEYS, sample_columns

#: Registers of the distinct count (2**12: about 1.6 % standard error), and the size of a quantile sketch (about 1.3 % rank error).
HLL_BITS, KLL_SIZE = 12, 200
SAMPLE_SIZE = 1000


def _bottom(samples: DataFrame, size: int) -> DataFrame:
    """(KEYS, sample): the ``size`` least digests of each column with their values, as one array."""
    order = Window.partitionBy(*KEYS).orderBy("digest", "value")
    kept = samples.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= size)
    return kept.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("digest", "value"))).alias("sample"))


def sketch_columns(df: DataFrame, table: str, columns: Sequence[str] | None = None, sample: int = SAMPLE_SIZE,
                   key: Sequence[str] | None = None, seed: str = "0", database: str = "tpch", schema: str = "main") -> DataFrame:
    """A sketch for each column of a table; nulls are counted and are in no other part.

    The sample holds ``sample`` values of the least digests of (column, row key), the
    whole row where no ``key`` is given.
    """
    long, digests = sample_columns(df, table, sample, columns, key, seed, database, schema)
    measured = long.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("non_null"),
        F.min(F.char_length("value")).alias("min_length"), F.max(F.char_length("value")).alias("max_length"),
        F.hll_sketch_agg("value", F.lit(HLL_BITS)).alias("distinct"),
        F.kll_sketch_agg_bigint(F.char_length("value").cast("long"), F.lit(KLL_SIZE)).alias("lengths"),
        F.kll_sketch_agg_double(F.col("value").try_cast("double"), F.lit(KLL_SIZE)).alias("numbers"))
    return measured.join(_bottom(digests, sample), list(KEYS), "left").withColumn("sample_size", F.lit(sample))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """Sketches of parts as sketches of the whole, one row for each column.

    Parts must not share rows. A sample is as large as the smallest of its parts' ``sample_size``.
    """
    merged = sketches.groupBy(*KEYS).agg(
        F.sum("rows").alias("rows"), F.sum("non_null").alias("non_null"),
        F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_bigint("lengths").alias("lengths"), F.kll_merge_agg_double("numbers").alias("numbers"),
        F.min("sample_size").alias("sample_size"))
    entries = sketches.select(*KEYS, F.explode("sample").alias("s")).select(*KEYS, "s.digest", "s.value")
    limits = merged.select(*KEYS, "sample_size")
    order = Window.partitionBy(*KEYS).orderBy("digest", "value")
    # a column has at most the sum of its parts' samples here
    kept = entries.withColumn("_rank", F.row_number().over(order)).join(limits, list(KEYS)).where(F.col("_rank") <= F.col("sample_size"))
    samples = kept.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("digest", "value"))).alias("sample"))
    return merged.join(samples, list(KEYS), "left").select(*sketches.columns)


def _quantile(sketch: str, kind: str, rank: float) -> Column:
    get = getattr(F, f"kll_sketch_get_quantile_{kind}")
    some = getattr(F, f"kll_sketch_get_n_{kind}")(sketch) > 0
    return F.when(some, get(sketch, F.lit(rank)))


def read_sketches(sketches: DataFrame, quantiles: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """What sketches say: counts, distinct values, quantiles of lengths and numbers, and the size of the sample."""
    named = [(q, f"{q * 100:g}".replace(".", "_")) for q in quantiles]
    return sketches.select(
        *KEYS, "rows", "non_null", "min_length", "max_length", F.hll_sketch_estimate("distinct").alias("distinct_values"),
        *[_quantile("lengths", "bigint", q).alias(f"length_p{n}") for q, n in named],
        *[_quantile("numbers", "double", q).alias(f"number_p{n}") for q, n in named],
        F.size(F.coalesce("sample", F.array().cast("array<struct<digest:string,value:string>>"))).alias("sampled"))


def sample_share(sketches: DataFrame, condition: Column) -> DataFrame:
    """(KEYS, sampled, share): the part of a column's sampled values for which ``condition`` on ``value`` holds."""
    values = sketches.select(*KEYS, F.explode("sample").alias("s")).select(*KEYS, F.col("s.value").alias("value"))
    return values.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("sampled"), (F.count_if(condition) / F.count(F.lit(1))).alias("share"))
