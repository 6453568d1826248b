"""Row sampling, unpivoting and column profiles: the data side of classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from wardlake.sources.tables import CATALOG_SCHEMA, catalog_rows

# Sampling strategies and the default sample sizes.
STRATEGIES = ("ROWS", "METADATA", "ROW_COUNT", "ROW_PERCENT", "COMBINED")
DEFAULT_OLTP_ROWS = 1000
DEFAULT_WAREHOUSE_ROWS = 100

KEYS = ("database_name", "schema_name", "table_name", "column_name")


def _row_hash(key: Sequence[str], seed: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in key]))


def sample_rows(df: DataFrame, strategy: str, size: int, key: Sequence[str], seed: str = "0") -> DataFrame:
    """A repeatable sample of a table by the hash of a row key; ``sample_columns`` samples each column.

    ROWS, ROW_COUNT and COMBINED keep ``size`` rows (a top-k over the hash);
    ROW_PERCENT keeps rows whose hash falls into the first ``size`` percent, a
    scan-time filter; METADATA reads no data.
    """
    name = strategy.upper()
    if name not in STRATEGIES:
        raise ValueError(f"strategy is one of {', '.join(STRATEGIES)}")
    if name == "METADATA":
        return df.limit(0)
    digest = _row_hash(key, seed)
    if name == "ROW_PERCENT":
        if not 0 <= size <= 100:
            raise ValueError("a percentage lies between 0 and 100")
        if size == 100:
            return df
        return df.filter(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100 < size)
    ordered = df.withColumn("_digest", digest).orderBy("_digest", *key)
    return ordered.limit(size).drop("_digest")


def as_text(df: DataFrame, name: str, dtype: T.DataType) -> Column:
    """A column as text; nested values as JSON, bytes as they are decoded."""
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.col(name))
    return F.col(name).cast("string")


def melt_columns(df: DataFrame, table: str, columns: Sequence[str] | None = None,
                 database: str = "tpch", schema: str = "main") -> DataFrame:
    """Long form (column key, value), every column read in one pass."""
    types = {f.name: f.dataType for f in df.schema.fields}
    names = list(columns) if columns is not None else df.columns
    texts = df.select(*[as_text(df, n, types[n]).alias(n) for n in names])
    return texts.unpivot([], names, "column_name", "value").select(
        F.lit(database).alias("database_name"), F.lit(schema).alias("schema_name"),
        F.lit(table).alias("table_name"), "column_name", "value",
    )


def sample_columns(df: DataFrame, table: str, size: int, columns: Sequence[str] | None = None, key: Sequence[str] | None = None,
                   seed: str = "0", database: str = "tpch", schema: str = "main") -> tuple[DataFrame, DataFrame]:
    """All values of a table in long form, and of each column the ``size`` non-null ones of the least digests, with ``digest``.

    The digest is one of seed, column and row key (the whole row where no ``key`` is
    given), so the sample is the same however the rows are laid out. Only rows below a
    bound are sorted. The bound follows from the number of values; where equal rows
    make it too low, it is raised and the column read again.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    names = list(columns) if columns is not None else df.columns
    row = F.concat_ws("|", *[as_text(df, k, types[k]) for k in (key or df.columns)])
    texts = df.select(row.alias("_row"), *[as_text(df, n, types[n]).alias(f"_{i}") for i, n in enumerate(names)])
    entry = lambda i, n: F.struct(F.lit(n).alias("column_name"), F.col(f"_{i}").alias("value"))
    path = [F.lit(database).alias("database_name"), F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name")]
    every = texts.select("_row", F.explode(F.array(*[entry(i, n) for i, n in enumerate(names)])).alias("e")).select(
        *path, "e.column_name", "e.value", "_row")
    counted = df.agg(*[F.count(F.col(n)).alias(f"n{i}") for i, n in enumerate(names)]).first()
    values = {n: counted[i] for i, n in enumerate(names)}
    digests = every.where("value IS NOT NULL").withColumn("digest", F.md5(F.concat_ws("|", F.lit(seed), "column_name", "_row")))
    short = {n: min(1.0, (size + 8 * size ** 0.5 + 8) / k) for n, k in values.items() if k}
    bounds: dict[str, float] = {}
    while short:
        bounds |= short
        below = _below(digests, bounds)
        if all(b >= 1.0 for b in short.values()):
            break
        full = {r["column_name"]: r["k"] for r in _below(digests, short).groupBy("column_name").agg(F.count(F.lit(1)).alias("k")).collect()}
        short = {n: min(1.0, 8 * b) for n, b in short.items() if full.get(n, 0) < min(size, values[n])}
    below = _below(digests, bounds)
    order = Window.partitionBy("column_name").orderBy("digest", "value")
    kept = below.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= size)
    return every.drop("_row"), kept.select(*KEYS, "value", "digest")


def _below(digests: DataFrame, bounds: dict[str, float]) -> DataFrame:
    """Rows whose digest lies in the first part of all digests, a part for each column."""
    if not bounds:
        return digests.limit(0)
    limit = F.create_map(*[x for n, b in bounds.items() for x in (F.lit(n), F.lit(f"{int(min(b, 1.0) * (16**12 - 1)):012x}" + "g"))])
    return digests.where(F.col("digest") <= limit[F.col("column_name")])


def profile_columns(long: DataFrame, counters: dict[str, Column]) -> DataFrame:
    """One row per column: sample size, lengths and every counter of every leaf.

    All counters share one aggregation. It combines before the shuffle, so a few
    rows per column and task are all that moves, however hot a column is.
    """
    return long.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("sampled"),
        F.count("value").alias("non_null"),
        F.min(F.char_length("value")).alias("min_length"),
        F.max(F.char_length("value")).alias("max_length"),
        *[c.alias(n) for n, c in counters.items()],
    )


def catalog_of(df: DataFrame, table: str, database: str = "tpch", schema: str = "main") -> DataFrame:
    """Catalog rows of one DataFrame from its schema."""
    return df.sparkSession.createDataFrame(catalog_rows(database, schema, table, df.schema), CATALOG_SCHEMA)
