"""Table readers and the column catalog."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CATALOG_SCHEMA = T.StructType([
    T.StructField("database_name", T.StringType()),
    T.StructField("schema_name", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("ordinal", T.IntegerType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("column_size", T.IntegerType()),
    T.StructField("description", T.StringType()),
])


def load_tables(spark: SparkSession, base: str, names: Sequence[str], fmt: str = "parquet",
                **options: str) -> dict[str, DataFrame]:
    """Read named tables below a folder; file formats of Spark (parquet, csv, json, orc)."""
    reader = spark.read.format(fmt).options(**options)
    return {n: reader.load(f"{base.rstrip('/')}/{n}.{fmt}") for n in names}


def declared_size(dtype: T.DataType) -> int | None:
    """Declared length of char and varchar, precision of decimal, else None."""
    if isinstance(dtype, (T.CharType, T.VarcharType)):
        return dtype.length
    if isinstance(dtype, T.DecimalType):
        return dtype.precision
    return None


def catalog_rows(database: str, schema: str, table: str, struct: T.StructType) -> list[tuple]:
    rows = []
    for i, field in enumerate(struct.fields):
        meta = field.metadata or {}
        raw = meta.get("__CHAR_VARCHAR_TYPE_STRING", "")
        length = re.search(r"\((\d+)\)", raw)
        size = int(length.group(1)) if length else declared_size(field.dataType)
        rows.append((database, schema, table, field.name, i, field.dataType.simpleString(), size,
                     meta.get("comment")))
    return rows


def frames_catalog(spark: SparkSession, tables: dict[str, DataFrame], database: str = "tpch",
                   schema: str = "main") -> DataFrame:
    """Catalog of given DataFrames, from their schemas alone; no data is read."""
    rows = [r for name, df in tables.items() for r in catalog_rows(database, schema, name, df.schema)]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def column_catalog(spark: SparkSession, databases: Sequence[str] | None = None) -> DataFrame:
    """Catalog of the tables and views registered in the session's metastore."""
    current = spark.catalog.currentCatalog()
    wanted = databases or [d.name for d in spark.catalog.listDatabases()]
    rows = []
    for database in wanted:
        for t in spark.catalog.listTables(database):
            qualified = f"`{t.name}`" if t.isTemporary else f"`{database}`.`{t.name}`"
            rows += catalog_rows(current, database, t.name, spark.table(qualified).schema)
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               num_partitions: int = 16, **options: str) -> DataFrame:
    """An OLTP table read over JDBC in ranges of a numeric or date column.

    The bounds come from one min/max query, so every partition reads one slice of
    the source. Without a column, the table is one partition.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column is None:
        return reader.option("dbtable", table).load()
    bounds = reader.option(
        "query", f"SELECT min({partition_column}) AS lo, max({partition_column}) AS hi FROM {table}"
    ).load().first()
    if bounds is None or bounds["lo"] is None:
        return reader.option("dbtable", table).load()
    return (
        reader.option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(bounds["lo"]))
        .option("upperBound", str(bounds["hi"]))
        .option("numPartitions", str(num_partitions))
        .load()
    )
