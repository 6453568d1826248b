"""Whole records of line-based logs, put together inside the files in parallel.

A record begins with a line that matches a pattern; the lines up to the next such
line belong to it. Tasks read blocks of files in order, join the lines they see,
and hand back what stands before a block's first record. These few pieces are
joined to the last record before them, one row per block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, DataFrameReader, functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.window import Window

_DDL = "path string, block long, n long, value string, thread string, who string, command string"
#: A thread's connection in a MySQL general log: user and host, then the database.
_CONNECT = re.compile(r"^(\S+@\S*)")


def _assemble(batches: Iterator[pd.DataFrame], start: str, threads: tuple[int, int, int] | None) -> Iterator[pd.DataFrame]:
    """Records of each block; number 0 is what stands before its first record.

    ``threads`` gives the groups of thread, command and argument where the log says
    once who a thread belongs to.
    """
    begins, out = re.compile(start), []
    place, lines, n, known = None, [], 0, {}

    def close() -> None:
        if lines:
            value, thread, who, command = "\n".join(lines), None, None, None
            m = begins.match(value) if threads else None
            if m:
                thread, command = m[threads[0]], m[threads[1]]
                if command == "Connect" and (c := _CONNECT.match(m[threads[2]])):
                    known[thread] = c[1]
                who = known.get(thread)
            out.append((*place, n, value, thread, who, command))

    for pdf in batches:
        for path, block, line in zip(pdf["path"], pdf["block"], pdf["value"]):
            if (path, block) != place:
                close()
                place, lines, n, known = (path, block), [], 0, {}
            if begins.match(line):
                close()
                lines, n = [line], n + 1
            else:
                lines.append(line)
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=[c.split()[0] for c in _DDL.split(", ")])
                out.clear()
    close()
    if out:
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _DDL.split(", ")])


def text_lines(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    """Lines with the file and the block in which a task reads them."""
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")


def whole_records(lines: DataFrame, start: str, threads: tuple[int, int, int] | None = None) -> DataFrame:
    """``value``, a whole record each, and ``who``, if the log tells by thread.

    ``lines`` are those of whole files, as ``text_lines`` gives them: a table, or a
    micro-batch of a stream, in which a file arrives whole.
    """
    pieces = lines.mapInPandas(lambda batches: _assemble(batches, start, threads), _DDL)
    per_block = pieces.groupBy("path", "block").agg(
        F.max("n").alias("last"), F.max(F.when(F.col("n") == 0, F.col("value"))).alias("head"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    heads = per_block.withColumn("home", F.max(F.when(F.col("last") > 0, F.col("block"))).over(before)).where("head is not null and home is not null")
    tails = heads.groupBy("path", F.col("home").alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "head"))), lambda h: h["head"]), "\n").alias("tail"))
    ends = per_block.join(tails, ["path", "block"]).select("path", "block", F.col("last").alias("n"), "tail")
    whole = pieces.where("n > 0").join(ends, ["path", "block", "n"], "left").withColumn("value", F.concat_ws("\n", "value", "tail"))
    if threads is None:
        return whole.select("value", "who")
    # who a thread belongs to, where it connected in an earlier block of the file
    connected = pieces.where("command = 'Connect' and who is not null").groupBy("path", "thread", "block").agg(F.max_by("who", "n").alias("who"))
    asked = pieces.where("n > 0 and who is null").select("path", "thread", "block", F.lit(None).cast("string").alias("who")).distinct()
    earlier = Window.partitionBy("path", "thread").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    found = connected.unionByName(asked).groupBy("path", "thread", "block").agg(F.max("who").alias("who")).withColumn(
        "since", F.last("who", ignorenulls=True).over(earlier)).select("path", "thread", "block", "since")
    return whole.join(found, ["path", "thread", "block"], "left").select("value", F.coalesce("who", "since").alias("who"))
