"""Hard negatives: rows of another label whose score lies in a window below the positives'.

Scores are exact integers. Anchors and candidates meet in tiles, blocks of an
anchor matrix against blocks of all rows, and each tile is multiplied by
Strassen's recursion on int64 with zero padding. Sums may wrap on the way; they
are exact modulo 2**64, so every score that fits in a long is right.

Two passes over the tiles: the first multiplies rows of equal label only and
keeps the best positives of each anchor, the second keeps for each anchor and
positive the best rows inside the window. Both keep short sorted heaps, which
merge within a task as tiles come and once more after the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from wardlake.session import write_through

#: Matrices with a side of at most so many are multiplied directly.
LEAF = 16
#: Anchors and candidates of a block; candidates multiplied at a time.
ANCHOR_BLOCK, CANDIDATE_BLOCK, TILE = 2048, 8192, 1024
#: Tasks of a pass; with more cells than that a task works on several, one after the other.
MOST_TASKS = 20_000
#: Bound on a squared norm, so that every score fits in a long.
MOST_NORM = float(2**62)

_NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices by seven half-size products, recursively."""
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    if min(rows, inner, columns) <= leaf:
        return a @ b
    r, k, c = (rows + 1) // 2, (inner + 1) // 2, (columns + 1) // 2
    if rows % 2 or inner % 2:
        a = np.pad(a, ((0, 2 * r - rows), (0, 2 * k - inner)))
    if inner % 2 or columns % 2:
        b = np.pad(b, ((0, 2 * k - inner), (0, 2 * c - columns)))
    a11, a12, a21, a22 = a[:r, :k], a[:r, k:], a[r:, :k], a[r:, k:]
    b11, b12, b21, b22 = b[:k, :c], b[:k, c:], b[k:, :c], b[k:, c:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * r, 2 * c), np.int64)
    out[:r, :c], out[:r, c:] = m1 + m4 - m5 + m7, m3 + m5
    out[r:, :c], out[r:, c:] = m2 + m4, m1 - m2 + m3 + m6
    return out[:rows, :columns]


class Heaps:
    """The best ``size`` of each of many lists, by score, ties by smaller id; lists merge with others."""

    def __init__(self, lists: int, size: int):
        self.scores = np.full((lists, size), _NONE, np.int64)
        self.ids = np.full((lists, size), np.iinfo(np.int64).max, np.int64)
        self.used = np.zeros((lists, size), bool)

    def merge(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray, used: np.ndarray) -> None:
        """Take rows of more entries into the lists of these numbers; each number occurs once."""
        s, i, u = (np.concatenate([own[lists], new], axis=1) for own, new in ((self.scores, scores), (self.ids, ids), (self.used, used)))
        order = np.lexsort((i, ~s, ~u), axis=1)[:, :self.scores.shape[1]]
        for own, new in ((self.scores, s), (self.ids, i), (self.used, u)):
            own[lists] = np.take_along_axis(new, order, axis=1)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, Iterator[pa.Table]]]:
    """Anchors and then the candidates, in runs of ``TILE``, of each cell; rows come sorted by cell and kind."""
    state: dict = {"next": None}

    def pieces() -> Iterator[pa.Table]:
        for batch in batches:
            for at in range(0, len(batch), TILE):
                yield pa.Table.from_batches([batch.slice(at, TILE)])

    def runs() -> Iterator[tuple[tuple, pa.Table]]:
        for table in pieces():
            marks = [table.column(c).to_numpy() for c in ("a_block", "c_block", "kind")]
            cut = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], axis=0)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(table)]):
                yield tuple(int(m[a]) for m in marks), table.slice(a, b - a)

    source = runs()
    state["next"] = next(source, None)
    while state["next"] is not None:
        cell, anchors = state["next"][0][:2], []
        while state["next"] is not None and state["next"][0] == (*cell, 0):
            anchors.append(state["next"][1])
            state["next"] = next(source, None)

        def candidates() -> Iterator[pa.Table]:
            while state["next"] is not None and state["next"][0] == (*cell, 1):
                table = state["next"][1]
                state["next"] = next(source, None)
                yield table

        rest = candidates()
        if anchors:
            yield pa.concat_tables(anchors), rest
        for _ in rest:  # a cell without anchors
            pass


def _arrays(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = table.column("vector").combine_chunks()
    return table.column("vec_id").to_numpy(), table.column("label").to_numpy(), _matrix(vectors, width)


def _width(table: pa.Table) -> int:
    return int(pc.max(pc.list_value_length(table.column("vector"))).as_py() or 0)


def _scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    width = max(anchors.shape[1], candidates.shape[1], 1)
    widen = lambda m: np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m
    return strassen(widen(anchors), np.ascontiguousarray(widen(candidates).T))


def _positive_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for table, rest in _cells(batches):
        key = table.column("anchor").to_numpy()
        ids, labels, vectors = _arrays(table, _width(table))
        heaps = Heaps(len(ids), size)
        for some in rest:
            cid, clabel, cvectors = _arrays(some, _width(some))
            for label in np.intersect1d(labels, clabel):
                rows, columns = np.flatnonzero(labels == label), np.flatnonzero(clabel == label)
                scores = _scores(vectors[rows], cvectors[columns])
                others = np.broadcast_to(cid[columns], scores.shape)
                heaps.merge(rows, scores, others, others != ids[rows][:, None])
        yield _entries(heaps, {"anchor": key}, ["positive_id", "positive_score"])


def _negative_batches(batches: Iterator[pa.RecordBatch], size: int, window: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    low, high = window
    for table, rest in _cells(batches):
        ids, labels, vectors = _arrays(table, _width(table))
        positives = table.column("positives").combine_chunks()
        counts = positives.value_lengths().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(ids)), counts)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        bounds = positives.flatten().to_pylist()
        least = np.array([-(-low * p // 100) for p in bounds], np.int64)  # the window in whole scores, rounded inwards
        most = np.array([high * p // 100 for p in bounds], np.int64)
        heaps = Heaps(len(owner), size)
        for some in rest:
            cid, clabel, cvectors = _arrays(some, _width(some))
            scores = _scores(vectors, cvectors)
            by_id = np.argsort(cid, kind="stable")
            ordered = scores[:, by_id]
            order = np.argsort(~ordered, axis=1, kind="stable")  # best first, ties by id
            ordered, columns = np.take_along_axis(ordered, order, axis=1), by_id[order]
            other = clabel[columns] != labels[:, None]
            for p in range(int(counts.max(initial=0))):  # the p-th positive of all anchors
                lists = np.flatnonzero(place == p)
                rows = owner[lists]
                inside = other[rows] & (ordered[rows] <= most[lists][:, None]) & (ordered[rows] >= least[lists][:, None])
                rank = np.cumsum(inside, axis=1)
                inside &= rank <= size
                some_lists = np.flatnonzero(inside.any(axis=1))
                r, c = np.nonzero(inside[some_lists])
                best = np.zeros((len(some_lists), size), np.int64)
                best_ids, used = best.copy(), best.astype(bool)
                at = rank[some_lists][r, c] - 1
                source = rows[some_lists][r]
                best[r, at], best_ids[r, at], used[r, at] = ordered[source, c], cid[columns[source, c]], True
                heaps.merge(lists[some_lists], best, best_ids, used)
        yield _entries(heaps, {"anchor": table.column("anchor").to_numpy()[owner], "place": place}, ["negative_id", "negative_score"])


def _entries(heaps: Heaps, keys: dict[str, np.ndarray], names: list[str]) -> pa.RecordBatch:
    lists, _ = np.nonzero(heaps.used)
    arrays = [pa.array(k[lists], pa.int64()) for k in keys.values()]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(heaps.ids[heaps.used]), pa.array(heaps.scores[heaps.used])], [*keys, *names])


def quantised(vector: Column, scale: int = 256) -> Column:
    """The components as whole numbers, ``floor(scale * x)``; null if the vector is null or has a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def mine(rows: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "vector", label: str = "label",
         positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90)) -> DataFrame:
    """For each anchor row and each of its positives the best rows of another label inside the window.

    ``vector`` holds whole numbers (see ``quantised``). An anchor's positives are the
    first rows of its label with another id; a negative has a score between the
    ``window``'s two percentages of the positive's. Best score first, ties by
    smaller id. Gives ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``, one row per negative; ``rank`` is the negative's.

    Rows with a null id, label, vector or component take no part. Vectors of unlike
    length are filled up with zeros. Repeated rows are rows of their own: each can
    be an anchor or take a rank. A pair without a row inside its window has no
    result; an empty table gives an empty one. Vectors so long that a score could
    overflow raise an error. Other columns are left out.
    """
    spark = rows.sparkSession
    norm = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    valid = F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull())
    checked = F.when(norm < MOST_NORM, F.col(vector)).otherwise(F.raise_error(F.lit("a vector is too long for exact scores")))
    used = rows.where(valid).select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), checked.cast("array<long>").alias("vector"),
        is_anchor.alias("is_anchor"))
    anchors = write_through(
        used.where("is_anchor").select(F.monotonically_increasing_id().alias("anchor"), "vec_id", "label", "vector"), "anchors")
    n_anchors, n = anchors.count(), used.count()
    a_blocks = -(-n_anchors // ANCHOR_BLOCK) or 1
    c_blocks = max(-(-n // CANDIDATE_BLOCK), min(spark.sparkContext.defaultParallelism, -(-n // TILE)), 1)
    a_block = F.pmod(F.xxhash64("anchor"), F.lit(a_blocks)).cast("int")
    c_block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(c_blocks)).cast("int")
    every = lambda k: F.sequence(F.lit(0), F.lit(k - 1))

    def cells(query: DataFrame, extra: list[str]) -> DataFrame:
        """Each block of anchors beside each block of rows, sorted so that a cell's anchors come first."""
        more = query.schema[extra[0]].dataType if extra else None
        own = query.withColumn("a_block", a_block).withColumn("kind", F.lit(0)).withColumn("c_block", F.explode(every(c_blocks)))
        columns = ["a_block", "c_block", "kind", "anchor", "vec_id", "label", "vector"]
        against = used.withColumn("c_block", c_block).withColumn("a_block", F.explode(every(a_blocks))).select(
            "a_block", "c_block", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("anchor"), "vec_id", "label", "vector",
            *[F.lit(None).cast(more).alias(c) for c in extra])
        both = own.select(*columns, *extra).unionByName(against)
        number = F.col("a_block") * c_blocks + F.col("c_block")
        return both.repartitionByRange(min(a_blocks * c_blocks, MOST_TASKS), number).sortWithinPartitions("a_block", "c_block", "kind")

    best_first = lambda score, other: [F.desc(score), F.asc(other)]
    found = cells(anchors, []).mapInArrow(
        lambda b: _positive_batches(b, positives), "anchor long, positive_id long, positive_score long")
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(*best_first("positive_score", "positive_id"))) - 1
    chosen = write_through(found.withColumn("place", place.cast("long")).where(F.col("place") < positives), "positives")
    listed = F.transform(F.sort_array(F.collect_list(F.struct("place", "positive_score"))), lambda p: p["positive_score"])
    with_positives = anchors.join(chosen.groupBy("anchor").agg(listed.alias("positives")), "anchor")
    mined = cells(with_positives, ["positives"]).mapInArrow(
        lambda b: _negative_batches(b, negatives, window), "anchor long, place long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*best_first("negative_score", "negative_id")))
    ranked = mined.withColumn("rank", rank).where(F.col("rank") <= negatives)
    named = chosen.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return ranked.join(named, ["anchor", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
