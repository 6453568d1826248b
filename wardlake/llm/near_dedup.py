"""Near-duplicate documents by MinHash with tensored banding; links are confirmed on full sets.

Two collections U and V of m values each are computed for a document, each value
the least hash of its shingles (or of ``per_half`` such, combined). Table (i, j)
has the key (U_i, V_j), so m² tables of keys cost 2m values instead of 2m². A
pair of documents with likeness s meets in some table unless it misses all of U
or all of V: 1 - (1 - (1 - s^per_half)^m)². With m = 8 a pair at 0.75 is missed
with probability 3e-5.

From keys to links without all pairs of a bucket:

1. Documents with equal shingle sets become one representative, the one with
   the smallest id.
2. Every document of a bucket is compared with the bucket's smallest id. The
   links make components.
3. A bucket whose other members are then in different components is settled by
   an exact way: for all its documents, shingles are ordered from rare to
   frequent, and only pairs that share one of their rarest shingles, and whose
   sizes and places allow the likeness, are compared (prefix and position
   filter). Nothing is capped; a shingle in thousands of documents is among the
   frequent ones of each.

Only documents that share a bucket have their shingle sets moved.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardlake.llm import wordhash
from wardlake.llm.components import connected_components
from wardlake.llm.wordcache import give_back_memory
from wardlake.session import write_through

#: Up to so many ids (16 MB) are broadcast to filter the documents; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000


@dataclass(frozen=True)
class Banding:
    """``m`` values in each collection, each from ``per_half`` hashes; links need 100·|A∩B| >= percent·|A∪B|."""

    m: int = 8
    per_half: int = 1
    percent: int = 75
    seed: int = 5


def collection_values(shingles: np.ndarray, sizes: np.ndarray, banding: Banding) -> np.ndarray:
    """The 2m values of each document, U and then V."""
    out = np.zeros((len(sizes), 2 * banding.m), np.uint64)
    with np.errstate(over="ignore"):
        for k, a in enumerate(wordhash.seeds(2 * banding.m * banding.per_half, banding.seed)):
            least = wordhash.segment_min(wordhash.mix(shingles * a), sizes)
            col = k // banding.per_half
            out[:, col] = wordhash.mix(out[:, col] * np.uint64(31) + least)
    return out


def set_digests(shingles: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that tell sets apart, whatever the order."""
    out = []
    with np.errstate(over="ignore"):
        for a in wordhash.seeds(2, 99):
            d, full = np.zeros(len(sizes), np.uint64), sizes > 0
            if full.any():
                d[full] = np.add.reduceat(wordhash.mix(shingles * a), (np.cumsum(sizes) - sizes)[full])
            out.append(d)
    return out[0], out[1]


def _signatures(batches: Iterator[pa.RecordBatch], banding: Banding) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, shingles, sizes in wordhash.shingle_sets(batch.column(1)):
            d1, d2 = set_digests(shingles, sizes)
            values = collection_values(shingles, sizes, banding).view(np.int64)
            half = lambda v: pa.ListArray.from_arrays(
                np.arange(0, v.size + 1, banding.m, dtype=np.int32), pa.array(np.ascontiguousarray(v).reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(sizes)), pa.array(sizes), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                 half(values[:, :banding.m]), half(values[:, banding.m:])], ["id", "n", "d1", "d2", "u", "v"])
    give_back_memory()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, shingles, sizes in wordhash.shingle_sets(batch.column(1)):
            ends = np.cumsum(sizes)
            sets = [shingles[e - n:e].tobytes() for e, n in zip(ends, sizes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(sizes)), pa.array(sizes), pa.array(sets, pa.binary())], ["id", "n", "shingles"])
    give_back_memory()


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    held, held_set = None, None
    for batch in batches:
        keep = []
        for k in range(batch.num_rows):
            left = batch.column(2)[k].as_buffer()
            if held is None or not left.equals(held):  # rows with one left side lie together
                held, held_set = left, np.frombuffer(left, np.uint64)
            right = np.frombuffer(batch.column(3)[k].as_buffer(), np.uint64)
            at = np.searchsorted(held_set, right)
            common = int((held_set[np.minimum(at, len(held_set) - 1)] == right).sum()) if len(held_set) else 0
            if common and 100 * common >= percent * (len(held_set) + len(right) - common):
                keep.append(k)
        yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(keep, pa.int64())) for i in (0, 1)], ["a", "b"])
    held = held_set = None
    give_back_memory()


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose full shingle sets are alike enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    joined = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "sa", "sb")
    return joined.mapInArrow(lambda batches: _confirm(batches, percent), "a long, b long")


def fits(n: Column, m: Column, percent: int) -> Column:
    """Whether sets of these sizes can be alike enough."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def only_ids(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` whose key is in ``ids``, a written table of one column with that name."""
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, key, "left_semi")


def _rare_pairs(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that can be alike enough, through their rarest shingles."""
    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                s = np.frombuffer(batch.column(3)[k].as_buffer(), np.int64)
                fixed = [np.full(len(s), batch.column(i)[k].as_py(), np.int64) for i in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*fixed, s)], ["id", "n", "label", "shingle"])

    labelled = sets.join(labels, sets["id"] == labels["node"], "left").select("id", "n", F.coalesce("label", "id").alias("label"), "shingles")
    p = write_through(labelled.mapInArrow(postings, "id long, n long, label long, shingle long"), "postings")
    frequency = p.groupBy("shingle").agg(
        F.count("*").alias("f"), (F.min("label") != F.max("label")).alias("mixed"))
    # a rarest-first order needs all shingles of a document in one place: its own set, no more
    ranked = p.join(frequency, "shingle").groupBy("id", "n", "label").agg(
        F.sort_array(F.collect_list(F.struct("f", "shingle", "mixed"))).alias("s"))
    probe = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    index = F.col("n") - F.ceil(F.col("n") * (2 * percent) / (100 + percent)) + 1
    first = ranked.select("id", "n", "label", index.alias("index"), F.posexplode(F.slice("s", F.lit(1), probe.cast("int"))).alias("pos", "e")).where(
        "e.mixed").select("id", "n", "label", "index", (F.col("pos") + 1).alias("pos"), F.col("e.shingle").alias("shingle"))
    first = write_through(first, "prefixes")
    x = first.select("shingle", *[F.col(c).alias(f"{c}_x") for c in ("id", "n", "label", "pos")])
    y = first.where("pos <= index").select("shingle", *[F.col(c).alias(f"{c}_y") for c in ("id", "n", "label", "pos")])
    rest = F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y")) + 1
    possible = (
        (F.col("n_x") >= F.col("n_y")) & fits(F.col("n_x"), F.col("n_y"), percent) & (F.col("label_x") != F.col("label_y"))
        & (rest * (100 + percent) >= (F.col("n_x") + F.col("n_y")) * percent)
    )
    pairs = x.join(y, (x["shingle"] == y["shingle"]) & possible)
    return pairs.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).where("a <> b").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", banding: Banding = Banding()) -> DataFrame:
    """``doc_id`` (the key), ``n_shingles``, ``component_id`` and ``kept``, a row per row of ``docs``.

    A component is what links reach; its id is its smallest key, and ``kept``
    says that a row has that key. Texts without words, null among them, are
    linked with nothing. Rows that share a key are one document with the links
    of all of them; a null key is linked with nothing, has no component and is
    kept.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    signed = write_through(rows.mapInArrow(
        lambda b: _signatures(b, banding), "id long, n long, d1 long, d2 long, u array<long>, v array<long>"), "signatures")
    reps = write_through(
        signed.where("n > 0 and id is not null").groupBy("d1", "d2", "n").agg(F.min(F.struct("id", "u", "v")).alias("r"))
        .select("d1", "d2", "n", "r.*"), "representatives")
    keys = reps.select("id", "n", F.posexplode("u").alias("i", "ui"), "v").select("id", "n", "i", "ui", F.posexplode("v").alias("j", "vj")).select(
        F.xxhash64("i", "j", "ui", "vj").alias("bucket"), "id", "n")
    shared = keys.groupBy("bucket").agg(F.min(F.struct("id", "n")).alias("head"), F.count("*").alias("c")).where("c > 1").select("bucket", "head")
    members = write_through(
        keys.join(shared, "bucket").where("id <> head.id").select("bucket", "id", "n", F.col("head.id").alias("head"), F.col("head.n").alias("head_n")),
        "buckets")
    ids = write_through(members.select("id").union(members.select("head")).distinct(), "candidates")
    sets = write_through(only_ids(rows, ids, "id").mapInArrow(_sets, "id long, n long, shingles binary").where("n > 0"), "sets")
    stars = members.where(fits(F.col("n"), F.col("head_n"), banding.percent)).select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    links = write_through(confirm(stars, sets, banding.percent), "links")
    labels = connected_components(links)

    named = members.join(labels, members["id"] == labels["node"], "left").select("bucket", "id", F.coalesce("label", "id").alias("label"))
    open_ = named.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("bucket")
    unsettled = write_through(members.join(open_, "bucket", "left_semi").select("id").distinct(), "unsettled")
    rare = _rare_pairs(sets.join(unsettled, "id", "left_semi"), labels, banding.percent)
    more = write_through(confirm(write_through(rare, "pairs"), sets, banding.percent), "links")
    la, lb = labels.select(F.col("node").alias("a"), F.col("label").alias("la")), labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    merged = more.join(la, "a", "left").join(lb, "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    top = connected_components(merged)

    of_rep = reps.select("d1", "d2", "n", F.col("id").alias("rep")).join(labels, F.col("rep") == labels["node"], "left").select(
        "d1", "d2", "n", F.coalesce("label", "rep").alias("l1"))
    of_rep = of_rep.join(top, F.col("l1") == top["node"], "left").select("d1", "d2", "n", F.coalesce("label", "l1").alias("component"))
    out = signed.select("id", "d1", "d2", "n").join(of_rep, ["d1", "d2", "n"], "left")
    component = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "id"))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col(key).isNull() | (F.col(key) == F.col("component_id")))
