"""Document fingerprints by one-permutation MinHash.

Each word shingle is hashed once; the top bits of the hash choose one of
``BINS`` bins, and the least hash of a bin is its value. An empty bin takes the
value of a filled one, tried in an order that is fixed for each bin (optimal
densification: every bin draws its own sequence of others, so that two documents
that share their filled bins also share the filled-in ones with the probability
of a match). The low bits of a value are taken after mixing it with the number of
the bin, so that a value that fills many bins does not stand in them as the same
bits. Of every value ``BITS`` low bits are stored. Two fingerprints agree in a bin by
likeness or by chance; ``likeness`` takes the chance off.

A document without words has the fingerprint of all zeros; one with words that would
come out so has its last bit set.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wardlake.llm import wordhash
from wardlake.session import write_through

BINS, BITS = 256, 4
#: Draws of each bin before it takes the next filled bin to its right.
DRAWS = 512


def draws() -> np.ndarray:
    """BINS × DRAWS: the order in which an empty bin asks others."""
    with np.errstate(over="ignore"):
        x = wordhash.mix(np.arange(BINS * DRAWS, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25) + np.uint64(12345))
    return (x % np.uint64(BINS)).astype(np.int64).reshape(BINS, DRAWS)


def fingerprints(shingles: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Packed fingerprints, a row of bytes per document. ``shingles`` are distinct and sorted in each document."""
    n = len(sizes)
    values, filled = np.zeros((n, BINS), np.uint64), np.zeros((n, BINS), bool)
    doc = np.repeat(np.arange(n), sizes)
    bin_ = (shingles >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    cell = doc * BINS + bin_
    if len(cell):
        first = np.concatenate([[True], cell[1:] != cell[:-1]])  # sorted: the first of a bin is its least
        values.reshape(-1)[cell[first]] = shingles[first]
        filled.reshape(-1)[cell[first]] = True
    d, i = np.nonzero(~filled & filled.any(1)[:, None])
    for t in range(DRAWS):
        if not len(d):
            break
        other = order[i, t]
        hit = filled[d, other]
        values[d[hit], i[hit]] = values[d[hit], other[hit]]
        d, i = d[~hit], i[~hit]
    for row, col in zip(d, i):
        at = np.flatnonzero(filled[row])
        values[row, col] = values[row, at[np.searchsorted(at, col) % len(at)]]
    with np.errstate(over="ignore"):
        salted = wordhash.mix(values ^ wordhash.seeds(BINS, 41))
    low = np.where(filled.any(1)[:, None], salted & np.uint64((1 << BITS) - 1), np.uint64(0)).astype(np.uint8)
    packed = low[:, 0::2] << BITS | low[:, 1::2]
    packed[filled.any(1) & ~packed.any(1), -1] = 1
    return packed


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of packed fingerprints, row by row."""
    x = a ^ b
    same = (x >> BITS == 0).sum(1) + (x & ((1 << BITS) - 1) == 0).sum(1)
    chance = 2.0 ** -BITS
    guess = np.clip((same / BINS - chance) / (1 - chance), 0.0, 1.0)
    empty = ~a.any(1) | ~b.any(1)
    return np.where(empty, (a == b).all(1).astype(float), guess)


def of_texts(texts: list[str], order: np.ndarray) -> np.ndarray:
    out = [np.zeros((0, BINS * BITS // 8), np.uint8)]
    for _, shingles, sizes in wordhash.shingle_sets(pa.array(texts, pa.large_string())):
        out.append(fingerprints(shingles, sizes, order))
    return np.concatenate(out)


def fingerprint(docs: DataFrame, text: str = "text", column: str = "fingerprint") -> DataFrame:
    """``docs`` with the packed fingerprint of ``text`` as binary. Null counts as empty. No shuffle."""
    from pyspark.sql import types as T

    rows = docs.drop(column)
    schema = T.StructType([*rows.schema.fields, T.StructField(column, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = draws()
        for b in batches:
            prints = of_texts([t.as_py() or "" for t in b.column(text)], order)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([p.tobytes() for p in prints], pa.binary())], [*b.schema.names, column])

    return rows.mapInArrow(run, schema)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many first characters of ``following``."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


_FIELDS = ("part int, role string, doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
           "near_edited double, near_next double, text string")
_ARROW = pa.schema([("part", pa.int32()), ("role", pa.string()), ("doc_id", pa.int64()), ("n_chars", pa.int64()),
                    ("edited_sha256", pa.string()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.string())])
#: Characters of texts that are held at a time.
BLOCK_CHARS = 8_000_000


def _compared(part: int, ids: list, texts: list[str], prints: np.ndarray, following: list[str], next_prints: np.ndarray,
              order: np.ndarray) -> pa.RecordBatch:
    changed = [edited(t, f) for t, f in zip(texts, following)]
    changed_prints = of_texts(changed, order)
    n = len(ids)
    digest = [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed]
    as_bytes = lambda x: [r.tobytes() for r in x]
    return pa.RecordBatch.from_pylist([
        dict(zip(_ARROW.names, row)) for row in zip(
            [part] * n, ["done"] * n, ids, map(len, texts), digest, as_bytes(prints), as_bytes(changed_prints),
            likeness(prints, changed_prints).tolist(), likeness(prints, next_prints).tolist(), [None] * n)
    ], _ARROW)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each row with the one after it in its partition; give the partition's first and last row with their texts."""
    part, order = TaskContext.get().partitionId(), draws()
    held_ids, held_texts, held_prints, first = [], [], np.zeros((0, BINS * BITS // 8), np.uint8), True

    def end_row(role: str, k: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"part": part, "role": role, "doc_id": held_ids[k], "n_chars": len(held_texts[k]),
                                            "fingerprint": held_prints[k].tobytes(), "text": held_texts[k]}], _ARROW)

    for batch in batches:
        ids, column = batch.column(0).to_pylist(), batch.column(1)
        at = 0
        while at < len(ids):
            texts, size = [], 0
            while at + len(texts) < len(ids) and size < BLOCK_CHARS:
                texts.append(column[at + len(texts)].as_py() or "")
                size += len(texts[-1])
            held_ids = held_ids + ids[at:at + len(texts)]
            at += len(texts)
            held_texts = held_texts + texts
            held_prints = np.concatenate([held_prints, of_texts(texts, order)])
            if first:
                yield end_row("first", 0)
                first = False
            if len(held_ids) > 1:
                yield _compared(part, held_ids[:-1], held_texts[:-1], held_prints[:-1], held_texts[1:], held_prints[1:], order)
            held_ids, held_texts, held_prints = held_ids[-1:], held_texts[-1:], held_prints[-1:]
    if held_ids:
        yield end_row("last", 0)


def _join_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    order = draws()
    for b in batches:
        if b.num_rows:
            rows = b.to_pylist()
            prints = [np.frombuffer(b"".join(r[k] for r in rows), np.uint8).reshape(len(rows), -1) for k in ("fingerprint", "next_fingerprint")]
            yield _compared(-1, [r["doc_id"] for r in rows], [r["text"] for r in rows], prints[0],
                            [r["next_text"] for r in rows], prints[1], order)


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are.

    The next document is the one with the next lower key; after the last comes
    the first. Rows with one key follow each other by their text; null keys come
    last. A null text is empty. A table of one row is its own next.

    One range exchange puts the documents in order; inside a partition each row
    meets the next one. The ends of the partitions, two rows each, are joined
    afterwards. The result of the first pass, without the texts, is written once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    order = [F.col("k").desc_nulls_last(), F.xxhash64("t"), F.col("t")]
    walked = write_through(
        rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).mapInArrow(_walk, _FIELDS), "fingerprints")
    done = walked.where("role = 'done'")
    parts = sorted(r["part"] for r in walked.where("role = 'first'").select("part").collect())  # one number per partition
    following = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    first = walked.where("role = 'first'").select(
        F.col("part").alias("next_part"), F.col("fingerprint").alias("next_fingerprint"), F.col("text").alias("next_text"))
    ends = walked.where("role = 'last'").join(following, "part").join(first, "next_part")
    joined = ends.select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint").mapInArrow(_join_ends, _FIELDS)
    return done.unionByName(joined).select(
        F.col("doc_id").alias(key), "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")
