"""Spelling variants: words one edit apart, found by a bit-sliced position index.

For every position and letter the index holds a bitset of the words that have
the letter there. A query walks its letters once and keeps, for all words at
once, the set that agrees so far (no error) and the sets with exactly one error;
a replaced letter stays at the same position, an inserted or deleted one shifts
the position looked up by one. Sixty-four words take one machine word, and many
queries are stepped together.

Two words one edit apart agree in the first or in the last half of the shorter
one, so words meet in a bucket for each half; a bucket larger than a tile is cut
into tiles of queries against indexed words. Nothing is capped. A bucket's words
lie in the order of their counts, so the number of set bits is the number of
near words and the lowest one the commonest; pairs are never written out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from wardlake.llm.wordcache import ragged
from wardlake.session import write_through

#: Letters of a word: a to z in both cases, and the code points from U+00C0 to U+00FF.
LETTERS = "A-Za-zÀ-ÿ"
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Distinct words that a task counts before it hands them on.
MOST_COUNTED = 200_000
#: Words of a tile, and letters of it for long words.
TILE_WORDS, TILE_LETTERS = 16_384, 1 << 21
#: Query and lane pairs stepped together.
BLOCK_ROWS = 1 << 18


def _damaged(run: str, key: bytes, every: int) -> str:
    h = zlib.crc32(run.encode(), zlib.crc32(key))
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count_batches(batches: Iterator[pa.RecordBatch], least: int, drop_every: int) -> Iterator[pa.RecordBatch]:
    runs = re.compile(f"[{LETTERS}]{{{least},}}")
    counted: Counter[str] = Counter()
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            if not text:
                continue
            found = Counter(runs.findall(text.encode().translate(_LOWER).decode()))
            if drop_every:
                prefix = f"{'' if key is None else key}:".encode()
                for run, n in found.items():
                    word = _damaged(run, prefix, drop_every)
                    if len(word) >= least:
                        counted[word] += n
            else:
                counted.update(found)
            if len(counted) >= MOST_COUNTED:
                yield _counts(counted)
                counted = Counter()
    if counted:
        yield _counts(counted)


def _counts(counted: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(counted.keys(), pa.string()), pa.array(counted.values(), pa.int64())], ["word", "n"])


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = 6, least_count: int = 5,
                drop_every: int = 0) -> DataFrame:
    """``word, n``: the words of whole texts with at least so many letters and occurrences; only A-Z are lower-cased.

    With ``drop_every``, a run loses one letter where the CRC of its row's key and
    itself is divisible by it, which plants misspellings. Null and empty texts
    have no words; a null key counts as the empty text; repeated rows count as
    often as they occur.
    """
    rows = docs.select(F.col(key).cast("string"), F.col(text))
    parts = rows.mapInArrow(lambda b: _count_batches(b, least_length, drop_every), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _half(size: Column) -> Column:
    return F.floor(size / 2).cast("int")


def _tiles(words: DataFrame) -> DataFrame:
    """A row per word and tile: its bucket (length of the shorter word, side, letters), tile and role (1 query, 2 indexed, 3 both)."""
    long = F.char_length("word")
    buckets = F.flatten(F.transform(
        F.filter(F.array(long, long - 1), lambda s: s > 0),
        lambda s: F.array(
            F.struct(s.alias("size"), F.lit(0).alias("side"), F.substr("word", F.lit(1), _half(s)).alias("part")),
            F.struct(s.alias("size"), F.lit(1).alias("side"), F.substr("word", long - _half(s) + 1, _half(s)).alias("part")))))
    placed = words.select("word", "n", F.explode(buckets).alias("b")).select("word", "n", "b.*")
    most = F.greatest(F.lit(64), F.least(F.lit(TILE_WORDS), F.floor(F.lit(TILE_LETTERS) / (F.col("size") + 1))))
    large = (
        placed.groupBy("size", "side", "part").agg(F.count("*").alias("k"))
        .withColumn("slices", F.ceil(F.col("k") / most).cast("int")).where("slices > 1").drop("k"))
    placed = placed.join(large, ["size", "side", "part"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("slices")).cast("int")
    each = F.sequence(F.lit(0), F.col("slices") - 1)
    role = lambda q, x, r: F.struct(q.alias("q"), x.alias("x"), r.alias("role"))
    tiles = F.concat(
        F.transform(each, lambda j: role(F.col("own"), j, F.when(j == F.col("own"), 3).otherwise(1))),
        F.transform(F.filter(each, lambda j: j != F.col("own")), lambda j: role(j, F.col("own"), F.lit(2))))
    return placed.withColumn("own", own).select("size", "side", "part", "word", "n", F.explode(tiles).alias("t")).select(
        "size", "side", "part", "t.*", "word", "n")


class PositionIndex:
    """Bitsets of words for each position and letter; words have ``size`` or ``size + 1`` letters."""

    def __init__(self, words: list[str], size: int):
        self.size = size
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        alphabet, codes = np.unique(flat, return_inverse=True)
        self.codes = np.zeros((len(words), size + 2), np.int32)  # 0: behind the end
        row = np.repeat(np.arange(len(words)), self.lengths)
        self.codes[row, ragged(np.zeros(len(words), np.int64), self.lengths)] = codes + 1
        lanes = (len(words) + 63) // 64
        slots = np.arange(len(words))
        self.letters = np.empty((size + 2, len(alphabet) + 1, lanes), np.uint64)
        for i in range(size + 2):
            has = np.zeros((len(alphabet) + 1, lanes * 64), bool)
            has[self.codes[:, i], slots] = True
            self.letters[i] = np.packbits(has, axis=1, bitorder="little").view("<u8")
        self.short = self.bits(self.lengths == size)

    def bits(self, chosen: np.ndarray) -> np.ndarray:
        out = np.zeros(-(-len(chosen) // 64) * 64, bool)
        out[:len(chosen)] = chosen
        return np.packbits(out, bitorder="little").view("<u8")

    def near(self, queries: np.ndarray, lanes: np.ndarray, among: np.ndarray, besides: int | None) -> np.ndarray:
        """For each query (a word of the index) and lane, the words in ``among`` one edit from it.

        All queries are of one length. A word of ``size`` letters finds those of its
        own length and the longer ones, a longer word finds the shorter ones. Words
        that agree with the query in the first ``besides`` letters are left out.
        """
        codes, size, letters = self.codes[queries], self.size, self.letters
        short = self.lengths[queries[0]] == size
        same, replaced, shifted = among.copy(), np.zeros_like(among), np.zeros_like(among)
        agree = np.zeros_like(among)
        for i in range(size if short else size + 1):
            if i == besides:
                agree = same.copy()
            c = codes[:, i]
            here = letters[i, c, lanes]
            if short:
                shifted = (shifted | same) & letters[i + 1, c, lanes]  # the word has a letter more before this one
                replaced = (replaced & here) | (same & ~here)
            else:
                before = letters[i - 1, c, lanes] if i else np.zeros_like(among)
                shifted = (shifted & before) | same  # the word lacks this letter or an earlier one
            same = same & here
        if besides == size and short:
            agree = same
        of_size = self.short[lanes]
        found = (replaced & of_size) | ((shifted | same) & ~of_size) if short else shifted & of_size
        return found if besides is None else found & ~agree


def near_in_tiles(words: list[str], tile: np.ndarray, role: np.ndarray, size: int, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``query, number of near words, first near word`` (places in ``words``) of the queries that have any.

    ``tile`` rises; words meet within a tile only. Pairs that agree in the first
    half are left to the buckets of first halves.
    """
    index = PositionIndex(words, size)
    firsts = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
    lasts = np.append(firsts[1:], len(words))
    number = np.cumsum(np.concatenate([[0], (tile[1:] != tile[:-1]).astype(np.int64)]))
    indexed = index.bits((role & 2) > 0)
    out = []
    for length in (size, size + 1):
        queries = np.flatnonzero((index.lengths == length) & ((role & 1) > 0))
        first, last = firsts[number[queries]], lasts[number[queries]]
        spans = (last - 1) // 64 - first // 64 + 1
        ends = np.cumsum(spans)
        a = 0
        while a < len(queries):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BLOCK_ROWS, "right")))
            n, lo, hi = spans[a:b], first[a:b], last[a:b]
            rows = np.repeat(np.arange(b - a), n)
            lanes = ragged(lo // 64, n)
            found = index.near(queries[a:b][rows], lanes, indexed[lanes] & _between(lanes, lo[rows], hi[rows]), size // 2 if side else None)
            begin = np.cumsum(n) - n
            count = np.add.reduceat(np.bitwise_count(found).astype(np.int64), begin)
            low = np.where(found == 0, len(words), lanes * 64 + np.bitwise_count((found & -found) - np.uint64(1)))
            some = count > 0
            out.append((queries[a:b][some], count[some], np.minimum.reduceat(low, begin)[some]))
            a = b
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))


def _between(lanes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The bits of places from ``first`` to before ``last`` in each lane."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    low = np.clip(first - lanes * 64, 0, 63).astype(np.uint64)
    high = np.clip(lanes * 64 + 64 - last, 0, 63).astype(np.uint64)
    return (full << low) & (full >> high)


def _near_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by size, side and tile; whole tiles are worked on together as far as they fit."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not len(table):
            continue
        held.append(table)
        if sum(map(len, held)) < 4096:
            continue
        rows = pa.concat_tables(held)
        yield from _near_rows(rows, last := _last_tile(rows))
        held = [rows.slice(last)] if last < len(rows) else []
    if held:
        rows = pa.concat_tables(held)
        yield from _near_rows(rows, len(rows))


def _edges(rows: pa.Table, names: tuple[str, ...]) -> np.ndarray:
    """Places where a row differs from the one before it."""
    differs = np.zeros(len(rows), bool)
    differs[:1] = True
    for name in names:
        column = rows.column(name).combine_chunks()
        if len(rows) > 1:
            differs[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(rows) - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(differs)


_TILE = ("size", "side", "part", "q", "x")


def _last_tile(rows: pa.Table) -> int:
    return int(_edges(rows, _TILE)[-1])


def _near_rows(rows: pa.Table, end: int) -> Iterator[pa.RecordBatch]:
    rows = rows.slice(0, end)
    if not end:
        return
    starts = _edges(rows, _TILE)
    tile = np.zeros(end, np.int64)
    tile[starts] = 1
    tile = np.cumsum(tile)
    groups = np.append(_edges(rows, ("size", "side")), end)
    words, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
    role, size, side = (rows.column(c).to_numpy() for c in ("role", "size", "side"))
    for a, b in zip(groups, groups[1:]):
        first = a
        while first < b:  # whole tiles, as many as one index may hold
            most = max(64, min(2 * TILE_WORDS, 2 * TILE_LETTERS // (int(size[first]) + 1)))
            cuts = starts[(starts > first) & (starts < b) & (starts <= first + most)]
            stop = b if b - first <= most else int(cuts[-1]) if len(cuts) else int(min([*starts[starts > first], b]))
            some = words[first:stop]
            query, count, best = near_in_tiles(some, tile[first:stop], role[first:stop], int(size[first]), int(side[first]))
            if len(query):
                yield pa.RecordBatch.from_arrays([
                    pa.array([some[k] for k in query.tolist()], pa.string()), pa.array(count, pa.int64()),
                    pa.array([some[k] for k in best.tolist()], pa.string()), pa.array(n[first:stop][best], pa.int64())],
                    ["word", "n_near", "best", "best_n"])
            first = stop


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best, best_n`` for the words of ``word, n`` with a word one insertion, deletion or replacement apart.

    ``best`` is the near word of the largest ``n``, the smallest in code-point order
    among equals. Words are distinct; null and empty ones are near nothing.
    """
    tiles = _tiles(words.where("word <> ''").select("word", F.col("n").cast("long").alias("n")))
    sorted_tiles = tiles.repartition(*_TILE).sortWithinPartitions(*_TILE, F.desc("n"), "word")
    found = sorted_tiles.mapInArrow(_near_batches, "word string, n_near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", F.col("b.best").alias("best"), (-F.col("b.less")).alias("best_n"))


def variant_groups(words: DataFrame, ratio: int = 5) -> DataFrame:
    """Every word of ``word, n`` with its form and root.

    Adds ``form``: the near word of the largest count if that is at least ``ratio``
    (over 1) times the word's, else null; ``root``: the last word when forms are
    followed; ``n_near`` and ``form_n``. Counts rise along forms, so there is no
    cycle. An empty table gives an empty one. Words are distinct; other columns are
    left out.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    words = write_through(words.select("word", "n"), "words")
    formed = F.col("best_n") >= ratio * F.col("n")
    rows = write_through(words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")), "forms")
    links = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:  # each round doubles the steps that a link spans
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = write_through(links.join(on, "root", "left").select("word", "root", "next"), "roots")
        links = step.select("word", F.coalesce("next", "root").alias("root"))
        if step.where("next is not null").isEmpty():
            break
    out = rows.join(links, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
