"""Quality by ordinal regression on graded ratings (cumulative logit with shared weights).

A text has a set of hashed features; one weight vector ``w`` serves all grades,
and ordered thresholds tell them apart:

    P(grade <= k) = sigmoid(threshold[k] - w · x).

So a text gets an expected grade and the probability of each tail, P(grade >= k),
by which documents are selected. Features are the distinct words and word
beginnings, how dense each punctuation mark is, and the shares of capitals and of
repeated words. Fitting uses a bounded, evenly spread sample of the labelled
rows (``MAX_ROWS``); scoring covers all rows, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardlake.llm import wordhash
from wardlake.llm.wordcache import give_back_memory

DIMS_BITS = 20
DIMS = 1 << DIMS_BITS
#: Labelled rows that fitting takes at most, shared out evenly over the grades.
MAX_ROWS = 9_000
#: Word beginnings of so many bytes are features.
PREFIXES = (4, 5, 6)

_GAPS = np.ones(256, bool)
_GAPS[128:] = False
for _c in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789":
    _GAPS[_c] = False
_PUNCTUATION = np.array([c for c in range(33, 127) if _GAPS[c]])


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    #: Ascending, one less than there are grades.
    thresholds: np.ndarray

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """P(grade = k), a row per score."""
        with np.errstate(over="ignore"):
            below = 1.0 / (1.0 + np.exp(np.clip(scores[:, None] - self.thresholds[None, :], -500, 500)))
        edges = np.concatenate([np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))], 1)
        return np.diff(edges, axis=1)


def features(texts: pa.Array, wanted: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``first, columns, sizes, wordy`` for runs of texts: the distinct feature columns of each, and whether it has words.

    A text without words has no features. ``wanted`` marks the columns that matter;
    others are left out before anything is sorted.
    """
    mark = np.uint64(DIMS - 1)
    for first, _, data, starts in wordhash.text_blocks(texts):
        words, counts, *begins = wordhash.word_hashes(data, starts, _GAPS, PREFIXES)
        n = len(counts)
        doc = np.repeat(np.arange(n), counts)
        with np.errstate(over="ignore"):
            kinds = [words] + [wordhash.mix(b + np.uint64(k)) for k, b in zip(PREFIXES, begins)]
            owner_of, cells = doc.astype(np.uint64) << np.uint64(DIMS_BITS), []
            for h in kinds:
                column = h & mark
                if wanted is None:
                    cells.append(owner_of | column)
                else:
                    matter = wanted[column.astype(np.int64)]
                    cells.append(owner_of[matter] | column[matter])
            owner = np.repeat(np.arange(n), np.diff(starts))
            marks = np.bincount(owner * 256 + data, minlength=n * 256).reshape(n, 256) if len(data) else np.zeros((n, 256), np.int64)
            many = np.maximum(counts, 1)[:, None]
            dense = np.ceil(np.log2(1 + 100 * marks[:, _PUNCTUATION] / many)).astype(np.int64)
            capitals = np.ceil(10 * marks[:, 65:91].sum(1) / np.maximum(1, marks[:, 65:91].sum(1) + marks[:, 97:123].sum(1))).astype(np.int64)
            distinct = np.bincount((np.unique(doc.astype(np.uint64) << np.uint64(32) | words >> np.uint64(32)) >> np.uint64(32)).astype(np.int64), minlength=n)
            variety = np.floor(10 * distinct / np.maximum(counts, 1)).astype(np.int64)
            shape_doc, shape_col = np.nonzero(dense > 2)
            shapes = [(shape_doc, _PUNCTUATION[shape_col] * 1000 + dense[shape_doc, shape_col]),
                      (np.arange(n), 1_000_000 + capitals), (np.arange(n), 2_000_000 + variety)]
            extra = [d.astype(np.uint64) << np.uint64(DIMS_BITS) | wordhash.mix(v.astype(np.uint64) + np.uint64(1 << 40)) & mark for d, v in shapes]
        cells = np.unique(np.concatenate([*cells, *extra]))
        owner = (cells >> np.uint64(DIMS_BITS)).astype(np.int64)
        kept = counts[owner] > 0
        yield first, (cells[kept] & mark).astype(np.int64), np.bincount(owner[kept], minlength=n), counts > 0


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, columns, sizes, _ in features(batch.column(1)):
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(sizes)), pa.ListArray.from_arrays(pa.array(ends), pa.array(columns.astype(np.int32)))],
                ["grade", "columns"])


#: Features enter the model if their chi-square against some split of the grades is this large, or a fifth of the rows where these are few.
LEAST_CHI_SQUARE = 30.0
#: A feature may lower the grade far and raise it little, so that much harmless text cannot outweigh a defect.
MOST_RAISE = 0.05


def telling_columns(rows: list[np.ndarray], grades: np.ndarray, n_grades: int) -> np.ndarray:
    """Columns whose presence depends on the grade, by the chi-square of each cumulative split."""
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate(rows)
    n, have = len(rows), np.bincount(flat, minlength=DIMS)
    most = np.zeros(DIMS)
    for k in range(1, n_grades):
        high = grades >= k
        share = high.mean()
        seen = np.bincount(flat, np.repeat(high, sizes).astype(float), DIMS)
        spread = have * share * (1 - share) * (1 - have / n) + 1e-9
        most = np.maximum(most, np.where(have >= 3, (np.abs(seen - have * share) - 0.5) ** 2 / spread, 0.0))
    return np.flatnonzero(most >= min(LEAST_CHI_SQUARE, n / 5))


def fit_rows(rows: list[np.ndarray], grades: np.ndarray, weight: np.ndarray, n_grades: int, epochs: int = 40, step: float = 0.3,
             shrink: float = 1e-4, seed: int = 1) -> OrdinalModel:
    """Stochastic gradient on the negative log likelihood, with a step per weight (AdaGrad)."""
    columns = telling_columns(rows, grades, n_grades)
    place = np.full(DIMS, -1)
    place[columns] = np.arange(len(columns))
    rows = [p[p >= 0] for p in (place[r] for r in rows)]
    dims = len(columns)
    w, g2 = np.zeros(dims), np.full(dims, 1e-6)
    share = np.bincount(grades, weights=weight, minlength=n_grades) + 0.5
    below = np.cumsum(share)[:-1] / share.sum()
    start = np.log(below / (1 - below))
    # thresholds rise: the first, and logs of the gaps
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    f2 = np.full(len(free), 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            pick = order[at:at + 64]
            sizes = np.array([len(rows[i]) for i in pick])
            col, doc = np.concatenate([rows[i] for i in pick]), np.repeat(np.arange(len(pick)), sizes)
            gaps = np.exp(free[1:])
            th = np.concatenate([free[:1], free[0] + np.cumsum(gaps)])
            score = np.bincount(doc, w[col], len(pick))
            y, k = grades[pick], weight[pick]
            lo = np.where(y > 0, 1 / (1 + np.exp(np.clip(score - th[np.maximum(y - 1, 0)], -60, 60))), 0.0)
            hi = np.where(y < n_grades - 1, 1 / (1 + np.exp(np.clip(score - th[np.minimum(y, n_grades - 2)], -60, 60))), 1.0)
            p = np.maximum(hi - lo, 1e-9)
            dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p
            slope = k * (dhi - dlo)  # d(-log p)/d score
            grad = np.bincount(col, slope[doc], dims)
            seen = np.unique(col)
            g = grad[seen] / len(pick) + shrink * w[seen]
            g2[seen] += g * g
            w[seen] = np.minimum(MOST_RAISE, w[seen] - step * g / np.sqrt(g2[seen]))
            dth = np.bincount(np.minimum(y, n_grades - 2), np.where(y < n_grades - 1, -k * dhi, 0), n_grades - 1) + np.bincount(
                np.maximum(y - 1, 0), np.where(y > 0, k * dlo, 0), n_grades - 1)
            dfree = np.concatenate([[dth.sum()], gaps * np.cumsum(dth[::-1])[::-1][1:]]) / len(pick)
            f2 += dfree * dfree
            free -= step * dfree / np.sqrt(f2)
    all_weights = np.zeros(DIMS, np.float32)
    all_weights[columns] = w
    return OrdinalModel(all_weights, np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))]))


def fit(docs: DataFrame, ratings: DataFrame, grade: Column, n_grades: int, key: str = "doc_id", text: str = "text",
        max_rows: int = MAX_ROWS) -> OrdinalModel | None:
    """Fit on at most ``max_rows`` rated documents, as many of each grade, weighted back to the grades' shares.

    The sample takes the rows whose key hashes lowest. An id that is rated more
    than once counts with its lowest grade; null ids, grades and texts count for
    nothing. None if fewer than two grades are left.
    """
    rated = ratings.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.min(grade.cast("int")).alias("grade"))
    share = {r["grade"]: r["count"] for r in rated.groupBy("grade").count().collect() if r["grade"] is not None}
    picked = None
    for g in range(n_grades):
        some = rated.where(F.col("grade") == g).orderBy(F.xxhash64("id"), "id").limit(max_rows // n_grades)
        picked = some if picked is None else picked.union(some)
    sample = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).where("text is not null").join(F.broadcast(picked), "id")
    found = sample.select("grade", "text").mapInArrow(_feature_batches, "grade int, columns array<int>").where("size(columns) > 0")
    table = found.toArrow()
    grades = np.array(table["grade"].to_pylist(), int)
    if len(np.unique(grades)) < 2:
        return None
    rows = [np.asarray(c.values) for c in table["columns"]]
    have = np.bincount(grades, minlength=n_grades)
    weight = np.array([share[g] for g in grades]) / have[grades]
    return fit_rows(rows, grades, weight / weight.mean(), n_grades)


def predict(docs: DataFrame, model: OrdinalModel | None, tail: int, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail_probability``, that is P(grade >= tail); ``prefix`` goes before both names.

    A text without words has grade 0 and no chance of the tail. Without a model
    (nothing was rated) every text has the best chance: nothing speaks against it.
    """
    from pyspark.sql import types as T

    names = [f"{prefix}expected_grade", f"{prefix}tail_probability"]
    rows = docs.drop(*names)
    schema = T.StructType([*rows.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if model is None else model.weights != 0
        for batch in batches:
            expected, chance = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            if model is None:
                expected[:], chance[:] = float(tail), 1.0
            else:
                for first, columns, sizes, wordy in features(batch.column(text), wanted):
                    owner = np.repeat(np.arange(len(sizes)), sizes)
                    p = model.probabilities(np.bincount(owner, model.weights[columns], len(sizes)))
                    expected[first:first + len(sizes)] = np.where(wordy, p @ np.arange(p.shape[1]), 0.0)
                    chance[first:first + len(sizes)] = np.where(wordy, p[:, tail:].sum(1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(expected), pa.array(chance)], [*batch.schema.names, *names])
        give_back_memory()

    return rows.mapInArrow(run, schema)


def grade_of_labels() -> Column:
    """0: low quality; 1: good but toxic; 2: good."""
    return F.when(F.col("quality") == 0, F.lit(0)).when(F.col("toxic") == 1, F.lit(1)).when(F.col("quality") == 1, F.lit(2))
