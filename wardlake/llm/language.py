"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes one space, and each run of
one to three characters is hashed into ``dims`` columns. Learning counts them by
language over all labelled rows, in one pass: a task adds up its own counts and
sends them once. The log-probability matrix, languages times columns, goes to
the tasks, which multiply it by the sparse counts of a block of texts at a time.
Its size is checked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardlake.llm.wordcache import kept_in_worker

DIMS = 1 << 15
#: Bytes that the log-probability matrix may take; beyond, fit with fewer dims.
MOST_BYTES = 256 << 20
#: Texts are scored together until they have so many n-grams, or are so many.
BLOCK_GRAMS, BLOCK_TEXTS = 1 << 17, 1 << 12
UNDETERMINED = "und"
SPACE = 32

_A, _B, _C = (np.uint32(x) for x in (2654435761, 2246822519, 3266489917))


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_prior: np.ndarray
    #: dims × languages
    log_prob: np.ndarray

    @property
    def dims(self) -> int:
        return len(self.log_prob)


def letters() -> np.ndarray:
    """Which code points are letters."""
    return kept_in_worker("letters", lambda: np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))


def n_grams(text: str, dims: int) -> np.ndarray | None:
    """Hashed columns of all n-grams of a text; None if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    alpha = letters()[points]
    if not alpha.any():
        return None
    before = np.concatenate([[True], alpha[:-1]])
    kept = alpha | before  # the first of a run of other characters stays, as a space
    p = np.where(alpha, points, np.uint32(SPACE))[kept]
    p = np.concatenate([[np.uint32(SPACE)], p, [np.uint32(SPACE)]]).astype(np.uint32)
    shift = np.uint32(32 - (dims.bit_length() - 1))
    with np.errstate(over="ignore"):
        one = p * _A
        two = one[:-1] * _B + p[1:] * _C
        three = two[:-1] * _B + p[2:] * _C
        scrambled = [((x ^ (x >> np.uint32(15))) * _A) >> shift for x in (one, two, three)]
    return np.concatenate(scrambled)


def count_batches(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """This task's n-gram counts by language, and its documents under dim -1."""
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1)):
            grams = n_grams(text.as_py(), dims)
            if grams is not None:
                lang = lang.as_py()
                if lang not in counts:
                    counts[lang] = np.zeros(dims, np.int64)
                counts[lang] += np.bincount(grams, minlength=dims)
                docs[lang] = docs.get(lang, 0) + 1
    for lang, c in counts.items():
        at = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(at) + 1)), pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(c[at], docs[lang]), pa.int64())],
            ["lang", "dim", "n"])


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", dims: int = DIMS, smoothing: float = 0.1) -> LanguageModel:
    """Learn from all rows with a text and a language. Rows without a letter count for nothing."""
    rows = docs.select(F.col(text), F.col(lang).cast("string")).where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counts = rows.mapInArrow(lambda b: count_batches(b, dims), "lang string, dim int, n long").groupBy("lang", "dim").agg(
        F.sum("n").alias("n"))
    by_lang = counts.groupBy("lang").agg(F.collect_list(F.struct("dim", "n")).alias("c"))  # at most dims + 1 entries each
    languages, columns, priors = [], [], []
    for r in by_lang.orderBy("lang").toLocalIterator():
        languages.append(r["lang"])
        column = np.zeros(dims)
        for dim, n in r["c"]:
            if dim < 0:
                priors.append(n)
            else:
                column[dim] = n
        columns.append(np.log((column + smoothing) / (column.sum() + smoothing * dims)).astype(np.float32))
        if len(columns) * dims * 4 > MOST_BYTES:
            raise ValueError(f"more than {MOST_BYTES} bytes of log-probabilities; use fewer dims")
    prior = np.log(np.array(priors, float) / max(1, sum(priors))) if priors else np.zeros(0)
    return LanguageModel(tuple(languages), prior, np.stack(columns, 1) if columns else np.zeros((dims, 0), np.float32))


def sparse_counts(grams: list[np.ndarray], dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' n-grams as a sparse matrix: start of each row, columns, and counts."""
    sizes = np.array([len(g) for g in grams], np.int64)
    codes = np.repeat(np.arange(len(grams), dtype=np.uint32) * np.uint32(dims), sizes) + np.concatenate(grams)
    codes.sort()
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    counts = np.diff(np.append(first, len(codes)))
    codes = codes[first]
    starts = np.searchsorted(codes, np.arange(len(grams), dtype=np.uint32) * np.uint32(dims))
    return starts, codes % np.uint32(dims), counts


def posteriors(grams: list[np.ndarray], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """The number of the likeliest language of each text, and its posterior probability.

    Every text has an n-gram. The product of counts and log-probabilities is added
    up row by row, so a text's result does not depend on the others of its batch.
    """
    starts, columns, counts = sparse_counts(grams, model.dims)
    logs = np.add.reduceat(model.log_prob[columns] * counts[:, None].astype(np.float64), starts, axis=0) + model.log_prior
    best = logs.argmax(axis=1)
    return best, 1.0 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)


def score_texts(texts: pa.Array, model: LanguageModel) -> tuple[list[str], list[float]]:
    """Languages and posterior probabilities, in blocks of texts with a bounded number of n-grams."""
    names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    block: list[np.ndarray] = []
    at: list[int] = []
    held, most_texts = 0, min(BLOCK_TEXTS, (1 << 32) // model.dims)

    def settle() -> None:
        for k, best, p in zip(at, *posteriors(block, model)):
            names[k], scores[k] = model.languages[best], float(p)
        block.clear()
        at.clear()

    for k, text in enumerate(texts):
        text = text.as_py()
        grams = n_grams(text, model.dims) if text and model.languages else None
        if grams is None:
            continue
        block.append(grams)
        at.append(k)
        held += len(grams)
        if held >= BLOCK_GRAMS or len(block) >= most_texts:
            settle()
            held = 0
    if block:
        settle()
    return names, scores


def score(text: str | None, model: LanguageModel) -> tuple[str, float]:
    """The likeliest language of one text and its posterior probability."""
    names, scores = score_texts(pa.array([text], pa.string()), model)
    return names[0], scores[0]


def predict_batches(batches: Iterator[pa.RecordBatch], model: LanguageModel, text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [n for n in batch.schema.names if n != text]
        names, scores = score_texts(batch.column(text), model)
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in kept] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
            kept + ["lang_pred", "score"])


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` and with ``lang_pred`` and ``score``.

    ``und`` and 0 for a text that is null, has no letter, or meets an empty
    model. Columns of ``docs`` with these names give way. No shuffle.
    """
    kept = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text))
    fields = [f"`{x.name}` {x.dataType.simpleString()}" for x in rows.schema if x.name != text]
    return rows.mapInArrow(lambda b: predict_batches(b, model, text), ", ".join(fields + ["lang_pred string", "score double"]))


def held_out(doc_id: Column) -> Column:
    """Rows that learning must not see: crc32 of the id as text has remainder 2 by 4. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
