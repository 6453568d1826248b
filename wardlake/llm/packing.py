"""Documents packed into sequences of a fixed length, in their order, by dynamic programming.

The token stream of a partition is cut into windows of at most ``limit`` tokens.
A cut may lie at the end of a document, of a sentence or of a word; a window
costs its padding plus a penalty for the place where it ends. With ``B`` the
places of the cuts,

    best[j] = penalty[j] + limit - B[j] + min(best[i] + B[i])  over B[j] - B[i] <= limit,

a minimum over a sliding range, which a monotone queue gives in constant time
for each cut. The stream is solved in blocks; the last window of a block is
left open and begins the next one, so memory is bounded and only the last window
of a partition stays short. There is no shuffle: a partition is a run of the
input, whatever its keys.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wardlake.llm.wordcache import UnitTable, give_back_memory, kept_in_worker, ragged

#: Tokens that one round of dynamic programming takes.
BLOCK_TOKENS = 1 << 20
#: Cut penalties in tokens of padding: at the end of a sentence, between words, inside a word.
SENTENCE, WORD, INSIDE = 2, 5, 20
#: Distinct units kept by a Python worker, and twice as many parts of them: about 300 MB. Fewer need less memory and more time.
MOST_UNITS = 600_000
#: Characters of texts cut into units at a time, and pieces and token ids of a batch of results.
BLOCK_CHARS = 1_000_000
BATCH_PIECES, BATCH_IDS = 20_000, 500_000
#: Without the end of a sentence, cuts lie about so many tokens apart.
GRID = 32

_MARKS = ".,;:!?*&%$#@)]}"
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")


class WordTokenizer:
    """Token ids of the units of a text by the ``tokenizers`` library; units have no space or line break.

    The tokenizer lower-cases, drops white space and keeps words and punctuation
    apart, so the ids of a unit do not depend on its neighbours, and those of a
    plain word with punctuation behind it are those of both parts.
    """

    def __init__(self, model: str, most_units: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.parts = UnitTable(self._encode, most=2 * most_units)
        self.table = UnitTable(self._by_parts, lambda u: u == "\n" or u[-1:] in ".!?", most_units)

    def _encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Parts of letters are encoded in one text, where each is a word of its own; the others one by one."""
        lengths, ids = np.zeros(len(parts), np.int64), [np.zeros(0, np.uint32)]
        plain = np.fromiter((p.isalpha() and (p.isascii() or _LETTERS.fullmatch(p) is not None) for p in parts), bool, len(parts))
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        words, others = [parts[k] for k in np.flatnonzero(plain)], [parts[k] for k in np.flatnonzero(~plain)]
        for at in range(0, len(words), 20_000):
            some = words[at:at + 20_000]
            e = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            count = np.bincount(np.array(e.word_ids, np.int64), minlength=len(some))
            if len(count) != len(some):
                raise ValueError("the tokenizer splits plain words")
            ids.append(np.array(e.ids, np.uint32))
            lengths[order[at:at + len(some)]] = count
        rest = [e.ids for e in self.tokenizer.encode_batch(others, add_special_tokens=False)]
        lengths[order[len(words):]] = [len(x) for x in rest]
        ids.append(np.fromiter(chain.from_iterable(rest), np.uint32))
        flat, sizes = np.concatenate(ids), lengths[order]
        begin = np.empty(len(parts), np.int64)
        begin[order] = np.cumsum(sizes) - sizes
        return flat[ragged(begin, lengths)], lengths

    def _by_parts(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat = []
        for u in units:
            word = u.rstrip(_MARKS)
            if word.isalpha() and (word.isascii() or _LETTERS.fullmatch(word)):
                flat += word.lower(), u[len(word):]
            else:
                flat += u, ""
        places = self.parts.look_up([flat])[0]
        return self.parts.ids_of(places), self.parts.lengths[places].reshape(-1, 2).sum(1)

    @staticmethod
    def units(text: str) -> list[str]:
        if "\0" in text:
            return re.findall(r"[^ \n]+|\n", text)
        return text.replace("\n", "\0\n\0").replace(" ", "\0").split("\0")


def cuts_of(lengths: np.ndarray, ends_sentence: np.ndarray, tail: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in a document of ``sum(lengths) + tail`` tokens where it may be cut, and their penalties.

    The last is the document's end, which costs nothing.
    """
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    sentence = np.unique(ends[ends_sentence & (ends > 0)])
    grid = ends // GRID
    word = ends[1:][grid[1:] != grid[:-1]] if len(ends) > 1 else ends[:0]
    word = word[word < total]
    raw = np.zeros(0, np.int64)
    long_units = np.flatnonzero(lengths > 4 * GRID)
    if len(long_units):
        raw = np.concatenate([np.arange(ends[u] - lengths[u] + GRID, ends[u], GRID) for u in long_units])
    at = np.concatenate([sentence, word, raw])
    cost = np.repeat([SENTENCE, WORD, INSIDE], [len(sentence), len(word), len(raw)])
    order = np.lexsort((cost, at))
    at, cost = at[order], cost[order]
    first = np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.zeros(0, bool)
    at, cost = at[first], cost[first]
    inside = at < total
    return np.append(at[inside], total + tail), np.append(cost[inside], 0)


def choose_cuts(places: list[int], penalties: list[int], limit: int) -> list[int]:
    """Numbers of the cuts of the cheapest windows, from the first place to the last.

    ``places`` rise from 0 in steps of at most ``limit``; ``penalties`` belong to them.
    """
    n = len(places)
    key, before = [0] * n, [0] * n
    queue: deque[int] = deque()
    for j in range(1, n):
        k = key[j - 1]
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j - 1)
        here = places[j]
        while here - places[queue[0]] > limit:
            queue.popleft()
        i = queue[0]
        before[j] = i
        key[j] = key[i] + limit + penalties[j]  # best[j] + B[j]
    out, j = [], n - 1
    while j > 0:
        out.append(j)
        j = before[j]
    return [0, *reversed(out)]


class _Doc:
    """What is left of a document: its ids from ``start`` on, and the cuts from there."""

    def __init__(self, key, ids: np.ndarray, at: np.ndarray, cost: np.ndarray):
        self.key, self.ids, self.at, self.cost, self.start = key, ids, at, cost, 0


class Packer:
    """Packs documents as they come; ``pieces`` collects (key, start, length, crc, doc tokens, sequence, offset, ids)."""

    def __init__(self, limit: int, first_sequence: int, with_ids: bool):
        self.limit, self.sequence, self.with_ids = limit, first_sequence, with_ids
        self.docs: list[_Doc] = []
        self.tokens = self.packed = 0
        self.pieces: list[tuple] = []

    def add(self, key, ids: np.ndarray, at: np.ndarray, cost: np.ndarray) -> None:
        self.docs.append(_Doc(key, ids, at, cost))
        self.tokens += len(ids)
        if self.tokens >= BLOCK_TOKENS:
            self.pack(last=False)

    def pack(self, last: bool) -> None:
        if not self.docs:
            return
        sizes = [len(d.ids) - d.start for d in self.docs]
        ends = np.cumsum(sizes)
        at = np.concatenate([[0]] + [d.at - d.start + e - n for d, e, n in zip(self.docs, ends, sizes)])
        cost = np.concatenate([[0]] + [d.cost for d in self.docs])
        chosen = choose_cuts(at.tolist(), cost.tolist(), self.limit)
        places = at[chosen].tolist()
        if not last:
            places.pop()
        doc, used = 0, 0  # the document that goes on, and the tokens before it
        for a, b in zip(places, places[1:]):
            offset = 0
            while offset < b - a:
                d, n = self.docs[doc], sizes[doc]
                skip = a + offset - used
                take = min(n - skip, b - a - offset)
                self._piece(d, d.start + skip, take, offset)
                offset += take
                if skip + take == n:
                    used += n
                    doc += 1
            self.sequence += 1
        skip = places[-1] - used
        self.docs = self.docs[doc:]
        if skip:
            d = self.docs[0]
            d.start += skip
            on = d.at > d.start
            d.at, d.cost = d.at[on], d.cost[on]
        self.tokens = sum(len(d.ids) - d.start for d in self.docs)

    def _piece(self, d: _Doc, start: int, length: int, offset: int) -> None:
        ids = np.ascontiguousarray(d.ids[start:start + length], "<u4")
        self.packed += length
        self.pieces.append((d.key, start, length, zlib.crc32(ids), len(d.ids), self.sequence, offset,
                            ids if self.with_ids else None))


def pack_batches(batches: Iterator[pa.RecordBatch], model: str, model_name: str, limit: int, end_id: int, key_type: pa.DataType,
                 with_ids: bool, most_units: int, keep_words: bool = True) -> Iterator[pa.RecordBatch]:
    def build() -> WordTokenizer:
        return WordTokenizer(model, most_units)

    words = kept_in_worker(("words", model_name, hash(model), most_units), build) if keep_words else build()
    packer = Packer(limit, TaskContext.get().partitionId() << 32, with_ids)
    for batch in batches:
        keys, texts, first = batch.column(0), batch.column(1), 0
        while first < len(texts):
            end, units, size = first, [], 0
            while end < len(texts) and (size < BLOCK_CHARS or end == first):
                text = texts[end].as_py() or ""
                units.append(words.units(text))
                size += len(text)
                end += 1
            found = words.table.look_up(units)
            del units
            for k, places in zip(range(first, end), found):
                ids = np.append(words.table.ids_of(places), np.uint32(end_id))
                packer.add(keys[k].as_py(), ids, *cuts_of(words.table.lengths[places], words.table.flags[places], 1))
                if len(packer.pieces) >= BATCH_PIECES or packer.with_ids and packer.packed >= BATCH_IDS:
                    yield from _tables(packer, key_type)
            del found
            first = end
    packer.pack(last=True)
    yield from _tables(packer, key_type)
    del packer, words
    give_back_memory()


def _tables(packer: Packer, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The pieces so far, in batches of about ``BATCH_IDS`` ids if these are asked for."""
    pieces, packer.pieces, packer.packed = packer.pieces, [], 0
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    first = 0
    while first < len(pieces):
        end, size = first, 0
        while end < len(pieces) and end - first < BATCH_PIECES and (not packer.with_ids or size < BATCH_IDS):
            size += pieces[end][2]
            end += 1
        columns = list(zip(*pieces[first:end]))
        arrays = [pa.array(columns[0], key_type)] + [pa.array(c, pa.int64()) for c in columns[1:7]]
        if packer.with_ids:
            offsets = np.zeros(end - first + 1, np.int32)
            np.cumsum(columns[2], out=offsets[1:])
            flat = np.concatenate(columns[7]).view(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
        yield pa.RecordBatch.from_arrays(arrays, names + ["ids"] * packer.with_ids)
        pieces[first:end] = [None] * (end - first)
        first = end


def pack(docs: DataFrame, model_path: str, limit: int = 2048, end_id: int = 1, key: str = "doc_id", text: str = "text",
         with_ids: bool = False, most_units: int = MOST_UNITS, keep_words: bool = True) -> DataFrame:
    """One row per piece of a document: its place in the document and in its sequence.

    ``doc_id`` (the key), ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``, and the piece's ``ids`` if asked for. A null text
    is empty and has the end id only. Repeated rows are packed as often as they
    occur. Other columns of ``docs`` are left out. ``most_units`` bounds the table of
    encoded words in each Python worker; ``keep_words`` keeps it there for later tasks.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    with open(model_path, encoding="utf-8") as f:
        model = f.read()
    rows = docs.select(F.col(key), F.col(text))
    kind = rows.schema[0].dataType
    key_type = to_arrow_type(kind)
    schema = f"doc_id {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema += ", ids array<int>" if with_ids else ""
    name = os.path.basename(model_path)
    return rows.mapInArrow(lambda b: pack_batches(b, model, name, limit, end_id, key_type, with_ids, most_units, keep_words), schema)
