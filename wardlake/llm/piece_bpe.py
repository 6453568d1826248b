"""SentencePiece BPE by vectorised merge rounds, and its decoding.

Runs inside tasks, on numpy arrays that hold the symbols of many words at once.
A round finds for each word the least rank among its neighbouring pairs, merges
the leftmost such pair of every word together, and closes the gaps; rounds go on
until no word has a pair left. Where it cannot change the result, all places of
a word's least pair are merged in one round: see ``_together``.

A text becomes words first: a piece never has the space mark after another
character, and characters that occur in no longer piece never merge, so the
encoding of a word does not depend on its neighbours.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardlake.llm.wordcache import UnitTable, kept_in_worker, ragged

SPACE = "▁"
NO_RANK = np.int64(1 << 40)
#: Words encoded together have about so many characters.
ROUND_CHARS = 1 << 20


class PieceModel:
    """The tables of a SentencePiece BPE model, from its file's bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        control = [sp.is_control(i) or sp.is_unknown(i) for i in range(n)]
        self.bos, self.eos, self.unknown = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self.byte_ids = np.full(256, self.unknown, np.int64)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_ids[int(names[i][3:5], 16)] = i
        piece_ids = {names[i]: i for i in range(n) if not control[i] and not sp.is_byte(i)}
        scores = {p: sp.get_score(i) for p, i in piece_ids.items()}
        if any(SPACE in p.lstrip(SPACE) for p in piece_ids):
            raise ValueError("a piece has the space mark inside; words are not independent")
        levels = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.together = _together(piece_ids, scores)
        self._tables(piece_ids, scores, levels)
        self.line_id = [int(self.byte_ids[10])] if "\n" not in piece_ids else [piece_ids["\n"]]
        self.split_lines = not any("\n" in p and len(p) > 1 for p in piece_ids)
        self.run = max((len(p) for p in piece_ids if not p.strip(SPACE)), default=1)
        self.run_id = piece_ids.get(SPACE * self.run, self.unknown)
        self.runs_repeat = False
        self.runs_repeat = all(self._leads_with_run(3 * self.run + k) for k in range(self.run))
        # decoding: the bytes of each id
        shown = [b"" if control[i] and i != self.unknown else sp.decode([self.unknown]).encode() if i == self.unknown
                 else bytes([int(names[i][3:5], 16)]) if sp.is_byte(i) else names[i].replace(SPACE, " ").encode() for i in range(n)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_lengths = np.array([len(x) for x in shown])
        self.shown_starts = np.cumsum(self.shown_lengths) - self.shown_lengths
        self.is_control = np.array([control[i] and i != self.unknown for i in range(n)])
        self.is_byte = np.array([sp.is_byte(i) for i in range(n)])

    def _tables(self, ids: dict[str, int], scores: dict[str, float], levels: dict[float, int]) -> None:
        """Symbols are piece ids, characters outside the pieces ids above them; a sorted table has every pair that makes a piece."""
        self.ids = ids
        self.first_free = max(ids.values()) + 1
        keys, merged, ranks = [], [], []
        for p, i in ids.items():
            for k in range(1, len(p)):
                if p[:k] in ids and p[k:] in ids:
                    keys.append(ids[p[:k]] << 32 | ids[p[k:]])
                    merged.append(i)
                    ranks.append(levels[scores[p]])
        order = np.argsort(keys)
        self.pair_keys = np.array(keys, np.int64)[order]
        self.pair_merged = np.array(merged, np.int64)[order]
        self.pair_ranks = np.array(ranks, np.int64)[order]
        self.merges_together = np.zeros(max(ids.values()) + 1, bool)
        for p in self.together:
            self.merges_together[ids[p]] = True

    def _leads_with_run(self, n: int) -> bool:
        """Whether ``n`` space marks are the longest run and then what ``n`` less that run are."""
        ids, counts = self._encode([SPACE * n, SPACE * (n - self.run)])
        return ids[:counts[0]].tolist() == [self.run_id, *ids[counts[0]:]]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; ``NO_RANK`` where it makes no piece."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == key
        return np.where(hit, self.pair_ranks[at], NO_RANK), self.pair_merged[at]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the words, and how many each has."""
        ids, counts, first, chars = [], [], 0, 0
        for k, w in enumerate(words):
            chars += len(w)
            if chars >= ROUND_CHARS or k == len(words) - 1:
                i, c = self._encode(words[first:k + 1])
                ids.append(i)
                counts.append(c)
                first, chars = k + 1, 0
        none = np.zeros(0, np.int64)
        return np.concatenate(ids or [none]), np.concatenate(counts or [none])

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lead = np.zeros(len(words), np.int64)
        if self.runs_repeat:  # of a long run of spaces the rounds get the last ones only
            for k, w in enumerate(words):
                if len(w) > 3 * self.run and w.startswith(SPACE * (3 * self.run)):
                    n = len(w) - len(w.lstrip(SPACE))
                    lead[k] = n // self.run - 2
            words = [w[int(n) * self.run:] if n else w for w, n in zip(words, lead)] if lead.any() else words
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = "".join(words)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        distinct, where = np.unique(points, return_inverse=True)
        symbols = np.array([self.ids.get(chr(c), self.first_free + c) for c in distinct], np.int64)[where] if len(points) else points
        word = np.repeat(np.arange(len(words)), lengths)
        ranks, merged = self._pairs(symbols, word)
        done_symbols, done_word = [], []
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.append(first, len(symbols)))
            least = np.repeat(np.minimum.reduceat(ranks, first), sizes)
            done = least == NO_RANK
            if done.any():  # words without a pair leave
                done_symbols.append(symbols[done])
                done_word.append(word[done])
                symbols, word, ranks, merged, least = (x[~done] for x in (symbols, word, ranks, merged, least))
            if len(symbols):
                symbols, word, ranks, merged = self._round(symbols, word, ranks, merged, least)
        none = np.zeros(0, np.int64)
        symbols, word = np.concatenate(done_symbols or [none]), np.concatenate(done_word or [none])
        order = np.argsort(word, kind="stable")
        return self._to_ids(symbols[order], word[order], len(words), lead)

    def _pairs(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each symbol with the one after it in its word."""
        ranks, merged = np.full(len(symbols), NO_RANK), np.zeros(len(symbols), np.int64)
        if len(symbols) > 1:
            ranks[:-1], merged[:-1] = self.look_up(symbols[:-1], symbols[1:])
            ranks[:-1][word[:-1] != word[1:]] = NO_RANK
        return ranks, merged

    def _round(self, symbols: np.ndarray, word: np.ndarray, ranks: np.ndarray, merged: np.ndarray,
               least: np.ndarray) -> tuple[np.ndarray, ...]:
        """One merge in every word, at its leftmost pair of least rank, and compaction.

        Only the pairs on both sides of a merge are looked up anew.
        """
        best = np.flatnonzero(ranks == least)
        lead = np.concatenate([[True], word[best][1:] != word[best][:-1]])
        best = best[lead | self.merges_together[merged[best]]]
        if len(best) > 1:  # of overlapping places, as in aaa, every second one from the left
            chain = np.concatenate([[True], np.diff(best) > 1])
            begin = np.maximum.accumulate(np.where(chain, np.arange(len(best)), 0))
            best = best[(np.arange(len(best)) - begin) % 2 == 0]
        symbols[best] = merged[best]
        stay = np.ones(len(symbols), bool)
        stay[best + 1] = False
        symbols, word, ranks, merged = symbols[stay], word[stay], ranks[stay], merged[stay]
        at = best - np.arange(len(best))  # where the merged symbols are now
        for k in (at - 1, at):
            k = k[(k >= 0) & (k < len(symbols) - 1)]
            ranks[k], merged[k] = self.look_up(symbols[k], symbols[k + 1])
            ranks[k[word[k] != word[k + 1]]] = NO_RANK
        last = at[at == len(symbols) - 1]
        ranks[last] = NO_RANK
        return symbols, word, ranks, merged

    def _to_ids(self, symbols: np.ndarray, word: np.ndarray, n: int, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        strange = symbols >= self.first_free
        lengths = np.ones(len(symbols), np.int64)
        if strange.any():
            raw = [chr(c - self.first_free).encode("utf-8", "replace") for c in symbols[strange]]
            lengths[strange] = [len(x) for x in raw]
        out = np.repeat(symbols, lengths)
        if strange.any():
            out[np.repeat(strange, lengths)] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        counts = np.bincount(np.repeat(word, lengths), minlength=n).astype(np.int64)
        if lead.any():
            at = np.repeat(np.cumsum(counts) - counts, lead)
            out = np.insert(out, at, self.run_id)
            counts = counts + lead
        return out, counts

    def units(self, text: str) -> list[str]:
        """The words of a text, each with the space marks before it; a line break is a unit of its own."""
        marked = SPACE + text.replace(" ", SPACE) if text else ""
        if SPACE + SPACE not in marked and "\0" not in marked and self.split_lines:
            return marked.replace(SPACE, "\0" + SPACE).replace("\n", "\0\n\0").split("\0")
        pattern = rf"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n" if self.split_lines else rf"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"
        return re.findall(pattern, marked)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, space marks to spaces, the one put in front taken off, bytes as UTF-8."""
        ids = ids[~self.is_control[ids]]
        if not len(ids):
            return ""
        data = self.shown[ragged(self.shown_starts[ids], self.shown_lengths[ids])].tobytes()
        if not self.is_byte[ids[0]] and data[:1] == b" ":
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:  # each byte that begins no character becomes one mark
            return "".join(_lenient(data))


def _lenient(data: bytes) -> Iterator[str]:
    at = 0
    while at < len(data):
        for n in (1, 2, 3, 4):
            try:
                yield data[at:at + n].decode()
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            yield "�"
            at += 1


def _together(ids: dict[str, int], scores: dict[str, float]) -> set[str]:
    """Pieces whose places in a word may be merged in one round.

    One at a time, the leftmost merge of x makes new pairs. These could take a
    neighbour that the next place of x needs only if a better piece ends in x
    and a beginning of x; and a piece with the score of another may have to wait
    for it. All other pieces give the same result either way.
    """
    count: dict[float, int] = {}
    for s in scores.values():
        count[s] = count.get(s, 0) + 1
    safe = {p for p in ids if len(p) > 1 and count[scores[p]] == 1}
    for p in ids:
        n = len(p)
        for a in range(n):
            for b in range(a + 2, n):
                x = p[a:b]
                if x in scores and x.startswith(p[b:]) and scores[p] > scores[x]:
                    safe.discard(x)
    return safe


def _digest(values: np.ndarray) -> str:
    return hashlib.sha256(np.ascontiguousarray(values, "<u4")).hexdigest()


def encode_batches(batches: Iterator[pa.RecordBatch], model: bytes, text: str, out: list[str]) -> Iterator[pa.RecordBatch]:
    """The batches with token ids, their decoded text, and digests, as ``out`` asks."""
    m, table = kept_in_worker(("pieces", hash(model)), lambda: (p := PieceModel(model), UnitTable(p.encode_words)))
    for batch in batches:
        texts = batch.column(text)
        rest = [batch.column(i) for i in range(batch.num_columns) if batch.schema.field(i).name != text]
        names = [n for n in batch.schema.names if n != text]
        first = 0
        while first < len(texts):
            end, units, size = first, [], 0
            while end < len(texts) and (size < 4_000_000 or end == first):
                value = texts[end].as_py() or ""
                units.append(m.units(value))
                size += len(value)
                end += 1
            found: dict[str, list] = {k: [] for k in ("ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256")}
            for places in table.look_up(units):
                ids = np.concatenate([[m.bos], table.ids_of(places), [m.eos]]).astype(np.int64)
                found["n_tokens"].append(len(ids))
                if "ids" in out:
                    found["ids"].append(ids.astype(np.int32))
                if "ids_sha256" in out:
                    found["ids_sha256"].append(_digest(ids))
                if "decoded" in out or "decoded_sha256" in out:
                    decoded = m.decode(ids)
                    if "decoded" in out:
                        found["decoded"].append(decoded)
                    found["decoded_sha256"].append(hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest())
            kinds = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded": pa.string(),
                     "decoded_sha256": pa.string()}
            yield pa.RecordBatch.from_arrays(
                [c.slice(first, end - first) for c in rest] + [pa.array(found[k], kinds[k]) for k in out], names + out)
            first = end


KINDS = {"ids": "array<int>", "n_tokens": "long", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def encode(docs: DataFrame, model_path: str, text: str = "text", out: tuple[str, ...] = ("ids", "n_tokens")) -> DataFrame:
    """``docs`` without ``text`` and with the columns ``out``, with begin and end ids.

    ``ids``, ``n_tokens``, ``decoded`` (the text that the ids give back),
    ``ids_sha256`` and ``decoded_sha256``. A column of ``docs`` with one of these
    names gives way. Null counts as empty: begin and end only. No shuffle; rows
    stay in their partition, and memory is bounded by the longest text.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    wanted = list(out)
    kept = [c for c in docs.columns if c != text and c not in wanted]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text))
    fields = [f"`{x.name}` {x.dataType.simpleString()}" for x in rows.schema if x.name != text]
    schema = ", ".join(fields + [f"{k} {KINDS[k]}" for k in wanted])
    return rows.mapInArrow(lambda batches: encode_batches(batches, model, text, wanted), schema)
