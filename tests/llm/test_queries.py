"""The registered queries at the smallest scale: against SQL, or against brute force."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest

from tests.llm import odd
from tests.oracle import compare, duck
from wardlake.llm import QUERIES


@pytest.fixture(scope="module")
def con(base):
    return duck(base)


@pytest.fixture(scope="module")
def docs(con):
    return {k: (t, lang) for k, t, lang in con.execute("SELECT doc_id, text, lang FROM documents").fetchall()}


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_matches_sql(spark, con, base, name):
    ok, note = compare(spark, con, base, QUERIES[name].run, QUERIES[name].sql)
    assert ok, note


def run(spark, base, name):
    return [r.asDict() for r in QUERIES[name].run(spark, base).collect()]


def test_near_duplicates(spark, base, docs):
    want = odd.components({k: t for k, (t, _) in docs.items()})
    got = run(spark, base, "op1_tensored_minhash")
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["n_shingles"] == len(odd.shingles(docs[r["doc_id"]][0])) and r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len(set(want.values())) < len(want)


def test_packing(spark, base, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {k: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for k, (t, _) in docs.items()}
    pieces, sequences = {}, {}
    for r in run(spark, base, "op4_ordered_windows"):
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(part) == r["ids_crc32"] and len(ids[r["doc_id"]]) == r["doc_tokens"]
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    gapless = lambda spans: sum(n for _, n in spans) if all(
        a + n == b for (a, n), (b, _) in zip(sorted(spans), sorted(spans)[1:])) and min(spans)[0] == 0 else None
    assert {k: gapless(v) for k, v in pieces.items()} == {k: len(v) for k, v in ids.items()}
    filled = [gapless(v) for v in sequences.values()]
    assert max(filled) <= 2048 and sum(2048 - n for n in filled) < 0.02 * sum(filled) + 2048


def test_fingerprints(spark, base, docs):
    got = {r["doc_id"]: r for r in run(spark, base, "op5_one_permutation_minhash")}
    order = sorted(docs, reverse=True)
    error = []
    for k, following in zip(order, order[1:] + order[:1]):
        text, other, r = docs[k][0] or "", docs[following][0] or "", got[k]
        cut = len(text) // 3
        changed = text[:len(text) - cut] + other[:cut]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        for value, with_ in ((r["near_edited"], changed), (r["near_next"], other)):
            a, b = odd.shingles(text), odd.shingles(with_)
            error.append(value - (len(a & b) / len(a | b) if a | b else 1.0))
    assert np.sqrt(np.mean(np.square(error))) < 0.05 and abs(np.mean(error)) < 0.01
    same = {}
    assert all(same.setdefault(docs[k][0], r["fingerprint"]) == r["fingerprint"] for k, r in got.items())


def test_language(spark, base, docs):
    got = run(spark, base, "op6_naive_bayes")
    assert {r["doc_id"] for r in got} == set(docs)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert np.mean([docs[r["doc_id"]][1] == r["lang_pred"] for r in held]) > 0.97


def test_shards(spark, base, docs):
    got = run(spark, base, "op8_histogram_sort")
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    shards = {}
    for r in got:
        raw = (docs[r["doc_id"]][0] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        shards.setdefault(r["shard"], []).append((r["slot"], r["size"]))
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in shards.values()) and set(shards) <= set(range(40))
    largest = max(r["size"] for r in got)
    total = sum(r["size"] for r in got)
    assert all(abs(sum(n for _, n in v) - total / 40) <= largest for v in shards.values())


def test_piece_bpe(spark, base, docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in run(spark, base, "op10_piece_bpe"):
        ids = library.encode(docs[r["doc_id"]][0] or "", add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_quality(spark, con, base):
    labels = {k: (q, t) for k, q, t in con.execute("SELECT doc_id, quality, toxic FROM labels").fetchall()}
    kept = {r["doc_id"]: r["kept"] for r in run(spark, base, "op2_ordinal_quality")}
    clean = [kept[k] for k, v in labels.items() if v == (1, 0)]
    junk = [kept[k] for k, v in labels.items() if v[0] == 0]
    assert np.mean(clean) > 0.95 and np.mean(junk) < 0.5


def test_surrogates(spark, base, docs):
    import re

    private = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]+\w|\+\d \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b\d{1,3}(?:\.\d{1,3}){3}\b|\b[0-9a-f]{40}\b")
    originals = {m for t, _ in docs.values() for m in private.findall(t or "")}
    got = run(spark, base, "op3_surrogates")
    assert originals and len(got) == len(docs)
    for r in got:
        text = docs[r["doc_id"]][0]
        found = private.findall(text or "")
        assert (r["text"] == text) if not found and not r["n_replaced"] else r["n_replaced"] >= len(found)
        assert not originals & set(private.findall(r["text"] or ""))
        assert len(private.findall(r["text"] or "")) == len(found)
