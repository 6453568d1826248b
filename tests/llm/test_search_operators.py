"""Spelling variants, chat formatting and hard negatives: against brute force, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import odd
from wardlake.llm import QUERIES, chat, hard_negatives, spelling


# Spelling variants

def counted(texts: list[tuple], least=6, drop=0) -> Counter:
    out: Counter = Counter()
    for key, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if drop and h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                out[run] += 1
    return out


def edits(w: str, letters: list[str]) -> set[str]:
    return ({w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
            | {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}) - {w}


def grouped(words: dict[str, int], ratio=5) -> dict[str, tuple]:
    letters = sorted(set("".join(words)))
    near = {w: [v for v in edits(w, letters) if v in words] for w in words}
    best = {w: min(v, key=lambda x: (-words[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if words[b] >= ratio * words[w]}
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None)
    return out


def as_dict(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_variants_query_against_brute_force(spark, base):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{base}/documents.parquet").collect()]
    words = {w: n for w, n in counted(docs, drop=199).items() if n >= 5}
    got = QUERIES["op11_spelling_variants"].run(spark, base)
    assert as_dict(got) == grouped(words) and got.count() == len(words)
    assert any(v[0] for v in grouped(words).values())


@pytest.mark.parametrize("tile", [None, 70])
def test_variants_of_random_words(spark, monkeypatch, tile):
    """Small alphabets, so that buckets are full; with small tiles, so that they are cut."""
    rnd = random.Random(tile)
    if tile:
        monkeypatch.setattr(spelling, "TILE_WORDS", tile)
        monkeypatch.setattr(spelling, "BLOCK_ROWS", 50)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randint(1, 9))): rnd.choice([1, 1, 2, 5, 25, 600]) for _ in range(900)}
    words |= {"x" * 5000: 5, "x" * 4999 + "y": 1, "x" * 5001: 30, "😀a\0": 1, "😀a": 9}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert as_dict(spelling.variant_groups(frame)) == grouped(words)


def test_variants_follow_chains_and_ties(spark):
    words = {"aaaaaaa": 1, "aaaaaab": 5, "aaaaabb": 25, "aaaabbb": 200, "aaabbbb": 2000, "zzzzzz": 4, "zzzzzy": 20, "zzzzzx": 20}
    got = as_dict(spelling.variant_groups(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got["aaaaaaa"] == ("aaaaaab", "aaabbbb", 1, 1, 5) and got["zzzzzz"][:2] == ("zzzzzx", "zzzzzx")
    assert got == grouped(words)
    with pytest.raises(ValueError):
        spelling.variant_groups(spark.createDataFrame([], "word string, n long"), ratio=1)


def test_words_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(spelling, "MOST_COUNTED", 7)
    rows = [(r[0], r[1]) for r in odd.rows()] + [(1, "ÀÉabcde ÀÉabcde× xÿÿÿÿÿÿ"), (None, "Repeated repeated")] * 3
    wanted = {w: n for w, n in counted(rows, least=5, drop=3).items() if n >= 2}
    clash = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, n int, word string")
    got = spelling.count_words(clash, least_length=5, least_count=2, drop_every=3)
    assert {r["word"]: r["n"] for r in got.collect()} == wanted
    assert spelling.count_words(odd.empty(spark)).count() == 0
    assert spelling.variant_groups(spelling.count_words(odd.empty(spark))).count() == 0


# Chat formatting

PARTS = ["[INST]", "[/INST]", " [/INST]", "[INST] ", "<s>", "</s>", "<<SYS>>", "\n<</SYS>>", "[ROLE x] ", " [/ROLE]", "[ROLE", "\\", "[", "<",
         "/", "a", " ", "\n", "é", "[\\INST]", "<\\\\/s>", "]", ">", "s>", "INST]", "\0", "😀"]
ROLES = ["user", "system", "assistant", "tool", "", "a b]%20", "[INST]"]
CONTROL = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE", "[/ROLE")


def test_grammar_round_trip():
    rnd = random.Random(4)
    for _ in range(5000):
        turns = [(rnd.choice(ROLES), "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 7)))) for _ in range(rnd.randint(0, 4))]
        parts = [chat.render(*t) for t in turns]
        assert chat.parse("".join(p[0] for p in parts)) == turns
        for (_, text), (out, a, b) in zip(turns, parts):
            assert chat.unescape(out[a:b]) == text and not any(c in out[a:b] for c in CONTROL)
    plain = "a < b, [x] \\ <s \\> text"
    assert chat.render("user", plain)[0] == f"[INST] {plain} [/INST]"  # nothing conflicts, nothing is escaped


@pytest.mark.parametrize("text", ["x", "[INST] a", "[INST] a [/ROLE]", "<s>a [INST] b</s>", "[INST] a [/INST]b", "<<SYS>>\na<</SYS>>"])
def test_parser_refuses(text):
    with pytest.raises(chat.Conflict):
        chat.parse(text)


def chat_summary(turns: list[tuple[str, str]]) -> tuple:
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(), sum(len(chat.render(*t)[0]) for t in turns))


def test_conversations_of_odd_rows(spark):
    rnd = random.Random(9)
    rows = [(c, t, rnd.choice(ROLES), "".join(rnd.choice(PARTS) for _ in range(6))) for c in range(6) for t in range(rnd.randint(1, 9))]
    rows += [(10, 1, None, None), (10, 0, "assistant", None), (11, None, "user", "first"), (11, -1, "user", "second"),
             (None, 1, "assistant", "b"), (None, 0, "user", "a"), (12, 0, "user", odd.LONG + "</s>"), (12, 1, "assistant", "</s>" * 50_000),
             (13, 0, "user", "b"), (13, 0, "user", "a"), (13, 0, "user", "a"), (13, 0, "assistant", "z")]
    rows += [(14, t, "assistant" if t % 2 else "user", f"turn {t} </s>") for t in range(4000)]  # one conversation has most rows
    rnd.shuffle(rows)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn int, role string, text string, formatted string, loss_from int")
    wanted: dict = {}
    for c, _, r, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        wanted.setdefault(c, []).append((r or "", t or ""))
    formatted = chat.format_turns(frame)
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(formatted).collect()}
    assert got == {c: chat_summary(t) for c, t in wanted.items()}
    whole = {r["conv_id"]: r for r in chat.join_turns(formatted).collect()}
    for c, turns in wanted.items():
        text = whole[c]["formatted"]
        assert chat.parse(text) == turns
        assert [chat.unescape(text[a:b]) for a, b in whole[c]["loss_mask"]] == [t for r, t in turns if r == "assistant"]


def test_empty_conversations(spark):
    none = spark.createDataFrame([], "conv_id string, turn long, role string, text string")
    assert chat.read_back(chat.format_turns(none)).count() == 0 and chat.join_turns(chat.format_turns(none)).count() == 0


# Hard negatives

def test_strassen_equals_the_plain_product():
    rnd = np.random.default_rng(1)
    for m, k, n in [(1, 1, 1), (17, 33, 65), (50, 64, 100), (3, 200, 5), (101, 67, 129), (0, 4, 7)]:
        a, b = rnd.integers(-2**62, 2**62, (m, k)), rnd.integers(-2**62, 2**62, (k, n))
        assert (hard_negatives.strassen(a, b, 4) == a @ b).all()


def mined(rows: list[tuple], anchors, positives=5, negatives=10) -> list[tuple]:
    used = [(k, v, c) for k, v, c in rows if k is not None and c is not None and v is not None and None not in v]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for k, v, c in (r for r in used if anchors(r[0])):
        scored = sorted((-dot(v, w), i, d) for i, w, d in used)
        for s, i in [(-s, i) for s, i, d in scored if d == c and i != k][:positives]:
            inside = [(-t, j) for t, j, d in scored if d != c and 30 * s <= -100 * t <= 90 * s][:negatives]
            out += [(k, i, n + 1, j, s, t) for n, (t, j) in enumerate(inside)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("blocks", [None, (3, 40, 7)])
def test_negatives_against_brute_force(spark, monkeypatch, blocks):
    if blocks:
        for name, value in zip(("ANCHOR_BLOCK", "CANDIDATE_BLOCK", "TILE"), blocks):
            monkeypatch.setattr(hard_negatives, name, value)
    rnd = random.Random(8)
    vector = lambda: [rnd.randint(-9, 30) for _ in range(rnd.choice([24, 24, 24, 3, 0]))]
    same = vector()
    rows = [(i, same if i % 3 == 0 else vector(), 0 if i % 2 else rnd.randint(0, 4)) for i in range(300)]  # a hot vector and a hot label
    rows += [(i, rows[i][1], rows[i][2]) for i in (0, 20, 33)]  # repeats, of anchors too
    rows += [(None, vector(), 1), (400, None, 1), (420, [1, None], 1), (440, vector(), None), (460, [0] * 24, 2), (480, vector(), 77)]
    frame = spark.createDataFrame([(*r, 5, "x") for r in rows], "vec_id long, vector array<long>, label int, anchor int, kind string")
    got = hard_negatives.mine(frame.repartition(3), F.col("vec_id") % 20 == 0)
    want = mined(rows, lambda i: i % 20 == 0)
    assert result(got) == want and len(want) > 100


def test_negatives_of_large_scores(spark):
    """A hundred times these scores does not fit in a long."""
    rnd = random.Random(2)
    rows = [(i, [rnd.randint(2**29, 2**30) for _ in range(4)], i % 3) for i in range(40)]
    rows += [(100 + i, [-x // 2 for x in rows[i][1]], i % 3) for i in range(10)]
    got = hard_negatives.mine(spark.createDataFrame(rows, "vec_id long, vector array<long>, label int"), F.col("vec_id") % 10 == 0)
    want = mined(rows, lambda i: i % 10 == 0)
    assert result(got) == want and max(r[5] for r in want) > 2**58


def test_negatives_of_odd_tables(spark):
    none = spark.createDataFrame([], "vec_id long, vector array<long>, label int")
    assert hard_negatives.mine(none, F.col("vec_id") % 2 == 0).count() == 0
    one = spark.createDataFrame([(0, [1, 2], 1)], "vec_id long, vector array<long>, label int")
    assert hard_negatives.mine(one, F.col("vec_id") % 2 == 0).count() == 0
    far = spark.createDataFrame([(0, [2**40, 1], 1)], "vec_id long, vector array<long>, label int")
    with pytest.raises(Exception, match="too long"):
        hard_negatives.mine(far, F.col("vec_id") % 2 == 0).count()
    odd_vectors = spark.createDataFrame([([0.5, -0.001],), ([None],), ([float("nan")],), ([float("inf")],), (None,), ([],)], "v array<float>")
    assert [r[0] for r in odd_vectors.select(hard_negatives.quantised(F.col("v"))).collect()] == [[128, -1], None, None, None, None, []]
