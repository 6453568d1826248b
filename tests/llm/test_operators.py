"""Operators on odd rows, empty tables and planted cases."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm import odd
from wardlake.llm import (components, fingerprint, language, licences, near_dedup, packing, pii, piece_bpe, quality_model,
                          quality_rules, sharding, wordhash)

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("make", [odd.frame, odd.empty])
def test_every_operator_takes_odd_rows(spark, make):
    docs = make(spark)
    n = docs.count()
    assert near_dedup.near_duplicates(docs).count() == n
    assert quality_rules.ledger(docs, ["doc_id"]).count() == n
    assert quality_model.predict(docs, None, tail=2).count() == n
    assert pii.replace_personal(docs, "key").count() == n
    assert {r["text"] for r in pii.replace_personal(docs, "key").collect()} == {r["text"] for r in docs.collect()}
    pieces = packing.pack(docs, WORDS).collect()
    assert sum(r["start"] == 0 for r in pieces) == n
    assert fingerprint.compare_with_next(docs).count() == n
    assert language.predict(docs, language.fit(docs)).count() == n
    assert licences.scan(docs, ["doc_id"]).count() == n
    keyed = docs.select("*", sharding.text_key(F.col("text")).alias("k"), F.coalesce("doc_id", F.lit(-1)).alias("i"), F.lit(1).cast("long").alias("w"))
    assert sharding.histogram_sort(keyed, ["k", "i"], "w", 4).count() == n
    assert piece_bpe.encode(docs, PIECES).count() == n


def test_near_duplicates_of_odd_rows(spark):
    got = near_dedup.near_duplicates(odd.frame(spark)).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[5]["component_id"] == 4 and by_id[6]["component_id"] == 4 and by_id[14]["component_id"] == 4
    assert by_id[8]["component_id"] == 7  # case does not count
    assert by_id[0]["component_id"] == 0 and by_id[1]["component_id"] == 1 and by_id[1]["n_shingles"] == 0
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert sum(r["doc_id"] == 4 for r in got) == 3


def test_near_duplicates_of_shared_passages_and_chains(spark):
    """A passage in most documents, families of edited copies, and chains in which only neighbours are alike."""
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(100_000)}"
    passage = [f"p{i}" for i in range(60)]
    texts = [passage + [word() for _ in range(rnd.randint(14, 90))] for _ in range(150)]
    family = [word() for _ in range(200)]
    for _ in range(60):
        copy = list(family)
        for _ in range(rnd.randint(1, 5)):
            copy[rnd.randrange(200)] = word()
        texts.append(copy)
    chain = [word() for _ in range(100)]
    for _ in range(30):
        chain = chain[5:] + [word() for _ in range(5)]
        texts.append(chain)
    rnd.shuffle(texts)
    docs = {i: " ".join(t) for i, t in enumerate(texts)}
    got = near_dedup.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == odd.components(docs)


def _templated(n, seed, values=20):
    """Texts of 60 words from one template, with five slots of so many values."""
    rnd = random.Random(seed)
    frame = [f"t{i}" for i in range(60)]
    out = []
    for _ in range(n):
        words = list(frame)
        for slot in (6, 17, 28, 39, 50):
            words[slot] = f"s{slot}v{rnd.randrange(values)}"
        out.append(" ".join(words))
    return out


def test_near_duplicates_of_small_templates(spark):
    """Few values a slot, so that many texts are alike, next to texts of other lengths."""
    texts = _templated(300, 4, 4) + [" ".join(t.split()[:k]) for t in _templated(40, 5, 4) for k in (50, 56)]
    docs = dict(enumerate(texts))
    got = near_dedup.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == odd.components(docs)


def test_components_of_path_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r["node"]: r["label"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(50))
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_and_shingle_hashes():
    import pyarrow as pa

    texts = ["Aa b\tc  d\x0be", "aa B c d e", "", "x", "x y", "a b c d e f a b c d e f", "x y z"]
    sets = []
    for _, s, n in wordhash.shingle_sets(pa.array(texts)):
        sets += np.split(s, np.cumsum(n)[:-1])
    assert [len(s) for s in sets] == [len(odd.shingles(t)) for t in texts]
    assert (sets[0] == sets[1]).all() and sets[3][0] != sets[4][0]


def test_ledger_policies_and_ablations(spark):
    good = " ".join(f"word{i} and" for i in range(60))
    docs = spark.createDataFrame([(1, good), (2, "same same " * 50), (3, good + " # # # # # # # # # # # # # # # # # #"), (4, "few"), (5, None)], "doc_id long, text string")
    ledger = quality_rules.ledger(docs, ["doc_id"])
    kept = lambda p: {r["doc_id"] for r in quality_rules.apply_policy(ledger, p).where("kept").collect()}
    assert kept(quality_rules.STRICT) == {1} and kept(quality_rules.BASE) == {1, 3}
    ablation = {r["rule"]: r for r in quality_rules.ablations(ledger, quality_rules.STRICT).collect()}
    assert ablation["symbols"]["rejected_alone"] == 1 and ablation["symbols"]["kept_without"] == 2
    assert ablation["few_words"]["failed"] == 2 and ablation["few_words"]["kept"] == 1
    with pytest.raises(ValueError):
        quality_rules.Policy("x", ("nothing",)).mask()


def test_shards_of_a_hot_text(spark):
    rows = [(i, "copy" if i % 3 else f"text {i}") for i in range(3000)] + [(7, "copy")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", sharding.text_key(F.col("text")).alias("k"), F.lit(10).cast("long").alias("w"))
    got = sharding.histogram_sort(docs, ["k", "doc_id"], "w", 10, pieces=3).toPandas()
    sizes = got.groupby("shard").w.sum()
    assert len(sizes) == 10 and sizes.max() - sizes.min() <= 20 + 3000  # equal rows cannot be parted
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    ordered = got.sort_values(["shard", "slot"])[["k", "doc_id"]].values.tolist()
    assert ordered == sorted(ordered)


def test_packing_choices():
    rnd = random.Random(1)
    for _ in range(60):
        places, penalties = [0], [0]
        for _ in range(rnd.randint(1, 12)):
            places.append(places[-1] + rnd.randint(1, 8))
            penalties.append(rnd.randint(0, 4))
        cost = lambda cuts: sum(10 - (places[b] - places[a]) + penalties[b] for a, b in zip(cuts, cuts[1:]))
        inner = range(1, len(places) - 1)
        ways = [[0] + [i for k, i in enumerate(inner) if mask >> k & 1] + [len(places) - 1] for mask in range(1 << len(inner))]
        best = min(cost(cuts) for cuts in ways if all(places[b] - places[a] <= 10 for a, b in zip(cuts, cuts[1:])))
        assert cost(packing.choose_cuts(places, penalties, 10)) == best


def test_packing_ids_are_the_tokenizers(spark):
    from tokenizers import Tokenizer

    texts = ["Don't STOP. Été ßtraße!! x<|endoftext|>y 'tis I'll", "a\0b c", "x" * 9000, "１２３ ǅ ½ naïve café.", "é é́  z", "…—“q”"]
    tokenizer = Tokenizer.from_file(WORDS)
    pieces = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), WORDS, limit=256, with_ids=True).collect()
    for i, text in enumerate(texts):
        mine = sorted((r["start"], r["ids"]) for r in pieces if r["doc_id"] == i)
        assert [x for _, part in mine for x in part] == tokenizer.encode(text, add_special_tokens=False).ids + [1]
    assert all(zlib.crc32(np.array(r["ids"], "<u4")) == r["ids_crc32"] for r in pieces)


def test_piece_bpe_equals_the_library():
    import sentencepiece

    with open(PIECES, "rb") as f:
        blob = f.read()
    model, library = piece_bpe.PieceModel(blob), sentencepiece.SentencePieceProcessor(model_proto=blob)
    rnd = random.Random(5)
    texts = ["", " ", "\n", "a  b\n\nc ▁x \x00\t Ω漢€", " " * 100 + "x", "reducereduce eeduce", "a" * 300, "<s></s><0x0A>", "######****"]
    alphabet = list("abcdetrnio  \n\n\t#=&*.▁éß漢€😀\x00")
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 120))) for _ in range(500)]
    for text in texts:
        ids, _ = model.encode_words(model.units(text))
        mine = np.concatenate([[model.bos], ids, [model.eos]]).astype(np.int64)
        want = library.encode(text, add_bos=True, add_eos=True)
        assert mine.tolist() == want and model.decode(mine) == library.decode(want), text


def test_fingerprint_estimates():
    order = fingerprint.draws()
    rnd = np.random.default_rng(2)
    pool = wordhash.mix(rnd.integers(1, 1 << 62, 4000).astype(np.uint64))
    for size, shared in ((3, 2), (30, 20), (400, 300), (3000, 2000)):
        a, b = pool[:size], pool[size - shared:2 * size - shared]
        both = [np.sort(a), np.sort(b)]
        prints = fingerprint.fingerprints(np.concatenate(both), np.array([size, size]), order)
        assert abs(fingerprint.likeness(prints[:1], prints[1:])[0] - shared / (2 * size - shared)) < 0.2
        assert fingerprint.likeness(prints[:1], prints[:1])[0] == 1.0


def test_fingerprints_of_short_texts_are_apart():
    """One to ten shingles fill few bins; unrelated texts must not agree, equal ones must."""
    order, rnd = fingerprint.draws(), np.random.default_rng(6)
    empty = fingerprint.fingerprints(np.zeros(0, np.uint64), np.array([0]), order)
    for size in (1, 2, 3, 5, 10):
        pool = wordhash.mix(rnd.integers(1, 1 << 62, 400 * size).astype(np.uint64))
        prints = fingerprint.fingerprints(np.concatenate([np.sort(x) for x in np.split(pool, 400)]), np.full(400, size), order)
        assert fingerprint.likeness(prints[:200], prints[200:]).max() < 0.12
        assert (fingerprint.likeness(prints, prints) == 1.0).all()
        assert (fingerprint.likeness(prints, np.repeat(empty, 400, 0)) == 0.0).all()
    assert fingerprint.likeness(empty, empty)[0] == 1.0
    texts = fingerprint.of_texts(["one two", "three four", "", "one two"], order)
    assert fingerprint.likeness(texts[:1], texts[3:])[0] == 1.0 and fingerprint.likeness(texts[:1], texts[1:2])[0] < 0.12


def test_language_equals_plain_naive_bayes(spark):
    rows = [("the cat and the dog", "en"), ("der hund und die katze", "de"), ("the end", "en"), ("ein ende", "de"), (None, "en"), ("x", None)]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"), smoothing=0.5)
    assert model.languages == ("de", "en")
    for text in ("the katze", "und und", "dog"):
        grams = language.n_grams(text, model.dims)
        logs = []
        for lang in model.languages:
            mine = [language.n_grams(t, model.dims) for t, x in rows if t and x == lang]
            counts = np.bincount(np.concatenate(mine), minlength=model.dims)
            logs.append(np.log(len(mine) / 4) + np.log((counts[grams] + 0.5) / (counts.sum() + 0.5 * model.dims)).sum())
        name, score = language.score(text, model)
        assert name == model.languages[int(np.argmax(logs))] and abs(score - 1 / (1 + np.exp(min(logs) - max(logs)))) < 1e-4
    assert language.score("123 !", model) == ("und", 0.0) and language.score(None, model) == ("und", 0.0)


def test_language_scores_do_not_depend_on_the_batch(monkeypatch):
    import pyarrow as pa

    rnd = random.Random(8)
    model = language.LanguageModel(("a", "b", "c"), np.log([0.5, 0.3, 0.2]), np.log(np.random.default_rng(1).dirichlet(
        np.ones(256), 3).T + 1e-9).astype(np.float32))
    texts = ["".join(rnd.choice("abc déß ж") for _ in range(rnd.choice([0, 1, 2, 30, 3000]))) for _ in range(200)] + [None, "  ", "7", "x" * 200_000]
    alone = [language.score(t, model) for t in texts]
    for t, (name, p) in zip(texts, alone):
        grams = language.n_grams(t, 256) if t else None
        if grams is None:
            assert (name, p) == ("und", 0.0)
            continue
        logs = model.log_prior + np.bincount(grams, minlength=256) @ model.log_prob.astype(np.float64)
        assert name == model.languages[int(logs.argmax())] and abs(p - 1 / np.exp(logs - logs.max()).sum()) < 1e-9
    for grams, count in ((1 << 19, 1 << 12), (1, 1), (5000, 7)):
        monkeypatch.setattr(language, "BLOCK_GRAMS", grams)
        monkeypatch.setattr(language, "BLOCK_TEXTS", count)
        assert list(zip(*language.score_texts(pa.array(texts, pa.string()), model))) == alone


def test_licence_rules(spark):
    apache = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
text that goes on"""
    rows = [(1, apache), (2, "Released under the MIT License.\nAll rights reserved."), (3, "you may obtain a copy of the License at"), (4, None)]
    got = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    assert got[1]["licenses"] == ["Apache-2.0"] and got[1]["sentence_ids"][:2] == ["APACHE_2_NAME", "APACHE_COMPLIANCE"]
    assert got[2]["licenses"] == ["MIT", "Proprietary"] and got[2]["unmatched"] == []
    assert got[3]["licenses"] == [] and got[3]["unmatched"] == ["APACHE_COPY_AT"] and got[4]["sentence_ids"] == []


def test_surrogates_keep_kind_and_identity(spark):
    rows = [(1, "Mr. John Smith and Mr. Smith; card 4111 1111 1111 1111 or 4111111111111111. A@B.COM, a@b.com"),
            (2, "Frau Müller, Господин Иванов, +1 (743) 555-3824, 123-45-6789, password=abc12345, 10.0.0.1"),
            (3, "Mr. John Smith wrote to c@b.com; nothing in v1.2.3 or 2.0"), (4, None), (5, "clean text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.replace_personal(docs, "k").collect()}
    again = {r["doc_id"]: r["text"] for r in pii.replace_personal(docs, "k").collect()}
    other = {r["doc_id"]: r["text"] for r in pii.replace_personal(docs, "other").collect()}
    assert got == again and got[1] != other[1] and got[4] is None and got[5] == "clean text"
    for secret in ("Smith", "4111", "A@B", "a@b", "Müller", "Иванов", "555-3824", "123-45", "abc12345", "10.0.0.1", "c@b"):
        assert not any(secret in (t or "") for t in got.values()), secret
    import re

    spaced, plain = re.search(r"card ([\d ]+) or (\d+)", got[1]).groups()
    assert spaced.replace(" ", "") == plain and len(plain) == 16
    digits = [int(d) for d in plain[::-1]]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    full, family = re.search(r"Mr\. (\w+ \w+) and Mr\. (\w+);", got[1]).groups()
    assert full.split()[1] == family and f"Mr. {full} wrote" in got[3]
    assert re.search(r"Господин [А-Яа-я]+,", got[2]) and "v1.2.3 or 2.0" in got[3]
    upper, lower = re.search(r"(\S+@\S+\.COM), (\S+@\S+\.com)", got[1]).groups()
    assert upper.lower() == lower and lower.split("@")[1] == re.search(r"@(\S+);", got[3])[1]


def licences_of(spark, texts):
    """Licences and unmatched identifiers by operator, held against the SQL twin."""
    import duckdb
    import pandas as pd

    rows = list(enumerate(texts))
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).orderBy("doc_id").collect()
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841
    twin = sorted(duckdb.sql(licences.scan_sql()).fetchall())
    assert [(r["doc_id"], *(",".join(r[c]) for c in ("sentence_ids", "licenses", "unmatched"))) for r in got] == twin
    return [(r["licenses"], r["unmatched"]) for r in got]


GPL_NOTICE = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{} either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""


def test_published_licence_notices(spark):
    gpl_3, gpl_2 = GPL_NOTICE.format(":", ",", 3), GPL_NOTICE.format(";", ";", 2)
    comment = lambda text, mark: "".join(f"{mark} {line}".rstrip() + "\n" for line in text.splitlines())
    one_line = lambda text: " ".join(text.split())
    texts = [gpl_3, gpl_2, comment(gpl_3, "#"), comment(gpl_2, " *"), one_line(gpl_3), one_line(gpl_2), MIT_TEXT, comment(MIT_TEXT, "//"),
             "# SPDX-License-Identifier: MIT\nimport os", "/* SPDX-License-Identifier: Apache-2.0 */", "// SPDX-License-Identifier: GPL-3.0-only\n#include <a.h>\n"]
    want = ["GPL-3.0-or-later", "GPL-2.0-or-later"] * 3 + ["MIT", "MIT", "MIT", "Apache-2.0", "GPL-3.0-only"]
    assert licences_of(spark, texts) == [([w], []) for w in want]


def test_licence_names_and_tags(spark):
    cases = {
        "This project is licensed under the MIT License.": "MIT", "This file is licensed under the Apache License, Version 2.0": "Apache-2.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License": "CC-BY-4.0",
        "This library is distributed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1-only",
        "Licensed under the Mozilla Public License 2.0": "MPL-2.0", "This software is released under the ISC License": "ISC",
        "The code is licensed under the GNU Affero General Public License v3.0": "AGPL-3.0-only",
        **{f"// SPDX-License-Identifier: {x}\nint a;": x for x in (
            "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.1-or-later", "MPL-2.0", "ISC")}}
    assert licences_of(spark, list(cases)) == [([x], []) for x in cases.values()]
    assert licences_of(spark, ["We like the MIT License.", "# SPDX-License-Identifier: GPL-2.0+"]) == [([], [])] * 2


def replaced(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r["text"], r["n"]) for r in pii.replace_personal(rows, "k", count="n").orderBy("doc_id").collect()]


def test_surrogates_for_addresses_in_any_script(spark):
    """Addresses behind letters of scripts without blanks, and with letters that are not ASCII."""
    texts = ["联系john@example.com", "müller@firma.de", "josé.garcia@example.com", "mail john@example.com联系我们。", "иван@почта.рф, ok",
             "请写用户@例子.公司。", "ติดต่อjohn@example.com", "联系password: abc12345", "账号DE89370400440532013000", "键abcdef0123456789abcdef0123456789"]
    got = replaced(spark, texts)
    for (new, n), parts in zip(got, ("john example", "müller firma ller", "josé garcia example", "john example", "иван почта", "用户 例子",
                                     "john example", "abc12345", "370400440532013000", "abcdef0123456789"), strict=True):
        assert n == 1 and not any(p in new for p in parts.split()), new
    address = got[0][0].removeprefix("联系")
    assert got[0][0].startswith("联系") and address.isascii() and address.endswith(".com")
    assert got[3][0] == f"mail {address}联系我们。" and got[6][0] == f"ติดต่อ{address}"
    assert got[1][0].endswith(".de") and got[4][0].endswith(".рф, ok")


def test_surrogates_at_sentence_ends_and_without_digits(spark):
    texts = ["Call 555-123-4567.", "tel.555-123-4567", "1-555-123-4567", "555 123 4567", "Is it 555.123.4567?", "(1 555 123 4567).",
             "password: correcthorse", "PWD='correcthorse'.", "passwd=!?!?!?"]
    got = replaced(spark, texts)
    for new, n in got:
        assert n == 1 and not any(p in new for p in ("123", "4567", "correct", "!?!?!? ")), new
    number = got[3][0].replace(" ", "")
    assert got[0][0].startswith("Call ") and got[0][0].endswith(".") and got[2][0].startswith("1-")
    assert all(new.translate(str.maketrans("", "", "Calteis?()-. I")).removeprefix("1").endswith(number) for new, _ in got[:6])
    assert got[6][0].removeprefix("password: ") == got[7][0][5:-2] and got[8][0] != texts[8]
    kept = ["version 2.555.123.4567", "12-555-123-4567", "555-123-4567-1", "555-123-4567.5", "password: ******", "password: abc", "token: somewhere"]
    assert replaced(spark, kept) == [(t, 0) for t in kept]
    assert replaced(spark, ["card 555 123 4567 8901"])[0][1] == 1


def test_surrogates_stay_distinct(spark):
    """More names than given names, and few digits: draws collide and are drawn again."""
    names = [(i, f"Mr. {a}{b} Stone") for i, (a, b) in enumerate((a, b) for a in "ABCDEFGH" for b in ("na", "no", "ni", "ne", "nu"))]
    got = pii.replace_personal(spark.createDataFrame(names, "doc_id long, text string"), "k").collect()
    assert len({r["text"] for r in got}) == len(names)
    numbers = [(i, f"{i // 254 + 1}.0.0.{i % 254 + 1}") for i in range(800)]
    got = pii.replace_personal(spark.createDataFrame(numbers, "doc_id long, text string"), "k").collect()
    assert len({r["text"] for r in got}) == 800 and not {r["text"] for r in got} & {t for _, t in numbers}


def test_ordinal_model_orders_grades(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(600):
        g = i % 3
        text = " ".join(rnd.choice(words) for _ in range(60)) + ("" if g == 2 else " rude loud" if g == 1 else " zzz *** ### zzz !!!")
        rows.append((i, text, g))
    data = spark.createDataFrame(rows, "doc_id long, text string, g int")
    model = quality_model.fit(data.where("doc_id < 400"), data.select("doc_id", "g"), F.col("g"), 3)
    assert (np.diff(model.thresholds) > 0).all()
    got = quality_model.predict(data.where("doc_id >= 400"), model, tail=2).toPandas()
    means = got.groupby("g").expected_grade.mean()
    assert means[0] < means[1] < means[2] and (got[got.g == 2].tail_probability > 0.5).mean() > 0.95
    assert np.allclose(model.probabilities(np.array([-3.0, 0.0, 5.0])).sum(1), 1)
    assert quality_model.fit(data, data.where("g = 1").select("doc_id", "g"), F.col("g"), 3) is None


def test_surrogates_of_a_full_shape_end(spark):
    """Shapes with fewer values than the table has entities are left behind, and every surrogate is new and distinct."""
    letters = "абвгдежзийклмнопрстуфхцчшщэюяé"
    rows = [(i, f"to {c}@firma.de now") for i, c in enumerate(letters)]
    rows += [(1000 + i, f"at {a}.{b}.{c}.{d}") for i, (a, b, c, d) in enumerate((a, b, c, d) for a in range(1, 10) for b in range(1, 10) for c in (1, 2, 3) for d in range(1, 10))]
    got = pii.replace_personal(spark.createDataFrame(rows, "doc_id long, text string"), "k", count="n").collect()
    assert all(r["n"] == 1 for r in got) and len({r["text"] for r in got}) == len(rows)
    assert not {r["text"] for r in got} & {t for _, t in rows}
    few = spark.createDataFrame([("ip", f"{a}.{b}.1.1") for a in range(1, 10) for b in range(1, 10)] + [("email", "a@b.de")] + [
        ("email", f"{c}@c.de") for c in "abcdefghijklmnopqrstuvwxyz"], "kind string, value string")
    made = pii.assign_surrogates(few, "k").collect()
    assert len({(r["kind"], r["surrogate"]) for r in made}) == len(made) == few.count()
    assert not {r["surrogate"] for r in made} & {r["value"] for r in made}
    again = {(r["value"], r["surrogate"]) for r in pii.assign_surrogates(few.orderBy("value"), "k").collect()}
    assert again == {(r["value"], r["surrogate"]) for r in made}
    long_ = [r["surrogate"] for r in made if r["kind"] == "email" and r["attempt"] >= pii.WIDEN]
    assert long_ and all(len(x.split("@")[0]) > 1 for x in long_)


def test_surrogates_keep_the_script(spark):
    texts = ["иван@firma.de", "Ωmega@firma.de", "用户@例子.公司", "דוד@firma.de", "나라@firma.de", "สมชาย@firma.de"]
    for text, (new, n), script in zip(texts, replaced(spark, texts), ("CYRILLIC", "GREEK", "CJK", "HEBREW", "HANGUL", "THAI")):
        import unicodedata

        local = new.split("@")[0]
        assert n == 1 and local != text.split("@")[0] and unicodedata.name(local[0]).startswith(script), new
