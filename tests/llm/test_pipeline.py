"""The pipeline against a brute-force version, and its stages on odd rows."""

import corpus_pipeline as pipeline
from tests.llm import odd
from wardlake.llm import quality_model
from wardlake.session import write_through


def test_stages_against_brute_force(spark, base):
    docs = spark.read.parquet(f"{base}/documents.parquet")
    columns = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = write_through(stage(spark, docs, base), "stage")
        after = {r["doc_id"]: r for r in docs.collect()}
        assert docs.columns == columns and set(after) <= set(before) and after
        if name == "quality rules":
            for k, r in before.items():
                ws = odd.words(r["text"])
                windows = list(zip(ws, ws[1:], ws[2:]))
                repeated = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)} if len(ws) < 400 else set()
                if len(ws) < 50 or 100 * len(repeated) > 50 * len(ws):
                    assert k not in after
        elif name == "near-duplicates":
            label = odd.components({k: r["text"] for k, r in before.items()})
            assert set(after) == set(label.values())
        elif name == "personal data":
            assert set(after) == set(before) and all(len(r["text"]) == r["n_chars"] for r in after.values())
    packed = pipeline.run(spark, base).collect()
    assert {r["doc_id"] for r in packed} == set(after)
    assert all(len(r["ids"]) == r["length"] for r in packed)


def test_stages_take_odd_rows(spark, base, monkeypatch):
    monkeypatch.setattr(quality_model, "fit", lambda *a, **k: None)
    for docs in (odd.frame(spark), odd.empty(spark)):
        for _, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, base)
            assert out.columns == docs.columns
            out.count()
    near = pipeline.near_dedup_stage(spark, odd.frame(spark), base).collect()
    ids = [r["doc_id"] for r in near]
    assert ids.count(4) == 1 and 5 not in ids and 14 not in ids and ids.count(None) == 2


def test_rows_that_share_an_id_are_documents_of_their_own(spark, base):
    other = " ".join(f"other{i}" for i in range(120))
    rows = [(1, odd.BASE), (1, other), (1, odd.BASE), (2, odd.BASE + " tail"), (3, other + " more"), (1, None), (1, ""), (4, "few words")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r["doc_id"], r["text"]) for r in pipeline.near_dedup_stage(spark, docs, base).collect()), key=str)
    assert got == sorted([(1, odd.BASE), (1, other), (1, None), (1, ""), (4, "few words")], key=str)


def test_packing_takes_odd_rows(spark, base):
    for docs in (odd.frame(spark), odd.empty(spark)):
        pieces = pipeline.packing_stage(spark, docs, base).collect()
        assert sum(r["start"] == 0 for r in pieces) == docs.count() and all(len(r["ids"]) == r["length"] for r in pieces)
