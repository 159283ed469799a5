"""The pipeline, stage by stage, against the brute-force versions."""

from collections import Counter

import corpus_pipeline as cp
from rosterforge.llm import lines, pii

from .test_dedup import lines_expected, shingles
from .test_tokens import check_pack


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, documents, sf):
    steps = dict(cp.STAGES)
    assert list(steps) == ["quality classifier", "line dedup", "minhash near-dedup", "personal data", "packing"]
    good = steps["quality classifier"](spark, documents, sf).cache()
    assert good.columns == list(cp.COLUMNS) and 0 < good.count() <= documents.count() and not Counter(rows(good)) - Counter(rows(documents))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {d for d, _ in rows(good)}
    assert sum(d in kept for d, q in labels.items() if q == 1) >= 0.97 * sum(labels.values())

    fewer = steps["line dedup"](spark, good, sf).cache()
    assert fewer.columns == list(cp.COLUMNS) and Counter(rows(fewer)) == Counter({(d, t): n for (d, t, *_), n in lines_expected(rows(good)).items()})

    unique = steps["minhash near-dedup"](spark, fewer, sf).cache()
    sets = [shingles(t, 5) for _, t in rows(unique)]
    assert unique.columns == list(cp.COLUMNS)
    assert not any(a and 100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])

    masked = steps["personal data"](spark, unique, sf).cache()
    model = pii.train_field()
    want = {(d, pii.mask(t, pii.find_spans([t], model, pii._Words())[0][1])) for d, t in rows(unique)}
    assert masked.columns == list(cp.COLUMNS) and set(rows(masked)) == want
    check_pack(masked)
    for df in (good, fewer, unique, masked):
        df.unpersist()


def test_lines_of_one_document_count_once(spark):
    got = lines.dedup_lines(spark.createDataFrame([(1, "same line here\nsame line here\n\nother words entirely")], "doc_id long, text string")).collect()
    assert got[0]["text"] == "same line here\n\nother words entirely" and got[0]["n_dropped"] == 1
