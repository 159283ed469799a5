"""Nothing is left out: cases that a part of the work would miss."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as cp
from rosterforge.llm import lines, pii, queries

from .conftest import ROWS
from .test_tokens import check_pack


def test_field_decodes_every_word_of_every_text(documents):
    texts = [r[1] or "" for r in ROWS] + [r["text"] or "" for r in documents.select("text").collect()]
    weights, trans = pii.train_field()
    cache = pii._Words()
    rows = [np.array([cache[w] for w in t.split()], np.int64) for t in texts]
    labels, starts = pii.decode(rows, cache.emissions(weights), trans)
    for text, row, at in zip(texts, rows, starts.tolist(), strict=True):
        if len(row):
            scores = pii._emissions(weights, np.array([pii.word_features(w) for w in text.split()]))
            assert (labels[at : at + len(row)] == pii.viterbi([scores], trans)[0]).all(), text[:200]


@pytest.mark.parametrize("seed", range(20))
def test_decoding_between_certain_words_is_exact(seed):
    rng = np.random.default_rng(seed)
    tables, trans = rng.normal(size=(4, 40, 4)) * 2, rng.normal(size=(4, 4))
    tables[:, 0], tables[2, :, 0] = 0, tables[2, :, 0] + 4
    rows = [rng.integers(1, 40, n) for n in (0, 1, 2, 3, 50, 200)]
    labels, starts = pii.decode(rows, tables, trans)
    for row, at in zip(rows, starts.tolist(), strict=True):
        if len(row):
            e = tables[2][row]
            e[2:] += tables[0][row[:-2]]
            e[1:] += tables[1][row[:-1]]
            e[:-1] += tables[3][row[1:]]
            assert (labels[at : at + len(row)] == pii.viterbi([e], trans)[0]).all()


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [("gestern kam Herr Steiner zu uns nach Hause", "person", "Steiner"), ("das Passwort: abcdef bitte", "secret", "abcdef"), ("they set password=correcthorsebattery over there", "secret", "password=correcthorsebattery")],
)
def test_field_looks_at_words_far_from_digits_and_english_cues(text, kind, span):
    got = pii.field_spans([text], pii.train_field(), pii._Words())[0]
    assert (kind, text.index(span), text.index(span) + len(span)) in got


def test_near_copies_with_null_and_repeated_ids(spark, sf):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, a), (2, a + " end"), (2, b), (None, c), (None, c), (None, b + " end"), (None, None), (None, None), (3, ""), (3, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = Counter((r["doc_id"], r["text"]) for r in cp.drop_near_copies(spark, docs, sf).collect())
    assert got == Counter([(1, a), (2, b), (None, c), (None, None), (None, None), (3, ""), (3, "")])


def test_stages_on_the_odd_fixture(spark, odd, sf):
    docs = odd.select(*cp.COLUMNS).cache()
    assert not Counter(map(tuple, cp.classify(spark, docs, sf).collect())) - Counter(map(tuple, docs.collect()))
    fewer = cp.drop_lines(spark, docs, sf).cache()
    assert Counter(r["doc_id"] for r in fewer.collect()) == Counter(r[0] for r in ROWS)
    unique = cp.drop_near_copies(spark, fewer, sf).cache()
    ids = Counter(r["doc_id"] for r in unique.collect())
    assert ids[None] == 1 and ids[9] == 1 and max(ids.values()) == 1 and {3, 4, 5, 6, 8, 10} <= set(ids)
    masked = cp.mask_personal_data(spark, unique, sf).cache()
    assert Counter(r["doc_id"] for r in masked.collect()) == ids
    check_pack(masked)
    for df in (docs, fewer, unique, masked):
        df.unpersist()


def test_op5_finds_short_lines_with_one_changed_character(spark, tmp_path):
    line = "a quick brown fox jumps over my lazy dog while we sit"
    long = line + " by the old river bank and wait for supper now"
    rows = [(1, line), (2, line.replace("jumps", "jumqs")), (3, long), (4, long.replace("river", "canal")), (5, "some other words that nobody repeats in this table")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["n_kept"] for r in queries.op5_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: 1, 2: 0, 3: 1, 4: 0, 5: 1}
    sets = lambda k: [set(zip(*[t[i:] for i in range(k)], strict=False)) for _, t in rows]
    for a, b in ((0, 1), (2, 3)):
        x, y = sets(7)[a], sets(7)[b]
        assert 100 * len(x & y) < 80 * len(x | y)


def test_long_runs_of_zeros_are_no_addresses_or_are():
    zeros = "0" * 5000
    texts = [f"at {'.'.join(zeros if i == k else '1' for i in range(4))} now" for k in range(4)]
    for t in texts:
        assert [s[0] for s in pii.base_spans(t) if s[0] == "ip"] == ["ip"]
    assert not [s for s in pii.base_spans(f"{zeros}256.1.1.1") if s[0] == "ip"]


def test_training_rows_of_op3_are_bounded(spark):
    from rosterforge.llm import quality

    docs = spark.range(50_000).selectExpr("id % 2 * 3 AS doc_id", "concat('word', id % 11, ' same text') AS text")
    labels = spark.createDataFrame([(0, 1), (3, 0)], "doc_id long, quality int")
    seen = []
    train, quality.train_ftrl = quality.train_ftrl, lambda rows: seen.append(len(rows)) or train(rows)
    try:
        quality.train(docs, labels, rows=40)
    finally:
        quality.train_ftrl = train
    assert seen == [40]
