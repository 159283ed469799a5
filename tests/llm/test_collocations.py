"""Collocations against plain counting, and the bitmaps against it at shard borders."""

import re
from collections import Counter, defaultdict

import duckdb
import pytest

from rosterforge.llm import collocations, queries

COLUMNS = "lang rank phrase a l r n score".split()


def counts(rows):
    f = defaultdict(Counter)
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            for k in range(1, 5):
                f[lang or "und"].update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
    return f


def expected(rows, least, top=2000):
    out = []
    for lang, f in counts(rows).items():
        n = sum(v for p, v in f.items() if " " not in p)
        found, held = [], Counter()
        for p, a in f.items():
            w = p.split(" ")
            if len(w) > 1 and a >= least:
                cuts = [(2000000 * a // (f[" ".join(w[:k])] + f[" ".join(w[k:])]), k, f[" ".join(w[:k])], f[" ".join(w[k:])]) for k in range(1, len(w))]
                score, _, l, r = min(cuts)
                found.append((-score, -a, p.encode(), p, l, r))
                for s in range(2, len(w)):
                    for i in range(len(w) - s + 1):
                        q = " ".join(w[i : i + s])
                        held[q] = max(held[q], a)
        left = sorted(x for x in found if 100 * held[x[3]] < -80 * x[1])
        out += [(lang, i + 1, p, -a, l, r, n, -s) for i, (s, a, _, p, l, r) in enumerate(left[:top])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("shard_words", [collocations.SHARD_WORDS, 50])
def test_odd_rows(spark, odd, shard_words):
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    text = "Ab ab\tAB ab. ab ab,ab x\x0by ab x ab x\x00 x É é  ab x ab x " * 5
    more = [(None, text), ("en", text), ("en", text), ("", " . , "), ("de", "one two one two one")]
    df = odd.select("lang", "text", "size", "rows").unionByName(spark.createDataFrame(more, "lang string, text string"), allowMissingColumns=True)
    got = rows_of(collocations.collocations(df, least=3, shard_words=shard_words))
    assert got == expected(rows + more, 3) and len(got) > 100


def test_no_rows(no_docs):
    assert collocations.collocations(no_docs).collect() == []


def test_phrases_over_many_shards_and_64_bit_parts(spark):
    rows = [("en", " ".join(f"w{(i * i + j) % 7}" for i in range(500))) for j in range(20)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for shard_words in (7, 64, 1000):
        words, grams = collocations.count_phrases(df, 30, shard_words=shard_words)
        want = counts(rows)["en"]
        assert {r["phrase"]: r["f"] for r in words.collect()} == {p: n for p, n in want.items() if " " not in p}
        assert {r["phrase"]: r["f"] for r in grams.collect()} == {p: n for p, n in want.items() if " " in p and n >= 30}


def test_whole_table_against_duckdb(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(queries.ORACLES["op11_collocations"]).df()
    assert rows_of(queries.op11_collocations(spark, sf)) == sorted(map(tuple, want[COLUMNS].values.tolist()))
