import pytest

#: Nulls, empty, blank and very long texts, ties, repeated rows, and extra columns whose names clash with internal ones.
LONG = " ".join(f"wort{i % 977} x{i % 31}" for i in range(40_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven wise men watch the quiet river run down to the sea and back"
ROWS = [
    (1, "a b c d e f g h", "en", "s"),
    (2, "a  b\tc d e f g h", "en", "s"),
    (3, None, None, None),
    (4, "", "en", "s"),
    (5, " \n\t ", "de", "s"),
    (6, LONG, "en", "hot"),
    (7, LONG + " end", "en", "hot"),
    (8, PROSE + "\n" + PROSE.replace("quick", "quiet") + "\nshort\n\nshort", "en", "hot"),
    (9, PROSE + "\nother line entirely with different words in it", "en", "hot"),
    (9, PROSE + "\nother line entirely with different words in it", "en", "hot"),
    (10, "einß Wort — naïve 日本語 text \U0001f600 with <|endoftext|> inside \x1c x", "de", "s"),
    (11, "x", None, "s"),
    (None, "mail bob.smith@example.com or 10.0.0.1 or +1 (499) 555-6503 card 4111 1111 1111 1111", "en", None),
    (13, "A B C D E F G H", "en", "s"),
]
CLASH = "n, part, ids, unit, key, node, _tie, _node, size, norm, row, rows, spans, score, label, regs, fp".split(", ")


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(*r, len(r[1] or ""), *["clash"] * len(CLASH)) for r in ROWS]
    names = ["doc_id long", "text string", "lang string", "source string", "n_chars long", *(f"`{c}` string" for c in CLASH)]
    return spark.createDataFrame(rows, ", ".join(names)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
