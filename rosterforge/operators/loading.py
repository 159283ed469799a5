"""The loader's projection with a side table for bad cells, and a whole run whose counters come from the running plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rosterforge.functions import scalars as S
from rosterforge.operators import contacts as C
from rosterforge.operators import importing, merge

DATES, FLAGS, NUMBERS = ("dob", "signup_date"), ("is_clicker", "is_opener", "is_validated"), ("quality_score",)
_FLAG_WORDS = ("true", "t", "yes", "y", "1", "false", "f", "no", "n", "0", "")


def load_rows(rows: DataFrame) -> DataFrame:
    """Every normalisation of the loader in one projection; ``bad`` holds the cells that did not fit, as (field, value, reason).

    Dates become dates, gender M or F, flags booleans, scores numbers, texts their stored
    lengths.  A cell that does not fit is null (a long text is cut) and noted; the row stays, so no
    value can fail a batch.  Blank cells are null and not noted; other columns pass unchanged.
    """
    out, bad = {}, []
    note = lambda c, reason, when: bad.append(F.when(when, F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"), F.lit(reason).alias("reason"))))
    blank = lambda c: F.coalesce(S.strip(F.col(c).cast("string")), F.lit("")) == ""
    for c in rows.columns:
        text = F.col(c).cast("string")
        if c in DATES:
            out[c] = S.load_date(text).try_cast("date")
            note(c, "no date", ~blank(c) & out[c].isNull())
        elif c == "gender":
            letter = S.load_gender(text)
            out[c] = F.when(letter != "", letter)
            note(c, "neither M nor F", ~blank(c) & (F.coalesce(letter, F.lit("")) == ""))
        elif c in FLAGS:
            out[c] = S.load_flag(text)
            note(c, "no flag", ~F.lower(S.strip(F.coalesce(text, F.lit("")))).isin(*_FLAG_WORDS))
        elif c in NUMBERS:
            out[c] = S.strip(text).try_cast("int")
            note(c, "no number", ~blank(c) & out[c].isNull())
        elif c in importing.LENGTHS:
            n = importing.LENGTHS[c]
            out[c] = F.when(~blank(c), F.left(text, F.lit(n)))
            note(c, f"cut to {n}", F.length(text) > n)
    noted: Column = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<struct<field: string, value: string, reason: string>>")
    return rows.withColumns(out | {"bad": noted})


def quarantine(loaded: DataFrame, *keys: str) -> DataFrame:
    """The side table of bad cells: ``keys``, field, value, reason."""
    return loaded.filter(F.size("bad") > 0).select(*keys, F.explode("bad").alias("_b")).select(*keys, "_b.*")


def counted_run(raw: DataFrame, as_of: str) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The merged contacts of a run, and its counters once an action has run on them.

    Read rows, valid ones, rejects by reason, loaded and duplicates are observed while the plan runs;
    nothing is scanned a second time.  The counters wait for the first action.
    """
    read, loaded = Observation(), Observation()
    reasons = [F.count_if(F.col("reject_reason") == r).alias(r) for r in C.REASONS]
    rows = C.with_reason(C.clean(raw)).observe(read, F.count(F.lit(1)).alias("read"), F.count_if(F.col("reject_reason").isNull()).alias("valid"), *reasons)
    ready = C.score(C.categorise(rows.filter("reject_reason IS NULL").drop("reject_reason")), as_of)
    out = merge.merge_duplicates(ready).observe(loaded, F.count(F.lit(1)).alias("loaded"))
    return out, lambda: dict(read.get) | {"loaded": loaded.get["loaded"], "duplicates": read.get["valid"] - loaded.get["loaded"]}
