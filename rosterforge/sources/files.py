"""Reading contact files: discovery, ragged CSV, loose TXT, ZIP archives, and the fixed record."""

from __future__ import annotations

import io
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.functions import rules as R
from rosterforge.functions import scalars as S
from rosterforge.sources import infer, records

#: Rows of a file that inference looks at.
SAMPLE = 1000
#: Columns of the readers: the whole record of a row that does not fit, and the cells beyond the named columns.
RAW, OVERFLOW = "_record", "overflow"
RECORD = ("email", "first_name", "last_name", "address", "city", "state", "zipcode", "phone", "dob", "gender", "signup_date", "signup_domain", "signup_ip", "validation_status", "country")


def discover(spark: SparkSession, root: str) -> DataFrame:
    """(path, name, length, modified) of contact files below ``root``, largest first; contents are not read.

    Paths that contain a skipped word anywhere, or a hidden folder, are left out.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    rows = files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.col("modificationTime").alias("modified"))
    skipped = reduce(lambda a, b: a | b, [F.contains(F.lower("path"), F.lit(w)) for w in R.SKIPPED_PATHS])
    wanted = F.lower("name").rlike(r"\.(csv|txt|zip|rar)$") & ~F.lower("name").rlike("|".join(R.EXCLUDED_NAMES)) & ~skipped & ~F.col("path").rlike(r"/\.")
    return rows.filter(wanted).orderBy(F.col("length").desc(), "path")


def with_file_facts(rows: DataFrame, path: Column | None = None) -> DataFrame:
    """Flags and the data source that a file's name and folder tell."""
    p = path if path is not None else F.col("path")
    name = F.lower(F.element_at(F.split(p, "/"), -1))
    folder = F.lower(F.regexp_replace(p, "[^/]*$", ""))
    return rows.withColumns({
        "is_clicker": F.contains(name, F.lit("click")),
        "is_opener": F.contains(name, F.lit("open")) & ~F.contains(name, F.lit("click")),
        "is_validated": name.rlike("certified|verified|validated"),
        "data_source": S.file_source(name, folder),
    })


def sniff(spark: SparkSession, path: str) -> dict:
    """Encoding, delimiter, header, names and field mapping of one file, from its first rows."""
    return {"path": path} | records.facts_of([bytes(r[0]) for r in spark.read.text(path).limit(SAMPLE).select(F.col("value").cast("binary")).collect()])


def quoted_breaks(spark: SparkSession, path: str) -> bool:
    """Whether some line of the file holds an odd number of quotes, as where a quoted cell goes on in the next line."""
    return not spark.read.text(path).filter("(length(value) - length(replace(value, '\"', ''))) % 2 = 1").isEmpty()


def cells_of(record: Column, sep: str) -> Column:
    """The cells of one delimited record: separators inside quotes don't part it, outer quotes go, doubled ones count once."""
    literal = "\\" + sep if sep in "|.*+?()[]{}^$\\" else sep
    parts = F.split(record, literal + '(?=(?:[^"]*"[^"]*")*[^"]*$)', -1)
    return F.transform(parts, lambda c: F.replace(F.regexp_replace(S.strip(c), r'(?s)^"(.*)"$', "$1"), F.lit('""'), F.lit('"')))


def read_csv(spark: SparkSession, path: str, facts: dict | None = None) -> DataFrame:
    """All rows as strings, none dropped: short rows padded with '', cells beyond the names in the array ``overflow``.

    Files with line breaks inside quotes go through ``records.quoted_rows``; all are read by
    as many tasks as they have splits.
    """
    f = facts or sniff(spark, path)
    names = f["names"]
    if quoted_breaks(spark, path):
        rows = records.quoted_rows(spark, path, f["sep"], f["code"], skip_first=f["header"])
        at = lambda i: F.coalesce(S.strip(F.get("cells", F.lit(i))), F.lit(""))
        more = F.transform(F.slice("cells", len(names) + 1, F.greatest(F.size("cells") - len(names), F.lit(0))), S.strip)
        return rows.select(*[at(i).alias(n) for i, n in enumerate(names)], more.alias(OVERFLOW))
    schema = ", ".join(f"`{n}` string" for n in [*names, RAW])
    # A row with another number of cells than names comes with its whole record beside it.
    options = {"sep": f["sep"], "encoding": f["encoding"], "quote": '"', "escape": '"', "header": f["header"], "enforceSchema": True, "columnPruning": False}
    rows = spark.read.options(**options).csv(path, schema=schema, mode="PERMISSIVE", columnNameOfCorruptRecord=RAW)
    none = F.array().cast("array<string>")
    every = cells_of(F.regexp_replace(RAW, r"[\r\n]+$", ""), f["sep"])
    more = F.when(F.col(RAW).isNotNull(), S.let(every, lambda c: F.when(F.size(c) > len(names), F.slice(c, len(names) + 1, F.size(c))).otherwise(none))).otherwise(none)
    return rows.select(*[F.coalesce(S.strip(F.col(f"`{n}`")), F.lit("")).alias(n) for n in names], more.alias(OVERFLOW))


def read_txt(spark: SparkSession, path: str, extras: int = 8) -> DataFrame:
    """Per line: the first cell with @ (else the first) is the e-mail, the others are column_1 and so on; blank lines go.

    Cells beyond ``extras`` others are in the array ``overflow``.
    """
    return loose_rows(spark.read.text(path), extras)


def loose_rows(lines: DataFrame, extras: int = 8) -> DataFrame:
    """As :func:`read_txt`, from a column ``value`` of lines."""
    cells = F.filter(cells_of(F.col("value"), ","), lambda c: c != "")
    rows = lines.select(cells.alias("c")).filter(F.size("c") > 0)
    at = F.array_position(F.transform("c", lambda c: F.contains(c, F.lit("@"))), True)
    rows = rows.withColumn("at", F.greatest(at, F.lit(1)).cast("int"))
    rest = F.filter(F.col("c"), lambda _, i: i != F.col("at") - 1)
    rows = rows.select(F.element_at("c", F.col("at")).alias("email"), rest.alias("c"))
    more = F.when(F.size("c") > extras, F.slice("c", extras + 1, F.size("c"))).otherwise(F.array().cast("array<string>"))
    return rows.select("email", *[F.get("c", F.lit(i)).alias(f"column_{i + 1}") for i in range(extras)], more.alias(OVERFLOW))


def read_zip(spark: SparkSession, path: str) -> DataFrame:
    """(member, line_no, line) of the csv and txt members of ZIP archives, streamed line by line inside the tasks."""

    def lines(batches):
        import zipfile

        import pandas as pd

        for b in batches:
            for content in b["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for m in z.infolist():
                        if m.is_dir() or not m.filename.lower().endswith((".csv", ".txt")):
                            continue
                        name = m.filename.replace("\\", "/").rsplit("/", 1)[-1]
                        with z.open(m) as f:
                            held = []
                            for i, x in enumerate(io.TextIOWrapper(f, "utf-8", "replace")):
                                held.append((name, i, x.rstrip("\r\n")))
                                if len(held) == 10_000:
                                    yield pd.DataFrame(held, columns=["member", "line_no", "line"])
                                    held = []
                            yield pd.DataFrame(held, columns=["member", "line_no", "line"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(lines, "member string, line_no long, line string")


def signed_up(rows: DataFrame, modified: Column) -> DataFrame:
    """Records whose blank ``signup_date`` is the time of their file; ``signup_from_file`` marks them."""
    blank = F.coalesce(S.strip(F.col("signup_date")), F.lit("")) == ""
    return rows.withColumns({"signup_date": F.when(blank, F.date_format(modified, "yyyy-MM-dd HH:mm:ss")).otherwise(F.col("signup_date")), "signup_from_file": blank})


def _modified(spark: SparkSession, path: str) -> Column:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    millis = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getModificationTime()
    return F.timestamp_millis(F.lit(millis).cast("long"))


def to_records(rows: DataFrame, mapping: dict[str, str], file_ordinal: int = 0) -> DataFrame:
    """The fixed record: mapped fields, overflow in custom1 to custom5 (the filled cells, in order, 500 characters at most).

    Rows without an e-mail cell go.
    """
    out = [(F.col(f"`{mapping[f]}`") if f in mapping else F.lit(None).cast("string")).alias(f) for f in RECORD]
    none = F.array().cast("array<string>")
    rest = [F.col(f"`{c}`") for c in rows.columns if c not in mapping.values() and c != OVERFLOW]
    every = F.concat(F.array(*rest) if rest else none, F.col(OVERFLOW) if OVERFLOW in rows.columns else none)
    filled = F.transform(F.filter(every, lambda c: F.coalesce(c, F.lit("")) != ""), lambda c: F.left(c, F.lit(500)))
    more = [F.get(filled, F.lit(i)).alias(f"custom{i + 1}") for i in range(5)]
    return rows.select(*out, *more, F.lit(file_ordinal).alias("file_ordinal"), F.monotonically_increasing_id().alias("row_ordinal")).filter("email IS NOT NULL AND email <> ''")


def read_contacts(spark: SparkSession, path: str, file_ordinal: int = 0) -> DataFrame:
    """Any contact file as fixed records, with what its name tells; blank sign-up dates are the file's time (``signed_up``).

    Members of a ZIP archive are files of their own, with their own names' facts; RAR archives
    give no rows, as no reader for them is at hand.
    """
    low = path.lower()
    if low.endswith(".zip"):
        rows = records.archive_records(spark, path, RECORD)
        both = rows.withColumns({"file_ordinal": F.lit(file_ordinal), "row_ordinal": F.monotonically_increasing_id()})
        return signed_up(with_file_facts(both, F.concat_ws("/", "path", "member")).drop("path", "member", "row"), _modified(spark, path))
    if low.endswith(".rar"):
        rows, mapping = loose_rows(spark.createDataFrame([], "value string")), {"email": "email"}
    elif low.endswith(".txt"):
        rows, mapping = read_txt(spark, path), {"email": "email"}
    else:
        facts = sniff(spark, path)
        rows, mapping = read_csv(spark, path, facts), facts["mapping"]
    return signed_up(with_file_facts(to_records(rows, mapping, file_ordinal), F.lit(path)), _modified(spark, path))


def profile(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per file, in one job: delimiter, header, width, label, e-mail column and its place, bytes of a line, column types."""
    return records.heads(spark, paths)


def profile_tree(spark: SparkSession, root: str) -> DataFrame:
    """The profile of every CSV and TXT file below ``root``, with its length and the rows this makes by its first lines."""
    found = discover(spark, root).filter(F.lower("name").rlike(r"\.(csv|txt)$"))
    paths = [r["path"] for r in found.collect()]  # the file listing, which the driver holds anyway
    if not paths:
        return found.join(spark.createDataFrame([], "path string, delimiter string, email_at int, row_estimate long"), "path")
    heads = profile(spark, paths)
    sizes = found.select(_plain_path(F.col("path")).alias("_p"), "name", "length")
    both = heads.withColumn("_p", _plain_path(F.col("path"))).join(sizes, "_p").drop("_p")
    return both.withColumn("row_estimate", F.ceil(F.col("length") / F.col("line_bytes")).cast("long"))


def _plain_path(c: Column) -> Column:
    """A path without the slashes after its scheme, of which the file sources write different numbers."""
    return F.url_decode(F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), "^([a-z]+:)/+", "$1/"))


def profile_summary(tree: DataFrame) -> DataFrame:
    """(what, value, files): how the delimiters and the places of the e-mail column are spread."""
    parts = F.explode(F.array(*[F.struct(F.lit(n).alias("what"), F.coalesce(F.col(c).cast("string"), F.lit("none")).alias("value")) for n, c in (("delimiter", "delimiter"), ("email_at", "email_at"))]))
    return tree.select(parts.alias("p")).groupBy("p.what", "p.value").agg(F.count("*").alias("files"))


def preview(spark: SparkSession, path: str, rows: int = 10) -> DataFrame:
    """(at, column, type, field, cells): each column of a file with its type, the field it maps to and its first cells."""
    f = sniff(spark, path)
    types, fields = infer.column_types(f["sample"]), {n: k for k, n in f["mapping"].items()}
    out = [(i, n, types[i] if i < len(types) else "empty", fields.get(n), [r[i] if i < len(r) else "" for r in f["sample"][:rows]]) for i, n in enumerate(f["names"])]
    return spark.createDataFrame(out, "at int, column string, type string, field string, cells array<string>")


def choose_small(files: DataFrame, least: int = 100 << 10, most: int = 10 << 20, n: int = 5) -> DataFrame:
    """The smallest files between the two lengths, for a trial run."""
    return files.filter(F.col("length").between(least, most)).orderBy("length", "path").limit(n)
