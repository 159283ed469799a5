"""Delimited records across line breaks and splits, members of archives, and file heads, parsed inside tasks.

A quoted cell may hold line breaks, so where a split of a file starts says nothing about
where a record does.  Each split reports, for both cases (it starts inside a quoted cell or
not), how it ends and whether a record starts in it; a scan over these few rows tells which
case holds, and every split is then parsed by itself.  Records that run over a border come as
fragments and are put together.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.sources import infer

#: Rows of a file that inference looks at, and rows of an Arrow batch.
SAMPLE, BATCH = 1000, 10_000


def goes_on(line: str, inside: bool, sep: str) -> bool:
    """Whether a quoted cell is open after ``line``.  A quote opens a cell only as its first character; inside, two are one."""
    at = 0
    while '"' in line:
        if inside:
            at = line.find('"', at)
            while at >= 0 and line.startswith('""', at):
                at = line.find('"', at + 2)
            if at < 0:
                return True
            inside, at = False, line.find(sep, at + 1) + 1
            if not at:
                return False
        if not line.startswith('"', at):
            at = line.find(sep + '"', at) + 1
            if not at:
                return False
        inside, at = True, at + 1
    return inside


def _physical(raw: str) -> list[str]:
    """The lines in a line that ends with a line feed, which may be parted by carriage returns, each with its end."""
    body, end = (raw[:-1], "\r\n") if raw.endswith("\r") else (raw, "\n")
    *some, last = body.split("\r")
    return [*(s + "\r" for s in some), last + end]


def _block_lines(batches, code: str) -> Iterator[tuple[tuple[str, int], str]]:
    for b in batches:
        for raw, path, block in zip(*(c.to_pylist() for c in b.columns)):
            for line in _physical(raw.decode(code, "replace")):
                yield (path, block), line


def _by_block(lines) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """Lines of each split; a split's lines come together and in order."""
    from itertools import groupby

    for key, some in groupby(lines, lambda x: x[0]):
        yield key, (line for _, line in some)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary"), "_metadata.file_path", "_metadata.file_block_start")


def quoted_rows(spark: SparkSession, path: str, sep: str, code: str = "utf-8", skip_first: bool = False) -> DataFrame:
    """(path, block, n, cells) of every record of a file or folder, read by as many tasks as it has splits.

    The cells are those of a csv reader over each whole file; ``block`` and ``n`` give their
    order.  With ``skip_first`` the first record of each file is left out.  A quote that is never
    closed makes one record of all that follows.  The driver sees two booleans per split and case.
    """

    def report(batches):
        for (file, block), some in _by_block(_block_lines(batches, code)):
            state, starts = [False, True], [False, False]
            for line in some:
                starts = [s or not x for s, x in zip(starts, state)]
                state = [goes_on(line, state[0], sep)] * 2 if state[0] == state[1] else [goes_on(line, x, sep) for x in state]
            yield pa.RecordBatch.from_pylist([{"path": file, "block": block, "ends": state, "starts": starts}])

    facts = _lines(spark, path).mapInArrow(report, "path string, block long, ends array<boolean>, starts array<boolean>").collect()
    cases, inside, owner, file = {}, False, -1, None
    for r in sorted(facts):
        if r["path"] != file:
            file, inside, owner = r["path"], False, -1
        cases[r["path"], r["block"]] = (inside, owner)
        owner = r["block"] if r["starts"][inside] else owner
        inside = r["ends"][inside]
    first = {}
    for file, block in sorted(cases, reverse=True):
        first[file] = block

    def parse(batches):
        csv.field_size_limit(sys.maxsize)
        for (file, block), some in _by_block(_block_lines(batches, code)):
            inside, owner = cases[file, block]
            lead, open_lines, n = [], [], 0

            def whole(some=some, lead=lead, open_lines=open_lines, state=inside):
                leading = state
                for line in some:
                    ends = goes_on(line, state, sep)
                    if leading:
                        lead.append(line)
                        leading = ends
                    else:
                        open_lines.append(line)
                        if not ends:
                            yield from open_lines
                            open_lines.clear()
                    state = ends

            held = []
            for cells in csv.reader(whole(), delimiter=sep):
                if not (skip_first and n == 0 and block == first[file]):
                    held.append((file, block, n, cells, None, None))
                n += 1
                if len(held) >= BATCH:
                    yield _batch(held)
                    held = []
            if lead:
                held.append((file, owner, -1, None, block, "".join(lead)))
            if open_lines:
                held.append((file, block, n, None, block, "".join(open_lines)))
            if held:
                yield _batch(held)

    def join(batches):
        csv.field_size_limit(sys.maxsize)
        for b in batches:
            out = []
            for file, block, n, text in zip(*(c.to_pylist() for c in b.columns)):
                rows = list(csv.reader(io.StringIO(text, newline=""), delimiter=sep))
                out += [(file, block, n, c, None, None) for c in rows if not (skip_first and n == 0 and block == first[file])]
            if out:
                yield _batch(out)

    parts = _lines(spark, path).mapInArrow(parse, _PARTS)
    whole = parts.filter("cells IS NOT NULL").select("path", "block", "n", "cells")
    # Two fragments a split at most, but for records longer than a split.
    cut = parts.filter("fragment IS NOT NULL").groupBy("path", "block").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "fragment"))).alias("f"))
    cut = cut.select("path", "block", "n", F.array_join("f.fragment", "").alias("text")).mapInArrow(join, _PARTS)
    return whole.unionByName(cut.select(*whole.columns)).filter("size(cells) > 1 OR (size(cells) = 1 AND trim(cells[0]) <> '')")


_PARTS = "path string, block long, n long, cells array<string>, at long, fragment string"
_PARTS_SCHEMA = pa.schema([("path", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("cells", pa.list_(pa.string())), ("at", pa.int64()), ("fragment", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema = _PARTS_SCHEMA) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)


def facts_of(raw: list[bytes]) -> dict:
    """Encoding, delimiter, header, names and field mapping, from the first lines of a file."""
    code = infer.encoding(b"\n".join(raw))
    lines = [x.decode(code, "replace") for x in raw]
    sep = infer.delimiter(lines)
    rows = [r for r in csv.reader(io.StringIO("\n".join(lines)), delimiter=sep) if r]
    header = bool(rows) and infer.is_header(rows[0])
    width = max(map(len, rows), default=0)
    first = rows[0] if header else [""] * width
    names = infer.unique_names(first) + [f"extra_{i}" for i in range(width - len(first))]
    body = rows[1:] if header else rows
    return {"code": code, "encoding": "ISO-8859-1" if code == "latin-1" else "UTF-8", "sep": sep, "header": header, "names": names, "mapping": infer.map_headers(names, body), "sample": body}


def _csv_records(open_member: Callable, fields: tuple[str, ...]):
    with open_member() as f:
        facts = facts_of([line.rstrip(b"\r\n") for line, _ in zip(f, range(SAMPLE))])
    at = {field: facts["names"].index(name) for field, name in facts["mapping"].items()}
    places, used = [at.get(f) for f in fields], set(at.values())
    with open_member() as f:
        rows = csv.reader(io.TextIOWrapper(f, facts["code"], "replace", newline=""), delimiter=facts["sep"])
        rows = (r for r in rows if r and (len(r) > 1 or r[0].strip()))
        for k, row in enumerate(rows):
            if k or not facts["header"]:
                cells = [c.strip() for c in row]
                padded = cells + [""] * (len(facts["names"]) - len(cells))
                rest = [c for i, c in enumerate(padded) if i not in used and c]
                yield [None if p is None else padded[p] for p in places], rest


def _txt_records(open_member: Callable, fields: tuple[str, ...]):
    with open_member() as f:
        for row in csv.reader(io.TextIOWrapper(f, "utf-8", "replace", newline="")):
            cells = [c.strip() for c in row if c.strip()]
            if cells:
                k = next((i for i, c in enumerate(cells) if "@" in c), 0)
                yield [cells[k] if f == "email" else None for f in fields], cells[:k] + cells[k + 1 :]


def archive_records(spark: SparkSession, path: str, fields: tuple[str, ...]) -> DataFrame:
    """(path, member, row, ``fields``, custom1 to custom5) of the csv and txt members of ZIP archives.

    Every member is a file of its own: its head tells delimiter, encoding, header and mapping,
    then it is streamed through a csv reader, so that quoted line breaks hold.  Rows without
    an e-mail cell go; a member that can't be read gives none.  An archive is one cell of the
    file source, so 2 GB at most, and is read by one task.
    """
    schema = pa.schema([("path", pa.string()), ("member", pa.string()), ("row", pa.int64()), *((f, pa.string()) for f in fields), *((f"custom{i + 1}", pa.string()) for i in range(5))])

    def read(batches):
        import zipfile

        csv.field_size_limit(sys.maxsize)
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1)):
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as z:
                    for m in z.infolist():
                        name = m.filename.replace("\\", "/").rsplit("/", 1)[-1]
                        kind = name.lower().rsplit(".", 1)[-1]
                        if m.is_dir() or kind not in ("csv", "txt"):
                            continue
                        found, held = (_csv_records if kind == "csv" else _txt_records)(lambda m=m: z.open(m), fields), []
                        for k, (values, rest) in enumerate(found):
                            more = [c[:500] for c in rest[:5]]
                            held.append((file, name, k, *values, *more, *[None] * (5 - len(more))))
                            if len(held) >= BATCH:
                                yield _batch(held, schema)
                                held = []
                        if held:
                            yield _batch(held, schema)

    kinds = ", ".join(f"`{f.name}` {'long' if f.name == 'row' else 'string'}" for f in schema)
    rows = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, kinds)
    return rows.filter("email IS NOT NULL AND email <> ''")


def heads(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per file, in one job: delimiter, header, width, names, label, e-mail column and its place, bytes of a line.

    A file's first lines all come to one task, that of its first split; an empty file gives no row.
    """

    def look(batches):
        held: dict[str, list[bytes]] = {}
        for b in batches:
            first = b.filter(pa.array(np.asarray(b.column(2)) == 0))
            for raw, file in zip(first.column(0).to_pylist(), first.column(1).to_pylist()):
                some = held.setdefault(file, [])
                if len(some) < SAMPLE:
                    some.append(raw.rstrip(b"\r"))
        for file, raw in held.items():
            f = facts_of(raw)
            email = f["mapping"].get("email")
            size = sum(len(r) + 1 for r in raw) / len(raw)
            row = (file, f["sep"], f["header"], len(f["names"]), f["names"], infer.schema_label(f["names"], f["mapping"]), email, f["names"].index(email) if email else None, size, infer.column_types(f["sample"]))
            yield _batch([row], schema)

    schema = pa.schema([("path", pa.string()), ("delimiter", pa.string()), ("header", pa.bool_()), ("width", pa.int32()), ("names", pa.list_(pa.string())), ("label", pa.string()), ("email_column", pa.string()), ("email_at", pa.int32()), ("line_bytes", pa.float64()), ("types", pa.list_(pa.string()))])
    kinds = "path string, delimiter string, header boolean, width int, names array<string>, label string, email_column string, email_at int, line_bytes double, types array<string>"
    return _lines(spark, paths).mapInArrow(look, kinds)
