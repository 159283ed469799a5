"""Quoted line breaks over split borders, archives as files, and profiles of a tree, against Python's csv reader."""

import csv
import io
import random
import zipfile

import pytest

from rosterforge.sources import files, records


@pytest.fixture
def tiny_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    for k, v in zip(keys, ("150", "0"), strict=True):
        spark.conf.set(k, v)
    yield
    for k, v in zip(keys, before, strict=True):
        spark.conf.set(k, v)


def random_csv(seed: int, rows: int, ends: str) -> str:
    r = random.Random(seed)
    cell = lambda: r.choice(["a@b.com", "x", "", 'say ""hi""', "two\nlines", "é;,", 'odd " quote', "long " * r.randint(1, 90), '"', "\n\n", "a\r\nb", ' "late'])
    out = io.StringIO()
    for _ in range(rows):
        cells = []
        for _ in range(r.randint(1, 4)):
            c = cell()
            cells.append(c if r.random() < 0.3 and not set(c) & set(',\n\r') and not c.startswith('"') else '"' + c.replace('"', '""') + '"' + ("tail" if r.random() < 0.1 else ""))
        out.write(",".join(cells) + ends)
    return out.getvalue()


@pytest.mark.parametrize(("seed", "ends", "code"), [(1, "\n", "utf-8"), (2, "\r\n", "utf-8"), (3, "\n", "latin-1"), (4, "\r", "utf-8")])
def test_quoted_breaks_over_splits(spark, tmp_path, tiny_splits, seed, ends, code):
    text = random_csv(seed, 150, ends) + '"never closed,\nlast'
    (tmp_path / "x.csv").write_bytes(text.encode(code))
    want = [r for r in csv.reader(io.StringIO(text, newline="")) if len(r) > 1 or r and r[0].strip(" ")]
    for skip in (False, True):
        got = records.quoted_rows(spark, str(tmp_path / "x.csv"), ",", code, skip)
        rows = sorted((r["block"], r["n"], r["cells"]) for r in got.collect())
        assert [[c.rstrip("\n") for c in r] for *_, r in rows] == [[c.rstrip("\n") for c in r] for r in want[skip:]]
    assert spark.read.text(str(tmp_path / "x.csv")).rdd.getNumPartitions() > 20 or ends == "\r"


def test_two_files_and_a_file_without_rows(spark, tmp_path, tiny_splits):
    texts = {"a.csv": random_csv(5, 40, "\n"), "b.csv": random_csv(6, 40, "\n"), "c.csv": ""}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    got = records.quoted_rows(spark, str(tmp_path), ",", skip_first=True).collect()
    for name, text in texts.items():
        want = list(csv.reader(io.StringIO(text, newline="")))[1:]
        assert sorted(r["cells"] for r in got if r["path"].endswith(name)) == sorted(r for r in want if len(r) > 1 or r and r[0].strip(" "))


def test_one_reader_for_both_kinds_of_file(spark, tmp_path, tiny_splits):
    body = "".join(f'p{i}@b.com,"Ann\n{i}",tx{",more,cells" if i % 7 == 0 else ""}\n' for i in range(60))
    (tmp_path / "x.csv").write_text("Email,First Name,State\n" + body + "last@b.com\n")
    got = {r["email"]: r for r in files.read_contacts(spark, str(tmp_path / "x.csv")).collect()}
    assert len(got) == 61 and got["p7@b.com"]["first_name"] == "Ann\n7" and (got["p7@b.com"]["custom1"], got["p7@b.com"]["custom2"]) == ("more", "cells")
    assert got["last@b.com"]["state"] == "" and got["p8@b.com"]["custom1"] is None


def test_members_of_archives_are_files(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("in/../glenn_click.csv", 'First Name;Email Address;Note;State\nAnn;a@b.com;"two\nlines; one";tx\nEve;e@f.net;;ny;over\n;;;\n')
        z.writestr("plain.csv", "José,Díaz,j@d.com,1 Way\n".encode("latin-1"))
        z.writestr("list.TXT", "x, c@d.org ,y\n\nno mail\n")
        z.writestr("two.bin", "a@b.com")
        z.writestr("empty.csv", "")
    got = {r["email"]: r for r in files.read_contacts(spark, str(tmp_path / "a.zip"), 3).collect()}
    assert set(got) == {"a@b.com", "e@f.net", "j@d.com", "c@d.org", "no mail"}
    a = got["a@b.com"]
    assert (a["first_name"], a["state"], a["custom1"], a["is_clicker"], a["data_source"], a["file_ordinal"]) == ("Ann", "tx", "two\nlines; one", True, "Glenn", 3)
    assert (got["e@f.net"]["custom1"], got["e@f.net"]["custom2"], got["j@d.com"]["first_name"], got["j@d.com"]["address"]) == ("over", None, "José", "1 Way")
    assert (got["c@d.org"]["custom1"], got["c@d.org"]["custom2"], got["c@d.org"]["is_clicker"]) == ("x", "y", False)


def test_profile_of_a_tree(spark, tmp_path):
    (tmp_path / "sub dir").mkdir()
    (tmp_path / "a+b.csv").write_text("Email;State\n" + "a@b.com;tx\n" * 500)
    (tmp_path / "sub dir" / "b.csv").write_text("x,1,c@d.org\n" * 20)
    (tmp_path / "sub dir" / "c.txt").write_text("c@d.org\n")
    tree = files.profile_tree(spark, str(tmp_path))
    got = {r["name"]: r for r in tree.collect()}
    assert {n: (r["delimiter"], r["header"], r["email_at"]) for n, r in got.items()} == {"a+b.csv": (";", True, 0), "b.csv": (",", False, 2), "c.txt": (",", False, 0)}
    assert (got["a+b.csv"]["row_estimate"], got["b.csv"]["row_estimate"], got["b.csv"]["types"][2]) == (501, 20, "email")
    assert {(r["what"], r["value"]): r["files"] for r in files.profile_summary(tree).collect()} == {("delimiter", ";"): 1, ("delimiter", ","): 2, ("email_at", "0"): 2, ("email_at", "2"): 1}
    assert [(r["column"], r["type"], r["field"], r["cells"][:1]) for r in files.preview(spark, str(tmp_path / "a+b.csv")).collect()] == [("Email", "email", "email", ["a@b.com"]), ("State", "state", "state", ["tx"])]
    assert [r["name"] for r in files.choose_small(files.discover(spark, str(tmp_path)), 100, 10_000).collect()] == ["b.csv", "a+b.csv"]
    (tmp_path / "none").mkdir()
    assert files.profile_tree(spark, str(tmp_path / "none")).count() == 0
