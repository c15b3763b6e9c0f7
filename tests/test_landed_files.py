"""Large files read in splits: JSON matrices and sheet sets."""

import json
import random

import pytest
from pyspark.sql import functions as F

from panelspark.sources import readers
from panelspark.sources import damaged_sheet_rows, matrix_rows, numbered_lines, read_json_matrix, read_sheet_set


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 2000)
    spark.conf.set("spark.sql.files.openCostInBytes", 100)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_lines_are_numbered_across_splits(spark, small_splits, tmp_path):
    r = random.Random(1)
    texts = {f"f{i}.txt": [f"{k} " + "x" * r.randrange(0, 90) for k in range(n)] for i, n in enumerate((400, 1, 0, 77))}
    for name, lines in texts.items():
        (tmp_path / name).write_text("".join(f"{x}\n" for x in lines))
    lines, splits = numbered_lines(spark, str(tmp_path), per_split={"most": F.max(F.length("value"))})
    got = sorted((x["source"], x["at"], x["value"]) for x in lines.collect())
    assert got == sorted((name, k, x) for name, own in texts.items() for k, x in enumerate(own))
    assert lines.rdd.getNumPartitions() > 8
    assert max(x["most"] for x in splits.collect()) == max(map(len, sum(texts.values(), [])))


def matrix(seed, n, style):
    r = random.Random(seed)
    cell = lambda: r.choice(["plain", "a ] b", "]", "[", '"', '\\"]', "\\", "],[", "", None, 5, 1.5, "é]\n[", "x" * 60])
    rows = [["NAME", "A]", "B", "A]", 'q"']] + [[f"n{k}", *[cell() for _ in range(r.choice([4, 4, 4, 2, 5]))]] for k in range(n)]
    if style == "one line":
        return json.dumps(rows, ensure_ascii=False)
    if style == "a row a line":
        return "[" + ",\n".join(json.dumps(x) for x in rows) + "]\n"
    return "﻿[\n  [\n" + "\n  ],\n  [\n".join(",\n".join("    " + json.dumps(c) for c in x) for x in rows) + "\n  ]\n]\n"


@pytest.mark.parametrize("keys", [["NAME", "A]", "B", 'q"', "absent"], None])
def test_split_matrices_equal_whole_ones(spark, small_splits, tmp_path, keys):
    plain = tmp_path / "m"
    plain.mkdir()
    for i, style in enumerate(("one line", "a row a line", "spread")):
        for n in (0, 1, 300):
            (plain / f"m{i}_{n}.json").write_text(matrix(i * 10 + n, n, style), encoding="utf-8")
    (plain / "empty.json").write_text("[]")
    (plain / "header.json").write_text('[["NAME"]]')
    own = read_json_matrix(spark, str(plain), keys)
    files = spark.createDataFrame([(f.name, json.dumps(json.loads(f.read_text(encoding="utf-8-sig")))) for f in plain.iterdir()], "source string, value string")
    as_rows = lambda df: sorted((str(r) for r in df.collect()))
    assert as_rows(own) == as_rows(matrix_rows(files, keys)) and own.count() == 3 * 301
    lines, _ = numbered_lines(spark, str(plain / "m0_300.json"), sep="]")
    assert lines.rdd.getNumPartitions() > 3          # one file is many tasks' work


@pytest.mark.parametrize("broadcast", [True, False])
def test_texts_longer_than_splits_and_texts_never_closed(spark, small_splits, tmp_path, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(readers, "fits_broadcast", lambda df: False)
    long = 'x] " [,\\' * 1500                                  # over several splits
    rows = [["A", "B"]] + [[f"{k}]" * (k % 3), long if k in (0, 7, 8) else "[y"] for k in range(40)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "b.json").write_text(json.dumps([["]" * 3000 + "A", "B"], ["1", "2"]]))       # so is the header
    (tmp_path / "c.json").write_text('[["A","B"],' + '["1","a ] b"],' * 300 + '["open],["2","x"],' + ",".join(['["3","y"]'] * 300) + "]")
    (tmp_path / "d.json").write_text('[["A,["1","2"]]')                                     # a header that is no JSON, and no row
    got = sorted((r["source"], r["A"], r["B"]) for r in read_json_matrix(spark, str(tmp_path), ["A", "B"]).fillna("NULL").collect())
    whole = [("a.json", a, b) for a, b in rows[1:]] + [("b.json", "NULL", "2")]
    assert got == sorted(whole + [("c.json", "1", "a ] b")] * 300 + [("c.json", "NULL", "NULL"), ("c.json", "2", "x")] + [("c.json", "3", "y")] * 300)


def test_only_rows_at_the_ends_of_splits_are_gathered(spark, tmp_path, monkeypatch):
    for i in range(3):
        (tmp_path / f"m{i}.json").write_text(json.dumps([["A", "B"]] + [[f"{k}", "a ] b"] for k in range(2000)]))
    frame = type(spark.range(1))
    kept, checkpoint = [], frame.checkpoint

    def counting(df, *args, **kwargs):
        out = checkpoint(df, *args, **kwargs)
        kept.append(out.count())
        return out
    monkeypatch.setattr(frame, "checkpoint", counting)
    rows = read_json_matrix(spark, str(tmp_path), ["A", "B"])
    assert rows.count() == 6000 and rows.where("B = 'a ] b'").count() == 6000
    assert kept and max(kept) <= 100                               # a row per split, and the pieces at its ends; not every torn row


def test_title_rows_go_exactly_and_damaged_rows_stay(spark, small_splits, tmp_path):
    body = [f"20{k % 30:02},{k % 12 + 1},AK,T,\"Coal, hard\",{k}" for k in range(300)]
    body[7], body[150] = "20x1,2,AK,T,Coal,n/a", ",,,,,"
    (tmp_path / "old.csv").write_text("YEAR,MONTH,STATE,TYPE,SOURCE,GENERATION\n" + "\n".join(body) + "\n\n")
    (tmp_path / "new.csv").write_text("2001 report\n2001,1,title,x,y,5\n\nunits\nYEAR,MONTH,STATE,TYPE,SOURCE,GENERATION\n" + "\n".join(body) + "\n")
    (tmp_path / "EnergySource_Notes.csv").write_text("2001,1,AK,T,Coal,5\n")
    rows = read_sheet_set(spark, str(tmp_path), title_rows={"new": 4})
    report = {r["sheet"]: (r["rows"], r["damaged"]) for r in damaged_sheet_rows(rows).collect()}
    assert report == {"old": (300, 2), "new": (300, 2)}
    assert rows.where("energysource = 'Coal, hard'").count() == 596
    assert read_sheet_set(spark, str(tmp_path), title_rows=4).where("sheet = 'new'").count() == 300
    # without numbers: from the first row whose year and value are numbers; the title that looks like data is one
    found = {r["sheet"]: r["rows"] for r in damaged_sheet_rows(read_sheet_set(spark, str(tmp_path))).collect()}
    assert found == {"old": 300, "new": 303}
