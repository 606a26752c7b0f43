"""Delimited tables with line breaks in cells, read by byte ranges: equal to Python's csv at any range size."""

import csv
import glob
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from parlance.operators import feature_table as FT
from parlance.operators import frequency as FQ
from parlance.plans import steps as S
from parlance.sources import delimited as D
from parlance.sources import tables as TB

CELLS = ["", "a", "line\nbreak", 'a "quote" b', '"', '""', "sep,here", "tab\there", "\n", "\n\n", "é\U0001f600", "x" * 300, "crlf\r\nin", '",\n"', "a,b\nc\"d,", " pad "]


def _dir():
    return tempfile.mkdtemp(prefix="parlance-csv-", dir="/tmp")


def _read(path, sep):
    out, at = [], 0
    for f in sorted(glob.glob(f"{path}/*.csv")):
        with open(f, encoding="utf-8", newline="") as fh:
            for row in [r for r in csv.reader(fh, delimiter=sep) if r][1:]:
                out.append((at, row))
                at += 1
    return out


@pytest.fixture
def split_bytes(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")

    def to(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield to
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


@pytest.mark.parametrize("sep,end,size", [(",", "\n", 64), (",", "\r\n", 200), ("\t", "\n", 1000), (",", "\n", 5000), ("\t", "\r\n", 1 << 20)])
def test_equal_to_csv(spark, split_bytes, sep, end, size):
    r, d = random.Random(size), _dir()
    for k, n in enumerate((60, 1, 35)):
        with open(f"{d}/part-{k}.csv", "w", encoding="utf-8", newline="") as f:
            w = csv.writer(f, delimiter=sep, lineterminator=end, quoting=r.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
            w.writerow(["c1", "c2", "c3"])
            for _ in range(n):
                w.writerow(["k" + r.choice(CELLS), r.choice(CELLS), r.choice(CELLS)])
                if r.random() < 0.1:
                    f.write(end)  # blank lines are no rows
    split_bytes(size)
    got = D.rows(spark, d, sep)
    if size < 5000:
        assert got.rdd.getNumPartitions() > 4
    assert sorted((x["row_index"], [x["c1"], x["c2"], x["c3"]]) for x in got.collect()) == _read(d, sep)


def test_loose_quotes_and_short_rows(spark, split_bytes):
    """Quotes that open no cell, text behind a closed one, an unfinished cell at the end."""
    d = _dir()
    rows = ['h1,h2', '5" disk,"a""b"tail', 'x"y"z,"two', 'lines"', 'only', '"a"","b', ',"",', '"open, until the', 'end of the ""file']
    with open(f"{d}/a.csv", "w", newline="") as f:
        f.write("\n".join(rows))
    for size in (8, 20, 4096):
        split_bytes(size)
        got = D.records(spark, d, ",").where("row_index >= 0").orderBy("row_index").collect()
        assert [(x["row_index"], x["cells"]) for x in got] == _read(d, ",")
    assert D.parsed('a\rb,"c\rd""e"f,', ",") == ["a\rb", 'c\rd"ef', ""]


def test_row_order_over_part_files(spark, split_bytes):
    """Last row wins by place in the table, over part files by name and at any range size."""
    d = _dir()
    for k in range(3):
        with open(f"{d}/part-{k}.csv", "w") as f:
            f.write("clinical_status,extra,patient_id\n" + "".join(f'{"CHR" if k == 2 else "HC"},"a\nb",P{i}\n' for i in range(50 - 20 * k)) + f"HC,,Q{k}\n")
    split_bytes(100)
    got = {r["patient_id"]: r["clinical_group"] for r in FT.status_table(TB.read_status(spark, d)).collect()}
    assert got == {**{f"P{i}": "CHR" if i < 10 else "HC" for i in range(50)}, "Q0": "HC", "Q1": "HC", "Q2": "HC"}
    with pytest.raises(ValueError, match="no column when"):
        D.rows(spark, d, ",", wanted=["when"])


def test_lexicon_readers_writer_and_build(spark, split_bytes):
    """A6, A7, B6, F7, L6 on files."""
    d = _dir()
    os.makedirs(f"{d}/sub")
    with open(f"{d}/sub/a.csv", "w") as f:
        f.write("Lg10WF,Word,FREQcount\n" + "".join(f"{i}.5,w{i},{i + 1}\n" for i in range(40)) + "7.25,W3,10\n")
    with open(f"{d}/anc.txt", "w") as f:
        f.write("the\tthe\tDT\t30\nruns\trun\tVBZ\t10\n")
    split_bytes(64)
    sub = TB.read_subtlex(spark, f"{d}/sub")
    built = {r["word"]: r["log_frequency"] for r in S.build_lexicon(spark, sub, "en", f"{d}/out").collect()}
    assert built["w3"] == 7.25 and built["w4"] == 4.5 and len(built) == 40
    back = spark.read.parquet(f"{d}/out/lexicon")
    assert back.where("lang = 'en'").count() == 41 and abs(back.agg(F.sum("frequency")).first()[0] - 1) < 1e-12
    anc = FQ.anc_lexicon(TB.read_anc(spark, f"{d}/anc.txt")).collect()
    assert {(r["word"], r["lemma"], r["pos"], r["count"], r["frequency"]) for r in anc} == {("the", "the", "DT", 30, 0.75), ("runs", "run", "VBZ", 10, 0.25)}
