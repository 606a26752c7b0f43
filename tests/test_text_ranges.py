"""Transcripts read by byte ranges (A1) equal those read whole; named files alone are opened (D-2)."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from parlance.operators import lines as L
from parlance.plans import steps as S
from parlance.sources import corpus as C

TEXTS = ["", "\n", "one line", "one line\n", "a\r\nb\r\n", "a\rb\rc", "a\rb\r", "a\n\r\nb\r", "﻿marked\nline", "﻿marked\nline\n", "\r\r\n\r", "a\n\n\nb\n\n",
         "S1: é\U0001f600 日本\nS2: x\n" * 40, "S1: " + "long " * 2000, "\x0bvt\x0c ff\x85nel ls\n" * 20, "S1: end\r\n" * 100 + "S2: last"]


def _tree(texts):
    d = tempfile.mkdtemp(prefix="parlance-ranges-", dir="/tmp")
    for k, t in enumerate(texts):
        os.makedirs(f"{d}/{k % 3}", exist_ok=True)
        with open(f"{d}/{k % 3}/t{k}.txt", "w", encoding="utf-8", newline="") as f:
            f.write(t)
    return d


def _lines(corpus):
    raw = L.raw_lines(corpus.chunks).join(corpus.files, "file_id")
    return sorted(tuple(r) for r in raw.select("file_name", "raw_index", "raw", "is_last", "char_offset", "line_index").collect())


@pytest.fixture
def ranges_of(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]

    def to(n):
        spark.conf.set(names[0], n)
        spark.conf.set(names[1], 1)
    yield to
    for n, v in zip(names, old):
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", [7, 100, 1 << 20])
def test_ranges_equal_whole_files(spark, ranges_of, size):
    r = random.Random(size)
    texts = TEXTS + ["".join(r.choice(["S1: word", "\n", "\r\n", "\r", "é", " "]) for _ in range(200)) for _ in range(6)]
    d = _tree(texts)
    whole = _lines(C.text_file_corpus(spark, d, whole_files=True))
    want = {f"t{k}.txt": t.replace("\r\n", "\n").replace("\r", "\n").split("\n") for k, t in enumerate(texts) if t}  # a file of no bytes is none to Spark
    assert [(f, i + 1, x) for f in sorted(want) for i, x in enumerate(want[f])] == [w[:3] for w in whole]
    ranges_of(size)
    assert _lines(C.text_file_corpus(spark, d)) == whole


def test_one_large_file_is_many_tasks(spark, ranges_of):
    d = _tree(["S1: some words to fill the line\n" * 100_000])
    ranges_of(100_000)
    corpus = C.text_file_corpus(spark, d)
    per_task = corpus.chunks.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) >= 8 and max(r["count"] for r in per_task) < 30_000
    assert corpus.chunks.agg(F.count_distinct("chunk")).first()[0] == 100_000


def test_named_files_alone_are_opened(spark):
    d = _tree([f"S1: text {k}\n" * 50 for k in range(30)])
    names = spark.createDataFrame([("t3.txt",), ("t17.txt",), ("t17.txt",), ("absent.txt",)], "file_name string")
    some = C.text_file_corpus(spark, d, names)
    assert sorted(r["file_name"] for r in some.files.collect()) == ["t17.txt", "t3.txt"]
    opened = {f.rsplit("/", 1)[1] for f in some.chunks.inputFiles() if f.endswith(".txt")}
    text_scan = [x for x in some.chunks._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan text" in x]
    assert opened >= {"t3.txt", "t17.txt"} and text_scan and all("2 paths" in x or ("t3.txt" in x and "t17.txt" in x) for x in text_scan)
    assert _lines(some) == [x for x in _lines(C.text_file_corpus(spark, d)) if x[0] in ("t17.txt", "t3.txt")]
    none = C.text_file_corpus(spark, d, names.where("file_name = 'absent.txt'"))
    assert none.files.count() == 0 == none.chunks.count()


def test_update_mode_reads_the_table_files_alone(spark):
    name = "NorthnetYA_YA{:05d}_interviewAudioTranscript_open_day0001_session0001_REDACTED.txt"
    d = tempfile.mkdtemp(prefix="parlance-update-", dir="/tmp")
    for k in range(5):
        with open(f"{d}/{name.format(k)}", "w") as f:
            f.write(f"INTERVIEWER: what\nPARTICIPANT: word{k} word{k}\n")
    table = spark.createDataFrame([(0, name.format(1), "Participant", "open"), (1, name.format(4), "Participant", "open")],
                                  "row_index long, file_name string, speaker_role string, interview_type string")
    corpus = C.text_file_corpus(spark, d, table)
    tags = spark.createDataFrame([("en", f"word{k}", 0.2, "w", "NOUN", "NN", "obj", None) for k in range(5)],
                                 "lang string, word string, frequency double, lemma string, upos string, xpos string, deprel string, feats string")
    langs = corpus.files.select("file_id", F.lit("en").alias("language"))
    out = S.tag(spark, corpus, f"{d}/out", table=table, languages=langs, tags=tags).table.collect()
    assert {(r["file_name"], r["NOUN"]) for r in out} == {(name.format(1), "2"), (name.format(4), "2")}
