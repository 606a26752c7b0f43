"""The answers ledger: only unanswered prompts reach a model, a broken run repeats its open piece alone."""

import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from parlance.operators import answers as AN
from parlance.operators import lines as L
from parlance.operators import models as MD
from parlance.plans import steps as S
from parlance.sources import corpus as C


def _dir():
    return tempfile.mkdtemp(prefix="parlance-ledger-", dir="/tmp")


def _prompts(spark, n, text="text"):
    return spark.createDataFrame([(i, p, "sys", f"{text} {i} {p}") for i in range(n) for p in range(2)], "file_id long, part long, system string, prompt string")


def _model(log, fail_at=None):
    """Answers every prompt and notes each call in a file of its own."""
    def model(frames):
        for f in frames:
            if fail_at is not None and (f["file_id"] == fail_at).any():
                raise ValueError("model broke")
            for i, p in zip(f["file_id"], f["part"]):
                open(f"{log}/{i}-{p}-{os.urandom(4).hex()}", "w").close()
            yield pd.DataFrame({"file_id": f["file_id"], "part": f["part"], "response": ["{OPEN}" if i % 2 else "{PSYCHS}" for i in f["file_id"]]})
    return model


def _asked(log):
    return sorted(tuple(map(int, x.split("-")[:2])) for x in os.listdir(log))


def test_a_rerun_asks_for_nothing_twice(spark):
    d, log = _dir(), _dir()
    ledger = AN.Ledger(spark, d, "types", "bigint")
    assert ledger.ask(_prompts(spark, 5), _model(log)).count() == 10
    assert _asked(log) == [(i, p) for i in range(5) for p in range(2)]
    again = AN.Ledger(spark, d, "types", "bigint")  # a new run, more files: the new ones alone are asked
    got = {(r["file_id"], r["part"]): r["response"] for r in again.ask(_prompts(spark, 7), _model(log)).collect()}
    assert _asked(log) == [(i, p) for i in range(7) for p in range(2)]
    assert got == {(i, p): "{OPEN}" if i % 2 else "{PSYCHS}" for i in range(7) for p in range(2)}
    assert again.ask(_prompts(spark, 2, "changed"), _model(log)).count() == 4  # another text is another prompt
    assert len(_asked(log)) == 18


def test_a_broken_run_keeps_its_pieces(spark):
    d, log = _dir(), _dir()
    ledger = AN.Ledger(spark, d, "types", "bigint")
    late = _prompts(spark, 40).groupBy("file_id").agg(F.min(F.pmod(F.xxhash64("file_id", "part"), F.lit(8))).alias("m")).where("m > 2").first()["file_id"]
    with pytest.raises(Exception, match="model broke"):
        ledger.ask(_prompts(spark, 40), _model(log, fail_at=late), pieces=8)
    kept = {(r["file_id"], r["part"]) for r in ledger.read().collect()}
    assert kept and kept <= set(_asked(log)) and late not in {i for i, _ in kept}
    second = _dir()
    assert ledger.ask(_prompts(spark, 40), _model(second), pieces=8).count() == 80
    assert set(_asked(second)) == {(i, p) for i in range(40) for p in range(2)} - kept and len(_asked(second)) == 80 - len(kept)


def test_latest_stale_and_null_answers(spark):
    prompts = AN.with_hash(_prompts(spark, 3))
    h = {(r["file_id"], r["part"]): r["prompt_hash"] for r in prompts.collect()}
    rows = [(0, 0, h[0, 0], "first", 1), (0, 0, h[0, 0], "second", 2), (0, 1, h[0, 0], "of another part", 1), (1, 0, "old", "stale", 9), (1, 1, h[1, 1], None, 3), (2, 0, h[2, 0], "", 1)]
    table = spark.createDataFrame(rows, "file_id long, part long, prompt_hash string, response string, asked long")
    assert sorted(tuple(r) for r in AN.answered(prompts, table).collect()) == [(0, 0, "second"), (2, 0, "")]
    assert sorted((r["file_id"], r["part"]) for r in AN.pending(prompts, table).collect()) == [(0, 1), (1, 0), (1, 1), (2, 1)]
    log = _dir()
    got = AN.collected(prompts, _model(log), table).collect()
    assert len(got) == 6 and _asked(log) == [(0, 1), (1, 0), (1, 1), (2, 1)]


def _corpus(spark):
    d = _dir()
    name = "NorthnetYA_YA{:05d}_interviewAudioTranscript_{}_day0001_session0001_REDACTED.txt"
    for i, kind in enumerate(["open", "psychs", "open", "psychs"]):
        with open(f"{d}/{name.format(i, kind)}", "w", encoding="utf-8") as f:
            f.write("\n".join(f"S{k % 2 + 1}: some words {i} {k}" for k in range(20)))
    return C.text_file_corpus(spark, d)


def test_steps_with_answers(spark):
    """``verify`` and ``organize`` take their answers from a ledger; the second run asks no model."""
    out, d, log = _dir(), _dir(), _dir()
    corpus = _corpus(spark)
    table = corpus.files.select(F.row_number().over(Window.orderBy("file_name")).cast("long").alias("row_index"),
                                "file_name", F.lit("Participant").alias("speaker_role"), F.split("file_name", "_")[3].alias("interview_type"))

    def says_open(frames):
        for f in frames:
            for i, p in zip(f["file_id"], f["part"]):
                open(f"{log}/0-{p}-{os.urandom(4).hex()}", "w").close()
            yield pd.DataFrame({"file_id": f["file_id"], "response": ["open" if "00001" not in i else "?" for i in f["file_id"]]})

    for run in range(2):
        ledger = AN.Ledger(spark, d, "types")
        got = S.verify(spark, table, corpus, f"{out}/{run}", says_open, type_answers=ledger)
        assert sorted(r["verdict"] for r in got.verdicts.collect()) == ["match", "match", "mismatch", "parse_failure"]
        assert len(_asked(log)) == 4
    only = S.verify(spark, table, corpus, f"{out}/3", type_answers=ledger)  # no model at all
    assert only.accuracy.first()["processed"] == 4
    roles = spark.createDataFrame([], "file_id string, part long, prompt_hash string, response string")
    raw = L.raw_lines(corpus.chunks)
    keyed = AN.with_hash(MD.role_prompts(raw)).select("file_id", "part", "prompt_hash", F.lit("S2: INTERVIEWER\nS1: PARTICIPANT").alias("response"))
    docs = spark.createDataFrame([("some words", "en")], "text string, lang string")
    org = S.organize(spark, corpus, f"{out}/o", docs, role_answers=keyed)
    assert {(r["speaker_role"], r["transcript_speaker_label"]) for r in org.table.collect()} == {("Participant", "S1"), ("Interviewer", "S2")}
    assert MD.classify_roles(raw, answers=roles)[1].count() == 0
