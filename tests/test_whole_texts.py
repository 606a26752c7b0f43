"""Whole texts are read: cues, speakers and languages that come late; answers of parts combined; the tag flow on files."""

import glob
import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from parlance.operators import feature_table as FT
from parlance.operators import frequency as FQ
from parlance.operators import labels as LB
from parlance.operators import lines as L
from parlance.operators import models as MD
from parlance.operators import verify as V
from parlance.plans import steps as S
from parlance.session import ensure_checkpoint_dir
from parlance.sinks import writers as W
from parlance.sources import corpus as C
from parlance.sources import tables as TB


def _raw(spark, texts):
    chunks = spark.createDataFrame([(k, 0, t.split("\n")) for k, t in texts.items()], "file_id long, chunk long, lines array<string>")
    return L.raw_lines(chunks)


def test_late_cue_speaker_and_language(spark):
    filler = "\n".join(f"S1: plain words number {i} said here" for i in range(3000))       # over 40,000 characters
    texts = {1: f"{filler}\nS2: and how often did that occur?", 2: filler}
    raw = _raw(spark, texts)
    assert {r["file_id"]: r["predicted"] for r in MD.predict_types(raw).collect()} == {1: "PSYCHS", 2: "OPEN"}
    _, roles = MD.classify_roles(raw)
    assert {(r["file_id"], r["original"], r["role"]) for r in roles.collect()} == {(1, "S2", "INTERVIEWER"), (1, "S1", "PARTICIPANT")}
    lex = FQ.corpus_lexicon(spark.createDataFrame([("plain words number said here", "en"), ("ganz anders gesprochen", "de")], "text string, lang string"))
    late = {3: "\n".join(["PARTICIPANT: plain"] * 500 + ["PARTICIPANT: ganz anders gesprochen"] * 900)}
    det = MD.detect_tagger_language(L.parse_lines(_raw(spark, late)), lex).first()
    assert det["detected"] == "de"


def test_prompts_hold_the_whole_text(spark):
    text = "\n".join(["S1: short", "", "S2: " + "x" * 57, "S1: end"])
    raw = _raw(spark, {1: text})
    rows = MD.join_lines(MD.prompt_parts(raw, 20)).orderBy("part").collect()
    assert all(len(r["text"]) <= 20 for r in rows)
    assert "".join(r["text"] for r in rows).replace("\n", "") == text.replace("\n", "")
    prompts = MD.role_prompts(raw, 20).count()
    assert prompts == len(rows)


def test_answers_of_parts(spark):
    rows = [(1, 0, "{OPEN}"), (1, 1, "it is {psychs}"), (1, 2, "psychs I think, or rather open"), (2, 0, "{PSYCHS}"), (2, 1, "{OPEN}"),
            (3, 0, "no idea"), (3, 1, "OPENING"), (4, 0, "nothing"), (4, 1, "open"), (5, 0, "{open} {PSYCHS} {PSYCHS}")]
    got = MD.combine_types(spark.createDataFrame(rows, "file_id long, part long, response string")).collect()
    assert {r["file_id"]: r["predicted"] for r in got} == {1: "OPEN", 2: "PSYCHS", 3: None, 4: "OPEN", 5: "OPEN"}


def test_role_answers_of_parts(spark):
    said = {0: "S1: interviewer\nS2: participant", 1: "nobody", 2: "s2: PARTICIPANT\ns1: INTERVIEWER", 3: "S2: INTERVIEWER\nS1: PARTICIPANT"}

    def model(frames):
        for f in frames:
            yield pd.DataFrame({"file_id": f["file_id"], "response": [said[int(p) % 4] for p in f["part"]]})

    raw = _raw(spark, {1: "\n".join(f"S{i % 2 + 1}: some words" for i in range(40))})
    _, roles = MD.classify_roles(raw, model, chars=160)
    assert {(r["original"], r["role"]) for r in roles.collect()} == {("S1", "INTERVIEWER"), ("S2", "PARTICIPANT")}


def _tree(files):
    d = tempfile.mkdtemp(prefix="parlance-flow-", dir="/tmp")
    for path, text in files.items():
        os.makedirs(os.path.dirname(f"{d}/raw/{path}"), exist_ok=True)
        open(f"{d}/raw/{path}", "w", encoding="utf-8").write(text)
    return d


def failing_tagger(frames):
    for f in frames:
        if f["text"].str.contains("boom").any():
            raise ValueError("model broke")
        yield pd.DataFrame([(r.file_id, r.speaker_role, r.line_index, 1, j + 1, w, w, "NOUN", "NN", "obj", None) for r in f.itertuples() for j, w in enumerate(r.text.split())],
                           columns=["file_id", "speaker_role", "line_index", "sent_id", "word_id", "word", "lemma", "upos", "xpos", "deprel", "feats"])


@pytest.fixture(scope="module")
def flow(spark):
    name = "NorthnetYA_YA{:05d}_interviewAudioTranscript_open_day0001_session0001_REDACTED.txt"
    talk = "INTERVIEWER: what now\nPARTICIPANT: one two two"
    d = _tree({f"a/{name.format(1)}": talk, f"b/{name.format(1)}": talk + "\nPARTICIPANT: two", f"a/{name.format(2)}": "INTERVIEWER: fine\nPARTICIPANT: boom",
               f"a/{name.format(3)}": talk, f"a/{name.format(4)}": talk})
    corpus = C.text_file_corpus(spark, f"{d}/raw")
    langs = corpus.files.select("file_id", F.when(F.col("file_name") == name.format(3), "cn").when(F.col("file_name") == name.format(4), "xx").otherwise("en").alias("language"))
    lex = spark.createDataFrame([("en", "one", 1.0), ("en", "two", 2.0), ("zh", "one", 5.0)], "lang string, word string, log_frequency double")
    return d, name, corpus, langs, lex


def test_tag_flow_on_files(spark, flow):
    d, name, corpus, langs, lex = flow
    out = S.tag(spark, corpus, f"{d}/out", lexicon=lex, languages=langs, predict_tokens=failing_tagger)
    rows = {(r["file_name"], r["speaker_role"]): r for r in out.table.collect()}
    assert rows[name.format(1), "Participant"]["NOUN"] == 4          # the last of two files with one name
    assert float(rows[name.format(1), "Participant"]["word_freq"]) == pytest.approx(7 / 4)   # under the given language, not the folder's
    assert float(rows[name.format(3), "Participant"]["word_freq"]) == 5.0                    # cn: detected first (zh)
    assert (name.format(2), "Participant") not in rows
    fails = {(r["filename"], r["reason"]) for r in out.failures.collect()}
    assert fails == {(name.format(2), "processing_error"), (name.format(4), "unsupported_language")}
    head = open(glob.glob(f"{d}/out/features_tsv/part-*")[0], encoding="utf-8").readline().rstrip("\n").split("\t")
    assert head[0] == "network" and head[-3:] == ["num_sent", "word_freq", "file_name.txt"] and "acl:relcl" in head


def test_participant_only_with_a_vocabulary_and_slice(spark, flow):
    d, name, corpus, langs, lex = flow
    out = S.tag(spark, corpus, f"{d}/out2", lexicon=lex, languages=langs.where("language != 'xx'"), predict_tokens=failing_tagger,
                roles=("Participant",), vocabulary=["NOUN", "NN"], first_per_language=1)
    rows = out.table.collect()
    assert {r["speaker_role"] for r in rows} == {"Participant"} and {r["file_name"] for r in rows} == {name.format(1), name.format(3)}
    assert rows[0].asDict().keys() >= {"NOUN", "NN", "num_sent", "word_freq"} and "obj" not in rows[0].asDict()


def test_language_plug_in(spark):
    def model(frames):
        for f in frames:
            yield f[["file_id", "line_index"]].assign(detected=["de" if "x" in t else "en" for t in f["text"]])
    lines = L.parse_lines(_raw(spark, {1: "PARTICIPANT: x\nPARTICIPANT: x\nPARTICIPANT: y", 2: " "}))
    got = {r["file_id"]: r["detected"] for r in MD.detect_languages(lines, None, model).collect()}
    assert got == {1: "de"}


def test_lexicons_by_column_name(spark):
    d = tempfile.mkdtemp(prefix="parlance-lex-", dir="/tmp")
    open(f"{d}/subtlex_en.csv", "w").write("Lg10WF,Extra,Word,FREQcount\n1.5,z,One,30\n1.04,z,two,10\n")
    open(f"{d}/subtlex_de.csv", "w").write("Word,Lg10WF\nEins,1.5\n")
    got = {(r["lang"], r["word"]): (r["frequency"], r["log_frequency"]) for r in TB.read_lexicons(spark, ["en"], d).collect()}
    assert got == {("en", "one"): (0.75, 1.5), ("en", "two"): (0.25, 1.04)}
    with pytest.raises(ValueError, match="FREQcount"):
        TB.read_subtlex(spark, f"{d}/subtlex_de.csv")
    with pytest.raises(ValueError):
        TB.lexicon_paths(["xx"], d)


def test_unknown_types_moves_and_quotes(spark):
    d = tempfile.mkdtemp(prefix="parlance-fix-", dir="/tmp")
    table = spark.createDataFrame([(0, "a_open_x.txt", "Participant", "open"), (1, "b_x.txt", "Participant", "strange"), (2, "c_psychs_x.txt", "Participant", "psychs")],
                                  "row_index long, file_name string, speaker_role string, interview_type string")
    mism = spark.createDataFrame([(0, "a_open_x.txt", "OPEN", "PSYCHS", 'a "quoted" reason'), (2, "c_psychs_x.txt", None, "OPEN", "Mismatch")],
                                 "row_index long, filename string, expected string, predicted string, reason string")
    W.write_mismatches(mism, f"{d}/m")
    back = TB.read_mismatches(spark, f"{d}/m")
    assert back.exceptAll(mism).count() == 0
    S.fix(spark, back, table, d)
    moved = {r["filename"]: (r["new_filename"], r["new_target"]) for r in spark.read.parquet(f"{d}/moved").collect()}
    assert moved == {"a_open_x.txt": ("a_psychs_x.txt", "psychs"), "c_psychs_x.txt": ("c_psychs_x.txt", "open")}
    lost = spark.read.option("header", "true").option("sep", "\t").csv(f"{d}/unrouted").collect()
    assert [(r["file_name"], r["reason"]) for r in lost] == [("b_x.txt", "unknown_type")]


def test_cleaned_corpus_can_be_read(spark):
    d = _tree({"a/x.txt": "PARTICIPANT hello\nINTERVIEWER: yes"})
    S.clean(spark, C.text_file_corpus(spark, f"{d}/raw"), d)
    corpus = S.corpus_from_lines(spark.read.parquet(f"{d}/cleaned"))
    assert [r["raw"] for r in L.raw_lines(corpus.chunks).orderBy("raw_index").collect()] == ["PARTICIPANT: hello", "INTERVIEWER: yes"]


def test_a_shared_folder_is_asked_for_off_local_masters():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
