"""The stream of a file's counts: tags are summed up by row of tags before they are read out."""

import re

import pytest

from parlance.operators import tally as T
from parlance.operators import units as U
from parlance.plans import catalog as CAT

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["tally_wide", "tally_vocabulary", "table_filled"])
def test_features_are_read_once_a_row_of_tags(spark, monkeypatch, name):
    """The joined words are summed up by speaker and row of tags, over one lexicon."""
    made, tags = [], CAT.document_tags
    monkeypatch.setattr(CAT, "document_tags", lambda *a: made.append(1) or tags(*a))
    plan = CAT.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Aggregate\(keys=\[[^\]]*speaker#\d+, [^\]]*feats#", plan)
    assert len(made) == 1


def test_sums_equal_tokens(spark):
    """Rows of tags with NULLs, values in two slots, unlisted words, words said often and by several speakers: the counts of tokens."""
    files = spark.createDataFrame([(1, "a/interviewX/1.txt"), (2, "a/audioJournal/2.txt")], "file_id long, path string")
    said = [(1, "PARTICIPANT", "The cat. the CAT ran!"), (1, "PARTICIPANT", "..."), (1, "INTERVIEWER", "ran ran the unlisted"), (1, "UNKNOWN", "cat"),
            (2, "UNKNOWN", "A cat, a diary"), (2, "PARTICIPANT", "the")]
    lines = spark.createDataFrame([(f, s, i, t) for i, (f, s, t) in enumerate(said)], "file_id long, speaker string, line_index long, text string")
    langs = spark.createDataFrame([(1, "en"), (2, "en")], "file_id long, lang string")
    known = spark.createDataFrame([("en", "the", 20000, "the", "DET", "DT", "det", "Definite=Def|PronType=Art"), ("en", "cat", 0, "cat", "NOUN", "NN", "nsubj", None),
                                   ("en", "a", 10000, "a", "DET", "DT", "det", "Definite=Def|PronType=Art"), ("en", "ran", None, "run", "VERB", None, "root", "Mood=Ind|Mood=Imp|Tense=Past"),
                                   ("de", "cat", 5, "cat", "X", "X", "X", None)],
                                  "lang string, word string, lg_e4 long, lemma string, upos string, xpos string, deprel string, feats string")
    tokens = T.annotate(T.tagging_units(lines, files).join(langs, "file_id"), tags=known)
    stream = U.unit_stream(lines.drop("line_index"), files, langs, known)
    by_role = {tuple(r) for r in U.unit_counts(stream).collect()}
    assert by_role == {tuple(r) for r in T.unit_counts(tokens).select("file_id", "speaker_role", "tag", "cnt").collect()} and by_role
    sums = {(r["file_id"], r["unit"], r["tag"]): r["cnt"] for r in stream.where("unit = '*' or unit = 'PARTICIPANT'").collect()}
    assert sums[1, "*", U.FOUND] == 6 and sums[1, "*", U.VALUE] == 60000 and sums[2, "*", U.VALUE] == 40000
    assert sums[1, "PARTICIPANT", U.FOUND] == 4 and sums[1, "PARTICIPANT", U.LINE] == 2
    assert {r["tag"]: r["cnt"] for r in U.unit_counts(U.unit_stream(lines.drop("line_index"), files, langs, known, ["DT"])).where("file_id = 2").collect()} == {"DT": 3, T.SENT: 2, T.WORD: 5}
