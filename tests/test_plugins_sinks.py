"""Plug-in predictors run through mapInPandas; sinks round-trip through the sources."""

import glob
import os
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from parlance.functions.tags import safe_names
from parlance.operators import feature_table as FT
from parlance.operators import lines as L
from parlance.operators import models as MD
from parlance.operators import tally as T
from parlance.plans import catalog as CAT
from parlance.sinks import writers as W
from parlance.sources.tables import read_feature_table

SF = "/root/testdata/sf0.001"


def fixed_role_model(batches):
    for b in batches:
        assert b["prompt"].str.contains("<transcript>").all() and (b["part"] >= 0).all()
        yield pd.DataFrame({"file_id": b["file_id"], "response": "s2: interviewer\nS1: Participant"})


def test_role_predictor_plugin(spark):
    _, raw = CAT.fx_raw(spark, SF, "raw")
    answers, roles = MD.classify_roles(raw, predict=fixed_role_model)
    r = roles.groupBy("role").count().collect()
    assert {x["role"] for x in r} == {"INTERVIEWER", "PARTICIPANT"}
    assert answers.select("file_id").distinct().count() == raw.select("file_id").distinct().count()


def braced_type_model(batches):
    for b in batches:
        yield pd.DataFrame({"file_id": b["file_id"],
                            "response": ["thinking... {psychs}" if i % 2 else "It is OPEN." for i in b["file_id"]]})


def test_type_predictor_plugin(spark):
    _, raw = CAT.fx_raw(spark, SF)
    got = {r["file_id"]: r["predicted"] for r in MD.predict_types(raw, braced_type_model, thinking="high").collect()}
    assert got and all(v == ("PSYCHS" if k % 2 else "OPEN") for k, v in got.items())


def whitespace_tagger(batches):
    for b in batches:
        rows = []
        for r in b.itertuples():
            for j, w in enumerate(r.text.split()):
                rows.append((r.file_id, r.line_index, 1, j + 1, w, w.lower(), "NOUN", "NN", "obj",
                             "Number=Sing", r.speaker_role))
        yield pd.DataFrame(rows, columns=["file_id", "line_index", "sent_id", "word_id", "word", "lemma",
                                          "upos", "xpos", "deprel", "feats", "speaker_role"])


def test_tagger_plugin(spark):
    corpus, lines = CAT.fx_lines(spark, SF)
    units = T.tagging_units(lines, corpus.files).withColumn("lang", F.lit("en"))
    toks = T.annotate(units, whitespace_tagger)
    tally = {r["tag"]: r["n"] for r in T.tag_tally(toks).groupBy("tag").agg(F.sum("cnt").alias("n")).collect()}
    n = toks.count()
    assert tally == {"NOUN": n, "NN": n, "obj": n, "Sing": n}


def test_feature_table_round_trip(spark):
    out = tempfile.mkdtemp(prefix="parlance-sink-", dir="/tmp")
    table = FT.empty_features(CAT.fx_table(spark, SF)).drop("row_index")
    W.write_feature_table(table, os.path.join(out, "safe"), raw_header=False)
    W.write_feature_table(table, os.path.join(out, "raw"), raw_header=True)
    header = open(glob.glob(os.path.join(out, "raw", "part-*.csv"))[0], encoding="utf-8").readline().rstrip("\n")
    cols = header.split("\t")
    assert "PART" in cols and "Part" in cols and "acl:relcl" in cols and "p1" in cols and "file_name.txt" in cols
    assert cols[0] == "network" and cols[-3:] == ["num_sent", "word_freq", "file_name.txt"]
    safe_cols = W.feature_table_columns()
    back = read_feature_table(spark, os.path.join(out, "safe"), safe_cols, sep="\t")
    assert back.count() == table.count()
    assert back.where(F.col(safe_names()["PART"]) != "").count() == 0      # empty cells read back as ''


def test_raw_header_table_reads_back(spark):
    from parlance.sources.tables import read_feature_table_auto, safe_header
    out = tempfile.mkdtemp(prefix="parlance-sink-", dir="/tmp")
    table = FT.empty_features(CAT.fx_table(spark, SF)).drop("row_index")
    W.write_feature_table(table, os.path.join(out, "raw"), raw_header=True)
    back = read_feature_table_auto(spark, os.path.join(out, "raw"), sep="\t")
    assert [c for c in back.columns if c != "row_index"] == W.feature_table_columns()
    assert back.select(*table.columns).exceptAll(table).count() == 0
    assert sorted(r[0] for r in back.select("row_index").collect()) == list(range(table.count()))   # consecutive over part files
    # the original's preliminary header repeats three tags
    assert safe_header(["Fin", "Fin", "Neut", "PART", "Part", "file_name.txt"]) == \
        ["Fin", "Fin__2", "Neut", "PART_2", "Part", "file_name"]


def test_a_vocabulary_file_feeds_the_tallies(spark):
    """A5: distinct tags in file order, blank lines dropped; the tagging step has a column for each of them and no other."""
    import pytest
    from parlance.functions.tags import listed
    from parlance.plans import steps as S
    from parlance.sources.tables import read_vocab
    out = tempfile.mkdtemp(prefix="parlance-vocab-", dir="/tmp")
    with open(os.path.join(out, "tags.txt"), "w", encoding="utf-8") as fh:
        fh.write("VERB\nnsubj\n\nNOUN\n  \nVERB\nnoun\n")
    table = read_vocab(spark, os.path.join(out, "tags.txt"))
    assert listed(table) == ["VERB", "nsubj", "NOUN", "noun"]
    with pytest.raises(ValueError):
        listed(table, most=3)
    with pytest.raises(ValueError):
        listed(table.limit(0))
    tags = CAT.document_tags(spark, SF)
    tagged = S.tag(spark, CAT.fx_corpus(spark, SF), out, tags=tags, vocabulary=table).table
    names = list(safe_names(listed(table)).values())
    assert names == ["VERB", "nsubj", "NOUN", "noun_2"] and [c for c in tagged.columns if c in safe_names().values() or c in names] == names
    assert tagged.agg(F.sum(F.col("VERB").cast("long"))).first()[0] > 0 == tagged.agg(F.sum(F.col("noun_2").cast("long"))).first()[0]
