"""The step compositions end to end on sf0.001, and the text-file source (A1)."""

import os
import tempfile

from pyspark.sql import functions as F

from parlance.operators import lines as L
from parlance.plans import catalog as CAT
from parlance.plans import steps as S
from parlance.sources import corpus as C
from parlance.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def _out():
    return tempfile.mkdtemp(prefix="parlance-test-", dir="/tmp")


def test_text_file_source_matches_table_corpus(spark):
    """A1: transcripts written as .txt files (CRLF line ends) parse to the same lines."""
    corpus = CAT.fx_corpus(spark, SF)
    raw = L.raw_lines(corpus.chunks)
    files = corpus.files.where(F.col("file_id") < 6).collect()
    root = _out()
    want = {}
    for f in files:
        rows = raw.where(F.col("file_id") == f["file_id"]).orderBy("raw_index").select("raw").collect()
        content = "\n".join(r[0] for r in rows)
        d = os.path.join(root, f["dir"].lstrip("/"))
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f["file_name"]), "w", encoding="utf-8", newline="") as fh:
            fh.write(content.replace("\n", "\r\n"))
        want[f["file_name"]] = [tuple(r) for r in L.parse_lines(raw.where(F.col("file_id") == f["file_id"]))
                                .orderBy("line_index").select("line_index", "speaker", "ts", "text").collect()]
    tc = C.text_file_corpus(spark, root)
    parsed = L.parse_lines(L.raw_lines(tc.chunks)).join(tc.files.select("file_id", "file_name"), "file_id")
    for name, rows in want.items():
        got = [tuple(r) for r in parsed.where(F.col("file_name") == name).orderBy("line_index")
               .select("line_index", "speaker", "ts", "text").collect()]
        assert got == rows, name


def test_steps_end_to_end(spark):
    out = _out()
    conv = read_table(spark, SF, "conversations")
    docs = read_table(spark, SF, "documents")
    raw_corpus = C.conversation_corpus(conv, "raw")
    org = S.organize(spark, raw_corpus, out, docs)
    assert os.path.isdir(os.path.join(out, "transcripts")) and os.path.isdir(os.path.join(out, "preliminary_tsv"))
    n_files = raw_corpus.files.count()
    assert org.table.select("file_name").distinct().count() == n_files

    # tag the organised (relabelled) transcripts in update mode
    organized = S.corpus_from_lines(spark.read.parquet(os.path.join(out, "transcripts")))
    lex = CAT.document_lexicon(spark, SF)
    tagged = S.tag(spark, organized, out, lexicon=lex, table=org.table, languages=org.languages, tags=CAT.document_tags(spark, SF))
    assert tagged.table.count() == org.table.count()

    labelled = C.conversation_corpus(conv, "labelled")
    table = CAT.fx_table(spark, SF)
    ver = S.verify(spark, table, labelled, out)
    acc = ver.accuracy.first()
    assert acc["processed"] == acc["matched"] + acc["mismatched"] + acc["parse_failures"]

    misc = S.verify(spark, table, labelled, os.path.join(out, "misc"), mode="misc")
    assert misc.verdicts.count() == ver.verdicts.count()

    plan = S.fix(spark, ver.mismatches, table, out, dry_run=True)
    assert plan.count() == ver.verdicts.where("verdict = 'mismatch'").count()
    S.fix(spark, ver.mismatches, table, out)
    corrected = spark.read.parquet(os.path.join(out, "corrected_table"))
    assert corrected.count() == table.count()

    summary = S.clean(spark, labelled, out)
    assert summary.first()["files_scanned"] == n_files
    flat = S.organize_flat(spark, table, labelled, out)
    assert flat.agg(F.sum("n_files")).first()[0] == n_files


def test_steps_on_text_files(spark):
    """The README flow on real .txt files (path keys), a status CSV and a SUBTLEX file."""
    import glob
    import shutil
    from parlance.operators import feature_table as FT
    from parlance.sources.tables import read_lexicons, read_status
    d = _out()
    corpus = CAT.fx_corpus(spark, SF, "raw")
    raw = L.raw_lines(corpus.chunks)
    for f in corpus.files.collect():
        rows = raw.where(F.col("file_id") == f["file_id"]).orderBy("raw_index").select("raw").collect()
        p = os.path.join(d, "raw", f["dir"].lstrip("/"))
        os.makedirs(p, exist_ok=True)
        with open(os.path.join(p, f["file_name"]), "w", encoding="utf-8") as fh:
            fh.write("\n".join(r[0] for r in rows))
    CAT._status_rows(spark, SF).select("patient_id", "clinical_status").coalesce(1) \
        .write.option("header", True).csv(os.path.join(d, "status"))
    sub = CAT.subtlex_from_documents(spark, SF).select(
        "Word", "FREQcount", F.lit(0).alias("CDcount"), F.lit(0).alias("FREQlow"), F.lit(0).alias("Cdlow"),
        F.lit(0.0).alias("SUBTLWF"), "Lg10WF", F.lit(0.0).alias("SUBTLCD"), F.lit(0.0).alias("Lg10CD"))
    sub.coalesce(1).write.option("header", True).csv(os.path.join(d, "sub_tmp"))
    os.makedirs(os.path.join(d, "subtlex"))
    shutil.copy(glob.glob(os.path.join(d, "sub_tmp", "part-*.csv"))[0], os.path.join(d, "subtlex", "subtlex_en.csv"))

    files = C.text_file_corpus(spark, os.path.join(d, "raw"))
    status = FT.status_table(read_status(spark, os.path.join(d, "status")))
    org = S.organize(spark, files, os.path.join(d, "s0"), read_table(spark, SF, "documents"), status=status)
    organized = S.corpus_from_lines(spark.read.parquet(os.path.join(d, "s0", "transcripts")))
    lex = read_lexicons(spark, ["en"], os.path.join(d, "subtlex"))
    tagged = S.tag(spark, organized, os.path.join(d, "s1"), lexicon=lex, table=org.table, languages=org.languages, tags=CAT.document_tags(spark, SF))
    ver = S.verify(spark, tagged.table, files, os.path.join(d, "s2"))
    n = files.files.count()
    assert org.table.select("file_name").distinct().count() == n
    assert tagged.table.count() == org.table.count()
    assert tagged.table.where("num_sent <> ''").count() > 0
    assert tagged.table.where("word_freq NOT IN ('', 'nan')").count() > 0
    acc = ver.accuracy.first()
    assert acc["processed"] > 0 and acc["processed"] == acc["matched"] + acc["mismatched"] + acc["parse_failures"]
