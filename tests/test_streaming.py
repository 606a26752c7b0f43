"""Incremental tagging picks up files as they arrive and equals the batch tally."""

import os
import tempfile

from pyspark.sql import functions as F

from parlance.operators import lines as L
from parlance.operators import tally as T
from parlance.plans import catalog as CAT
from parlance.streaming.incremental import start_incremental_tagging

SF = "/root/testdata/sf0.001"


def test_incremental_tagging_matches_batch(spark):
    corpus = CAT.fx_corpus(spark, SF)
    raw = L.raw_lines(corpus.chunks)
    files = corpus.files.where(F.col("file_id") < 8).collect()
    root = tempfile.mkdtemp(prefix="parlance-stream-", dir="/tmp")
    arrivals, out = os.path.join(root, "in"), os.path.join(root, "out")
    ckpt = os.path.join(root, "ckpt")

    def drop(fs):
        for f in fs:
            rows = raw.where(F.col("file_id") == f["file_id"]).orderBy("raw_index").select("raw").collect()
            d = os.path.join(arrivals, f["dir"].lstrip("/"))
            os.makedirs(d, exist_ok=True)
            with open(os.path.join(d, f["file_name"]), "w", encoding="utf-8") as fh:
                fh.write("\n".join(r[0] for r in rows))

    tags = CAT.document_tags(spark, SF)
    drop(files[:4])
    start_incremental_tagging(spark, arrivals, out, tags, ckpt, available_now=True).awaitTermination()
    drop(files[4:])
    start_incremental_tagging(spark, arrivals, out, tags, ckpt, available_now=True).awaitTermination()

    written = spark.read.parquet(os.path.join(out, "tallies"))
    assert written.select("batch_id").distinct().count() >= 2      # the second run only took new files
    got = written.drop("batch_id")
    ids = [f["file_id"] for f in files]
    lines = L.parse_lines(L.raw_lines(corpus.chunks.where(F.col("file_id").isin(ids))))
    units = CAT._tagging_units(lines, corpus.files, T.tagging_languages(corpus.files))
    want = T.tag_tally(T.annotate(units, tags=tags)).join(corpus.files.select("file_id", "file_name"), "file_id") \
        .drop("file_id")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
