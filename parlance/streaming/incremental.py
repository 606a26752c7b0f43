"""Incremental tagging (optional; the original tool has no streaming).

New transcript files arriving in a folder are parsed and tallied as they
come: Structured Streaming reads each new ``*.txt`` whole, and every
micro-batch runs the same batch operators as the tag step (line numbering
uses windows, which a streaming plan cannot hold, so the work happens in
``foreachBatch`` on a static DataFrame).  Output rows are appended as long
tallies ``file_name, speaker_role, tag, cnt`` plus sentence counts.

Progress lives in the query checkpoint (a folder under the shared
``spark.checkpoint.dir``), so a restarted query resumes with the files it
has not committed yet; each batch is written with a batch-id suffix so a
replayed batch overwrites its own output instead of duplicating it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parlance.operators import lines as L
from parlance.operators import tally as T
from parlance.session import ensure_checkpoint_dir
from parlance.sources.corpus import Corpus, split_chunks


def _batch_corpus(batch: DataFrame) -> Corpus:
    path = F.regexp_replace("uri", "^file:", "")
    files = batch.select(path.alias("file_id"), F.element_at(F.split(path, "/"), -1).alias("file_name"),
                         F.regexp_extract(path, "^(.*)/[^/]*$", 1).alias("dir"), path.alias("path"))
    lines = batch.select(path.alias("file_id"), F.split(F.regexp_replace("value", "\r\n?", "\n"), "\n", -1).alias("all"))
    return Corpus(files, split_chunks(lines, "file_id", "all"))


def tally_batch(batch: DataFrame, tags: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Long tallies and sentence counts of one batch of whole files (``uri, value``)."""
    corpus = _batch_corpus(batch)
    lines = L.parse_lines(L.raw_lines(corpus.chunks))
    langs = T.tagging_languages(corpus.files).where(F.col("tagger").isNotNull()).select("file_id", F.col("tagger").alias("lang"))
    units = T.tagging_units(lines, corpus.files).join(langs, "file_id")
    tokens = T.annotate(units, tags=tags)
    names = corpus.files.select("file_id", "file_name")
    tally = T.tag_tally(tokens).join(names, "file_id").drop("file_id")
    sent = T.sentence_counts(tokens).join(names, "file_id").drop("file_id")
    return tally, sent


def start_incremental_tagging(spark: SparkSession, arrivals: str, out_dir: str, tags: DataFrame,
                              checkpoint: str | None = None, available_now: bool = False,
                              max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Start the stream: ``arrivals`` is watched for new ``*.txt`` files;
    tagged with the lexicon ``tags``; results go to ``out_dir/tallies`` and ``out_dir/sentences`` (parquet)."""
    base = ensure_checkpoint_dir(spark)
    checkpoint = checkpoint or os.path.join(base, "incremental-tagging")
    stream = (spark.readStream.format("text").option("wholetext", "true")
              .option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", max_files_per_trigger).load(arrivals)
              .select(F.col("_metadata.file_path").alias("uri"), "value"))

    def write(batch: DataFrame, batch_id: int) -> None:
        tally, sent = tally_batch(batch, tags)
        tally.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
            .parquet(os.path.join(out_dir, "tallies", f"batch_id={batch_id}"))
        sent.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
            .parquet(os.path.join(out_dir, "sentences", f"batch_id={batch_id}"))

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
