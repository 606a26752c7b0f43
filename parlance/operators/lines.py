"""Transcript text -> line tables.

A transcript arrives as *chunks*: contiguous runs of raw lines in file order
(``file_id, chunk, lines ARRAY<STRING>``).  A text file read whole is one
chunk; a conversation table gives one chunk per turn, so a long transcript is
never gathered into one row.

File-wide ordinals (1-based index over all lines, over non-blank lines, char
offset) are running sums over the chunk order.  They are computed with a
two-level (block) prefix sum so that no window partition holds a whole file:

* in-block running sums: window ``partitionBy(file_id, block)``, at most
  ``block_size`` chunks per partition;
* block totals: ``groupBy(file_id, block)`` (partial aggregation map-side);
* block offsets: window ``partitionBy(file_id)`` over the block totals, which
  are ``block_size`` times fewer rows than the chunks;
* one equi-join on ``(file_id, block)`` puts them together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.text import is_blank, line_speaker, line_text, line_timestamp, strip_ws

BLOCK_SIZE = 1024


def running_offsets(df: DataFrame, key: str, order: list[str], block: str, measures: list[str],
                    block_sums: DataFrame | None = None) -> DataFrame:
    """Add ``<m>_before`` (exclusive running sum in ``order`` within ``key``) and
    ``<m>_total`` for every measure column, block-decomposed (see module doc).

    ``block_sums`` (``key, block, <m>...``) may be given when the caller can
    compute block totals more cheaply than from ``df`` (e.g. from chunk arrays).
    """
    w_in = (Window.partitionBy(key, block).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, -1))
    inner = df.select("*", *[F.coalesce(F.sum(m).over(w_in), F.lit(0)).alias(f"_{m}_in")
                             for m in measures])
    if block_sums is None:
        block_sums = df.groupBy(key, block).agg(*[F.sum(m).alias(m) for m in measures])
    blocks = block_sums.select(key, block, *[F.col(m).alias(f"_{m}_b") for m in measures])
    w_blk = Window.partitionBy(key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(key)
    blocks = blocks.select(
        key, block,
        *[F.coalesce(F.sum(f"_{m}_b").over(w_blk), F.lit(0)).alias(f"_{m}_boff") for m in measures],
        *[F.sum(f"_{m}_b").over(w_all).alias(f"{m}_total") for m in measures])
    out = inner.join(blocks, [key, block])
    return out.select(
        *[c for c in inner.columns if not c.startswith("_") or c == block],
        *[(F.col(f"_{m}_boff") + F.col(f"_{m}_in")).alias(f"{m}_before") for m in measures],
        *[F.col(f"{m}_total") for m in measures])


def raw_lines(chunks: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """Every ``\\n``-separated raw line of every file, in file order.

    Output: ``file_id, raw_index (1-based), raw, is_last, char_offset (0-based
    offset of the line in the file text), line_index`` (1-based ordinal among
    non-blank lines, NULL for a blank line).

    Block totals come straight from the chunk arrays (size, non-blank count,
    summed length), so that branch never explodes lines.
    """
    blk = F.floor(F.col("chunk") / F.lit(block_size)).alias("_blk")
    # One shared base for both branches, with the join keys' null filters
    # stated up front: Spark then infers no extra filter on either side, the
    # two branches stay identical below their first exchange and AQE runs
    # the scan + shuffle once.  Chunks are never empty arrays (``split`` gives
    # at least ``['']``), so the outer explode (which adds no size filter) is exact.
    base = chunks.select("file_id", "chunk", blk, "lines") \
        .where(F.col("file_id").isNotNull() & F.col("_blk").isNotNull())
    exploded = base.select("file_id", "chunk", "_blk", F.posexplode_outer("lines").alias("pos", "raw"))
    measured = exploded.select(
        "*", F.lit(1).cast("bigint").alias("n"),
        F.when(is_blank("raw"), 0).otherwise(1).cast("bigint").alias("kept"),
        (F.length("raw") + 1).cast("bigint").alias("chars"))
    per_chunk = base.select(
        "file_id", "_blk", F.size("lines").cast("bigint").alias("n"),
        F.size(F.filter("lines", lambda x: ~is_blank(x))).cast("bigint").alias("kept"),
        F.aggregate("lines", F.lit(0).cast("bigint"),
                    lambda acc, x: acc + F.length(x) + 1).alias("chars"))
    block_sums = per_chunk.groupBy("file_id", "_blk").agg(
        *[F.sum(m).alias(m) for m in ("n", "kept", "chars")])
    off = running_offsets(measured, "file_id", ["chunk", "pos"], "_blk", ["n", "kept", "chars"], block_sums)
    raw_index = F.col("n_before") + 1
    return off.select(
        "file_id",
        raw_index.alias("raw_index"),
        "raw",
        (raw_index == F.col("n_total")).alias("is_last"),
        F.col("chars_before").alias("char_offset"),
        F.when(F.col("kept") == 1, F.col("kept_before") + 1).alias("line_index"))


def spoken_lines(chunks: DataFrame) -> DataFrame:
    """C9 without ordinals, for counts that don't ask where a line stands: ``file_id, speaker, text`` of the non-blank lines,
    straight from the chunks (no window, join or shuffle)."""
    raw = chunks.where(F.col("file_id").isNotNull()).select("file_id", F.explode("lines").alias("raw")).where(~is_blank("raw"))
    s = raw.select("file_id", strip_ws("raw").alias("_s"))
    return s.select("file_id", line_speaker("_s").alias("speaker"), line_text("_s").alias("text"))


def parse_lines(raw: DataFrame) -> DataFrame:
    """Non-blank lines with speaker, timestamp and text.

    Output: ``file_id, line_index, raw_index, speaker, ts, text``.
    """
    s = strip_ws("raw")
    return (raw.where(F.col("line_index").isNotNull())
            .select("file_id", "line_index", "raw_index", "raw", s.alias("_s"))
            .select("file_id", "line_index", "raw_index",
                    line_speaker("_s").alias("speaker"),
                    line_timestamp("_s").alias("ts"),
                    line_text("_s").alias("text")))


def role_lines(lines: DataFrame, role: str) -> DataFrame:
    """Lines of one speaker role, with their ordinal among that role's lines."""
    return lines.where(F.col("speaker") == role)


def role_line_ordinals(lines: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """Ordinal of each line among its speaker's lines and among all lines,
    plus per-file counts per speaker (for "first N participant lines" rules).

    Adds ``role_ordinal`` and ``n_role_lines`` (lines of that speaker in the file).
    """
    df = lines.select("*", F.floor(F.col("line_index") / F.lit(block_size)).alias("_blk"),
                      F.lit(1).cast("bigint").alias("one"))
    # key = (file, speaker) so the hot file is split by speaker and by block
    df = df.withColumn("_fs", F.struct("file_id", "speaker"))
    off = running_offsets(df, "_fs", ["line_index"], "_blk", ["one"])
    return off.select(
        *[c for c in lines.columns],
        (F.col("one_before") + 1).alias("role_ordinal"),
        F.col("one_total").alias("n_role_lines"))
