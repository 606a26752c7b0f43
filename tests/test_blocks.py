"""The block-decomposed prefix sums give the same ordinals for any block size,
including a hot file spread over many blocks."""

from pyspark.sql import functions as F

from parlance.operators import lines as L
from parlance.plans import catalog as CAT

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_block_size_does_not_change_ordinals(spark):
    corpus = CAT.fx_corpus(spark, SF)
    base = _rows(L.raw_lines(corpus.chunks))
    for b in (1, 2, 3):
        assert _rows(L.raw_lines(corpus.chunks, block_size=b)) == base


def test_hot_file_over_many_blocks(spark):
    # one file of 5,000 chunks (some blank lines, multi-line chunks) next to small files
    n = 5000
    hot = spark.range(n).select(F.lit(7).cast("bigint").alias("file_id"), F.col("id").alias("chunk"),
                                F.when(F.col("id") % 7 == 0, F.array(F.lit(""), F.lit("x y")))
                                .otherwise(F.array(F.concat(F.lit("l"), F.col("id").cast("string"))))
                                .alias("lines"))
    small = spark.range(30).select((F.col("id") % 3).alias("file_id"), F.col("id").alias("chunk"),
                                   F.array(F.lit("a"), F.lit("  ")).alias("lines"))
    chunks = hot.unionByName(small)
    got = L.raw_lines(chunks, block_size=64).where("file_id = 7")
    rows = got.orderBy("raw_index").collect()
    # expected by a plain (single-task) running count, fine at this size
    exp, idx, kept, off = [], 0, 0, 0
    for i in range(n):
        for raw in (["", "x y"] if i % 7 == 0 else [f"l{i}"]):
            idx += 1
            kept += 1 if raw.strip() else 0
            exp.append((idx, raw, kept if raw.strip() else None, off))
            off += len(raw) + 1
    assert [(r["raw_index"], r["raw"], r["line_index"], r["char_offset"]) for r in rows] == exp
    assert rows[-1]["is_last"] and sum(r["is_last"] for r in rows) == 1


def test_role_ordinals_block_size(spark):
    corpus = CAT.fx_corpus(spark, SF)
    lines = L.parse_lines(L.raw_lines(corpus.chunks))
    cols = ["file_id", "line_index", "role_ordinal", "n_role_lines"]
    assert _rows(L.role_line_ordinals(lines, block_size=2).select(*cols)) == \
        _rows(L.role_line_ordinals(lines).select(*cols))
