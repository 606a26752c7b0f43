"""Summaries observed on writes (F9-F11): the rows of the group-by, in the write's own job."""

import tempfile

import pytest
from pyspark.sql import functions as F

from parlance.operators import verify as V
from parlance.plans import catalog as CAT
from parlance.sinks.observed import Counted

SF = "/root/testdata/sf0.001"


def _path():
    return tempfile.mkdtemp(prefix="parlance-test-", dir="/tmp") + "/t"


def _rows(df):
    return {tuple(r) for r in df.collect()}


def test_observed_rows_equal_the_group_by(spark):
    disk, table = CAT.lookup_scenario(spark, SF)
    flat = V.flat_by_type(table, V.file_index(disk), mode="diary_first", normalized=True)
    counted = V.counted_copies(flat)
    counted.df.write.parquet(_path())
    assert counted.table().columns == V.copy_summary(flat).columns
    assert _rows(counted.table()) == _rows(V.copy_summary(flat)) != set()
    routed = V.route(CAT.fx_table(spark, SF), "type_first")
    splits = V.counted_splits(routed)
    splits.df.write.partitionBy("target").csv(_path())
    assert _rows(splits.table()) == _rows(V.split_counts(routed)) != set()


@pytest.mark.parametrize("rows", [[("f", "match"), ("g", "mismatch"), ("h", "parse_failure"), ("i", "match")], []])
def test_accuracy_of_written_verdicts(spark, rows):
    verdict = spark.createDataFrame(rows, "filename string, verdict string")
    counted = V.counted_verdicts(verdict)
    counted.df.write.parquet(path := _path())
    assert _rows(V.observed_accuracy(counted)) == _rows(V.accuracy(spark.read.parquet(path)))


def test_counts_take_one_job(spark):
    """The summary of a written table starts no job over its input: an accumulator counts each input row once."""
    seen = spark.sparkContext.accumulator(0)
    read = F.udf(lambda x: (seen.add(1), x)[1], "string").asNondeterministic()
    df = spark.range(500).select(F.col("id"), read(F.expr("if(id % 5 = 0, 'open', 'diary')")).alias("target"))
    counted = V.counted_splits(df)
    counted.df.write.parquet(_path())
    assert _rows(counted.table()) == {("open", 100), ("diary", 400)} and seen.value == 500


def test_a_value_outside_the_list_is_an_error(spark):
    counted = Counted(spark.createDataFrame([("x",), ("new",), (None,)], "v string"), "v", ("x",), "n")
    counted.df.write.parquet(_path())
    with pytest.raises(ValueError, match="2 rows whose v"):
        counted.table()
