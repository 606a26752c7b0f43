"""Tables with versions: read and replace, broken writes, rival writers."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from parlance.operators import feature_table as FT
from parlance.plans import catalog as CAT
from parlance.plans import steps as S
from parlance.sinks import versions as TV
from parlance.sinks import writers as W

SF = "/root/testdata/sf0.001"


def _table():
    return os.path.join(tempfile.mkdtemp(prefix="parlance-versions-", dir="/tmp"), "table")


def test_a_table_is_read_and_replaced(spark):
    path = _table()
    assert TV.versions(spark, path) == [] and TV.current(spark, path) is None
    with pytest.raises(ValueError):
        TV.read_version(spark, path)
    TV.replace_table(spark.range(100), path)
    old = TV.read_version(spark, path)
    assert TV.replace_table(old.where("id % 2 = 0"), path).number == 2
    assert TV.replace_table(TV.read_version(spark, path).limit(0), path, after=2).number == 3      # an empty version
    assert [TV.read_version(spark, path, n).count() for n in (1, 2, 3)] == [100, 50, 0]
    assert old.count() == 100 and TV.read_version(spark, path).count() == 0


def test_a_broken_write_leaves_the_version_before(spark):
    path = _table()
    TV.replace_table(spark.range(10), path)
    with pytest.raises(RuntimeError):
        with TV.new_version(spark, path) as folder:
            spark.range(20).write.parquet(folder)       # all files are there, the manifest is not
            raise RuntimeError("killed between write and commit")
    with pytest.raises(Exception):
        TV.replace_table(spark.range(20).select(F.raise_error(F.lit("a task fails")).alias("id")), path)
    assert TV.read_version(spark, path).count() == 10 and len(TV.versions(spark, path)) == 1
    assert TV.replace_table(spark.range(30), path).number == 2


def test_the_second_of_two_writers_gets_a_conflict(spark):
    path = _table()
    TV.replace_table(spark.range(1), path)
    with pytest.raises(TV.Conflict):
        with TV.new_version(spark, path) as mine:
            TV.replace_table(spark.range(2), path)      # a rival commits first
            spark.range(3).write.parquet(mine)
    with pytest.raises(TV.Conflict):
        TV.replace_table(spark.range(4), path, after=1)
    assert TV.read_version(spark, path).count() == 2 and [v.number for v in TV.versions(spark, path)] == [1, 2]


def test_any_writer_may_fill_a_version(spark):
    path = _table()
    rows = FT.empty_features(CAT.fx_table(spark, SF)).drop("row_index")
    with TV.new_version(spark, path) as folder:
        W.write_feature_table(rows, folder, raw_header=False)
    back = spark.read.option("sep", "\t").option("header", True).csv(TV.current(spark, path).folder)
    assert back.count() == rows.count() and back.columns[-1] == "file_name.txt"


def test_fix_replaces_the_table_it_read(spark):
    path, out = _table(), tempfile.mkdtemp(prefix="parlance-test-", dir="/tmp")
    TV.replace_table(CAT.fx_table(spark, SF), path)
    mismatches = CAT.QUERIES["mismatches"](spark, SF)
    plan = S.fix(spark, mismatches, path, out)
    want = FT.apply_corrections(TV.read_version(spark, path, 1), plan)
    got = TV.read_version(spark, path)
    assert TV.current(spark, path).number == 2 and got.count() == CAT.fx_table(spark, SF).count()
    assert got.exceptAll(want).isEmpty() and not got.exceptAll(TV.read_version(spark, path, 1)).isEmpty()
    assert not os.path.exists(os.path.join(out, "corrected_table"))
