"""Plan checks: the registered queries stay JVM-side, never gather data in a
single partition through a window, and prune parquet columns."""

import json
import re

import pytest

from parlance.plans.catalog import QUERIES as CATALOG

SF = "/root/testdata/sf0.001"
QUERIES = dict(CATALOG)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def unpartitioned_windows(df) -> int:
    nodes = json.loads(df._jdf.queryExecution().sparkPlan().toJSON())
    return sum(1 for n in nodes if n.get("class", "").endswith("WindowExec") and not n.get("partitionSpec"))


def test_global_window_is_detected(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    assert unpartitioned_windows(spark.range(3).withColumn("r", F.row_number().over(Window.orderBy("id")))) == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_global_window(spark, name):
    df = QUERIES[name](spark, SF)
    plan = plan_of(df)
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan, f"{name}: Python node {node} in a built-in plan"
    # a window without partition columns runs in one task
    assert unpartitioned_windows(df) == 0, f"{name}: window without partitioning"


def test_lexicon_scan_is_pruned(spark):
    plan = plan_of(QUERIES["lexicon"](spark, SF))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    # text and lang, never the unused columns
    assert schemas and all("text:string" in s and "source" not in s and "n_chars" not in s for s in schemas)


def test_totals_are_no_join_and_words_meet_the_lexicon_once(spark):
    """F5's totals are a scalar map; E5 is one join on (lang, word), after the words were counted."""
    assert "Join" not in plan_of(QUERIES["lexicon"](spark, SF))
    plan = plan_of(QUERIES["word_freq"](spark, SF))
    assert len(re.findall(r"Join \[lang#\d+, _key#\d+\]", plan)) == 1


def test_generated_code_is_compiled(spark, capfd):
    """No stage of the re-routed splits falls back to interpreted execution."""
    QUERIES["splits_corrected"](spark, SF).collect()
    assert "grows beyond 64 KB" not in capfd.readouterr().err


def test_lookup_tables_are_literals(spark):
    """Site / language lookups are folded literal maps: no join for them."""
    plan = plan_of(QUERIES["site_code"](spark, SF))
    assert "Join" not in plan
