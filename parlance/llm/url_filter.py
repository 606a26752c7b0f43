"""URL filters by expression hashes: host-suffix and path-prefix expressions, short hash prefixes, full digests.

Each URL is expanded into host suffix + path prefix expressions: the suffixes of as many labels and the prefixes of as many characters as
occur in the rules (of a length that only slash-ended rules have, prefixes that end with a slash), so a URL costs time
linear in its length.  The expressions are equi-joined with the rules on the first ``PREFIX_HEX`` hex digits of their SHA-256; the full
digest confirms a hit, and among the confirmed rules the longest one wins (its host and path together; then the longer
host, then ``block`` before ``allow``).  All steps are DataFrame functions.  Rules of up to ``BROADCAST_BYTES``, as measured, are broadcast, so that
expressions that hit nothing are never shuffled; larger rule sets are met by a shuffle join, whose
hot keys (``com/``) adaptive execution splits.

Defined results: a null URL or one without ``://`` has an empty host and path and fits no rule (but one of an empty host and path); a URL
that fits no rule gets ``default``; very long URLs are judged whole; repeated rows and null ids keep their rows; an empty table
or an empty rule set gives no rows or no hits; rules with a null host, path or verdict fit nothing; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import durable

PREFIX_HEX = 8
#: Rules up to this size (characters of hosts, paths, verdicts and digests) are sent to every task.
BROADCAST_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host: Column, labels: Sequence[int]) -> Column:
    """The last n labels of the host, for each given n that it has."""
    has = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    return _present(F.when(has >= n, F.substring_index(host, ".", -n)) for n in labels)


def _prefixes(path: Column, slashed: Sequence[int], others: Sequence[int]) -> Column:
    """The prefixes of the given lengths that the path has; of ``slashed`` lengths those that end with a slash."""
    ended = (F.when(F.substring(path, n, 1) == "/", F.substring(path, 1, n)) for n in slashed)
    return _present([*ended, *(F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in others)])


def _present(columns: Iterable[Column]) -> Column:
    return F.array_compact(F.array(F.lit(None).cast("string"), *columns))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def rule_table(rules: DataFrame) -> DataFrame:
    """Hashed rules of ``rules(host, path, verdict)``, verdict ``block`` or ``allow``."""
    rules = rules.withColumn("host", F.translate("host", UPPER, LOWER)).dropna(subset=["host", "path", "verdict"])
    return rules.select(
        _digest(F.col("host"), F.col("path")).alias("digest"),
        F.struct(F.length(F.concat("host", "path")).alias("size"), F.length("host").alias("host_size"),
                 (F.col("verdict") == "block").alias("blocks"), F.concat("host", "path").alias("rule"),
                 F.col("verdict").alias("verdict")).alias("hit"),
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("path_size"), F.col("path").endswith("/").alias("slashed"),
    ).withColumn("key", F.substring("digest", 1, PREFIX_HEX))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_column: str = "page_id",
          broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(id_column, host, path, rule, verdict): one row for each row of ``pages``.

    The driver reads the distinct label counts and path lengths of the rules (numbers, not rules) and their total size.
    """
    known = durable(rule_table(rules))
    labels, slashed, others, size = known.agg(
        F.array_sort(F.collect_set("labels")), F.array_sort(F.collect_set(F.when(F.col("slashed"), F.col("path_size")))),
        F.array_sort(F.collect_set(F.when(~F.col("slashed"), F.col("path_size")))),
        F.coalesce(F.sum(F.length("hit.rule") + F.lit(160)), F.lit(0))).first()
    known = known.select("key", "digest", "hit")
    rows = durable(pages.select(F.col(id_column), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
                   .withColumn("rid", F.monotonically_increasing_id()))
    hashed = (rows.select("rid", "path", F.explode(_suffixes(F.col("host"), labels)).alias("suffix"))
              .select("rid", "suffix", F.explode(_prefixes(F.col("path"), slashed, others)).alias("prefix"))
              .select("rid", _digest(F.col("suffix"), F.col("prefix")).alias("full"))
              .withColumn("key", F.substring("full", 1, PREFIX_HEX)))
    found = hashed.join(F.broadcast(known) if size <= broadcast_bytes else known, "key").filter(F.col("full") == F.col("digest"))
    best = found.groupBy("rid").agg(F.max("hit").alias("best"))
    return (rows.join(best, "rid", "left")
            .select(id_column, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
