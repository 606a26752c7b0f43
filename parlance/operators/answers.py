"""Model answers as data: a ledger of prompts already answered (K3, K4).

An answer belongs to a prompt, not to a run: its key is ``file_id, part, prompt_hash``, where the hash covers the system text and
the prompt.  A prompt whose text, template or part size has changed has another hash, so an old answer is never taken for it.

* :func:`pending` — the prompts without an answer (an anti join), the only ones that need a model;
* :func:`answered` — the answers to the given prompts; of several to one prompt the one asked last;
* :class:`Ledger` — a ledger kept as Parquet under a folder: ``ask`` sends what is pending to a model in ``pieces``, each
  committed by itself, so that a run broken off repeats the open piece alone and a finished one repeats nothing.

A NULL response is no answer: the prompt stays pending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.session import persisted

KEY = ["file_id", "part", "prompt_hash"]
PIECES = 16


def prompt_hash(system: str = "system", prompt: str = "prompt") -> Column:
    return F.sha2(F.concat(F.col(system), F.lit("\x1f"), F.col(prompt)).cast("binary"), 256)


def with_hash(prompts: DataFrame) -> DataFrame:
    """``prompts`` (``file_id, part, system, prompt``) with their ``prompt_hash``."""
    return prompts if "prompt_hash" in prompts.columns else prompts.withColumn("prompt_hash", prompt_hash())


def latest(answers: DataFrame) -> DataFrame:
    """``KEY, response``: one answer a prompt, the one with the largest ``asked`` (of equal ones the largest text)."""
    asked = F.col("asked") if "asked" in answers.columns else F.lit(0)
    return answers.where(F.col("response").isNotNull()).groupBy(*KEY).agg(F.max_by("response", F.struct(asked, "response")).alias("response"))


def pending(prompts: DataFrame, answers: DataFrame) -> DataFrame:
    """The prompts that no answer belongs to, with their hash."""
    return with_hash(prompts).join(answers.where(F.col("response").isNotNull()).select(*KEY), KEY, "left_anti")


def answered(prompts: DataFrame, answers: DataFrame) -> DataFrame:
    """``file_id, part, response`` of the prompts that have an answer."""
    return with_hash(prompts).select(*KEY).join(latest(answers), KEY).select("file_id", "part", "response")


class Ledger:
    """Answers kept as Parquet under ``path``, a folder that driver and executors share, by ``kind`` (``roles``, ``types``, ...).

    ``key_type`` is the type of the corpus's ``file_id``.
    """

    def __init__(self, spark: SparkSession, path: str, kind: str, key_type: str = "string"):
        self.spark, self.path = spark, f"{path.rstrip('/')}/{kind}"
        self.schema = f"file_id {key_type}, part bigint, prompt_hash string, response string, asked bigint"
        self.add(spark.createDataFrame([], self.schema))  # so that there is a folder to read

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def add(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path)

    def ask(self, prompts: DataFrame, predict, pieces: int = PIECES, batch_rows: int = 16) -> DataFrame:
        """Answers to all ``prompts``; ``predict`` (see ``models.run_predictor``) is asked for the pending ones only."""
        from parlance.operators.models import run_predictor
        keyed = persisted(with_hash(prompts))
        todo = persisted(pending(keyed, self.read()).withColumn("_piece", F.pmod(F.xxhash64("file_id", "part"), F.lit(pieces))))
        for r in sorted(todo.select("_piece").distinct().collect()):  # at most ``pieces`` numbers
            some = todo.where(F.col("_piece") == r[0]).drop("_piece")
            said = run_predictor(some.select("file_id", "part", "system", "prompt"), predict, batch_rows)
            rows = said.where(F.col("response").isNotNull()).join(some.select(*KEY), ["file_id", "part"])
            self.add(rows.select(*KEY, "response", F.unix_micros(F.current_timestamp()).alias("asked")))
        return answered(keyed, self.read())


def collected(prompts: DataFrame, predict=None, answers: DataFrame | Ledger | None = None) -> DataFrame:
    """``file_id, part, response`` of the prompts, from a ledger or a table of answers, and from a model where there is one.

    With a table alone, prompts it does not answer have no row; with a model besides, they are sent to it; a ledger keeps what
    the model says.
    """
    from parlance.operators.models import run_predictor
    if answers is None:
        return run_predictor(prompts, predict)
    if isinstance(answers, Ledger):
        return answered(prompts, answers.read()) if predict is None else answers.ask(prompts, predict)
    known = answered(prompts, answers)
    if predict is None:
        return known
    rest = pending(prompts, answers).select("file_id", "part", "system", "prompt")
    return known.unionByName(run_predictor(rest, predict))
