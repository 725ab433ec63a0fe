"""Calls to models behind an interface: canned answers by join, or an injected client, one failure never reaching another call."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def canned(calls: DataFrame, answers: DataFrame) -> DataFrame:
    """`calls(paper_id, call)` with `answers(paper_id, call, answer)`: the paper's own, or the one without a paper."""
    own = answers.filter("paper_id is not null").select("paper_id", "call", F.col("answer").alias("own"))
    common = answers.filter("paper_id is null").select("call", F.col("answer").alias("common"))
    out = calls.join(own, ["paper_id", "call"], "left").join(common, "call", "left")
    return out.withColumn("answer", F.coalesce("own", "common")).drop("own", "common")


def retried(attempts: DataFrame, most: int = 4) -> DataFrame:
    """`attempts(call_id, attempt, status, answer)`, attempt from 0 and status null where nobody answered, to one row a call: `attempts` that
    were made, seconds `waited` (1, 2, 4, ... up to 30 after each failure but the last), `answer` and `problem`. A status from 400
    to 499 other than 429 ends a call at once."""
    good = F.coalesce(F.col("status").between(200, 299), F.lit(False))
    final = F.coalesce(F.col("status").between(400, 499) & (F.col("status") != 429), F.lit(False))
    first = F.min(F.when(good | final, F.col("attempt"))).over(Window.partitionBy("call_id"))
    made = attempts.filter(F.col("attempt") < most).withColumn("first", first).filter(F.col("first").isNull() | (F.col("attempt") <= F.col("first")))
    made = made.withColumn("final", final)
    end = F.max(F.struct("attempt", F.when(good, F.col("answer")).alias("answer"), F.when(good, None).when(final, "refused").otherwise("no answer").alias("problem")))
    rows = made.groupBy("call_id").agg(F.count("*").alias("attempts"), end.alias("end"), F.sum(F.least(F.lit(30.0), F.pow(F.lit(2.0), "attempt"))).alias("all"), F.max(F.col("attempt")).alias("last"))
    waited = (F.col("all") - F.least(F.lit(30.0), F.pow(F.lit(2.0), "last"))).cast("long")
    return rows.select("call_id", "attempts", waited.alias("waited"), F.col("end.answer").alias("answer"), F.col("end.problem").alias("problem"))


class Refused(Exception):
    """A client's answer that another attempt would not change."""


def ask(calls: DataFrame, client: Callable[[], Callable[[str, str], str]], at_once: int | None = None, pool: int = 1, attempts: int = 1, wait: float = 1.0) -> DataFrame:
    """`calls(call_id, call, prompt)` to `(call_id, answer, error)`. `client()` makes a client in each task; `at_once` bounds the tasks, `pool` the calls that
    a task makes at a time. A call is made up to `attempts` times, with pauses of `wait` seconds, doubled up to 30; `Refused` ends it at once.
    Spark may repeat a task, so clients answer a call_id alike each time, or the result is written before it is read twice."""

    def patient(send: Callable[[str, str], str], call_id: str, call: str, prompt: str) -> tuple:
        for attempt in range(attempts):
            try:
                return call_id, send(call, prompt), None
            except Exception as error:
                problem = f"{type(error).__name__}: {error}"[:1000]
                if isinstance(error, Refused) or attempt == attempts - 1:
                    break
                time.sleep(min(30.0, wait * 2**attempt))
        return call_id, None, problem

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send = client()
        with ThreadPoolExecutor(pool) as workers:
            for batch in batches:
                rows = workers.map(lambda row: patient(send, *row), zip(batch["call_id"], batch["call"], batch["prompt"], strict=True))
                yield pd.DataFrame(list(rows), columns=["call_id", "answer", "error"])

    rows = calls.select("call_id", "call", "prompt")
    return (rows.repartition(at_once) if at_once else rows).mapInPandas(run, "call_id string, answer string, error string")


def canned_or_asked(calls: DataFrame, answers: DataFrame, client: Callable[[], Callable[[str, str], str]], at_once: int | None = None) -> DataFrame:
    """`calls(call_id, paper_id, call, prompt)` to `(call_id, answer, error)`: a canned answer where there is one, else the client is asked
    once, without a retry. Canned answers cost no call."""
    known = canned(calls, answers)
    told = known.filter("answer is not null").select("call_id", "answer", F.lit(None).cast("string").alias("error"))
    return told.union(ask(known.filter("answer is null"), client, at_once))


#: `calls(call_id, paper_id, call, prompt)` to `(call_id, answer, error)`.
Asker = Callable[[DataFrame], DataFrame]


def from_table(answers: DataFrame) -> Asker:
    """Answers by `answers(paper_id, call, answer)`, see `canned`; a call without one is an error."""

    def asked(calls: DataFrame) -> DataFrame:
        return canned(calls, answers).select("call_id", "answer", F.when(F.col("answer").isNull(), F.concat(F.lit("no answer for "), "call")).alias("error"))

    return asked


def from_client(client: Callable[[], Callable[[str, str], str]], at_once: int | None = None, pool: int = 1, attempts: int = 1, wait: float = 1.0) -> Asker:
    return lambda calls: ask(calls, client, at_once, pool, attempts, wait)


def answer_files(files: DataFrame) -> DataFrame:
    """`files(path, content)` named `<paper>.<call>.json`, or `<call>.json` for all papers, to `(paper_id, call, answer)`."""
    name = F.element_at(F.split("path", "/"), -1)
    part = lambda i: F.nullif(F.regexp_extract(name, r"^(?:(.+)\.)?([^.]+)\.json$", i), F.lit(""))
    return files.select(part(1).alias("paper_id"), part(2).alias("call"), F.col("content").cast("string").alias("answer")).filter("call is not null")


class Ledger:
    """Calls that have been answered, in a folder of Parquet, by a digest of who asks what. A call that is there with an answer is not made again, so a run that
    broke off, or is made again with some inputs changed, asks only what is new."""

    def __init__(self, spark: SparkSession, folder: str, asker: Asker):
        self.spark, self.folder, self.asker = spark, folder, asker

    def rows(self) -> DataFrame:
        """(key, paper_id, call, answer, error), a row for each time that a call was made."""
        schema = "key string, paper_id string, call string, answer string, error string"
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        there = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(schema).parquet(self.folder) if there else self.spark.createDataFrame([], schema)

    def __call__(self, calls: DataFrame) -> DataFrame:
        """`calls(call_id, paper_id, call, prompt)` to `(call_id, answer, error)`; what is new is written before it is read."""
        keyed = calls.withColumn("key", F.sha2(F.concat_ws("\x1f", "paper_id", "call", "prompt"), 256))
        new = keyed.join(self.rows().filter("error IS NULL").select("key").distinct(), "key", "left_anti")
        told = self.asker(new.select("call_id", "paper_id", "call", "prompt"))
        new.drop("prompt").join(told, "call_id").select("key", "paper_id", "call", "answer", "error").write.mode("append").parquet(self.folder)
        best = F.min(F.struct(F.col("error").isNotNull().alias("bad"), "answer", "error")).alias("b")
        return keyed.select("call_id", "key").join(self.rows().groupBy("key").agg(best), "key").select("call_id", "b.answer", "b.error")
