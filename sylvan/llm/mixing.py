"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with target t and size s is due t / s copies. The whole copies are certain; the fraction is a
probability. Two documents at a time, expected words move from one to the other, up or down at random and fair, until
one of the two probabilities is 0 or 1; so a source's expected words never change, and only one document of a source is
left undecided in the end. Blocks of a source run apart; what each leaves undecided meets further up a reduction tree.
The random numbers are hashes of the documents' ids and texts, so reruns agree whatever the partitioning. Rows that are alike in
both are numbered, within each input partition and then from partition to partition, so that they are dealt to blocks like
all others; which of them has which number doesn't matter.

Nulls: a null text has size 0, is due nothing and takes no part in rounding; a null source is a source of its own, the
last. Null and repeated doc_ids are documents each. Repeated rows count as often as they occur. The targets are worked out in one
task with a row a source. Further columns are ignored. An empty table gives no rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textkit import U64, mix
from .work import Workspace


@dataclass(frozen=True)
class Mixing:
    """weights: repeated over the sources in code-point order. most: copies of a document at most. block: documents that
    one task rounds at once. fan: blocks whose undecided documents meet one level up."""

    weights: tuple[int, ...] = (5, 2, 1)
    most: int = 3
    block: int = 1024
    fan: int = 64
    seed: int = 20


def word_count(text: Column | str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, conf: Mixing) -> DataFrame:
    """`sizes(source, source_size)` to `target`: shares by weight, held to `most` times the source, the excess reshared.

    In order of the level at which a source reaches its cap, the common level is that of the first source which the
    rest of the words, shared over the rest of the weights, does not lift above its cap. One row a source is sorted."""
    weight = F.element_at(F.array(*map(F.lit, conf.weights)), (F.col("place") % len(conf.weights) + 1).cast("int"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cap = (F.col("source_size") * conf.most).cast("double")
    rows = sizes.withColumn("place", place).withColumn("weight", weight.cast("double")).withColumn("cap", cap).withColumn("full_at", F.col("cap") / F.col("weight"))
    order = Window.orderBy("full_at", "place")
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({
        "total": F.sum(F.col("source_size").cast("double")).over(every),
        "before": F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "rest": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
    })
    level = (F.col("total") - F.col("before")) / F.col("rest")
    rows = rows.withColumn("level", F.min(F.when(level <= F.col("full_at"), F.struct("full_at", "place", level.alias("level")))).over(every)["level"])
    return rows.select("source", "source_size", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight"))).alias("target"))


def pivot(ids: np.ndarray, sizes: np.ndarray, p: np.ndarray, seed: int) -> int:
    """Round `p` in place, in the given order; the index that is left undecided, or -1."""
    ids = np.ascontiguousarray(ids, np.int64).view(U64)
    left = -1
    with np.errstate(over="ignore"):
        mark = mix(ids * U64(0x9E3779B97F4A7C15) + U64(seed))
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if left < 0:
            left = i
            continue
        a, b = left, i
        gain_a, loss_b = (1 - p[a]) * sizes[a], p[b] * sizes[b]
        loss_a, gain_b = p[a] * sizes[a], (1 - p[b]) * sizes[b]
        up, down = min(gain_a, loss_b), min(loss_a, gain_b)
        with np.errstate(over="ignore"):
            u = float(mix(mark[a : a + 1] * U64(3) + mark[b : b + 1])[0]) / 2.0**64
        if u < down / (up + down):
            p[a], p[b] = (1.0 if gain_a <= loss_b else p[a] + up / sizes[a]), (0.0 if loss_b <= gain_a else p[b] - up / sizes[b])
        else:
            p[a], p[b] = (0.0 if loss_a <= gain_b else p[a] - down / sizes[a]), (1.0 if gain_b <= loss_a else p[b] + down / sizes[b])
        left = next((k for k in (a, b) if 0.0 < p[k] < 1.0), -1)
    return left


_ROW = "doc_id long, h long, mark long, source string, size long, source_size long, target double, whole long, p double, block long, done boolean"


def _rounder(seed: int, last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "mark"], ascending=[False, True], kind="stable")
        p = pdf["p"].to_numpy(float).copy()
        ids = pdf["mark"].to_numpy()
        left = pivot(ids, pdf["size"].to_numpy(float), p, seed)
        done = np.ones(len(p), bool)
        if left >= 0 and last:
            with np.errstate(over="ignore"):
                u = float(mix(ids[left : left + 1].astype(np.int64).view(U64) + U64(seed + 1))[0]) / 2.0**64
            p[left] = float(u < p[left])
        elif left >= 0:
            done[left] = False
        return pdf.assign(p=p, done=done)

    return run


def row_hash(columns: list[str]) -> Column:
    """Of the columns' values, and of which of them are null."""
    return F.xxhash64(*columns, *(F.col(c).isNull() for c in columns))


def numbered(rows: DataFrame, work: Workspace) -> DataFrame:
    """`rows(doc_id, source, h, part, ...)`, a written table, with `nth` from 0 among the rows that share doc_id, source and h: a
    running number in each `part`, from the count of the parts before it on."""
    same = ["source", "doc_id", "h"]
    by_part = rows.groupBy("part", *same).agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy(*same).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = by_part.withColumn("earlier", earlier).filter("earlier > 0").select("earlier", F.col("part").alias("part_"), *(F.col(c).alias(f"{c}_") for c in same))
    counts = work.keep(counts, "earlier", rows.count())
    within = F.row_number().over(Window.partitionBy("part", *same).orderBy(F.lit(0))) - 1
    on = F.col("part") == F.col("part_")
    for c in same:
        on = on & F.col(c).eqNullSafe(F.col(f"{c}_"))
    return rows.withColumn("nth", within).join(counts, on, "left").withColumn("nth", F.col("nth") + F.coalesce("earlier", F.lit(0))).drop(*counts.columns)


def mixture(docs: DataFrame, conf: Mixing = Mixing()) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it."""
    columns = docs.columns
    own = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text", "source", row_hash(columns).alias("h"))
    due = mixed(own, conf).filter("copies > 0").groupBy("doc_id", "source", "h").agg(F.sum("copies").alias("copies"))
    due = due.select("copies", *(F.col(c).alias(f"{c}_") for c in ("doc_id", "source", "h")))
    on = F.col("doc_id").eqNullSafe(F.col("doc_id_")) & F.col("source").eqNullSafe(F.col("source_")) & (F.col("h") == F.col("h_"))
    once = own.dropDuplicates(["doc_id", "source", "h"]).drop("text")
    return once.join(due, on).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def mixed(docs: DataFrame, conf: Mixing = Mixing()) -> DataFrame:
    """`docs(doc_id, text, source[, h])` to `(doc_id, h, source, size, source_size, target, copies, taken)`; h tells documents of one
    doc_id apart, a hash of the text where `docs` has no long of that name."""
    work = Workspace(docs.sparkSession, "mixing")
    own = F.col("h") if dict(docs.dtypes).get("h") == "bigint" else F.xxhash64("text")
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), own.alias("h"), "source", word_count().alias("size"), F.spark_partition_id().alias("part"))
    sized = work.keep(sized, "sized")
    n = sized.count()
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    plan = work.keep(targets(sums.drop("n"), conf).withColumnRenamed("source", "s").join(sums.select("source", "n"), F.col("s").eqNullSafe(F.col("source"))).drop("s"), "plan", 1)
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    near = F.when(F.abs(due - F.round(due)) < 1e-12, F.round(due)).otherwise(due)
    blocks = F.ceil(F.col("n") / conf.block)
    sized = numbered(sized, work).withColumn("mark", F.xxhash64("doc_id", "h", "nth"))
    rows = sized.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("due", near).select(
        "doc_id", "h", "mark", "source", "size", "source_size", "target", F.floor("due").cast("long").alias("whole"), F.when(F.col("size") > 0, F.col("due") - F.floor("due")).otherwise(0.0).alias("p"),
        F.pmod(F.xxhash64("mark", F.lit(conf.seed)), blocks).alias("block"),
    )
    most = plan.agg(F.max(F.ceil(F.col("n") / conf.block))).first()[0] or 1
    out, level = [], 0
    while True:
        last = most <= 1
        step = work.keep(rows.groupBy("source", "block").applyInPandas(_rounder(conf.seed + 2 * level, last), _ROW), f"level{level}", n // conf.block**level + 1, 50_000)
        out.append(step.filter("done"))
        if last:
            break
        rows = step.filter("not done").withColumn("block", F.floor(F.col("block") / conf.fan)).drop("done")
        most, level = -(-most // conf.fan), level + 1
    done = out[0]
    for more in out[1:]:
        done = done.union(more)
    copies = F.col("whole") + F.col("p").cast("long")
    return done.select("doc_id", "h", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
