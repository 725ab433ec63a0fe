"""The authoring of a tree as a chain of named calls, answered by a table or a client: which calls are made, in which order, and what
their answers add up to."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strict_json
from . import models

#: Names of the calls, and stages by the order in which they follow each other.
STAGES = ("elements", "matrix", "addendum", "tree-plan", "subtree", "weighting", "review", "judge-addendum", "repair")


def call_plan(papers: DataFrame) -> DataFrame:
    """`papers(paper_id, chunks, branches, asks_addendum, repairs)` to `(paper_id, stage, ord, call)`: a call a chunk, a call a branch (array of
    ids), a judge's addendum where the review asks for one, and as many repairs as were needed."""
    one = lambda stage: F.array(F.lit(stage))
    numbered = lambda stage, n, digits: F.when(n > 0, F.transform(F.sequence(F.lit(1).cast("long"), n), lambda i: F.concat(F.lit(f"{stage}-"), F.lpad(i.cast("string"), digits, "0")))).otherwise(F.array().cast("array<string>"))
    calls = {
        "elements": numbered("elements", F.col("chunks").cast("long"), 3), "subtree": F.transform(F.col("branches"), lambda b: F.concat(F.lit("subtree-"), b)), "judge-addendum": F.when(F.col("asks_addendum"), one("judge-addendum")),
        "repair": numbered("repair", F.col("repairs").cast("long"), 2),
    }
    listed = F.array(*(F.struct(F.lit(i).alias("stage"), F.coalesce(calls.get(s, one(s)), F.array().cast("array<string>")).alias("calls")) for i, s in enumerate(STAGES)))
    rows = papers.select("paper_id", F.explode(listed).alias("s")).select("paper_id", F.col("s.stage").alias("stage"), F.posexplode("s.calls").alias("ord", "call"))
    return rows


def answered(plan: DataFrame, answers: DataFrame) -> DataFrame:
    """The plan's calls with canned answers: the paper's own, or the common one."""
    return models.canned(plan, answers)


def in_order(results: DataFrame) -> DataFrame:
    """Results as one array a paper and stage, in the order of the calls whatever order they came in."""
    listed = F.array_sort(F.collect_list(F.struct("ord", "call", "answer")))
    return results.groupBy("paper_id", "stage").agg(F.transform(listed, lambda x: x["answer"]).alias("answers"))


def joined_lists(results: DataFrame, field: str) -> DataFrame:
    """`field`, a list of texts in each answer's JSON, of all answers of a paper one after the other."""
    own = F.coalesce(F.try_variant_get(strict_json(F.col("answer")), f"$.{field}", "array<string>"), F.array().cast("array<string>"))
    rows = results.select("paper_id", "stage", "ord", own.alias("found"))
    listed = F.array_sort(F.collect_list(F.struct("stage", "ord", "found")))
    return rows.groupBy("paper_id").agg(F.flatten(F.transform(listed, lambda x: x["found"])).alias(field))


def repair_rounds(reports: DataFrame, most: int = 1) -> DataFrame:
    """`reports(paper_id, round, valid)`, round 0 the draft, to `(paper_id, rounds, valid)`: repairs go on while the tree is invalid, at most
    `most` of them."""
    before = F.max(F.col("valid").cast("int")).over(Window.partitionBy("paper_id").orderBy("round").rowsBetween(Window.unboundedPreceding, -1))
    made = reports.filter(F.col("round") <= most).withColumn("before", F.coalesce(before, F.lit(0))).filter("before = 0")
    last = F.max(F.struct("round", "valid"))
    return made.groupBy("paper_id").agg(last.alias("l")).select("paper_id", F.col("l.round").cast("long").alias("rounds"), F.col("l.valid").alias("valid"))


def approvals(drafts: DataFrame) -> DataFrame:
    """`drafts(paper_id, reviewer, approved_at, rubric, addendum)` to the record of each approval as JSON, the time as UTC of the given
    wall clock."""
    record = F.struct(
        F.sha2("addendum", 256).alias("addendum_sha256"), F.date_format(F.col("approved_at").cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("approved_at"), "paper_id", "reviewer", F.sha2("rubric", 256).alias("rubric_sha256"),
    )
    return drafts.select("paper_id", F.to_json(record).alias("record"))
