"""Whole runs over folders: validating packages, authoring from canned answers, publishing drafts and converting packages to a batch.

Folders are read and written by tasks, whatever store they are in; what the driver holds is counts, and the first rows of what is
broken."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversion
from .operators import authoring, batch, contracts, packaging, rules, tree
from .sources import sinks
from .sources.files import file_tree, flatten_trees, normal_tree
from .sources.tables import kept
from .sources.versions import Versions


def package_folder(spark: SparkSession, root: str, ids: list[str] | None = None) -> DataFrame:
    """`(paper_id, name, content)` of the packages below `root`, a folder each; `name` is a path within the package."""
    files = file_tree(spark, root).select(F.split_part("path", F.lit("/"), F.lit(1)).alias("paper_id"), F.regexp_replace("path", "^[^/]+/", "").alias("name"), "content")
    return files.filter(F.col("paper_id").isin(*ids)) if ids else files


def validate(spark: SparkSession, root: str, ids: list[str] | None = None, code_only: bool = False, fail_on_warning: bool = False) -> tuple[DataFrame, DataFrame, bool]:
    """(report, violations, whether all is valid) of the packages below `root`. Ids without a package are not valid."""
    files = package_folder(spark, root, ids).withColumn("text", F.make_valid_utf8(F.when(~F.endswith("name", F.lit(".pdf")), F.col("content").cast("string"))))
    found = kept(spark, rules.package_violations(files, flatten_trees, code_only), "violations")
    subjects = files.select("paper_id").distinct()
    if ids:
        subjects = spark.createDataFrame([(i,) for i in ids], "paper_id string")
        absent = subjects.join(files.select("paper_id").distinct(), "paper_id", "left_anti").select("paper_id", F.lit("error").alias("severity"), F.lit("no package").alias("rule"))
        found = found.union(absent)
    report = kept(spark, rules.report(subjects, found, "paper_id", fail_on_warning), "report")
    return report, found, report.filter("not valid").isEmpty()


def author(spark: SparkSession, papers: DataFrame, answers: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """All calls of `papers` (see `authoring.call_plan`) answered by `answers(paper_id, call, answer)`, written by paper and stage below
    `folder`: (results in order, open questions). A call without an answer stops its paper at that stage: later stages are not
    written."""
    told = authoring.answered(authoring.call_plan(papers), answers)
    stop = told.filter("answer is null").groupBy("paper_id").agg(F.min("stage").alias("stop"))
    done = told.join(stop, "paper_id", "left").filter("answer is not null and (stop is null or stage < stop)").drop("stop")
    done = kept(spark, done, "answers")
    sinks.write_stages(done, folder)
    return authoring.in_order(done), authoring.joined_lists(done, "unresolved")


def publish(spark: SparkSession, drafts: DataFrame, files: DataFrame, folder: str, reviewer: str, artefacts: tuple[str, ...], tag: str | None = None, replace: bool = False) -> tuple[DataFrame, DataFrame]:
    """Publishes `files(paper_id, name, content)` of the `drafts` that no rule of `contracts.gate_rules` holds back, each with a record of
    its approval: (what was written, what held others back). A reviewer's name is needed."""
    if not reviewer.strip():
        raise ValueError("a reviewer is needed")
    held = kept(spark, rules.violations(drafts, contracts.gate_rules(artefacts, tag), ["paper_id"]), "held")
    ready = drafts.join(held, "paper_id", "left_anti").select("paper_id")
    own = files.join(ready, "paper_id", "left_semi")
    text = lambda name: F.max(F.when(F.col("name") == name, F.col("content").cast("string")))
    records = authoring.approvals(own.groupBy("paper_id").agg(text("rubric.json").alias("rubric"), text("addendum.md").alias("addendum")).withColumns({"reviewer": F.lit(reviewer), "approved_at": F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())}))
    every = own.select(F.concat_ws("/", "paper_id", "name").alias("path"), "content").union(records.select(F.concat(F.col("paper_id"), F.lit("/human_approval.json")), F.encode("record", "utf-8")))
    return kept(spark, sinks.write_files(every, folder, overwrite=replace), "written"), held


def convert(spark: SparkSession, root: str, target: str, name: str, label: str, templates: dict[str, bytes], instructions: bytes, contract: batch.Contract = batch.Contract(), overwrite: bool = False) -> DataFrame:
    """Whole packages below `root`, a folder each, as the next version of the batch `name` at `target` (see `conversion.put`); a package's id is its title. Gives the manifest's lines. Projects with lists of papers, drafts and
    approvals go through `conversion.convert`."""
    if Versions(spark, target).current()[1] and not overwrite:
        raise FileExistsError(target)
    report, found, valid = validate(spark, root, code_only=contract.mode == "code-dev")
    if not valid:
        raise ValueError(f"not converted: {[tuple(r) for r in found.filter(F.col('severity') == 'error').take(20)]}")
    files = package_folder(spark, root).withColumn("bytes", F.octet_length("content").cast("long"))
    text = lambda name: F.max(F.when(F.col("name") == name, F.make_valid_utf8(F.col("content").cast("string"))))
    texts = files.filter(F.col("name").isin("rubric.json", "addendum.md", "judge.addendum.md")).groupBy("paper_id").agg(text("rubric.json").alias("json"), text("addendum.md").alias("addendum"), text("judge.addendum.md").alias("judge_addendum"))
    texts = kept(spark, texts, "texts")
    leaves = tree.leaves(normal_tree(flatten_trees(texts.select(F.col("paper_id").alias("tree_id"), "json")))).groupBy(F.col("tree_id").alias("paper_id")).agg(F.count("*").alias("leaves"))
    bundles = texts.join(leaves, "paper_id", "left").withColumns({"title": F.col("paper_id"), "metadata": F.lit(None).cast("string")})
    conf = conversion.Conversion(name, label, contract)
    built = conversion.task_files(spark, bundles, files, templates, instructions, conf)
    order = F.row_number().over(packaging.Window.orderBy("paper_id"))
    manifest = packaging.manifest(report.select("paper_id", order.alias("source_index")), name, label, "tasks")
    return conversion.put(spark, target, built, manifest, templates, instructions, contract, overwrite)
