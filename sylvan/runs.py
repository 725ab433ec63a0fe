"""Runs over many papers or submissions that ask a model in rounds: authoring a tree for each paper, and grading each submission leaf by leaf.

A round makes the calls of all papers that are still going, in one job, and writes their answers to a ledger before anything is derived from them. What a paper
asks next follows from what it was told: its chunks, its plan's branches, whether its tree is sound, what its review wants. A paper whose
answer can't be used stops there and holds no other one up. Made again over the same folder, a run asks only what has changed."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .conversion import project_files
from .functions.text import authored_object, heading_chunks, strict_json
from .operators import contracts, evidence, grading, models, rules, tree
from .release import FOLDER, NEEDED
from .sources import sinks
from .sources.files import flatten_trees, normal_tree
from .sources.tables import kept as kept_table


@dataclass(frozen=True)
class Authoring:
    """mode: regular, or code-dev, where the complete tree is authored first and cut down last, by the derivation `tag`. repairs: rounds for trees that aren't sound."""

    mode: str = "regular"
    tag: str | None = None
    chunk: int = 50_000
    repairs: int = 1
    target: str = "40-120"


def _part(name: str, text: Column) -> Column:
    return F.concat(F.lit(f"\n\n<{name}>\n"), F.coalesce(text, F.lit("")), F.lit(f"\n</{name}>"))


#: What the author is asked for in each call, and the shape of the answer.
ASKED = {
    "elements": 'List what a replication needs from this part of the paper: claims, method components, experiments, resources and open points, each with where it stands. Guess nothing. JSON: {"claims": [], "method_components": [], "experiments": [], "resources": [], "ambiguities": []}',
    "matrix": 'Merge the elements of all parts into contributions, each with the evidence that it takes and whether it is in scope. What experts must decide stays open. JSON: {"paper_id": "", "contributions": [], "reproduction_contract": {}, "unresolved_questions": []}',
    "addendum": 'Write the public addendum in Markdown with the sections Scope, Approved adaptations, Required comparisons and evidence, Clarifications, Out of scope. Reveal no weights and no hidden numbers. JSON: {"addendum_markdown": "", "unresolved_questions": []}',
    "tree-plan": 'Plan the top of the tree by contribution, without leaves: kebab-case ids, weights 1 to 3, {target} leaves in all. JSON: {"root": {"id": "root", "requirements": "", "branches": [{"id": "", "requirements": "", "weight": 1}]}, "unresolved_questions": [], "possible_double_counting": []}',
    "subtree": 'Expand this branch until each leaf is one binary condition that can be observed. Keep its id and requirements, begin the ids below it with its own, categories on leaves alone. JSON: {"subtree": {}, "unresolved_questions": [], "possible_double_counting": []}',
    "weighting": 'Give each node of the tree a weight of 1, 2 or 3 among its siblings by scientific importance; the root stays 1. JSON: {"weights": [{"node_id": "", "weight": 1}], "unresolved_questions": []}',
    "repair": 'Mend what is listed and nothing else. JSON: {"rubric": {}, "unresolved_questions": [], "changes": []}',
    "review": 'Review addendum and tree as an independent second reader; mend nothing. JSON: {"blocking_issues": [], "warnings": [], "unresolved_questions": [], "judge_addendum": {"needed": false}}',
    "judge-addendum": 'Write what only a judge needs to tell similar conditions apart; hide nothing that a candidate needs. JSON: {"judge_addendum_markdown": "", "unresolved_questions": []}',
}
MODES = {"regular": "Code, execution and results count.", "code-dev": "Code alone counts."}


class _Run:
    """Papers that are going, answers of each stage, and what stopped the others."""

    def __init__(self, spark: SparkSession, folder: str, asker: models.Asker, papers: DataFrame):
        self.spark, self.at = spark, f"{folder}/rounds/{uuid.uuid4().hex[:12]}"
        self.ledger = models.Ledger(spark, f"{folder}/ledger", asker)
        self._n = 0
        self.papers = self.kept(papers, "papers")
        self.stopped = self.kept(spark.createDataFrame([], "paper_id string, call string, problem string"), "stopped")

    def kept(self, rows: DataFrame, name: str) -> DataFrame:
        self._n += 1
        at = f"{self.at}/{self._n:02d}-{name}"
        rows.write.parquet(at)
        return self.spark.read.schema(rows.schema).parquet(at)

    def stop(self, rows: DataFrame) -> None:
        """`rows(paper_id, call, problem)`: where problem is not null, the paper stops."""
        new = rows.filter("problem IS NOT NULL").select("paper_id", "call", "problem")
        self.stopped = self.kept(self.stopped.union(new).coalesce(1), "stopped")

    def going(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.stopped.select("paper_id").distinct(), "paper_id", "left_anti")

    def told(self, calls: DataFrame, stage: str, check: Callable[[Column], Column] = lambda v: F.lit(None).cast("string")) -> DataFrame:
        """`calls(paper_id, ord, call, prompt)` of papers that are going, asked, to `(paper_id, ord, call, json)` of those that still are."""
        calls = self.kept(self.going(calls).withColumn("call_id", F.concat_ws("/", "paper_id", "call")), f"{stage}-calls")
        v = authored_object(F.col("answer"))
        rows = calls.select("call_id", "paper_id", "ord", "call").join(self.ledger(calls), "call_id")
        rows = rows.withColumn("v", v).select("paper_id", "ord", "call", F.to_json("v").alias("json"), F.coalesce("error", F.when(F.col("v").isNull(), "answer is no JSON object"), check(F.col("v"))).alias("problem"))
        rows = self.kept(rows, stage)
        self.stop(rows)
        return self.going(rows).drop("problem")


def _one(call: str, prompt: Column) -> list[Column]:
    return [F.col("paper_id"), F.lit(0).alias("ord"), F.lit(call).alias("call"), prompt.alias("prompt")]


def _get(json: str | Column, path: str, kind: str) -> Column:
    return F.try_variant_get(F.try_parse_json(json), path, kind)


def _text_of(path: str, call: str) -> Callable[[Column], Column]:
    kind = lambda v: F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    return lambda v: F.when(~F.coalesce(kind(v) == "STRING", F.lit(False)), f"{call} has no text")


def author(spark: SparkSession, papers: DataFrame, guide: str, asker: models.Asker, folder: str, conf: Authoring = Authoring()) -> dict[str, DataFrame]:
    """Trees for `papers(paper_id, metadata, text)`, metadata as JSON. Gives `files(paper_id, path, text)` of the papers that came through, `reports(paper_id, valid, errors, warnings, repairs, full_valid)`,
    `unresolved(paper_id, question)` and `stopped(paper_id, call, problem)`; nothing is published."""
    code = contracts.code_only_of(conf.mode)
    run = _Run(spark, folder, asker, papers)
    ask = lambda name: F.concat(F.lit(ASKED[name].replace("{target}", conf.target) + "\n"), F.lit(MODES["regular"]))
    by_paper = lambda rows, name: rows.select("paper_id", F.col("json").alias(name))
    listed = lambda rows, name: rows.groupBy("paper_id").agg(F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "json"))), lambda x: x["json"]), ", "), F.lit("]")).alias(name))

    chunks = run.papers.select("paper_id", F.posexplode(heading_chunks(F.col("text"), conf.chunk)).alias("ord", "chunk"))
    elements = run.told(chunks.select("paper_id", "ord", F.concat(F.lit("elements-"), F.lpad((F.col("ord") + 1).cast("string"), 3, "0")).alias("call"), F.concat(ask("elements"), _part("paper", F.col("chunk"))).alias("prompt")), "elements")
    known = run.kept(run.papers.select("paper_id", "metadata").join(listed(elements, "elements"), "paper_id"), "known")
    matrix = run.told(known.select(*_one("matrix", F.concat(ask("matrix"), _part("metadata", F.col("metadata")), _part("elements", F.col("elements"))))), "matrix")
    known = run.kept(known.join(by_paper(matrix, "matrix"), "paper_id"), "known")
    addendum = run.told(known.select(*_one("addendum", F.concat(ask("addendum"), _part("metadata", F.col("metadata")), _part("matrix", F.col("matrix"))))), "addendum", _text_of("$.addendum_markdown", "addendum"))
    known = run.kept(known.join(addendum.select("paper_id", _get("json", "$.addendum_markdown", "string").alias("addendum")), "paper_id"), "known")
    base = [_part("matrix", F.col("matrix")), _part("addendum", F.col("addendum"))]

    plan = run.told(known.select(*_one("tree-plan", F.concat(ask("tree-plan"), _part("metadata", F.col("metadata")), *base, _part("guide", F.lit(guide))))), "plan")
    branches = run.kept(contracts.branches(plan.select(F.col("paper_id").alias("plan_id"), F.parse_json("json").alias("plan"))), "branches")
    broken = rules.violations(branches, contracts.plan_rules(), ["plan_id"]).groupBy("plan_id").agg(F.min("rule").alias("rule"))
    run.stop(run.kept(broken.select(F.col("plan_id").alias("paper_id"), F.lit("tree-plan").alias("call"), F.col("rule").alias("problem")), "broken-plans"))

    own = run.going(branches.withColumnRenamed("plan_id", "paper_id").filter("pos IS NOT NULL"))
    branch = F.to_json(F.struct(F.col("branch_id").alias("id"), "requirements", "weight"))
    grown = run.told(own.join(known, "paper_id").select("paper_id", F.col("pos").alias("ord"), F.concat(F.lit("subtree-"), "branch_id").alias("call"), F.concat(ask("subtree"), _part("branch", branch), *base, _part("guide", F.lit(guide))).alias("prompt")), "subtrees")
    subtrees = grown.select("paper_id", "ord", "call", F.to_json(_get("json", "$.subtree", "variant")).alias("subtree"))
    fits = contracts.assemble(
        own.select(F.col("paper_id").alias("plan_id"), "pos", F.col("branch_id").alias("id"), "requirements", "weight"),
        contracts.subtree_answers(subtrees.select(F.col("paper_id").alias("plan_id"), F.col("ord").alias("pos"), F.try_parse_json("subtree").alias("answer"))),
    )
    run.stop(run.kept(run.going(fits.select(F.col("plan_id").alias("paper_id"), F.concat(F.lit("subtree-"), "id").alias("call"), "problem")), "fits"))
    flat = run.kept(flatten_trees(run.going(subtrees).select(F.concat_ws("\x1f", "paper_id", "ord").alias("tree_id"), F.col("subtree").alias("json"))), "flat")
    place = flat.withColumns({"paper_id": F.regexp_replace("tree_id", "(?s)\x1f[0-9]+$", ""), "pos": F.regexp_extract("tree_id", "\x1f([0-9]+)$", 1).cast("int")})
    run.stop(run.kept(place.filter("fault IS NOT NULL").select("paper_id", F.lit("subtree").alias("call"), F.col("fault").alias("problem")), "faults"))
    # below the root: the plan's branches with their weights, then what the answers hold
    at = normal_tree(run.going(place).drop("tree_id").withColumnRenamed("paper_id", "tree_id").withColumn("node_id", F.col("node_id"))).columns
    top = own.select("paper_id", "pos", "root_id", "root_requirements", F.col("weight").alias("planned"))
    inner = run.going(place).drop("tree_id").join(top.select("paper_id", "pos", "root_id", "planned"), ["paper_id", "pos"])
    first = F.col("parent_id").isNull()
    inner = inner.withColumns({"ord": F.when(first, F.col("pos")).otherwise(F.col("ord")).cast("long"), "weight": F.when(first, F.col("planned")).otherwise(F.col("weight")), "parent_id": F.coalesce("parent_id", "root_id"), "depth": F.col("depth") + 1}).withColumnRenamed("paper_id", "tree_id")
    none = F.lit(None).cast("string")
    root = top.select("paper_id", "root_id", "root_requirements").distinct().select(F.col("paper_id").alias("tree_id"), F.col("root_id").alias("node_id"), none.alias("parent_id"), F.lit(0).cast("long").alias("ord"), F.lit(0).alias("depth"), F.col("root_requirements").alias("requirements"), F.lit(1.0).alias("weight"), none.alias("task_category"), none.alias("fine_category"))
    nodes = run.kept(run.going(inner.select(*at).unionByName(root).withColumn("paper_id", F.col("tree_id"))).drop("paper_id"), "tree")
    unweighted = run.kept(tree.as_json(nodes).withColumnRenamed("tree_id", "paper_id"), "unweighted")

    weighting = run.told(unweighted.join(known, "paper_id").select(*_one("weighting", F.concat(ask("weighting"), _part("matrix", F.col("matrix")), _part("tree", F.col("json"))))), "weighting",
        lambda v: F.when(F.try_variant_get(v, "$.weights", "array<variant>").isNull(), "plan has no list"))
    entries = run.kept(contracts.weight_entries(weighting.select(F.col("paper_id").alias("tree_id"), F.parse_json("json").alias("plan"))).filter("problem IS NULL"), "weights")
    alive = lambda rows: run.going(rows.withColumn("paper_id", F.col("tree_id"))).drop("paper_id")
    nodes = run.kept(tree.apply_weights(alive(nodes), entries), "weighted")

    def found(some: DataFrame, code_only: bool = False) -> DataFrame:
        return run.kept(rules.tree_violations(some, code_only), "violations")

    broken, repairs = found(nodes), []
    subjects = lambda: run.going(known).select(F.col("paper_id").alias("tree_id"))
    giving_up = spark.createDataFrame([], "tree_id string")
    for n in range(1, conf.repairs + 1):
        unsound = rules.report(subjects(), broken, "tree_id").filter("NOT valid").select("tree_id").join(giving_up, "tree_id", "left_anti")
        unsound = run.kept(unsound, f"unsound-{n}")
        if unsound.isEmpty():
            break
        problems = broken.filter("severity = 'error'").groupBy("tree_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("node_id", "rule")))).alias("problems"))
        calls = tree.as_json(nodes.join(unsound, "tree_id", "left_semi")).join(problems, "tree_id").withColumnRenamed("tree_id", "paper_id")
        mended = run.told(calls.select(*_one(f"repair-{n:02d}", F.concat(ask("repair"), _part("tree", F.col("json")), _part("problems", F.col("problems"))))), f"repair-{n}")
        repairs.append(mended.withColumn("ord", F.lit(n)))
        new = flatten_trees(mended.select(F.col("paper_id").alias("tree_id"), F.to_json(_get("json", "$.rubric", "variant")).alias("json")))
        new = run.kept(new, f"repaired-{n}")
        bad = new.filter("fault IS NOT NULL").select("tree_id").distinct()
        giving_up = run.kept(giving_up.union(bad), f"given-up-{n}")
        sound = normal_tree(new.join(bad, "tree_id", "left_anti"))
        nodes = run.kept(alive(nodes.join(sound.select("tree_id").distinct(), "tree_id", "left_anti").unionByName(sound, allowMissingColumns=True)), f"trees-{n}")
        broken = found(nodes)

    nodes = run.kept(tree.apply_weights(alive(nodes), entries), "final")
    audit = tree.audit_weights(nodes, entries).groupBy("tree_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("problem", "node_id")))).alias("application"))
    full_report = rules.report(subjects(), found(nodes), "tree_id").select("tree_id", F.col("valid").alias("full_valid"))
    complete = nodes
    if code:
        nodes = run.kept(tree.prune_to(nodes).drop("path"), "pruned")
    broken = found(nodes, code)
    made = [r.groupBy("paper_id").agg(F.lit(1).alias("n")) for r in repairs]
    rounds = made[0] if made else spark.createDataFrame([], "paper_id string, n int")
    for r in made[1:]:
        rounds = rounds.union(r)
    rounds = rounds.groupBy(F.col("paper_id").alias("tree_id")).agg(F.sum("n").alias("repairs"))
    report = rules.report(subjects(), broken, "tree_id").join(full_report, "tree_id").join(rounds, "tree_id", "left").na.fill(0, ["repairs"])
    report = run.kept(report.withColumnRenamed("tree_id", "paper_id"), "report")
    problems = broken.groupBy(F.col("tree_id").alias("paper_id")).agg(F.to_json(F.array_sort(F.collect_list(F.struct("severity", "node_id", "rule")))).alias("problems"))
    drafts = run.kept(tree.as_json(nodes).withColumnRenamed("tree_id", "paper_id"), "drafts")
    shown = run.kept(drafts.join(known, "paper_id").join(problems, "paper_id", "left").withColumn("mode", F.lit(MODES[conf.mode])), "shown")
    parts = [_part("mode", F.col("mode")), _part("addendum", F.col("addendum")), _part("tree", F.col("json"))]
    review = run.told(shown.select(*_one("review", F.concat(ask("review"), *parts, _part("matrix", F.col("matrix")), _part("validation", F.col("problems"))))), "review")
    wanted = review.filter(F.coalesce(_get("json", "$.judge_addendum.needed", "boolean"), F.lit(False))).select("paper_id", F.col("json").alias("review"))
    blank = lambda v: F.when(~F.coalesce(F.trim(F.try_variant_get(v, "$.judge_addendum_markdown", "string")) != "", F.lit(False)), "judge-addendum has no text")
    hidden = run.told(shown.join(wanted, "paper_id").select(*_one("judge-addendum", F.concat(ask("judge-addendum"), *parts, _part("review", F.col("review"))))), "judge-addendum", blank)

    sources = [matrix, addendum, plan, weighting, grown, review, hidden, *repairs]
    questions = [run.going(s).select("paper_id", F.lit(i).alias("source"), "ord", F.posexplode(_get("json", "$.unresolved_questions", "array<variant>")).alias("pos", "q")) for i, s in enumerate(sources)]
    every = questions[0]
    for q in questions[1:]:
        every = every.unionByName(q)
    every = every.select("paper_id", F.struct("source", "ord", "pos").alias("at"), F.to_json("q").alias("question")).groupBy("paper_id", "question").agg(F.min("at").alias("at"))
    every = run.kept(every, "questions")

    named = lambda rows, path, text: rows.select("paper_id", F.lit(path).alias("path") if isinstance(path, str) else path.alias("path"), F.coalesce(text, F.lit("null")).alias("text"))
    json = F.col("json")
    as_lists = every.groupBy("paper_id").agg(F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "question"))), lambda x: x["question"]), ", "), F.lit("]")).alias("json"))
    whole = tree.as_json(complete).withColumnRenamed("tree_id", "paper_id")
    derived = {"code_dev_derivation": F.lit(conf.tag), "full_rubric_sha256": F.sha2("json", 256)} if code else {}
    sourced = run.papers.join(whole, "paper_id", "left") if code else run.papers
    provenance = F.to_json(F.struct("paper_id", *(c.alias(n) for n, c in derived.items()), F.lit(conf.mode).alias("rubric_mode"), F.lit("regular").alias("authoring_mode"), F.sha2("text", 256).alias("paper_md_sha256"), F.sha2("metadata", 256).alias("task_metadata_sha256"), F.sha2(F.lit(guide), 256).alias("guide_sha256"), F.lit("draft-needs-human-review").alias("status")))
    ends = lambda text: F.concat(F.regexp_replace(text, r"(?U)\s+$", ""), F.lit("\n"))
    out = [
        named(known, "paper_elements.json", F.concat(F.lit('{"chunks": '), "elements", F.lit("}"))), named(matrix, "contribution_evidence_matrix.json", json), named(known, "addendum.draft.md", ends(F.col("addendum"))), named(addendum, "addendum_generation.json", json),
        named(plan, "rubric_tree_plan.json", json), named(grown, F.concat(F.lit("rubric_subtrees/"), F.expr("substring(call, 9)"), F.lit(".json")), json), named(unweighted, "rubric_tree_unweighted.json", json), named(weighting, "rubric_weight_plan.json", json),
        named(known.join(audit.withColumnRenamed("tree_id", "paper_id"), "paper_id", "left"), "rubric_weight_application.json", F.coalesce("application", F.lit("[]"))), named(drafts, "rubric.draft.json", json), named(review, "quality_review.json", json),
        named(known.join(as_lists, "paper_id", "left"), "unresolved_questions.json", F.coalesce(json, F.lit("[]"))), named(report, "validation_report.json", F.to_json(F.struct(*report.columns))), named(sourced, "authoring_provenance.json", provenance),
        named(hidden, "judge_addendum_generation.json", json), named(hidden, "judge.addendum.draft.md", ends(_get("json", "$.judge_addendum_markdown", "string"))),
    ]
    if code:
        out.append(named(whole, "rubric.full.draft.json", json))
    files = out[0]
    for rows in out[1:]:
        files = files.unionByName(rows)
    return {"files": run.kept(run.going(files), "files"), "reports": run.going(report), "unresolved": run.going(every).orderBy("paper_id", "at").select("paper_id", "question"), "stopped": run.stopped}


def unauthored(files: DataFrame, guide: str, conf: Authoring = Authoring()) -> DataFrame:
    """`files` as of `conversion.project_files` to `(paper_id, metadata, text, started, current)`: papers with what is authored from them, whether a draft has been begun, and whether it is whole and made from what the paper, its
    metadata, the guide and the options are now."""
    at = lambda place, name: (F.col("place") == place) & (F.col("name") == name)
    pick = lambda place, name: F.max(F.when(at(place, name), F.make_valid_utf8(F.col("content").cast("string"))))
    names = [FOLDER + n for n in NEEDED.values()]
    few = files.filter(at("paper_sources", "paper.md") | at("design", "task_metadata.json") | ((F.col("place") == "design") & F.col("name").isin(*names)))
    rows = few.groupBy("paper_id").agg(
        pick("paper_sources", "paper.md").alias("text"), F.coalesce(pick("design", "task_metadata.json"), F.lit("{}")).alias("metadata"), pick("design", FOLDER + NEEDED["provenance"]).alias("provenance"),
        F.count_if((F.col("place") == "design") & F.col("name").isin(*names)).alias("there"),
    ).withColumn("v", strict_json(F.col("provenance")))
    made_from = {"paper_md_sha256": F.sha2("text", 256), "task_metadata_sha256": F.sha2("metadata", 256), "guide_sha256": F.sha2(F.lit(guide), 256), "rubric_mode": F.lit(conf.mode), "code_dev_derivation": F.lit(conf.tag if contracts.code_only_of(conf.mode) else None).cast("string")}
    same = [F.try_variant_get("v", f"$.{n}", "string").eqNullSafe(c) for n, c in made_from.items()]
    current = F.col("there") == len(names)
    for s in same:
        current = current & s
    return rows.select("paper_id", "metadata", "text", (F.col("there") > 0).alias("started"), current.alias("current"))


def author_project(spark: SparkSession, root: str, ids: list[str], guide: str, asker: models.Asker, conf: Authoring = Authoring(), existing: str = "refuse") -> dict[str, DataFrame]:
    """Drafts for papers of the project at `root`, written below `design/<paper>/rubric_authoring`, which `release.release` publishes. `existing` drafts are refused, made again (`overwrite`), or made again where they
    are not whole or one of their inputs has changed (`changed`). Gives what `author` gives, with `written(path, bytes, sha256)`. A paper without text stops."""
    if existing not in ("refuse", "overwrite", "changed"):
        raise ValueError(f"no such choice: {existing!r}")
    wanted = spark.createDataFrame([(i,) for i in dict.fromkeys(ids)], "paper_id string")
    rows = kept_table(spark, wanted.join(unauthored(project_files(spark, root, wanted, {"paper.md", "task_metadata.json", *NEEDED.values()}), guide, conf), "paper_id", "left"), "to-author")
    if existing == "refuse":
        begun = [r.paper_id for r in rows.filter("started").orderBy("paper_id").take(20)]
        if begun:
            raise FileExistsError(f"drafts are there: {begun}")
    if existing == "changed":
        rows = rows.filter("NOT coalesce(current, false)")
    unread = rows.filter("text IS NULL").select("paper_id", F.lit("paper").alias("call"), F.lit("no text").alias("problem"))
    made = author(spark, rows.filter("text IS NOT NULL").select("paper_id", "metadata", "text"), guide, asker, f"{root}/_runs", conf)
    files = made["files"].select(F.concat(F.lit("design/"), "paper_id", F.lit(f"/{FOLDER}"), "path").alias("path"), F.encode("text", "utf-8").alias("content"))
    # the provenance comes last: a draft that breaks off is not current
    last = F.endswith("path", F.lit("/" + NEEDED["provenance"]))
    written = kept_table(spark, sinks.write_files(files.filter(~last), root, overwrite=True), "drafts")
    written = written.union(kept_table(spark, sinks.write_files(files.filter(last), root, overwrite=True), "provenance"))
    return made | {"written": written, "stopped": made["stopped"].union(unread)}


def grade(spark: SparkSession, submissions: DataFrame, nodes: DataFrame, files: DataFrame, papers: DataFrame, runs: DataFrame, asker: models.Asker, folder: str, code_only: bool = False) -> dict[str, DataFrame]:
    """Submissions graded from their files to their rewards: `submissions` as in `grading.graded` with `paper_id` and `title`, `files(submission_id, executed, path, bytes, text)`, `papers(paper_id, paper_md, addendum, blacklist, judge_addendum)`,
    `runs(submission_id, exit_code, stdout, stderr, file_manifest)`. Each leaf is asked by itself; answers go to a ledger below `folder`, and the rewards to files of it. Gives `leaves`,
    `records` and `written`."""
    at = f"{folder}/rounds/{uuid.uuid4().hex[:12]}"

    def kept(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{at}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{at}/{name}")

    def seen(executed: bool, prefix: str) -> DataFrame:
        own = evidence.evidence_text(files.filter(F.col("executed") == executed).drop("executed"))
        listing = evidence.ranked(files.filter(F.col("executed") == executed).select("submission_id", "path", "bytes"))
        listing = listing.groupBy("submission_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("place", "path", "bytes"))), lambda x: F.struct(x["path"].alias("path"), x["bytes"].alias("bytes")))).alias(f"{prefix}_files"))
        return listing.join(own.select("submission_id", F.col("text").alias(f"{prefix}_text")), "submission_id", "left")

    whole = submissions.filter(F.coalesce("valid", F.lit(False)) & ~F.coalesce("failed", F.lit(False))).select("submission_id", "tree_id", "paper_id", "title")
    own = tree.prune_to(nodes) if code_only else nodes
    leaves = tree.leaf_contexts(own).select("tree_id", "context", F.col("node_id").alias("leaf_id"))
    leaves = grading.compact_leaves(own, code_only).select("tree_id", "leaf_id", "requirements").join(leaves, ["tree_id", "leaf_id"], "left")
    summary = grading.excerpts(runs, grading.RUN_PARTS).select("submission_id", F.to_json(F.struct(*grading.RUN_PARTS)).alias("run"))
    rows = whole.join(seen(False, "raw"), "submission_id", "left").join(seen(True, "executed"), "submission_id", "left").join(summary, "submission_id", "left").join(papers, "paper_id", "left")
    asked = grading.prompts(rows.withColumn("code_only", F.lit(code_only)).join(leaves, "tree_id"))
    calls = asked.select(F.concat_ws("/", "submission_id", "leaf_id").alias("call_id"), F.col("submission_id").alias("paper_id"), F.col("leaf_id").alias("call"), "prompt")
    calls = kept(calls, "calls")
    told = models.Ledger(spark, f"{folder}/ledger", asker)(calls)
    answers = kept(calls.drop("prompt").join(told, "call_id").select(F.col("paper_id").alias("submission_id"), F.col("call").alias("leaf_id"), F.col("answer").alias("response"), "error"), "answers")
    scored, records = grading.graded(submissions, nodes, answers, code_only)
    scored, records = kept(scored, "leaves"), kept(records, "records")
    written = kept(sinks.write_files(sinks.reward_files(records), f"{folder}/rewards", overwrite=True), "written")
    return {"leaves": scored, "records": records, "written": written}
