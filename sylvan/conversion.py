"""Authored papers to a batch of tasks: bundles are chosen, cut down to code where only code counts, held against their approvals and the time that judging takes, then
written as task folders, read back, validated and put as the next version of the batch.

A project folder holds `paper_sources/<paper>/` (paper.pdf, paper.md, blacklist.txt, assets, and what was published) and `design/<paper>/` (task_metadata.json, and drafts
below rubric_authoring). Files go from a task that reads them to a task that writes them; the driver holds options, templates and the first rows of what is broken."""

from __future__ import annotations

import datetime
import hashlib
import json
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.render import Listed, Plain, toml
from .functions.text import strict_json
from .operators import batch, contracts, intake, packaging, profile, rules, score, tree
from .sources import sinks
from .sources.files import file_tree, flatten_trees, folder_listing, normal_tree, paper_list
from .sources.tables import kept
from .sources.versions import Versions

#: What a judge is told of a paper that brings nothing of its own.
JUDGE_NOTES = {
    "regular": "# For the judge\n\nCode, the script that runs it, its logs and its outputs are evidence. A leaf on code asks for code that does it, one on execution for a run that shows in logs or outputs, "
    "one on results for outputs that bear the claim out. Each leaf counts by itself; layouts may differ. Results that no code gives count for nothing.\n",
    "code-dev": "# For the judge\n\nCommitted code and its README are evidence; nothing is run, and no logs or results are asked for. Each leaf asks for code that does it, whatever its layout. "
    "Text that only claims, and made-up outputs, count for nothing.\n",
}
#: Where the files of a bundle lie: state, folder, names of tree, addendum, judge's addendum and of the record that tells its mode.
STATES = {
    "published": ("paper_sources/{}/", "rubric.json", "addendum.md", "judge.addendum.md", "human_approval.json"),
    "draft": ("design/{}/rubric_authoring/", "rubric.draft.json", "addendum.draft.md", "judge.addendum.draft.md", "authoring_provenance.json"),
}
INPUTS = ("paper.pdf", "paper.md", "blacklist.txt")


@dataclass(frozen=True)
class Conversion:
    """approved: published bundles alone, with an approval of their digests. limit: seconds that a task's grading may take, of which `reproduction` go to the run (none where only code
    counts) and `request` to each wave of `workers` leaves. image: what containers are made of."""

    batch_id: str
    label: str = "papers"
    contract: batch.Contract = batch.Contract()
    approved: bool = False
    judge: str = ""
    limit: int = 606_100
    reproduction: int = 604_800
    request: int = 600
    workers: int = 100
    image: str = ""

    @property
    def run(self) -> int:
        return 0 if contracts.code_only_of(self.contract.mode) else self.reproduction


def _broken(held: DataFrame, what: str) -> None:
    found = [tuple(r) for r in held.take(20)]
    if found:
        raise ValueError(f"{what}: {found}")


def checked_options(spark: SparkSession, conf: Conversion) -> None:
    """Refuses options that no batch can be made with."""
    row = {"chunk_chars": 10_000, "workers": conf.workers, "paper_workers": 1, "papers": 1, "total_timeout": conf.limit, "needed": conf.request + conf.run + 60}
    columns = [F.lit(v).alias(k) for k, v in row.items()] + [F.lit(False).alias("overwrite"), F.lit(False).alias("resume"), F.lit(None).cast("string").alias("switch_model"), F.lit(None).cast("int").alias("switch_after")]
    options = spark.range(1).select(*columns, F.lit(conf.batch_id).alias("batch_id"), F.array(F.lit(conf.limit), F.lit(conf.reproduction), F.lit(conf.request)).alias("timeouts"))
    _broken(rules.violations(options, contracts.option_rules(), []).select("rule"), "options")


def selected(spark: SparkSession, path: str, ids: list[str] | None = None) -> DataFrame:
    """`(paper_id, title, ord, entry)` of a list of papers, of some of them if `ids` are given: in the list's order, whatever theirs is. A list that breaks a rule is refused, as are ids
    that it doesn't hold. The list is one document, which one task reads."""
    _, papers = paper_list(spark, path)
    papers = kept(spark, papers.select("ord", F.to_json("paper").alias("entry")), "papers").withColumn("paper", F.parse_json("entry"))
    _broken(rules.violations(rules.paper_entries(papers), rules.paper_rules(), ["label"]).select("label", "rule"), "list of papers")
    get = lambda name: F.try_variant_get("paper", f"$.{name}", "string")
    every = papers.select(get("id").alias("paper_id"), get("title").alias("title"), "ord", "entry")
    if ids is None:
        return every
    wanted = spark.createDataFrame([(i,) for i in ids], "paper_id string")
    _broken(packaging.unknown(every, wanted), "unknown papers")
    return packaging.select_in_order(every, wanted)


def project_files(spark: SparkSession, root: str, papers: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """`(paper_id, place, name, bytes, content)` of the papers' files in a project folder, of all or those of some file names, place being the folder above all papers. With names, papers and assets aren't read for the sake of small texts."""
    versions = Versions(spark, root)
    parts = []
    for place in ("paper_sources", "design"):
        if versions.store.exists(versions._path(f"{root}/{place}")):
            rows = file_tree(spark, f"{root}/{place}", names)
            parts.append(rows.select(F.split_part("path", F.lit("/"), F.lit(1)).alias("paper_id"), F.lit(place).alias("place"), F.regexp_replace("path", "^[^/]+/", "").alias("name"), "bytes", "content"))
    if not parts:
        raise FileNotFoundError(root)
    return reduce(DataFrame.union, parts).join(papers.select("paper_id"), "paper_id", "left_semi")


def candidates(files: DataFrame) -> DataFrame:
    """`files` as of `project_files` to `(paper_id, state, mode, tag, rubric, addendum, judge_addendum, record)`: the bundles that are there, of those that have tree and addendum both. A bundle's mode is
    what its record says, regular if there is none."""
    inside = F.regexp_replace("name", "^rubric_authoring/", "")
    own = files.filter((F.col("place") == "paper_sources") | F.startswith("name", F.lit("rubric_authoring/"))).withColumn("inside", F.when(F.col("place") == "design", inside).otherwise(F.col("name")))
    names = {state: (folder.split("/")[0], *rest) for state, (folder, *rest) in STATES.items()}
    text = F.make_valid_utf8(F.col("content").cast("string"))
    pick = lambda place, name: F.max(F.when((F.col("place") == place) & (F.col("inside") == name), text))
    digest = lambda place, name: F.max(F.when((F.col("place") == place) & (F.col("inside") == name), F.sha2("content", 256)))
    wanted = own.filter(F.col("inside").isin(*{n for _, *rest in names.values() for n in rest}))
    # the approval of what was published lies among the drafts
    columns = {f"{state}_{field}": pick("design" if field == "record" else place, name) for state, (place, *rest) in names.items() for field, name in zip(("rubric", "addendum", "judge_addendum", "record"), rest, strict=True)}
    columns |= {f"{state}_{field}_sha256": digest(place, name) for state, (place, *rest) in names.items() for field, name in zip(("rubric", "addendum"), rest[:2], strict=True)}
    rows = wanted.groupBy("paper_id").agg(*(c.alias(n) for n, c in columns.items()))
    each = F.array(*(F.struct(F.lit(s).alias("state"), *(F.col(f"{s}_{f}").alias(f) for f in ("rubric", "addendum", "judge_addendum", "record", "rubric_sha256", "addendum_sha256"))) for s in names))
    out = rows.select("paper_id", F.explode(each).alias("b")).select("paper_id", "b.*").filter("rubric IS NOT NULL AND addendum IS NOT NULL").withColumn("v", strict_json(F.col("record")))
    get = lambda name: F.try_variant_get("v", f"$.{name}", "string")
    return out.withColumns({"mode": F.coalesce(get("rubric_mode"), F.lit("regular")), "tag": get("code_dev_derivation"), "approved_rubric": get("rubric_sha256"), "approved_addendum": get("addendum_sha256")}).drop("v")


def chosen(found: DataFrame, conf: Conversion) -> DataFrame:
    """One of the `candidates` a paper: what is published comes first, and drafts come not at all where approval is asked. Where only code counts a complete tree does as well, since it is cut down."""
    mode = conf.contract.mode
    return packaging.choose_bundle(found, (mode,) if mode == "regular" else (mode, "regular"), conf.approved)


def trees_of(spark: SparkSession, bundles: DataFrame, conf: Conversion) -> tuple[DataFrame, DataFrame]:
    """(`(paper_id, json, leaves)`, `(paper_id, rule)` of errors) of the bundles' trees as the tasks will hold them. Of a tree that is cut down what stays has to be sound, and what is no
    node at all is an error wherever it stands."""
    flat = kept(spark, flatten_trees(bundles.select(F.col("paper_id").alias("tree_id"), F.col("rubric").alias("json"))), "flat")
    if not contracts.code_only_of(conf.contract.mode):
        found = rules.json_tree_violations(flat)
        texts = bundles.select("paper_id", F.col("rubric").alias("json"))
        leaves = tree.leaves(normal_tree(flat))
    else:
        nodes = kept(spark, tree.prune_to(normal_tree(flat)).drop("path"), "pruned")
        structure = rules.violations(flat, rules.structure_rules(), tree.KEY + ["fault"])
        stays = nodes.select(*tree.KEY, F.lit(True).alias("stays"))
        structure = structure.join(stays, tree.KEY, "left").filter("stays OR fault IS NOT NULL").drop("stays", "fault")
        found = structure.unionByName(rules.tree_violations(nodes, True))
        texts = tree.as_json(nodes).withColumnRenamed("tree_id", "paper_id")
        leaves = tree.leaves(nodes)
    counts = leaves.groupBy(F.col("tree_id").alias("paper_id")).agg(F.count("*").alias("leaves"))
    errors = found.filter("severity = 'error'").select(F.col("tree_id").alias("paper_id"), F.concat(F.lit("rubric: "), "rule", F.coalesce(F.concat(F.lit(" at "), "node_id"), F.lit(""))).alias("rule"))
    return texts.join(counts, "paper_id", "left"), errors


def held_back(papers: DataFrame, files: DataFrame, bundles: DataFrame, trees: DataFrame, tree_errors: DataFrame, conf: Conversion) -> DataFrame:
    """(paper_id, rule) of all that keeps a paper from becoming a task."""
    mode, tag = conf.contract.mode, conf.contract.tag
    code = contracts.code_only_of(mode)
    only = lambda found: found.filter("severity = 'error'").select("paper_id", "rule")
    untitled = papers.filter(F.coalesce(F.trim("title"), F.lit("")) == "").select("paper_id", F.lit("title is empty").alias("rule"))
    wanted = papers.select("paper_id", F.explode(F.array(*map(F.lit, INPUTS))).alias("name"))
    there = files.filter("place = 'paper_sources'").select("paper_id", "name")
    absent = wanted.join(there, ["paper_id", "name"], "left_anti").select("paper_id", F.concat(F.lit("missing "), "name").alias("rule"))
    without = papers.join(bundles, "paper_id", "left_anti").select("paper_id", F.lit(f"no {'approved ' if conf.approved else ''}bundle for {mode}").alias("rule"))
    addenda = only(rules.violations(bundles, rules.addendum_rules(F.col("addendum")), ["paper_id"])).withColumn("rule", F.concat(F.lit("addendum: "), "rule"))
    fits = score.timeout_plan(trees.select(F.col("paper_id").alias("tree_id"), "leaves"), conf.workers, conf.request, conf.run, conf.limit).select(F.col("tree_id").alias("paper_id"), "fits")
    count = lambda rows, name: rows.groupBy("paper_id").agg(F.count("*").alias(name))
    pair = lambda a, b: F.create_map(F.lit("rubric"), a, F.lit("addendum"), b)
    rows = bundles.join(trees.select("paper_id", "leaves"), "paper_id", "left").join(fits, "paper_id", "left").join(count(tree_errors, "tree_errors"), "paper_id", "left").join(count(addenda, "addendum_errors"), "paper_id", "left")
    # only a tree that was cut down before names how
    derived = F.when(F.col("mode") == "code-dev", F.col("tag")).otherwise(F.lit(tag)) if code else F.lit(tag)
    rows = rows.withColumns({"tag": derived, "approved_hashes": pair("approved_rubric", "approved_addendum"), "actual_hashes": pair("rubric_sha256", "addendum_sha256")})
    gate = rules.violations(rows, contracts.conversion_rules(tag if code else None, conf.approved), ["paper_id"])
    return reduce(DataFrame.union, [untitled, absent, without, tree_errors.select("paper_id", "rule"), addenda, only(gate)])


def configuration(conf: Conversion, commit: str) -> Column:
    """The TOML text of a task, of a row with `paper_id`, `task_id`, `title`, `leaves`, `resource`, and its files' `bytes`, `files` and `kinds`."""
    code, gpu = contracts.code_only_of(conf.contract.mode), conf.contract.gpu
    machine = {"network_mode": "public", "os": "linux"}
    size = lambda cpus, memory, workdir: {"cpus": cpus, "memory_mb": memory, "storage_mb": 16_384, "gpus": 1, "gpu_types": [gpu], "docker_image": conf.image, "workdir": workdir}
    paper = F.col("paper_id")
    tagged = {"code_dev_derivation": conf.contract.tag} if code and conf.contract.tag else {}
    return toml({
        "": {"schema_version": "1.4", "artifacts": ["/home/submission"]},
        "task": {
            "name": F.concat(F.lit(f"{conf.label}/"), "task_id"), "description": F.concat(F.lit("Implement the core methods of " if code else "Reproduce the core methods and experiments of "), "title"),
            "keywords": Listed(F.array_sort(F.array_distinct(F.array(paper, F.lit("paper-reproduction"), F.lit("research"), F.lit(conf.label))))),
        },
        "metadata": {
            "benchmark": conf.label, "source_native_contract": "paperbench_authored_task_v1", "construction_format": "native_rollout_task_v1", "paper_id": paper, "native_task_id": paper, "source_task_key": paper,
            "rubric_leaf_count": Plain(F.col("leaves")), "oracle_available": False, "reference_solution_available": False, "scoring_method": "llm_rubric_judge", "judge_mode": "llm_code_dev" if code else "llm_full", "code_only": code, "rubric_mode": conf.contract.mode,
            **tagged, "paper_resource_profile": F.col("resource"), "rollout_resource_profile": "gpu_capable", "reproduction_resource_profile": "not_executed" if code else "gpu_capable", "pipeline_commit": commit,
            "resource_metadata_version": conf.contract.version, "resource_metadata_file": "resource_metadata.json", "data_total_bytes": Plain(F.col("bytes")), "data_file_count": Plain(F.col("files")), "data_kinds": Listed(F.col("kinds")),
            "gpu_tier": gpu, "gpu_required": True, "gpu_count": 1, "estimated_training_time_tier": batch.TIME_TIER, "estimated_vram_gb_typical": Plain(F.format_string("%.0f", batch.memory(F.col("resource"))["typical"])),
            "resource_estimate_confidence": batch.CONFIDENCE, "resource_estimate_model": conf.contract.estimator,
        },
        "agent": {"timeout_sec": conf.limit}, "verifier": {"timeout_sec": conf.limit, "environment_mode": "separate"},
        "verifier.env": {"JUDGE_MODEL": conf.judge, "JUDGE_TIMEOUT_SEC": str(conf.request), "JUDGE_MAX_WORKERS": str(conf.workers), "REPRODUCTION_TIMEOUT_SEC": str(conf.reproduction)},
        "verifier.environment": {"build_timeout_sec": 900, **machine, **size(2, 4_096, "/tests")}, "environment": {"build_timeout_sec": 1_200, **machine, **size(4, 8_192, "/home")},
    })


def task_files(spark: SparkSession, bundles: DataFrame, inputs: DataFrame, templates: dict[str, bytes], instructions: bytes, conf: Conversion, old_title: str | None = None) -> DataFrame:
    """`(task_id, path, content)` of a task for each of `bundles(paper_id, title, metadata, json, leaves, addendum, judge_addendum)`, `json` being its tree; a path that ends in a slash is a folder. `inputs(paper_id, name, bytes, content)` are the
    paper's files. `old_title` in the solution's README gives way to the paper's."""
    code, tag = contracts.code_only_of(conf.contract.mode), conf.contract.tag
    task = packaging.task_id(F.lit(conf.batch_id), F.col("paper_id"), conf.label)
    digest = hashlib.sha256()
    for label, content in sorted([("instruction.md", instructions), *templates.items()]):
        digest.update(label.encode() + b"\0" + content + b"\0")
    text = lambda c: F.encode(c, "utf-8")
    ends = lambda c: F.when(F.endswith(c, F.lit("\n")), c).otherwise(F.concat(c, F.lit("\n")))
    judge = {
        "judge_mode": F.lit("llm_code_dev" if code else "llm_full"), "code_only": F.lit(code), "rubric_mode": F.lit(conf.contract.mode), "code_dev_derivation": F.lit(tag if code else None), "paper_id": F.col("paper_id"), "title": F.col("title"),
        "judge_model_env": F.lit("JUDGE_MODEL"), "request_mode": F.lit("per_leaf"), "max_workers": F.lit(conf.workers),
    }
    made = {
        "environment/paper/addendum.md": text("addendum"), "environment/paper/assets/": F.lit(b""), "tests/rubric.json": text(ends(F.col("json"))),
        "tests/judge.addendum.md": text(F.coalesce("judge_addendum", F.lit(JUDGE_NOTES[conf.contract.mode]))), "tests/judge_config.json": text(sinks.pretty_json(F.struct(*(c.alias(n) for n, c in judge.items())))),
        "instruction.md": F.lit(instructions), **{p: F.lit(c) for p, c in templates.items()},
    }
    if old_title is not None:
        made["solution/README.md"] = text(F.replace(F.lit(templates["solution/README.md"].decode()), F.lit(old_title), F.col("title")))
    fixed = bundles.select("paper_id", F.explode(F.array(*(F.struct(F.lit(p).alias("path"), c.alias("content")) for p, c in made.items()))).alias("f")).select("paper_id", "f.*")
    fixed = kept(spark, fixed, "made").withColumn("bytes", F.octet_length("content").cast("long"))
    own = inputs.filter(F.col("name").isin(*INPUTS) | F.startswith("name", F.lit("assets/"))).join(bundles.select("paper_id"), "paper_id", "left_semi")
    own = own.select("paper_id", F.concat(F.lit("environment/paper/"), "name").alias("path"), "content", "bytes")
    walked = own.select("paper_id", "path", "bytes").union(fixed.select("paper_id", "path", "bytes")).filter(F.split_part("path", F.lit("/"), F.lit(1)).isin(*profile.SCOPES) & ~F.endswith("path", F.lit("/")))
    profiles = kept(spark, profile.whole_profile_json(walked.withColumnRenamed("paper_id", "set_id")), "profiles")
    v = F.try_parse_json("metadata")
    compute = lambda name: F.try_variant_get(v, f"$.compute.{name}", "string")
    rows = bundles.select("paper_id", "title", "leaves", task.alias("task_id"), compute("accelerator").alias("accelerator"), compute("notes").alias("notes"))
    rows = rows.join(profiles.withColumnRenamed("set_id", "paper_id"), "paper_id").withColumn("profile", F.col("json"))
    rows = batch.resource_record(rows, conf.contract, F.lit(datetime.datetime.now(datetime.timezone.utc).isoformat()))
    late = F.array(F.struct(F.lit("task.toml").alias("path"), text(configuration(conf, digest.hexdigest()[:40])).alias("content")), F.struct(F.lit("resource_metadata.json").alias("path"), text(F.concat("record", F.lit("\n"))).alias("content")))
    late = rows.select("paper_id", F.explode(late).alias("f")).select("paper_id", "f.*")
    return own.drop("bytes").union(fixed.drop("bytes")).union(late).select(task.alias("task_id"), "path", "content")


def put(spark: SparkSession, target: str, files: DataFrame, manifest: DataFrame, templates: dict[str, bytes], instructions: bytes, contract: batch.Contract, overwrite: bool = False) -> DataFrame:
    """`files(task_id, path, content)` and `manifest`, with `source_task_dir` in order, as the next version of the batch at `target` (see `sources.versions`): written to a folder of its own, read back with the modes and
    folders that are really there, validated, and put only if nothing is broken and nobody else has put one. Gives the manifest's lines. Where a store has no modes, none are checked."""
    versions = Versions(spark, target)
    before, there = versions.current()
    if there and not overwrite:
        raise FileExistsError(target)
    staged = versions.stage()
    mode = F.when(F.col("path").isin(*batch.EXECUTABLES), "755").otherwise("644")
    written = kept(spark, sinks.write_files(files.select(F.concat(F.lit("tasks/"), "task_id", F.lit("/"), "path").alias("path"), "content", mode.alias("mode")), staged), "written")
    packaging.as_json_lines(manifest.orderBy("source_task_dir", "task_id")).coalesce(1).write.text(f"{staged}/manifest")
    part = next(s.getPath() for s in versions.store.listStatus(versions._path(f"{staged}/manifest")) if s.getPath().getName().startswith("part-"))
    versions.store.rename(part, versions._path(f"{staged}/manifest.jsonl"))
    versions.store.delete(versions._path(f"{staged}/manifest"), True)

    back = file_tree(spark, f"{staged}/tasks").select(F.split_part("path", F.lit("/"), F.lit(1)).alias("task_id"), F.regexp_replace("path", "^[^/]+/", "").alias("path"), "content")
    digests = kept(spark, back.select("task_id", "path", F.sha2("content", 256).alias("sha256")), "digests")
    entries = kept(spark, folder_listing(digests.select("task_id").distinct(), f"{staged}/tasks").join(digests, ["task_id", "path"], "left"), "entries")
    pinned = spark.createDataFrame([(p, hashlib.sha256(c).hexdigest()) for p, c in templates.items() if p in batch.EXECUTABLES], "path string, sha256 string")
    texts = kept(spark, back.filter(F.col("path").rlike(r"\.(toml|md|json|py|sh)$")).select("task_id", "path", F.make_valid_utf8(F.col("content").cast("string")).alias("text")), "texts")
    lines = spark.read.text(f"{staged}/manifest.jsonl")
    numbered = lines.select(F.monotonically_increasing_id().alias("ord"), F.col("value").alias("line"))
    broken = [tuple(r) for r in batch.violations(numbered, entries, texts, pinned, hashlib.sha256(instructions).hexdigest(), flatten_trees, contract).take(20)]
    if not broken:
        differ = written.filter(~F.endswith("path", F.lit("/"))).select("path", "sha256").exceptAll(digests.select(F.concat_ws("/", F.lit("tasks"), "task_id", "path").alias("path"), "sha256"))
        broken = [(r.path, "file is not as it was written") for r in differ.take(20)]
    if broken:
        versions.store.delete(versions._path(staged), True)
        raise ValueError(f"not converted: {broken}")
    versions.put(staged, before)
    return lines


def convert(spark: SparkSession, root: str, papers: DataFrame, target: str, templates: dict[str, bytes], instructions: bytes, conf: Conversion, overwrite: bool = False) -> DataFrame:
    """`papers(paper_id, title, ord, entry)` (see `selected`) of the project at `root` as a batch at `target`: all of them or, if one is held back, none. `templates` are the files of a template task, its judge's configuration
    among them, whose title stands in the README. Gives the manifest's lines."""
    checked_options(spark, conf)
    if Versions(spark, target).current()[1] and not overwrite:
        raise FileExistsError(target)
    given = spark.createDataFrame([("t", p, c.decode(errors="replace")) for p, c in templates.items()], "template_id string, path string, text string")
    _broken(batch.template_problems(given).select("problem"), "template")
    old = json.loads(templates["tests/judge_config.json"])["title"]
    if old not in templates["solution/README.md"].decode():
        raise ValueError("template: the title is not in the README")
    papers = kept(spark, papers, "selected")
    if papers.isEmpty():
        raise ValueError("no papers")
    files = project_files(spark, root, papers)
    texts = project_files(spark, root, papers, {"task_metadata.json", *(n for _, *rest in STATES.values() for n in rest)})
    bundles = kept(spark, chosen(candidates(texts), conf), "bundles")
    trees, errors = trees_of(spark, bundles, conf)
    trees, errors = kept(spark, trees, "trees"), kept(spark, errors, "errors")
    stored = texts.filter("place = 'design' AND name = 'task_metadata.json'").select("paper_id", F.make_valid_utf8(F.col("content").cast("string")).alias("metadata"))
    metadata = kept(spark, intake.metadata_or_entry(papers.select("paper_id", "entry"), stored), "metadata")
    unread = metadata.filter(strict_json(F.col("metadata")).isNull()).select("paper_id", F.lit("metadata is no JSON").alias("rule"))
    _broken(held_back(papers, files, bundles, trees, errors, conf).union(unread).distinct().orderBy("paper_id", "rule"), "not converted")
    whole = papers.select("paper_id", "title").join(metadata.select("paper_id", "metadata"), "paper_id").join(trees, "paper_id").join(bundles.select("paper_id", "addendum", "judge_addendum"), "paper_id")
    inputs = files.filter("place = 'paper_sources'").select("paper_id", "name", "bytes", "content")
    held = {p: c for p, c in templates.items() if p != "tests/judge_config.json"}
    built = task_files(spark, whole, inputs, held, instructions, conf, old)
    # the list is one document, so its order is found where the list was read
    index = (F.row_number().over(Window.orderBy("ord")) - 1).alias("source_index")
    manifest = packaging.manifest(papers.select("paper_id", index), conf.batch_id, conf.label, "tasks")
    return put(spark, target, built, manifest, held, instructions, conf.contract, overwrite)
