"""Packaged batches of tasks: one table of violations over the manifest, the folders and the files of all tasks.

A check reads what it needs of two tables: the entries of the folders, without contents, and the texts of the few small files that
have rules. Every check is a filter, an aggregate a task or a join on the task, so nothing grows but with the batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strict_json, toml_as_json
from ..sources.tables import bounded_batches, kept
from . import contracts, packaging, profile, rules

#: What a task's folders hold, and which of its files may be run.
FOLDERS = {
    "": ("task.toml", "instruction.md", "resource_metadata.json", "tests", "solution", "environment"),
    "tests": ("test.sh", "llm_rubric_judge.py", "judge_config.json", "rubric.json", "judge.addendum.md"),
    "solution": ("reproduce.sh", "README.md"),
    "environment/paper": ("paper.pdf", "paper.md", "addendum.md", "blacklist.txt", "assets"),
}
FILES = tuple(f"{folder}/{name}".lstrip("/") for folder, names in FOLDERS.items() for name in names if name not in ("tests", "solution", "environment", "assets"))
EXECUTABLES = ("tests/test.sh", "tests/llm_rubric_judge.py", "solution/reproduce.sh")
DOCKERFILES = ("environment/Dockerfile", "tests/Dockerfile")
#: Texts that a file must hold (True) or must not (False); `{paper_id}` is the task's, `{gpu}` and `{version}` the contract's.
FRAGMENTS = [
    ("instruction.md", "/home/paper", True), ("instruction.md", "/home/submission", True),
    ("task.toml", 'schema_version = "1.4"', True), ("task.toml", 'artifacts = ["/home/submission"]', True), ("task.toml", 'source_native_contract = "paperbench_authored_task_v1"', True), ("task.toml", 'construction_format = "native_rollout_task_v1"', True),
    ("task.toml", 'paper_id = "{paper_id}"', True), ("task.toml", 'native_task_id = "{paper_id}"', True), ("task.toml", "reference_solution_available = false", True),
    ("task.toml", 'scoring_method = "llm_rubric_judge"', True), ("task.toml", 'resource_metadata_version = "{version}"', True), ("task.toml", 'gpu_tier = "{gpu}"', True), ("task.toml", "gpu_count = 1", True), ("task.toml", 'environment_mode = "separate"', True), ("task.toml", 'workdir = "/tests"', True),
    ("task.toml", 'workdir = "/home"', True), ("task.toml", "LLM_API_KEY", False), ("task.toml", "LLM_BASE_URL", False),
    ("task.toml", 'JUDGE_LLM_API_KEY = "${', False), ("task.toml", 'JUDGE_LLM_BASE_URL = "${', False),
    ("tests/llm_rubric_judge.py", "def score_rubric_tree(", True), ("tests/llm_rubric_judge.py", "def grade_leaf_requests(", True),
    ("tests/llm_rubric_judge.py", 'parser.add_argument("--submission-validation", type=Path, required=True)', True), ("tests/llm_rubric_judge.py", 'parser_invalid_reason = "leaf score must be exactly 0 or 1"', True),
    ("tests/llm_rubric_judge.py", 'api_key = env_value("JUDGE_LLM_API_KEY")', True), ("tests/llm_rubric_judge.py", 'base_url = env_value("JUDGE_LLM_BASE_URL")', True),
    ("tests/llm_rubric_judge.py", "ThreadPoolExecutor", True), ("tests/llm_rubric_judge.py", '"temperature"', False), ("tests/llm_rubric_judge.py", "'temperature'", False),
    ("tests/test.sh", "MAX_COMMITTED_BYTES = 1_000_000_000", True), ("tests/test.sh", '"tracked_worktree_clean"', True), ("tests/test.sh", '"committed_size_ok"', True),
    ("tests/test.sh", 'git -C "${CLEAN_SUBMISSION_DIR}" clean -fd', True), ("tests/test.sh", '--submission-validation "${LOGS_DIR}/preflight.json"', True), ("tests/test.sh", '--submission-dir "${CLEAN_SUBMISSION_DIR}"', True),
]
MODE_FRAGMENTS = {
    "regular": [("instruction.md", "for a maximum runtime of 7 days", True), ("instruction.md", "NVIDIA H200 GPU", True), ("instruction.md", "NVIDIA A10 GPU", False), ("task.toml", 'rubric_mode = "regular"', True), ("task.toml", "code_only = false", True)],
    "code-dev": [("instruction.md", "The code will not be executed during grading.", True), ("instruction.md", "for a maximum runtime of 7 days", False), ("task.toml", 'rubric_mode = "code-dev"', True), ("task.toml", "code_only = true", True)],
}


@dataclass(frozen=True)
class Contract:
    """mode: regular or code-dev. fragments: further texts of files, as FRAGMENTS. tag: the derivation that a code-dev task names. estimator: the name
    of the rules that estimate what a task needs."""

    mode: str = "regular"
    gpu: str = "H200"
    version: str = "resource_metadata_v3"
    fragments: tuple[tuple[str, str, bool], ...] = ()
    tag: str | None = None
    estimator: str = "rules-v1"


def manifest_rows(lines: DataFrame) -> DataFrame:
    """`lines(ord, line)` to `(ord, task_id, paper_id, problem)`."""
    rows = lines.withColumn("v", strict_json(F.col("line")))
    is_object = F.coalesce(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")), F.lit(False))
    own = F.array_sort(F.map_keys(F.try_variant_get("v", "$", "map<string,variant>")))
    problem = F.when(~is_object, "manifest line is no object").when(own != F.array(*map(F.lit, sorted(packaging.MANIFEST_KEYS))), "manifest keys differ")
    get = lambda name: F.when(is_object, F.try_variant_get("v", f"$.{name}", "string"))
    return rows.select("ord", get("task_id").alias("task_id"), get("paper_id").alias("paper_id"), problem.alias("problem"))


def _found(rows: DataFrame, rule: str | Column, detail: str | Column) -> DataFrame:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return rows.select("task_id", as_column(rule).alias("rule"), as_column(detail).cast("string").alias("detail"))


def _over(rows: DataFrame, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """(task_id, rule, detail) of the checks whose condition isn't true, in one pass."""
    marks = F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.struct(F.lit(rule).alias("rule"), F.lit(detail).alias("detail"))) for rule, detail, ok in checks))
    return rows.select("task_id", F.explode(F.filter(marks, lambda m: m.isNotNull())).alias("m")).select("task_id", "m.*")


def _json(texts: DataFrame, path: str) -> DataFrame:
    return texts.filter(F.col("path") == path).select("task_id", strict_json(F.col("text")).alias("v"))


def violations(lines: DataFrame, entries: DataFrame, texts: DataFrame, templates: DataFrame, instructions_sha256: str, flatten: Callable[[DataFrame], DataFrame], contract: Contract = Contract()) -> DataFrame:
    """(task_id, rule, detail) over `lines(ord, line)` of the manifest, `entries(task_id, path, is_folder, mode, bytes, sha256)`,
    `texts(task_id, path, text)` of the files with rules, and `templates(path, sha256)`. An empty manifest is a violation
    without a task."""
    manifest = manifest_rows(lines)
    folders = entries.select("task_id").distinct()
    files = entries.filter("not is_folder")
    named = manifest.filter("task_id is not null")
    empty = lines.agg(F.count("*").alias("n")).filter("n = 0").select(F.lit(None).cast("string").alias("task_id"))
    out = [
        _found(empty, "manifest is missing", ""),
        _found(manifest.filter("problem is not null"), F.col("problem"), F.col("ord")),
        _found(named.groupBy("task_id").count().filter("count > 1"), "task id is not unique", ""),
        _found(packaging.set_audit(named, folders, "task_id"), F.when(F.col("only_in") == "left", "task has no folder").otherwise("task is not in the manifest"), ""),
    ]
    folder_rows = contracts.folder_audit(entries, FOLDERS)
    out.append(_found(folder_rows, F.concat(F.lit("entry is "), "problem"), F.concat_ws("/", F.nullif(F.col("folder"), F.lit("")), "name")))
    required = folders.withColumn("path", F.explode(F.array(*map(F.lit, FILES))))
    out.append(_found(required.join(files.select("task_id", "path"), ["task_id", "path"], "left_anti"), "required file is missing", F.col("path")))
    out.append(_found(entries.filter(F.col("path").isin(*DOCKERFILES)), "Dockerfile is there", F.col("path")))
    out.append(_found(files.filter((F.col("path") == "instruction.md") & (F.col("sha256") != instructions_sha256)), "instructions differ", ""))
    out.append(_found(contracts.template_audit(files, templates).join(files.select("task_id", "path"), ["task_id", "path"], "left_semi"), "file differs from its template", F.col("path")))
    out.append(_found(contracts.mode_audit(entries, EXECUTABLES), "mode differs", F.col("path")))

    # texts that must or must not be there
    own = {"{gpu}": contract.gpu, "{version}": contract.version}
    pinned = [(file, reduce(lambda t, k: t.replace(k, own[k]), own, needle), wanted) for file, needle, wanted in (*FRAGMENTS, *MODE_FRAGMENTS[contract.mode], *contract.fragments)]
    needles = entries.sparkSession.createDataFrame(pinned, "file string, needle string, wanted boolean")
    with_paper = texts.withColumnRenamed("path", "file").join(named.dropDuplicates(["task_id"]).select("task_id", "paper_id"), "task_id", "left")
    broken = rules.text_rules(with_paper, needles, ["task_id"], F.replace(F.col("needle"), F.lit("{paper_id}"), F.coalesce("paper_id", F.lit(""))))
    out.append(_found(broken, F.when(F.col("wanted"), "text is missing").otherwise("text is forbidden"), F.concat_ws(": ", "file", "needle")))

    get = lambda path, kind: F.try_variant_get("v", path, kind)
    # what Python parses is parsed once, and read again by the checks
    spark = entries.sparkSession
    bounded_batches(spark)
    toml = kept(spark, texts.filter("path = 'task.toml'").select("task_id", toml_as_json("text").alias("json")), "toml").select("task_id", F.try_parse_json("json").alias("v"))
    is_object = lambda path: F.startswith(F.schema_of_variant(get(path, "variant")), F.lit("OBJECT"))
    out.append(_found(toml.filter("v is null"), "TOML does not parse", "task.toml"))
    code, tag = contracts.code_only_of(contract.mode), F.lit(contract.tag)
    checks = [("TOML has no metadata", "task.toml", is_object("$.metadata"))]
    checks += [("derivation is another one", "task.toml", ~is_object("$.metadata") | get("$.metadata.code_dev_derivation", "string").eqNullSafe(tag))] if code else []
    for section in ("environment", "verifier.environment"):
        checks += [("one GPU is asked", section, get(f"$.{section}.gpus", "bigint") == 1), ("GPU is of another kind", section, get(f"$.{section}.gpu_types", "array<string>") == F.array(F.lit(contract.gpu)))]
    out.append(_over(toml.filter("v is not null"), checks))
    kind = lambda path: F.schema_of_variant(get(path, "variant"))
    judge = [
        ("judge has another mode", "", get("$.rubric_mode", "string") == contract.mode), ("judge grades other code", "", (kind("$.code_only") == "BOOLEAN") & (get("$.code_only", "boolean") == F.lit(code))),
        ("judge does not ask leaf by leaf", "", get("$.request_mode", "string") == "per_leaf"), ("judge has no workers", "", (kind("$.max_workers") == "BIGINT") & (get("$.max_workers", "bigint") > 0)),
    ]
    judge += [("derivation is another one", "judge", get("$.code_dev_derivation", "string").eqNullSafe(tag))] if code else []
    out.append(_over(_json(texts, "tests/judge_config.json"), judge))
    resource = [
        ("resource record is of another version", "", get("$.schema_version", "string") == contract.version), ("GPU tier is another one", "estimate", get("$.resource_estimate.gpu_tier", "string") == contract.gpu),
        ("one GPU is asked", "estimate", get("$.resource_estimate.gpu_required", "boolean") & (get("$.resource_estimate.gpu_count", "bigint") == 1)),
        ("GPU tier is another one", "estimator", get("$.estimator.declared_gpu_tier", "string") == contract.gpu),
    ]
    metadata = _json(texts, "resource_metadata.json")
    out.append(_over(metadata, resource))
    trees = kept(spark, flatten(texts.filter("path = 'tests/rubric.json'").select(F.col("task_id").alias("tree_id"), F.col("text").alias("json"))), "flat")
    broken = rules.json_tree_violations(trees, code).filter("severity = 'error'")
    out.append(_found(broken.withColumnRenamed("tree_id", "task_id"), F.concat(F.lit("rubric: "), "rule"), F.coalesce("node_id", F.lit(""))))
    stored = metadata.select(F.col("task_id").alias("set_id"), get("$.data_profile", "variant").alias("profile"))
    walked = files.filter(F.split_part("path", F.lit("/"), F.lit(1)).isin(*profile.SCOPES)).select(F.col("task_id").alias("set_id"), "path", "bytes")
    out.append(_found(contracts.profile_audit(stored, walked).withColumnRenamed("set_id", "task_id"), "data profile differs", ""))
    return reduce(DataFrame.union, out)


def summary(lines: DataFrame, found: DataFrame) -> DataFrame:
    """(valid, violations, tasks): one row."""
    tasks = manifest_rows(lines).agg(F.count_if(F.col("problem").isNull() | (F.col("problem") != "manifest line is no object")).alias("tasks"))
    return tasks.crossJoin(found.agg(F.count("*").alias("violations"))).select((F.col("violations") == 0).alias("valid"), "violations", "tasks")


def rendered_instructions(template: DataFrame, expected_sha256: str, old: str, new: str) -> DataFrame:
    """`template(path, text)` with the one place of `old` replaced, or what keeps it from being the pinned template."""
    pinned = F.sha2("text", 256) == expected_sha256
    places = (F.length("text") - F.length(F.replace(F.col("text"), F.lit(old)))) / len(old)
    problem = F.when(~pinned, "template is not the pinned one").when(places != 1, "clause does not stand there once")
    return template.select("path", problem.alias("problem"), F.when(problem.isNull(), F.replace(F.col("text"), F.lit(old), F.lit(new))).alias("text"))


def template_problems(template: DataFrame) -> DataFrame:
    """(template_id, problem) over `template(template_id, path, text)`: files that a template must hold, and the title of its judge."""
    needed = ("solution/README.md", "solution/reproduce.sh", "tests/judge_config.json", "tests/llm_rubric_judge.py", "tests/test.sh")
    every = template.select("template_id").distinct().withColumn("path", F.explode(F.array(*map(F.lit, needed))))
    absent = every.join(template.select("template_id", "path"), ["template_id", "path"], "left_anti").select("template_id", F.concat(F.lit("missing "), "path").alias("problem"))
    title = F.try_variant_get(strict_json(F.col("text")), "$.title", "string")
    untitled = template.filter((F.col("path") == "tests/judge_config.json") & (F.coalesce(title, F.lit("")) == "")).select("template_id", F.lit("judge has no title").alias("problem"))
    return absent.union(untitled)


#: Video memory in GB that a class of machine is taken to need, as (least, typical, most).
MEMORY = {"cpu_sufficient": (1.0, 2.0, 6.0), "gpu_relevant": (2.0, 8.0, 20.0), "gpu_required_likely": (2.0, 8.0, 20.0)}
#: What every estimate says.
TIME_TIER, CONFIDENCE = "under_6h", 0.75


def memory(resource: Column) -> Column:
    """(min, typical, max) of a class."""
    found = F.create_map(*(x for k, (least, typical, most) in MEMORY.items() for x in (F.lit(k), F.struct(F.lit(least).alias("min"), F.lit(typical).alias("typical"), F.lit(most).alias("max")))))
    return F.try_element_at(found, resource)


def resource_record(tasks: DataFrame, contract: Contract = Contract(), created: Column | None = None) -> DataFrame:
    """`tasks(task_id, accelerator, notes, profile)`, profile a JSON text, with `resource`, its class, and `record`, the JSON of its resource metadata: the profile, an estimate that is declared by
    rules and not measured, and who estimated. `created`: a time stamp that the record carries."""
    tasks = tasks.withColumn("resource", profile.resource_class(F.col("accelerator"), F.col("notes")))
    reason = F.concat(F.lit("Declared by rules on the paper's own metadata; it is classed as "), "resource", F.lit(f". Grading uses one {contract.gpu} GPU, as the task does."))
    estimate = {
        "attempts": F.lit(1), "confidence": F.lit(CONFIDENCE), "estimated_vram_gb": memory(F.col("resource")), "gpu_count": F.lit(1), "gpu_required": F.lit(True), "gpu_tier": F.lit(contract.gpu),
        "reason": reason, "training_time_tier": F.lit(TIME_TIER),
    }
    estimator = {
        "declared_gpu_tier": F.lit(contract.gpu), "declared_max_gpus": F.lit(1), "model": F.lit(contract.estimator), "operator": F.lit("declared"), "prompt_version": F.lit(contract.version),
        "validation_history": F.array(F.array().cast("array<string>")),
    }
    named = lambda fields: F.struct(*(c.alias(n) for n, c in fields.items()))
    record = {"data_profile": F.try_parse_json("profile"), "estimator": named(estimator), "resource_estimate": named(estimate), "schema_version": F.lit(contract.version)}
    if created is not None:
        record["created_at"] = created
    return tasks.withColumn("record", F.to_json(named(record)))


def convert(bundles: DataFrame, batch: str, label: str, rules_broken: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`bundles(paper_id, source_index, files)`, `files` an array of (path, text), to what is published: the manifest and
    `(task_id, path, text)` of all tasks. With a broken rule nothing is converted."""
    if not rules_broken.isEmpty():
        raise ValueError(f"not converted: {[tuple(r) for r in rules_broken.take(20)]}")
    manifest = packaging.manifest(bundles, batch, label, "tasks")
    files = bundles.select(packaging.task_id(F.lit(batch), F.col("paper_id"), label).alias("task_id"), F.explode("files").alias("f"))
    return manifest, files.select("task_id", "f.*")
