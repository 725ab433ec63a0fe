"""Queries over packaged batches: a task for each supplier, with a fault by suppkey % 38, so that SQL can say what must be found."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from .. import conversion
from ..functions.text import toml_as_json
from ..operators import batch, contracts, packaging, profile, rules
from ..sources import files
from ..sources.tables import spread, table
from .checks import _LEAF, _cases

_INSTRUCTIONS = "Read /home/paper and write to /home/submission; it runs for a maximum runtime of 7 days on an NVIDIA H200 GPU."
#: A task without a fault, written by hand: what the contract asks of its files is not read from the catalogue that is tested on it.
_HEAD = """schema_version = "1.4"
artifacts = ["/home/submission"]
source_native_contract = "paperbench_authored_task_v1"
construction_format = "native_rollout_task_v1"
paper_id = "{paper_id}"
native_task_id = "{paper_id}"
reference_solution_available = false
scoring_method = "llm_rubric_judge"
rubric_mode = "regular"
code_only = false
resource_metadata_version = "resource_metadata_v3"
gpu_tier = "H200"
gpu_count = 1
environment_mode = "separate"
"""
_TOML = _HEAD + """[metadata]
kind = "x"
[environment]
workdir = "/home"
gpus = 1
gpu_types = ["H200"]
[verifier.environment]
workdir = "/tests"
gpus = 1
gpu_types = ["H200"]
"""
_JUDGE_PY = """from concurrent.futures import ThreadPoolExecutor
api_key = env_value("JUDGE_LLM_API_KEY")
base_url = env_value("JUDGE_LLM_BASE_URL")
parser.add_argument("--submission-validation", type=Path, required=True)
def score_rubric_tree(): ...
def grade_leaf_requests(): ...
parser_invalid_reason = "leaf score must be exactly 0 or 1"
"""
_TEST_SH = """MAX_COMMITTED_BYTES = 1_000_000_000
git -C "${CLEAN_SUBMISSION_DIR}" clean -fd
echo "tracked_worktree_clean" "committed_size_ok"
judge --submission-validation "${LOGS_DIR}/preflight.json" --submission-dir "${CLEAN_SUBMISSION_DIR}"
"""
_TREE = (
    '{"id": "root", "requirements": "r", "weight": 1, "sub_tasks": ['
    + ", ".join(_LEAF.format(id=f"leaf-{n}", cat=c) for n, c in enumerate(("Code Development", "Code Execution", "Result Analysis")))
    + '], "task_category": null, "finegrained_task_category": null}'
)
_JUDGE = {"rubric_mode": "regular", "code_only": False, "request_mode": "per_leaf", "max_workers": 100}
#: Texts of a task without a fault; others hold their own name.
_TEXTS = {"instruction.md": _INSTRUCTIONS, "task.toml": _TOML, "tests/judge_config.json": json.dumps(_JUDGE), "tests/rubric.json": _TREE, "tests/llm_rubric_judge.py": _JUDGE_PY, "tests/test.sh": _TEST_SH}
_TEXTS = {f: _TEXTS.get(f, f) for f in batch.FILES}
_BYTES = {f: len(t) for f, t in _TEXTS.items()}
_WALKED = [f for f in batch.FILES if "/" in f]
_kind = lambda f: next((k for k, suffixes in profile.KINDS.items() if f.rpartition(".")[2] in suffixes), "binary")
_scope = lambda f: profile.SCOPES.get(f.split("/")[0], "package")
_tally = lambda of, value: {k: sum(value(f) for f in _WALKED if of(f) == k) for k in sorted({of(f) for f in _WALKED})}
_RECORD = {
    "schema_version": "resource_metadata_v3", "resource_estimate": {"gpu_tier": "H200", "gpu_required": True, "gpu_count": 1}, "estimator": {"declared_gpu_tier": "H200"},
    "data_profile": {
        "file_count": len(_WALKED), "total_bytes": sum(_BYTES[f] for f in _WALKED), "kind_counts": _tally(_kind, lambda f: 1), "kind_bytes": _tally(_kind, _BYTES.get), "scope_file_counts": _tally(_scope, lambda f: 1),
        "scope_bytes": _tally(_scope, _BYTES.get),
    },
}
_TEXTS["resource_metadata.json"] = json.dumps(_RECORD)
#: k: (path, part of its text, what stands there instead).
_EDITS = {
    10: ("instruction.md", "Read", "Do read"), 11: ("instruction.md", "7 days", "9 days"), 12: ("tests/test.sh", "MAX", "# MAX"), 13: ("task.toml", "[metadata]", "[metadata"), 14: ("task.toml", "gpu_count = 1", "gpu_count = 2"),
    15: ("task.toml", "[metadata]", "# LLM_BASE_URL\n[metadata]"), 16: ("task.toml", "[verifier.environment]\nworkdir = \"/tests\"\ngpus = 1", "[verifier.environment]\nworkdir = \"/tests\"\ngpus = 2"), 17: ("task.toml", "[metadata]", "[other]"),
    18: ("tests/judge_config.json", "regular", "code-dev"), 19: ("tests/judge_config.json", "100", "0"), 20: ("tests/judge_config.json", "per_leaf", "all"),
    21: ("tests/rubric.json", '"weight": 1, "sub_tasks": [], "task_category": "Result', '"weight": -1, "sub_tasks": [], "task_category": "Result'), 22: ("tests/llm_rubric_judge.py", "ThreadPoolExecutor\n", "ThreadPoolExecutor, \"temperature\"\n"),
    23: ("tests/llm_rubric_judge.py", "ThreadPoolExecutor", "Thread"), 24: ("tests/test.sh", '"committed_size_ok"', "x"), 26: ("resource_metadata.json", "_v3", "_v2"), 27: ("resource_metadata.json", '"gpu_tier": "H200"', '"gpu_tier": "A10"'),
    28: ("resource_metadata.json", "true", "false"), 29: ("resource_metadata.json", '"declared_gpu_tier": "H200"', '"declared_gpu_tier": "A10"'), 30: ("resource_metadata.json", '"file_count": ', '"file_count": 1'),
    31: ("task.toml", "source_native_contract", "native_contract"), 32: ("task.toml", 'gpu_tier = "H200"', 'gpu_tier = "A10"'), 33: ("tests/llm_rubric_judge.py", "def score_rubric_tree(", "def other("), 34: ("tests/llm_rubric_judge.py", "exactly 0 or 1", "0 or 1"),
    35: ("tests/test.sh", "clean -fd", "clean -n"), 36: ("tests/test.sh", "--submission-dir", "--folder"), 37: ("tests/judge_config.json", "}", "} and {}"),
}
_DROPPED = {7: "solution/README.md"}
_ADDED = {5: "notes.txt", 6: "tests/x.py", 8: "environment/paper/x", 9: "environment/Dockerfile"}


def _tasks(spark, sf):
    return table(spark, sf, "supplier").select((F.col("s_suppkey") % 38).cast("int").alias("k"), F.concat(F.lit("task-"), "s_suppkey").alias("task_id"), F.concat(F.lit("p-"), "s_suppkey").alias("paper_id"), F.col("s_suppkey").alias("ord"))


def batch_tables(spark, sf):
    """(lines, entries, texts, templates) of the batch."""
    tasks, k = _tasks(spark, sf), F.col("k")
    fields = F.struct(*(F.lit("").alias(c) if c not in ("task_id", "paper_id") else F.col(c) for c in sorted(packaging.MANIFEST_KEYS)))
    short = F.struct(*(F.col(c) if c in ("task_id", "paper_id") else F.lit("").alias(c) for c in sorted(packaging.MANIFEST_KEYS) if c != "metric"))
    line = F.when(k == 1, "{broken").when(k == 2, F.to_json(short)).otherwise(F.to_json(fields))
    lines = tasks.select("ord", line.alias("line"), "k")
    lines = lines.union(lines.filter("k = 3")).select("ord", "line")
    text = F.col("base")
    for n, (path, old, new) in _EDITS.items():
        text = F.when((k == n) & (F.col("path") == path), F.replace(F.col("base"), F.lit(old), F.lit(new))).otherwise(text)
    text = F.replace(text, F.lit("{paper_id}"), F.col("paper_id"))
    held = F.array(*(F.struct(F.lit(f).alias("path"), F.lit(t).alias("base"), F.lit(_BYTES[f]).cast("long").alias("bytes")) for f, t in _TEXTS.items()))
    own = tasks.filter("k <> 4").select("*", F.explode(held).alias("f")).select("k", "task_id", "paper_id", "f.*")
    for n, path in _DROPPED.items():
        own = own.filter((k != n) | (F.col("path") != path))
    own = own.withColumn("text", text)
    extra = spark.createDataFrame(list(_ADDED.items()), "k int, path string")
    added = tasks.join(F.broadcast(extra), "k").select("k", "task_id", "path", F.lit("x").alias("text"), F.lit(1).cast("long").alias("bytes"))
    every = own.select("k", "task_id", "path", "text", "bytes").union(added)
    mode = F.when(F.col("path").isin(*batch.EXECUTABLES) | ((k == 25) & (F.col("path") == "task.toml")), "755").otherwise("644")
    plain = every.select("task_id", "path", F.lit(False).alias("is_folder"), mode.alias("mode"), "bytes", F.sha2("text", 256).alias("sha256"))
    folders = tasks.filter("k <> 4").select("task_id", F.explode(F.array(*map(F.lit, ("tests", "solution", "environment", "environment/paper", "environment/paper/assets")))).alias("path"))
    entries = plain.union(folders.select("task_id", "path", F.lit(True), F.lit("755"), F.lit(0).cast("long"), F.lit(None).cast("string")))
    templates = spark.createDataFrame([(f, _TEXTS[f]) for f in batch.EXECUTABLES], "path string, text string").select("path", F.sha2("text", 256).alias("sha256"))
    ruled = ("instruction.md", "task.toml", "resource_metadata.json", "tests/judge_config.json", "tests/rubric.json", "tests/llm_rubric_judge.py", "tests/test.sh")
    return lines, entries, every.filter(F.col("path").isin(*ruled)).select("task_id", "path", "text"), templates


def _violations(spark, sf):
    import hashlib

    lines, entries, texts, templates = batch_tables(spark, sf)
    return lines, batch.violations(lines, entries, texts, templates, hashlib.sha256(_INSTRUCTIONS.encode()).hexdigest(), files.flatten_trees)


def batch_violations(spark, sf):
    return _violations(spark, sf)[1]


def batch_summary(spark, sf):
    return batch.summary(*_violations(spark, sf))


def template_guard(spark, sf):
    """A template for each supplier, with a fault by suppkey % 8."""
    needed = ("solution/README.md", "solution/reproduce.sh", "tests/judge_config.json", "tests/llm_rubric_judge.py", "tests/test.sh")
    k = F.col("s_suppkey") % 8
    rows = table(spark, sf, "supplier").select("s_suppkey", F.posexplode(F.array(*map(F.lit, needed))).alias("i", "path")).filter(F.col("i") != k)
    text = F.when(F.col("path") != "tests/judge_config.json", "x").when(k == 6, '{"title": ""}').when(k == 7, "[]").otherwise('{"title": "t"}')
    return batch.template_problems(rows.select(F.concat(F.lit("t"), "s_suppkey").alias("template_id"), "path", text.alias("text")))


def pinned_instructions(spark, sf):
    """Templates of which every fifth has been changed and every seventh has the clause twice."""
    import hashlib

    base = "an NVIDIA A10 GPU is there"
    k = F.col("s_suppkey")
    text = F.when(k % 5 == 1, F.concat(F.lit(base), F.lit("!"))).otherwise(base)
    rows = table(spark, sf, "supplier").select(F.concat(F.lit("t"), k).alias("path"), text.alias("text"))
    return batch.rendered_instructions(rows, hashlib.sha256(base.encode()).hexdigest(), "NVIDIA A10 GPU", "NVIDIA H200 GPU")


def resource_records(spark, sf):
    tasks = table(spark, sf, "part").select("p_partkey", F.col("p_partkey").alias("task_id"), F.when(F.col("p_partkey") % 3 == 0, "CPU only").when(F.col("p_partkey") % 3 == 1, "one A100").alias("accelerator"), F.lit(None).cast("string").alias("notes"), F.concat(F.lit('{"file_count": '), "p_size", F.lit("}")).alias("profile"))
    v = F.parse_json("record")
    get = lambda p, kind: F.variant_get(v, p, kind)
    estimate = lambda name, kind: get(f"$.resource_estimate.{name}", kind)
    return batch.resource_record(tasks).select(
        "p_partkey", get("$.data_profile.file_count", "bigint").alias("file_count"), F.col("resource").alias("paper_resource"), F.contains(estimate("reason", "string"), F.col("resource")).alias("reasoned"), get("$.estimator.declared_gpu_tier", "string").alias("tier"),
        get("$.schema_version", "string").alias("version"), *(estimate(f"estimated_vram_gb.{n}", "double").alias(f"vram_{n}") for n in ("min", "typical", "max")), estimate("training_time_tier", "string").alias("time_tier"), estimate("confidence", "double").alias("confidence"),
    )


def task_configurations(spark, sf):
    """The configuration of a task for each part, read back as TOML; every seventh name has quotes and a backslash."""
    k = F.col("p_partkey")
    title = F.when(k % 7 == 0, F.concat(F.lit('a "b" \\ '), "p_name")).otherwise(F.col("p_name"))
    kinds = F.when(k % 3 == 0, F.array().cast("array<string>")).when(k % 3 == 1, F.array(F.lit("text"))).otherwise(F.array(F.lit("json"), F.lit("image")))
    rows = spread(table(spark, sf, "part").select("p_partkey", "p_name", "p_size")).select(k, F.concat(F.lit("p-"), k).alias("paper_id"), F.concat(F.lit("task-"), k).alias("task_id"), title.alias("title"), F.col("p_size").alias("leaves"), F.when(k % 2 == 0, "cpu_sufficient").otherwise("gpu_relevant").alias("resource"), (k * 10).alias("bytes"), k.alias("files"), kinds.alias("kinds"))
    conf = conversion.Conversion("20260101-120000", contract=batch.Contract(mode="code-dev", tag="v1"), request=900)
    texts = rows.select("p_partkey", conversion.configuration(conf, "c0").alias("text")).withColumn("v", F.try_parse_json(toml_as_json("text")))
    get = lambda path, kind="string": F.try_variant_get("v", path, kind)
    return texts.select(
        "p_partkey", get("$.task.name").alias("name"), get("$.task.description").alias("description"), F.array_join(get("$.task.keywords", "array<string>"), ",").alias("keywords"), F.array_join(get("$.metadata.data_kinds", "array<string>"), ",").alias("kinds"),
        get("$.metadata.rubric_leaf_count", "bigint").alias("leaves"), get("$.metadata.data_total_bytes", "bigint").alias("bytes"), get("$.metadata.estimated_vram_gb_typical", "bigint").alias("vram"), get("$.metadata.code_dev_derivation").alias("tag"),
        get("$.metadata.code_only", "boolean").alias("code_only"), F.array_join(get("$.artifacts", "array<string>"), ",").alias("artifacts"), get("$.verifier.env.JUDGE_TIMEOUT_SEC").alias("wait"), get("$.verifier.environment.workdir").alias("workdir"),
    )


def chosen_bundles(spark, sf):
    """Project folders of all suppliers: by suppkey % 6, nothing, a draft, half a draft, a published pair, both, and a published pair of code alone with a regular draft; chosen for code alone, with and without approval."""
    k = F.col("s_suppkey") % 6
    file = lambda place, name, when, text: F.when(when, F.struct(F.lit(place).alias("place"), F.lit(name).alias("name"), F.encode(text, "utf-8").alias("content")))
    own = lambda what: F.concat(F.lit(what), F.col("s_suppkey").cast("string"))
    held = [
        file("design", "rubric_authoring/rubric.draft.json", k.isin(1, 2, 4, 5), own("draft ")), file("design", "rubric_authoring/addendum.draft.md", k.isin(1, 4, 5), F.lit("a")),
        file("design", "rubric_authoring/authoring_provenance.json", k == 1, F.lit('{"rubric_mode": "code-dev", "code_dev_derivation": "v1"}')), file("paper_sources", "rubric.json", k >= 3, own("published ")), file("paper_sources", "addendum.md", k >= 3, F.lit("a")),
        file("design", "rubric_authoring/human_approval.json", k == 5, F.lit('{"rubric_mode": "code-dev"}')), file("paper_sources", "paper.md", F.lit(True), F.lit("p")),
    ]
    files = table(spark, sf, "supplier").select(F.concat(F.lit("s-"), "s_suppkey").alias("paper_id"), F.explode(F.array_compact(F.array(*held))).alias("f")).select("paper_id", "f.*")
    found = conversion.candidates(files)
    out = [conversion.chosen(found, conversion.Conversion("b", contract=batch.Contract(mode=mode, tag="v1"), approved=approved)).select("paper_id", F.lit(mode).alias("asked"), F.lit(approved).alias("approved"), "state", "mode", "tag", "rubric") for mode in ("regular", "code-dev") for approved in (False, True)]
    return out[0].union(out[1]).union(out[2]).union(out[3])


def set_largest_files(spark, sf):
    """The ten largest documents of each source, as files of two kinds, by the profile that is stored with a task."""
    d = table(spark, sf, "documents")
    files = d.select(F.col("source").alias("set_id"), F.concat(F.when(F.col("doc_id") % 2 == 0, "tests/").otherwise("environment/"), F.format_string("%012d", "doc_id"), F.when(F.col("doc_id") % 3 == 0, ".md").otherwise(".py")).alias("path"), F.octet_length("text").cast("long").alias("bytes"))
    stored = profile.whole_profile_json(files)
    row = "struct<kind: string, scope: string, bytes: bigint>"
    largest = F.try_variant_get(F.parse_json("json"), "$.largest_files", f"array<{row}>")
    return stored.select("set_id", F.array_join("kinds", ",").alias("kinds"), "files", F.posexplode(largest).alias("place", "f")).select("set_id", "kinds", "files", "place", "f.kind", "f.scope", F.col("f.bytes").alias("bytes"))


def converted_files(spark, sf):
    """What a conversion of all parts as papers writes, by digest."""
    bundles = table(spark, sf, "part").select(F.concat(F.lit("p"), "p_partkey").alias("paper_id"), F.col("p_partkey").alias("source_index"), F.array(F.struct(F.lit("paper.md").alias("path"), F.col("p_name").alias("text"))).alias("files"))
    file = F.col("files")[0]
    held = rules.violations(bundles, [rules.Rule("paper has no text", F.coalesce(F.trim(file["text"]), F.lit("")) == ""), rules.Rule("id is not kebab-case", ~F.col("paper_id").rlike(rules.KEBAB))], ["paper_id"])
    _, written = batch.convert(bundles, "b1", "papers", held)
    return written.select("task_id", "path", F.md5("text").alias("digest"))


def stage_outputs_missing(spark, sf):
    """Outputs of the first stage that suppliers lack: the one that suppkey % 9 names, if there is one."""
    names = ("assets", "blacklist.txt", "config.yaml", "paper.md", "paper.pdf", "source_provenance.json", "task_metadata.json")
    papers = table(spark, sf, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("paper_id"), (F.col("s_suppkey") % 9).alias("k"))
    there = papers.select("paper_id", "k", F.posexplode(F.array(*map(F.lit, names))).alias("i", "name")).filter("i <> k and k <> 8")
    return contracts.missing_outputs(papers, there, names)


def profile_differences(spark, sf):
    """Documents as files of languages; a third of the languages' stored profiles have one kind wrong."""
    d = table(spark, sf, "documents")
    files = d.select(F.col("source").alias("set_id"), F.concat_ws("/", F.lit("tests"), F.concat("doc_id", F.when(F.col("doc_id") % 2 == 0, ".md").otherwise(".py"))).alias("path"), F.octet_length("text").cast("long").alias("bytes"))
    odd = F.length("set_id") % 2 == 1
    stored = profile.profile_json(files).select("set_id", F.parse_json(F.when(odd, F.replace(F.col("json"), F.lit('"image":0'), F.lit('"image":1'))).otherwise(F.col("json"))).alias("profile"))
    return contracts.profile_audit(stored, files)


QUERIES = (stage_outputs_missing, profile_differences, batch_violations, batch_summary, template_guard, pinned_instructions, resource_records, converted_files, task_configurations, chosen_bundles, set_largest_files)
_K = "k AS (SELECT 'task-' || s_suppkey AS task_id, 'p-' || s_suppkey AS paper_id, s_suppkey AS ord, s_suppkey % 38 AS k FROM supplier)"
_BROKEN = "WITH " + _K + ", v AS (" + _cases("k", {
    "CAST(NULL AS VARCHAR) AS task_id, 'manifest line is no object' AS rule, CAST(ord AS VARCHAR) AS detail": "k = 1", "task_id, 'task is not in the manifest', ''": "k = 1", "task_id, 'text is missing', 'task.toml: paper_id = \"\"'": "k = 1",
    "task_id, 'text is missing', 'task.toml: native_task_id = \"\"'": "k = 1",
    "task_id, 'manifest keys differ', CAST(ord AS VARCHAR)": "k = 2", "task_id, 'task id is not unique', ''": "k = 3", "task_id, 'task has no folder', ''": "k = 4",
    "task_id, 'entry is extra', 'notes.txt'": "k = 5", "task_id, 'entry is extra', 'tests/x.py'": "k = 6", "task_id, 'entry is missing', 'solution/README.md'": "k = 7", "task_id, 'required file is missing', 'solution/README.md'": "k = 7",
    "task_id, 'entry is extra', 'environment/paper/x'": "k = 8", "task_id, 'Dockerfile is there', 'environment/Dockerfile'": "k = 9", "task_id, 'instructions differ', ''": "k IN (10, 11)",
    "task_id, 'text is missing', 'instruction.md: for a maximum runtime of 7 days'": "k = 11", "task_id, 'file differs from its template', 'tests/test.sh'": "k IN (12, 24, 35, 36)", "task_id, 'TOML does not parse', 'task.toml'": "k = 13",
    "task_id, 'text is missing', 'task.toml: gpu_count = 1'": "k = 14", "task_id, 'text is forbidden', 'task.toml: LLM_BASE_URL'": "k = 15", "task_id, 'one GPU is asked', 'verifier.environment'": "k = 16", "task_id, 'TOML has no metadata', 'task.toml'": "k = 17",
    "task_id, 'judge has another mode', ''": "k IN (18, 37)", "task_id, 'judge has no workers', ''": "k IN (19, 37)", "task_id, 'judge does not ask leaf by leaf', ''": "k IN (20, 37)", "task_id, 'rubric: weight is negative or not finite', 'leaf-2'": "k = 21", "task_id, 'rubric: effective weights do not sum to 1', ''": "k = 21",
    "task_id, 'text is forbidden', 'tests/llm_rubric_judge.py: \"temperature\"'": "k = 22", "task_id, 'file differs from its template', 'tests/llm_rubric_judge.py'": "k IN (22, 23, 33, 34)",
    "task_id, 'text is missing', 'tests/llm_rubric_judge.py: ThreadPoolExecutor'": "k = 23", "task_id, 'text is missing', 'tests/test.sh: \"committed_size_ok\"'": "k = 24", "task_id, 'mode differs', 'task.toml'": "k = 25",
    "task_id, 'resource record is of another version', ''": "k = 26", "task_id, 'GPU tier is another one', 'estimate'": "k = 27", "task_id, 'one GPU is asked', 'estimate'": "k = 28", "task_id, 'GPU tier is another one', 'estimator'": "k = 29",
    "task_id, 'text is missing', 'task.toml: source_native_contract = \"paperbench_authored_task_v1\"'": "k = 31", "task_id, 'text is missing', 'task.toml: gpu_tier = \"H200\"'": "k = 32",
    "task_id, 'text is missing', 'tests/llm_rubric_judge.py: def score_rubric_tree('": "k = 33", "task_id, 'text is missing', 'tests/llm_rubric_judge.py: parser_invalid_reason = \"leaf score must be exactly 0 or 1\"'": "k = 34",
    "task_id, 'text is missing', 'tests/test.sh: git -C \"${CLEAN_SUBMISSION_DIR}\" clean -fd'": "k = 35", "task_id, 'text is missing', 'tests/test.sh: --submission-dir \"${CLEAN_SUBMISSION_DIR}\"'": "k = 36",
    "task_id, 'judge grades other code', ''": "k = 37", 
    "task_id, 'data profile differs', ''": "k IN (6, 7, 8, 9, 30)",
}) + ")"
SQL = {
    "stage_outputs_missing": """WITH s AS (SELECT 's' || s_suppkey AS paper_id, s_suppkey % 9 AS k FROM supplier), n AS (SELECT unnest(range(7)) AS i,
      unnest(['assets', 'blacklist.txt', 'config.yaml', 'paper.md', 'paper.pdf', 'source_provenance.json', 'task_metadata.json']) AS name) SELECT paper_id, name FROM s, n WHERE i = k OR k = 8""",
    "profile_differences": "SELECT DISTINCT source AS set_id FROM documents WHERE length(source) % 2 = 1",
    "batch_violations": f"{_BROKEN} SELECT * FROM v",
    "batch_summary": f"{_BROKEN} SELECT (SELECT count(*) FROM v) = 0 AS valid, (SELECT count(*) FROM v) AS violations, count(*) FILTER (k <> 1) + count(*) FILTER (k = 3) AS tasks FROM k",
    "template_guard": "WITH s AS (SELECT 't' || s_suppkey AS template_id, s_suppkey % 8 AS k FROM supplier) " + _cases("s", {
        "template_id, 'missing solution/README.md' AS problem": "k = 0", "template_id, 'missing solution/reproduce.sh'": "k = 1", "template_id, 'missing tests/judge_config.json'": "k = 2",
        "template_id, 'missing tests/llm_rubric_judge.py'": "k = 3", "template_id, 'missing tests/test.sh'": "k = 4", "template_id, 'judge has no title'": "k IN (6, 7)",
    }),
    "pinned_instructions": "SELECT 't' || s_suppkey AS path, CASE WHEN s_suppkey % 5 = 1 THEN 'template is not the pinned one' END AS problem, CASE WHEN s_suppkey % 5 <> 1 THEN 'an NVIDIA H200 GPU is there' END AS text FROM supplier",
    "resource_records": """WITH r AS (SELECT p_partkey, p_size, CASE p_partkey % 3 WHEN 0 THEN 'cpu_sufficient' WHEN 1 THEN 'gpu_relevant' ELSE 'gpu_required_likely' END AS paper_resource FROM part)
      SELECT p_partkey, CAST(p_size AS BIGINT) AS file_count, paper_resource, TRUE AS reasoned, 'H200' AS tier, 'resource_metadata_v3' AS version, CASE WHEN paper_resource LIKE 'cpu%' THEN 1.0::DOUBLE ELSE 2.0 END AS vram_min,
      CASE WHEN paper_resource LIKE 'cpu%' THEN 2.0::DOUBLE ELSE 8.0 END AS vram_typical, CASE WHEN paper_resource LIKE 'cpu%' THEN 6.0::DOUBLE ELSE 20.0 END AS vram_max, 'under_6h' AS time_tier, 0.75::DOUBLE AS confidence FROM r""",
    "task_configurations": r"""SELECT p_partkey, 'papers/task-' || p_partkey AS name, 'Implement the core methods of ' || CASE WHEN p_partkey % 7 = 0 THEN 'a "b" \ ' ELSE '' END || p_name AS description,
      'p-' || p_partkey || ',paper-reproduction,papers,research' AS keywords, CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'text' ELSE 'json,image' END AS kinds, CAST(p_size AS BIGINT) AS leaves, CAST(p_partkey * 10 AS BIGINT) AS bytes,
      CAST(CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 8 END AS BIGINT) AS vram, 'v1' AS tag, TRUE AS code_only, '/home/submission' AS artifacts, '900' AS wait, '/tests' AS workdir FROM part""",
    "chosen_bundles": """WITH s AS (SELECT s_suppkey AS n, s_suppkey % 6 AS k FROM supplier), b AS (
        SELECT n, 'published' AS state, 1 AS rank, CASE WHEN k = 5 THEN 'code-dev' ELSE 'regular' END AS mode, CAST(NULL AS VARCHAR) AS tag, 'published ' || n AS rubric FROM s WHERE k >= 3
        UNION ALL SELECT n, 'draft', 2, CASE WHEN k = 1 THEN 'code-dev' ELSE 'regular' END, CASE WHEN k = 1 THEN 'v1' END, 'draft ' || n FROM s WHERE k IN (1, 4, 5)),
      q AS (SELECT * FROM (VALUES ('regular'), ('code-dev')) m(asked), (VALUES (TRUE), (FALSE)) a(approved))
      SELECT 's-' || n AS paper_id, asked, approved, state, mode, tag, rubric FROM b, q WHERE (mode = asked OR (asked = 'code-dev' AND mode = 'regular')) AND (NOT approved OR state = 'published')
      QUALIFY row_number() OVER (PARTITION BY n, asked, approved ORDER BY rank) = 1""",
    "set_largest_files": """WITH f AS (SELECT source AS set_id, CASE WHEN doc_id % 2 = 0 THEN 'tests/' ELSE 'environment/' END || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS path, CASE WHEN doc_id % 3 = 0 THEN 'text' ELSE 'code' END AS kind,
        CASE WHEN doc_id % 2 = 0 THEN 'hidden_or_solution' ELSE 'visible' END AS scope, CAST(strlen(text) AS BIGINT) AS bytes FROM documents),
      t AS (SELECT set_id, concat_ws(',', CASE WHEN bool_or(kind = 'text') THEN 'text' END, CASE WHEN bool_or(kind = 'code') THEN 'code' END) AS kinds, count(*) AS files FROM f GROUP BY 1)
      SELECT set_id, kinds, files, CAST(row_number() OVER w - 1 AS INTEGER) AS place, kind, scope, bytes FROM f JOIN t USING (set_id) WINDOW w AS (PARTITION BY set_id ORDER BY bytes DESC, path) QUALIFY row_number() OVER w <= 10""",
    "converted_files": "SELECT 'b1-papers-' || substr(sha256('b1:p' || p_partkey), 1, 6) AS task_id, 'paper.md' AS path, md5(p_name) AS digest FROM part",
}
