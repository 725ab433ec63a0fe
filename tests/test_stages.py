"""Sinks, publication and conversion on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from sylvan.operators import authoring, batch, intake, models, packaging
from sylvan.sources import sinks


def test_files_are_written_whole(spark, tmp_path):
    rows = spark.createDataFrame([("a/x.txt", b"one"), ("a/b/y.bin", b"\x00\xff"), ("z", None)], "path string, content binary")
    got = {r.path: (r.bytes, r.sha256) for r in sinks.write_files(rows, f"file://{tmp_path}/out").collect()}
    assert (tmp_path / "out/a/b/y.bin").read_bytes() == b"\x00\xff" and got["z"][0] == 0 and got["a/x.txt"][0] == 3
    assert sorted(p.name for p in (tmp_path / "out").rglob("*") if p.is_file()) == ["x.txt", "y.bin", "z"]
    assert sinks.write_files(rows, f"file://{tmp_path}/out").count() == 3  # a task that runs again finds its own files
    other = spark.createDataFrame([("z", b"new")], "path string, content binary")
    with pytest.raises(Exception, match="FileExistsError"):
        sinks.write_files(other, f"file://{tmp_path}/out").collect()
    assert sinks.write_files(other, f"file://{tmp_path}/out", overwrite=True).first().bytes == 3 and (tmp_path / "out/z").read_bytes() == b"new"


def test_pretty_json_and_stages(spark, tmp_path):
    row = spark.createDataFrame([('q" : "x', 2)], "b string, a int").select(sinks.pretty_json(F.struct("b", F.struct("a").alias("c"))).alias("j")).first()
    assert row.j.endswith("}\n") and '\n  "c": {' in row.j and json.loads(row.j) == {"b": 'q" : "x', "c": {"a": 2}}
    answers = spark.createDataFrame([("p", 0, "elements-001", "{}"), ("p", 1, "matrix", "{}")], "paper_id string, stage int, call string, answer string")
    sinks.write_stages(answers, f"file://{tmp_path}/stages")
    assert {p.name for p in (tmp_path / "stages").rglob("stage=*")} == {"stage=0", "stage=1"}


def test_rewards_and_canned_answers(spark):
    records = spark.createDataFrame([("s", 0.5, 1.0)], "submission_id string, score double, format double")
    got = {r.path: bytes(r.content).decode() for r in sinks.reward_files(records).collect()}
    assert got == {"s/reward.json": '{\n  "format": 1.0,\n  "score": 0.5\n}\n', "s/reward.txt": "0.5\n"}
    calls = spark.createDataFrame([("1", "p", "leaf", "x"), ("2", "q", "leaf", "y")], "call_id string, paper_id string, call string, prompt string")
    answers = spark.createDataFrame([("p", "leaf", "known")], "paper_id string, call string, answer string")
    got = models.canned_or_asked(calls, answers, lambda: lambda call, prompt: f"asked {prompt}")
    assert {r.call_id: (r.answer, r.error) for r in got.collect()} == {"1": ("known", None), "2": ("asked y", None)}


def test_publication_replaces_as_a_whole(spark, tmp_path):
    target, ok = f"file://{tmp_path}/t", lambda df: df.filter("id < 0")
    assert packaging.publish(spark, spark.range(3), target, ok).count() == 3
    with pytest.raises(FileExistsError):
        packaging.publish(spark, spark.range(5), target, ok)
    with pytest.raises(ValueError):
        packaging.publish(spark, spark.range(5), target, lambda df: df.filter("id > 3"), overwrite=True)
    assert spark.read.parquet(target).count() == 3
    assert packaging.publish(spark, spark.range(5), target, ok, overwrite=True).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_manifest_with_ids_that_papers_share_is_published(spark, tmp_path):
    from sylvan.plans import documents

    spark.createDataFrame([(721,), (9813,), (5,)], "doc_id long").write.parquet(f"{tmp_path}/documents.parquet")  # the first two share six digits
    got = documents.staged_publish(spark, str(tmp_path)).collect()
    assert len(got) == 3 and len({r.task_id for r in got}) == 2 and {json.loads(r.value)["paper_id"] for r in got} == {"paper-721", "paper-9813", "paper-5"}


def test_manifest_rows_that_are_damaged_are_found(spark):
    papers = spark.createDataFrame([("p", 1), ("q", 2), ("q", 2), ("r", 1)], "paper_id string, source_index int")
    rows = packaging.as_json_lines(packaging.manifest(papers, "b", "l", "tasks")).select(F.get_json_object("value", "$.task_id").alias("task_id"), "value")
    problems = lambda rows: sorted((r.problem, r.key) for r in packaging.manifest_problems(rows, "b", "l").collect())
    assert problems(rows) == [("folder is another paper's", "p")] and problems(rows.filter("value NOT LIKE '%\"r\"%'")) == []
    assert problems(rows.filter("value LIKE '%\"q\"%'").limit(1).withColumn("task_id", F.lit("x"))) == [("task id is not its key's", "q")]
    assert problems(spark.createDataFrame([("x", "{")], "task_id string, value string")) == [("task id is not its key's", None)]


def test_configurations_are_parsed_by_many_tasks(spark):
    from conftest import SF
    from sylvan.plans import batches

    rows = spark.read.parquet(f"{SF}/part.parquet").count()
    each = [r["count"] for r in batches.task_configurations(spark, SF).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(each) == rows and max(each) <= rows / 4


def test_texts_of_a_batch_are_parsed_once_and_in_pieces(spark):
    import pandas as pd
    from conftest import SF
    from sylvan.plans import batches, checks
    from sylvan.sources import files

    for query in (batches.batch_violations, checks.package_violations, checks.json_tree_report):
        plan = query(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInPandas" not in plan and "pythonUDF" not in plan and "toml_as_json" not in plan, query
    whole = json.dumps({"id": "r", "sub_tasks": [{"id": f"n{i}"} for i in range(2_499)]})
    pieces = list(files._flattened([pd.DataFrame({"tree_id": ["t", "u"], "json": [whole, "[]"]})]))
    assert [len(p) for p in pieces] == [1_000, 1_000, 501] and pd.concat(pieces)["node_id"].tolist() == ["r", *(f"n{i}" for i in range(2_499)), "root"]


def test_nothing_is_converted_with_a_broken_rule(spark):
    bundles = spark.createDataFrame([("p", 1, [("a.md", "x")])], "paper_id string, source_index int, files array<struct<path: string, text: string>>")
    manifest, files = batch.convert(bundles, "b", "l", bundles.limit(0))
    assert manifest.count() == 1 and files.first().path == "a.md" and files.first().task_id == manifest.first().task_id
    with pytest.raises(ValueError):
        batch.convert(bundles, "b", "l", bundles)


def test_an_empty_manifest_is_a_violation(spark):
    from sylvan.sources.files import flatten_trees

    lines = spark.createDataFrame([], "ord long, line string")
    entries = spark.createDataFrame([], "task_id string, path string, is_folder boolean, mode string, bytes long, sha256 string")
    texts = spark.createDataFrame([], "task_id string, path string, text string")
    templates = spark.createDataFrame([], "path string, sha256 string")
    found = batch.violations(lines, entries, texts, templates, "x", flatten_trees, batch.Contract(mode="code-dev", tag="v1"))
    assert [(r.task_id, r.rule) for r in found.collect()] == [(None, "manifest is missing")]


def test_downloads_and_calls_stop_in_time(spark):
    rows = [("a.pdf", 0, True, None, None), ("a.pdf", 1, False, 5, b"%PDF-"), ("a.pdf", 2, False, None, b"%PDF-1 %%EOF"), ("a.pdf", 3, True, None, None), ("b", 0, True, None, None), ("b", 1, False, 9, b"cut")]
    got = {r.url: (r.attempts, r.waited, r.bytes, r.problem) for r in intake.downloads(spark.createDataFrame(rows, "url string, attempt int, failed boolean, expected int, content binary")).collect()}
    assert got == {"a.pdf": (3, 3, 12, None), "b": (2, 3, None, "answer is cut off")}
    calls = [("x", 0, 429, None), ("x", 1, None, None), ("x", 2, 200, "yes"), ("x", 3, 200, "no"), ("y", 0, 401, None), ("y", 1, 200, "late")]
    got = {r.call_id: (r.attempts, r.waited, r.answer, r.problem) for r in models.retried(spark.createDataFrame(calls, "call_id string, attempt int, status int, answer string")).collect()}
    assert got == {"x": (3, 3, "yes", None), "y": (1, 0, None, "refused")}


def test_repairs_end_with_the_first_valid_tree(spark):
    rows = [("a", 0, True), ("a", 1, False), ("b", 0, False), ("b", 1, True), ("b", 2, True), ("c", 0, False), ("c", 1, False), ("c", 2, True)]
    got = {r.paper_id: (r.rounds, r.valid) for r in authoring.repair_rounds(spark.createDataFrame(rows, "paper_id string, round int, valid boolean"), 1).collect()}
    assert got == {"a": (0, True), "b": (1, True), "c": (1, False)}


def _package(folder, tree):
    folder.mkdir(parents=True)
    for name, content in {"config.yaml": b"x", "paper.pdf": b"%PDF-1 %%EOF", "paper.md": b"text", "blacklist.txt": b"", "rubric.json": tree, "addendum.md": ("Scope. Approved adaptation. Required evidence. Clarification. Out of scope. " + "x" * 300).encode()}.items():
        (folder / name).write_bytes(content)


def test_packages_become_a_batch(spark, tmp_path):
    from sylvan import drivers
    from sylvan.sources.versions import Versions
    from sylvan.plans.batches import _HEAD, _JUDGE_PY, _TEST_SH, _TREE

    for paper in ("a-paper", "b-paper"):
        _package(tmp_path / "in" / paper, _TREE.encode())
    root, target = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    report, found, valid = drivers.validate(spark, root, ["a-paper", "c-paper"])
    assert [tuple(r) for r in found.filter("paper_id = 'a-paper'").collect()] == []
    assert not valid and {(r.paper_id, r.valid) for r in report.collect()} == {("a-paper", True), ("c-paper", False)} and found.filter("rule = 'no package'").count() == 1
    templates = {"solution/README.md": b"r", "solution/reproduce.sh": b"s", "tests/test.sh": _TEST_SH.encode(), "tests/llm_rubric_judge.py": _JUDGE_PY.encode()}
    text = b"Read /home/paper, write to /home/submission, for a maximum runtime of 7 days on an NVIDIA H200 GPU"
    manifest = drivers.convert(spark, root, target, "b1", "papers", templates, text)
    number, at = Versions(spark, target).current()
    tasks = list((tmp_path / "out" / at.rpartition("/")[2] / "tasks").iterdir())
    assert manifest.count() == 2 and _HEAD and number == 1 and len(tasks) == 2 and {oct((t / "tests/test.sh").stat().st_mode)[-3:] for t in tasks} == {"755"} and {oct((t / "task.toml").stat().st_mode)[-3:] for t in tasks} == {"644"}
    with pytest.raises(FileExistsError):
        drivers.convert(spark, root, target, "b1", "papers", templates, text)
    with pytest.raises(ValueError, match="instruction.md"):
        drivers.convert(spark, root, f"file://{tmp_path}/bad", "b1", "papers", templates, b"nothing of it")
    (tmp_path / "in" / "a-paper" / "rubric.json").write_text("{")
    with pytest.raises(ValueError, match="tree is no JSON"):
        drivers.convert(spark, root, target, "b1", "papers", templates, text, overwrite=True)
    assert Versions(spark, target).current() == (1, at) and len(list((tmp_path / "out").iterdir())) == 2 and not list((tmp_path / "bad").glob("v-*"))


def test_authoring_and_publication(spark, tmp_path):
    from sylvan import drivers

    papers = spark.createDataFrame([("p", 1, ["x"], False, 0), ("q", 0, [], False, 0)], "paper_id string, chunks int, branches array<string>, asks_addendum boolean, repairs int")
    answers = spark.createDataFrame([(None, c, json.dumps({"unresolved": [c]})) for c in ("elements-001", "matrix", "addendum", "tree-plan", "weighting", "review")] + [("p", "subtree-x", "{}"), ("q", "weighting", None)], "paper_id string, call string, answer string")
    results, open_ = drivers.author(spark, papers, answers, f"file://{tmp_path}/made")
    assert {r.paper_id: r.unresolved for r in open_.collect()}["p"] == ["elements-001", "matrix", "addendum", "tree-plan", "weighting", "review"]
    assert results.filter("paper_id = 'p'").count() == 7 and (tmp_path / "made").exists()
    schema = "paper_id string, artefacts array<string>, tag string, tree_errors int, addendum_errors int, blocking_issues int, unresolved int, weights_valid boolean, targets int, replace boolean"
    drafts = spark.createDataFrame([("p", ["a"], None, 0, 0, 0, 0, True, 0, False), ("q", ["a"], None, 0, 0, 1, 0, True, 0, False)], schema)
    files = spark.createDataFrame([(p, n, b"{}") for p in "pq" for n in ("rubric.json", "addendum.md")], "paper_id string, name string, content binary")
    written, held = drivers.publish(spark, drafts, files, f"file://{tmp_path}/pub", "someone", ("a",))
    assert {r.path for r in written.collect()} == {"p/rubric.json", "p/addendum.md", "p/human_approval.json"} and [(r.paper_id, r.rule) for r in held.collect()] == [("q", "review blocks")]
    record = json.loads((tmp_path / "pub/p/human_approval.json").read_text())
    assert record["reviewer"] == "someone" and record["approved_at"].endswith("Z") and len(record["rubric_sha256"]) == 64
    with pytest.raises(ValueError):
        drivers.publish(spark, drafts, files, f"file://{tmp_path}/pub", " ", ("a",))


def test_a_writer_that_dies_leaves_the_old_version_or_the_new_one(spark, tmp_path, monkeypatch):
    from sylvan.sources.versions import Conflict, Versions

    versions = Versions(spark, f"file://{tmp_path}/batch")
    assert versions.current() == (0, None)

    def content(n):
        at = versions.stage()
        spark.createDataFrame([(n,)], "n int").write.parquet(at)
        return at

    seen = lambda: spark.read.parquet(versions.current()[1]).first().n
    assert versions.put(content(1), 0) == 1 and seen() == 1
    staged = content(2)  # dies before it puts
    assert seen() == 1
    with monkeypatch.context() as patch:  # dies between writing the pointer and its place
        patch.setattr(Versions, "_rename", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            versions.put(staged, 1)
    assert seen() == 1 and versions.current()[0] == 1
    assert versions.put(staged, 1) == 2 and seen() == 2
    late = content(3)
    with pytest.raises(Conflict):
        versions.put(late, 1)
    with monkeypatch.context() as patch:  # another writer comes first after the check
        patch.setattr(Versions, "current", lambda self: (1, "old"))
        with pytest.raises(Conflict):
            versions.put(late, 1)
    assert seen() == 2 and not [p for p in (tmp_path / "batch/_versions").iterdir() if late in p.name]
    versions.clear()
    assert seen() == 2 and len(list((tmp_path / "batch").glob("v-*"))) == 1
