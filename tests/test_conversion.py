"""A project folder to a batch: which bundles are taken, what they are cut down to, what holds them back, and what is written."""

import hashlib
import json
import tomllib

import pytest

from sylvan import conversion
from sylvan.operators import batch
from sylvan.plans.batches import _JUDGE_PY, _TEST_SH
from sylvan.sources.versions import Versions
from test_runs import ADDENDUM, branch

TAG = "derived-v1"
TREE = {"id": "root", "requirements": "All is done.", "weight": 1, "sub_tasks": [branch()], "task_category": None, "finegrained_task_category": None}
CODE = {**TREE, "sub_tasks": [{**TREE["sub_tasks"][0], "sub_tasks": TREE["sub_tasks"][0]["sub_tasks"][:2]}]}
TEMPLATES = {"solution/README.md": b"# The old one\n", "solution/reproduce.sh": b"true\n", "tests/test.sh": _TEST_SH.encode(), "tests/llm_rubric_judge.py": _JUDGE_PY.encode(), "tests/judge_config.json": b'{"title": "The old one"}'}
TEXT = {"regular": b"Read /home/paper, write to /home/submission, for a maximum runtime of 7 days on an NVIDIA H200 GPU", "code-dev": b"Read /home/paper, write to /home/submission. The code will not be executed during grading."}


def write(folder, files):
    for name, content in files.items():
        at = folder / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(content if isinstance(content, bytes) else content.encode() if isinstance(content, str) else json.dumps(content).encode())


def published(root, paper, tree=TREE, mode=None, approve=True, **extra):
    write(root / "paper_sources" / paper, {"paper.pdf": b"%PDF-1 %%EOF", "paper.md": "text", "blacklist.txt": b"", "rubric.json": tree, "addendum.md": ADDENDUM})
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    record = {"rubric_sha256": digest(json.dumps(tree)), "addendum_sha256": digest(ADDENDUM) if approve else "another", **({"rubric_mode": mode} if mode else {}), **extra}
    write(root / "design" / paper / "rubric_authoring", {"human_approval.json": record})


def draft(root, paper, tree=TREE, mode="regular", **extra):
    write(root / "paper_sources" / paper, {"paper.pdf": b"%PDF-1 %%EOF", "paper.md": "text", "blacklist.txt": "example.org\n"})
    write(root / "design" / paper / "rubric_authoring", {"rubric.draft.json": tree, "addendum.draft.md": ADDENDUM, "authoring_provenance.json": {"rubric_mode": mode, **extra}, "judge.addendum.draft.md": "only judges\n"})


@pytest.fixture
def project(tmp_path):
    root = tmp_path / "project"
    published(root, "in-print")
    write(root / "paper_sources" / "in-print" / "assets", {"fig/a.png": b"\x00\xff" * 40, "b.csv": "1,2\n"})
    write(root / "design" / "in-print", {"task_metadata.json": {"compute": {"accelerator": "CPU only", "notes": ""}}, "rubric_authoring/rubric.draft.json": "{"})
    draft(root, "in-draft")
    draft(root, "cut-down", CODE, "code-dev", code_dev_derivation=TAG)
    published(root, "no-approval", approve=False)
    names = {"in-print": 'One "title"', "in-draft": "Two", "cut-down": "Three", "no-approval": "Four"}
    (root / "list.json").write_text(json.dumps({"papers": [{"id": i, "title": t, "pdf_url": "https://example.org/x.pdf", "compute": {"notes": "one A100"}} for i, t in names.items()]}))
    return root


def run(spark, project, mode, ids, text=None, overwrite=False, **options):
    conf = conversion.Conversion(options.pop("batch_id", "20260101-120000"), contract=batch.Contract(mode=mode, tag=TAG if mode == "code-dev" else None), **options)
    papers = conversion.selected(spark, f"file://{project}/list.json", ids)
    target = f"file://{project.parent}/out-{mode}"
    lines = [json.loads(r.value) for r in conversion.convert(spark, f"file://{project}", papers, target, TEMPLATES, text or TEXT[mode], conf, overwrite).collect()]
    at = project.parent / f"out-{mode}" / Versions(spark, target).current()[1].rpartition("/")[2]
    return lines, {r["paper_id"]: at / "tasks" / r["task_id"] for r in lines}, at


def test_published_and_drafted_bundles_become_tasks(spark, project):
    lines, tasks, at = run(spark, project, "regular", ["in-draft", "in-print"])
    assert [(r["paper_id"], r["source_task_name"]) for r in lines] == [("in-print", "papers/papers-0000"), ("in-draft", "papers/papers-0001")]  # the list's order
    assert sorted(p.name for p in at.iterdir()) == [".manifest.jsonl.crc", "manifest.jsonl", "tasks"] or sorted(p.name for p in at.iterdir()) == ["manifest.jsonl", "tasks"]
    for paper, task in tasks.items():
        assert {p.relative_to(task).as_posix() for p in task.rglob("*") if p.is_file()} >= set(batch.FILES) and (task / "environment/paper/assets").is_dir()
        assert json.loads((task / "tests/rubric.json").read_text()) == TREE and (task / "environment/paper/addendum.md").read_text() == ADDENDUM
        assert all(oct(p.stat().st_mode)[-3:] == ("755" if p.is_dir() or p.relative_to(task).as_posix() in batch.EXECUTABLES else "644") for p in task.rglob("*"))
        conf = tomllib.loads((task / "task.toml").read_text())
        record = json.loads((task / "resource_metadata.json").read_text())
        walked = [p for top in ("environment", "tests", "solution") for p in (task / top).rglob("*") if p.is_file()]
        assert conf["metadata"]["data_total_bytes"] == record["data_profile"]["total_bytes"] == sum(p.stat().st_size for p in walked) and conf["metadata"]["data_file_count"] == len(walked)
        assert [f["bytes"] for f in record["data_profile"]["largest_files"]] == sorted((p.stat().st_size for p in walked), reverse=True)[:10]
        assert conf["metadata"]["data_kinds"] == record["data_profile"]["data_kinds"] == list(record["data_profile"]["kind_counts"]) or set(conf["metadata"]["data_kinds"]) == set(record["data_profile"]["kind_counts"])
        assert conf["artifacts"] == ["/home/submission"] and conf["metadata"]["rubric_leaf_count"] == 4 and conf["environment"]["gpu_types"] == ["H200"] and conf["task"]["keywords"] == sorted({paper, "paper-reproduction", "research", "papers"})
        assert conf["verifier.env".split(".")[0]]["env"]["JUDGE_TIMEOUT_SEC"] == "600"
    one, two = tasks["in-print"], tasks["in-draft"]
    assert (one / "solution/README.md").read_text() == '# One "title"\n' and tomllib.loads((one / "task.toml").read_text())["task"]["description"].endswith('One "title"')
    assert (one / "environment/paper/assets/fig/a.png").read_bytes() == b"\x00\xff" * 40 and not list((two / "environment/paper/assets").iterdir())
    assert (one / "tests/judge.addendum.md").read_text() == conversion.JUDGE_NOTES["regular"] and (two / "tests/judge.addendum.md").read_text() == "only judges\n"
    classes = {p: json.loads((t / "resource_metadata.json").read_text())["resource_estimate"] for p, t in tasks.items()}
    assert classes["in-print"]["estimated_vram_gb"] == {"min": 1.0, "typical": 2.0, "max": 6.0} and "cpu_sufficient" in classes["in-print"]["reason"] and "gpu_relevant" in classes["in-draft"]["reason"]
    with pytest.raises(FileExistsError):
        run(spark, project, "regular", ["in-print"])
    assert [r["paper_id"] for r in run(spark, project, "regular", ["in-print"], overwrite=True)[0]] == ["in-print"]


def test_only_code_is_left_where_only_code_counts(spark, project):
    lines, tasks, _ = run(spark, project, "code-dev", ["in-print", "cut-down"], limit=700)
    assert len(lines) == 2 and all(json.loads((t / "tests/rubric.json").read_text()) == CODE for t in tasks.values())
    judge = json.loads((tasks["in-print"] / "tests/judge_config.json").read_text())
    assert judge["code_only"] is True and judge["code_dev_derivation"] == TAG and judge["title"] == 'One "title"'
    assert tomllib.loads((tasks["cut-down"] / "task.toml").read_text())["metadata"]["reproduction_resource_profile"] == "not_executed"


def test_what_holds_papers_back(spark, project):
    def told(mode, ids, **options):
        with pytest.raises(ValueError) as error:
            run(spark, project, mode, ids, **options)
        return str(error.value)

    assert "('in-draft', 'no approved bundle for regular')" in told("regular", ["in-draft", "in-print"], approved=True)
    assert "('no-approval', 'approval does not match')" in told("regular", ["no-approval"], approved=True)
    assert "('cut-down', 'no bundle for regular')" in told("regular", ["cut-down"])
    assert "time does not suffice" in told("regular", ["in-print"], workers=1)
    assert "total timeout does not suffice" in told("regular", ["in-print"], limit=700) and "batch id" in told("regular", ["in-print"], batch_id="today") and "unknown papers" in told("regular", ["in-print", "nobody"])
    assert "instruction.md" in told("regular", ["in-print"], text=b"nothing of it")
    (project / "paper_sources/in-print/paper.md").unlink()
    (project / "design/cut-down/rubric_authoring/authoring_provenance.json").write_text(json.dumps({"rubric_mode": "code-dev", "code_dev_derivation": "older"}))
    odd = json.loads(json.dumps(TREE))
    odd["sub_tasks"][0]["sub_tasks"][0]["weight"], odd["sub_tasks"][0]["sub_tasks"][3]["weight"] = -1, "x"
    (project / "design/in-draft/rubric_authoring/rubric.draft.json").write_text(json.dumps(odd))
    found = told("code-dev", None)
    assert "('in-print', 'missing paper.md')" in found and "('cut-down', 'derivation is another one')" in found and "weight is negative or not finite at core-a" in found and "core-result" not in found
    assert not (project.parent / "out-regular").exists() or not list((project.parent / "out-regular").glob("v-*"))
    run(spark, project, "regular", ["no-approval"])  # no approval is asked


def test_a_broken_rule_stops_the_whole_conversion(spark):
    bundles = spark.createDataFrame([("p", 0, [("paper.md", "text")])], "paper_id string, source_index int, files array<struct<path: string, text: string>>")
    found = spark.createDataFrame([("p", "error", "no leaf")], "paper_id string, severity string, rule string")
    with pytest.raises(ValueError, match="no leaf"):
        batch.convert(bundles, "b1", "papers", found)
    assert batch.convert(bundles, "b1", "papers", found.limit(0))[1].first().path == "paper.md"


def test_lists_and_numbers_of_columns_in_configurations(spark):
    from pyspark.sql import functions as F

    from sylvan.functions.render import Listed, Plain, toml

    rows = spark.createDataFrame([(['a "b"', "c\\d"], 3), ([], None), (None, 0)], "names array<string>, n int")
    texts = [r.t for r in rows.select(toml({"": {"names": Listed(F.col("names")), "fixed": ["x", 1, True]}, "in.ner": {"n": Plain(F.col("n"))}}).alias("t")).collect()]
    assert [tomllib.loads(t) for t in texts] == [{"names": n, "fixed": ["x", 1, True], "in": {"ner": {"n": k}}} for n, k in ((['a "b"', "c\\d"], 3), ([], 0), ([], 0))]
