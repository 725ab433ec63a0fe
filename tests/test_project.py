"""A project from papers to tasks by the command line: drafts, what holds them back, publication and conversion."""

import hashlib
import json

import pytest

from sylvan import release, runs
from sylvan.__main__ import main
from sylvan.operators import models
from test_conversion import CODE, TEMPLATES, TEXT, TREE, write
from test_runs import answers

TAG = "derived-v1"


@pytest.fixture
def project(tmp_path):
    root = tmp_path / "project"
    for paper in ("one", "two"):
        write(root / "paper_sources" / paper, {"paper.pdf": b"%PDF-1 %%EOF", "paper.md": "# Method\nModules A and B.\n", "blacklist.txt": b""})
        write(tmp_path / "answers", {f"{paper}.{call}.json": answer for _, call, answer in answers(paper, questions=[{"question": "which"}] if paper == "two" else ())})
    write(root, {"list.json": [{"id": i, "title": i, "pdf_url": "x"} for i in ("one", "two")]})
    write(tmp_path, {"guide.md": "guide", "text.md": TEXT["code-dev"]})
    write(tmp_path / "template", TEMPLATES)
    return root


def test_papers_are_drafted_released_and_converted(spark, project, capsys):
    root, above = f"file://{project}", f"file://{project.parent}"
    own = ["--paper", "one", "--paper", "two", "--tag", TAG]
    author = ["author", root, *own, "--guide", f"{above}/guide.md", "--answers", f"{above}/answers", "--mode", "code-dev"]
    assert main(author) == 0
    folder = project / "design/one/rubric_authoring"
    made_from = json.loads((folder / "authoring_provenance.json").read_text())
    assert made_from["code_dev_derivation"] == TAG and made_from["full_rubric_sha256"] == hashlib.sha256((folder / "rubric.full.draft.json").read_bytes()).hexdigest()
    assert {p.name for p in folder.iterdir() if p.is_file()} >= set(release.NEEDED.values())
    with pytest.raises(FileExistsError):
        main(author)

    assert main(["release", root, *own, "--reviewer", "someone", "--notes", "read twice"]) == 1  # two has open questions
    told = capsys.readouterr().out
    assert '"paper_id":"two","rule":"questions are open"' in told and '"paper_id":"one"' not in told.split('"paper_id":"two","rule"')[1]
    record = json.loads((folder / "human_approval.json").read_text())
    assert record["approved_by"] == "someone" and record["notes"] == "read twice" and record["rubric_mode"] == "code-dev" and record["rubric_stats"]["leaves"] == 2 and record["code_dev_derivation"] == TAG
    assert record["rubric_sha256"] == hashlib.sha256((project / "paper_sources/one/rubric.json").read_bytes()).hexdigest() and not (project / "paper_sources/two/rubric.json").exists()
    convert = ["convert", root, f"{root}/list.json", f"{above}/out", "--mode", "code-dev", "--tag", TAG, "--template", f"{above}/template", "--instructions", f"{above}/text.md", "--approved", "--batch-id", "20260101-120000", "--limit", "700"]
    with pytest.raises(ValueError, match="'two', 'no approved bundle"):
        main(convert)
    assert main([*convert, "--paper", "one"]) == 0
    assert [json.loads(line)["paper_id"] for line in capsys.readouterr().out.splitlines()] == ["one"]
    assert len(list((project.parent / "out").glob("v-*/tasks/*/tests/rubric.json"))) == 1


def test_only_what_has_changed_is_authored_again(spark, project):
    root = f"file://{project}"
    told = spark.createDataFrame([a for p in ("one", "two") for a in answers(p)], "paper_id string, call string, answer string")
    run = lambda ids=("one", "two"): runs.author_project(spark, root, list(ids), "guide", models.from_table(told), existing="changed")
    assert sorted(r.paper_id for r in run()["reports"].collect()) == ["one", "two"]
    (project / "paper_sources/two/paper.md").write_text("# Method\nAnother one.\n")
    (project / "design/one/task_metadata.json").parent.mkdir(exist_ok=True)
    again = run(("one", "two", "absent"))
    assert [r.paper_id for r in again["reports"].collect()] == ["two"] and [tuple(r) for r in again["stopped"].collect()] == [("absent", "paper", "no text")]
    (project / "design/one/rubric_authoring/quality_review.json").unlink()  # no whole draft
    assert [r.paper_id for r in run()["reports"].collect()] == ["one"]


def test_what_holds_drafts_back(spark, project):
    def draft(paper, tree=CODE, mode="code-dev", full=TREE, recorded=None, **changes):
        text = json.dumps(full)
        recorded = recorded or hashlib.sha256(text.encode()).hexdigest()
        good = {"rubric.draft.json": tree, "addendum.draft.md": "Scope. Approved adaptation. Required evidence. Clarification. Out of scope. " + "x" * 300, "quality_review.json": {"blocking_issues": []}, "unresolved_questions.json": [],
            "rubric_weight_application.json": {"valid": True}, "authoring_provenance.json": {"rubric_mode": mode, "code_dev_derivation": TAG, "full_rubric_sha256": recorded}, "rubric.full.draft.json": text}
        write(project / "design" / paper / "rubric_authoring", {n: c for n, c in (good | changes).items() if c is not None})

    draft("good")
    draft("plain", TREE, "regular")
    draft("uncut", TREE | {"sub_tasks": CODE["sub_tasks"] * 1} | {"requirements": "Another."})
    draft("changed", recorded="0" * 64)
    draft("no-full", **{"rubric.full.draft.json": None})
    draft("blocked", **{"quality_review.json": {"blocking_issues": ["x"]}})
    draft("odd", **{"quality_review.json": [], "unresolved_questions.json": {}, "rubric_weight_application.json": [1], "addendum.draft.md": " "})
    draft("part", **{"quality_review.json": None})
    draft("there")
    write(project / "paper_sources" / "there", {"rubric.json": "old"})
    names = ["good", "plain", "uncut", "changed", "no-full", "blocked", "odd", "part", "there", "nobody"]
    written, held = release.release(spark, f"file://{project}", names, "someone", tag=TAG)
    found = {}
    for r in held.collect():
        found.setdefault(r.paper_id, set()).add(r.rule)
    assert found == {
        "uncut": {"draft is not the complete tree's part"}, "changed": {"complete tree has changed"}, "no-full": {"no complete tree", "draft is not the complete tree's part"}, "blocked": {"review blocks"},
        "odd": {"review blocks", "questions are open", "weights were not applied", "addendum has errors", "addendum is empty"}, "part": {"artefact is missing"}, "there": {"target is there"}, "nobody": {"no draft"},
    }
    assert {r.path.split("/")[1] for r in written.collect()} == {"good", "plain"}
    assert json.loads((project / "paper_sources/plain/rubric.json").read_text()) == TREE and (project / "paper_sources/there/rubric.json").read_text() == "old"
    assert release.release(spark, f"file://{project}", ["there"], "someone", tag="another", replace=True)[1].first().rule == "derivation is another one"
    assert release.release(spark, f"file://{project}", ["there"], "someone", tag=TAG, replace=True)[1].isEmpty()
    assert json.loads((project / "paper_sources/there/rubric.json").read_text()) == CODE
    with pytest.raises(ValueError):
        release.release(spark, f"file://{project}", ["good"], " ")
