"""Whole runs with canned answers and with a client: authoring in rounds, grading leaf by leaf, and ledgers that are not asked twice."""

import json

import pytest

from sylvan import runs
from sylvan.operators import models
from sylvan.sources.files import file_tree, flatten_trees, normal_tree

ADDENDUM = "# Scope\nThe method.\n# Approved adaptations\nAny layout.\n# Required comparisons and evidence\nCode.\n# Clarifications\nNone.\n# Out of scope\nThe rest.\n" + "More words on it. " * 20


def leaf(id_, category, weight=1):
    return {"id": id_, "requirements": f"{id_} is there.", "weight": weight, "sub_tasks": [], "task_category": category, "finegrained_task_category": "Method Implementation"}


def branch(name="core", **changes):
    kids = [leaf(f"{name}-a", "Code Development", 2), leaf(f"{name}-b", "Code Development"), leaf(f"{name}-run", "Code Execution"), leaf(f"{name}-result", "Result Analysis")]
    return {"id": name, "requirements": f"{name} is done.", "weight": 3, "sub_tasks": kids, "task_category": None, "finegrained_task_category": None} | changes


def answers(paper, branches=("core",), questions=(), **changes):
    """All answers of a paper that goes well."""
    plan = {"root": {"id": "root", "requirements": "All is done.", "branches": [{"id": b, "requirements": f"{b} is done.", "weight": 1} for b in branches]}, "unresolved_questions": []}
    ids = ["root", *(x for b in branches for x in (b, f"{b}-a", f"{b}-b", f"{b}-run", f"{b}-result"))]
    out = {
        "elements-001": {"claims": []}, "matrix": {"paper_id": paper, "contributions": [], "unresolved_questions": list(questions)}, "addendum": {"addendum_markdown": ADDENDUM, "unresolved_questions": list(questions)}, "tree-plan": plan,
        **{f"subtree-{b}": {"subtree": branch(b)} for b in branches}, "weighting": {"weights": [{"node_id": i, "weight": 2 if i.endswith("-a") else 1} for i in ids]}, "review": {"blocking_issues": []},
    }
    return [(paper, call, json.dumps(a) if isinstance(a, dict) else a) for call, a in (out | changes).items() if a is not None]


def papers(spark, *names, text="# Method\nModules A and B.\n"):
    return spark.createDataFrame([(n, json.dumps({"paper_id": n, "title": n}), text) for n in names], "paper_id string, metadata string, text string")


def texts(made, paper):
    return {r.path: r.text for r in made["files"].filter(f"paper_id = '{paper}'").collect()}


def test_papers_go_on_by_what_they_are_told(spark, tmp_path):
    unsound = branch(task_category="Code Development")
    two = [{"question": "why"}, {"question": "who"}]
    told = [
        *answers("good", ("core", "more")), *answers("mended", **{"subtree-core": {"subtree": unsound}, "repair-01": {"rubric": {"id": "root", "requirements": "All is done.", "weight": 1, "sub_tasks": [branch()], "task_category": None, "finegrained_task_category": None}, "unresolved_questions": [{"question": "how"}]}}),
        *answers("unmended", **{"subtree-core": {"subtree": unsound}, "repair-01": {"rubric": "none"}}), *answers("odd-plan", ("Core",)), *answers("silent", **{"subtree-core": None}), *answers("other-branch", **{"subtree-core": {"subtree": branch(requirements="another")}}),
        *answers("free", **{"matrix": 'Here: {"paper_id": "free"} and {"more": 1}'}), *answers("hidden", questions=two, review={"judge_addendum": {"needed": True}, "unresolved_questions": two[:1]}, **{"judge-addendum": {"judge_addendum_markdown": "only judges\n\n"}}),
    ]
    names = sorted({t[0] for t in told})
    canned = spark.createDataFrame(told, "paper_id string, call string, answer string")
    made = runs.author(spark, papers(spark, *names), "guide", models.from_table(canned), f"file://{tmp_path}/run")
    stopped = {r.paper_id: (r.call, r.problem) for r in made["stopped"].collect()}
    assert stopped == {
        "odd-plan": ("tree-plan", "branch id is not kebab-case"), "silent": ("subtree-core", "no answer for subtree-core"), "other-branch": ("subtree-core", "other requirements"), "free": ("matrix", "answer is no JSON object"),
    }
    reports = {r.paper_id: (r.valid, r.repairs) for r in made["reports"].collect()}
    assert reports == {"good": (True, 0), "mended": (True, 1), "unmended": (False, 1), "hidden": (True, 0)}
    good = texts(made, "good")
    tree = json.loads(good["rubric.draft.json"])
    assert [b["id"] for b in tree["sub_tasks"]] == ["core", "more"] and [x["weight"] for x in tree["sub_tasks"][0]["sub_tasks"]] == [2, 1, 1, 1] and tree["sub_tasks"][0]["weight"] == 1
    assert json.loads(good["rubric_tree_unweighted.json"])["sub_tasks"][1]["sub_tasks"][0]["weight"] == 2 and good["addendum.draft.md"] == ADDENDUM.rstrip() + "\n"
    assert {"rubric_subtrees/core.json", "rubric_subtrees/more.json", "quality_review.json", "authoring_provenance.json"} <= set(good) and json.loads(good["unresolved_questions.json"]) == [] == json.loads(good["rubric_weight_application.json"])
    assert "judge.addendum.draft.md" not in good and texts(made, "hidden")["judge.addendum.draft.md"] == "only judges\n"
    assert [json.loads(r.question) for r in made["unresolved"].collect()] == [*two, {"question": "how"}]
    ledger = spark.read.parquet(f"file://{tmp_path}/run/ledger")
    assert ledger.filter("call = 'repair-01'").count() == 2 and ledger.filter("call LIKE 'judge%'").count() == 1 and ledger.filter("paper_id = 'odd-plan' AND call LIKE 'subtree%'").count() == 0


def test_code_alone_is_cut_from_the_complete_tree_and_asked_once(spark, tmp_path):
    for paper, call, answer in answers("fixture"):
        (tmp_path / "mock").mkdir(exist_ok=True)
        (tmp_path / "mock" / (f"{paper}.{call}.json" if call != "elements-001" else f"{call}.json")).write_text(answer)
    told = models.answer_files(file_tree(spark, f"file://{tmp_path}/mock"))
    conf, folder = runs.Authoring(mode="code-dev", repairs=0), f"file://{tmp_path}/run"
    made = runs.author(spark, papers(spark, "fixture"), "guide", models.from_table(told), folder, conf)
    out = texts(made, "fixture")
    pruned, full = (json.loads(out[n]) for n in ("rubric.draft.json", "rubric.full.draft.json"))
    assert [(x["id"], x["weight"]) for x in pruned["sub_tasks"][0]["sub_tasks"]] == [("core-a", 2), ("core-b", 1)] and len(full["sub_tasks"][0]["sub_tasks"]) == 4
    assert json.loads(out["authoring_provenance.json"])["rubric_mode"] == "code-dev" and made["reports"].first().valid and made["stopped"].isEmpty()
    asked = spark.read.parquet(f"{folder}/ledger").count()

    def never(calls):
        return models.ask(calls, lambda: lambda call, prompt: (_ for _ in ()).throw(models.Refused(call)))

    again = runs.author(spark, papers(spark, "fixture", "new"), "guide", never, folder, conf)
    assert texts(again, "fixture") == out and [tuple(r) for r in again["stopped"].collect()] == [("new", "elements-001", "Refused: elements-001")]
    assert spark.read.parquet(f"{folder}/ledger").count() == asked + 1


@pytest.mark.parametrize("code_only", [False, True])
def test_each_leaf_is_asked_by_itself_and_no_failure_reaches_another(spark, tmp_path, code_only):
    tree = {"id": "root", "requirements": "All is done.", "weight": 1, "sub_tasks": [branch()], "task_category": None, "finegrained_task_category": None}
    nodes = normal_tree(flatten_trees(spark.createDataFrame([("t", json.dumps(tree))], "tree_id string, json string")))
    submissions = spark.createDataFrame([("s1", "t", "p", "Title", True, True, True, False, True, True), ("s2", "t", "p", "Title", False, True, True, False, False, False)], "submission_id string, tree_id string, paper_id string, title string, valid boolean, has_readme boolean, has_script boolean, failed boolean, reproduction_ran boolean, reproduction_success boolean")
    files = spark.createDataFrame([("s1", False, "README.md", 12, "source text"), ("s1", True, "results.json", 9, "ran text"), ("s1", False, ".git/x", 3, "no")], "submission_id string, executed boolean, path string, bytes long, text string")
    known = spark.createDataFrame([("p", "paper text", "scope", "", "judge notes")], "paper_id string, paper_md string, addendum string, blacklist string, judge_addendum string")
    ran = spark.createDataFrame([("s1", "0", "out text", "", "[]")], "submission_id string, exit_code string, stdout string, stderr string, file_manifest string")
    calls = tmp_path / "calls"
    calls.mkdir()

    def client():
        def send(call, prompt):
            with open(calls / call, "a") as log:
                log.write("x")
            assert "source text" in prompt and "judge notes" in prompt and "core is done." in prompt and ("ran text" in prompt) == (not code_only) == ("out text" in prompt)
            if call == "core-run":
                raise TimeoutError("late")
            if call == "core-result":
                return "not JSON"
            return json.dumps({"leaves": [{"leaf_id": "other", "score": 1}, {"leaf_id": call, "score": 1, "rationale": "seen"}]})

        return send

    folder = f"file://{tmp_path}/run"
    asker = models.from_client(client, pool=3, attempts=2, wait=0.01)
    made = runs.grade(spark, submissions, nodes, files, known, ran, asker, folder, code_only)
    got = {r.leaf_id: (r.score, r.judge_available, r.llm_parse_ok) for r in made["leaves"].collect()}
    good = {"core-a": (1.0, True, True), "core-b": (1.0, True, True)}
    assert got == good if code_only else got == good | {"core-run": (0.0, False, False), "core-result": (0.0, False, False)}
    record = {r.submission_id: r for r in made["records"].collect()}
    assert (record["s1"].score, record["s1"].judge_available, record["s2"].score) == ((1.0, 1.0, 0.0) if code_only else (0.6, 0.5, 0.0))
    assert json.loads((tmp_path / "run/rewards/s1/reward.json").read_text())["score"] == record["s1"].score and (tmp_path / "run/rewards/s2/reward.txt").read_text() == "0.0\n"
    assert len((calls / "core-a").read_text()) == 1 and (code_only or len((calls / "core-run").read_text()) == 2)
    if not code_only:  # what failed is asked again, and nothing else
        runs.grade(spark, submissions, nodes, files, known, ran, asker, folder)
        assert len((calls / "core-a").read_text()) == 1 and len((calls / "core-run").read_text()) == 4
