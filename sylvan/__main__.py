"""python -m sylvan COMMAND ...

validate FOLDER                      packages of a folder: one line of JSON a package; the status is 1 if one of them is not valid
author ROOT --paper ID ...           drafts for papers of a project, from files of answers or a client
release ROOT --paper ID ...          publishes drafts that a reviewer has approved and nothing holds back
convert ROOT LIST TARGET ...         papers of a project as the next version of a batch of tasks"""

from __future__ import annotations

import argparse
import datetime
import importlib
import sys

from pyspark.sql import DataFrame, SparkSession

from . import conversion, drivers, release, runs
from .operators import batch, models
from .sources.files import file_tree


def _show(rows: DataFrame, *order: str) -> None:
    for line in rows.orderBy(*order).toJSON().toLocalIterator():
        print(line)


def _read(spark: SparkSession, path: str) -> bytes:
    """One small file, of any store."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def _validate(spark: SparkSession, given: argparse.Namespace) -> int:
    report, _, valid = drivers.validate(spark, given.folder, given.id, given.code_only, given.fail_on_warning)
    _show(report, "paper_id")
    return 0 if valid else 1


def _author(spark: SparkSession, given: argparse.Namespace) -> int:
    if given.answers:
        asker = models.from_table(models.answer_files(file_tree(spark, given.answers)))
    else:
        module, _, name = given.client.partition(":")
        asker = models.from_client(getattr(importlib.import_module(module), name), pool=given.pool, attempts=given.attempts)
    conf = runs.Authoring(given.mode, given.tag, given.chunk, given.repairs, given.target)
    made = runs.author_project(spark, given.root, given.paper, _read(spark, given.guide).decode(), asker, conf, given.existing)
    _show(made["reports"], "paper_id")
    _show(made["stopped"], "paper_id")
    return 0 if made["stopped"].isEmpty() else 1


def _release(spark: SparkSession, given: argparse.Namespace) -> int:
    written, held = release.release(spark, given.root, given.paper, given.reviewer, given.notes, given.tag, given.replace)
    _show(written, "path")
    _show(held, "paper_id", "rule", "detail")
    return 0 if held.isEmpty() else 1


def _convert(spark: SparkSession, given: argparse.Namespace) -> int:
    needed = ("solution/README.md", "solution/reproduce.sh", "tests/judge_config.json", "tests/llm_rubric_judge.py", "tests/test.sh")
    files = file_tree(spark, given.template)
    templates = {r.path: bytes(r.content) for r in files.filter(files.path.isin(*needed)).select("path", "content").collect()}
    contract = batch.Contract(mode=given.mode, gpu=given.gpu, tag=given.tag)
    batch_id = given.batch_id or datetime.datetime.now(datetime.timezone.utc).strftime("%Y%m%d-%H%M%S")
    conf = conversion.Conversion(batch_id, given.label, contract, given.approved, given.judge, given.limit, given.reproduction, given.request, given.workers, given.image)
    lines = conversion.convert(spark, given.root, conversion.selected(spark, given.list, given.paper), given.target, templates, _read(spark, given.instructions), conf, given.overwrite)
    for row in lines.toLocalIterator():
        print(row.value)
    return 0


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="sylvan", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = out.add_subparsers(dest="command", required=True)
    one = commands.add_parser("validate")
    one.add_argument("folder")
    one.add_argument("--id", action="append")
    one.add_argument("--code-only", action="store_true")
    one.add_argument("--fail-on-warning", action="store_true")
    one.set_defaults(run=_validate)

    one = commands.add_parser("author")
    one.add_argument("root")
    one.add_argument("--paper", action="append", required=True)
    one.add_argument("--guide", required=True)
    who = one.add_mutually_exclusive_group(required=True)
    who.add_argument("--answers", help="a folder of <paper>.<call>.json")
    who.add_argument("--client", help="module:factory, made in each task; it takes a call and a prompt")
    one.add_argument("--existing", choices=("refuse", "overwrite", "changed"), default="refuse")
    for name, kind, default in (("chunk", int, 50_000), ("repairs", int, 1), ("target", str, "40-120"), ("pool", int, 3), ("attempts", int, 4)):
        one.add_argument(f"--{name}", type=kind, default=default)
    one.set_defaults(run=_author)

    two = commands.add_parser("release")
    two.add_argument("root")
    two.add_argument("--paper", action="append", required=True)
    two.add_argument("--reviewer", required=True)
    two.add_argument("--notes", default="")
    two.add_argument("--replace", action="store_true")
    two.set_defaults(run=_release)

    three = commands.add_parser("convert")
    for name in ("root", "list", "target"):
        three.add_argument(name)
    three.add_argument("--paper", action="append")
    for name in ("template", "instructions"):
        three.add_argument(f"--{name}", required=True)
    for name, default in (("batch-id", None), ("label", "papers"), ("gpu", "H200"), ("judge", ""), ("image", "")):
        three.add_argument(f"--{name}", default=default)
    for name, default in (("limit", 606_100), ("reproduction", 604_800), ("request", 600), ("workers", 100)):
        three.add_argument(f"--{name}", type=int, default=default)
    three.add_argument("--approved", action="store_true")
    three.add_argument("--overwrite", action="store_true")
    three.set_defaults(run=_convert)
    for command in (one, three):
        command.add_argument("--mode", choices=("regular", "code-dev"), default="regular")
    for command in (one, two, three):
        command.add_argument("--tag", help="the derivation that trees of code alone name")
    return out


def main(arguments: list[str] | None = None) -> int:
    given = parser().parse_args(arguments)
    return given.run(SparkSession.builder.getOrCreate(), given)


if __name__ == "__main__":
    sys.exit(main())
