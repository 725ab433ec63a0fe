"""Sources of the document pipeline: whole files, JSON documents and lines, paper lists, trees in JSON."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from itertools import islice
from urllib.parse import unquote

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strict_json, truncated
from .tables import bounded_batches


def file_tree(spark: SparkSession, folder: str, names: Iterable[str] | None = None) -> DataFrame:
    """All files below a folder, or those of some `names`, as `(path, bytes, content)`, paths relative to it; files of other names are not read. The reader passes empty files over, so they come from
    its listing, which the driver holds anyway."""
    base = folder.removeprefix("file://").rstrip("/") + "/"
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if names is not None:
        reader = reader.option("pathGlobFilter", "{" + ",".join(sorted(set(names))) + "}")
    files = reader.load(folder)
    relative = F.regexp_replace(F.split_part("path", F.lit(base), F.lit(2)), "^/", "")
    rows = files.select(relative.alias("path"), F.col("length").alias("bytes"), "content")
    listed = [(unquote(name).partition(base)[2],) for name in files.inputFiles()]
    empty = spark.createDataFrame(listed, "path string").join(rows.select("path"), "path", "left_anti")
    return rows.union(empty.select("path", F.lit(0).cast("long"), F.lit(b"")))


def folder_listing(folders: DataFrame, above: str) -> DataFrame:
    """`folders(task_id)` below `above` to `(task_id, path, is_folder, mode, bytes)` of all that they hold, as tasks find it; modes in octal, null where the store has none."""
    schema = "task_id string, path string, is_folder boolean, mode string, bytes long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(above)
        local = isinstance(store, fs.LocalFileSystem)
        for batch in batches:
            for folder in batch["task_id"]:
                rows = []
                for entry in store.get_file_info(fs.FileSelector(f"{root}/{folder}", recursive=True, allow_not_found=True)):
                    is_folder = entry.type == fs.FileType.Directory
                    mode = f"{os.stat(entry.path).st_mode & 0o777:o}" if local else None
                    rows.append((folder, entry.path.partition(f"{root}/{folder}/")[2], is_folder, mode, 0 if is_folder else entry.size))
                yield pd.DataFrame(rows, columns=["task_id", "path", "is_folder", "mode", "bytes"])

    return folders.select("task_id").mapInPandas(run, schema)


def capped_text(content: Column, most: int) -> Column:
    """Bytes as text, invalid ones replaced, cut to `most` characters with a note."""
    return truncated(F.make_valid_utf8(F.coalesce(content.cast("string"), F.lit(""))), most)


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """`(path, value)`: one variant a file, null where it doesn't parse."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.col("_metadata.file_path").alias("path"), strict_json(F.col("value")).alias("value"))


def json_lines(spark: SparkSession, path: str, keys: tuple[str, ...] | None = None) -> DataFrame:
    """`(line, value, error)`: each line's object; an error where it isn't one, or where its keys aren't exactly `keys`."""
    rows = spark.read.text(path).filter(F.trim("value") != "").select(F.col("value").alias("line"), strict_json(F.col("value")).alias("value"))
    is_object = F.coalesce(F.schema_of_variant("value").startswith("OBJECT"), F.lit(False))
    error = F.when(~is_object, F.lit("no object"))
    if keys is not None:
        own = F.array_sort(F.map_keys(F.try_variant_get("value", "$", "map<string,variant>")))
        error = error.when(own != F.array(*map(F.lit, sorted(keys))), F.lit("other keys"))
    return rows.withColumn("error", error)


def paper_list(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A list of papers, or an object that holds one under `papers`, as (header, rows); rows are `(ord, paper)` variants."""
    whole = json_documents(spark, path)
    kind = F.schema_of_variant("value")
    listed = F.when(kind.startswith("ARRAY"), F.try_variant_get("value", "$", "array<variant>")).otherwise(F.try_variant_get("value", "$.papers", "array<variant>"))
    header = whole.select("path", F.map_filter(F.coalesce(F.try_variant_get("value", "$", "map<string,variant>"), F.create_map().cast("map<string,variant>")), lambda k, v: k != "papers").alias("header"))
    return header, whole.select("path", F.posexplode(listed).alias("ord", "paper"))


def first_filled(*names: str) -> Column:
    """The first of several columns that isn't blank; a template that was never filled in is blank."""
    plain = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    return F.coalesce(*(F.when(~F.startswith(plain(n), F.lit("${")), plain(n)) for n in names))


def is_pdf(content: Column) -> Column:
    """Whether bytes begin and end as a PDF does."""
    tail = F.expr("substring({0}, greatest(1, octet_length({0}) - 4095))".format("content")) if isinstance(content, str) else F.substring(content, F.greatest(F.lit(1), F.octet_length(content) - 4095), F.lit(4096))
    return F.startswith(content, F.lit(b"%PDF-")) & F.contains(tail, F.lit(b"%%EOF"))


def page_count(info: Column) -> Column:
    """The number in a line `Pages: n`."""
    return F.nullif(F.regexp_extract(info, r"(?m)^Pages:\s+(\d+)$", 1), F.lit("")).cast("int")


#: fault: what keeps a row from being a node; has_id: whether the id is the node's own and not its path; listed: whether sub_tasks is a list.
_NODE = (
    "tree_id string, node_id string, parent_id string, ord long, depth int, path string, requirements string, weight double, task_category string, fine_category string, extra string, "
    "missing string, fault string, has_id boolean, listed boolean"
)
_FIELDS = ("id", "requirements", "weight", "sub_tasks", "task_category", "finegrained_task_category")


def _row(tree_id: str, path: str, parent: str | None, ord_: int, depth: int, node: object) -> tuple:
    """A node's row; what is no object is a row with a fault."""
    if not isinstance(node, dict):
        return (tree_id, path, parent, ord_, depth, path, *[None] * 6, "root is no object" if parent is None else "node is no object", False, False)
    number, own = node.get("weight"), node.get("id")
    number = float(number) if isinstance(number, int | float) and not isinstance(number, bool) else None
    text = {k: v if isinstance(v, str) else None for k, v in ((k, node.get(k)) for k in _FIELDS)}
    named = isinstance(own, str) and own.strip() != ""
    return (
        tree_id, own if named else path, parent, ord_, depth, path, text["requirements"], number, text["task_category"], text["finegrained_task_category"],
        ",".join(sorted(set(node) - set(_FIELDS))), ",".join(sorted(set(_FIELDS) - set(node))), None, named, isinstance(node.get("sub_tasks"), list),
    )


def _flatten(tree_id: str, text: str | None) -> Iterator[tuple]:
    """Nodes from the root down; a text that is no JSON is one row."""
    try:
        root = json.loads(text or "")
    except ValueError:
        yield (tree_id, "root", None, 0, 0, "root", *[None] * 6, "tree is no JSON", False, False)
        return
    waiting: list[tuple] = [(root, None, 0, 0, "root")]
    while waiting:
        node, parent, ord_, depth, path = waiting.pop()
        row = _row(tree_id, path, parent, ord_, depth, node)
        yield row
        if row[-1]:
            waiting += [(c, row[1], i, depth + 1, f"{path}.sub_tasks[{i}]") for i, c in reversed(list(enumerate(node["sub_tasks"])))]


#: Nodes that a task holds at once.
_PIECE = 1_000


def _flattened(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in _NODE.split(", ")]
    for batch in batches:
        nodes = (r for t, j in zip(batch["tree_id"], batch["json"], strict=True) for r in _flatten(t, j))
        while rows := list(islice(nodes, _PIECE)):
            yield pd.DataFrame(rows, columns=columns)


def flatten_trees(trees: DataFrame) -> DataFrame:
    """`trees(tree_id, json)` to an adjacency table; fields that are missing or too many are listed by name. Texts that don't parse
    and nodes that are no objects are rows with a `fault`. A plan that reads it more than once should keep it first, as each reading parses the texts again."""
    bounded_batches(trees.sparkSession)
    return trees.select("tree_id", "json").mapInPandas(_flattened, _NODE)


def sound_nodes(nodes: DataFrame) -> DataFrame:
    """The rows of `flatten_trees` that are nodes."""
    return nodes.filter("fault is null")


def normal_tree(nodes: DataFrame) -> DataFrame:
    """Exactly the fields of the data model, of nodes that are nodes."""
    return sound_nodes(nodes).select("tree_id", "node_id", "parent_id", "ord", "depth", "requirements", "weight", "task_category", "fine_category")
