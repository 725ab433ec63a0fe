"""Leaf scores from responses, and the record of a graded submission."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import json_object

#: Fixed value: characters of a rationale that are kept.
RATIONALE = 2000


def clamped(x: Column) -> Column:
    """To [0, 1]; what is no finite number is 0."""
    x = F.coalesce(x.try_cast("double"), F.lit(0.0))
    return F.when(F.isnan(x), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def _parts(v: Column, leaf_id: Column) -> tuple[Column, Column, Column]:
    """What a response's object can be to a leaf: a list of entries, the leaf's own entry, or a map that holds it; each null if it isn't."""
    get = lambda path, kind: F.try_variant_get(v, path, kind)
    listed = F.coalesce(get("$.leaves", "array<variant>"), get("$.items", "array<variant>"))
    own = F.when(F.coalesce(F.nullif(get("$.leaf_id", "string"), F.lit("")), get("$.id", "string")) == leaf_id, F.array(v))
    by_id = F.try_element_at(get("$", "map<string,variant>"), leaf_id)
    return listed, own, F.when(F.startswith(F.schema_of_variant(by_id), F.lit("OBJECT")), F.array(by_id))


def readable(response: Column, leaf_id: Column) -> Column:
    """Whether a response holds a list of entries or one for the leaf."""
    return F.coalesce(*_parts(json_object(response), leaf_id)).isNotNull()


def response_rows(responses: DataFrame) -> DataFrame:
    """`responses(leaf_id, ord, response)` to `(leaf_id, ord, pos, found_id, score, rationale)`, one row a scored leaf that
    a response holds: a list under `leaves` or `items`, the object itself, or a map by leaf id. Any other response is one
    row, with whatever id it has."""
    with_object = responses.withColumn("v", json_object(F.col("response")))
    listed, own, mapped = _parts(F.col("v"), F.col("leaf_id"))
    rows = with_object.select("leaf_id", "ord", (listed.isNull() & own.isNull() & mapped.isNotNull()).alias("keyed"), F.posexplode(F.coalesce(listed, own, mapped, F.array("v"))).alias("pos", "x"))
    field = lambda name, kind: F.try_variant_get("x", f"$.{name}", kind)
    found = F.coalesce(F.nullif(field("leaf_id", "string"), F.lit("")), field("id", "string"), F.when(F.col("keyed"), F.col("leaf_id")))
    number = F.schema_of_variant(field("score", "variant")).rlike("^(BIGINT|DOUBLE|DECIMAL)")
    score = F.when(number, field("score", "double"))
    return rows.select("leaf_id", "ord", "pos", found.alias("found_id"), score.alias("score"), F.substring(field("rationale", "string"), 1, RATIONALE).alias("rationale"))


def leaf_scores(rows: DataFrame) -> DataFrame:
    """`rows(leaf_id, ord, pos, found_id, score)` to one row a leaf: the first entry of its own id counts, and only a
    score of exactly 0 or 1 is valid; any other counts as 0. Unknown ids and repeats are counted as invalid."""
    fits = F.col("found_id") == F.col("leaf_id")
    place = F.row_number().over(Window.partitionBy("leaf_id", "found_id").orderBy("ord", "pos"))
    first = rows.withColumn("first", F.coalesce(fits, F.lit(False)) & (place == 1)).withColumn("valid", F.coalesce(F.col("score").isin(0.0, 1.0), F.lit(False)))
    return first.groupBy("leaf_id").agg(
        F.coalesce(F.max(F.when(F.col("first") & F.col("valid"), F.col("score"))), F.lit(0.0)).alias("score"),
        F.count_if(~(F.col("first") & F.col("valid"))).alias("invalid"),
    )


def reward_record(submissions: DataFrame, code_only: bool = False, score_names: tuple[str, ...] = ("score", "weighted_score", "reward")) -> DataFrame:
    """`submissions(submission_id, valid, has_readme, has_script, leaves, requests, answered, parsed, score, weight_total, reproduction_ran, reproduction_success)` to the record:
    an invalid submission scores 0, with all leaves invalid and nothing asked. `score_names`: keys that hold the same score."""
    valid = F.coalesce("valid", F.lit(False))
    formed = F.col("has_readme") if code_only else F.col("has_readme") & F.col("has_script")
    score = F.when(valid, clamped(F.col("score"))).otherwise(0.0)
    ratio = lambda n: F.when(valid, F.coalesce(F.try_divide(n, "requests"), F.lit(0.0))).otherwise(0.0)
    as_double = lambda c: c.cast("double")
    return submissions.select(
        "submission_id", *(score.alias(n) for n in score_names),
        F.when(~valid, 0.0).when(formed, 1.0).otherwise(0.25).alias("format"), as_double(valid).alias("submission_present"),
        ratio("answered").alias("judge_available"), ratio("parsed").alias("llm_parse_ok"), as_double(F.col("leaves")).alias("leaf_count"),
        as_double(F.when(valid, F.col("requests") - F.col("parsed")).otherwise(F.col("leaves"))).alias("invalid_leaf_count"),
        as_double(F.col("weight_total")).alias("rubric_weight_total"),
        as_double(valid & F.col("reproduction_ran")).alias("reproduction_ran"), as_double(valid & F.col("reproduction_success")).alias("reproduction_success"),
        F.lit(float(code_only)).alias("code_only"),
    )


def waves(leaves: int, workers: int) -> int:
    return math.ceil(leaves / workers)


def timeout_plan(trees: DataFrame, workers: int = 100, request: int = 600, reproduction: int = 604_800, limit: int = 606_100, slack: int = 60) -> DataFrame:
    """`trees(tree_id, leaves)`: waves of requests, the seconds they need, and whether the limit covers them."""
    n = F.ceil(F.col("leaves") / workers).cast("long")
    need = n * request + reproduction + slack
    return trees.select("tree_id", "leaves", n.alias("waves"), need.alias("needed"), (need <= limit).alias("fits"))
