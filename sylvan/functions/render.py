"""Configuration texts from columns, and facts from version-control listings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(text: Column) -> Column:
    """A JSON string, which is a TOML and a YAML string as well."""
    return F.regexp_replace(F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("x"))), r'^\{"x":|\}$', "")


@dataclass(frozen=True)
class Listed:
    """A column of arrays of strings, rendered as a list."""

    items: Column


@dataclass(frozen=True)
class Plain:
    """A column of numbers or booleans, rendered without quotes; null is 0."""

    value: Column


Value = Column | Listed | Plain | str | int | float | bool | list


def _value(value: Value) -> Column:
    if isinstance(value, bool):
        return F.lit(str(value).lower())
    if isinstance(value, int | float):
        return F.lit(str(value))
    if isinstance(value, list):
        return F.concat(F.lit("["), F.concat_ws(", ", *map(_value, value)), F.lit("]"))
    if isinstance(value, Listed):
        items = F.coalesce(value.items, F.array().cast("array<string>"))
        return F.concat(F.lit("["), F.array_join(F.transform(items, quoted), ", "), F.lit("]"))
    if isinstance(value, Plain):
        return F.coalesce(value.value.cast("string"), F.lit("0"))
    return quoted(F.lit(value) if isinstance(value, str) else value)


def toml(sections: dict[str, dict[str, Value]]) -> Column:
    """A TOML text; a section named by an empty string stands at the top. Plain columns are strings."""
    parts: list[Column] = []
    for name, fields in sections.items():
        head = [F.lit(f"[{name}]")] if name else []
        parts.append(F.concat_ws("\n", *head, *(F.concat(F.lit(f"{k} = "), _value(v)) for k, v in fields.items())))
    return F.concat(F.concat_ws("\n\n", *parts), F.lit("\n"))


def yaml(fields: dict[str, Value]) -> Column:
    return F.concat(F.concat_ws("\n", *(F.concat(F.lit(f"{k}: "), _value(v)) for k, v in fields.items())), F.lit("\n"))


def tree_listing(listing: Column) -> Column:
    """A NUL-separated long listing of a version-control tree as an array of (path, bytes); folders and links have no size."""
    entries = F.filter(F.split(listing, "\\x00"), lambda e: e != "")
    return F.transform(entries, lambda e: F.struct(F.regexp_extract(e, r"(?s)\t(.*)$", 1).alias("path"), F.regexp_extract(e, r"^\S+ \S+ \S+ +(\S+)\t", 1).try_cast("bigint").alias("bytes")))


def tracked_clean(status: Column) -> Column:
    """Whether a porcelain status tells of no change to tracked files."""
    return F.forall(F.filter(F.split(status, "\n"), lambda s: F.trim(s) != ""), lambda s: F.startswith(s, F.lit("??")))
