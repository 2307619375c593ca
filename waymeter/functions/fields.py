"""Reading fields of loosely named JSON objects, and small text rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def to_snake(name: str) -> str:
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.replace("-", "_")).lower()


def to_camel(name: str) -> str:
    head, *rest = name.split("_")
    return head.lower() + "".join(part.capitalize() for part in rest)


def snake(name: Column) -> Column:
    """Column form of :func:`to_snake`."""
    return F.lower(F.regexp_replace(F.replace(name, F.lit("-"), F.lit("_")), r"([a-z0-9])([A-Z])", "$1_$2"))


def camel(name: Column) -> Column:
    """Column form of :func:`to_camel`."""
    parts = F.split(name, "_")
    joined = F.array_join(F.transform(parts, lambda p: F.initcap(p)), "")
    first = F.lower(parts.getItem(0))
    return F.concat(first, F.substring(joined, F.length(first) + 1, F.length(joined)))


def spellings(name: str) -> list[str]:
    """The spellings tried for a field, in order, without repeats."""
    name = name.strip()
    tried = [name, name.lower(), name.upper(), to_snake(name), to_snake(name).upper(), to_camel(name), to_camel(name).upper()]
    return list(dict.fromkeys(s for s in tried if s))


def number(text: Column) -> Column:
    """A decimal number as a double; anything else, null included, is 0.0."""
    return F.coalesce(F.when(text.rlike(NUMBER), text.try_cast("double")), F.lit(0.0))


def first_non_empty(*texts: Column) -> Column:
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])


def blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def resolve(candidate: Column, fallback: Column) -> Column:
    return F.coalesce(F.nullif(candidate, F.lit("")), fallback, F.lit(""))


def is_online(availability: Column) -> Column:
    return F.coalesce(availability.isin("AVAILABLE", "BUSY", "ONLINE"), F.lit(False))


def status_has(status: Column, part: str) -> Column:
    return F.upper(blank(status)).contains(part)


def is_op(op: Column, name: str) -> Column:
    return F.coalesce(F.lower(op) == name, F.lit(False))
