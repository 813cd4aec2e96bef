"""Typed access to paths in JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TYPES = {"long": "bigint", "int": "int", "integer": "int", "string": "string", "json": "string", "bool": "boolean"}


def json_path(c: Column, kind: str, *path: str) -> Column:
    """The value at a path of a JSON text, null where it is missing, JSON null, not of the kind, or the way leads through something that is no object."""
    if kind not in TYPES:
        raise ValueError(f"no such kind: {kind}")
    v = F.get_json_object(c, "$" + "".join(f"['{p}']" for p in path))
    v = F.when(v != "null", v) if kind == "json" else v
    return v.try_cast(TYPES[kind]) if TYPES[kind] != "string" else v
