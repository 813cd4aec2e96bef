"""Nested records to related flat tables, by Dewey labels.

Every element of an array gets a label: the path of (array number, element position) pairs from the record's root down to it. The label of
the parent is the label cut by one pair, so parent links need no join and no generated keys. Nodes with the same schema path form one table.

Everything is derived from the DataFrame's schema and stays in Catalyst: a record's nodes are one array expression and one explode, so there
is no shuffle, and the arrays that are not asked for are pruned from the scan.

Defined cases: null and empty arrays have no nodes; null elements have none either but keep their position; a null struct on the way hides what
is below it; repeated records give repeated rows (make records unique first); other columns of the input are left out, so clashing names
do no harm; an empty table gives an empty table with the same schema.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

NODE = "struct<schema_path:string,node_path:string,label:array<int>>"


def listed(t: DataType) -> bool:
    """Which array elements are nodes: objects and strings. Numbers stay inside their object as a value."""
    return isinstance(t, (StructType, StringType))


def array_paths(t: DataType, at: tuple[str, ...] = (), is_node: Callable[[DataType], bool] = listed) -> list[tuple[str, ...]]:
    """The arrays below a type, in schema order; a step "[]" goes into an array's elements."""
    if isinstance(t, StructType):
        return [p for f in t.fields for p in array_paths(f.dataType, (*at, f.name), is_node)]
    if isinstance(t, ArrayType) and is_node(t.elementType):
        return [at, *array_paths(t.elementType, (*at, "[]"), is_node)]
    return []


def _join(prefix: str, name: str) -> str:
    return f"{prefix}.{name}" if prefix else name


def _nodes(col: Column, t: DataType, schema_path: str, node_path: Column, label: Column, numbers: dict[str, int], is_node: Callable[[DataType], bool]) -> list[Column]:
    """Array columns that together hold the nodes below one value."""
    if isinstance(t, StructType):
        out = []
        for f in t.fields:
            if array_paths(f.dataType, (), is_node):
                dot = F.when(node_path == "", F.lit(f.name)).otherwise(F.concat(node_path, F.lit("." + f.name))) if not schema_path else F.concat(node_path, F.lit("." + f.name))
                out += _nodes(col[f.name], f.dataType, _join(schema_path, f.name), dot, label, numbers, is_node)
        return out
    if not (isinstance(t, ArrayType) and is_node(t.elementType)):
        return []
    number = numbers[schema_path]

    def element(x: Column, i: Column) -> Column:
        own, mine = F.concat(node_path, F.lit("["), i.cast("string"), F.lit("]")), F.concat(label, F.array(F.lit(number), i.cast("int")))
        node = F.array(F.struct(F.lit(schema_path).alias("schema_path"), own.alias("node_path"), mine.alias("label")))
        below = _nodes(x, t.elementType, f"{schema_path}[]", own, mine, numbers, is_node)
        return F.when(x.isNull(), F.array().cast(f"array<{NODE}>")).otherwise(F.concat(node, *below) if below else node)

    return [F.coalesce(F.flatten(F.transform(col, element)), F.array().cast(f"array<{NODE}>"))]


def _numbers(t: StructType, roots: list[str], is_node: Callable[[DataType], bool]) -> dict[str, int]:
    paths = [p for r in roots for p in array_paths(t[r].dataType, (r,), is_node)]
    return {".".join(p).replace(".[]", "[]"): n for n, p in enumerate(paths)}


def node_array(df: DataFrame, roots: list[str], is_node: Callable[[DataType], bool] = listed) -> Column:
    """A record's nodes below the given columns as one array<struct<schema_path, node_path, label>>."""
    numbers, parts = _numbers(df.schema, roots, is_node), []
    for r in roots:
        parts += _nodes(F.col(f"`{r}`"), df.schema[r].dataType, r, F.lit(r), F.array().cast("array<int>"), numbers, is_node)
    return F.concat(*parts) if parts else F.array().cast(f"array<{NODE}>")


def dewey_nodes(df: DataFrame, id_col: str, roots: list[str], is_node: Callable[[DataType], bool] = listed) -> DataFrame:
    """One row per array element: record_id, schema_path, node_path, label, parent_label (empty array: the record itself), depth."""
    label = F.col("n.label")
    return (
        df.select(F.col(f"`{id_col}`").alias("record_id"), F.explode(node_array(df, roots, is_node)).alias("n"))
        .select("record_id", "n.schema_path", "n.node_path", label.alias("label"), F.slice(label, F.lit(1), F.size(label) - 2).alias("parent_label"), (F.size(label) / 2).cast("int").alias("depth"))
    )


def flat_table(df: DataFrame, id_col: str, schema_path: str, is_node: Callable[[DataType], bool] = listed) -> DataFrame:
    """The typed table of one schema path, e.g. "relationships[].object.synsets": record_id, label, parent_label and the element's own
    values (arrays that are tables of their own are left out; a string element is the column "value")."""
    root = schema_path.replace("[]", "").split(".")[0]
    numbers = _numbers(df.schema, [root], is_node)
    out = df.select(F.col(f"`{id_col}`").alias("record_id"), F.array().cast("array<int>").alias("label"), F.col(f"`{root}`").alias("v"))
    done, steps = root, [s for s in schema_path[len(root) :].replace("[]", ".[]").split(".") if s]
    for s in [*steps, "[]"]:
        if s == "[]":
            n = numbers[done]
            out = out.select("record_id", "label", F.posexplode("v").alias("i", "v")).where("v is not null")
            out, done = out.select("record_id", F.concat("label", F.array(F.lit(n), F.col("i"))).alias("label"), "v"), done + "[]"
        else:
            out, done = out.select("record_id", "label", F.col("v")[s].alias("v")), f"{done}.{s}"
    t = out.schema["v"].dataType
    values = [F.col("v").alias("value")] if not isinstance(t, StructType) else [F.col("v")[f.name].alias(f.name) for f in t.fields if not array_paths(f.dataType, (), is_node) and f.name not in ("record_id", "label", "parent_label")]
    return out.select("record_id", "label", F.slice("label", F.lit(1), F.size("label") - 2).alias("parent_label"), *values)


def flat_tables(df: DataFrame, id_col: str, roots: list[str], is_node: Callable[[DataType], bool] = listed) -> dict[str, DataFrame]:
    """A table for every schema path below the given columns."""
    return {p: flat_table(df, id_col, p, is_node) for p in _numbers(df.schema, roots, is_node)}
