"""Trees of labelled values, of any depth -> long rows, within the row (no join, no shuffle, no driver loop).

A node's children are VARIANT values, parsed once with the text that holds them, so a schema fixes no depth: `tree_rows` opens
level after level inside one aggregate over an array, with as many steps as lists are nested, and slices values without
parsing them again.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from panelkit.functions.items import CATEGORIES, ROLES
from panelkit.functions.numbers import any_minus_number
from panelkit.functions.text import Col, as_col, blank_to_null, let

NODE = T.StructType([T.StructField("label_verbatim", T.StringType()), T.StructField("value", T.StringType()),
                     T.StructField("children", T.ArrayType(T.VariantType()))])
_ROW = T.StructType([T.StructField("place", T.ArrayType(T.IntegerType()))] + [T.StructField(n, T.StringType()) for n in ("top_category", "hierarchy_id")] + [T.StructField("level", T.IntegerType())] +
                    [T.StructField(n, T.StringType()) for n in ("parent_label", "label_verbatim", "value")] + [NODE["children"]])
_OPENED = T.StructType([T.StructField("rows", T.ArrayType(_ROW)), T.StructField("done", T.IntegerType())])


def tree_type(roles: list[str] = ROLES) -> T.StructType:
    return T.StructType([T.StructField(r, NODE) for r in roles])


def _row(node: Column, place: Column, top: Column, hid: Column, level: Column, parent: Column) -> Column:
    return F.struct(place.alias("place"), top.alias("top_category"), hid.alias("hierarchy_id"), level.alias("level"), parent.alias("parent_label"),
                    node["label_verbatim"].alias("label_verbatim"), node["value"].alias("value"), node["children"].alias("children"))


def _children(row: Column) -> Column:
    """Rows of a row's children; a child that is no object has no row but keeps its number."""
    def child(node: Column, i: Column) -> Column:
        return F.when(node.isNotNull(), _row(node, F.array_append(row["place"], i), row["top_category"], F.concat_ws(".", row["hierarchy_id"], (i + 1).cast("string")),
                                             row["level"] + 1, row["label_verbatim"]))
    # read once each: a lambda's argument is a value, an expression used four times in one would be read four times
    nodes = F.transform(row["children"], lambda v: F.try_variant_get(v, "$", NODE.simpleString()))
    return F.filter(F.transform(nodes, child), lambda r: r.isNotNull())


def _opened(state: Column, _step: Column) -> Column:
    """The next level: children of the rows that the last step added."""
    rows, done = state["rows"], state["done"]
    new = F.flatten(F.transform(F.filter(F.slice(rows, done + 1, F.size(rows) - done), lambda r: r["children"].isNotNull()), _children))
    return F.when(F.size(rows) == done, state).otherwise(F.struct(F.concat(rows, new).alias("rows"), F.size(rows).alias("done")).cast(_OPENED))


def list_depth(json: Column) -> Column:
    """How deep lists are nested in JSON texts: strings go, then all but brackets, then the highest balance is counted."""
    bare = F.regexp_replace(F.regexp_replace(json, r"\\.", ""), '"[^"]*"', "")
    brackets = F.regexp_replace(bare, r"[^\[\]]+", "")
    state = "struct<now:int,most:int>"

    def count(s: Column, c: Column) -> Column:
        now = s["now"] + F.when(c == "[", 1).when(c == "]", -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(s["most"], now).alias("most")).cast(state)
    return F.aggregate(F.split(brackets, ""), F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")).cast(state), count)["most"]


def tree_rows(tree: Col, roles: list[str] = CATEGORIES) -> Column:
    """array of line-item structs of all roles, depth first; a missing role keeps its number."""
    tree = as_col(tree)
    top = F.array(*[F.when(tree[r].isNotNull(), _row(tree[r], F.array(F.lit(n)), F.lit(r), F.lit(str(n)), F.lit(0), F.lit(None).cast("string")))
                    for n, r in enumerate(roles, start=1)])
    lists = F.concat_ws(",", *[F.when(F.size(tree[r]["children"]) > 0, F.to_json(F.struct(tree[r]["children"]))) for r in roles])
    steps = let(list_depth(lists), lambda n: F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")))
    start = F.struct(F.filter(top, lambda r: r.isNotNull()).alias("rows"), F.lit(0).alias("done")).cast(_OPENED)
    named = [c for c in _ROW.names if c not in ("place", "children")]
    rows = F.transform(F.aggregate(steps, start, _opened)["rows"], lambda r: F.struct(r["place"].alias("place"), F.struct(*[r[c].alias(c) for c in named]).alias("row")))
    return F.array_sort(rows)["row"]


def flatten_tree(df: DataFrame, tree: str, roles: list[str] = CATEGORIES) -> DataFrame:
    """One row per line item: the other columns, then category, id, level, parent, label, value."""
    keep = [c for c in df.columns if c != tree]
    return df.select(*keep, F.explode(tree_rows(tree, roles)).alias("__r")).select(*keep, "__r.*")


def level_counts(df: DataFrame, tree: str, roles: list[str] = CATEGORIES) -> DataFrame:
    """(level, n): how many line items lie on each level."""
    return flatten_tree(df.select(tree), tree, roles).groupBy("level").agg(F.count("*").alias("n"))


def node_counts(df: DataFrame, tree: str, roles: list[str] = ROLES) -> DataFrame:
    """Adds n_labelled and n_values: labelled nodes, and those with a value (row-local, no explode)."""
    rows = tree_rows(tree, roles)

    def filled(c: Column) -> Column:
        return F.coalesce(c != "", F.lit(False))
    return (df.withColumn("n_labelled", F.size(F.filter(rows, lambda r: filled(r["label_verbatim"]))))
              .withColumn("n_values", F.size(F.filter(rows, lambda r: filled(r["label_verbatim"]) & filled(r["value"])))))


def needs_legibility_retry(table_found: Col, failure_reason: Col, n_values: Col, n_labelled: Col) -> Column:
    v, n = as_col(n_values), as_col(n_labelled)
    unreadable = F.coalesce(as_col(failure_reason).isin("pages_unreadable", "dsa_pages_not_in_input"), F.lit(False))
    return F.when(~F.coalesce(as_col(table_found), F.lit(False)), unreadable).otherwise(
        (n == 0) | (v < 3) | F.coalesce(F.try_divide(v, n) < 0.45, F.lit(True)))


def role_value(tree: Col, role: str) -> Column:
    """Number of one role's own node."""
    return any_minus_number(as_col(tree)[role]["value"])


def wide_values(df: DataFrame, tree: str, roles: list[str] = CATEGORIES) -> DataFrame:
    """One column per role instead of one row per node."""
    keep = [c for c in df.columns if c != tree]
    return df.select(*keep, *[role_value(tree, r).alias(r) for r in roles])


def spread_map(df: DataFrame, map_col: str, key: str, value: str) -> DataFrame:
    """map{key -> struct} to rows."""
    keep = [c for c in df.columns if c != map_col]
    return df.select(*keep, F.explode(map_col).alias(key, value))


def has_value(c: Col) -> Column:
    return blank_to_null(c).isNotNull()
