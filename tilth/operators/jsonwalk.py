"""Documents of any nesting as rows: one row for each scalar, without a schema.

A document is walked level by level inside its own row: the nodes of a level are an array,
its containers open into the nodes of the next one, and ``levels`` levels are one projection
without a shuffle.  Documents that go deeper are stored and walked on, so depth has no limit.
Objects open in the order their text lists them (as a map); a VARIANT of the same object
tells containers from strings that merely look like one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.session import materialize

LEVELS = 4

_TEXTS, _VALUES = "map<string,string>", "map<string,variant>"


def is_json(text: Column) -> Column:
    """Whether a text is a JSON document; null for null."""
    found = (F.from_json(text, _TEXTS).isNotNull() | F.from_json(text, "array<string>").isNotNull()
             | F.try_parse_json(text).isNotNull())
    return F.when(text.isNotNull(), found)


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _opens(text: Column, mark: str) -> Column:
    return F.startswith(F.ltrim(text), F.lit(mark))


def _looks(text: Column) -> Column:
    """Whether a text may be a container with something in it; a VARIANT decides."""
    return F.coalesce(F.substring(text, 1, 1).isin("{", "[") & ~text.isin("{}", "[]"), F.lit(False))


def _child(node: Column, key: Column, at: Column, text: Column, value: Column, inherited: Column) -> Column:
    inside = _looks(text) & F.coalesce(F.substring(F.to_json(value), 1, 1) != '"', F.lit(False))
    return F.struct(F.concat(node["path"], F.array(key)).alias("path"), F.concat(node["place"], F.array(at)).alias("place"),
                    text.alias("text"), inside.alias("inside"), inherited.alias("inherited"))


def _inherited(node: Column, texts: Column, names: tuple[str, ...]) -> Column:
    """The fields an object hands down: its own where it has them, else those it was handed."""
    depth = F.size(node["path"])
    return F.struct(*[F.when(F.try_element_at(texts, F.lit(n)).isNotNull(),
                             F.struct(F.try_element_at(texts, F.lit(n)).alias("text"), depth.alias("depth")))
                      .otherwise(node["inherited"][n]).alias(n) for n in names])


def _children(node: Column, names: tuple[str, ...]) -> Column:
    def of_object(o):
        entries, values = F.map_entries(o["texts"]), F.map_values(o["values"])
        return F.transform(entries, lambda e, i: _child(
            node, e["key"], i, e["value"], F.get(values, i), o["inherited"]))

    def of_array(a):
        return F.transform(a["texts"], lambda t, i: _child(
            node, i.cast("string"), i, t, F.get(a["values"], i), node["inherited"]))

    def opened(o):
        values = F.when(F.exists(F.map_values(o), _looks), F.from_json(node["text"], _VALUES))
        return F.struct(o.alias("texts"), values.alias("values"),
                        _inherited(node, o, names).alias("inherited"))
    as_object = _let(F.from_json(node["text"], _TEXTS), lambda m: _let(opened(m), of_object))
    as_array = _let(F.from_json(node["text"], "array<string>"), lambda m: _let(F.struct(
        m.alias("texts"), F.when(F.exists(m, _looks), F.from_json(node["text"], "array<variant>")).alias("values")), of_array))
    return F.coalesce(F.when(_opens(node["text"], "{"), as_object).otherwise(as_array), F.array())


def _node_type(names: tuple[str, ...]) -> str:
    handed = ",".join(f"`{n}`:struct<text:string,depth:int>" for n in names)
    return f"struct<path:array<string>,place:array<int>,text:string,inside:boolean,inherited:struct<{handed}>>"


def walk_json(docs: DataFrame, json_col: str, inherit: tuple[str, ...] = (), levels: int = LEVELS) -> DataFrame:
    """One row per document, its other columns and ``fields`` (replaced if it exists): an array of
    struct<path, place, text, inherited>, one for each scalar, null and empty container, in
    the document's order within a level.

    ``path`` holds keys (and places in arrays, as text), ``place`` the place at each level,
    so places order fields as the document lists them.  ``inherited`` has, for each name in
    ``inherit``, the text under that name in the nearest enclosing object that has one, and
    that object's depth (0: the document).

    Null, malformed and scalar documents have no fields (``is_json`` tells them apart); a
    key that an object repeats is a field each time; numbers keep the precision of a
    double."""
    own = [c for c in docs.columns if c not in (json_col, "fields")]
    names = inherit or ("none",)        # a struct needs a field
    kind = _node_type(names)
    handed = F.struct(*[F.lit(None).cast("struct<text:string,depth:int>").alias(n) for n in names])
    root = F.struct(F.array().cast("array<string>").alias("path"), F.array().cast("array<int>").alias("place"),
                    F.col(json_col).alias("text"), F.lit(True).alias("inside"), handed.alias("inherited"))
    todo = docs.select(*own, F.array(root).cast(f"array<{kind}>").alias("_open"), F.array().cast(f"array<{kind}>").alias("fields"))
    done: list[DataFrame] = []
    while True:
        for _ in range(levels):
            nodes = F.flatten(F.transform("_open", lambda n: _children(n, names)))
            todo = todo.withColumn("_nodes", nodes.cast(f"array<{kind}>")).select(
                *own, F.filter("_nodes", lambda n: n["inside"]).alias("_open"),
                F.concat("fields", F.filter("_nodes", lambda n: ~n["inside"])).alias("fields"))
        stored = materialize(todo)
        done.append(stored.where(F.size("_open") == 0).select(*own, "fields"))
        todo = stored.where(F.size("_open") > 0)
        if todo.isEmpty():
            break
    return reduce(lambda a, b: a.unionByName(b), done)
