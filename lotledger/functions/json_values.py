"""JSON documents as columns: ordered members, value kinds, script-style text.

Member order matters to the inventory rules and VARIANT sorts its keys, so a document
is read twice: as text in document order, and as VARIANT to know what each member is.

A *node* is ``struct<path array<int>, parent string, key string, text string,
kind string>``. The kind is the first two letters of the value's VARIANT schema:
OBject, ARray, STring, BOolean, VOid (null), anything else is a number.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import bind

NODE = "struct<path:array<int>,parent:string,key:string,text:string,kind:string>"
OBJECT, ARRAY, STRING, BOOLEAN, NULL = "OB", "AR", "ST", "BO", "VO"
_STRICT = {"allowSingleQuotes": "false"}


def no_nodes() -> Column:
    return F.array().cast(f"array<{NODE}>")


def root_path() -> Column:
    return F.array().cast("array<int>")


def kind_of(value: Column) -> Column:
    return F.left(F.schema_of_variant(value), F.lit(2))


def number_text(value: Column) -> Column:
    """Number as a script prints it: 52000.0 is 52000, 1e10 is 10000000000."""
    def shown(text: Column) -> Column:
        wide = text.try_cast("double").try_cast("decimal(38,12)").cast("string")
        return F.regexp_replace(
            F.when(text.contains("E"), F.coalesce(wide, text)).otherwise(text),
            r"(\.[0-9]*?)0+$", "$1",
        )

    text = value.cast("string")
    return F.when(
        text.contains("."), F.regexp_replace(shown(text), r"\.$", "")
    ).otherwise(text)


def value_text(text: Column, value: Column, kind: Column) -> Column:
    return (
        F.when(kind.isin(OBJECT, ARRAY, STRING, BOOLEAN), text)
        .when(kind != NULL, number_text(value))
    )


def clean_key(key: Column) -> Column:
    return F.regexp_replace(F.lower(key), "[^a-z0-9_]", "")


def _node(path: Column, parent: Column, key: Column, text: Column, value: Column) -> Column:
    return bind(
        kind_of(value),
        lambda kind: F.struct(
            path.alias("path"),
            parent.alias("parent"),
            key.alias("key"),
            value_text(text, value, kind).alias("text"),
            kind.alias("kind"),
        ),
    )


def object_members(text: Column, path: Column, parent: Column, keys_cleaned: bool) -> Column:
    """The members of a JSON object in document order.

    A repeated key keeps its first place and its last value.
    """
    zipped = F.arrays_zip(
        F.map_entries(F.from_json(text, "map<string,string>", _STRICT)).alias("s"),
        F.map_entries(F.from_json(text, "map<string,variant>", _STRICT)).alias("v"),
    )

    def last_of(rows: Column) -> Column:
        names = F.transform(rows, lambda r: r["s"]["key"])
        return F.when(F.size(F.array_distinct(names)) == F.size(rows), rows).otherwise(
            F.transform(
                F.array_distinct(names),
                lambda k: F.element_at(F.filter(rows, lambda r: r["s"]["key"] == k), -1),
            )
        )

    def node(row: Column, i: Column) -> Column:
        key = row["s"]["key"]
        return _node(
            F.array_append(path, i.cast("int")),
            parent,
            clean_key(key) if keys_cleaned else key,
            row["s"]["value"],
            row["v"]["value"],
        )

    return F.coalesce(F.transform(bind(zipped, last_of), node), no_nodes())


def array_members(text: Column, path: Column, parent: Column) -> Column:
    zipped = F.arrays_zip(
        F.from_json(text, "array<string>", _STRICT).alias("s"),
        F.from_json(text, "array<variant>", _STRICT).alias("v"),
    )
    nodes = F.transform(
        zipped,
        lambda row, i: _node(
            F.array_append(path, i.cast("int")), parent, F.lit(None).cast("string"),
            row["s"], row["v"],
        ),
    )
    return F.coalesce(nodes, no_nodes())


def truthy(value: Column) -> Column:
    """The VARIANT where a script would call it true, else NULL."""
    def kept(v: Column) -> Column:
        empty = F.to_json(v).isin('""', "0", "false", "null")
        return F.when(v.isNotNull() & ~empty, v)

    return bind(value, kept)


def at(value: Column, path: str) -> Column:
    """A VARIANT member or NULL."""
    return F.try_variant_get(value, path, "variant")
