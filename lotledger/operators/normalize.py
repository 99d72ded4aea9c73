"""Raw vehicle records of any shape to the 23-column vehicle.

All steps work inside the row (higher-order functions over the record's members), so
normalising needs no shuffle; only the per-dealer dedupe does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as V
from ..functions import json_values as J
from ..functions import text as X
from ..functions import urls as U
from ..schemas import VEHICLE_COLUMNS
from .keyed import first_by, top_per_group
from .rows import settle

_ENTRY = "struct<text:string,kind:string>"
MEMBER_LEVELS = 5


def flat_leaves(raw: Column, levels: int | None = MEMBER_LEVELS) -> Column:
    """All non-object members down to ``levels`` levels, in document order; all without a number."""
    shape = f"struct<open:array<{J.NODE}>,leaves:array<{J.NODE}>>"
    top = J.object_members(raw, J.root_path(), F.lit(None).cast("string"), True)
    start = F.struct(top.alias("open"), J.no_nodes().alias("leaves")).cast(shape)

    def leaves_of(nodes: Column) -> Column:
        return F.filter(nodes, lambda n: n["kind"] != J.OBJECT)

    def descend(acc: Column, _: Column) -> Column:
        inner = F.flatten(F.transform(
            F.filter(acc["open"], lambda n: n["kind"] == J.OBJECT),
            lambda n: J.object_members(n["text"], n["path"], n["key"], True),
        ))
        kept = F.concat(acc["leaves"], leaves_of(acc["open"]))
        return F.struct(inner.alias("open"), kept.alias("leaves"))

    # No document is deeper than it has braces; a round without an open object costs nothing.
    rounds = F.regexp_count(raw, F.lit(r"\{")) if levels is None else F.lit(levels - 1)
    done = F.aggregate(
        F.sequence(F.lit(0), F.coalesce(rounds, F.lit(0))), start, lambda acc, i: F.when(i > 0, descend(acc, i)).otherwise(acc),
        lambda acc: F.concat(acc["leaves"], leaves_of(acc["open"])),
    )
    return F.array_sort(done)


def first_writers(leaves: Column) -> Column:
    """Leaves to ``struct<keys, entries>``: per key the first writer stays.

    A leaf also writes ``<parent>_<key>``, but only if it won its bare key. A NULL
    value occupies its key.
    """
    shape = f"struct<keys:array<string>,entries:array<{_ENTRY}>>"
    empty = F.struct(
        F.array().cast("array<string>").alias("keys"),
        F.array().cast(f"array<{_ENTRY}>").alias("entries"),
    ).cast(shape)

    def names_of(acc: Column, leaf: Column) -> Column:
        full = F.concat(leaf["parent"], F.lit("_"), leaf["key"])
        return (
            F.when(F.array_contains(acc["keys"], leaf["key"]), F.array().cast("array<string>"))
            .when(full.isNull() | F.array_contains(acc["keys"], full), F.array(leaf["key"]))
            .otherwise(F.array(leaf["key"], full))
        )

    def write(acc: Column, leaf: Column) -> Column:
        entry = F.struct(leaf["text"].alias("text"), leaf["kind"].alias("kind"))
        return X.bind(
            names_of(acc, leaf),
            lambda names: F.struct(
                F.concat(acc["keys"], names).alias("keys"),
                F.concat(acc["entries"], F.array_repeat(entry, F.size(names))).alias("entries"),
            ),
        )

    return F.aggregate(leaves, empty, write)


def _array_head(items: Column) -> Column:
    """First element as text: an empty array reads 'undefined', a nested container or
    NULL is nothing."""
    head = F.get(items, 0)
    return F.when(F.size(items) == 0, F.lit("undefined")).when(
        ~head["kind"].isin(J.OBJECT, J.ARRAY), head["text"]
    )


def _array_joined(items: Column) -> Column:
    return F.array_join(
        F.transform(
            items,
            lambda n: F.when(n["kind"] == J.OBJECT, "[object Object]").otherwise(
                F.coalesce(n["text"], F.lit(""))
            ),
        ),
        ",",
    )


def _readable(pair: Column) -> Column:
    """Key with the text a string field reads, the text a number field reads, and
    whether the value counts as filled."""
    entry = pair["e"]
    plain = F.struct(entry["text"].alias("text"), entry["text"].alias("digits"))
    listed = X.bind(
        J.array_members(entry["text"], J.root_path(), F.lit(None).cast("string")),
        lambda items: F.struct(
            _array_head(items).alias("text"), _array_joined(items).alias("digits")
        ),
    )
    filled = (entry["kind"] != J.NULL) & ((entry["kind"] != J.STRING) | (entry["text"] != ""))
    return F.struct(
        pair["k"].alias("k"),
        F.when(entry["kind"] == J.ARRAY, listed).otherwise(plain).alias("e"),
        filled.alias("filled"),
    )


def with_alias_maps(df: DataFrame, raw: str, levels: int | None = MEMBER_LEVELS) -> DataFrame:
    """Adds ``_exact`` (key -> filled value) and ``_suffix`` (alias -> filled value of
    the first key that equals it or ends in ``_alias``)."""
    aliases = sorted({a for names in V.FIELD_ALIASES.values() for a in names})
    last_words = sorted({a.rsplit("_", 1)[-1] for a in aliases})
    df = df.withColumn("_flat", first_writers(flat_leaves(F.col(raw), levels)))
    zipped = F.arrays_zip(F.col("_flat.keys").alias("k"), F.col("_flat.entries").alias("e"))
    df = df.withColumn(
        "_pairs", F.transform(F.filter(
            zipped, lambda p: F.substring_index(p["k"], "_", -1).isin(last_words)
        ), _readable)
    ).drop("_flat")

    def ending(pair: Column, key: Column) -> Column:
        return F.struct(key.alias("k"), pair["e"].alias("e"), pair["filled"].alias("filled"))

    def endings(pair: Column) -> Column:
        cut = X.bind(
            F.split(pair["k"], "_"),
            lambda parts: F.transform(
                F.sequence(F.lit(1), F.size(parts)),
                lambda i: ending(pair, F.array_join(F.slice(parts, i, F.size(parts)), "_")),
            ),
        )
        return F.when(pair["k"].contains("_"), cut).otherwise(F.array(ending(pair, pair["k"])))

    ends = F.filter(F.flatten(F.transform("_pairs", endings)), lambda x: x["k"].isin(aliases))

    def as_map(pairs: Column) -> Column:
        return F.map_from_entries(
            F.transform(pairs, lambda x: F.struct(x["k"].alias("key"), x["e"].alias("value")))
        )

    def first_hits(hits: Column) -> Column:
        return X.bind(
            F.transform(hits, lambda x: x["k"]),
            lambda names: F.filter(
                hits, lambda x, i: (F.array_position(names, x["k"]) == i + 1) & x["filled"]
            ),
        )

    exact = F.filter("_pairs", lambda x: x["filled"])
    return df.withColumns({
        "_exact": as_map(exact), "_suffix": as_map(X.bind(ends, first_hits)),
    }).drop("_pairs")


def picked_values(exact: Column, suffix: Column) -> Column:
    """One entry per field of ``FIELD_ALIASES``: the first alias in order that has a
    filled exact key, else a filled suffix hit.

    A loop over the alias table keeps the generated code small; spelling out some 220
    lookups makes a method the JIT compiler refuses.
    """
    table = F.array(*[
        F.array(*[F.lit(a) for a in names]) for names in V.FIELD_ALIASES.values()
    ])

    def lookup(maps: Column) -> Column:
        def found(alias: Column) -> Column:
            return F.coalesce(
                F.try_element_at(maps["exact"], alias), F.try_element_at(maps["suffix"], alias)
            )

        return F.transform(
            table,
            lambda names: F.get(
                F.filter(F.transform(names, found), lambda e: e.isNotNull()), 0
            ),
        )

    # bound, so that merging projections cannot pull the maps into the loop
    return X.bind(F.struct(exact.alias("exact"), suffix.alias("suffix")), lookup)


_INT_FIELDS = ("year", "mileage", "doors")
_FLOAT_FIELDS = ("price", "msrp")


def normalize_vehicles(
    df: DataFrame, raw: str = "raw", base: str = "origin", run_year: int = 2024,
    text_chars: int | None = None, raw_chars: int | None = None, levels: int | None = MEMBER_LEVELS,
) -> DataFrame:
    """Replace the raw JSON column by the 23 vehicle columns. No row is dropped.

    ``text_chars`` and ``raw_chars`` bound text fields and ``raw_json``, where given. Members
    are read down to ``levels`` levels, as the rules say, or all of them (None).
    """
    keep = [c for c in df.columns if c != raw]
    picked = settle(
        with_alias_maps(df, raw, levels), [*keep, raw],
        {"_picked": picked_values(F.col("_exact"), F.col("_suffix"))},
    )
    values = {}
    for i, field in enumerate(V.FIELD_ALIASES):
        entry = F.get("_picked", i)
        if field in _INT_FIELDS:
            values[field] = X.to_int(entry["digits"])
        elif field in _FLOAT_FIELDS:
            values[field] = X.to_float(entry["digits"])
        else:
            values[field] = X.at_most(X.trimmed(entry["text"]), text_chars)
    values["raw_json"] = X.at_most(F.col(raw), raw_chars)
    typed = picked.select(*keep, *[values[c].alias(c) for c in VEHICLE_COLUMNS])
    return finish_fields(typed, base, run_year)


def finish_fields(df: DataFrame, base: str, run_year: int) -> DataFrame:
    """VIN, year, condition and URL rules on typed columns."""
    df = settle(df, df.columns, {
        "_url": U.resolve(F.col("url"), F.col(base)),
        "_image": U.resolve(F.col("image_url"), F.col(base)),
    })
    # the page URL is resolved first; if that fails the image keeps its text too
    url_ok = F.col("url").isNull() | F.col("_url").isNotNull()
    return df.withColumns({
        "vin": X.vin_rule(F.col("vin")),
        "year": X.year_rule(F.col("year"), run_year),
        "condition": X.condition_rule(F.col("condition")),
        "image_url": F.coalesce(F.when(url_ok, F.col("_image")), F.col("image_url")),
        "url": F.coalesce(F.col("_url"), F.col("url")),
    }).drop("_url", "_image")


def is_valid_vehicle() -> Column:
    make = F.coalesce(F.col("make"), F.lit("")) != ""
    model = F.coalesce(F.col("model"), F.lit("")) != ""
    year = F.coalesce(F.col("year"), F.lit(0)) != 0
    return (F.coalesce(F.col("vin"), F.lit("")) != "") | (make & (model | year))


def vehicle_key() -> Column:
    return F.coalesce(
        F.col("vin"),
        X.null_safe_key(*[F.col(c) for c in ("make", "model", "year", "stock_number", "url")]),
    )


def dedupe_vehicles(df: DataFrame, owner: list[str], order: list[str]) -> DataFrame:
    """Valid vehicles, the first per owner and key."""
    keyed = df.filter(is_valid_vehicle()).withColumn("_key", vehicle_key())
    return first_by(keyed, [*owner, "_key"], [F.col(c) for c in order]).drop("_key")


def normalize_many(
    df: DataFrame,
    owner: list[str],
    order: list[str],
    raw: str = "raw",
    base: str = "origin",
    run_year: int = 2024,
    levels: int | None = MEMBER_LEVELS,
) -> DataFrame:
    return dedupe_vehicles(normalize_vehicles(df, raw, base, run_year, levels=levels), owner, order)


def cap_vehicles(
    df: DataFrame, owner: list[str], order: list[str], most: int | None = None
) -> DataFrame:
    """The first ``most`` vehicles per dealer, in order; all without a number."""
    return df if most is None else top_per_group(df, owner, order, most)
