"""Vehicle records inside pages and JSON responses.

Each page or response is one row and all of its parsing happens inside that row; the
records come out by one explode. Nested documents are walked level by level with
``aggregate`` over a frontier of members, so there is no recursion and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as V
from ..functions import json_values as J
from ..functions import text as X
from ..functions import urls as U
from .blobs import script_literals
from .keyed import first_by
from .rows import explode_rows, settle

_VEHICLE_ARRAY_DEPTH = 8


# --- scripts -------------------------------------------------------------------

def page_scripts(body: Column) -> Column:
    """``array<struct<attrs, text>>`` of the page's scripts in order."""
    pattern = F.lit(r"(?is)<script\b([^>]*)>(.*?)</script\s*>")
    return F.arrays_zip(
        F.regexp_extract_all(body, pattern, F.lit(1)).alias("attrs"),
        F.regexp_extract_all(body, pattern, F.lit(2)).alias("text"),
    )


def is_ld(script: Column) -> Column:
    return script["attrs"].rlike(r"""(?i)\btype\s*=\s*["']?application/ld\+json""")


def is_inline(script: Column) -> Column:
    return ~script["attrs"].rlike(r"(?i)(^|\s)src\s*=")


def is_next_data(script: Column) -> Column:
    return script["attrs"].rlike(r"""\bid\s*=\s*["']?__NEXT_DATA__""")


def is_state(script: Column) -> Column:
    return script["text"].rlike("(?i)" + V.STATE_SCRIPT)


# --- JSON-LD -------------------------------------------------------------------

def _list_at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "array<variant>")


def _items(value: Column) -> Column:
    """An array's elements, or the value itself as the only one."""
    return F.coalesce(_list_at(value, "$"), F.array(value))


def _types(item: Column) -> Column:
    kinds = F.coalesce(_list_at(item, "$['@type']"), F.array(J.at(item, "$['@type']")))
    return F.transform(kinds, lambda t: F.lower(F.coalesce(t.cast("string"), F.lit(""))))


def ld_record(item: Column) -> Column:
    """The 20-field projection of a JSON-LD vehicle, as JSON text."""
    def get(path: str) -> Column:
        return J.at(item, "$." + path)

    def offer(path: str) -> Column:  # of a list of offers the first counts
        return F.coalesce(get("offers[0]." + path), get("offers." + path))

    def either(*options: Column) -> Column:  # the last one stays even when empty
        return F.coalesce(*[J.truthy(o) for o in options[:-1]], options[-1])

    fields = {
        "vin": either(get("vehicleIdentificationNumber"), get("vin"), get("mpn")),
        "stock_number": get("sku"),
        "make": either(get("brand.name"), get("manufacturer.name"), get("brand")),
        "model": either(get("model.name"), get("model")),
        "trim": get("vehicleConfiguration"),
        "year": either(get("vehicleModelDate"), get("productionDate"), get("modelDate")),
        "mileage": either(get("mileageFromOdometer.value"), get("mileageFromOdometer")),
        "price": offer("price"),
        "exteriorColor": get("color"),
        "interiorColor": get("vehicleInteriorColor"),
        "transmission": get("vehicleTransmission"),
        "fuelType": get("fuelType"),
        "engine": get("vehicleEngine.name"),
        "bodyStyle": get("bodyType"),
        "doors": get("numberOfDoors"),
        "condition": either(get("itemCondition"), offer("itemCondition")),
        "url": either(get("url"), offer("url")),
        "image": F.when(_list_at(item, "$.image").isNotNull(), get("image[0]")).otherwise(get("image")),
        "description": get("description"),
        "location": either(offer("availableAtOrFrom.name"), offer("seller.name")),
    }
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def ld_records(texts: Column) -> Column:
    """Vehicle records of JSON-LD texts, in page order.

    Item lists and graphs are followed as deep as they are named in the text.
    """
    levels = F.coalesce(F.array_max(F.transform(
        texts, lambda t: F.regexp_count(t, F.lit("@graph|itemListElement"))
    )), F.lit(0)) + 1
    open_type = "array<struct<path:array<int>,item:variant>>"
    done_type = "array<struct<path:array<int>,raw:string>>"
    start = F.flatten(F.transform(
        texts,
        lambda t, i: F.transform(
            _items(F.try_parse_json(X.trimmed(t))),
            lambda v, j: F.struct(
                F.array(i.cast("int"), j.cast("int")).alias("path"), v.alias("item")
            ),
        ),
    ))

    def is_vehicle(item: Column) -> Column:
        vin = F.coalesce(*[
            J.truthy(J.at(item, p)) for p in ("$.vehicleIdentificationNumber", "$.vin", "$.mpn")
        ])
        return X.bind(
            _types(item),
            lambda types: F.arrays_overlap(
                types, F.array(*[F.lit(t) for t in ("vehicle", "car", "motorcycle", "motorizedbicycle")])
            ) | (F.array_contains(types, "product") & vin.isNotNull()),
        )

    def inner(item: Column) -> Column:
        elements = F.transform(
            _list_at(item, "$.itemListElement"),
            lambda e: F.coalesce(J.truthy(J.at(e, "$.item")), e),
        )
        listed = F.array_contains(_types(item), "itemlist")
        return F.coalesce(
            F.when(listed, elements), _list_at(item, "$['@graph']"),
            F.array().cast("array<variant>"),
        )

    def level(acc: Column, _: Column) -> Column:
        def split(marked: Column) -> Column:
            hits = F.transform(
                F.filter(marked, lambda m: m["hit"]),
                lambda m: F.struct(m["n"]["path"].alias("path"), ld_record(m["n"]["item"]).alias("raw")),
            )
            deeper = F.flatten(F.transform(
                F.filter(marked, lambda m: ~m["hit"]),
                lambda m: F.transform(
                    inner(m["n"]["item"]),
                    lambda v, j: F.struct(
                        F.array_append(m["n"]["path"], j.cast("int")).alias("path"), v.alias("item")
                    ),
                ),
            ))
            return F.struct(deeper.alias("open"), F.concat(acc["done"], hits).alias("done"))

        marked = F.transform(
            acc["open"],
            lambda n: F.struct(n.alias("n"), F.coalesce(is_vehicle(n["item"]), F.lit(False)).alias("hit")),
        )
        return X.bind(marked, split)

    first = F.struct(
        start.cast(open_type).alias("open"), F.array().cast(done_type).alias("done")
    ).cast(f"struct<open:{open_type},done:{done_type}>")
    done = F.aggregate(F.sequence(F.lit(0), levels), first, level, lambda a: a["done"])
    return F.transform(F.array_sort(done), lambda d: d["raw"])


def ld_inventory_signal(body: Column) -> Column:
    """JSON-LD item (or one graph level) of a vehicle-like type with VIN, model or brand."""
    texts = F.regexp_extract_all(
        body, F.lit(r"(?is)<script[^>]+application/ld\+json[^>]*>(.*?)</script>"), F.lit(1)
    )

    def one(item: Column) -> Column:
        named = F.coalesce(*[
            J.truthy(J.at(item, p))
            for p in ("$.vehicleIdentificationNumber", "$.vin", "$.model", "$.brand")
        ])
        kind = J.at(item, "$['@type']").cast("string")
        return F.coalesce(kind.rlike("(?i)" + V.LD_INVENTORY_TYPE) & named.isNotNull(), F.lit(False))

    def doc(text: Column) -> Column:
        return X.bind(
            F.try_parse_json(X.trimmed(text)),
            lambda v: F.exists(
                F.coalesce(
                    _list_at(v, "$"),
                    F.concat(F.array(v), F.coalesce(_list_at(v, "$['@graph']"), F.array().cast("array<variant>"))),
                ),
                one,
            ),
        )

    return F.exists(texts, lambda t: F.coalesce(doc(t), F.lit(False)))


# --- arrays of vehicles anywhere in a document ------------------------------------

def _key_words_in(text: Column) -> Column:
    words = F.array(*[F.lit(w) for w in V.VEHICLE_KEY_WORDS])
    return F.size(F.filter(words, lambda w: F.contains(text, w)))


def could_hold_vehicles(text: Column) -> Column:
    """Three of the ten key words occur: needed for a hit, far cheaper than a parse."""
    return X.bind(F.lower(text), _key_words_in) >= 3


def vehicle_arrays(text: Column, depth: int | None = _VEHICLE_ARRAY_DEPTH) -> Column:
    """``array<struct<path, raws>>``: arrays of objects whose first element's keys hold
    three of the ten key words, down to ``depth`` (all without a number), in discovery order."""
    node = "array<" + J.NODE + ">"
    hit = "array<struct<path:array<int>,raws:array<string>>>"
    opening = F.left(F.trim(text), F.lit(1))
    root = F.struct(
        J.root_path().alias("path"), F.lit(None).cast("string").alias("parent"),
        F.lit(None).cast("string").alias("key"), text.alias("text"),
        F.when(opening == "[", J.ARRAY).otherwise(J.OBJECT).alias("kind"),
    )
    usable = opening.isin("{", "[") & could_hold_vehicles(text)
    start = F.struct(
        F.when(usable, F.array(root)).otherwise(J.no_nodes()).cast(node).alias("open"),
        F.array().cast(hit).alias("hits"),
    ).cast(f"struct<open:{node},hits:{hit}>")
    none = F.lit(None).cast("string")

    def container(n: Column) -> Column:
        return n["kind"].isin(J.OBJECT, J.ARRAY)

    def members(n: Column) -> Column:
        return F.when(n["kind"] == J.ARRAY, J.array_members(n["text"], n["path"], none)).otherwise(
            J.object_members(n["text"], n["path"], none, False)
        )

    def is_hit(e: Column) -> Column:
        head = F.get(e["kids"], 0)
        names = X.bind(
            F.lower(F.array_join(F.map_keys(F.from_json(head["text"], "map<string,string>")), "\n")),
            _key_words_in,
        )
        return (
            (e["kind"] == J.ARRAY) & (F.size(e["kids"]) > 0) & F.forall(e["kids"], container)
            & (head["kind"] == J.OBJECT) & (F.coalesce(names, F.lit(0)) >= 3)
        )

    def level(acc: Column, _: Column) -> Column:
        opened = F.transform(
            acc["open"],
            lambda n: F.struct(n["path"].alias("path"), n["kind"].alias("kind"), members(n).alias("kids")),
        )
        return X.bind(opened, lambda nodes: F.struct(
            F.flatten(F.transform(nodes, lambda e: F.filter(
                e["kids"], lambda k: container(k) & could_hold_vehicles(k["text"])
            ))).alias("open"),
            F.concat(acc["hits"], F.transform(F.filter(nodes, is_hit), lambda e: F.struct(
                e["path"].alias("path"), F.transform(e["kids"], lambda k: k["text"]).alias("raws")
            ))).alias("hits"),
        ))

    # No document is deeper than it has brackets; a round without an open member costs nothing.
    last = F.regexp_count(text, F.lit(r"[\[{]")) if depth is None else F.lit(depth)
    return F.array_sort(F.aggregate(
        F.sequence(F.lit(0), F.coalesce(last, F.lit(0))), start, level, lambda a: a["hits"]
    ))


def vehicle_records(text: Column, depth: int | None = _VEHICLE_ARRAY_DEPTH) -> Column:
    """All records of all vehicle arrays, concatenated in discovery order."""
    return F.flatten(F.transform(vehicle_arrays(text, depth), lambda h: h["raws"]))


# --- records of a page ---------------------------------------------------------

def embedded_records(captures: DataFrame, keep: list[str], depth: int | None = _VEHICLE_ARRAY_DEPTH) -> DataFrame:
    """``keep..., source, priority, ord, raw``: the records of each page's best source.

    JSON-LD comes first, then the first state script that yields, then the first inline
    script that yields. A source that yields records blocks the later ones, whether or
    not its records turn out valid.
    """
    df = captures.withColumn("_scripts", page_scripts(F.col("body"))).select(*keep, "_scripts")
    ld_texts = F.transform(F.filter("_scripts", is_ld), lambda s: s["text"])
    ranked = F.array_sort(F.transform(
        F.filter(
            F.transform("_scripts", lambda s, i: F.struct(s.alias("s"), i.alias("i"))),
            lambda x: (is_inline(x["s"]) | is_next_data(x["s"])) & could_hold_vehicles(x["s"]["text"]),
        ),
        lambda x: F.struct(
            F.when(is_next_data(x["s"]), 0).when(is_state(x["s"]), 1).otherwise(2).alias("rank"),
            x["i"].alias("pos"), x["s"]["text"].alias("text"),
        ),
    ))
    df = settle(df, [*keep, "_scripts"], {"_ld": ld_records(ld_texts)})
    df = df.select(
        *keep, "_ld",
        F.when(F.size("_ld") == 0, ranked).otherwise(F.slice(ranked, 1, 0)).alias("_ranked"),
    )
    df = df.withColumn("_literals", script_literals(F.transform("_ranked", lambda r: r["text"])))
    found = F.filter(
        F.transform(
            F.arrays_zip(F.col("_ranked").alias("r"), F.col("_literals").alias("l")),
            lambda x: F.struct(
                x["r"]["rank"].alias("rank"),
                F.flatten(F.transform(x["l"], lambda t: vehicle_records(t, depth))).alias("raws"),
            ),
        ),
        lambda x: F.size(x["raws"]) > 0,
    )
    df = settle(df, [*keep, "_ld"], {"_script": F.get(found, 0)})
    from_ld = F.size("_ld") > 0
    best = F.when(from_ld, F.struct(
        F.lit(V.SOURCE_LD).alias("source"), F.lit(0).alias("priority"), F.col("_ld").alias("raws")
    )).otherwise(F.struct(
        F.when(F.col("_script.rank") < 2, V.SOURCE_STATE).otherwise(V.SOURCE_INLINE).alias("source"),
        F.when(F.col("_script.rank") < 2, 1).otherwise(2).alias("priority"),
        F.col("_script.raws").alias("raws"),
    ))
    df = settle(df, keep, {"_best": best}).withColumns(
        {"source": F.col("_best.source"), "priority": F.col("_best.priority")}
    )
    return explode_rows(df, [*keep, "source", "priority"], F.col("_best.raws"), "ord", "raw")


def response_records(responses: DataFrame, keep: list[str], depth: int | None = _VEHICLE_ARRAY_DEPTH) -> DataFrame:
    """``keep..., ord, raw`` of every vehicle array in JSON responses."""
    return explode_rows(responses, keep, vehicle_records(F.col("body"), depth), "ord", "raw")


# --- platform responses ----------------------------------------------------------

def cars_commerce_rows(responses: DataFrame) -> DataFrame:
    """Every listing with a VIN in Cars Commerce answers, as card columns."""
    listed = _list_at(F.try_parse_json("body"), "$.data.listings")
    rows = explode_rows(
        responses.filter(F.col("page_url").rlike("(?i)" + V.CARS_COMMERCE_URL)),
        ["run_id", "dealer_url", "page_ord"], listed, "card_ord", "_v",
    )

    def text(path: str) -> Column:
        value = J.at(F.col("_v"), "$." + path)
        return F.when(
            ~F.left(F.schema_of_variant(value), F.lit(2)).isin(J.STRING, J.BOOLEAN, J.OBJECT, J.ARRAY),
            J.number_text(value),
        ).otherwise(value.cast("string"))

    def positive(path: str) -> Column:
        shown = text("pricing." + path)
        return F.when(shown.try_cast("double") > 0, shown)

    cards = rows.select(
        "run_id", "dealer_url", "page_ord", "card_ord",
        text("vin").alias("vin"), text("stock").alias("stock_number"), text("year").alias("year"),
        text("make").alias("make"), text("model").alias("model"), text("trim").alias("trim"),
        text("mileage").alias("mileage"), text("type").alias("condition"),
        F.coalesce(positive("our_price"), positive("price"), positive("msrp")).alias("price"),
        positive("msrp").alias("msrp"),
        text("body_details.type").alias("body_style"),
        text("body_details.number_of_doors").alias("doors"),
        text("mechanical.drivetrain").alias("drivetrain"),
        text("mechanical.transmission").alias("transmission"),
        text("mechanical.fuel_type").alias("fuel_type"),
        text("mechanical.engine").alias("engine"),
        F.nullif(text("vdp_url"), F.lit("")).alias("url"),
        text("media.images[0]").alias("image_url"),
    )
    return cards.filter("vin is not null and vin <> ''")


def last_listings(cards: DataFrame) -> DataFrame:
    """The last listing per VIN, at the place of the first."""
    fields = [c for c in cards.columns if c not in ("run_id", "dealer_url", "page_ord", "card_ord")]
    place = F.struct("page_ord", "card_ord")
    folded = cards.groupBy("run_id", "dealer_url", F.col("vin").alias("_vin")).agg(
        F.max_by(F.struct(*fields), place).alias("_c"), F.min(place).alias("_at")
    )
    return folded.select("run_id", "dealer_url", "_at.page_ord", "_at.card_ord", "_c.*")


def cars_commerce_listings(responses: DataFrame) -> DataFrame:
    return last_listings(cars_commerce_rows(responses))


def announced_totals(responses: DataFrame) -> DataFrame:
    """``run_id, dealer_url, total``: the number of vehicles Cars Commerce answers announce."""
    said = F.try_variant_get(F.try_parse_json("body"), "$.data.total_vehicle_count", "int")
    return (
        responses.filter(F.col("page_url").rlike("(?i)" + V.CARS_COMMERCE_URL))
        .select("run_id", "dealer_url", said.alias("total"))
        .groupBy("run_id", "dealer_url").agg(F.max("total").alias("total"))
    )


def dealercom_rows(responses: DataFrame, depth: int | None = _VEHICLE_ARRAY_DEPTH) -> DataFrame:
    """Every record of Dealer.com inventory answers with its ``_key``: VIN, else uuid, else
    the whole record."""
    rows = response_records(
        responses.filter(F.col("page_url").rlike("(?i)" + V.DEALERCOM_URL)),
        ["run_id", "dealer_url", "page_ord"], depth,
    )
    members = F.from_json("raw", "map<string,string>")
    rows = rows.withColumn("_m", members)
    key = F.coalesce(
        F.nullif(F.try_element_at("_m", F.lit("vin")), F.lit("")),
        F.nullif(F.try_element_at("_m", F.lit("uuid")), F.lit("")),
        F.sha2("raw", 256),
    )
    return rows.withColumn("_key", key).drop("_m")


def first_records(keyed: DataFrame) -> DataFrame:
    return first_by(
        keyed, ["run_id", "dealer_url", "_key"], [F.col("page_ord"), F.col("ord")]
    ).drop("_key")


def dealercom_records(responses: DataFrame, depth: int | None = _VEHICLE_ARRAY_DEPTH) -> DataFrame:
    """Records of Dealer.com inventory answers, the first per key."""
    return first_records(dealercom_rows(responses, depth))


def answer_records(answers: DataFrame) -> DataFrame:
    """Model answers: code fences off, parsed, a lone object counts as a list of one."""
    bare = F.trim(X.spaced(F.regexp_replace("text", "```json|```", "")))
    parsed = answers.withColumn("_t", bare).filter(F.try_parse_json("_t").isNotNull())
    none = F.lit(None).cast("string")
    rows = F.when(
        F.col("_t").startswith("["),
        F.transform(J.array_members(F.col("_t"), J.root_path(), none), lambda n: n["text"]),
    ).otherwise(F.array("_t"))
    return explode_rows(parsed, ["dealer_url"], rows, "ord", "raw").withColumn(
        "origin", U.origin(F.col("dealer_url"))
    )
