"""Golden records of flattening, alias choice and the vehicle rules."""

import json

from pyspark.sql import functions as F

from lotledger.operators import normalize as N


def flat(spark, record):
    df = spark.createDataFrame([(json.dumps(record),)], "raw string")
    row = df.select(N.first_writers(N.flat_leaves(F.col("raw"))).alias("f")).first()["f"]
    return dict(zip(row["keys"], [e["text"] for e in row["entries"]]))


def vehicle(spark, record):
    raw = record if isinstance(record, str) else json.dumps(record)
    df = spark.createDataFrame([(raw, "https://d.com")], "raw string, origin string")
    return N.normalize_vehicles(df).first().asDict()


def test_null_occupies_its_key(spark):
    assert flat(spark, {"a": {"price": None}, "b": {"price": 5}}) == {"price": None, "a_price": None}


def test_prefix_is_the_immediate_parent(spark):
    assert flat(spark, {"x": {"y": {"vin": "V"}}}) == {"vin": "V", "y_vin": "V"}


def test_written_prefix_blocks_a_later_literal_key(spark):
    assert flat(spark, {"a": {"price": 1}, "a_price": 2})["a_price"] == "1"


def test_five_levels_deep_and_no_further(spark):
    deep = {"a": {"b": {"c": {"d": {"vin": "five"}}}}}
    assert flat(spark, deep) == {"vin": "five", "d_vin": "five"}
    assert flat(spark, {"z": deep}) == {}


def test_document_order_not_alphabetical(spark):
    v = vehicle(spark, '{"z":{"price":1},"a":{"price":2}}')
    assert v["price"] == 1.0


FIELD_CASES = [
    ({"brand": {"name": "Q"}}, "make", None),
    ({"mileage": 52000.0}, "mileage", 52000),
    ({"mileage": "52000.0"}, "mileage", 520000),
    ({"doors": [1, 2]}, "doors", 12),
    ({"trim": ["a", "b"]}, "trim", "a"),
    ({"trim": []}, "trim", "undefined"),
    ({"trim": [{}]}, "trim", None),
    ({"model": True}, "model", "true"),
    ({"año": 2001}, "year", None),
    ({"vin": "", "x": {"vin": "12345678901"}}, "vin", None),
    ({"vin": None, "vin_number": "12345678901"}, "vin", "12345678901"),
    ({"info_vin": "12345678901"}, "vin", "12345678901"),
    ({"image_url": "/a.png"}, "image_url", None),
    ({"images": ["/a.png", "/b.png"]}, "image_url", "https://d.com/a.png"),
    ({"price": 1e10}, "price", 1e10),
    ({"make": "  Ford ﻿"}, "make", "Ford"),
]


def test_vehicle_fields(spark):
    rows = [(i, json.dumps(r), "https://d.com") for i, (r, _, _) in enumerate(FIELD_CASES)]
    df = spark.createDataFrame(rows, "i int, raw string, origin string")
    got = {r["i"]: r for r in N.normalize_vehicles(df).collect()}
    assert [got[i][f] for i, (_, f, _) in enumerate(FIELD_CASES)] == [e for _, _, e in FIELD_CASES]


def test_first_suffix_key_wins_even_when_empty(spark):
    # the first key that ends in the alias is empty: the next alias is tried, not the next key
    assert vehicle(spark, {"a_vin": "", "b_vin": "12345678901"})["vin"] is None


def test_unresolvable_url_keeps_its_text_and_the_image(spark):
    v = vehicle(spark, {"url": "http://exa mple.com/", "image": "/a.png"})
    assert (v["url"], v["image_url"]) == ("http://exa mple.com/", "/a.png")


def test_validity(spark):
    rows = [("V" * 11, None, None, None, True), (None, "M", "X", None, True), (None, "M", None, 2000, True),
            (None, "M", "", 0, False), (None, None, "X", 2000, False)]
    df = spark.createDataFrame(rows, "vin string, make string, model string, year int, want boolean")
    assert [r["got"] == r["want"] for r in df.select("want", N.is_valid_vehicle().alias("got")).collect()] == [True] * 5


def test_dedupe_keeps_the_first_and_spells_nulls(spark):
    raws = ['{"make":"A","model":"B"}', '{"make":"A","model":"B"}', '{"vin":"12345678901"}', '{"x":1}']
    df = spark.createDataFrame([("d", i, r, "https://d.com") for i, r in enumerate(raws)],
                               "dealer string, ord int, raw string, origin string")
    out = N.normalize_many(df, ["dealer"], ["ord"]).select("ord").collect()
    assert sorted(r["ord"] for r in out) == [0, 2]
