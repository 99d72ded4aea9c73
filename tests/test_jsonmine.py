import json

from pyspark.sql import functions as F

from lotledger.operators import jsonmine as JM
from lotledger.operators.blobs import json_literals

CAR = {"vin": "1", "make": "A", "price": 1}


def arrays(spark, doc):
    text = doc if isinstance(doc, str) else json.dumps(doc)
    df = spark.createDataFrame([(text,)], "t string")
    return [tuple(h["path"]) for h in df.select(JM.vehicle_arrays(F.col("t")).alias("h")).first()["h"]]


# A document and the places of its vehicle arrays, members counted from 0 at each level.
DOCUMENTS = [
    ([CAR, CAR], [()]),
    ({"z": [CAR], "a": [CAR, {"x": 1}]}, [(0,), (1,)]),
    ([dict(CAR, options=[{"Make": 1, "model_name": 2, "Trim": 3}])], [(), (0, 3)]),
    ([{"x": 1}, CAR], []),
    ([CAR, 5], []),
    ([CAR, None], []),
    ({"s": json.dumps([CAR])}, []),
    ({"a": {"b": {"c": {"d": {"e": {"f": {"g": {"h": [CAR]}}}}}}}}, [(0, 0, 0, 0, 0, 0, 0, 0)]),
    ({"a": {"b": {"c": {"d": {"e": {"f": {"g": {"h": {"i": [CAR]}}}}}}}}}, []),
    ([[CAR], [CAR]], [(0,), (1,)]),
    ({}, []),
]


def test_vehicle_arrays(spark):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, (d, _) in enumerate(DOCUMENTS)], "i int, t string")
    rows = df.select("i", JM.vehicle_arrays(F.col("t")).alias("h")).collect()
    got = {r["i"]: [tuple(h["path"]) for h in r["h"]] for r in rows}
    assert [got[i] for i in range(len(DOCUMENTS))] == [want for _, want in DOCUMENTS]


def test_unparsable_document_yields_nothing(spark):
    assert arrays(spark, '{"vin": "make" price') == []


def ld(spark, *docs):
    df = spark.createDataFrame([([json.dumps(d) for d in docs],)], "t array<string>")
    return [json.loads(r) for r in df.select(JM.ld_records(F.col("t")).alias("r")).first()["r"]]


def test_ld_types_and_nesting(spark):
    docs = [
        {"@type": "ItemList", "itemListElement": [
            {"item": {"@type": ["Product", "Car"], "vin": "L1"}}, {"@type": "Vehicle", "vin": "L2"}]},
        {"@graph": [{"@type": "Product", "mpn": "L3"}, {"@type": "Product", "name": "no vin"}]},
        [{"@type": "Motorcycle", "vin": "L4"}, {"@type": "Organization"}],
    ]
    assert [r["vin"] for r in ld(spark, *docs)] == ["L1", "L2", "L3", "L4"]


def test_ld_fallbacks(spark):
    item = {"@type": "Car", "vehicleIdentificationNumber": "", "vin": "V", "brand": {"name": ""},
            "manufacturer": {"name": "M"}, "model": {"name": "X"}, "offers": [{"price": 5.0}, {"price": 6}],
            "image": ["a", "b"], "mileageFromOdometer": {"value": 7}, "itemCondition": "", "url": 0}
    got = ld(spark, item)[0]
    assert (got["vin"], got["make"], got["model"], got["price"], got["image"], got["mileage"]) == ("V", "M", "X", 5, "a", 7)


def test_literals_balance_brackets_and_strings():
    blob = json.dumps({"t": '}]"', "rows": [dict(CAR, note="x" * 200)]})
    assert json_literals(f"var a = {blob}; b = [1,2];") == [blob, "[1,2]"]
    assert json_literals("  " + blob + "\n") == [blob]
    assert json_literals("a = {broken " + "x" * 300) == []
    assert json_literals(";".join(f"v{i} = {blob}" for i in range(9))) == [blob] * 9
    assert json_literals(";".join(f"v{i} = {blob}" for i in range(9)), most=5) == [blob] * 5
    assert json_literals('a = {"b": 1, "c": "x = [1]"}') == ['{"b": 1, "c": "x = [1]"}']


def test_ld_is_followed_as_deep_as_it_goes(spark):
    item = dict(CAR) | {"@type": "Car", "vin": "deep"}
    for _ in range(12):
        item = {"@type": "ItemList", "itemListElement": [{"item": item}]}
    assert [r["vin"] for r in ld(spark, item)] == ["deep"]


def test_distinct_dealercom_records_with_a_common_beginning_stay_apart(spark):
    rows = [dict(CAR, vin="", uuid="", note="x" * 100, n=i) for i in (1, 2, 2)]
    body = json.dumps({"pageInfo": {"trackingData": [{"note": "x" * 100, **r} for r in rows]}})
    df = spark.createDataFrame(
        [("r", "https://d.com", "https://d.com/getInventory", 0, body)],
        "run_id string, dealer_url string, page_url string, page_ord int, body string")
    assert JM.dealercom_records(df).count() == 2


def test_ld_blocks_scripts_even_if_its_records_are_useless(spark):
    page = ('<script type="application/ld+json">{"@type":"Car"}</script>'
            f"<script>var inventory = {json.dumps([dict(CAR, n='x' * 200)])};</script>")
    df = spark.createDataFrame([(1, page)], "capture_id int, body string")
    rows = JM.embedded_records(df, ["capture_id"]).collect()
    assert [r["source"] for r in rows] == ["JSON-LD"]


def test_first_state_script_that_yields_wins(spark):
    blob = json.dumps([dict(CAR, n="x" * 200)])
    page = (f"<script>q = {blob}</script><script>window.__NUXT__ = {{}}</script>"
            f"<script>window.__INITIAL_STATE__ = {json.dumps([dict(CAR, vin='state', n='x' * 200)])}</script>")
    df = spark.createDataFrame([(1, page)], "capture_id int, body string")
    rows = JM.embedded_records(df, ["capture_id"]).collect()
    assert [json.loads(r["raw"])["vin"] for r in rows] == ["state"]


def test_model_answers(spark):
    rows = [("https://a.com", '```json\n[{"vin":"1"},{"vin":"2"}]\n```'), ("https://b.com", '{"vin":"3"}'), ("https://c.com", "none")]
    out = JM.answer_records(spark.createDataFrame(rows, "dealer_url string, text string")).collect()
    assert sorted((r["dealer_url"], r["ord"], json.loads(r["raw"])["vin"]) for r in out) == [
        ("https://a.com", 0, "1"), ("https://a.com", 1, "2"), ("https://b.com", 0, "3")]


def test_a_broken_script_is_read_once():
    import time

    start = time.perf_counter()
    assert json_literals("a = {" * 20_000) == []
    assert json_literals('a = "' + "b = {" * 20_000) == []
    assert time.perf_counter() - start < 2
    assert json_literals('x = "a = {"; y = {"b": 1}; z = {"c": [2]} }') == ['{"b": 1}', '{"c": [2]}']
    assert json_literals("it's = [1]; \"q = [2]") == ["[1]", "[2]"]
