"""Golden values of the column functions."""

import pytest
from pyspark.sql import functions as F

from lotledger.functions import text as X
from lotledger.functions import urls as U
from lotledger.operators import classify as C
from lotledger.functions import markers as M
from lotledger import fixed_values as V


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text, expected", [
    ("12.5", 125), ("2020-2021", 2020), ("$12,500", 12500), ("--5", None), ("-5", -5),
    ("", None), ("n/a", None), ("99999999999", None),
])
def test_to_int(spark, text, expected):
    assert value(spark, X.to_int(F.lit(text))) == expected


@pytest.mark.parametrize("text, expected", [
    ("$12,500.00", 12500.0), ("1.2.3", 1.2), ("-.5", -0.5), ("5.", 5.0), ("Call", None),
])
def test_to_float(spark, text, expected):
    assert value(spark, X.to_float(F.lit(text))) == expected


@pytest.mark.parametrize("vin, expected", [
    ("1hgcm82633a004352", "1HGCM82633A004352"), ("abcdefghijkl", "ABCDEFGHIJKL"), ("abcdefghij", None),
])
def test_vin_rule(spark, vin, expected):
    assert value(spark, X.vin_rule(F.lit(vin))) == expected


@pytest.mark.parametrize("year, expected", [(0, 0), (1949, None), (1950, 1950), (2026, 2026), (2027, None)])
def test_year_rule(spark, year, expected):
    assert value(spark, X.year_rule(F.lit(year), 2024)) == expected


@pytest.mark.parametrize("text, expected", [
    ("Certified Used", "certified"), ("Pre-Owned", "used"), ("Nuevo", "new"), ("Demo", "Demo"),
])
def test_condition_rule(spark, text, expected):
    assert value(spark, X.condition_rule(F.lit(text))) == expected


@pytest.mark.parametrize("url, expected", [
    ("/a/b", "https://d.com/a/b"), ("v/../w?q=1", "https://d.com/w?q=1"),
    ("//cdn.com/x.png", "https://cdn.com/x.png"), ("https://E.com", "https://e.com/"),
    ("../../up", "https://d.com/up"), ("a b", "https://d.com/a%20b"), ("?p=2", "https://d.com/?p=2"),
    ("mailto:x@y.z", "mailto:x@y.z"), ("http://exa mple.com/", None),
])
def test_resolve(spark, url, expected):
    assert value(spark, U.resolve(F.lit(url), F.lit("https://d.com"))) == expected


@pytest.mark.parametrize("raw, expected", [
    ("http://https://www.A.com// ", "https://www.A.com"), ("me@x.com", None),
    ("https://facebook.com/me", None), ("localhost", None), (" a b.com ", "https://ab.com"),
])
def test_clean_url(spark, raw, expected):
    assert value(spark, U.clean_url(F.lit(raw))) == expected


def test_origin_keeps_foreign_ports_only(spark):
    assert value(spark, U.origin(F.lit("https://A.com:443/x"))) == "https://a.com"
    assert value(spark, U.origin(F.lit("http://a.com:8080/x"))) == "http://a.com:8080"


def test_signature_order_decides(spark):
    both = F.lower(F.lit("powered by CarsForSale.com, guarded by DataDome, on wp-content"))
    assert value(spark, M.first_label(both, V.HTML_SIGNATURES)) == "CarsForSale.com"


def test_signatures_stop_at_200000_characters(spark):
    page = spark.range(1).select(F.concat(F.repeat(F.lit("x"), 200_000), F.lit("dealersync")).alias("body"))
    assert C.with_page_platform(page, "p", limit=200_000).first()["p"] is None
    assert C.with_page_platform(page, "p").first()["p"] == "DealerSync"


def test_clean_html_keeps_links_only(spark):
    html = "<p>a  b</p><a href='/x'>y</a><script>1<2</script><svg>z</svg><!-- n -->"
    assert value(spark, C.clean_html(F.lit(html))) == "a b <a href='/x'>y</a>"


def test_host_labels_beyond_ascii(spark):
    from lotledger.functions import urls as U

    labels = ["bücher", "münchen-ost", "例え", "テスト", "ñandú", "a1ü", "üü", "правда", "faß", "他们为什么不说中文", "x\U0001f697y"]
    df = spark.createDataFrame([(x,) for x in labels], "x string")
    got = [r[0] for r in df.select(U.ascii_label(F.col("x"))).collect()]
    assert got == [x.encode("punycode").decode() for x in labels]
    urls = [("//Bücher.example/ä", "https://xn--bcher-kva.example/%C3%A4"), ("https://例え.テスト:8443/x?q=1", "https://xn--r8jz45g.xn--zckzah:8443/x?q=1"), ("/é", "https://xn--and-6ma2c.es/%C3%A9")]
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "i int, u string")
    got = {r["i"]: r["v"] for r in df.select("i", U.resolve(F.col("u"), F.lit("https://ñandú.es")).alias("v")).collect()}
    assert [got[i] for i in range(2)] == [v for _, v in urls[:2]]
    assert got[2] == "https://xn--" + "ñandú".encode("punycode").decode() + ".es/%C3%A9"
