from pyspark.sql import functions as F

from lotledger.operators import cards as CA


def page(spark, body, page_ord=0, dealer="https://d.com"):
    return spark.createDataFrame(
        [(page_ord, "r", dealer, dealer + "/inventory", page_ord, body)],
        "capture_id long, run_id string, dealer_url string, page_url string, page_ord int, body string",
    )


def test_dws_label_strip_removes_one_word_only(spark):
    body = ('<div class="row"><h3 class="dws-vehicle-listing-item-title"><a href="/inventory/Ford/F-150/S9/">2020 Ford</a></h3>'
            '<div class="dws-vehicle-field-stock-number">Stock Number 123</div></div>')
    card = CA.dws_cards(page(spark, body)).first()
    assert (card["stock_number"], card["make"], card["model"], card["vin"]) == ("Number 123", "Ford", "F 150", None)


def test_footer_does_not_leak_into_the_last_card(spark):
    body = '<div data-vin="1HGCM82633A004352" data-vehicle-title="2020 A B">x</div><footer>$5,000 77,000 miles</footer>'
    card = CA.dealersync_cards(page(spark, body)).first()
    assert (card["price"], card["mileage"], card["trim"]) == (None, None, None)


def test_text_between_cards_counts_to_the_card_before(spark):
    # the stated approximation: a segment runs to the next card
    body = '<div data-vin="1HGCM82633A004352">x</div><p>$5,000</p><div data-vin="1HGCM82633A004353">y</div>'
    assert [r["price"] for r in CA.dealersync_cards(page(spark, body)).orderBy("card_ord").collect()] == ["5,000", None]


def test_overfuel_falls_back_to_class_and_named_price(spark):
    body = '<div class="x make_kia" data-vin="1HGCM82633A004352"><p>Was $30,000</p><p>Sale Price $ 20,500</p><p>Stock #A1</p></div>'
    card = CA.overfuel_cards(page(spark, body)).first()
    assert (card["make"], card["price"], card["stock_number"]) == ("kia", "20,500", "A1")


def test_carsforsale_price_from_ld_at_the_same_index(spark):
    body = ('<a href="/details/used-2019-kia-rio/7">a</a><a href="/details/used-2019-kia-rio/7">2019 kia rio LX</a>'
            '<a href="/details/new-2020-ford-f-150/8">b</a>$9,999'
            '<script type="application/ld+json">[{"@type":"Car","offers":{"price":5}},{"@type":"Car","offers":{"price":6}}]</script>')
    rows = CA.carsforsale_cards(page(spark, body)).orderBy("card_ord").collect()
    assert [(r["listing_id"], r["price"], r["model"]) for r in rows] == [("7", "5", "rio"), ("8", "9,999", "f 150")]


def test_wide_path_refuses_silly_vins_and_fills_gaps(spark):
    body = ('<li>VIN AAAAAAA1111111AAA 2020 Ford Focus with words</li>'
            '<article data-vin="1HGCM82633A004352">2018 Honda Civic nice car</article>'
            '<article data-vin="1HGCM82633A004352">2018 Honda Civic $12,000</article>')
    rows = CA.wide_cards(page(spark, body)).collect()
    got = {(r["vin"], r["make"], r["price"]) for r in rows}
    assert got == {(None, "Ford", None), ("1HGCM82633A004352", "Honda", "12,000")}


def test_pagination_stops_after_the_first_page_without_news(spark):
    def listing(ord_, ids):
        cards = "".join(
            f'<div class="row"><h3 class="dws-vehicle-listing-item-title"><a href="/inventory/a/b/{i}/">2020</a></h3></div>' for i in ids)
        return page(spark, cards, ord_)
    pages = listing(0, [1, 2]).union(listing(1, [3])).union(listing(2, [3])).union(listing(3, [4]))
    cards = CA.dws_cards(pages)
    kept = CA.cut_pagination(cards, "dws", pages).select("page_ord").distinct().collect()
    assert sorted(r[0] for r in kept) == [0, 1, 2]


def test_an_empty_page_ends_pagination(spark):
    first = page(spark, '<div class="row"><h3 class="dws-vehicle-listing-item-title"><a href="/inventory/a/b/1/">2020</a></h3></div>', 0)
    later = page(spark, '<div class="row"><h3 class="dws-vehicle-listing-item-title"><a href="/inventory/a/b/2/">2020</a></h3></div>', 2)
    pages = first.union(page(spark, "<p>nothing</p>", 1)).union(later)
    kept = CA.cut_pagination(CA.dws_cards(pages), "dws", pages).select("stock_number").collect()
    assert [r[0] for r in kept] == ["1"]


def test_routing_falls_back_to_lower_case(spark):
    df = spark.createDataFrame([("DealerSync",), ("DWS",), ("Wix",), (None,)], "label string")
    assert [r[0] for r in df.select(CA.extractor_for(F.col("label"))).collect()] == ["dealersync", "dws", None, None]
