"""Cards by containment, held against hand-made pages."""

from lotledger.operators import cards as CA
from lotledger.operators import elements as E

VIN, OTHER = "1HGCM82633A004352", "1HGCM82633A004353"


def page(spark, body, dealer="https://d.com"):
    return spark.createDataFrame(
        [(1, "r", dealer, dealer + "/inventory", 0, body)],
        "capture_id long, run_id string, dealer_url string, page_url string, page_ord int, body string",
    )


def test_ranges_of_elements():
    p = E.Page("<html><body><ul><li>a<li>b<ul><li>c</ul></ul><p>d<div>e</p></div><br>f</body>")
    at = {t: i for i, t in enumerate(p.tag)}
    assert p.tag == ["html", "body", "ul", "li", "li", "ul", "li", "p", "div", "br"]
    assert [p.parent[i] for i in range(10)] == [-1, 0, 1, 2, 2, 4, 5, 1, 1, 1]
    assert p.text(at["body"]) == "a b c d e f" and p.text(3) == "a" and p.text(4) == "b c" and p.text(7) == "d"
    assert p.end[2] == 7 and p.end[0] == 10


def test_markup_that_is_not_well_formed():
    for body in ("", "<", "<p", '<p class="x', "</div></p>text", "<!-- open", "<script>var a = '<div>'", "a<b>c"):
        p = E.Page(body)
        assert len(p.tag) == len(p.end) == len(p.parent)
    assert E.Page("<!-- <b>x</b> -->y").tag == []
    assert E.Page("<script>'<b>'</script><i>z</i>").tag == ["script", "i"]
    assert E.Page('<a title="x > y" href=/q>t</a>').attributes == [{"title": "x > y", "href": "/q"}]
    assert E.Page("<td>1<td>2<tr><td>3").text(1) == "2"
    assert E.Page("a &amp; b&nbsp;c").texts == ["a & b\xa0c"]


def test_deep_markup_is_read_in_one_pass():
    p = E.Page("<div>" * 5000 + "x" + "</div>" * 5000)
    assert p.end[0] == 5000 and p.text(4999) == "x"


def test_a_wrapper_of_cards_is_no_card(spark):
    body = ('<div class="vehicle-list"><p>1999 Wrong Car $1,111 and more</p>'
            f'<div class="vehicle-a" data-vin="{VIN}"><b>2019 Ford Focus</b> with a text long enough</div>'
            f'<div class="vehicle-b" data-vin="{OTHER}"><b>2020 Kia Rio</b> with a text long enough</div></div>')
    rows = CA.generic_cards(page(spark, body)).orderBy("card_ord").collect()
    assert [(r["vin"], r["make"], r["price"]) for r in rows] == [(VIN, "Ford", None), (OTHER, "Kia", None)]


def test_length_of_card_text_is_a_rule_that_can_be_lifted(spark):
    long = f'<article data-vin="{VIN}">2019 Ford Focus {"word " * 1000}</article>'
    assert CA.generic_cards(page(spark, long)).count() == 0
    assert CA.generic_cards(page(spark, long), chars=None).first()["make"] == "Ford"
    assert CA.generic_cards(page(spark, "<article>2019 Ford Focus</article>")).count() == 0
    five = "".join(f"<article>20{i:02} Ford Focus number {i} here</article>" for i in range(10, 15))
    assert [r["year"] for r in CA.generic_cards(page(spark, five), most=2).collect()] == ["2010", "2011"]


def test_vin_in_an_attribute_far_before_its_card(spark):
    body = (f'<body><img alt="{VIN}">' + "<br>" * 1000 + "<section><h2>2020 Ford Ranger</h2> <a href='/car/1'>x</a>"
            + "<i>note</i> " * 400 + f"<div><p>VIN: {VIN}</p></div></section></body>")
    row = CA.wide_cards(page(spark, body)).first()
    assert (row["vin"], row["year"], row["make"], row["url"]) == (VIN, "2020", "Ford", "https://d.com/car/1")


def test_six_steps_up_and_no_further(spark):
    def around(steps):
        return "<body><main><h2>2020 Ford Ranger </h2>" + "<div>" * steps + VIN + "</div>" * steps + "</main></body>"
    assert CA.wide_cards(page(spark, around(6))).first()["make"] == "Ford"
    assert CA.wide_cards(page(spark, around(7))).first()["make"] is None


def test_cards_come_before_loose_vins_and_fill_each_other(spark):
    body = (f'<body><li>{VIN} 2018 Honda Civic <b>nice</b></li><li>{VIN} 2018 Honda Civic for $12,000</li>'
            f'<p>again {VIN}</p><p>{OTHER} sits alone</p><script>x = "2HGCM82633A004354"</script></body>')
    rows = CA.wide_cards(page(spark, body)).orderBy("card_ord").collect()
    assert [(r["vin"], r["price"]) for r in rows] == [(VIN, "12,000"), (OTHER, "12,000"), ("2HGCM82633A004354", "12,000")]


def test_cards_need_no_shuffle(spark):
    body = f'<article data-vin="{VIN}">2019 Ford Focus with words</article>'
    for cards in (CA.generic_cards, CA.wide_cards):
        plan = cards(page(spark, body).repartition(2))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("ArrowEvalPython") == 1
