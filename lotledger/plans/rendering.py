"""Captures rendered from the driver tables.

The driver tables hold no vehicles, so rows of ``part`` and ``lineitem`` are rendered
into the markup and JSON the operators read. Rendering is a Spark plan of its own; the
operators get nothing but the captures. ``{key} % n`` varies how a row is written
(missing VIN, price as text, alias names), never which rows take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import work_folder

PAGE_CARDS = 60  # cards per rendered listing page


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# the vehicle behind a part; {S} is the engine's string type
VEHICLE_SQL = """
  cast(p_partkey as bigint) as id,
  'https://d' || substr(p_brand,7) || '.example.com' as dealer_url,
  'FX1GB' || lpad(cast(p_partkey*2654435+314159265358 as {S}),12,'0') as vin,
  'S' || cast(p_partkey as {S}) as stock,
  'Brand' || chr(cast(64+cast(substr(p_brand,7) as int) as int)) as make,
  p_type as model,
  1990 + p_size % 35 as yr,
  cast((p_partkey*37) % 150000 + 1000 as int) as miles,
  cast(floor(p_retailprice)*10 as int) as price
"""


def vehicles(spark: SparkSession, sf: str) -> DataFrame:
    """One vehicle per part: ``id, dealer_url, vin, stock, make, model, yr, miles, price``."""
    exprs = VEHICLE_SQL.format(S="string")
    table(spark, sf, "part").createOrReplaceTempView("ll_part")
    return spark.sql(f"select {exprs}, row_number() over (partition by p_brand order by p_partkey) - 1 as rn from ll_part")


def _by_page(cards: DataFrame) -> DataFrame:
    """Vehicles dealt by page: the few bytes of a vehicle are moved, not its markup."""
    numbered = cards.withColumn("page_ord", F.floor(F.col("rn") / PAGE_CARDS).cast("int"))
    return numbered.repartition(4 * cards.sparkSession.sparkContext.defaultParallelism, "dealer_url", "page_ord")


def pages_of(cards: DataFrame, markup: str, tail: str = "") -> DataFrame:
    """Group card markup (SQL expression over the vehicle columns) into captures of
    ``PAGE_CARDS`` cards: the body of a page is bounded by that number."""
    body = _by_page(cards).withColumn("_m", F.expr(markup)).groupBy("dealer_url", "page_ord").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rn", "_m"))), lambda x: x["_m"]), "\n").alias("_b")
    )
    head = "<!DOCTYPE html><html><head><title>Inventory</title></head><body><main>"
    return body.select(
        F.xxhash64("dealer_url", "page_ord").alias("capture_id"), F.lit("run-1").alias("run_id"),
        "dealer_url", F.concat("dealer_url", F.lit("/inventory")).alias("page_url"), "page_ord",
        F.lit(200).alias("status"), F.lit("text/html").alias("content_type"),
        F.concat(F.lit(head), F.col("_b"), F.expr(f"'</main>{tail}<footer>Call 1 $999,999 since 1950 Old Shop 77 miles</footer></body></html>'")).alias("body"),
        F.lit(None).cast("string").alias("error"), F.lit(1).alias("attempt"),
        F.lit(None).cast("string").alias("cname"),
    )


PRICE_TEXT = "case when id % 11 = 0 then 'Call' else '$' || format_number(price, 0) end"
SHOWN_VIN = "case when id % 5 = 0 then null else vin end"

CARD_MARKUP = {
    "dealersync": f"""
      '<div class="ds-vehicle-list-item"' ||
      ' data-vin="' || coalesce({SHOWN_VIN}, '') || '" data-stock-no="' || stock || '" data-vehicle-title="' || yr || ' ' || make || ' ' || model || ' LX Sport" data-city="City ' || (id % 7) || '">' ||
      '<a href="/detail/' || id || '">View</a><img src="/i/' || id || '.jpg"><span>' || {PRICE_TEXT} || '</span> <b>' ||
      case when id % 13 = 0 then '' else format_number(miles, 0) || ' 25 MPG' end || '</b></div>'""",
    "dws": f"""
      '<div class="row"><h3 class="dws-vehicle-listing-item-title"><a href="/inventory/' || make || '/' || model || '/' || stock || '/">' || yr || ' ' || make || '</a></h3>' ||
      '<div class="dws-vehicle-field-vin">VIN ' || vin || '</div><div class="dws-vehicle-field-stock-number">Stock ' || stock || '</div>' ||
      case when id % 13 = 0 then '' else '<div class="dws-vehicle-field-mileage"><span>Mileage</span> ' || format_number(miles, 0) || '</div>' end ||
      '<div class="dws-vehicle-field-door">Doors ' || (2 + id % 3) || '</div><span>' || {PRICE_TEXT} || '</span></div>' ||
      '<div class="row grid"><h3 class="dws-vehicle-listing-item-title"><a href="/inventory/' || make || '/' || model || '/' || stock || '/">' || yr || ' ' || make || '</a></h3>' ||
      '<div class="dws-vehicle-field-engine">Engine V' || (4 + id % 5) || '</div></div>'""",
    "dealr": f"""
      '<div class="col dealr-inventory-vehicle"><a href="inventory/' || yr || '-' || make || '-' || model || '-LX-Sport/' || id || '">See</a>' ||
      case when id % 5 = 0 then '' else '<i data-cg-vin="' || vin || '"></i>' end ||
      '<p>' || {PRICE_TEXT} || '</p><p>Mileage ' || format_number(miles, 0) || '</p><p>Stock ' || stock || '</p><p>Drivetrain AWD</p><p>Exterior Deep Red</p><p>Interior Sand</p><p>Engine 2.0L Turbo</p><p>MPG 30</p></div>'""",
    "overfuel": f"""
      '<div class="srp-cardcontainer make_' || lower(make) || '" data-vin="' || vin || '"><a href="/inventory/' || yr || '-' || make || '-' || model || '-LX-' || vin || '">go</a>' ||
      '<span>Stock # ' || stock || '</span> <span>' || format_number(miles, 0) || ' miles</span> <span>MSRP $99,999</span> <span>' ||
      case when id % 11 = 0 then 'Call' else 'No-haggle price $' || format_number(price, 0) end || '</span></div>'""",
    "carsforsale": f"""
      '<div class="vehicle-snapshot"><a href="/details/used-' || yr || '-' || lower(make) || '-' || lower(model) || '/' || id || '"><img src="/c/' || id || '.jpg"></a>' ||
      '<h3><a href="/details/used-' || yr || '-' || lower(make) || '-' || lower(model) || '/' || id || '">' || yr || ' ' || make || ' ' || model || ' Limited</a></h3>' ||
      '<p>Price ' || {PRICE_TEXT} || '</p><p>' || case when id % 13 = 0 then '' else format_number(miles, 0) || ' mi' end || '</p><p>Transmission Automatic Drivetrain FWD</p>' ||
      '<script type="application/ld+json">{{"@type":"Vehicle","offers":{{"price":' || (price + 1) || '}}}}</script></div>'""",
    "generic": f"""
      '<article><a href="/car/' || id || '"><img data-src="/g/' || id || '.jpg"></a><h2>' || yr || ' ' || make || ' ' || model || '</h2><p>' ||
      {PRICE_TEXT} || ' - ' || format_number(miles, 0) || ' miles</p>' || case when id % 5 = 0 then '' else '<p>VIN ' || vin || '</p>' end || '</article>'""",
    # a card in a wrapper of the same class, longer than a thousand characters of markup
    "nested": f"""
      '<div class="vehicle-wrap"><p>Sponsored 1999 Wrong Car for $1,111</p><div class="vehicle-inner"><a href="/car/' || id || '"><img data-src="/n/' || id || '.jpg"></a><h2>' || yr || ' ' || make || ' ' || model || '</h2><p>' ||
      {PRICE_TEXT} || ' - ' || format_number(miles, 0) || ' miles</p>' || repeat('<p class="note">&nbsp;note</p>', 100) || case when id % 5 = 0 then '' else '<p>VIN ' || vin || '</p>' end || '</div></div>'""",
    # the VIN stands in an attribute long before its card, and at the far end of it
    "attribute": f"""
      '<p><img alt="' || vin || '"></p>' || repeat('<br>', 600) || '<section><h2>' || yr || ' ' || make || ' ' || model || ' </h2><a href="/car/' || id || '">more</a>' ||
      repeat('<i>note</i> ', 150) || '<div><div><b>VIN: ' || vin || '</b></div></div></section>'""",
    "anchored": f"""
      '<section><a href="/car/' || id || '">more</a><p>' || yr || ' ' || make || ' ' || model || '</p><p>VIN: ' || vin || '</p></section>' || repeat('<br>', 300)""",
}


def stored(captures: DataFrame) -> DataFrame:
    """Captures as a written table, which is what the operators meet in real use."""
    path = work_folder(captures.sparkSession, "captures")
    # Pages are wide: a row group is held by its writer and, decoded, by its reader.
    captures.write.option("parquet.block.size", 16 << 20).parquet(path)
    return captures.sparkSession.read.parquet(path)


def listing_pages(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Rendered listing pages of one kind of markup."""
    return pages_of(vehicles(spark, sf), CARD_MARKUP[kind])


def detail_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Detail page of every listing; every fifth one shows no details."""
    v = vehicles(spark, sf)
    url = "dealer_url || '/details/used-' || yr || '-' || lower(make) || '-' || lower(model) || '/' || id"
    return v.select(
        F.col("id").alias("capture_id"), "dealer_url", F.expr(url).alias("page_url"),
        F.expr("'<html><body><h1>' || make || '</h1>' || case when id % 5 = 0 then '<p>Sold</p>' else '<p>VIN: ' || lower(vin) || '</p><p>Stock #: ' || stock || '</p><p>77,777 miles</p>' end || '</body></html>'").alias("body"),
    )


LD_ITEM = """to_json(named_struct('@type', case when id % 3 = 0 then array('Product','Car') else array('Vehicle') end,
  'vehicleIdentificationNumber', vin, 'sku', stock, 'brand', named_struct('@type','Brand','name', make), 'model', model,
  'vehicleModelDate', cast(yr as string), 'mileageFromOdometer', named_struct('value', miles), 'offers', named_struct('price', price, 'itemCondition', 'UsedCondition'), 'image', array('/x.jpg')))"""

ALIAS_ITEM = """case id % 4
  when 0 then to_json(named_struct('VIN', vin, 'StockNumber', stock, 'make', make, 'model', model, 'year', yr, 'odometer', miles, 'price', price))
  when 1 then to_json(named_struct('vehicle', named_struct('vin', vin, 'brand', make, 'modelo', model, 'model-year', yr), 'stock', stock, 'mileage', named_struct('value', miles), 'sellingPrice', '$' || format_number(price,0)))
  when 2 then to_json(named_struct('vehicleIdentificationNumber', vin, 'sku', stock, 'manufacturer', make, 'model', array(model, 'x'), 'anio', cast(yr as string), 'km', format_number(miles,0), 'pricing', named_struct('listPrice', price)))
  else to_json(named_struct('vin_number', vin, 'stockNo', stock, 'marca', make, 'model', model, 'vehicleYear', yr, 'kilometraje', miles, 'precio', cast(price as string) || '.00')) end"""

# a record with at least three key words in its keys, for array discovery
PLAIN_ITEM = "to_json(named_struct('vin', vin, 'stockNumber', stock, 'make', make, 'model', model, 'year', yr, 'mileage', miles, 'price', price))"


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of few bytes but much work, dealt to all cores by ``id``.

    Numbering the vehicles leaves them in as many parts as there are brands, of uneven size;
    and an operator that reads a column several times would render it as often.
    """
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, "id")


def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    """One raw JSON record per part, written with four sets of key names."""
    return dealt(vehicles(spark, sf).select(
        "id", "dealer_url", F.col("dealer_url").alias("origin"), F.lit("run-1").alias("run_id"),
        F.col("rn").alias("ord"), F.expr(ALIAS_ITEM).alias("raw"),
    ))


def _document_pages(spark: SparkSession, sf: str, item: str, before: str, after: str, content: str) -> DataFrame:
    grouped = _by_page(vehicles(spark, sf)).withColumn("_m", F.expr(item)).groupBy("dealer_url", "page_ord").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rn", "_m"))), lambda x: x["_m"]), ",").alias("items")
    )
    return grouped.select(
        F.xxhash64("dealer_url", "page_ord").alias("capture_id"), F.lit("run-1").alias("run_id"), "dealer_url",
        F.concat("dealer_url", F.lit("/api/inventory")).alias("page_url"), "page_ord", F.lit(200).alias("status"),
        F.lit(content).alias("content_type"), F.expr(f"{before} || items || {after}").alias("body"),
        F.lit(None).cast("string").alias("error"), F.lit(1).alias("attempt"), F.lit(None).cast("string").alias("cname"),
    )


def ld_pages(spark: SparkSession, sf: str) -> DataFrame:
    """JSON-LD in every page, as an item list inside a graph."""
    return _document_pages(
        spark, sf, "'{\"@type\":\"ListItem\",\"item\":' || " + LD_ITEM + " || '}'",
        """'<html><head><script type="application/ld+json">{"@context":"x","@graph":[{"@type":"WebSite"},{"@type":"ItemList","itemListElement":['""",
        """']}]}</script></head><body>' || repeat('x', 2000) || '</body></html>'""", "text/html",
    )


def state_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A state script on even pages, a plain inline script on odd ones."""
    return _document_pages(
        spark, sf, PLAIN_ITEM,
        """'<html><script src="a.js"></script><script>var cfg = {"a": 1};</script><script>' || case when page_ord % 2 = 0 then 'window.__INITIAL_STATE__ = {"ui":{"t":"}"},"inv":{"list":[' else 'render(); rows = [' end""",
        """case when page_ord % 2 = 0 then ']}};' else '];' end || '</script></html>'""", "text/html",
    )


def json_pages(spark: SparkSession, sf: str, item: str = PLAIN_ITEM) -> DataFrame:
    """JSON responses with the records two levels down."""
    return _document_pages(
        spark, sf, item, """'{"meta":{"count":1},"data":{"pages":[{"id":7},{"vehicles":['""",
        """']}]},"z":[{"a":1}]}'""", "application/json; charset=utf-8",
    )


def cars_commerce_pages(spark: SparkSession, sf: str) -> DataFrame:
    item = """to_json(named_struct('vin', vin, 'stock', stock, 'year', yr, 'make', make, 'model', model, 'mileage', miles, 'type', 'Used',
      'pricing', named_struct('our_price', case when id % 3 = 0 then 0 else price end, 'price', case when id % 2 = 0 then -1 else price + 5 end, 'msrp', price + 9),
      'body_details', named_struct('type','SUV','number_of_doors', 4), 'mechanical', named_struct('drivetrain','AWD')))"""
    pages = _document_pages(
        spark, sf, item, """'{"data":{"total_vehicle_count":100,"listings":['""", "']}}'", "application/json"
    )
    return pages.withColumn("page_url", F.lit("https://x.carscommerce.inc/api/v1/listings/12/search"))


def dealercom_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Every page shows its records twice: the second copy must lose."""
    item = PLAIN_ITEM + " || ',' || to_json(named_struct('vin', vin, 'make', 'Copy', 'model', model, 'price', 1))"
    pages = json_pages(spark, sf, item)
    return pages.withColumn("page_url", F.concat("dealer_url", F.lit("/api/widget/ws-inv-data/getInventory")))
