"""Seeds, links and page classification over the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as V
from ..functions import urls as U
from ..operators import classify as C
from ..operators import frontier as FR
from ..operators import keyed as K
from ..session import work_folder
from ..sources import captures as SC
from ..sources import seeds as SS
from ..sources import sinks as SK
from .registry import query
from .rendering import table

# --- seed lines: one per customer, the same expression in both engines ----------------
_N = "cast(c_custkey as {S})"
SEED_LINE = """case c_custkey % 10
  when 0 then '# dealer ' || {N}
  when 1 then 'https://d' || cast(c_custkey % 700 as {S}) || '.example.com,DealerSync'
  when 2 then '  http://www.D' || {N} || '.example.com/x , Wix '
  when 3 then 'ftp://d' || {N} || '.example.com'
  when 4 then 'mail' || {N} || '@example.com'
  when 5 then 'http://http://www.d' || cast(c_custkey % 300 as {S}) || '.example.com//'
  when 6 then 'https://facebook.com/d' || {N}
  when 7 then 'd' || cast(c_custkey % 300 as {S}) || '.example.com'
  when 8 then 'https://www.d' || cast(c_custkey % 300 as {S}) || '.example.com:8080/a?b=1'
  else 'https://d' || cast(c_custkey % 90 as {S}) || '.example.com,' end"""


def _seed_sql(string: str) -> str:
    return SEED_LINE.replace("{N}", _N).replace("{S}", string)


def seed_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("ord"), F.expr(_seed_sql("string")).alias("line")
    )


LINES = f"with lines as (select c_custkey as ord, {_seed_sql('varchar')} as line from customer)"
SEEDS = LINES + """, seeds as (select ord, trim(split_part(trim(line),',',1)) as url,
  nullif(trim(split_part(trim(line),',',2)),'') as platform
  from lines where trim(line) <> '' and trim(line) not like '#%')"""
CLEANED = LINES + """, stripped as (select ord, regexp_replace(regexp_replace(regexp_replace(trim(line),'^https?://','','i'),'^https?://','','i'),'\\s+','','g') as u from lines),
 cleaned as (select ord, 'https://' || regexp_replace(u,'/+$','') as url from stripped
   where u <> '' and u not like '%@%' and lower(u) not like '%facebook.com%' and u like '%.%')"""


@query("s1_read_seed_text", SEEDS + " select ord, url, platform from seeds")
def s1(spark, sf):
    path = work_folder(spark, "seeds")
    lines = seed_lines(spark, sf)
    # through a text file and back; the place of a line is its order column
    lines.select(F.concat_ws("\t", F.col("ord").cast("string"), "line").alias("value")).write.text(path)
    back = SS.read_lines(spark, path).select(
        F.substring_index("line", "\t", 1).cast("bigint").alias("ord"),
        F.expr("substring(line, instr(line, '\t') + 1)").alias("line"),
    )
    return SS.seeds_from_lines(back)


@query("s2_inline_seeds", SEEDS + """ select ord, url, platform from seeds""")
def s2(spark, sf):
    lines = seed_lines(spark, sf).filter((F.trim("line") != "") & ~F.trim("line").startswith("#"))
    item = F.when(
        F.col("ord") % 2 == 0,
        F.to_json(F.struct(
            F.trim(F.split(F.trim("line"), ",")[0]).alias("url"),
            F.trim(F.get(F.split(F.trim("line"), ","), 1)).alias("platform"),
        )),
    ).otherwise(F.concat(F.lit('"'), F.trim("line"), F.lit('"')))
    return SS.seeds_from_json(lines.select("ord", item.alias("item")))


@query("s3_platform_map_source", SEEDS + """ select url, platform from seeds where ord > (select min(ord) from seeds)""")
def s3(spark, sf):
    seeds = SS.seeds_from_lines(seed_lines(spark, sf))
    lines = seeds.select("ord", F.concat_ws(",", "url", F.coalesce("platform", F.lit("")), F.lit("html"), F.lit("")).alias("line"))
    return SS.platform_map_from_lines(lines).select("url", "platform")


@query("s3_platform_map_if_named", SEEDS + """ select kind, url, platform from seeds, (select unnest(['named', 'bare']) as kind)""")
def s3b(spark, sf):
    """A first line is a header only where it says so."""
    seeds = SS.seeds_from_lines(seed_lines(spark, sf))
    lines = seeds.select("ord", F.concat_ws(",", "url", F.coalesce("platform", F.lit("")), F.lit("html"), F.lit("")).alias("line"))
    header = spark.createDataFrame([(-1, "URL,Platform,via,cname")], "ord int, line string")
    header = header.select(F.col("ord").cast(lines.schema["ord"].dataType), "line")
    named = SS.platform_map_from_lines(header.unionByName(lines), "if_named").withColumn("kind", F.lit("named"))
    bare = SS.platform_map_from_lines(lines, "if_named").withColumn("kind", F.lit("bare"))
    return named.unionByName(bare).select("kind", "url", "platform")


@query("s4_captured_html", "select page_id as capture_id, length(html) as n_chars from pages where page_id % 7 <> 0")
def s4(spark, sf):
    caps = SC.captures_from_pages(table(spark, sf, "pages")).withColumn(
        "status", F.when(F.col("capture_id") % 7 == 0, 404).otherwise(200)
    )
    path = work_folder(spark, "captures")
    caps.write.parquet(path)
    return SC.html_pages(SC.read_captures(spark, path)).select(
        "capture_id", F.length("body").cast("bigint").alias("n_chars")
    )


@query("s5_captured_json", """select event_id as capture_id, length(props) + 100 as n_chars from events
  where event_type <> 'error' and event_type <> 'signup'""")
def s5(spark, sf):
    body = F.concat("props", F.when(F.col("event_type") == "error", "}").otherwise(""), F.lit(" " * 100))
    caps = table(spark, sf, "events").select(
        F.col("event_id").alias("capture_id"),
        F.when(F.col("event_type") == "signup", "https://x/a.png").otherwise("https://x/a").alias("page_url"),
        F.lit(200).alias("status"), F.lit("application/json").alias("content_type"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("{"), body)).otherwise(body).alias("body"),
    )
    return SC.json_responses(caps).select("capture_id", F.length("body").cast("bigint").alias("n_chars"))


@query("u1_valid_seeds", SEEDS + " select ord, url from seeds where regexp_matches(url,'^https?://[^/@\\s]+','i')")
def u1(spark, sf):
    return FR.valid_seeds(SS.seeds_from_lines(seed_lines(spark, sf))).select("ord", "url")


@query("u2_unique_seeds", SEEDS + """ select url, platform from (select *, row_number() over (partition by url order by ord) r from seeds) where r = 1""")
def u2(spark, sf):
    return FR.unique_seeds(SS.seeds_from_lines(seed_lines(spark, sf))).select("url", "platform")


@query("u3_clean_url", CLEANED + " select ord, url from cleaned")
def u3(spark, sf):
    return seed_lines(spark, sf).select("ord", U.clean_url(F.col("line")).alias("url")).filter("url is not null")


@query("u4_discard_stats", CLEANED + """ select count(*) as entries, (select count(distinct url) from cleaned) as unique_valid,
  count(*) - (select count(distinct url) from cleaned) as discarded from lines where trim(line) <> ''""")
def u4(spark, sf):
    return FR.discard_stats(seed_lines(spark, sf))


@query("u5_domain_origin", """select page_id, regexp_replace(lower(regexp_extract(url,'^https?://([^/:?#]+)',1)),'^www\\.','') as domain,
  regexp_extract(url,'^(https?)://',1) || '://' || lower(regexp_extract(url,'^https?://([^/:?#]+)',1)) as origin from pages""")
def u5(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", U.domain(F.col("url")).alias("domain"), U.origin(F.col("url")).alias("origin")
    )


_SQL_PATHS = ",".join(f"'{p}'" for p in V.INVENTORY_PATHS)


@query("u6_candidate_pages", f"""with o as (select page_id, url, regexp_extract(url,'^(https?://[^/?#]+)',1) as origin from pages),
  g as (select page_id, url, origin, unnest([{_SQL_PATHS}]) as p, unnest(range(1,{len(V.INVENTORY_PATHS) + 1})) as i from o)
  select page_id, cast(0 as int) as page_ord, url as page_url from o union all
  select page_id, cast(i as int), origin || p from g""")
def u6(spark, sf):
    return FR.candidate_pages(table(spark, sf, "pages").select("page_id", "url")).select(
        "page_id", "page_ord", "page_url"
    )


# --- pages with links and markers ------------------------------------------------------
LINK_MARKUP = """case page_id % 6
  when 0 then '<a href="/used-cars/all">Our cars</a><a href="/inventory">Inventory</a><a href="https://other.com/inventory">x</a>'
  when 1 then '<a href="/specials">View Inventory now</a><script>fetch("/api/vehicles/list?x=1"); var a=''/feed/inventory.css'', b="/feed/inventory?y=2"</script>'
  when 2 then '<a href=''/x''>Pre-Owned</a><a class="b" href="/vehicles"><b>All vehicles</b></a>'
  when 3 then '<p>wp-content "/a/inventario/b" "/a/inventario/b" "/a/vehiculos"</p><a href="srp/list">cars for sale</a>'
  when 4 then '<a href="/about">Contact</a><img src="https://cdn.vendor' || cast(page_id % 3 as {S}) || '.com/x.png"><link href="https://fonts.googleapis.com/css">'
  else '<meta name="generator" content="WordPress 6.1"><a href="https://www.shop' || cast(page_id % 4 as {S}) || '.example.co/used">Used</a> dealer inspire' end"""


def link_pages(spark: SparkSession, sf: str) -> DataFrame:
    body = F.concat("html", F.expr(LINK_MARKUP.replace("{S}", "string")))
    return SC.captures_from_pages(table(spark, sf, "pages")).drop("body").join(
        table(spark, sf, "pages").select(F.col("page_id").alias("capture_id"), body.alias("body"), F.col("page_id")),
        "capture_id",
    ).withColumn("dealer_url", F.expr("'https://h' || page_id || '.example.com/home'")).withColumn("page_url", F.col("dealer_url"))


LINKED = f"""with linked as (select page_id, 'https://h' || cast(page_id as varchar) || '.example.com' as origin,
  html || {LINK_MARKUP.replace('{S}', 'varchar')} as body from pages)"""
# every rendered anchor, and the plain ones of the page: href="/word">word
ANCHORS = LINKED + """, raw as (select page_id, origin, regexp_extract_all(body,'(?is)<a\\b[^>]*>.*?</a\\s*>') as tags from linked),
 tags as (select page_id, origin, unnest(tags) as tag, unnest(range(0, len(tags))) as pos from raw),
 parts as (select page_id, origin, pos, regexp_extract(tag,'(?i)href=["'']([^"'']*)["'']',1) as h,
   trim(regexp_replace(regexp_replace(regexp_replace(tag,'^<a[^>]*>',''),'<[^>]*>','','g'),'\\s+',' ','g')) as text from tags),
 links as (select page_id, origin, pos, text, case when h like 'http%' then regexp_replace(h,'^(https?://[^/]*)$','\\1/') when h like '/%' then origin || h else origin || '/' || h end as href from parts)"""
_SCORE = " + ".join(
    f"(case when contains(lower(text),'{w}') then 2 else 0 end) + (case when contains(lower(href),'{w.replace(' ', '-')}') then 1 else 0 end)"
    for w in V.LINK_WORDS
)


@query("u7_candidate_endpoints", LINKED + f""", b as (select page_id, origin, body, lower(body) as low from linked),
 named as (select *, case when contains(low,'dealer.com') or contains(low,'ddc-') then 'dealer.com' when contains(low,'dealeron') then 'dealeron'
   when contains(low,'dealerinspire') or contains(low,'dealer inspire') then 'dealerinspire' when contains(low,'dealersocket') then 'dealersocket'
   when contains(low,'carsforsale.com') then 'carsforsale' when contains(low,'wp-content') or contains(low,'wp-json') then 'wordpress' end as builder from b),
 own as (select *, case builder when 'dealer.com' then ['{V.BUILDER_API_PATHS['dealer.com'][0]}'] when 'wordpress' then ['{V.BUILDER_API_PATHS['wordpress'][0]}','{V.BUILDER_API_PATHS['wordpress'][1]}']
   when 'dealerinspire' then ['{V.BUILDER_API_PATHS['dealerinspire'][0]}'] else [] end as own,
   list_filter(regexp_extract_all(body, '(?i)["''](/[a-z0-9_\\-/.]*(?:inventory|vehicles|inventario|vehiculos)[a-z0-9_\\-/.?=&]*)["'']', 1), lambda p: not regexp_matches(p,'\\.(css|js|png|jpe?g|svg|webp|gif)(\\?|$)')) as q from named),
 every as (select page_id, origin, list_concat(own, list_concat(q, [{",".join(f"'{p}'" for p in V.API_PATHS)}])) as ps from own),
 un as (select page_id, origin, unnest(ps) as p, unnest(range(0,len(ps))) as i from every),
 firsts as (select page_id, origin || p as endpoint_url, min(i) as i from un group by all)
 select page_id, endpoint_url, cast(row_number() over (partition by page_id order by i) - 1 as int) as endpoint_ord from firsts""")
def u7(spark, sf):
    caps = C.with_builder(link_pages(spark, sf))
    rows = FR.candidate_endpoints(caps)
    page = F.regexp_extract("dealer_url", r"^https://h(\d+)\.", 1).cast("bigint")
    return rows.select(page.alias("page_id"), "endpoint_url", "endpoint_ord")


def _page_id():
    return F.regexp_extract("page_url", r"^https://h(\d+)\.", 1).cast("bigint").alias("page_id")


@query("u8_best_inventory_link", ANCHORS + f""", s as (select *, {_SCORE} as score from links where starts_with(href, origin))
  select page_id, href, score from (select *, row_number() over (partition by page_id order by score desc, pos) r from s where score >= 2) where r = 1""")
def u8(spark, sf):
    links = FR.page_links(link_pages(spark, sf))
    return FR.best_inventory_link(links).select(_page_id(), "href", "score")


@query("u9_best_wide_link", ANCHORS + f""", s as (select *, (case when regexp_matches(href,'(?i){V.WIDE_LINK_HREF}') then 2 else 0 end) + (case when regexp_matches(lower(text),'{V.WIDE_LINK_TEXT}') then 1 else 0 end) as score from links where href like 'http%')
  select page_id, href, score from (select *, row_number() over (partition by page_id order by score desc, pos) r from s where score > 0) where r = 1""")
def u9(spark, sf):
    return FR.best_wide_link(FR.page_links(link_pages(spark, sf))).select(_page_id(), "href", "score")


@query("u10_first_link_by_text", ANCHORS + """ select page_id, arg_min(href, pos) as href from links
  where regexp_matches(text,'(?i)^(inventory|view inventory|pre-?owned|used|vehicles)') group by page_id""")
def u10(spark, sf):
    return FR.first_link_by_text(FR.page_links(link_pages(spark, sf)), "dealersync").select(_page_id(), "href")


@query("u11_pagination_frontier", """select page_id, cast(n as int) as page, case when n = 1 then url when contains(url,'?') then url || '&page=' || cast(n as varchar) else url || '?page=' || cast(n as varchar) end as page_url
  from pages, range(1,16) t(n)""")
def u11(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return FR.pagination_frontier(pages, "dealr", V.MAX_PAGES).select("page_id", "page", "page_url")


@query("u11_pagination_rules", """select page_id, p as platform, cast(n as int) as page, case when n = 1 then url when p = 'dws' then url || '?page_no=' || cast(n as varchar)
    when p = 'dealercom' then url || '?start=' || cast((n - 1) * 24 as varchar) when contains(url,'?') then url || '&page=' || cast(n as varchar) else url || '?page=' || cast(n as varchar) end as page_url
  from pages, range(1,6) t(n), (select unnest(['dws', 'dealercom', 'dealersync', 'overfuel', 'carsforsale']) as p)""")
def u11b(spark, sf):
    """Every platform's way to write the page number."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    return reduce(DataFrame.unionByName, [
        FR.pagination_frontier(pages, platform, 5).select("page_id", F.lit(platform).alias("platform"), "page", "page_url")
        for platform in ("dws", "dealercom", "dealersync", "overfuel", "carsforsale")
    ])


@query("u12_text_beyond_ascii", """select p_partkey as id, case p_partkey % 7 when 6 then 'https://xn--bcher-kva.example/' || p_partkey when 0 then 'https://d.com/caf%C3%A9/' || p_partkey when 1 then 'https://d.com/%E6%BC%A2/x%20y' || p_partkey
  when 2 then 'https://d.com/a?q=%C3%BC%20' || p_partkey when 3 then 'https://d.com/%F0%9F%9A%97' || p_partkey when 4 then 'https://d.com/%7Ba%7D/%60' || p_partkey || '?b={}%27' else 'https://d.com/a#%C3%BC%60' || p_partkey end as url from part""")
def u12b(spark, sf):
    rel = F.expr("""case p_partkey % 7 when 6 then '//Bücher.example/' || p_partkey when 0 then '/café/' || p_partkey when 1 then '漢/x y' || p_partkey when 2 then '/a?q=ü ' || p_partkey
      when 3 then '/🚗' || p_partkey when 4 then '/{a}/`' || p_partkey || "?b={}'" else '/a#ü`' || p_partkey end""")
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), U.resolve(rel, F.lit("https://d.com")).alias("url"))


@query("u12_resolve_url", """select p_partkey as id, case p_partkey % 5 when 0 then 'https://d.com/a/b' || p_partkey when 1 then 'https://d.com/x/' || p_partkey || '?q=1'
  when 2 then 'https://cdn.com/i' || p_partkey when 3 then 'https://d.com/a/' || p_partkey else 'https://e.com/p%20q' || p_partkey end as url from part""")
def u12(spark, sf):
    rel = F.expr("""case p_partkey % 5 when 0 then '/a/b' || p_partkey when 1 then 'x/' || p_partkey || '?q=1'
      when 2 then '//cdn.com/i' || p_partkey when 3 then './a/c/../' || p_partkey else ' https://E.com/p q' || p_partkey end""")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), U.resolve(rel, F.lit("https://d.com")).alias("url")
    )


@query("u13_clean_fleet", CLEANED + """, kept as (select c.*, regexp_replace(lower(regexp_extract(url,'^https?://([^/:?#]+)',1)),'^www\\.','') as domain from cleaned c join lines l using (ord) where not regexp_matches(l.line,'(?i)^#|ftp:'))
  select domain, url from (select *, row_number() over (partition by domain order by ord) r from kept) where r = 1""")
def u13(spark, sf):
    return FR.clean_fleet(seed_lines(spark, sf), "(?i)^#|ftp:").select("domain", "url")


# --- pages with platform markers ---------------------------------------------------
MARKERS = [
    "<i class=DWS-Vehicle>", "data-widget-name", "cms-content-di", "dealeroncdn", "DealerCarSearch",
    "v12soft", "motorlot", "<p>DealerSync</p>", "overfuel", "dealr.cloud", "carsforsale.com datadome",
    "goxee", "frazer", "duda.co", "captcha-delivery.com", "wsimg.com", "deskmanager", "autorevo",
    "dealerfire", "autocorner.com", "this domain is for sale", "wp-json", "_wixCssImports", "squarespace",
    "Shopify", "Just a moment", "nothing", "access denied", '"vin": 1 "VIN" : 2 "vin":3',
    '__NEXT_DATA__ "inventory"', "FX1GB314159265358", "buy this domain",
    '<script type="application/ld+json">{"@graph":[{"@type":"Product","brand":"B"}]}</script>',
    '<script type="application/ld+json">{"@type":"Organization","brand":"B"}</script>', "{{x}}",
    "/vdp/ /vdp/ /details/ /vehicle/ /inventory/ /vdp/", "Attention Required! | Cloudflare",
]
MARKED_SQL = (
    "select page_id as capture_id, 'run-1' as run_id, 'https://h' || cast(page_id as {S}) || case page_id % 19 when 3 then '.dealeron.com' when 4 then '.edgepilot.net' else '.example.com' end as dealer_url,"
    " cast(case page_id % 13 when 0 then 403 when 1 then 404 when 2 then null when 3 then 503 when 4 then null else 200 end as int) as status,"
    " case page_id % 13 when 2 then 'dns' when 4 then case when page_id % 2 = 0 then 'timeout' else 'other' end end as error,"
    " case when page_id % 17 = 5 then 'x.wixsite.com' when page_id % 17 = 6 then 'other.net' end as cname,"
    " case when page_id % 13 in (2, 4) then null else html || case page_id % " + str(len(MARKERS)) + " "
    + " ".join(f"when {i} then '{m}'" for i, m in enumerate(MARKERS)) + " end end as body from pages"
)


def marked(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "pages").createOrReplaceTempView("pages")
    return spark.sql(MARKED_SQL.replace("{S}", "string")).withColumn("page_url", F.col("dealer_url"))


M = f"with m as ({MARKED_SQL.replace('{S}', 'varchar')})"


def _chain(column: str, signatures) -> str:
    return "case " + " ".join(
        f"when regexp_matches({column}, '(?i){p}') then '{n}'" for p, n in signatures
    ) + " end"


_HOST = "regexp_extract(dealer_url,'^https?://([^/]+)',1) || ' ' || coalesce(cname,'')"
_BLOCKED = f"(coalesce(status in (403,429,503), false) or coalesce(length(body),0) < 1500 or coalesce(regexp_matches(body,'(?i){V.BLOCKED_MARKERS}'), false))"
FINGER = M + f""", f as (select dealer_url as url, cname, {_chain(_HOST, V.HOST_SIGNATURES)} as hl, {_chain('body', V.HTML_SIGNATURES)} as pl, (error is not null or status >= 400) as nr from m),
  finger as (select url, coalesce(hl, pl, case when nr then '{V.LABEL_CHECK_WITH_BROWSER}' else '{V.LABEL_UNKNOWN}' end) as platform,
   case when hl is not null then 'host/cname' when pl is not null then 'html' else 'http' end as via, case when hl is not null then cname end as cname from f)"""
_LD = "regexp_matches(body, '\"@type\":\"Product\",\"brand\"')"
_EMBED = f"({_LD} or (regexp_matches(body,'{V.STATE_MARKERS_CASED}') and regexp_matches(body,'(?i){V.STATE_VIN_WORDS}')) or len(regexp_extract_all(body,'(?i)\"vin\"\\s*:')) >= 3)"


@query("c1_blocked_pages", M + f" select capture_id, {_BLOCKED} as blocked from m")
def c1(spark, sf):
    return C.with_blocked(marked(spark, sf)).select("capture_id", "blocked")


@query("c2_host_platform", M + f" select capture_id, {_chain(_HOST, V.HOST_SIGNATURES)} as platform from m")
def c2(spark, sf):
    return marked(spark, sf).select(
        "capture_id", C.host_platform(F.col("dealer_url"), F.col("cname")).alias("platform")
    )


@query("c3_page_platform", M + f" select capture_id, {_chain('body', V.HTML_SIGNATURES)} as platform from m")
def c3(spark, sf):
    return C.with_page_platform(marked(spark, sf), "platform").select("capture_id", "platform")


_BUILDER = "case " + " ".join(
    "when " + " or ".join(f"contains(lower(body),'{w}')" for w in words) + f" then '{n}'"
    for words, n in V.BUILDER_MARKERS
) + " end"


@query("c4_site_builder", M + f" select capture_id, {_BUILDER} as builder from m")
def c4(spark, sf):
    return C.with_builder(marked(spark, sf)).select("capture_id", "builder")


RENDERED = M + f""", f as (select dealer_url as url, cname, {_chain(_HOST, V.HOST_SIGNATURES)} as hl, {_chain('body', V.HTML_SIGNATURES)} as pl, (error is not null or status >= 400) as nr,
   case when error = 'dns' then '{V.LABEL_UNREACHABLE}' else coalesce({_chain('html', V.HTML_SIGNATURES)}, '{V.LABEL_UNKNOWN}') end as rl from m join pages on page_id = capture_id)
  select url, coalesce(hl, pl, case when nr then rl else '{V.LABEL_UNKNOWN}' end) as platform,
   case when hl is not null then 'host/cname' when pl is not null then 'html' when nr and rl = '{V.LABEL_UNREACHABLE}' then 'browser-error' when nr then 'browser' else 'http' end as via,
   case when hl is not null then cname end as cname from f"""


@query("c5_fingerprint", RENDERED)
def c5(spark, sf):
    caps = marked(spark, sf)
    again = caps.filter("error is not null or status >= 400").select(
        "capture_id", "dealer_url", F.when(F.col("error") == "dns", "browser").alias("error")
    )
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("capture_id"), F.col("html").alias("body"))
    return C.fingerprint(caps, again.join(pages, "capture_id"))


_SHARE = "cast(floor(100.0 * n / sum(n) over () + 0.5) as bigint) as pct"


@query("c6_platform_distribution", FINGER + f", c as (select platform, count(*) as n from finger group by platform) select platform, n, {_SHARE} from c")
def c6(spark, sf):
    return C.distribution(C.fingerprint(marked(spark, sf)), "platform")


@query("c7_spa_likelihood", M + f""", p as (select 'https://g' || cast(capture_id % 40 as varchar) as dealer_url, body from m where length(body) >= 2000)
  select dealer_url, bool_or(regexp_matches(body,'(?i){V.SPA_MARKERS}') or len(regexp_extract_all(body,'(?i){V.DETAIL_LINK}')) >= 6) or max(length(body)) >= 8000 as spa_likely from p group by dealer_url""")
def c7(spark, sf):
    caps = marked(spark, sf).withColumn("dealer_url", F.expr("'https://g' || (capture_id % 40)"))
    return C.spa_likelihood(caps)


@query("c8_embedded_signal", M + f" select capture_id, coalesce({_EMBED}, false) as embedded from m")
def c8(spark, sf):
    return marked(spark, sf).select("capture_id", C.embedded_signal(F.col("body")).alias("embedded"))


@query("c9_api_signal", """select event_id, event_type <> 'error' and event_type <> 'view' as api from events""")
def c9(spark, sf):
    body = F.expr("""case event_type when 'error' then 'x [{"vin": 1},{"vin": 2}]' when 'view' then '[{"vin": 1}]' else '  [{"VIN" : 1},{"vin": 2}]' end || props""")
    return table(spark, sf, "events").select("event_id", C.api_signal(body).alias("api"))


def _in(labels) -> str:
    return "(" + ",".join(f"'{x}'" for x in labels) + ")"


LAYERS = FINGER + f""", api as (select distinct 'https://h' || cast(page_id as varchar) || case page_id % 19 when 3 then '.dealeron.com' when 4 then '.edgepilot.net' else '.example.com' end as url from pages where page_id % 3 = 0),
 layers as (select f.url, f.platform, case when f.platform in {_in(V.READY_LABELS)} then 'L0_extractor' when f.platform in {_in(V.KNOWN_PENDING_LABELS)} then 'L0_pendiente'
  when f.platform = '{V.LABEL_PARKED}' then 'descartado'
  when m.error = 'timeout' then 'recuperable' when m.error is not null then 'descartado'
  when m.status in (403,429,503) or regexp_matches(body,'(?i){V.CHALLENGE_MARKERS}') then 'antibot'
  when regexp_matches(body,'(?i){V.PARKED_MARKERS}') then 'descartado' when {_EMBED} then 'L2_embebido'
  when api.url is not null then 'L1_api' else 'L3_navegacion' end as layer
  from finger f join m on m.dealer_url = f.url left join api on api.url = f.url)"""


def _layers(spark: SparkSession, sf: str) -> DataFrame:
    caps = marked(spark, sf)
    answers = caps.select(
        "dealer_url", F.lit(200).alias("status"),
        F.expr("""case when capture_id % 3 = 0 then '[{"vin":1},{"vin":2}]' else '[{"vin":1}]' end""").alias("body"),
    )
    return C.cascade_layers(C.fingerprint(caps), caps, answers)


@query("c10_cascade_layer", LAYERS + " select url, platform, layer from layers")
def c10(spark, sf):
    return _layers(spark, sf)


_ORD = "case layer " + " ".join(f"when '{n}' then {i}" for i, n in enumerate(V.LAYER_ORDER)) + f" else {len(V.LAYER_ORDER)} end"


@query("c11_layer_distribution", LAYERS + f", c as (select layer, count(*) as n from layers group by layer) select layer, n, {_ORD} as ord, {_SHARE} from c")
def c11(spark, sf):
    return C.layer_distribution(_layers(spark, sf))


RELABEL = FINGER + f""", tries as (select dealer_url as url, 1 as attempt, case when capture_id % 4 = 1 then '' else repeat('x',1600) end || case when capture_id % 3 = 0 then 'overfuel' else 'datadome' end as body from m
  union all select dealer_url, 2, case when capture_id % 5 = 1 then '' else repeat('x',1600) end || case when capture_id % 2 = 0 then 'goxee' else '' end from m),
 lab as (select url, attempt, length(body) > 1500 as usable, {_chain('body', V.HTML_SIGNATURES)} as label from tries),
 o as (select url, arg_min(label, attempt) filter (where usable and label is not null and label not in {_in(V.INCONCLUSIVE_LABELS)}) as hit,
   arg_max(case when usable then coalesce(label,'{V.LABEL_UNKNOWN}') else '{V.LABEL_UNREACHABLE}' end, attempt) as last from lab group by url),
 relabelled as (select f.url, case when f.platform in {_in(V.BLOCKED_LABELS)} then coalesce(o.hit, o.last, '{V.LABEL_UNREACHABLE}') else f.platform end as platform,
   case when f.platform in {_in(V.BLOCKED_LABELS)} then 'web-unlocker' else via end as via, f.platform as was from finger f left join o on o.url = f.url)"""


def _relabelled(spark: SparkSession, sf: str) -> DataFrame:
    caps = marked(spark, sf)
    first = caps.select("dealer_url", F.lit(1).alias("attempt"), F.expr(
        "case when capture_id % 4 = 1 then '' else repeat('x',1600) end || case when capture_id % 3 = 0 then 'overfuel' else 'datadome' end").alias("body"))
    second = caps.select("dealer_url", F.lit(2).alias("attempt"), F.expr(
        "case when capture_id % 5 = 1 then '' else repeat('x',1600) end || case when capture_id % 2 = 0 then 'goxee' else '' end").alias("body"))
    return C.relabel_blocked(C.fingerprint(caps), first.unionByName(second))


@query("c12_relabel_blocked", RELABEL + " select url, platform, via, was from relabelled")
def c12(spark, sf):
    return _relabelled(spark, sf).select("url", "platform", "via", "was")


@query("c13_recovery_stats", RELABEL + f""" select count(*) filter (where platform not in {_in(V.INCONCLUSIVE_LABELS)}) as recovered, count(*) as targets from relabelled where was in {_in(V.BLOCKED_LABELS)}""")
def c13(spark, sf):
    return C.recovery_stats(_relabelled(spark, sf))


TRIAGE = M + f""", t as (select dealer_url as url, case when {_BLOCKED} or error is not null then 'antibot_real'
  when regexp_matches(body,'\\b[A-HJ-NPR-Z0-9]{{17}}\\b') or regexp_matches(body,'(?i){V.RENDERED_VEHICLE_MARKERS}') then 'L3_navegacion' else 'L3_sin_senal' end as layer2 from m)"""


@query("c14_rendered_triage", TRIAGE + " select url, layer2 from t")
def c14(spark, sf):
    return C.rendered_triage(marked(spark, sf))


VENDORS = LINKED + f""", h as (select page_id, regexp_extract_all(body,'(?i)\\s(?:src|href)\\s*=\\s*["'']?https?://([a-z0-9.-]+)',1) as hs, regexp_extract(body,'(?i)name="generator" content="([^"]*)"',1) as g from linked),
 d as (select distinct page_id, array_to_string(list_slice(string_split(lower(x),'.'),-2,-1),'.') as vendor from (select page_id, unnest(hs) as x from h)),
 v as (select page_id, vendor from d where not regexp_matches(vendor,'{V.VENDOR_NOISE}') union all select page_id, 'gen:' || regexp_extract(g,'^[^\\s\\d]*',0) from h where g <> ''),
 tally as (select vendor, count(*) as n from v group by vendor)"""


@query("c15_vendor_tally", VENDORS + " select vendor, n from tally order by n desc, vendor limit 40")
def c15(spark, sf):
    return C.top_vendors(C.vendor_tally(link_pages(spark, sf)))


@query("c16_visible_vins", M + """ select capture_id, coalesce(len(list_distinct(list_filter(regexp_extract_all(body,'\\b[A-HJ-NPR-Z0-9]{17}\\b'), lambda v: regexp_matches(v,'[0-9]') and regexp_matches(v,'[A-Z]')))),0) as vins from m""")
def c16(spark, sf):
    return marked(spark, sf).select(
        "capture_id", F.coalesce(F.size(C.visible_vins(F.col("body"))), F.lit(0)).cast("bigint").alias("vins")
    )


@query("c17_clean_html", """with a as (select page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,'(?is)<script.*?</script>',' ','g'),'(?is)<style.*?</style>',' ','g'),'(?is)<svg.*?</svg>',' ','g'),'(?s)<!--.*?-->',' ','g') as h from pages),
  b as (select page_id, regexp_replace(regexp_replace(h,'<(?:[^a/>][^>]*|a[^\\s>][^>]*|/[^a][^>]*)>',' ','g'),'\\s{2,}',' ','g') as h from a)
  select page_id, md5(trim(h, E' \\t\\n\\r')) as digest, length(trim(h, E' \\t\\n\\r')) as n_chars from b""")
def c17(spark, sf):
    return table(spark, sf, "pages").select("page_id", C.clean_html(F.col("html")).alias("t")).select(
        "page_id", F.md5("t").alias("digest"), F.length("t").cast("bigint").alias("n_chars")
    )


@query("c18_seed_tags", FINGER + f" select url, case when platform in {_in(V.SEED_TAGS)} then platform end as tag from finger")
def c18(spark, sf):
    return C.fingerprint(marked(spark, sf)).select("url", C.seed_tag(F.col("platform")).alias("tag"))


# --- sinks: written, read back ------------------------------------------------------
@query("s7_platform_map_sink", FINGER + " select url, platform, via, coalesce(cname,'') as cname from finger")
def s7(spark, sf):
    path = work_folder(spark, "platform-map")
    SK.write_platform_map(C.fingerprint(marked(spark, sf)), path)
    return spark.read.csv(path, header=True, emptyValue="").na.fill("")


@query("s8_layer_sink", LAYERS + " select url, platform, layer from layers")
def s8(spark, sf):
    path = work_folder(spark, "cascade-map")
    SK.write_layers(_layers(spark, sf), path, ["url", "platform", "layer"])
    return spark.read.csv(path, header=True)


@query("s8_reprobe_sink", TRIAGE + " select url, layer2 from t")
def s8b(spark, sf):
    path = work_folder(spark, "reprobe-map")
    SK.write_layers(C.rendered_triage(marked(spark, sf)), path, ["url", "layer2"])
    return spark.read.csv(path, header=True)


@query("s9_tagged_seed_sink", FINGER + f" select case when platform in {_in(V.SEED_TAGS)} then url || ',' || platform else url end as value from finger")
def s9(spark, sf):
    path = work_folder(spark, "seeds-out")
    tagged = C.fingerprint(marked(spark, sf)).withColumn("tag", C.seed_tag(F.col("platform")))
    SK.write_tagged_seeds(tagged, path)
    return spark.read.text(path)


@query("s10_vendor_sink", VENDORS + " select cast(n as varchar) as n, vendor from tally")
def s10(spark, sf):
    path = work_folder(spark, "vendors")
    SK.write_vendor_tally(C.vendor_tally(link_pages(spark, sf)), path)
    return spark.read.csv(path, sep="\t").toDF("n", "vendor")


@query("r10_fleet_triage", FINGER + f""", c as (select coalesce(error, 'answered') as cause, count(*) as n from m where error is not null or status >= 400 group by 1) select cause, n, {_SHARE} from c""")
def r10(spark, sf):
    down = marked(spark, sf).filter("error is not null or status >= 400")
    return C.distribution(down.withColumn("cause", F.coalesce("error", F.lit("answered"))), "cause")
