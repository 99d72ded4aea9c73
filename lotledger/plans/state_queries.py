"""Cascade, history tables, reports and the streaming worker over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as V
from ..operators import cascade as K
from ..operators import reports as R
from ..operators import state as ST
from ..schemas import VEHICLE_COLUMNS, VEHICLE_TYPES
from ..session import work_folder
from ..sources import sinks as SK
from ..streaming import worker as W
from .page_queries import SEEDS, seed_lines
from ..sources import seeds as SS
from .registry import query
from .rendering import table

# --- listings: every line item shows part l_partkey at dealer l_suppkey -------------------
_ORD = ("(cast(date_diff('day', date '1970-01-01', cast(l_shipdate as date)) as bigint) * 10000000000000"
        " + l_orderkey * 10000000 + cast(round(l_extendedprice * 100) as bigint) % 10000000)")
LISTING_SQL = """select l_suppkey as dealer_id,
  'FX1GB' || lpad(cast(l_partkey*2654435+314159265358 as {S}),12,'0') as vin,
  case when l_linestatus = 'O' then 'S' || cast(l_partkey as {S}) end as stock_number,
  case when l_returnflag = 'N' then 'Brand' || l_linestatus end as make,
  cast(case when l_returnflag <> 'R' then l_quantity * 100 end as int) as mileage,
  case when l_linestatus = 'F' then l_extendedprice end as price,
  case when l_shipdate < timestamp '1998-01-01 00:00:00' then 'r1' else 'r2' end as run_id,
  'layer' || l_returnflag as source_strategy, {ORD} as ord from lineitem"""
LISTINGS = "with li as (" + LISTING_SQL.replace("{S}", "varchar").replace("{ORD}", _ORD) + ")"


def _as_batch(df: DataFrame) -> DataFrame:
    """Fill up to the columns the upsert takes."""
    for name in VEHICLE_COLUMNS:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(VEHICLE_TYPES[name]))
    return df.withColumn("seen_at", F.when(
        F.col("run_id") == "r1", F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    ).otherwise(F.to_timestamp(F.lit("2024-01-02 00:00:00"))))


def listings(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "lineitem").createOrReplaceTempView("lineitem")
    order = _ORD.replace("date_diff('day', date '1970-01-01', cast(l_shipdate as date))",
                         "unix_date(cast(l_shipdate as date))")
    return _as_batch(spark.sql(LISTING_SQL.replace("{S}", "string").replace("{ORD}", order)))


def empty_state(spark: SparkSession) -> DataFrame:
    types = {"dealer_id": "bigint", "vehicle_key": "string", **VEHICLE_TYPES}
    for name in ST.STATE_COLUMNS:
        types.setdefault(name, "timestamp" if name.endswith("_at") else "string")
    return spark.createDataFrame([], ", ".join(f"{n} {types[n]}" for n in ST.STATE_COLUMNS))


def _history(spark: SparkSession, sf: str) -> DataFrame:
    """State after run r1, then r2 merged on top. The first state is a written table, as
    it is between runs."""
    rows = listings(spark, sf)
    root = work_folder(spark, "vehicles")
    SK.write_snapshot(ST.state_of(ST.merge_vehicles(empty_state(spark), rows.filter("run_id = 'r1'"))), root)
    return ST.merge_vehicles(SK.read_snapshot(spark, root), rows.filter("run_id = 'r2'"))


def _fold(column: str) -> str:
    newer = f"arg_max({column}, ord) filter (where run_id = 'r2' and {column} is not null)"
    older = f"arg_max({column}, ord) filter (where run_id = 'r1' and {column} is not null)"
    return f"coalesce({newer}, {older}) as {column}"


HISTORY = LISTINGS + f""", st as (select dealer_id, vin, {_fold('stock_number')}, {_fold('make')}, {_fold('mileage')}, {_fold('price')}, {_fold('source_strategy')},
  min(run_id) as first_seen_run, max(run_id) as last_seen_run, count(*) filter (where run_id = 'r2') as n2, count(*) filter (where run_id = 'r1') as n1 from li group by dealer_id, vin)"""
_STATE_OUT = "dealer_id, vin, stock_number, make, mileage, price, source_strategy, first_seen_run, last_seen_run"


@query("m6_upsert_with_vin", HISTORY + f" select {_STATE_OUT} from st")
def m6(spark, sf):
    return _history(spark, sf).select(_STATE_OUT.split(", "))


@query("m9_fold_counts", HISTORY + " select dealer_id, sum(case when n1 = 0 then 1 else 0 end)::bigint as inserted, sum(n2 - case when n1 = 0 then 1 else 0 end)::bigint as updated from st where n2 > 0 group by dealer_id")
def m9(spark, sf):
    return ST.upsert_counts(_history(spark, sf))


@query("m9_fold_batch", LISTINGS + """ select dealer_id, vin, arg_max(price, ord) filter (where price is not null) as price, arg_max(make, ord) filter (where make is not null) as make, count(*) as rows from li group by dealer_id, vin""")
def m9b(spark, sf):
    rows = listings(spark, sf).withColumn("rows", F.lit(1).cast("bigint"))
    return ST.fold_batch(rows, ["dealer_id", "vin"]).select("dealer_id", "vin", "price", "make", "rows")


@query("m10_first_last_seen", HISTORY + """ select dealer_id, vin, first_seen_run, last_seen_run, case first_seen_run when 'r1' then '2024-01-01' else '2024-01-02' end as first_day, case last_seen_run when 'r1' then '2024-01-01' else '2024-01-02' end as last_day from st""")
def m10(spark, sf):
    return _history(spark, sf).select(
        "dealer_id", "vin", "first_seen_run", "last_seen_run",
        F.date_format("first_seen_at", "yyyy-MM-dd").alias("first_day"),
        F.date_format("last_seen_at", "yyyy-MM-dd").alias("last_day"),
    )


def _two_runs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("r1", 1), ("r2", 2)], "id string, started_at int")


@query("m11_left_inventory", HISTORY + " select dealer_id, vin, last_seen_run from st where last_seen_run <> 'r2'")
def m11(spark, sf):
    return ST.left_inventory(_history(spark, sf), _two_runs(spark)).select("dealer_id", "vin", "last_seen_run")


@query("m12_invariants", "select 'duplicate vehicles' as what, 0::bigint as n union all select 'orphan dealers', count(*) from (select distinct l_suppkey from lineitem) where l_suppkey not in (select s_suppkey from supplier)")
def m12(spark, sf):
    state = ST.state_of(_history(spark, sf))
    twice = ST.duplicate_keys(state, ["dealer_id", "vin"]).agg(F.count("*").alias("n"))
    lost = ST.orphans(state.select("dealer_id").distinct(), "dealer_id", table(spark, sf, "supplier"), "s_suppkey")
    return twice.select(F.lit("duplicate vehicles").alias("what"), "n").unionByName(
        lost.agg(F.count("*").alias("n")).select(F.lit("orphan dealers").alias("what"), "n")
    )


# --- vehicles without VIN: one per customer ------------------------------------------------
def _bare(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("bigint").alias("dealer_id"), F.col("c_custkey").alias("k"),
        F.col("c_mktsegment").alias("make"), F.expr("'M' || c_custkey").alias("model"),
        F.lit(2000).alias("year"), "c_acctbal",
    )
    old = c.select("dealer_id", "k", F.expr("'S' || k").alias("stock_number"), "make", "model", "year",
                   F.col("c_acctbal").alias("price"), F.lit("r1").alias("run_id"), F.col("k").alias("ord"))
    kind = F.col("k") % 4
    new = c.select(
        "dealer_id", "k",
        F.when(kind == 0, F.expr("'S' || k")).when(kind == 2, F.expr("'T' || k")).when(kind == 3, F.expr("'U' || k")).alias("stock_number"),
        F.when(kind != 0, F.col("make")).alias("make"),
        F.when(kind == 0, None).when(kind == 3, F.expr("'N' || k")).otherwise(F.col("model")).alias("model"),
        "year", (F.col("c_acctbal") + 1).alias("price"), F.lit("r2").alias("run_id"), F.col("k").alias("ord"),
    )
    again = new.filter(F.col("stock_number").startswith("U")).withColumns({
        "ord": F.col("ord") + 10_000_000, "price": F.lit(None).cast("double"),
    })
    return tuple(
        _as_batch(d.drop("k")).withColumn("source_strategy", F.lit("api")) for d in (old, new.unionByName(again))
    )


def _bare_history(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _bare(spark, sf)
    root = work_folder(spark, "bare")
    SK.write_snapshot(ST.state_of(ST.merge_vehicles(empty_state(spark), old)), root)
    return ST.merge_vehicles(SK.read_snapshot(spark, root), new)


@query("m7_upsert_by_stock", """select cast(c_nationkey as bigint) as dealer_id, case when c_custkey % 4 = 2 then 'T' else 'S' end || cast(c_custkey as varchar) as stock_number, c_mktsegment as make, c_acctbal + case when c_custkey % 4 = 3 then 0 else 1 end as price, 'r1' as first_seen_run, case when c_custkey % 4 = 3 then 'r1' else 'r2' end as last_seen_run from customer
  union all select c_nationkey, 'U' || cast(c_custkey as varchar), c_mktsegment, c_acctbal + 1, 'r2', 'r2' from customer where c_custkey % 4 = 3""")
def m7(spark, sf):
    return _bare_history(spark, sf).select(
        "dealer_id", "stock_number", "make", "price", "first_seen_run", "last_seen_run"
    )


@query("m8_upsert_by_model", """select cast(c_nationkey as bigint) as dealer_id, case when c_custkey % 4 = 2 then 'T' else 'S' end || cast(c_custkey as varchar) as stock_number, 'M' || cast(c_custkey as varchar) as model, c_acctbal + case when c_custkey % 4 = 3 then 0 else 1 end as price, case when c_custkey % 4 = 3 then null else 1 end::bigint as batch_rows, false as is_new from customer
  union all select c_nationkey, 'U' || cast(c_custkey as varchar), 'N' || cast(c_custkey as varchar), c_acctbal + 1, 2, true from customer where c_custkey % 4 = 3""")
def m8(spark, sf):
    return _bare_history(spark, sf).select("dealer_id", "stock_number", "model", "price", "batch_rows", "is_new")


# --- dealers and runs -----------------------------------------------------------------------
def _dealers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.xxhash64(F.expr("'https://www.s' || s_suppkey || '.example.com'")).alias("id"),
        F.col("s_name").alias("name"), F.expr("'https://www.s' || s_suppkey || '.example.com'").alias("base_url"),
        F.expr("'s' || s_suppkey || '.example.com'").alias("domain"),
        F.expr("case when s_nationkey % 3 <> 0 then 'P' || s_nationkey end").alias("platform"),
        F.lit(None).cast("timestamp").alias("created_at"), F.lit(None).cast("timestamp").alias("updated_at"),
    )


@query("m1_upsert_dealers", "with b as (select 'https://www.s' || cast(l_suppkey + 50 as varchar) || '.example.com' as base_url, case when l_returnflag <> 'R' then l_linestatus || l_returnflag end as platform, " + _ORD + """ as ord from lineitem),
  f as (select base_url, arg_max(platform, ord) filter (where platform is not null) as p from b group by base_url),
  o as (select 'https://www.s' || cast(s_suppkey as varchar) || '.example.com' as base_url, s_name, case when s_nationkey % 3 <> 0 then 'P' || cast(s_nationkey as varchar) end as platform from supplier)
  select coalesce(o.base_url, f.base_url) as base_url, replace(coalesce(o.base_url, f.base_url),'https://www.','') as domain, coalesce(s_name, replace(f.base_url,'https://www.','')) as name, coalesce(f.p, o.platform) as platform from o full outer join f on o.base_url = f.base_url""")
def m1(spark, sf):
    rows = listings(spark, sf)
    batch = rows.select(
        F.expr("'https://www.s' || (dealer_id + 50) || '.example.com'").alias("base_url"),
        F.lit(None).cast("string").alias("name"),
        F.expr("case when source_strategy <> 'layerR' then (case when stock_number is null then 'F' else 'O' end) || right(source_strategy, 1) end").alias("platform"),
        "seen_at", "ord",
    )
    return ST.upsert_dealers(_dealers(spark, sf), batch).select("base_url", "domain", "name", "platform")


@query("m2_set_platform", """select 'https://www.s' || cast(s_suppkey as varchar) || '.example.com' as base_url, case when s_suppkey % 3 = 0 then 'wordpress' when s_suppkey % 2 = 0 then 'DealerSync' when s_nationkey % 3 <> 0 then 'P' || cast(s_nationkey as varchar) end as platform from supplier""")
def m2(spark, sf):
    s = table(spark, sf, "supplier").withColumn("base_url", F.expr("'https://www.s' || s_suppkey || '.example.com'"))
    known = s.select("base_url", F.expr("case when s_suppkey % 2 = 0 then 'DealerSync' end").alias("platform"), F.lit(0).alias("prio"))
    page = s.select("base_url", F.expr("case when s_suppkey % 3 = 0 then 'wordpress' end").alias("platform"), F.lit(1).alias("prio"))
    return ST.set_platforms(_dealers(spark, sf), known.unionByName(page)).select("base_url", "platform")


_DAY = "strftime(ts,'%Y-%m-%d')"
LEDGER = f"""with e as (select *, {_DAY} as run_id, 'https://d' || cast(user_id as varchar) || '.example.com' as url, event_type = 'purchase' or event_type = 'signup' as late from events),
  led as (select run_id, url, arg_min(event_id, (late, event_id)) as event_id from e group by run_id, url),
  ledger as (select l.run_id, l.url, l.event_id, case when e.event_type = 'error' then 'failed' else 'ok' end as status, cast(floor(e.value) as int) as vehicles_found from led l join e using (event_id)),
  runs as (select run_id as id, cast(max(cast(floor(value) as int)) as int) as total_urls from e group by run_id),
  sums as (select run_id as id, count(*) as cnt, count(*) filter (where status = 'ok') as ok, count(*) filter (where status = 'failed') as bad, sum(vehicles_found) as veh from ledger group by run_id),
  refreshed as (select r.id, total_urls, cast(ok as int) as urls_ok, cast(bad as int) as urls_failed, cast(veh as int) as total_vehicles, case when cnt >= total_urls and total_urls > 0 then 'finished' else 'running' end as status from runs r join sums using (id))"""


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        F.expr("'https://d' || user_id || '.example.com'").alias("url"),
        F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"),
        F.floor("value").cast("int").alias("vehicles_found"),
        F.col("event_type").isin("purchase", "signup").alias("late"),
        F.col("ts").cast("timestamp").alias("seen_at"), F.col("event_id").alias("ord"), "event_type",
        "event_id", "user_id", "value",
    )


def _ledger(spark: SparkSession, sf: str) -> DataFrame:
    e = _events(spark, sf).select("run_id", "url", "status", "vehicles_found", "ord", "late")
    start = ST.new_results(e.limit(0), e.filter("not late"))
    return ST.record_results(start.drop("late"), e.filter("late"))


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    e = _events(spark, sf).select("run_id", F.col("vehicles_found").alias("total_urls"), "seen_at", "late")
    none = spark.createDataFrame([], W._RUN_SCHEMA)
    first = ST.ensure_runs(none, e.filter("not late"))
    return ST.ensure_runs(first, e.filter("late"))


def _refreshed(spark: SparkSession, sf: str) -> DataFrame:
    return ST.refresh_runs(_runs(spark, sf), _ledger(spark, sf), F.to_timestamp(F.lit("2024-02-01 00:00:00")))


@query("m3_ensure_runs", LEDGER + " select id, total_urls from runs")
def m3(spark, sf):
    return _runs(spark, sf).select("id", "total_urls")


@query("m4_record_results", LEDGER + " select run_id, url, event_id as ord, status, vehicles_found from ledger")
def m4(spark, sf):
    return _ledger(spark, sf).select("run_id", "url", "ord", "status", "vehicles_found")


@query("m5_refresh_runs", LEDGER + " select *, case when status = 'finished' then '2024-02-01' end as finished_on from refreshed")
def m5(spark, sf):
    return _refreshed(spark, sf).select(
        "id", "total_urls", "urls_ok", "urls_failed", "total_vehicles", "status",
        F.date_format("finished_at", "yyyy-MM-dd").alias("finished_on"),
    )


# --- cascade: layers tried per day and user -------------------------------------------------
_STRATEGY = "case event_type when 'view' then 'api' when 'click' then 'embedded' when 'purchase' then 'navigate' when 'signup' then 'unlocked' else 'platform:DealerSync' end"
_PRIO = "case strategy when 'api' then 1 when 'embedded' then 2 when 'navigate' then 3 when 'unlocked' then 4 else 0 end"
LAYERS = f"""with e as (select *, {_DAY} as run_id, 'https://d' || cast(user_id as varchar) || '.example.com' as dealer_url, {_STRATEGY} as strategy from events),
  ly as (select run_id, dealer_url, strategy, {_PRIO} as prio, count(*) filter (where value > 60) as n, count(*) as tries, strategy || ' ' || cast(count(*) as varchar) as reason from e group by run_id, dealer_url, strategy),
  w as (select run_id, dealer_url, min(prio) filter (where n > 0) as win_prio from ly group by run_id, dealer_url),
  won as (select w.run_id, w.dealer_url, w.win_prio, ly.strategy, ly.n, ly.reason from w left join ly on ly.run_id = w.run_id and ly.dealer_url = w.dealer_url and ly.prio = w.win_prio),
  tr as (select ly.run_id, ly.dealer_url, string_agg('[' || strategy || '] ' || reason, ' || ' order by prio) as trace, count(*) as entries, max(tries * 9) as longest from ly join w using (run_id, dealer_url) where win_prio is null or prio <= win_prio group by ly.run_id, ly.dealer_url)"""


def _strategies(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).select(
        "run_id", F.col("url").alias("dealer_url"), F.expr(_STRATEGY).alias("strategy"), "event_id", "value"
    ).withColumn("prio", K.priority(F.col("strategy")))


def _layers(spark: SparkSession, sf: str) -> DataFrame:
    n = F.count_if(F.col("value") > 60)
    tries = F.count("*")
    return _strategies(spark, sf).groupBy("run_id", "dealer_url", "strategy", "prio").agg(
        (n > 0).alias("ok"), n.alias("n"),
        F.concat("strategy", F.lit(" "), tries.cast("string")).alias("reason"),
        F.array_repeat(F.lit("try"), (tries * 9).cast("int")).alias("attempts"),
    )


@query("k1_priority_order", LAYERS + " select run_id, dealer_url, strategy, cast(prio as int) as prio from ly")
def k1(spark, sf):
    return _layers(spark, sf).select("run_id", "dealer_url", "strategy", "prio")


@query("k2_first_success", LAYERS + " select run_id, dealer_url, cast(win_prio as int) as win_prio, strategy as win_strategy, n as win_n from won")
def k2(spark, sf):
    return K.winners(_layers(spark, sf)).select("run_id", "dealer_url", "win_prio", "win_strategy", "win_n")


@query("k2_winning_vehicles", LAYERS + " select e.event_id, e.strategy from e join won on won.run_id = e.run_id and won.dealer_url = e.dealer_url and won.strategy = e.strategy")
def k2b(spark, sf):
    won = K.winners(_layers(spark, sf))
    return K.winning_vehicles(_strategies(spark, sf), won, ["event_id"]).select("event_id", "strategy")


@query("k2_unsolved", LAYERS + " select e.event_id from e join w using (run_id, dealer_url) where win_prio is null")
def k2c(spark, sf):
    solved = K.winners(_layers(spark, sf)).filter("win_prio is not null")
    rows = _strategies(spark, sf).withColumn("capture_id", F.col("event_id"))
    return K.unsolved(rows, solved).select("event_id")


@query("k3_first_page_hit", f"with e as (select event_id, user_id, hour(ts) as page_ord from events where value > 60) select event_id from e join (select user_id, min(page_ord) as least from e group by user_id) using (user_id) where page_ord = least")
def k3(spark, sf):
    rows = table(spark, sf, "events").filter("value > 60").select("event_id", "user_id", F.hour("ts").alias("page_ord"))
    return K.first_hit(rows, "page_ord", ["event_id"], ["user_id"]).select("event_id")


@query("k4_navigate_priority", """with e as (select event_id, user_id, case event_type when 'purchase' then 0 when 'click' then 1 else 2 end as sub from events) select event_id, cast(sub as int) as sub from e join (select user_id, min(sub) as least from e group by user_id) using (user_id) where sub = least""")
def k4(spark, sf):
    sub = F.expr("case event_type when 'purchase' then 0 when 'click' then 1 else 2 end")
    rows = table(spark, sf, "events").select("event_id", "user_id", sub.alias("sub"))
    return K.first_hit(rows, "sub", ["event_id"], ["user_id"]).select("event_id", "sub")


@query("k5_trace_text", LAYERS + """ select ly.run_id, ly.dealer_url, '[' || string_agg('{"strategy":"' || strategy || '","ok":' || case when n > 0 then 'true' else 'false' end || ',"reason":"' || reason || '","attempts":["try"' || repeat(',"try"', cast(least(tries * 9, 15) - 1 as int)) || ']}', ',' order by prio) || ']' as strategies_tried
  from ly join w using (run_id, dealer_url) where win_prio is null or prio <= win_prio group by ly.run_id, ly.dealer_url""")
def k5b(spark, sf):
    return K.traces(_layers(spark, sf), V.LEDGER_ATTEMPTS).select("run_id", "dealer_url", F.to_json("strategies_tried").alias("strategies_tried"))


@query("k5_trace", LAYERS + " select run_id, dealer_url, entries, longest from tr")
def k5(spark, sf):
    longest = F.array_max(F.transform("strategies_tried", lambda t: F.size(t["attempts"])))
    return K.traces(_layers(spark, sf)).select(
        "run_id", "dealer_url", F.size("strategies_tried").cast("bigint").alias("entries"),
        longest.cast("bigint").alias("longest"),
    )


@query("k6_failure_reason", LAYERS + " select run_id, dealer_url, trace from tr")
def k6(spark, sf):
    return K.traces(_layers(spark, sf)).select(
        "run_id", "dealer_url", K.failure_reason(F.col("strategies_tried")).alias("trace")
    )


@query("k7_result_rows", LAYERS + """ select run_id, dealer_url as url, coalesce(replace(won.strategy,'platform:',''),'none') as strategy_used, case when win_prio is null then 'failed' else 'ok' end as status,
  cast(coalesce(won.n, 0) as int) as vehicles_found, case when win_prio is null then trace else won.reason end as reason from won join tr using (run_id, dealer_url)""")
def k7(spark, sf):
    return K.result_rows(_layers(spark, sf)).select(
        "run_id", "url", "strategy_used", "status", "vehicles_found", "reason"
    )


@query("k8_invalid_seeds", SEEDS + " select url, 'failed' as status, 'URL inválida: ' || url as reason from seeds where not regexp_matches(url,'^https?://[^/@\\s]+','i')")
def k8(spark, sf):
    rows = K.invalid_seed_rows(SS.seeds_from_lines(seed_lines(spark, sf)), "run-1")
    return rows.select("url", "status", "reason")


@query("k9_upsert_counts", LAYERS + """, cnt as (select run_id, dealer_url, count(*) filter (where value > 100) as i, count(*) filter (where value <= 100) as u from e group by all)
  select run_id, dealer_url as url, cast(i as int) as vehicles_new, cast(u as int) as vehicles_updated from cnt""")
def k9(spark, sf):
    counts = _strategies(spark, sf).groupBy("run_id", F.xxhash64("dealer_url").alias("dealer_id")).agg(
        F.count_if(F.col("value") > 100).alias("inserted"), F.count_if(F.col("value") <= 100).alias("updated")
    )
    return K.with_upsert_counts(K.result_rows(_layers(spark, sf)), counts).select(
        "run_id", "url", "vehicles_new", "vehicles_updated"
    )


# --- reports ---------------------------------------------------------------------------------
@query("r1_last_runs", LEDGER + " select id, urls_ok, urls_failed, total_vehicles, status from refreshed order by id desc limit 10")
def r1(spark, sf):
    return R.last_runs(_refreshed(spark, sf)).select("id", "urls_ok", "urls_failed", "total_vehicles", "status")


@query("r2_latest_run_results", LEDGER + " select run_id, url, status, vehicles_found, left(repeat('why ', 40), 90) as reason from ledger where run_id = (select max(id) from runs)")
def r2(spark, sf):
    ledger = _ledger(spark, sf).withColumn("reason", F.lit("why " * 40))
    return R.latest_run_results(_runs(spark, sf), ledger).select(
        "run_id", "url", "status", "vehicles_found", "reason"
    )


@query("r3_dealer_counts", "select s_suppkey as id, s_name as name, coalesce(n, 0) as vehicles from supplier left join (select l_suppkey, count(*) as n from lineitem group by 1) on l_suppkey = s_suppkey order by vehicles desc, id limit 25")
def r3(spark, sf):
    dealers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    rows = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("dealer_id"))
    return R.dealer_counts(dealers, rows)


@query("r4_latest_vehicles", "with l as (select *, " + _ORD + " as ord from lineitem), t as (select * from l order by ord desc limit 15) select ord as vehicle_key, s_name as domain, l_extendedprice as price from t join supplier on s_suppkey = l_suppkey")
def r4(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("dealer_id"), F.col("l_extendedprice").alias("price"),
        F.expr(_ORD.replace("date_diff('day', date '1970-01-01', cast(l_shipdate as date))", "unix_date(cast(l_shipdate as date))")).alias("vehicle_key"),
    ).withColumn("last_seen_at", F.col("vehicle_key"))
    dealers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("domain"))
    return R.latest_vehicles(rows, dealers).select("vehicle_key", "domain", "price")


@query("r6_results_by_status", LEDGER + " select url, status, vehicles_found from ledger where run_id = '2024-01-15'")
def r6(spark, sf):
    return R.results_by_status(_ledger(spark, sf), "2024-01-15").select("url", "status", "vehicles_found")


@query("r7_last_five_runs", LEDGER + " select id, status from refreshed order by id desc limit 5")
def r7(spark, sf):
    return R.last_runs(_refreshed(spark, sf), 5).select("id", "status")


@query("r8_sample", HISTORY + " select dealer_id, vin from st order by dealer_id, vin limit 3")
def r8(spark, sf):
    return R.sample_vehicles(ST.state_of(_history(spark, sf)), ["dealer_id", "vin"]).select("dealer_id", "vin")


@query("r9_export", HISTORY + " select vin, cast(null as int) as year, make, cast(null as varchar) as model, mileage, stock_number, price from st")
def r9(spark, sf):
    return R.export_rows(ST.state_of(_history(spark, sf)))


@query("s6_table_snapshots", "select l_suppkey as dealer_id, count(*) as n from lineitem group by 1")
def s6(spark, sf):
    root = work_folder(spark, "table")
    rows = listings(spark, sf).select("dealer_id", "vin", "run_id")
    SK.write_snapshot(rows.filter("run_id = 'r1'"), root)
    SK.write_snapshot(SK.read_snapshot(spark, root).unionByName(rows.filter("run_id = 'r2'")), root)
    return SK.read_snapshot(spark, root).groupBy("dealer_id").agg(F.count("*").alias("n"))


@query("s6_stored_rows", LISTINGS + " select dealer_id, vin, run_id, source_strategy, ord from li")
def s6b(spark, sf):
    """The rows themselves come back from the newest version, the older one stays readable."""
    root = work_folder(spark, "table")
    rows = listings(spark, sf).select("dealer_id", "vin", "run_id", "source_strategy", "ord")
    first = SK.write_snapshot(rows.filter("run_id = 'r1'"), root)
    SK.write_snapshot(SK.read_snapshot(spark, root, first).unionByName(rows.filter("run_id = 'r2'")), root)
    return SK.read_snapshot(spark, root)


# --- streaming --------------------------------------------------------------------------------
def _message_stream(spark: SparkSession, sf: str, folder: str | None = None) -> DataFrame:
    """``events.parquet``, or the events of a folder, as a message stream; error events are
    broken messages."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    reader = spark.readStream.schema(schema)
    raw = reader.parquet(folder) if folder else reader.option("pathGlobFilter", "events.parquet").parquet(sf)
    day = F.date_format("ts", "yyyy-MM-dd")
    body = F.to_json(F.struct(
        day.alias("runId"), F.expr("'https://d' || user_id || '.example.com'").alias("url"),
        F.lit(40).alias("totalUrls"),
    ))
    value = F.when(F.col("event_type") == "error", "{broken").when(
        F.col("event_type") == "signup", '{"runId": "x"}'
    ).otherwise(body)
    return raw.select(
        value.alias("value"), F.col("event_id").alias("ord"), F.col("ts").cast("timestamp").alias("captured_at"),
        F.col("value").alias("amount"),
    )


def _job(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each message yields one vehicle of its dealer and one ledger row."""
    dealer = F.xxhash64("url")
    vehicles = _as_batch(messages.select(
        dealer.alias("dealer_id"), "run_id", "ord",
        F.concat(F.lit("FX1GB"), F.lpad(F.round(F.col("amount") * 100).cast("bigint").cast("string"), 12, "0")).alias("vin"),
        F.col("amount").alias("price"), F.lit("api").alias("source_strategy"),
    )).withColumn("seen_at", F.to_timestamp("run_id"))
    results = messages.select(
        "run_id", dealer.alias("dealer_id"), "url", F.lit("api").alias("strategy_used"),
        F.lit("ok").alias("status"), F.lit(1).alias("vehicles_found"), F.lit(0).alias("vehicles_new"),
        F.lit(0).alias("vehicles_updated"), F.lit(None).cast("string").alias("reason"), "ord",
    )
    return results, vehicles


BATCHES = 3


def _worked(spark: SparkSession, sf: str, replay: bool = False) -> W.InventoryWorker:
    """The events delivered in three batches, in order."""
    root = work_folder(spark, "stream")
    worker = W.InventoryWorker(spark, root, _job, F.to_timestamp(F.lit("2024-02-01 00:00:00")))
    events = table(spark, sf, "events")
    place = F.floor(F.col("event_id") * BATCHES / F.lit(events.count()))
    for number in range(BATCHES):
        events.filter(place == number).write.mode("append").parquet(f"{root}/source")
        worker.run_available(_message_stream(spark, sf, f"{root}/source"), f"{root}/checkpoint")
    if replay:  # the same messages delivered again, as a second stream of batches
        again = W.InventoryWorker(spark, root, _job, worker.now)
        again.run_available(_message_stream(spark, sf), f"{root}/checkpoint-again")
    return worker


GOOD = f"with g as (select *, {_DAY} as run_id, 'https://d' || cast(user_id as varchar) || '.example.com' as url from events where event_type not in ('error','signup'))"


@query("t1_parse_messages", "select event_type not in ('error','signup') as good, count(*) as n from events group by 1")
def t1(spark, sf):
    root = work_folder(spark, "parsed")
    parsed = W.parse_messages(_message_stream(spark, sf))
    q = parsed.writeStream.format("parquet").option("path", f"{root}/out").option(
        "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out").groupBy("good").agg(F.count("*").alias("n"))


@query("t2_redelivery", GOOD + " select run_id, url, cast(1 as bigint) as n from g group by all")
def t2(spark, sf):
    worker = _worked(spark, sf, replay=True)
    return worker.ledger.read().groupBy("run_id", "url").agg(F.count("*").alias("n"))


@query("t2_dedupe_in_stream", GOOD + " select run_id, url from g group by all")
def t2b(spark, sf):
    root = work_folder(spark, "deduped")
    good = W.parse_messages(_message_stream(spark, sf)).filter("good")
    q = W.dedupe_in_stream(good, delay="2 days").select("run_id", "url").writeStream.format("parquet").option(
        "path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query("t3_incremental_upsert", GOOD + " select url, 'FX1GB' || lpad(cast(cast(round(value*100) as bigint) as varchar),12,'0') as vin, min(run_id) as first_seen_run, max(run_id) as last_seen_run from g group by all")
def t3(spark, sf):
    worker = _worked(spark, sf)
    urls = table(spark, sf, "events").select(F.expr("'https://d' || user_id || '.example.com'").alias("url")).distinct()
    return worker.vehicles.read().drop("url").join(
        urls.withColumn("dealer_id", F.xxhash64("url")), "dealer_id"
    ).select("url", "vin", "first_seen_run", "last_seen_run")


@query("t3_counts_per_run", GOOD + f""", r as (select run_id, url, event_id * {BATCHES} // (select count(*) from events) as part, row_number() over (partition by url, cast(round(value*100) as bigint) order by event_id) as k from g),
  p as (select run_id, url, part, count(*) as n, count(*) filter (where k = 1) as fresh from r group by all)
  select run_id, url, 1 as vehicles_found, cast(fresh as int) as vehicles_new, cast(n - fresh as int) as vehicles_updated from p qualify part = min(part) over (partition by run_id, url)""")
def t3b(spark, sf):
    return _worked(spark, sf).ledger.read().select("run_id", "url", "vehicles_found", "vehicles_new", "vehicles_updated")


@query("t4_incremental_rollup", GOOD + ", r as (select run_id as id, count(distinct url) as n from g group by run_id) select id, 40 as total_urls, cast(n as int) as urls_ok, cast(n as int) as total_vehicles, case when n >= 40 then 'finished' else 'running' end as status from r")
def t4(spark, sf):
    return _worked(spark, sf).runs.read().select("id", "total_urls", "urls_ok", "total_vehicles", "status")
