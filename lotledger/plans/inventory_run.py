"""One whole run: seeds and captures to dealers, vehicles, ledger rows and run totals.

Layers run from cheap to costly. Each layer writes its vehicles and, in the same step, what it
tried: one row per dealer nobody had solved before it. The next layer only reads the captures
of dealers that are still open, so a costly parse never runs for a dealer a cheap one has
covered, and the ledger says what happened, not only who won.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as V
from ..functions import urls as U
from ..operators import cards as CA
from ..operators import cascade as K
from ..operators import classify as C
from ..operators import frontier as FR
from ..operators import jsonmine as JM
from ..operators import normalize as N
from ..operators import state as ST
from ..operators.keyed import beside, first_by, top_per_group
from ..schemas import VEHICLE_COLUMNS
from ..session import work_folder
from ..sources.captures import html_pages, json_responses, of_dealers
from ..sources import sinks as SK
from ..streaming import worker as W

_PLACE = ["page_ord", "card_ord"]
_COLUMNS = [*K.OWNER, *_PLACE, "strategy", "prio", *VEHICLE_COLUMNS]
# How a capture was fetched, as numbers of ``attempt``: a layer reads all up to its own.
PLAIN, BROWSER, UNLOCKED, REMOTE = 1, 2, 3, 4


def _up_to(captures: DataFrame, attempt: int, beyond: int = 0) -> DataFrame:
    return captures.filter((F.col("attempt") <= attempt) & (F.col("attempt") > beyond))


def _parsed_once(vehicles: DataFrame) -> DataFrame:
    """Vehicles as a written table: ``cascade.first_hit`` reads them twice, and would parse
    all pages as often."""
    path = work_folder(vehicles.sparkSession, "parsed")
    vehicles.write.parquet(path)
    return vehicles.sparkSession.read.schema(vehicles.schema).parquet(path)


def _generic(vehicles: DataFrame, most: int | None) -> DataFrame:
    """Dedupe, keep the first page that has vehicles, at most ``most`` per dealer."""
    unique = _parsed_once(N.dedupe_vehicles(vehicles, [*K.OWNER, "page_ord"], _PLACE))
    return N.cap_vehicles(K.first_hit(unique, "page_ord", ["card_ord"]), K.OWNER, _PLACE, most)


def _named(vehicles: DataFrame, strategy: Column) -> DataFrame:
    named = vehicles.withColumn("strategy", strategy)
    return named.withColumn("prio", K.priority(F.col("strategy"))).select(_COLUMNS)


class Layers:
    """The six layers, each from open captures to vehicles.

    ``most`` vehicles per dealer come from the generic layers, from arrays down to ``depth``
    and members down to ``levels``; all without a number. ``answers`` are replies of a model
    (``dealer_url, text``), if there are any.
    """

    def __init__(self, run_year: int, most: int | None, depth: int | None, levels: int | None,
                 answers: DataFrame | None, fetched: set[int]):
        self.run_year, self.most, self.depth, self.levels, self.answers = run_year, most, depth, levels, answers
        self.fetched = fetched  # the attempts there are: steps over others are left out of the plan
        self.keep = [*K.OWNER, "page_ord"]

    def _any(self, attempt: int, beyond: int) -> bool:
        return any(beyond < a <= attempt for a in self.fetched)

    def _mined(self, records: DataFrame) -> DataFrame:
        df = records.withColumnRenamed("ord", "card_ord").withColumn("origin", U.origin(F.col("dealer_url")))
        return N.normalize_vehicles(df, run_year=self.run_year, levels=self.levels)

    def _responses(self, caps: DataFrame) -> DataFrame:
        return self._mined(JM.response_records(json_responses(caps), self.keep, self.depth))

    def _embedded(self, caps: DataFrame) -> DataFrame:
        return self._mined(JM.embedded_records(html_pages(caps), self.keep, self.depth))

    def _wide(self, caps: DataFrame) -> DataFrame:
        return CA.cards_to_vehicles(CA.wide_cards(html_pages(caps)), self.run_year)

    def platform(self, caps: DataFrame) -> DataFrame:
        """The extractor of the seed's label."""
        found = CA.platform_vehicles(caps, self.run_year, self.depth)
        return _named(found, F.concat(F.lit("platform:"), F.col("platform")))

    def api(self, caps: DataFrame) -> DataFrame:
        return _named(_generic(self._responses(_up_to(caps, PLAIN)), self.most), F.lit("api"))

    def embedded(self, caps: DataFrame) -> DataFrame:
        return _named(_generic(self._embedded(_up_to(caps, PLAIN)), self.most), F.lit("embedded"))

    def navigate(self, caps: DataFrame) -> DataFrame:
        """What the browser received, else what its pages embed, else the cards they show."""
        columns = [*K.OWNER, *_PLACE, *VEHICLE_COLUMNS]
        steps = [CA.cards_to_vehicles(CA.generic_cards(html_pages(_up_to(caps, BROWSER))), self.run_year)]
        if self._any(BROWSER, PLAIN):
            rendered = _up_to(caps, BROWSER, PLAIN)
            steps = [self._responses(rendered), self._embedded(rendered), *steps]
        every = reduce(DataFrame.unionByName, [
            N.dedupe_vehicles(step, K.OWNER, _PLACE).select(columns).withColumn("_step", F.lit(i))
            for i, step in enumerate(steps)
        ])
        kept = K.first_hit(_parsed_once(every), "_step", _PLACE) if len(steps) > 1 else every
        return _named(N.cap_vehicles(kept, K.OWNER, _PLACE, self.most), F.lit("navigate"))

    def unlocked(self, caps: DataFrame) -> DataFrame:
        """Embedded vehicles and wide cards of all pages; for dealers without any whose pages
        look like an application, what its rendered pages received and show."""
        columns = [*K.OWNER, *_PLACE, *VEHICLE_COLUMNS]
        pages = _up_to(caps, UNLOCKED)
        found = self._wide(pages).select(columns)
        if self._any(UNLOCKED, PLAIN):
            found = CA.merge_wide_path(self._embedded(_up_to(pages, UNLOCKED, PLAIN)).select(columns), found)
        if self._any(REMOTE, UNLOCKED):
            spa = C.spa_likelihood(html_pages(pages)).filter("spa_likely").select("dealer_url")
            late = _up_to(caps, REMOTE, UNLOCKED).join(spa, "dealer_url", "left_semi")
            merged = CA.merge_rendered(*[
                _with_base(part.select(columns), late) for part in (self._responses(late), self._wide(late))
            ])
            both = found.select(columns).withColumn("_step", F.lit(0)).unionByName(
                merged.select(columns).withColumn("_step", F.lit(1))
            )
            found = K.first_hit(_parsed_once(both), "_step", _PLACE)
        return _named(N.dedupe_vehicles(found.select(columns), K.OWNER, _PLACE), F.lit("unlocked"))

    def ai(self, caps: DataFrame) -> DataFrame:
        """Vehicles of the model's replies."""
        owners = caps.select(*K.OWNER).distinct()
        records = JM.answer_records(self.answers).join(owners, "dealer_url").withColumn("page_ord", F.lit(0))
        found = self._mined(records)
        return _named(N.dedupe_vehicles(found, K.OWNER, _PLACE), F.lit("ai"))

    def steps(self) -> list[tuple[str, Callable[[DataFrame], DataFrame]]]:
        named = [("platform", self.platform), ("api", self.api), ("embedded", self.embedded),
                 ("navigate", self.navigate), ("unlocked", self.unlocked)]
        return named if self.answers is None else [*named, ("ai", self.ai)]


def _with_base(vehicles: DataFrame, captures: DataFrame) -> DataFrame:
    """The place of the base a page belongs to: its URL without the page number."""
    base = F.regexp_replace("page_url", r"[?&]page=\d+", "")
    pages = captures.groupBy(*K.OWNER, base.alias("_url")).agg(
        F.min("page_ord").alias("base_ord"), F.collect_set("page_ord").alias("page_ord")
    ).select(*K.OWNER, "base_ord", F.explode("page_ord").alias("page_ord"))
    return vehicles.join(pages.groupBy(*K.OWNER, "page_ord").agg(F.min("base_ord").alias("base_ord")), [*K.OWNER, "page_ord"])


def _attempts(layer: str, captures: DataFrame, most: int) -> DataFrame:
    """Per dealer the first ``most`` pages the layer read and what they answered."""
    json = F.lower(F.coalesce("content_type", F.lit(""))).contains("json")
    read = {"api": json, "embedded": ~json}.get(layer, F.lit(True))
    reach = {"api": PLAIN, "embedded": PLAIN, "navigate": BROWSER}.get(layer, REMOTE)
    said = F.concat("page_url", F.when(F.col("error").isNotNull(), F.concat(F.lit(" -> error: "), "error")).otherwise(
        F.concat(F.lit(" -> HTTP "), F.coalesce(F.col("status").cast("string"), F.lit("?")))
    ))
    pages = captures.filter(read & (F.col("attempt") <= reach)).select(*K.OWNER, "page_ord", "attempt", said.alias("said"))
    first = top_per_group(pages, K.OWNER, ["page_ord", "attempt", "said"], most)
    listed = F.sort_array(F.collect_list(F.struct("page_ord", "attempt", "said")))
    return first.groupBy(*K.OWNER).agg(F.transform(listed, lambda p: p["said"]).alias("attempts"))


def _tried(layer: str, still_open: DataFrame, captures: DataFrame, found: DataFrame, attempts: int) -> DataFrame:
    """The layer's row per dealer it was tried for."""
    strategy = F.lit(layer)
    if layer == "platform":
        still_open = still_open.filter(CA.extractor_for(F.col("platform")).isNotNull())
        strategy = F.concat(F.lit("platform:"), F.col("platform"))
    hits = found.groupBy(*K.OWNER).agg(F.count("*").alias("n"))
    joined = still_open.join(hits, K.OWNER, "left").join(_attempts(layer, captures, attempts), K.OWNER, "left")
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    return joined.select(*K.OWNER, strategy.alias("strategy"), n.alias("n"), "attempts").select(
        *K.OWNER, "strategy", K.priority(F.col("strategy")).alias("prio"), (F.col("n") > 0).alias("ok"), "n",
        F.when(F.col("n") > 0, F.concat("strategy", F.lit(": "), F.col("n").cast("string")))
        .when(F.col("attempts").isNull(), "no captures").otherwise("no vehicles").alias("reason"),
        F.coalesce("attempts", F.array().cast("array<string>")).alias("attempts"),
    )


def run_cascade(
    spark: SparkSession, targets: DataFrame, captures: DataFrame, answers: DataFrame | None = None,
    run_year: int = 2024, most: int | None = None, depth: int | None = None, levels: int | None = N.MEMBER_LEVELS,
    attempts: int = V.LEDGER_ATTEMPTS,
) -> tuple[DataFrame, DataFrame]:
    """``(vehicles, layers)``: vehicles of each dealer's winning layer, and a row per dealer
    and layer tried, as ``cascade.traces`` takes them.

    ``targets`` is ``run_id, dealer_url, platform``, one row per dealer, captured or not;
    ``captures`` the captures of this run. For the rest see ``Layers``.
    """
    root = work_folder(spark, "layers")
    targets = targets.select(*K.OWNER, "platform")
    captures = captures.drop("platform").join(beside(targets), K.OWNER)
    fetched = {r[0] for r in captures.select("attempt").distinct().collect()}  # a handful of numbers
    vehicles: list[DataFrame] = []
    layers: list[DataFrame] = []
    for name, layer in Layers(run_year, most, depth, levels, answers, fetched).steps():
        left, still_open = captures, targets
        if vehicles:
            solved = reduce(DataFrame.unionByName, vehicles).select(K.OWNER).distinct()
            left, still_open = K.unsolved(captures, solved), targets.join(solved, K.OWNER, "left_anti")
        layer(left).write.parquet(f"{root}/{name}/vehicles")
        found = spark.read.parquet(f"{root}/{name}/vehicles")
        _tried(name, still_open, captures, found, attempts).write.parquet(f"{root}/{name}/tried")
        vehicles.append(found)
        layers.append(spark.read.parquet(f"{root}/{name}/tried"))
    return reduce(DataFrame.unionByName, vehicles), reduce(DataFrame.unionByName, layers)


def run_layers(
    spark: SparkSession, captures: DataFrame, run_year: int = 2024, most: int | None = None, depth: int | None = None
) -> DataFrame:
    """Vehicles of the winning layer of every captured dealer; ``captures`` carries the
    seed's ``platform`` label (or NULL)."""
    targets = captures.groupBy(*K.OWNER).agg(F.min("platform").alias("platform"))
    return run_cascade(spark, targets, captures, run_year=run_year, most=most, depth=depth)[0]


# --- from seeds to tables ------------------------------------------------------------

def as_batch(vehicles: DataFrame, now: Column) -> DataFrame:
    """Winning vehicles as ``state.merge_vehicles`` takes them, in page order."""
    place = F.shiftleft(F.col("page_ord").cast("bigint"), 32) + F.col("card_ord").cast("bigint")
    return vehicles.select(
        F.xxhash64("dealer_url").alias("dealer_id"), *VEHICLE_COLUMNS,
        F.regexp_replace("strategy", "^platform:", "").alias("source_strategy"), "run_id",
        now.alias("seen_at"), place.alias("ord"),
    )


def found_platforms(targets: DataFrame, captures: DataFrame) -> DataFrame:
    """``base_url, platform, prio``: labels an extractor knows, then what a first page shows."""
    known = targets.filter(CA.extractor_for(F.col("platform")).isNotNull()).select(
        F.col("dealer_url").alias("base_url"), "platform", F.lit(0).alias("prio")
    )
    pages = html_pages(_up_to(captures, PLAIN)).select("dealer_url", "page_ord", "capture_id", "body")
    shown = C.with_builder(pages).select("dealer_url", "page_ord", "capture_id", "builder")
    first = first_by(shown, ["dealer_url"], [F.col("page_ord"), F.col("capture_id")])
    return known.unionByName(first.select(F.col("dealer_url").alias("base_url"), F.col("builder").alias("platform"), F.lit(1).alias("prio")))


TABLES = {
    "dealers": W._DEALER_SCHEMA, "runs": W._RUN_TABLE_SCHEMA, "results": W._LEDGER_SCHEMA,
    "vehicles": W._VEHICLE_SCHEMA.split(", batch_rows")[0],
}


def read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The newest version of the four tables; empty ones before the first run."""
    found = {name: SK.read_snapshot(spark, f"{root}/{name}") for name in TABLES}
    return {name: spark.createDataFrame([], TABLES[name]) if df is None else df for name, df in found.items()}


def run_inventory(
    spark: SparkSession, seeds: DataFrame, captures: DataFrame, root: str, run_id: str, now: Column,
    answers: DataFrame | None = None, run_year: int = 2024, **limits: int | None,
) -> DataFrame:
    """A run over ``seeds`` (``ord, url, platform``): the four tables of ``root`` get their next
    version, the ledger rows of the run come back.

    Every distinct seed ends in the ledger: a bad URL and a dealer without captures as failed
    rows. ``captures`` of other runs and dealers are left alone.
    """
    known = read_tables(spark, root)
    seeds = FR.unique_seeds(seeds)
    targets = FR.valid_seeds(seeds).select(F.lit(run_id).alias("run_id"), F.col("url").alias("dealer_url"), "platform")
    mine = captures.filter(F.col("run_id") == run_id)
    vehicles, layers = run_cascade(spark, targets, mine, answers, run_year, **limits)

    # Both are read several times below: written once.
    work = work_folder(spark, "run")
    K.result_rows(layers).unionByName(K.invalid_seed_rows(seeds, run_id)).write.parquet(f"{work}/results")
    merged = ST.merge_vehicles(known["vehicles"], as_batch(vehicles, now), tally=True)
    merged.write.parquet(f"{work}/vehicles")
    results, merged = spark.read.parquet(f"{work}/results"), spark.read.parquet(f"{work}/vehicles")
    results = K.with_upsert_counts(results, ST.upsert_counts_by_run(merged))

    seen = targets.select(
        F.col("dealer_url").alias("base_url"), F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("platform"), now.alias("seen_at"), F.lit(0).alias("ord"),
    )
    dealers = ST.set_platforms(ST.upsert_dealers(known["dealers"], seen), found_platforms(targets, mine))
    fresh = ST.new_results(known["results"], W.ledger_columns(results).withColumn("ord", F.lit(0))).select(W.LEDGER_COLUMNS)
    fresh.write.parquet(f"{work}/fresh")
    fresh = spark.read.parquet(f"{work}/fresh")
    opened = seeds.agg(F.count("*").cast("int").alias("total_urls")).select(
        F.lit(run_id).alias("run_id"), "total_urls", now.alias("seen_at")
    )
    runs = ST.roll_up(known["runs"], opened, ST.result_sums(fresh), now)
    for name, table in (
        ("dealers", dealers), ("vehicles", ST.state_of(merged)),
        ("results", known["results"].unionByName(fresh)), ("runs", runs),
    ):
        SK.write_snapshot(table.select([c.split()[0] for c in TABLES[name].split(", ")]), f"{root}/{name}")
    return fresh


# --- the worker's job -----------------------------------------------------------------

def captured_job(
    spark: SparkSession, captures: str, now: Column, run_year: int = 2024, parts: int = 256
) -> Callable[[DataFrame], tuple[DataFrame, DataFrame]]:
    """The job of a message worker: the cascade over the captures of a batch's dealers.

    ``captures`` is a folder of ``write_by_dealer`` with so many ``parts``: a batch reads those
    of its dealers.
    """

    def job(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
        targets = messages.groupBy("run_id", "url").agg(F.max("platform").alias("platform"))
        good = FR.valid_seeds(targets).withColumnRenamed("url", "dealer_url")
        vehicles, layers = run_cascade(spark, good, of_dealers(spark, captures, good, parts), run_year=run_year)
        results = K.result_rows(layers).unionByName(K.invalid_seed_rows(targets))
        return results.withColumn("ord", F.lit(0)), as_batch(vehicles, now)

    return job


def ledger_rows(vehicles: DataFrame, captures: DataFrame) -> DataFrame:
    """The result row of every captured dealer; without vehicles it is a failed one."""
    counted = vehicles.groupBy(*K.OWNER, "strategy", "prio").agg(F.count("*").alias("n"))
    hits = counted.select(
        *K.OWNER, "strategy", "prio", F.lit(True).alias("ok"), "n",
        F.concat("strategy", F.lit(": "), F.col("n").cast("string")).alias("reason"),
        F.array().cast("array<string>").alias("attempts"),
    )
    lost = captures.select(*K.OWNER).distinct().join(hits.select(*K.OWNER), K.OWNER, "left_anti").select(
        *K.OWNER, F.lit("unlocked").alias("strategy"), F.lit(4).alias("prio"), F.lit(False).alias("ok"),
        F.lit(0).cast("bigint").alias("n"), F.lit("no vehicles").alias("reason"),
        F.array().cast("array<string>").alias("attempts"),
    )
    return K.result_rows(hits.unionByName(lost))
