"""Page classification: blocked pages, publishing platform, cascade layer, triage.

Everything is one pass of expressions over ``captures``; only the distributions and the
choice among a URL's attempts shuffle, and those shuffle labels, never bodies.

Marker chains are bound to the lowered text: it is computed once per page, and a filter
pushed below a label cannot multiply the chain in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed_values as V
from ..functions import markers as M
from ..functions import text as X
from ..functions import urls as U
from . import jsonmine
from .keyed import first_by
from .rows import explode_rows, settle


def _marked(text: Column, markers: str) -> Column:
    return F.coalesce(X.bind(F.lower(text), lambda low: M.has_any(low, markers)), F.lit(False))


def is_blocked(body: Column, status: Column) -> Column:
    """Blocking status, a missing or short page, or a challenge marker."""
    return (
        F.coalesce(status.isin(V.BLOCKED_STATUS), F.lit(False))
        | (F.coalesce(F.length(body), F.lit(0)) < V.MIN_PAGE_CHARS)
        | _marked(body, V.BLOCKED_MARKERS)
    )


def with_blocked(df: DataFrame) -> DataFrame:
    return df.withColumn("blocked", is_blocked(F.col("body"), F.col("status")))


def host_platform(url: Column, cname: Column) -> Column:
    blob = F.lower(F.concat(U.host(url), F.lit(" "), F.coalesce(cname, F.lit(""))))
    return X.bind(blob, lambda low: M.first_label(low, V.HOST_SIGNATURES))


def with_page_platform(
    df: DataFrame, label: str = "page_platform", limit: int | None = None
) -> DataFrame:
    """First page signature that hits, in the whole page or its first ``limit`` characters."""
    text = X.at_most(F.col("body"), limit)
    return df.withColumn(
        label, X.bind(F.lower(text), lambda low: M.first_label(low, V.HTML_SIGNATURES))
    )


def with_builder(df: DataFrame, label: str = "builder") -> DataFrame:
    """Site builder by plain substrings of the lowered page."""

    def chain(low: Column) -> Column:
        return F.coalesce(*[
            F.when(M.has_any(low, "|".join(w.replace(".", r"\.") for w in words)), F.lit(name))
            for words, name in V.BUILDER_MARKERS
        ])

    return df.withColumn(label, X.bind(F.lower("body"), chain))


def _order(captures: DataFrame) -> list[Column]:
    """Page and attempt of a capture; 0 where the table has no such column."""
    return [
        F.col(c) if c in captures.columns else F.lit(0).alias(c) for c in ("page_ord", "attempt")
    ]


def first_capture(labels: DataFrame) -> DataFrame:
    """One row per ``url``: the one of the first page and attempt. Labels, no bodies."""
    return first_by(labels, ["url"], [F.col("page_ord"), F.col("attempt")]).drop("page_ord", "attempt")


def fingerprint(captures: DataFrame, rendered: DataFrame | None = None) -> DataFrame:
    """One row per URL: ``url, platform, via, cname``.

    ``captures`` holds plain captures; of several of one URL the first counts. ``rendered`` holds the rendered
    capture of the URLs that needed one; passing None means no rendering was done.
    """
    first = first_capture(
        captures.withColumn("host_label", host_platform(F.col("dealer_url"), F.col("cname")))
        .transform(with_page_platform, "html_label")
        .select(
            F.col("dealer_url").alias("url"), "cname", "host_label", "html_label",
            (F.col("error").isNotNull() | F.col("status").isNull() | (F.col("status") >= 400))
            .alias("needs_render"),
            *_order(captures),
        )
    )
    if rendered is not None:
        second = first_capture(with_page_platform(rendered, "label").select(
            F.col("dealer_url").alias("url"),
            F.when(F.col("error").isNull(), F.coalesce("label", F.lit(V.LABEL_UNKNOWN))).alias("rendered"),
            *_order(rendered),
        ))
        first = first.join(second, "url", "left")
        render_label = F.coalesce("rendered", F.lit(V.LABEL_UNREACHABLE))
        render_via = F.when(F.col("rendered").isNull(), "browser-error").otherwise("browser")
    else:
        render_label, render_via = F.lit(V.LABEL_CHECK_WITH_BROWSER), F.lit("http")
    # a failed fetch has no page to look at
    platform = F.coalesce(
        "host_label", "html_label",
        F.when(F.col("needs_render"), render_label).otherwise(V.LABEL_UNKNOWN),
    )
    via = (
        F.when(F.col("host_label").isNotNull(), "host/cname")
        .when(F.col("html_label").isNotNull(), "html")
        .when(F.col("needs_render"), render_via)
        .otherwise("http")
    )
    # the CNAME is only reported when the host decided
    cname = F.when(F.col("host_label").isNotNull(), F.nullif("cname", F.lit("")))
    return first.select("url", platform.alias("platform"), via.alias("via"), cname.alias("cname"))


def distribution(df: DataFrame, label: str) -> DataFrame:
    """Count and rounded percent per label, most frequent first."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    # one row per label: the grand total is a window over that short list
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("pct", X.rounded_share(F.col("n"), total)).orderBy(F.desc("n"), label)


def spa_likelihood(captures: DataFrame, least: int = V.SPA_MIN_PAGE_CHARS) -> DataFrame:
    """Per dealer: template markers, many detail links, or one big page. By definition,
    pages of fewer than ``least`` characters say nothing."""
    pages = captures.filter(F.length("body") >= least)
    marks = F.col("body").rlike("(?i)" + V.SPA_MARKERS) | (
        F.regexp_count("body", F.lit("(?i)" + V.DETAIL_LINK)) >= 6
    )
    return pages.groupBy("dealer_url").agg(
        (F.bool_or(marks) | (F.max(F.length("body")) >= V.SPA_BIG_PAGE_CHARS)).alias("spa_likely")
    )


def embedded_signal(body: Column) -> Column:
    """Looser than extraction: typed JSON-LD with a vehicle property, state marker plus
    VIN word, or three VIN keys."""
    state = body.rlike(V.STATE_MARKERS_CASED) & body.rlike("(?i)" + V.STATE_VIN_WORDS)
    many = F.regexp_count(body, F.lit(r'(?i)"vin"\s*:')) >= 3
    return F.coalesce(jsonmine.ld_inventory_signal(body) | state | many, F.lit(False))


def api_signal(body: Column, limit: int | None = None) -> Column:
    text = X.at_most(body, limit)
    return F.coalesce(
        text.rlike(r"^\s*[\[{]") & (F.regexp_count(text, F.lit(r'(?i)"vin"\s*:')) >= 2),
        F.lit(False),
    )


def api_answers(json_captures: DataFrame) -> DataFrame:
    """URLs with at least one JSON capture that looks like an inventory answer."""
    return (
        json_captures.filter((F.col("status") < 400) & api_signal(F.col("body")))
        .select(F.col("dealer_url").alias("url"))
        .distinct()
        .withColumn("has_api", F.lit(True))
    )


def cascade_layers(
    platform_map: DataFrame, captures: DataFrame, json_captures: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """``url, platform, layer``: the layer that would solve each dealer, one row per row of
    the map. Of several captures of a URL the first counts; a URL without a capture is
    ``sin_captura`` unless its label alone decides."""
    seen = first_capture(
        captures.withColumn("_body", X.at_most(F.col("body"), limit))
        .select(
            F.col("dealer_url").alias("url"), "status", "error",
            _marked(F.col("_body"), V.CHALLENGE_MARKERS).alias("challenge"),
            _marked(F.col("_body"), V.PARKED_MARKERS).alias("parked"),
            embedded_signal(F.col("_body")).alias("embedded"),
            F.lit(True).alias("captured"), *_order(captures),
        )
    )
    joined = platform_map.join(seen, "url", "left")
    if json_captures is None:
        joined = joined.withColumn("has_api", F.lit(False))
    else:
        joined = joined.join(api_answers(json_captures), "url", "left")
    label, error = F.col("platform"), F.col("error")
    dead = F.when(error == "timeout", "recuperable").otherwise("descartado")
    probed = (
        F.when(F.col("captured").isNull(), "sin_captura")
        .when(error.isNotNull(), dead)
        .when(F.col("status").isin(V.BLOCKED_STATUS) | F.col("challenge"), "antibot")
        .when(F.col("parked"), "descartado")
        .when(F.col("embedded"), "L2_embebido")
        .when(F.col("has_api"), "L1_api")
        .otherwise("L3_navegacion")
    )
    again = F.when(F.col("captured").isNull(), "sin_captura").when(error.isNotNull(), dead).when(F.col("status") >= 400, "antibot").otherwise("recuperable")
    layer = (
        F.when(label.isin(V.READY_LABELS), "L0_extractor")
        .when(label.isin(V.KNOWN_PENDING_LABELS), "L0_pendiente")
        .when(label == V.LABEL_PARKED, "descartado")
        .when(label == V.LABEL_UNREACHABLE, again)
        .otherwise(probed)
    )
    return joined.select("url", "platform", layer.alias("layer"))


def layer_distribution(layers: DataFrame) -> DataFrame:
    """Counts in the fixed layer order, unlisted layers last."""
    order = F.coalesce(
        *[F.when(F.col("layer") == name, F.lit(i)) for i, name in enumerate(V.LAYER_ORDER)],
        F.lit(len(V.LAYER_ORDER)),
    )
    counts = layers.groupBy("layer").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return (
        counts.withColumns({"ord": order, "pct": X.rounded_share(F.col("n"), total)})
        .orderBy("ord", "layer")
    )


def relabel_blocked(
    platform_map: DataFrame, attempts: DataFrame, max_attempts: int | None = None
) -> DataFrame:
    """Blocked rows of the map take the label of a newer capture.

    The first attempt with a real label wins; else the last attempt decides. Attempts
    after ``max_attempts`` are not looked at, where that is given. Attempts are labelled
    where they lie; only labels are joined.
    """
    targets = platform_map.filter(F.col("platform").isin(V.BLOCKED_LABELS)).select("url")
    labelled = attempts if max_attempts is None else attempts.filter(F.col("attempt") <= max_attempts)
    labelled = settle(labelled.transform(with_page_platform, "label"), ["dealer_url", "attempt"], {
        "label": F.col("label"),
        "_usable": F.coalesce(F.length("body"), F.lit(0)) > V.MIN_PAGE_CHARS,
    })
    tried = labelled.join(targets.withColumnRenamed("url", "dealer_url"), "dealer_url", "left_semi")
    real = F.col("_usable") & F.col("label").isNotNull() & ~F.col("label").isin(V.INCONCLUSIVE_LABELS)
    usable = F.when(F.col("_usable"), F.coalesce("label", F.lit(V.LABEL_UNKNOWN)))
    last = F.struct("attempt", usable.alias("label"))
    outcome = tried.groupBy(F.col("dealer_url").alias("url")).agg(
        F.min(F.when(real, F.struct("attempt", "label"))).alias("hit"), F.max(last).alias("last")
    ).select("url", F.coalesce("hit.label", "last.label").alias("found"))
    joined = platform_map.join(outcome, "url", "left")
    blocked = F.col("platform").isin(V.BLOCKED_LABELS)
    return joined.select(
        "url",
        F.when(blocked, F.coalesce("found", F.lit(V.LABEL_UNREACHABLE)))
        .otherwise(F.col("platform")).alias("platform"),
        F.when(blocked, "web-unlocker").otherwise(F.col("via")).alias("via"),
        "cname",
        F.col("platform").alias("was"),
    )


def recovery_stats(relabelled: DataFrame) -> DataFrame:
    targets = relabelled.filter(F.col("was").isin(V.BLOCKED_LABELS))
    return targets.agg(
        F.count_if(~F.col("platform").isin(V.INCONCLUSIVE_LABELS)).alias("recovered"),
        F.count("*").alias("targets"),
    )


def rendered_triage(captures: DataFrame) -> DataFrame:
    """Rendered pages: still blocked, vehicles visible, or no signal."""
    blocked = is_blocked(F.col("body"), F.col("status")) | F.col("error").isNotNull()
    vehicles = F.col("body").rlike(V.VIN_IN_TEXT) | _marked(F.col("body"), V.RENDERED_VEHICLE_MARKERS)
    return captures.select(
        F.col("dealer_url").alias("url"),
        F.when(blocked, "antibot_real").when(vehicles, "L3_navegacion")
        .otherwise("L3_sin_senal").alias("layer2"),
    )


def vendor_mentions(captures: DataFrame) -> DataFrame:
    """``capture_id, vendor``: outside domains a page links to, and its generator."""
    hosts = F.regexp_extract_all(
        "body", F.lit(r"""(?i)\s(?:src|href)\s*=\s*["']?https?://([a-z0-9.-]+)"""), F.lit(1)
    )
    domains = F.filter(
        F.array_distinct(F.transform(hosts, lambda h: F.substring_index(F.lower(h), ".", -2))),
        lambda d: ~d.rlike(V.VENDOR_NOISE),
    )
    tag = F.regexp_extract("body", r"""(?i)<meta\b[^>]*\bname\s*=\s*["']?generator\b[^>]*>""", 0)
    content = X.first_match(tag, r"""(?i)\bcontent\s*=\s*["']([^"']*)["']""")
    generator = F.concat(F.lit("gen:"), F.get(F.split(content, r"[\s\d]"), 0))
    names = F.concat(domains, F.array_compact(F.array(generator)))
    return explode_rows(captures, ["capture_id"], names, "_i", "vendor").drop("_i")


def vendor_tally(captures: DataFrame) -> DataFrame:
    return vendor_mentions(captures).groupBy("vendor").agg(F.count("*").alias("n"))


def top_vendors(tally: DataFrame, k: int = 40) -> DataFrame:
    return tally.orderBy(F.desc("n"), "vendor").limit(k)


def visible_vins(body: Column) -> Column:
    """Distinct 17-character VINs that hold a digit and a letter."""
    found = F.regexp_extract_all(body, F.lit(V.VIN_IN_TEXT), F.lit(0))
    return F.array_distinct(F.filter(found, lambda v: v.rlike("[0-9]") & v.rlike("[A-Z]")))


def clean_html(body: Column, limit: int | None = None) -> Column:
    """Text and links only; at most ``limit`` characters where that is given."""
    out = body
    for pattern in (
        r"(?is)<script.*?</script>", r"(?is)<style.*?</style>", r"(?is)<svg.*?</svg>",
        r"(?s)<!--.*?-->", r"<(?!a\s|/a)[^>]+>",
    ):
        out = F.regexp_replace(out, pattern, " ")
    out = F.regexp_replace(out, r"(?U)\s{2,}", " ")
    return X.at_most(F.btrim(out, F.lit(X.SCRIPT_BLANKS)), limit)


def seed_tag(label: Column) -> Column:
    """Label to routing tag; labels without an extractor have none."""
    return F.when(label.isin(V.SEED_TAGS), label)
