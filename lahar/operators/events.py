"""Event feeds and their lifecycle: relevance, products, decisions, change logs, lag, latency, licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lahar.functions import geo, text
from lahar.operators import graph
from lahar.operators.ranking import placed

#: Magnitude that triggers, re-dispatch floor in minutes, retry window in hours, review in days.
TRIGGER_MAGNITUDE, REDISPATCH_MIN, RETRY_H, REVIEW_DAYS = 5.5, 15, 6, 90
#: The state machine's allowed transitions.
TRANSITIONS = {
    "detectado": ("preliminar", "publicado", "degradado", "descartado"),
    "preliminar": ("preliminar", "publicado", "degradado", "descartado"),
    "publicado": ("publicado", "degradado", "descartado"),
    "degradado": ("preliminar", "publicado", "descartado"),
    "descartado": (),
}
#: Alert levels that are passed on.
ALERTS = ("green", "yellow", "orange", "red")
#: The buckets of accepted licences: 0 free, 1 share-alike, 2 non-commercial.
LICENCES = (
    ("public-domain-usgov", 0),
    ("public-domain", 0),
    ("CC0-1.0", 0),
    ("CC-BY-4.0", 0),
    ("EC-reuse-attribution", 0),
    ("CC-BY-IGO", 0),
    ("gov-open-co", 0),
    ("ODbL-1.0", 1),
    ("CC-BY-SA-4.0", 1),
    ("CC-BY-NC-4.0", 2),
    ("CC-BY-NC-SA-4.0", 2),
)
#: Without a readable time of detection, so many attempts stand for the retry window: one each five minutes.
MOST_ATTEMPTS = RETRY_H * 60 // 5


def _micros(stamp: Column) -> Column:
    """Stamps without a zone are UTC, as the session's zone is."""
    return F.unix_micros(stamp.cast("timestamp"))


def irrelevance(kind: Column, magnitude: Column, lon: Column, lat: Column, least: float = TRIGGER_MAGNITUDE) -> Column:
    """The first reason for which an event is not ours; null if it is."""
    return (
        F.when(F.coalesce(kind, F.lit("")) != "earthquake", "not an earthquake")
        .when(magnitude.isNull() | (magnitude < least), "too small")
        .when(~F.coalesce(geo.in_box(lon, lat, *geo.REGION), F.lit(False)), "outside the region")
    )


def only_too_small(kind: Column, magnitude: Column, lon: Column, lat: Column) -> Column:
    """Events that would count at any magnitude."""
    return irrelevance(kind, magnitude, lon, lat).isNotNull() & irrelevance(kind, magnitude, lon, lat, 0.0).isNull()


def preferred_products(versions: DataFrame) -> DataFrame:
    """Per event: without deletions, the contributor of most weight (ties by name), of it the newest update."""
    live = versions.where("status <> 'DELETE'")
    best = live.groupBy("event").agg(F.min(F.struct((-F.col("weight")).alias("w"), F.col("contributor"))).alias("b"))
    own = live.join(best, "event").where(F.col("contributor") == F.col("b.contributor"))
    last = own.groupBy("event").agg(F.max_by(F.struct("contributor", "weight", "version", "updated"), F.struct("updated", "version")).alias("p"))
    return last.select("event", "p.*")


def preferred_revisions(states: DataFrame, versions: DataFrame, now: Column, days: int = REVIEW_DAYS) -> DataFrame:
    """late_revisions() against the preferred product of each event: deleted versions and weaker contributors don't count."""
    return late_revisions(states, preferred_products(versions).select("event", "contributor", "version"), now, days)


def version_changed(old_by: Column, old: Column, new_by: Column, new: Column) -> Column:
    """A change of contributor, else a higher number; number zero is no product."""
    return (new > 0) & ((F.coalesce(old_by, F.lit("")) != F.coalesce(new_by, F.lit(""))) | (new > F.coalesce(old, F.lit(0))))


def first_content(contents: Column, *keys: str) -> Column:
    """The first of several keys that a content map holds."""
    return F.coalesce(*[F.element_at(contents, k) for k in keys])


def known_alert(alert: Column) -> Column:
    """Alert levels pass as they are written, anything else is blank."""
    return F.when(alert.isin(*ALERTS), alert).otherwise("")


def decide(has_product: Column, changed: Column, discarded: Column, age_hours: Column, attempts: Column, force: Column) -> Column:
    """omit, full, preliminary or exhausted. changed: the live product is not the one processed last.

    Force reaches discarded events too, but never without a product. Without one, an event is preliminary until its
    retry window is over, also where it was published before.
    """
    over = F.coalesce(age_hours >= RETRY_H, attempts >= MOST_ATTEMPTS)
    return (
        F.when(force & has_product, "full")
        .when(discarded, "omit")
        .when(~has_product, F.when(over, "exhausted").otherwise("preliminary"))
        .when(changed, "full")
        .otherwise("omit")
    )


def may_dispatch(last: Column, now: Column) -> Column:
    """No dispatch is on record or it is long enough ago."""
    return last.isNull() | (_micros(now) - _micros(last) >= REDISPATCH_MIN * 60_000_000)


def allowed(old: Column, new: Column) -> Column:
    table = F.create_map(*[x for k, v in TRANSITIONS.items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v]).cast("array<string>"))])
    return F.coalesce(F.array_contains(F.element_at(table, old), new), F.lit(False))


def by_any_id(events: DataFrame, states: DataFrame) -> DataFrame:
    """Each event with the state that any of its ids names; the id that comes first decides."""
    ids = events.select("event", F.posexplode("ids").alias("place", "known_id"))
    hits = ids.join(states, "known_id").groupBy("event").agg(F.min_by("state", F.struct("place", "known_id")).alias("state"))
    return events.select("event").join(hits, "event", "left")


def late_revisions(states: DataFrame, live: DataFrame, now: Column, days: int = REVIEW_DAYS) -> DataFrame:
    """Events of at most that many days ago whose live product is not the one processed last, by contributor and number.

    states: event, origin, contributor, version; live: event, contributor, version. Undated events are not reviewed.
    """
    recent = states.where(F.col("origin").isNotNull() & (F.col("origin") >= now - F.make_interval(days=F.lit(days))))
    found = live.select("event", F.col("contributor").alias("live_by"), F.col("version").alias("live_version"))
    both = recent.join(found, "event")
    changed = version_changed(F.col("contributor"), F.col("version"), F.col("live_by"), F.col("live_version"))
    return both.where(changed).select("event", F.concat_ws(" ", "contributor", "version").alias("before"), F.concat_ws(" ", "live_by", "live_version").alias("after"))


SOLUTION = ("mag", "depth", "lon", "lat", "people")


def _changes() -> list[Column]:
    """What differs between a solution and the one before it, whose columns begin with o_; null where nothing does."""
    moved = geo.haversine_km(F.col("o_lon"), F.col("o_lat"), F.col("lon"), F.col("lat"))
    before, after = text.prose(F.col("o_people")), text.prose(F.col("people"))
    lines = [
        (F.round(F.abs(F.col("mag") - F.col("o_mag")), 6) >= 0.05, "magnitude"),
        (F.round(F.abs(F.col("depth") - F.col("o_depth")), 6) >= 0.5, "depth"),
        (moved >= 1, "epicentre"),
        (before != after, "people"),
    ]
    return [F.when(cond, F.lit(name)) for cond, name in lines]


def change_log(old: DataFrame, new: DataFrame) -> DataFrame:
    """Lines of what changed between two solutions of an event: magnitude, depth, epicentre, and figures as printed."""
    both = old.select(F.col("event"), *[F.col(c).alias(f"o_{c}") for c in SOLUTION]).join(new, "event")
    return both.select("event", F.explode(F.array_compact(F.array(*_changes()))).alias("change"))


def accumulated_log(solutions: DataFrame) -> DataFrame:
    """(event, place, change): what all solutions of an event changed, newest first, since its contributor last changed.

    solutions: event, seq, contributor, version and the columns of SOLUTION. A version is known by contributor and
    number together, so an equal number of another contributor is a change. A solution without a contributor is no
    change of contributor; it goes on under the last one known. Each step tells its change of version, then of figures.
    """
    w = Window.partitionBy("event").orderBy("seq")
    named = solutions.withColumn("contributor", F.last("contributor", ignorenulls=True).over(w))
    steps = named.select("*", *[F.lag(c).over(w).alias(f"o_{c}") for c in ("seq", "contributor", "version", *SOLUTION)])
    other = F.coalesce(F.col("o_contributor") != F.col("contributor"), F.lit(False))
    steps = steps.withColumn("era", F.sum(other.cast("int")).over(w))
    identity = lambda by, number: F.concat_ws(" ", by, F.concat(F.lit("v"), number))
    version = F.when(other | ~F.col("o_version").eqNullSafe(F.col("version")), F.concat(identity("o_contributor", F.col("o_version")), F.lit(" → "), identity("contributor", F.col("version"))))
    lines = steps.where("o_seq IS NOT NULL").select("event", "seq", "era", F.posexplode(F.array_compact(F.array(version, *_changes()))).alias("at", "change"))
    last = steps.groupBy("event").agg(F.max("era").alias("era"))
    place = F.row_number().over(Window.partitionBy("event").orderBy(F.desc("seq"), "at"))
    return lines.join(last, ["event", "era"]).select("event", place.alias("place"), "change")


def lagging(published: DataFrame, live: DataFrame) -> DataFrame:
    """Reports behind the live product, largest gap first."""
    both = published.join(live, "event", "left").where(F.col("live_version") > F.col("version"))
    return both.select("event", "version", "live_version", (F.col("live_version") - F.col("version")).alias("gap")).orderBy(F.desc("gap"), F.desc("event"))


def latency(minutes: DataFrame, by: list[str]) -> DataFrame:
    """Exact percentiles with linear interpolation, one decimal; null for an empty group."""
    p = lambda q: F.round(F.percentile("minutes", F.lit(q)), 1)
    return minutes.groupBy(*by).agg(F.count("minutes").alias("n"), p(0.5).alias("p50"), p(0.95).alias("p95"), F.round(F.max("minutes"), 1).alias("worst"))


def latency_by_clock(reports: DataFrame) -> DataFrame:
    """(clock, n, p50, p95, worst): minutes to publication since the event's origin, and since its detection.

    reports: origin, detected, published, backtest. Back-tests are left out, as their events were over long before; so
    is, of each clock, a report that lacks the clock's start or its publication, or was published before it.
    """
    live = reports.where(~F.coalesce("backtest", F.lit(False)))
    since = lambda c: F.struct(F.lit(c).alias("clock"), ((_micros(F.col("published")) - _micros(F.col(c))) / 60e6).alias("minutes"))
    rows = live.select(F.explode(F.array(since("origin"), since("detected"))).alias("c")).select("c.*").where("minutes >= 0")
    return latency(rows, ["clock"])


def cadence(beats: DataFrame, longest_h: float = 24.0) -> DataFrame:
    """Minutes between heartbeats divided by the polls each stands for; gaps of zero or over a day are left out."""
    w = Window.partitionBy("source").orderBy("ts", "id")
    gap = (_micros(F.col("ts")) - _micros(F.lag("ts").over(w))) / 60e6
    rows = beats.withColumn("gap", gap).where((F.col("gap") > 0) & (F.col("gap") <= longest_h * 60)).withColumn("each", F.col("gap") / F.greatest(F.col("polls"), F.lit(1)))
    return rows.groupBy("source").agg(F.count("*").alias("n"), *[F.round(F.percentile("each", F.lit(q)), 1).alias(f"p{int(q * 100)}") for q in (0.5, 0.9)], F.round(F.max("each"), 1).alias("worst"))


def islands(rows: DataFrame, by: list[Column], is_header: Column, cut) -> DataFrame:
    """Numbers runs that begin where a header follows a line that is none.

    Rows are dealt by range and written where lost executors don't matter; a run's number is that within a part, plus
    the runs that began in the parts before. The window over parts has a row for each of them.
    """
    dealt = cut(rows.withColumn("_head", is_header).repartitionByRange(*by).withColumn("_part", F.spark_partition_id()))
    own = Window.partitionBy("_part").orderBy(*by)
    last = dealt.groupBy("_part").agg(F.max_by("_head", F.struct(*by)).alias("_last")).select("_part", "_last")
    across = last.select("_part", F.lag("_last").over(Window.orderBy("_part")).alias("_before"))
    began = dealt.join(F.broadcast(across), "_part").withColumn("_lag", F.coalesce(F.lag("_head").over(own), "_before", F.lit(False)))
    began = began.withColumn("_start", (F.col("_head") & ~F.col("_lag")).cast("int"))
    earlier = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = began.groupBy("_part").agg(F.sum("_start").alias("_n")).select("_part", earlier.alias("_runs"))
    placed = began.join(F.broadcast(offsets), "_part")
    run = F.sum("_start").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("_runs")
    return placed.withColumn("run", run).drop("_head", "_part", "_before", "_lag", "_start", "_runs")


def recent_first(rows: DataFrame, now: Column, days: int, stamp: str) -> DataFrame:
    """Rows with a readable stamp of at most that many days ago, newest first."""
    return rows.where(F.col(stamp).isNotNull() & (F.col(stamp) >= now - F.make_interval(days=F.lit(days)))).orderBy(F.desc(stamp), "id")


def upserted(old: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """Union by key; the higher version wins, and the new side at a tie."""
    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    cols = [c for c in old.columns if c != key]
    return both.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(version, "_side")).alias("r")).select(key, "r.*")


def resolved(known: DataFrame | None, feed: DataFrame, cut) -> DataFrame:
    """(alias, event): what known held, and every alias of a poll, with rows that share any alias in one event.

    feed: ids, all aliases of a row; null and blank ones are left out. An event is named by its smallest alias. Only
    events that the poll names go through components: the rest of known passes as it is. Polling again changes nothing.
    """
    rows = feed.select(F.filter("ids", lambda i: i.isNotNull() & (F.trim(i) != "")).alias("ids")).where(F.size("ids") > 0)
    links = rows.select(F.element_at("ids", 1).alias("first"), F.explode("ids").alias("alias")).distinct()
    if known is not None:
        event = known.select(F.col("alias").alias("at"), "event")
        named = lambda df, c: df.join(event, F.col(c) == F.col("at"), "left").withColumn(c, F.coalesce("event", c)).drop("at", "event")
        edges = named(named(links.withColumn("own", F.col("alias")), "first"), "alias")
    else:
        edges = links.withColumn("own", F.col("alias"))
    edges = cut(edges)
    roots = cut(graph.components(edges.select(F.col("first").alias("x"), F.col("alias").alias("y")), cut))
    new = edges.join(roots, F.col("alias") == F.col("node")).select(F.col("own").alias("alias"), F.col("root").alias("event")).distinct()
    if known is None:
        return cut(new)
    moved = known.join(roots, F.col("event") == F.col("node"), "left").select("alias", F.coalesce("root", "event").alias("event"))
    return cut(moved.unionByName(new.join(known, "alias", "left_anti")))


def licence_bucket(sources: DataFrame, spark) -> DataFrame:
    """The strictest licence of each asset's sources; an unknown one is stricter than all."""
    dim = spark.createDataFrame(list(LICENCES), "license string, severity int")
    both = sources.join(F.broadcast(dim), "license", "left").withColumn("severity", F.coalesce("severity", F.lit(9)))
    return both.groupBy("asset").agg(F.max("severity").alias("severity"), F.max_by("license", F.struct("severity", "license")).alias("license"))


def licence_lint(sources: DataFrame, spark) -> DataFrame:
    """Findings by source: unknown licence, non-commercial, floating vintage; and assets that mix share-alike licences."""
    dim = spark.createDataFrame(list(LICENCES), "license string, severity int")
    both = sources.join(F.broadcast(dim), "license", "left")
    found = F.array_compact(F.array(F.when(F.col("severity").isNull(), "unknown licence"), F.when(F.col("severity") == 2, "non-commercial"), F.when(F.lower("vintage").isin("latest", "current"), "floating vintage")))
    single = both.select("asset", "source", F.explode(found).alias("finding"))
    mixed = both.where("severity = 1").groupBy("asset").agg(F.countDistinct("license").alias("n")).where("n > 1").select("asset", F.lit(None).cast("string").alias("source"), F.lit("incompatible share-alike").alias("finding"))
    return single.unionByName(mixed)


def damage_gate(precision: Column, recall: Column, least: float = 0.75) -> Column:
    return F.when((precision >= least) & (recall >= least), "publish").otherwise("hold")


def publication_bucket(precision: Column, recall: Column, lineage: Column, least: float = 0.75) -> Column:
    """Where a damage map goes that passes the gate: by the lineage of its model's weights, nc/ or core/; else null."""
    return F.when(damage_gate(precision, recall, least) == "publish", F.when(lineage == "nc", "nc/").otherwise("core/"))


PRODUCTS = ("shake", "ground")


def report_lag(reports: DataFrame, live: DataFrame, manifests: DataFrame) -> DataFrame:
    """(event, outcome, behind, shake_gap, ground_gap) of every published report.

    reports: event, country, manifest, and for each product its contributor (shake_by) and number (shake); live: event
    and the same of the products served now; manifests: country, current. What can't be asked, an event that live
    doesn't have or a manifest's country without a current one, is 'unknown', never up to date. A report that names no
    manifest isn't behind one. A product that is served no more makes a report 'gone', which no new run mends;
    otherwise it is 'behind' or 'current'. behind lists what moved.
    """
    names = [c for p in PRODUCTS for c in (p, f"{p}_by")]
    served = live.select("event", F.lit(True).alias("_asked"), *[F.col(c).alias(f"live_{c}") for c in names])
    both = reports.join(served, "event", "left").join(manifests.select("country", "current"), "country", "left")
    old, new = lambda p: F.coalesce(F.col(p), F.lit(0)), lambda p: F.coalesce(F.col(f"live_{p}"), F.lit(0))
    named = F.coalesce("manifest", F.lit("")) != ""
    moved = {p: version_changed(F.col(f"{p}_by"), old(p), F.col(f"live_{p}_by"), new(p)) for p in PRODUCTS}
    moved["manifest"] = named & (F.col("manifest") != F.col("current"))
    gone = (old("shake") > 0) & (new("shake") == 0) | (old("ground") > 0) & (new("ground") == 0)
    unknown = F.col("_asked").isNull() | named & F.col("current").isNull()
    behind = F.when(~unknown, F.array_compact(F.array(*[F.when(m, n) for n, m in moved.items()])))
    outcome = F.when(unknown, "unknown").when(gone, "gone").when(F.size(behind) > 0, "behind").otherwise("current")
    return both.select("event", outcome.alias("outcome"), F.array_join(behind, ",").alias("behind"), *[F.when(~unknown, new(p) - old(p)).alias(f"{p}_gap") for p in PRODUCTS])


def review_queue(states: DataFrame, now: Column, days: int = REVIEW_DAYS) -> DataFrame:
    """Events to look at again, newest origin first: not discarded, dated, and at most that many days old."""
    dated = states.where((F.col("state") != "descartado") & F.col("origin").isNotNull())
    return dated.where(F.col("origin") >= now - F.make_interval(days=F.lit(days))).orderBy(F.desc("origin"), "event")


#: How a list of events can be sorted; without a figure an event counts as zero, without a date it comes last.
ORDERS = {
    "date": lambda: F.desc_nulls_last("origin"),
    "magnitude": lambda: F.desc(F.coalesce("mag", F.lit(0.0))),
    "people": lambda: F.desc(F.coalesce("people", F.lit(0.0))),
}


def listed(rows: DataFrame, mode: str, cut) -> DataFrame:
    """Events with their place in the order chosen, ties by event."""
    return placed(rows, [ORDERS[mode](), F.col("event")], "place", cut)


def coverage(manifests: DataFrame) -> DataFrame:
    """(country, built, measured, reference, deviation_pct): a country is built if people were measured.

    The deviation is null where one of the figures is missing or zero: unmeasured is not zero.
    """
    m, r = F.coalesce("measured", F.lit(0)), F.coalesce("reference", F.lit(0))
    off = F.when((m != 0) & (r != 0), F.round((m - r) * F.lit(100.0) / r, 2))
    return manifests.select("country", (m > 0).alias("built"), m.alias("measured"), r.alias("reference"), off.alias("deviation_pct"))


def coverage_summary(covered: DataFrame) -> DataFrame:
    """Countries, those built, people in the grid, and the worst absolute deviation of a built country."""
    built = lambda v: F.when(F.col("built"), v)
    worst = F.max(built(F.abs("deviation_pct"))).alias("worst_pct")
    return covered.agg(F.count("*").alias("countries"), F.count_if("built").alias("built"), F.coalesce(F.sum(built(F.col("measured"))), F.lit(0)).alias("people"), worst)


def catalogue(reports: DataFrame, bands: tuple[str, ...]) -> DataFrame:
    """Reports, live and back-tests, countries that are named, and of each band the reports without anybody in it."""
    back = F.coalesce("backtest", F.lit(False))
    none = [F.count_if(F.coalesce(b, F.lit(0)) == 0).alias(f"none_{b}") for b in bands]
    return reports.agg(F.count("*").alias("reports"), F.count_if(~back).alias("live"), F.count_if(back).alias("backtests"), F.count_distinct(F.nullif("country", F.lit(""))).alias("countries"), *none)
