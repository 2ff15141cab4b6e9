"""Registered queries: each operator over the bridged test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from logtally import bridge
from logtally.functions.values import kst_day, round_to, rows, to_kst
from logtally.operators import connections, dimensions, drilldown, metrics
from logtally.operators.audit_view import audit_v
from logtally.operators.id_gaps import id_gaps
from logtally.plans import checks, ingest, publish, recipes, reconcile, rollup, series, share, stream
from logtally.sources import archive, files
from logtally.sources.store import Store

AS_OF = bridge.AS_OF

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Days and wall clocks as text, so that every engine compares them alike."""
    clocks = (T.DateType, T.TimestampNTZType)
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, clocks)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _register(name: str) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        REGISTRY[name] = lambda spark, sf_dir: _plain(query(spark, sf_dir))
        return query

    return keep


def _v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.store(spark, sf_dir).audit_v()


def _over_view(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    _register(name)(lambda spark, sf_dir: operator(_v(spark, sf_dir)))


# --- view, dimensions -------------------------------------------------------


@_register("audit_parse")
def _audit_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parses the payloads itself; the other queries read stored columns."""
    return audit_v(bridge.audit(spark, sf_dir)).drop("detail")


@_register("pokemon_dim")
def _pokemon_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.pokemon_dim(bridge.pokemon_file(spark, sf_dir))


@_register("item_dim")
def _item_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.item_dim(bridge.item_file(spark, sf_dir))


def _dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.pokemon_dim(bridge.store(spark, sf_dir).dims().pokemon)


@_register("orphan_keys")
def _orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = _dim(spark, sf_dir)
    orphans = dimensions.orphan_keys(_v(spark, sf_dir), dim, "pokedex_id")
    return orphans.groupBy("pokedex_id").agg(rows().alias("events"))


# --- metrics ----------------------------------------------------------------

_over_view("money_series", metrics.money_series)
_over_view("economy_daily", metrics.economy_daily)
_over_view("dau_daily", metrics.dau_daily)
_over_view("bait_rock_daily", metrics.bait_rock_daily)
_over_view("catch_attempt", metrics.catch_attempt)
_over_view("catch_rate_daily", metrics.catch_rate_daily)
_over_view("safari_session", metrics.safari_session)


@_register("safari_session_daily")
def _safari_session_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles to the microsecond; engines differ in the last bit beyond it."""
    sessions = metrics.safari_session(_v(spark, sf_dir))
    daily = metrics.safari_session_daily(sessions)
    for name in ("dwell_median_sec", "dwell_p90_sec"):
        daily = daily.withColumn(name, round_to(F.col(name), 6))
    return daily


_over_view("connection_session", connections.connection_session)


@_register("connection_daily")
def _connection_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To the microsecond; engines differ in the last bit beyond it."""
    daily = connections.connection_daily(connections.connection_session(_v(spark, sf_dir)))
    for name in ("mean_sec_per_user", "length_median_sec", "length_p90_sec"):
        daily = daily.withColumn(name, round_to(F.col(name), 6))
    return daily


# --- series, drill-down, periods ---------------------------------------------


def _rollups(spark: SparkSession, sf_dir: str) -> drilldown.Rollups:
    """Kept beside the store: made by the first query, read by the others."""
    return rollup.refresh(bridge.store(spark, sf_dir))


def _series(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return series.all_series(_rollups(spark, sf_dir))


def _one_series(metric: str) -> None:
    _register(f"series_{metric}")(lambda spark, sf_dir: _series(spark, sf_dir)[metric])


for _metric in series.SERIES:
    _one_series(_metric)


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drilldown.drill_counts(_rollups(spark, sf_dir))


@_register("drill_counts")
def _drill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


@_register("drill_totals")
def _drill_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drilldown.drill_totals(_counts(spark, sf_dir))


@_register("drill_preview")
def _drill_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drilldown.drill_preview(_counts(spark, sf_dir))


@_register("drill_page")
def _drill_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drilldown.drill_page(_counts(spark, sf_dir), "dau", "active", "2024-01-10", "1")


@_register("drill_by_series")
def _drill_by_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drilldown.drill_by_series(_counts(spark, sf_dir), spark)


@_register("period_summary")
def _period_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.period_summary(_series(spark, sf_dir), 7)


@_register("period_notes")
def _period_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.period_notes(_series(spark, sf_dir), 7)


def _long(v: DataFrame) -> DataFrame:
    """The same rows dealt over more than 200 days, with days that have none."""
    later = F.timestamp_add("DAY", F.col("id") % 7 * 30, F.col("created_at"))
    moved = v.withColumn("created_at", later).withColumn("created_at_kst", to_kst(F.col("created_at")))
    return moved.where(F.dayofyear(kst_day()) % 11 != 3)


def _long_series(metric: str) -> None:
    _register(f"series_{metric}_long")(
        lambda spark, sf_dir: series.all_series(_long_rollups(spark, sf_dir))[metric]
    )


def _long_rollups(spark: SparkSession, sf_dir: str) -> drilldown.Rollups:
    """Rollups over 200 days that came in three runs, one build after each.

    The second run brings rows for days that the first build had left behind
    already, the third one the newest days.
    """
    base = Store(spark, f"{bridge.folder(spark, sf_dir, 'long')}/store")
    if base.last_number() == 0:
        v = _long(_v(spark, sf_dir))
        newest = F.col("created_at") >= F.lit("2024-07-01").cast("timestamp_ntz")
        late = (F.col("id") % 5 == 0) & ~newest
        for rows_ in (v.where(~late & ~newest), v.where(late), v.where(newest)):
            run = base.new_run("append")
            run.write_typed(rows_)
            run.commit()
            rollup.refresh(base)
    return rollup.refresh(base)


for _metric in series.SERIES:
    _long_series(_metric)


@_register("drill_counts_long")
def _drill_counts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drilldown.drill_counts(_long_rollups(spark, sf_dir))


def _daily_log(v: DataFrame) -> DataFrame:
    """A load history as if each day's rows had been loaded with its last event."""
    per_day = v.groupBy(kst_day().alias("scanned_from")).agg(
        F.max("created_at").alias("run_at"),
        rows().alias("rows_inserted"),
        F.max("id").alias("max_id"),
    )
    so_far = Window.orderBy("scanned_from")
    return per_day.select(
        "run_at",
        "scanned_from",
        F.lit(1).cast("bigint").alias("files_scanned"),
        "rows_inserted",
        F.sum("rows_inserted").over(so_far).alias("total_rows"),
        "max_id",
    )


_over_view("freshness", lambda v: series.freshness(_daily_log(v), "2024-02-01 12:00:00"))


@_register("meta")
def _meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = bridge.store(spark, sf_dir)
    dims = store.dims()
    log = _daily_log(store.audit_v())
    return series.meta(log, store.latest_event(), dims.version, dims.pokemon)


@_register("period_slice")
def _period_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.period(_series(spark, sf_dir), 7)["catch_rate"]


@_register("publish_roundtrip")
def _publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Builds and checks all output, then reads the published drill-down back."""
    out = bridge.folder(spark, sf_dir, "published")
    folder = publish.publish(bridge.store(spark, sf_dir), out, AS_OF)
    return publish.read_details(spark, folder)


SALT = "a salt for the test tables"  # fixed value: the checking SQL needs it too


@_register("shared_details")
def _shared_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of the drill-down for others: pseudonyms in place of account ids."""
    out = bridge.folder(spark, sf_dir, "shared")
    counts = _counts(spark, sf_dir)
    return share.read(spark, share.publish(spark, counts, out, SALT, AS_OF))


@_register("shared_joined")
def _shared_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two copies joined on the pseudonym: the same salt links all, another none."""
    counts = _counts(spark, sf_dir).where("metric = 'dau' AND category = 'active'")
    one, same, other = [share.shared(counts, s) for s in (SALT, SALT, SALT[::-1])]

    def links(copy: DataFrame) -> DataFrame:
        found = one.select("d", "pseudonym").join(copy.select("d", "pseudonym"), ["d", "pseudonym"])
        return found.agg(rows().alias("links"), F.count_distinct("pseudonym").alias("accounts"))

    return links(same).select(F.lit("same").alias("salt"), "*").unionByName(
        links(other).select(F.lit("other").alias("salt"), "*")
    )


@_register("shared_leaks")
def _shared_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy in which one metric still shows plain ids, and a column too many."""
    counts = _counts(spark, sf_dir)
    plain = F.when(F.col("metric") == "dau", F.col("account_id").cast("string"))
    copy = share.pseudonym(F.col("account_id"), SALT)
    spoiled = counts.withColumn("pseudonym", F.coalesce(plain, copy))
    return share.leaks(spoiled).groupBy("rule", "metric").agg(F.sum("n").alias("n"))


# --- ingest ------------------------------------------------------------------

_FACT = ["id", "account_id", "action", "source", "created_at"]


@_register("ingest_dedup")
def _ingest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows shipped on their day, trades once more, changed, a day later."""
    audit = bridge.store(spark, sf_dir).audit()

    def shipped(df: DataFrame, days: int) -> DataFrame:
        day = F.date_add(F.col("created_at").cast("date"), days).cast("string")
        folder = F.translate(day, "-", "/")
        return df.withColumn(
            "path", F.concat(F.lit("audit/"), folder, F.lit("/audit-1.jsonl.gz"))
        )

    trades = audit.where(F.col("action").isin(*metrics.TRADES))
    again = shipped(trades.withColumn("source", F.lit("second")), 1)
    return archive.latest_per_id(shipped(audit, 0).unionByName(again)).select(*_FACT)


@_register("ingest_antijoin")
def _ingest_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything shipped, while the fact lacks the catches."""
    batch = _v(spark, sf_dir).select(*_FACT)
    return ingest.new_rows(batch, batch.where(F.col("action") != "POKEMON_CATCH"))


@_register("upsert_latest")
def _upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades come again, changed; catches come under ids unseen so far."""
    fact = _v(spark, sf_dir).select(*_FACT)
    changed = fact.where(F.col("action").isin(*metrics.TRADES))
    fresh = fact.where(F.col("action") == "POKEMON_CATCH").withColumn(
        "id", -F.col("id")
    )
    batch = changed.unionByName(fresh).withColumn("source", F.lit("forced"))
    return ingest.upsert(fact, batch)


@_register("scan_plan")
def _scan_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object per event day; those up to 19 January are loaded already."""
    per_day = (
        _v(spark, sf_dir)
        .groupBy(F.col("created_at").cast("date").alias("day"))
        .agg(F.max("id").alias("cutoff"))
    )
    folder = F.translate(F.col("day").cast("string"), "-", "/")
    files_ = per_day.select(
        F.concat(
            F.lit("s3://b/audit/"),
            folder,
            F.lit("/audit-"),
            F.col("day").cast("string"),
            F.lit("T0003Z-"),
            F.col("cutoff").cast("string"),
            F.lit(".jsonl.gz"),
        ).alias("path")
    )
    stray = files_.select(F.replace("path", F.lit("/2024/"), F.lit("/none/")).alias("path"))
    objects = archive.parse_paths(files_.union(stray))
    loaded = objects.where(F.col("batch_date") <= F.lit("2024-01-19").cast("date"))
    start = ingest.scan_from(1, datetime(2024, 1, 25), datetime(2024, 1, 31))
    return archive.plan_scan(objects, loaded.select("path"), start, everything=False)


_SHIPPED_LATER = 1000  # days; puts the objects behind the archive's first day
_LOAD_AT = datetime(2026, 11, 1)


def _loaded(spark: SparkSession, sf_dir: str) -> Store:
    """All rows exported to an archive and loaded from it, once per application."""
    base = bridge.folder(spark, sf_dir, "roundtrip")
    store = Store(spark, f"{base}/store")
    if store.last_number() == 0:
        archive_ = f"{base}/{uuid.uuid4().hex}"
        bridge.export_archive(spark, sf_dir, archive_, _SHIPPED_LATER)
        ingest.load(spark, store, archive_, _LOAD_AT)
    return store


_AGAIN = _SHIPPED_LATER + 4  # trades shipped again, changed, on later days


def _reloaded(spark: SparkSession, sf_dir: str, force: bool) -> Store:
    """A loaded archive that grows by changed copies of trades, loaded again."""
    base = bridge.folder(spark, sf_dir, f"reload-{force}")
    store = Store(spark, f"{base}/store")
    if len(store.committed()) < 2:
        archive_ = f"{base}/{uuid.uuid4().hex}"
        bridge.export_archive(spark, sf_dir, archive_, _SHIPPED_LATER)
        if store.last_number() == 0:
            ingest.load(spark, store, archive_, _LOAD_AT)
        trades = bridge.audit(spark, sf_dir).where(F.col("action").isin(*metrics.TRADES))
        changed = trades.withColumn("source", F.lit("forced"))
        bridge.export_archive(spark, sf_dir, archive_, _AGAIN, changed)
        ingest.load(spark, store, archive_, _LOAD_AT + timedelta(hours=1), force=force)
    return store


@_register("forced_load")
def _forced_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window's rows read again: the copy shipped last replaces the old row."""
    return _reloaded(spark, sf_dir, True).audit().select(*_FACT)


@_register("forced_load_log")
def _forced_load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reloaded(spark, sf_dir, True).load_log()


@_register("repeat_load")
def _repeat_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that are known already change nothing, whatever their new copy says."""
    return _reloaded(spark, sf_dir, False).audit().select(*_FACT)


@_register("repeat_load_log")
def _repeat_load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reloaded(spark, sf_dir, False).load_log()


@_register("stream_load")
def _stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows from an archive read as a stream, ten objects at a time."""
    base = bridge.folder(spark, sf_dir, "stream")
    store = Store(spark, f"{base}/store")
    if store.last_number() == 0:
        archive_ = f"{base}/{uuid.uuid4().hex}"
        bridge.export_archive(spark, sf_dir, archive_, _SHIPPED_LATER)
        stream.load_stream(spark, store, archive_, f"{archive_}/progress", _LOAD_AT, objects_at_once=10)
    return store.audit_v().drop("detail")


@_register("jsonl_roundtrip")
def _jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir).audit_v().drop("detail")


@_register("load_log_row")
def _load_log_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir).load_log()


@_register("dims_roundtrip")
def _dims_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension files delivered as CSV, loaded into a store, then cleaned."""
    base = f"{bridge.folder(spark, sf_dir, 'dims')}/{uuid.uuid4().hex}"
    delivered = bridge.dims(spark, sf_dir)
    for name in ("pokemon", "item"):
        table = getattr(delivered, name)
        # A line end inside a value would end the line; the loader strips it anyway.
        bare = table.select(*[F.replace(c, F.lit("\r")).alias(c) for c in table.columns])
        bare.write.csv(f"{base}/master/v=abc/{name}.csv", header=True, escape='"')
    files.create(spark, f"{base}/master/LATEST", "abc\n")
    store = Store(spark, f"{base}/store")
    ingest.load_dims(spark, store, base, datetime.fromisoformat(AS_OF))
    return dimensions.pokemon_dim(store.dims().pokemon)


# --- checks ------------------------------------------------------------------


def _gapped(v: DataFrame) -> DataFrame:
    """The same rows with a jump of 5000 ids after every 1500."""
    jumps = F.floor(F.col("id") / 1500) * 5000
    return v.withColumn("id", F.col("id") + jumps)


def _twice(v: DataFrame) -> DataFrame:
    """Trades shipped a second time."""
    return v.unionByName(v.where(F.col("action").isin(*metrics.TRADES)))


_over_view("dup_ids", lambda v: checks.duplicate_ids(_twice(v)))
_over_view("id_gaps", lambda v: id_gaps(_gapped(v)))
_over_view("unmasked_urls", checks.unmasked_urls)


@_register("assertions")
def _assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _twice(_gapped(_v(spark, sf_dir)))
    return checks.assertions(spark, v, v, _dim(spark, sf_dir), AS_OF)


@_register("assertions_dirty")
def _assertions_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact with ip, a view with unmasked urls and a login name, and a
    dimension whose line ends were never stripped."""
    v = _v(spark, sf_dir)
    audit = v.withColumn("ip", F.lit("192.0.2.1"))
    method = F.concat("req_url", F.lit("?code="), F.col("req_method"))
    dirty = v.withColumn("req_url", F.coalesce(method, F.col("req_url"))).withColumn("Login_Username", F.lit("x"))
    # Put back row by row: ids of parts repeat from 10,000 parts on, so a join by id would multiply rows.
    dim = _dim(spark, sf_dir).withColumn("tier", F.concat("tier", F.lit("\r")))
    return checks.assertions(spark, audit, dirty, dim, AS_OF)


@_register("contract_broken")
def _contract_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of the published series and the banner row, broken once."""
    sound = _series(spark, sf_dir)
    first = F.col("d") == F.lit("2024-01-10").cast("date")
    more = F.explode(F.array(*[F.date_add("d", 100 * k) for k in range(4)]))
    endless = F.when(first, F.lit(float("inf"))).otherwise(F.col("catch_rate"))
    unknown = F.when(first, F.lit(float("nan"))).otherwise(F.col("unclosed_rate"))
    broken = {
        "dau": sound["dau"].withColumn("d", more),
        "catch_rate": sound["catch_rate"].withColumn("catch_rate", endless),
        "safari_session": sound["safari_session"].withColumn("unclosed_rate", unknown),
        "bait_rock": sound["bait_rock"].unionByName(sound["bait_rock"].where(first)),
    }
    store = bridge.store(spark, sf_dir)
    row = series.meta(_daily_log(store.audit_v()), store.latest_event(), store.dims().version, store.dims().pokemon)
    negative = row.withColumn("last_inserted", -F.col("last_inserted"))
    twice = row.unionByName(row)
    parts = [checks.series_contract(broken), checks.meta_contract(negative), checks.meta_contract(twice)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@_register("preview_spoiled")
def _preview_spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A preview that lost its first account, and totals one too high, on one day."""
    counts = _counts(spark, sf_dir)
    spoiled = (F.col("d") == F.lit("2024-01-10").cast("date")) & (F.col("metric") == "dau")
    preview = drilldown.drill_preview(counts).where(~(spoiled & (F.col("rank") == 1)))
    users = F.when(spoiled, F.col("total_users") + 1).otherwise(F.col("total_users"))
    totals = drilldown.drill_totals(counts).withColumn("total_users", users)
    return checks.preview_invariants(counts, preview, totals)


@_register("contract_drift")
def _contract_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = bridge.store(spark, sf_dir)
    audit, dims = store.audit(), store.dims()
    base = f"{bridge.folder(spark, sf_dir, 'shape')}/{uuid.uuid4().hex}"
    sampled = "audit/2024/01/30/audit-1.jsonl.gz"
    bridge.export_object(spark, sf_dir, base, sampled)
    shape = archive.read_events(spark, [f"{base}/{sampled}"]).agg(
        F.max("created_at").alias("observed_at"),
        F.lit(sampled).alias("sampled"),
        F.array(*[F.lit(n) for n in archive.source_columns(spark, f"{base}/{sampled}")]).alias("columns"),
    )
    return checks.contract_drift(audit, shape, dims.pokemon, dims.version, AS_OF)


_over_view(
    "reconcile",
    lambda v: reconcile.reconcile(
        _twice(_gapped(v)), _gapped(v).where(F.col("action") != "LOGIN_FAILED")
    ),
)


@_register("series_contract")
def _series_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound series but for one day taken out of one of them."""
    broken = _series(spark, sf_dir)
    broken["dau"] = broken["dau"].where(F.col("d") != F.lit("2024-01-10").cast("date"))
    return checks.series_contract(broken)


@_register("drill_invariants")
def _drill_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without an account dropped from the drill-down by mistake."""
    source = _rollups(spark, sf_dir)
    lost = drilldown.drill_counts(source).where(F.col("account_id").isNotNull())
    return checks.drill_invariants(series.all_series(source), lost)


_over_view(
    "sanity",
    lambda v: checks.sanity(
        v,
        metrics.catch_rate_daily(v),
        metrics.safari_session(v),
        metrics.money_series(v),
    ),
)

# --- product and abuse questions ----------------------------------------------



def _recent(name: str, days: int, operator: Callable[[DataFrame], DataFrame]) -> None:
    """Over the window that the operator itself asks for, without older folders."""
    _register(name)(
        lambda spark, sf_dir: operator(bridge.store(spark, sf_dir).recent(AS_OF, days))
    )


_recent("dau_recent", 30, lambda v: recipes.recent_dau(v, AS_OF))
PAST = "2024-01-20 00:00:00"  # rows lie on both sides


@_register("dau_recent_past")
def dau_recent_past(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.recent_dau(bridge.store(spark, sf_dir).recent(PAST, 10), PAST, 10)


_recent("funnel", 30, lambda v: recipes.funnel(v, AS_OF))
_recent("faucet_sink", 30, lambda v: recipes.faucet_sink(v, AS_OF))
_recent("map_edges", 7, lambda v: recipes.map_edges(v, AS_OF))
_recent("shiny_screen", 30, lambda v: recipes.shiny_screen(v, AS_OF, min_catches=1))
_over_view(
    "money_unexplained",
    lambda v: recipes.money_unexplained(metrics.money_series(v), AS_OF, threshold=10_000),
)
_over_view(
    "money_net_gain", lambda v: recipes.money_net_gain(metrics.money_series(v), AS_OF)
)
_recent(
    "bot_screen",
    30,
    lambda v: recipes.bot_screen(v, AS_OF, days=30, max_gap=400_000, min_events=3),
)
_recent("ticket_ledger", 30, lambda v: recipes.ticket_ledger(v, AS_OF))


def _past(name: str, days: int, operator: Callable[[DataFrame], DataFrame]) -> None:
    """The same questions with rows on both sides of ``as_of``."""
    _register(f"{name}_past")(
        lambda spark, sf_dir: operator(bridge.store(spark, sf_dir).recent(PAST, days))
    )


_past("ticket_ledger", 12, lambda v: recipes.ticket_ledger(v, PAST, days=12))
_past("map_edges", 7, lambda v: recipes.map_edges(v, PAST))
_past("funnel", 10, lambda v: recipes.funnel(v, PAST, days=10))
_past("shiny_screen", 15, lambda v: recipes.shiny_screen(v, PAST, days=15, min_catches=1))
_past(
    "bot_screen",
    15,
    lambda v: recipes.bot_screen(v, PAST, days=15, max_gap=400_000, min_events=3),
)


_recent(
    "attempt_zscore",
    30,
    lambda v: recipes.attempt_zscore(v, AS_OF, days=30, min_attempts=1, min_z=5.0, top=1000),
)


@_register("attempt_zscore_past")
def _attempt_zscore_past(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A short baseline, and rows on both sides of the window."""
    v = bridge.store(spark, sf_dir).recent(PAST, 14)
    return recipes.attempt_zscore(
        v, PAST, baseline_hours=48, min_hours=12, min_attempts=1, min_z=2.0, top=1000
    )


@_register("catch_composition")
def _catch_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = bridge.store(spark, sf_dir).recent(AS_OF, 14)
    return recipes.catch_composition(recent, _dim(spark, sf_dir), AS_OF)


@_register("reentry_gap")
def _reentry_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recipes.reentry_gap(bridge.store(spark, sf_dir).recent(AS_OF, 7), AS_OF)
    later = F.timestamp_diff("MICROSECOND", F.col("entered"), F.col("entered") + F.col("gap"))
    return found.withColumn("gap", later / F.lit(1e6)).withColumnRenamed("gap", "gap_s")
