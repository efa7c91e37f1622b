"""Every query by name, over the tables below a data folder.

Each callable takes ``(spark, sf_dir)``. Values are returned in plain types (bigint, double,
string, date, boolean, timestamp without zone) and unrounded ones with six digits.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions.numeric import half_up
from usagelens.functions.wire import decode_events, encode_event, rejected
from usagelens.operators import boosting, cohorts, filters, gaps, quality, splits, users
from usagelens.operators.churn import evaluate
from usagelens.operators.isolation_forest import NODE_SCHEMA, IsolationForestModel, path_lengths
from usagelens.operators.keyed import first_per_key, latest_per_key
from usagelens.plans import marts, reports, training
from usagelens.schema import WIRE_SCHEMA, conform, stage
from usagelens.session import materialize, scratch_path
from usagelens.sources import events_table, files, kafka, testtables
from usagelens.sources.keyed_table import KeyedTable
from usagelens.streaming import jobs

# The day the events are looked at from.
AS_OF = "2024-01-31"
# The same for the orders, of which there are years.
ORDERS_AS_OF = "2001-08-02"
INACTIVE_DAYS = 120
ROLLOUT = {"rollout": "1998-06-01", "tier": "enterprise", "region": "AMERICA", "days": 90}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _plain(field: T.StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
        value = value.cast("long")
    elif isinstance(field.dataType, T.DecimalType):
        value = value.cast("double")
    elif isinstance(field.dataType, T.TimestampType):
        value = value.cast("timestamp_ntz")
    return value.alias(field.name)


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: half_up(c, digits) for c in doubles})


def query(build: Query) -> Query:
    """Register a query under its function name, with its output in plain types."""

    @functools.wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(spark, sf_dir)
        return df.select(*[_plain(f) for f in df.schema.fields])

    QUERIES[build.__name__] = run
    return run


# Events without user columns, events with them, and the user-day rollup. A query takes the
# first or the last wherever it can, as neither joins users to single events.
events = testtables.events
usage = testtables.usage_events
days = testtables.usage_days

# What is asked of users over a long time is asked of the orders, event by event or rolled up.
orders = testtables.order_events
order_days = testtables.order_days


# Reports


@query
def endpoint_metrics(spark, sf_dir):
    return reports.endpoint_metrics(events(spark, sf_dir))


def _stored_parts(spark, sf_dir):
    """The daily counts as the marts store them, written as one table a day."""
    path = scratch_path(spark, "endpoint-parts")
    parts = marts.endpoint_parts(events(spark, sf_dir))
    parts.write.partitionBy("event_date").parquet(path)
    return spark.read.schema(parts.schema).parquet(path)


@query
def endpoint_metrics_from_marts(spark, sf_dir):
    return reports.endpoint_metrics(events(spark, sf_dir), parts=_stored_parts(spark, sf_dir))


@query
def current_metrics_from_marts(spark, sf_dir):
    return reports.current_metrics(events(spark, sf_dir), parts=_stored_parts(spark, sf_dir))


@query
def current_metrics(spark, sf_dir):
    return reports.current_metrics(events(spark, sf_dir))


@query
def narrative_metrics(spark, sf_dir):
    return reports.narrative_metrics(events(spark, sf_dir))


@query
def narrative(spark, sf_dir):
    return reports.narrative(events(spark, sf_dir))


@query
def time_series(spark, sf_dir):
    return reports.time_series(events(spark, sf_dir), AS_OF, days=21)


@query
def time_series_from_rollup(spark, sf_dir):
    return reports.time_series(days(spark, sf_dir), AS_OF, days=21)


@query
def mark_partial(spark, sf_dir):
    # Looked at on the last day of the data, which is then still in progress.
    daily = reports.time_series(events(spark, sf_dir), AS_OF, days=30)
    return filters.mark_partial(daily, "2024-01-30").select(
        "event_date", "requests", "is_partial", "is_bridge"
    )


@query
def user_tiers(spark, sf_dir):
    return reports.user_tiers(days(spark, sf_dir))


@query
def errors_top(spark, sf_dir):
    return reports.errors_top(events(spark, sf_dir))


@query
def errors_top_5(spark, sf_dir):
    # Fewer than there are kinds of error, so that the limit acts.
    return reports.errors_top(events(spark, sf_dir), 5)


@query
def churn_risk(spark, sf_dir):
    return users.at_risk(order_days(spark, sf_dir))


@query
def user_day_rollup(spark, sf_dir):
    rows = _rounded(days(spark, sf_dir), 2)
    return rows.withColumn("churn_day", F.col("churn_day").cast("double"))


@query
def dau(spark, sf_dir):
    return reports.dau(events(spark, sf_dir))


@query
def token_usage(spark, sf_dir):
    return reports.token_usage(days(spark, sf_dir))


@query
def daily_errors(spark, sf_dir):
    return reports.daily_errors(events(spark, sf_dir))


@query
def daily_tier_panel(spark, sf_dir):
    return reports.daily_tier_panel(days(spark, sf_dir))


@query
def daily_latency_error(spark, sf_dir):
    return _rounded(reports.daily_latency_error(events(spark, sf_dir)))


@query
def rolling_features(spark, sf_dir):
    return _rounded(reports.rolling_daily(events(spark, sf_dir)))


@query
def anomaly_features(spark, sf_dir):
    return _rounded(reports.anomaly_features(events(spark, sf_dir)))


# Filters and single rows


@query
def latest_day(spark, sf_dir):
    return filters.latest_day(events(spark, sf_dir)).select("event_id", "event_date", "user_id")


@query
def newest_sample(spark, sf_dir):
    rows = filters.newest(events(spark, sf_dir))
    return testtables.with_users(rows, sf_dir).select(
        "event_id", "timestamp", "user_id", "user_tier", "endpoint", "latency_ms", "status_code",
        "input_tokens", "output_tokens",
    )


@query
def newest_100(spark, sf_dir):
    return filters.newest(events(spark, sf_dir), 100).select("event_id", "timestamp", "user_id")


@query
def newest_100_of_days(spark, sf_dir):
    # From a table with a folder per day.
    path = scratch_path(spark, "events-by-day")
    rows = events(spark, sf_dir).select("event_id", "timestamp", "user_id", "event_date")
    rows.write.partitionBy("event_date").parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    return filters.newest_of_days(stored, 100).select("event_id", "timestamp", "user_id")


@query
def latest_tier_per_user(spark, sf_dir):
    # Tiers change from order to order.
    rows = orders(spark, sf_dir).select("user_id", "event_date", "event_id", "user_tier")
    return latest_per_key(rows, "user_id", ["event_date", "event_id"])


@query
def latest_event_per_user(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_date", "timestamp", "event_id", "endpoint")
    latest = latest_per_key(rows, "user_id", ["event_date", "timestamp", "event_id"])
    return testtables.with_users(latest, sf_dir).drop("region")


@query
def distinct_tiers(spark, sf_dir):
    return days(spark, sf_dir).select("user_tier").distinct()


# Cohorts


@query
def cohort_retention(spark, sf_dir):
    return cohorts.cohort_retention(orders(spark, sf_dir), grain="week")


def _order_cohorts(spark, sf_dir):
    return reports.cohort_report(
        testtables.table(spark, sf_dir, "orders"), user="o_custkey", date="o_orderdate")


@query
def cohort_retention_orders(spark, sf_dir):
    return _order_cohorts(spark, sf_dir)


@query
def cohort_mart_orders(spark, sf_dir):
    # Without a bound on the age, as the mart has it.
    return cohorts.cohort_retention(testtables.table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


@query
def cohort_mart_incremental(spark, sf_dir):
    # Built in three steps, each adding the orders of some years to what is stored.
    rows = testtables.table(spark, sf_dir, "orders")
    path = scratch_path(spark, "user-months")
    bounds = ["1990-01-01", "1995-03-10", "1998-07-01", "2100-01-01"]
    for low, high in zip(bounds, bounds[1:]):
        some = rows.where(F.col("o_orderdate").between(F.lit(low), F.lit(high)) & (F.col("o_orderdate") < F.lit(high)))
        part = cohorts.user_months(some, "o_custkey", "o_orderdate")
        if low != bounds[0]:
            part = materialize(cohorts.merged_months(part.unionByName(spark.read.parquet(path))), "months")
        part.write.mode("overwrite").parquet(path)
    return cohorts.cohorts_of_months(spark.read.parquet(path))


@query
def cohort_matrix(spark, sf_dir):
    wide = cohorts.cohort_matrix(_order_cohorts(spark, sf_dir))
    # Empty cells are null, so the counts are given as doubles.
    return wide.select("cohort_month", *[F.col(c).cast("double").alias(c) for c in wide.columns[1:]])


@query
def retained_within(spark, sf_dir):
    return cohorts.retained_within(orders(spark, sf_dir), days=90)


# Event table


@query
def conform_events(spark, sf_dir):
    rows = conform(usage(spark, sf_dir))
    return rows.select(
        "event_id", "timestamp", "user_id", "user_tier", "endpoint", "input_tokens",
        "output_tokens", "latency_ms", "status_code", "error_type", "region", "rate_limited",
        "will_churn", F.col("churn_day").cast("double").alias("churn_day"),
        F.col("ingested_at").isNotNull().alias("has_ingested_at"),
    )


@query
def stage_events(spark, sf_dir):
    raw = conform(usage(spark, sf_dir).drop("is_error", "total_tokens", "event_date"))
    return stage(raw).select("event_id", "event_date", "is_error", "total_tokens", "latency_ms")


def _sent(spark, sf_dir):
    return usage(spark, sf_dir).withColumns({
        "model_variant": F.lit(None).cast("string"), "sdk_version": F.lit("1.3.0"),
        "session_id": F.concat(F.lit("s"), F.col("event_id")),
        "latency_ms": F.col("latency_ms").cast("decimal(10,2)"),
        "event_id": F.col("event_id").cast("string"), "user_id": F.col("user_id").cast("string"),
    })


@query
def wire_roundtrip(spark, sf_dir):
    received = decode_events(kafka.messages(_sent(spark, sf_dir)))
    return received.select(
        *[c for c in WIRE_SCHEMA.names if c != "churn_day"],
        F.col("churn_day").cast("double").alias("churn_day"),
    )


@query
def wire_rejects(spark, sf_dir):
    # Four in ten messages are damaged, each kind in a way of its own.
    kind = F.col("event_id").cast("long") % 10
    rows = _sent(spark, sf_dir)
    sent = rows.select(F.col("event_id").alias("sent_id"), kind.alias("kind"), encode_event(rows).alias("value"))
    damaged = (F.when(F.col("kind") == 0, F.expr("left(value, length(value) - 5)"))
               .when(F.col("kind") == 1, F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"soon"'))
               .when(F.col("kind") == 2, F.regexp_replace("value", '"input_tokens":[0-9]+', '"input_tokens":"abc"'))
               .when(F.col("kind") == 3, F.regexp_replace("value", '"user_id":"[^"]*",', ""))
               .otherwise(F.col("value")))
    return rejected(sent.withColumn("value", damaged)).select("sent_id", "reason")


@query
def insert_new(spark, sf_dir):
    # The table holds the first half of the month. The batch overlaps it, and each of its
    # events comes twice: the later copy, with another latency, must lose.
    rows = events(spark, sf_dir).select("event_id", "timestamp", "user_id", "latency_ms")
    first = rows.filter(F.col("timestamp") < F.lit("2024-01-15").cast("timestamp"))
    batch = rows.filter(F.col("timestamp") >= F.lit("2024-01-10").cast("timestamp"))
    again = batch.withColumns({
        "timestamp": F.col("timestamp") + F.expr("interval 5 minutes"),
        "latency_ms": F.col("latency_ms") + 1,
    })
    table = KeyedTable(spark, scratch_path(spark, "keyed-table"), rows.schema, "event_id")
    table.append(first)
    table.append(first_per_key(batch.unionByName(again), "event_id", ["timestamp"]))
    # What the table has besides its first half; an event that is in it twice would show.
    return table.read().exceptAll(first)


@query
def events_of_users(spark, sf_dir):
    # From a stored table; more users than one pushed-down list has.
    path = scratch_path(spark, "user-events")
    events_table.insert_new(conform(_sent(spark, sf_dir)), path)
    return events_table.events_of_users(spark, path, range(1, 14), "2024-01-05 06:00:00", "2024-01-20 18:30:00").select(
        "event_id", "timestamp", "user_id", "endpoint")


@query
def retain_recent(spark, sf_dir):
    return events_table.retain_recent(events(spark, sf_dir), "2024-01-31 12:00:00", 10).select(
        "event_id", "timestamp", "user_id"
    )


@query
def cull_report(spark, sf_dir):
    return events_table.cull_report(events(spark, sf_dir), "2024-01-31 12:00:00", 10)


# Slots


def _calendar(spark, sf_dir):
    minute = F.date_trunc("minute", F.col("timestamp"))
    bounds = events(spark, sf_dir).agg(
        F.min(minute).alias("start"), (F.max(minute) + F.expr("interval 1 minute")).alias("end")
    )
    return gaps.slots_between(bounds)


@query
def slot_calendar(spark, sf_dir):
    return _calendar(spark, sf_dir)


@query
def existing_slots(spark, sf_dir):
    return gaps.existing_slots(events(spark, sf_dir), "2024-01-10", "2024-01-20 06:30:00")


@query
def missing_slots(spark, sf_dir):
    return gaps.missing_slots(_calendar(spark, sf_dir), gaps.existing_slots(events(spark, sf_dir)))


@query
def slot_coverage(spark, sf_dir):
    return gaps.slot_coverage(_calendar(spark, sf_dir), gaps.existing_slots(events(spark, sf_dir)))


@query
def slot_event_id(spark, sf_dir):
    return gaps.backfill_keys(gaps.existing_slots(events(spark, sf_dir)))


@query
def append_batches(spark, sf_dir):
    # Backfilled events, which have no user yet, and other events as one batch.
    keys = gaps.backfill_keys(gaps.existing_slots(events(spark, sf_dir), "2024-01-10", "2024-01-12"))
    others = events(spark, sf_dir).select(F.col("event_id").cast("string").alias("event_id"), "timestamp",
                                          F.col("user_id").cast("string").alias("user_id"))
    return gaps.append_events(keys.withColumnRenamed("slot", "timestamp"), others)


# Report sinks, read back.


@query
def sink_json(spark, sf_dir):
    report, path = reports.token_usage(days(spark, sf_dir)), scratch_path(spark, "report-json")
    files.write_json(report, path)
    return spark.read.schema(report.schema).json(path)


@query
def sink_csv(spark, sf_dir):
    report, path = reports.daily_errors(events(spark, sf_dir)), scratch_path(spark, "report-csv")
    files.write_csv(report, path)
    return spark.read.schema(report.schema).csv(path, header=True, enforceSchema=False)


@query
def sink_text(spark, sf_dir):
    path = scratch_path(spark, "report-text")
    files.write_text(training.rollout_report(_rollout_effect(spark, sf_dir)), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query
def hourly_profile(spark, sf_dir):
    return _rounded(gaps.hourly_profile(events(spark, sf_dir)))


# Quality


@query
def dq_suite(spark, sf_dir):
    return quality.check_rows(usage(spark, sf_dir), narrow=events(spark, sf_dir))


@query
def dq_violations(spark, sf_dir):
    checks = [
        quality.not_null("error_type"), quality.unique("user_id"),
        quality.in_set("user_tier", ["free", "pro"]), quality.between("latency_ms", 2, 50),
        quality.mean_between("input_tokens", 5000, 9000), quality.unique("event_id"),
        quality.in_set("error_type", ["RateLimitError", "APIError"]),
    ]
    return quality.check_rows(usage(spark, sf_dir), checks, events(spark, sf_dir))


@query
def dq_report(spark, sf_dir):
    report = quality.run_suite(
        usage(spark, sf_dir), AS_OF, narrow=events(spark, sf_dir))
    return report.select(
        "run_time", "row_count", F.col("passed").alias("n_passed"), "total", F.inline("checks"))


@query
def dq_marts(spark, sf_dir):
    # All marts, built and read back.
    paths = marts.build_marts(spark, usage(spark, sf_dir), scratch_path(spark, "marts"))
    return marts.check_marts({name: spark.read.parquet(path) for name, path in paths.items()})


@functools.cache
def _refreshed_marts(session: str, sf_dir: str) -> dict[str, str]:
    # Built on the days up to the middle of the month, then refreshed with the rest.
    spark = SparkSession.active()
    out, staged = scratch_path(spark, "marts"), usage(spark, sf_dir)
    marts.build_marts(spark, staged.where("event_date < '2024-01-15'"), out)
    return marts.build_marts(spark, staged, out, since="2024-01-15")


def _mart(name: str) -> None:
    """A query that reads the mart of this name back; the marts are built once a session."""

    def read(spark, sf_dir):
        rows = spark.read.parquet(_refreshed_marts(spark.sparkContext.applicationId, sf_dir)[name])
        if name == marts.ROLLUP:
            return _rounded(rows, 2).withColumn("churn_day", F.col("churn_day").cast("double"))
        return _rounded(rows) if name == "daily_latency_error" else rows

    read.__name__ = f"mart_{name}"
    query(read)


for _name in marts.MART_CHECKS:
    _mart(_name)


@query
def label_guard(spark, sf_dir):
    return quality.label_guard(users.churn_features(order_days(spark, sf_dir), ORDERS_AS_OF))


# Users and models


@query
def user_activity(spark, sf_dir):
    rows = _rounded(users.user_activity(events(spark, sf_dir)))
    return rows.withColumn("churn_day", F.col("churn_day").cast("double"))


@query
def churn_features(spark, sf_dir):
    rows = _rounded(users.churn_features(order_days(spark, sf_dir), ORDERS_AS_OF))
    return rows.withColumn("churn_day", F.col("churn_day").cast("double"))


@query
def one_hot(spark, sf_dir):
    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    rows = users.one_hot(testtables.users(spark, sf_dir), "region", regions, "region")
    return rows.select([F.col(c).alias(c.lower().replace(" ", "_")) for c in rows.columns])


@query
def user_lifetimes(spark, sf_dir):
    return users.user_lifetimes(order_days(spark, sf_dir), ORDERS_AS_OF, INACTIVE_DAYS)


@query
def kaplan_meier(spark, sf_dir):
    return _rounded(training.survival_curves(order_days(spark, sf_dir), ORDERS_AS_OF, INACTIVE_DAYS))


@query
def kaplan_meier_inverted(spark, sf_dir):
    return _rounded(
        training.survival_curves(order_days(spark, sf_dir), ORDERS_AS_OF, INACTIVE_DAYS, inverted=True))


@query
def stratified_split(spark, sf_dir):
    features = users.churn_features(order_days(spark, sf_dir), ORDERS_AS_OF).select("user_id", "churned")
    features = materialize(features, "split-features")
    return splits.stratified_split(features, "churned", "user_id")


def _rollout_effect(spark, sf_dir):
    # Read three times: for both outcomes and for the last day.
    return training.rollout_effect(materialize(order_days(spark, sf_dir), "user-days"), **ROLLOUT)


@query
def diff_in_diff(spark, sf_dir):
    return _rounded(_rollout_effect(spark, sf_dir))


@query
def rollout_report(spark, sf_dir):
    return training.rollout_report(_rollout_effect(spark, sf_dir))


@query
def isolation_forest(spark, sf_dir):
    return training.anomaly_model(events(spark, sf_dir))[1]


# A small forest on the latency and the tokens of an event: (tree, node, feature, threshold, left,
# right, path), as a fitted one is stored.
SMALL_FOREST = [
    (0, 0, 0, 50.0, 1, 2, 0.0), (0, 1, 1, 700.5, 3, 4, 0.0), (0, 2, -1, 0.0, 2, 2, 1.5),
    (0, 3, -1, 0.0, 3, 3, 2.0), (0, 4, 0, 20.25, 5, 6, 0.0), (0, 5, -1, 0.0, 5, 5, 3.25), (0, 6, -1, 0.0, 6, 6, 3.0),
    (1, 0, 1, 1200.5, 1, 2, 0.0), (1, 1, -1, 0.0, 1, 1, 4.0), (1, 2, 0, 90.125, 3, 4, 0.0),
    (1, 3, -1, 0.0, 3, 3, 2.5), (1, 4, -1, 0.0, 4, 4, 2.0),
    (2, 0, -1, 0.0, 0, 0, 0.75),
]


@query
def forest_scores(spark, sf_dir):
    # Every event's mean path down a fixed forest, and its score for a subsample of 16.
    nodes = spark.createDataFrame(SMALL_FOREST, NODE_SCHEMA)
    rows = events(spark, sf_dir).select("event_id", "latency_ms", F.col("total_tokens").cast("double").alias("tokens"))
    model = IsolationForestModel(("latency_ms", "tokens"), nodes.toPandas(), 16)
    paths = path_lengths(rows, nodes, model.features, depth=4).select("event_id", "path_length")
    scores = model.score(rows).select("event_id", "anomaly_score")
    return _rounded(paths.join(scores, "event_id"))


@functools.cache
def _churn(session: str, sf_dir: str):
    spark = SparkSession.active()
    return training.churn_model(order_days(spark, sf_dir), ORDERS_AS_OF)


@query
def churn_model(spark, sf_dir):
    # Fitted once a session, for this query and the next.
    return _churn(spark.sparkContext.applicationId, sf_dir).metrics()


@query
def boosted_tree(spark, sf_dir):
    # The first tree of a churn model, with bins of one width: its splits, their gains and both values.
    rows = users.churn_features(order_days(spark, sf_dir), ORDERS_AS_OF)
    names = users.feature_columns()
    rows = materialize(rows.select(F.col("churned").cast("double").alias("churned"), *names), "boosted-tree")
    edges = boosting.equal_edges(rows, names, 8)
    share = rows.agg(F.avg("churned")).first()[0]
    base = math.log(share / (1 - share))
    binned = boosting.bins(rows, names, edges)
    splits = boosting.grow_tree(boosting.gradients(binned, "churned", f"{base!r}D"), len(names), depth=3)
    found = [(s.node, names[s.feature], edges[s.feature][s.bin], s.gain, s.left[2], s.right[2], *s.values())
             for s in splits.values()]
    return _rounded(spark.createDataFrame(
        found, "node long, feature string, threshold double, gain double, rows_left long, rows_right long, "
               "value_left double, value_right double"))


@query
def model_metrics(spark, sf_dir):
    # The metrics of a score that is a formula of the data: the days since the last activity.
    rows = users.churn_features(order_days(spark, sf_dir), ORDERS_AS_OF)
    away = F.col("days_since_last")
    scored = rows.select(F.col("churned").cast("double").alias("churned"), away.cast("double").alias("rawPrediction"),
                         (away > 150).cast("double").alias("prediction"))
    return _rounded(evaluate(materialize(scored, "scored"), "churned"))


@query
def churn_importances(spark, sf_dir):
    return _churn(spark.sparkContext.applicationId, sf_dir).importances()


# Streams, run until the events are used up; their output is read back as a table.


EVENTS_OF_A_FILE = 1_000_000


def _event_stream(spark, sf_dir, batches=3):
    # The events dealt over some batches at random: most of them come late. The files of a batch
    # follow the number of events.
    path = scratch_path(spark, "event-files")
    rows = testtables.table(spark, sf_dir, "events")
    files = 1 + rows.count() // (batches * EVENTS_OF_A_FILE)
    rows.repartition(batches * files, F.xxhash64("event_id")).write.parquet(path)
    raw = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)
    return testtables.event_columns(raw)


@query
def streaming_metrics(spark, sf_dir):
    out = scratch_path(spark, "streaming-metrics")
    jobs.live_metrics(
        _event_stream(spark, sf_dir), f"{out}/events", f"{out}/windows", f"{out}/checkpoint",
    ).awaitTermination()
    return _rounded(jobs.read_live_metrics(spark, f"{out}/windows").drop("window_date"))


@query
def stream_dedup(spark, sf_dir):
    twice = _event_stream(spark, sf_dir).unionByName(_event_stream(spark, sf_dir))
    rows = twice.select("event_id", "timestamp", "user_id", "endpoint")
    out = scratch_path(spark, "stream-dedup")
    jobs.dedup_stream(rows, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/table")


@query
def ingest_stream(spark, sf_dir):
    twice = _event_stream(spark, sf_dir).unionByName(_event_stream(spark, sf_dir))
    rows = testtables.with_users(twice, sf_dir).withColumns(
        {c: F.lit("-") for c in ("model_variant", "sdk_version", "session_id")})
    sink = scratch_path(spark, "ingest-stream")
    jobs.ingest_stream(rows, sink, scratch_path(spark, "ingest-stream-checkpoint")).awaitTermination()
    return events_table.read_events(spark, sink).select(
        "event_id", "timestamp", "event_date", "user_id", "user_tier", "endpoint", "input_tokens",
        "output_tokens", "latency_ms", "status_code", "error_type", "region", "will_churn",
    )
