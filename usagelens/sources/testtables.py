"""Usage events derived from a star schema: ``events`` with customer, nation and region."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.operators.measures import user_days

# Declared, so that opening a table does not start a job to read file footers.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}

# How the columns of the source tables stand for those of usage events.
TIER_OF_SEGMENT = {"AUTOMOBILE": "enterprise", "MACHINERY": "pro"}
ENDPOINT_OF_TYPE = {
    "click": "/v1/completions", "view": "/v1/chat",
    "purchase": "/v1/embeddings", "signup": "/v1/classify",
}
STATUS_OF_ERROR = [429, 401, 400, 500, 504, 503]
ERROR_OF_STATUS = {
    429: "RateLimitError", 401: "AuthenticationError", 400: "InvalidRequestError",
    500: "InternalServerError", 504: "TimeoutError", 503: "APIError",
}
TIER_OF_PRIORITY = {"1-URGENT": "enterprise", "2-HIGH": "pro"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _case(value: str, mapping: dict, otherwise: str) -> str:
    """SQL that looks a value up in a mapping; numbers and strings read alike in it."""
    branches = " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in mapping.items())
    return f"CASE {value} {branches} ELSE {otherwise} END"


def event_columns(events: DataFrame) -> DataFrame:
    """Usage columns that follow from the event alone; every event has a row."""
    in_order = dict(enumerate(ENDPOINT_OF_TYPE.values()))
    endpoint = _case("event_type", ENDPOINT_OF_TYPE, _case("k % 4", in_order, "NULL"))
    status = _case("k % 6", dict(enumerate(STATUS_OF_ERROR)), "NULL")
    rows = events.selectExpr(
        "event_id", "user_id", "event_type", "value",
        "cast(ts AS timestamp) AS timestamp",
        "cast(ts AS date) AS event_date",
        "cast(get_json_object(props, '$.k') AS int) AS k",
        "CASE WHEN user_id % 4 = 0 THEN cast(3 + (7 * user_id) % 25 AS int) END AS churn_day",
    )
    rows = rows.selectExpr(
        "*", f"CASE WHEN event_type = 'error' THEN {status} ELSE 200 END AS status_code")
    return rows.selectExpr(
        "event_id", "timestamp", "event_date", "user_id",
        f"{endpoint} AS endpoint",
        "10 * k + 50 AS input_tokens",
        "4 * k + 50 AS output_tokens",
        "value AS latency_ms",
        "status_code",
        f"{_case('status_code', ERROR_OF_STATUS, 'NULL')} AS error_type",
        "status_code = 429 AS rate_limited",
        "churn_day IS NOT NULL AS will_churn",
        "churn_day",
        "event_type = 'error' AS is_error",
        "14 * k + 100 AS total_tokens",
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged usage events without the columns of the user."""
    return event_columns(table(spark, sf_dir, "events"))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged usage events made of all orders, for what is asked of users over years.

    Customers stop ordering by themselves, and their tier follows the order, so it changes.
    """
    orders = table(spark, sf_dir, "orders")
    endpoint = _case("o_orderkey % 4", dict(enumerate(ENDPOINT_OF_TYPE.values())), "NULL")
    status = _case("o_orderkey % 6", dict(enumerate(STATUS_OF_ERROR)), "NULL")
    rows = orders.selectExpr(
        "o_orderkey AS event_id", "o_custkey AS user_id",
        "cast(o_orderdate AS timestamp) AS timestamp", "cast(o_orderdate AS date) AS event_date",
        f"{_case('o_orderpriority', TIER_OF_PRIORITY, repr('free'))} AS user_tier",
        f"{endpoint} AS endpoint",
        "cast(o_totalprice / 100 AS int) AS input_tokens",
        "cast(o_totalprice / 200 AS int) AS output_tokens",
        "o_totalprice / 1000 AS latency_ms",
        f"CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 = 0 THEN {status} ELSE 200 END AS status_code",
        "CASE WHEN o_custkey % 4 = 0 THEN cast(30 + (70 * o_custkey) % 250 AS int) END AS churn_day",
    )
    return rows.selectExpr(
        "*", "status_code >= 400 AS is_error", "input_tokens + output_tokens AS total_tokens")


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user-day rollup of the orders, with the region of each user."""
    rollup = user_days(order_events(spark, sf_dir), ("event_date", "user_id", "user_tier"))
    places = users(spark, sf_dir).select("user_id", "region").dropDuplicates(["user_id"])
    return rollup.join(places, "user_id", "left")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tier and region per user."""
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    # Nations do not grow; left to its estimates, Spark may send all customers through the driver instead.
    return customer.join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_custkey AS user_id",
        f"{_case('c_mktsegment', TIER_OF_SEGMENT, repr('free'))} AS user_tier",
        "r_name AS region",
    )


def with_users(df: DataFrame, sf_dir: str, unique: bool = False) -> DataFrame:
    """Add tier and region; a user not known has the tier free and no region.

    ``unique`` states that users are unique, and the join is then left out where only other
    columns are used. Not for single events: the aggregate that states it would keep adaptive
    execution from splitting the partition of a very busy user.
    """
    known = users(df.sparkSession, sf_dir)
    if unique:
        known = known.dropDuplicates(["user_id"])
    joined = df.join(known, "user_id", "left")
    return joined.withColumn("user_tier", F.coalesce("user_tier", F.lit("free")))


def usage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged usage events with all columns."""
    return with_users(events(spark, sf_dir), sf_dir)


def usage_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user-day rollup of the usage events.

    Tier and region are joined to the rollup, not to the events: far fewer rows are shuffled
    by user, and a busy user is a few rows by then.
    """
    rollup = user_days(events(spark, sf_dir), ("event_date", "user_id"))
    return with_users(rollup, sf_dir, unique=True)
