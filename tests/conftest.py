import datetime as dt

import pytest

from usagelens.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "usagelens-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


STAGED = (
    "event_id string, timestamp timestamp, event_date date, user_id string, user_tier string, "
    "endpoint string, input_tokens int, output_tokens int, total_tokens bigint, latency_ms double, "
    "status_code int, error_type string, is_error boolean, region string, churn_day int"
)


@pytest.fixture
def make_events(spark):
    """Staged events from (id, timestamp, user) and overrides by name."""

    def make(rows):
        out = []
        for i, row in enumerate(rows):
            row = dict(row)
            ts = dt.datetime.fromisoformat(row.get("timestamp", "2024-01-01 00:00:00"))
            status = row.get("status_code", 200)
            tokens = row.get("input_tokens", 100), row.get("output_tokens", 50)
            out.append((
                row.get("event_id", f"e{i}"), ts.replace(tzinfo=dt.timezone.utc), ts.date(),
                row.get("user_id", "u1"), row.get("user_tier", "free"),
                row.get("endpoint", "/v1/chat"), *tokens, sum(tokens),
                row.get("latency_ms", 10.0), status, row.get("error_type"),
                status >= 400, row.get("region", "eu"), row.get("churn_day"),
            ))
        return spark.createDataFrame(out, STAGED)

    return make
