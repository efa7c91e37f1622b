"""The models, trained and written out in one run."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.operators.causal import diff_in_diff, rollout_panel
from usagelens.operators.churn import ChurnModel, train_churn
from usagelens.operators.cohorts import retained_within
from usagelens.operators.isolation_forest import IsolationForestModel, fit_isolation_forest
from usagelens.operators.measures import is_rollup, user_days
from usagelens.operators.quality import label_guard
from usagelens.operators.survival import kaplan_meier
from usagelens.operators.users import (
    churn_features, feature_columns, numeric_durations, user_lifetimes,
)
from usagelens.plans import reports
from usagelens.session import materialize
from usagelens.sources.files import write_csv, write_json, write_text


def _rollup(df: DataFrame) -> DataFrame:
    return df if is_rollup(df) else materialize(user_days(df), "user-days")


def anomaly_model(df: DataFrame, n: int = 7, **params) -> tuple[IsolationForestModel, DataFrame]:
    """Fit on the daily features; gives the model and the scored days."""
    features = materialize(reports.anomaly_features(df, n), "anomaly-features")
    model = fit_isolation_forest(features, reports.anomaly_columns(n), "event_date", **params)
    return model, model.transform(features)


def churn_model(df: DataFrame, as_of: dt.date | str, **params) -> ChurnModel:
    return train_churn(churn_features(df, as_of), feature_columns(), **params)


def survival_curves(
    df: DataFrame, as_of: dt.date | str, inactive_days: int = 30, inverted: bool = False
) -> DataFrame:
    """Survival per tier; ``inverted`` counts the users still active as the observed ends."""
    lifetimes = numeric_durations(user_lifetimes(df, as_of, inactive_days))
    if inverted:
        lifetimes = lifetimes.withColumn("churned", 1 - F.col("churned"))
    return kaplan_meier(lifetimes)


def rollout_effect(
    df: DataFrame, rollout: dt.date | str, tier: str, region: str, days: int = 7
) -> DataFrame:
    """Effect of a rollout on return within ``days`` days and on tokens per user and day."""
    rollup = _rollup(df)
    returns = retained_within(rollup, days, keep=["user_tier", "region"])
    outcomes = {
        "retained": (returns, "retained"),
        "tokens_per_user_day": (rollup, "total_tokens"),
    }
    parts = [
        diff_in_diff(rollout_panel(panel, rollout, tier, region), column, user="user_id").select(
            F.lit(name).alias("outcome"), "*"
        )
        for name, (panel, column) in outcomes.items()
    ]
    return parts[0].unionByName(parts[1])


def rollout_report(effects: DataFrame) -> DataFrame:
    """The measured effects as text, one line per outcome; errors and p-values are those by user."""
    return effects.select(F.format_string(
        "- **%s**: treated %.4f -> %.4f, control %.4f -> %.4f, effect %+.4f (%+.2f%%; se %.4f, t %.2f, p %.4f; %d users)",
        "outcome", "treated_pre_mean", "treated_post_mean", "control_pre_mean", "control_post_mean",
        "did", F.col("relative_effect") * 100, "cluster_se", "cluster_t", "p_value", "clusters",
    ).alias("line"))


def train_all(
    df: DataFrame, as_of: dt.date | str, out: str, rollout: dt.date | str, tier: str, region: str,
    inactive_days: int = 30, **churn_params,
) -> dict[str, str]:
    """Run every model over staged events and write its results below ``out``.

    The churn model is skipped when there are too few positive labels; that check's result is
    written either way. The events are read once for the rollup that all models share, and
    once more for the percentile in the summary.
    """
    rollup = _rollup(df)
    paths = {name: os.path.join(out, name) for name in (
        "label_guard", "anomalies", "survival_curves", "causal_report", "narrative")}
    guard = label_guard(churn_features(rollup, as_of))
    write_json(guard, paths["label_guard"])
    write_csv(anomaly_model(rollup)[1], paths["anomalies"])
    if guard.first()["sufficient"]:
        churn = churn_model(rollup, as_of, **churn_params)
        for name, result in (("importances", churn.importances()), ("metrics", churn.metrics())):
            paths[name] = os.path.join(out, name)
            write_json(result, paths[name])
    write_csv(survival_curves(rollup, as_of, inactive_days), paths["survival_curves"])
    write_text(rollout_report(rollout_effect(rollup, rollout, tier, region)), paths["causal_report"])
    write_text(reports.narrative(df), paths["narrative"])
    return paths
