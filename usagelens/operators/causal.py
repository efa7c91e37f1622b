"""Difference in differences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions import dates
from usagelens.functions.distributions import two_sided_t
from usagelens.session import materialize


def rollout_panel(
    df: DataFrame,
    rollout: dt.date | str,
    tier: str,
    region: str,
    date: str = "event_date",
) -> DataFrame:
    """Keep treated and control rows and flag them.

    Treated is one tier in one region. Controls are the same tier elsewhere and the other
    tiers in that region; all other rows belong to neither.
    """
    in_tier, in_region = F.col("user_tier") == tier, F.col("region") == region
    return df.filter(in_tier | in_region).withColumns({
        "treated": in_tier & in_region,
        "post": F.col(date) >= dates.day(rollout),
    })


CELLS = {"treated_pre": -1, "treated_post": 1, "control_pre": 1, "control_post": -1}


def _cells(treated: str, post: str) -> dict[str, Column]:
    return {
        "treated_pre": F.col(treated) & ~F.col(post),
        "treated_post": F.col(treated) & F.col(post),
        "control_pre": ~F.col(treated) & ~F.col(post),
        "control_post": ~F.col(treated) & F.col(post),
    }


def diff_in_diff(
    panel: DataFrame, outcome: str, treated: str = "treated", post: str = "post", user: str | None = None
) -> DataFrame:
    """One row: size and mean of the four cells, ``did``, its standard error and ``t_stat``.

    ``did = (treated after - treated before) - (control after - control before)``, with the
    standard error of four independent means. All of it is one aggregation.

    With ``user`` the rows of one user are not taken as independent: ``clusters`` (users),
    ``cluster_se``, ``cluster_t`` and the two-sided ``p_value`` follow, and ``relative_effect``, the
    effect as a share of what the treated would have had without it. The panel is then aggregated once
    by user, and that table is stored and read twice.
    """
    if user is None:
        return _with_effect(panel.agg(*_cell_aggregates(panel, outcome, treated, post)))
    sums = []
    for name, cell in _cells(treated, post).items():
        value = F.when(cell, F.col(outcome).cast("double"))
        sums += [F.count(value).alias(f"{name}_n"), F.sum(value).alias(f"{name}_sum"),
                 (F.var_pop(value) * F.count(value)).alias(f"{name}_spread")]
    users = materialize(panel.where(F.col(outcome).isNotNull()).groupBy(user).agg(*sums), "rollout-users")
    return _clustered(users)


def _clustered(users: DataFrame) -> DataFrame:
    """The effect from the users' counts, sums and squared deviations in each cell."""
    means = users.agg(*[F.sum(f"{c}_n").alias(f"{c}_all") for c in CELLS], *[
        F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_n").cast("double")).alias(f"{c}_mean") for c in CELLS])
    rows = users.crossJoin(F.broadcast(means))
    # What a user's deviations from the cells' means add to the effect.
    share = sum((sign * F.try_divide(F.coalesce(f"{c}_sum", F.lit(0.0)) - F.col(f"{c}_n") * F.col(f"{c}_mean"),
                                     F.col(f"{c}_all").cast("double")) for c, sign in CELLS.items()), F.lit(0.0))
    own_mean = {c: F.try_divide(F.col(f"{c}_sum"), F.col(f"{c}_n").cast("double")) for c in CELLS}
    spread = {c: F.col(f"{c}_spread") + F.col(f"{c}_n") * (own_mean[c] - F.col(f"{c}_mean")) ** 2 for c in CELLS}
    aggregates = [F.count(F.lit(1)).alias("clusters"), F.sum(share * share).alias("meat")]
    for c in CELLS:
        size = F.max(f"{c}_all")
        aggregates += [F.coalesce(size, F.lit(0)).alias(f"{c}_n"), F.max(f"{c}_mean").alias(f"{c}_mean"),
                       F.when(size > 1, F.sum(spread[c]) / (size - 1)).alias(f"{c}_var")]
    total = sum((F.col(f"{c}_n") for c in CELLS), F.lit(0))
    g = F.col("clusters")
    correction = F.try_divide(g * (total - 1.0), (g - 1.0) * (total - len(CELLS)))
    expected = F.col("treated_post_mean") - F.col("did")
    out = _with_effect(rows.agg(*aggregates), "clusters", "meat")
    out = out.withColumn("cluster_se", F.when(F.col("did").isNotNull(), F.sqrt(F.col("meat") * correction)))
    return out.withColumns({
        "cluster_t": F.try_divide("did", "cluster_se"),
        "relative_effect": F.try_divide(F.col("did"), expected),
    }).withColumn("p_value", two_sided_t(F.col("cluster_t"), g - 1)).drop("meat")


def _cell_aggregates(panel: DataFrame, outcome: str, treated: str, post: str) -> list[Column]:
    aggregates = []
    for name, cell in _cells(treated, post).items():
        value = F.when(cell, F.col(outcome).cast("double"))
        aggregates += [
            F.count(value).alias(f"{name}_n"),
            F.avg(value).alias(f"{name}_mean"),
            F.var_samp(value).alias(f"{name}_var"),
        ]
    return aggregates


def _with_effect(cells: DataFrame, *more: str) -> DataFrame:
    did = (F.col("treated_post_mean") - F.col("treated_pre_mean")) - (
        F.col("control_post_mean") - F.col("control_pre_mean")
    )
    terms = [F.try_divide(F.col(f"{n}_var"), F.col(f"{n}_n").cast("double")) for n in CELLS]
    se = F.sqrt(terms[0] + terms[1] + terms[2] + terms[3])
    return (
        cells.withColumns({"did": did, "se": se})
        .withColumn("t_stat", F.try_divide("did", "se"))
        .select(*[f"{n}_n" for n in CELLS], *[f"{n}_mean" for n in CELLS], "did", "se", "t_stat", *more)
    )
