"""URL filter: host and path rules first, then the ratio of two character language models.

The rules label a part of the URLs. Their characters train two Markov models of variable order,
one of accepted and one of rejected URLs; an order counts for as long as its context has been seen,
and every order is smoothed by the one below. The difference of the two log-likelihoods is a sum
over the substrings of a URL, so scoring is a join with a table of substring weights.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import LOWER, UPPER, count_floor
from usagelens.session import materialize


class UrlRule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
)

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def split_url(url: str = "url") -> dict[str, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for a URL without ``://``."""
    part = lambda i: F.coalesce(F.regexp_extract(F.col(url), PARTS, i), F.lit(""))
    return {"host": F.translate(part(1), UPPER, LOWER), "path": part(2)}


def matched_rule(rules: tuple[UrlRule, ...] = RULES) -> Column:
    """The longest rule that fits ``host`` and ``path``, as a struct (length, rule, verdict)."""
    fits = []
    for r in rules:
        host = (F.col("host") == r.host) | F.endswith(F.col("host"), F.lit("." + r.host))
        fits.append(F.when(host & F.startswith(F.col("path"), F.lit(r.path)), F.struct(
            F.lit(len(r.text)).alias("length"), F.lit(r.text).alias("rule"),
            F.lit(r.verdict).alias("verdict"))))
    return F.greatest(*fits) if len(fits) > 1 else fits[0]


def grams(text: Column, order: int, shortest: int = 1) -> Column:
    """Substrings of ``shortest`` to ``order`` characters of a text framed by marks, ending at each
    place."""
    chars = F.concat(F.array(F.lit("^")), F.filter(F.split(text, ""), lambda c: c != ""),
                     F.array(F.lit("$")))
    at = F.sequence(F.lit(1), F.size(chars))
    return F.flatten(F.transform(at, lambda i: F.transform(
        F.sequence(F.lit(shortest), F.least(F.lit(order), i)),
        lambda n: F.array_join(F.slice(chars, i - n + 1, n), ""))))


def train(labelled: DataFrame, order: int = 4, weight: float = 4.0, min_count: int = 3,
          max_grams: int | None = None) -> DataFrame:
    """Substrings with weights and counts (gram, weight, n) from ``labelled`` (key, accepted, n).

    All rows count. A substring seen fewer than ``min_count`` times is left to the order below, and
    so is a context; contexts are counted before. With ``max_grams`` the bound rises, in steps of an
    eighth of a power of two, until at most so many are left; without it the model grows with the
    URLs. With p_o(c | ctx) = (n(ctx c) + weight * p_{o-1}) / (n(ctx) + weight) in each model, a
    substring's weight is its change of log p_accepted - log p_rejected against the order below; a
    context's weight is that of a character never seen after it.
    """
    spark = labelled.sparkSession
    side = lambda flag: F.sum(F.when(F.col("accepted") == flag, F.col("n")).otherwise(0))
    counted = (labelled.select("accepted", "n", F.explode(grams(F.col("key"), order)).alias("gram"))
               .groupBy("gram").agg(side(True).alias("a"), side(False).alias("r")))
    counted = materialize(counted.withColumn("level", F.length("gram")), "url-grams")
    counted = counted.withColumn("both", F.col("a") + F.col("r"))
    least = min_count
    if max_grams is not None:
        if (floor := count_floor(counted, "both", max_grams)) is None:
            return spark.createDataFrame([], "gram string, weight double, n long")
        least = max(floor, min_count)
    context = F.expr("substring(gram, 1, level - 1)")
    contexts = materialize(counted.groupBy(context.alias("context")).agg(
        F.sum("a").alias("ca"), F.sum("r").alias("cr")).where(F.col("ca") + F.col("cr") >= least), "url-contexts")
    counted = counted.where(F.col("both") >= least)
    below, levels, base = None, [], 1.0 / 256
    for level in range(1, order + 1):
        rows = counted.where(F.col("level") == level).withColumns({
            "context": context, "suffix": F.expr("substring(gram, 2)")}).join(contexts, "context")
        if below is None:
            rows = rows.withColumns({"qa": F.lit(base), "qr": F.lit(base)})
        else:
            rows = rows.join(below.select(
                F.col("gram").alias("suffix"), F.col("pa").alias("qa"), F.col("pr").alias("qr")), "suffix")
        p = lambda n, c, q: (F.col(n) + weight * F.col(q)) / (F.col(c) + weight)
        below = materialize(rows.withColumns({"pa": p("a", "ca", "qa"), "pr": p("r", "cr", "qr")})
                            .select("gram", "both", "ca", "cr", "pa", "pr", "qa", "qr"), "url-level")
        levels.append(below)
    every = levels[0]
    for level in levels[1:]:
        every = every.union(level)
    unseen = lambda a, r: F.log(F.col(r) + weight) - F.log(F.col(a) + weight)
    seen = every.select("gram", (F.log(F.col("pa") / F.col("qa")) - F.log(F.col("pr") / F.col("qr"))
                                 - unseen("ca", "cr")).alias("w"), F.col("both").alias("n"))
    after = contexts.select(F.col("context").alias("gram"), unseen("ca", "cr").alias("w"),
                            (F.col("ca") + F.col("cr")).alias("n"))
    return materialize(seen.union(after).groupBy("gram")
                       .agg(F.sum("w").alias("weight"), F.max("n").alias("n")), "url-model")


def score(keys: DataFrame, model: DataFrame, order: int = 4, most_broadcast: int = 100_000) -> DataFrame:
    """``keys`` (key: distinct) with ``score``, the difference of log-likelihoods per character.

    At most ``most_broadcast`` of the model's most frequent substrings are broadcast; the distinct
    substrings of a key that are not among them meet the rest of the model through a shuffle. A key
    without a known substring has 0.
    """
    floor = count_floor(model, "n", most_broadcast)
    often = F.lit(False) if floor is None else F.col("n") >= floor
    frequent, rest = (model.where(c).select("gram", "weight") for c in (often, ~often))
    # The empty substring at each place stands for the context that is always there.
    parts = keys.select("key", F.explode(grams(F.col("key"), order, 0)).alias("gram"))
    totals = (parts.join(F.broadcast(frequent), "gram", "left").groupBy("key")
              .agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("total")))
    if not rest.isEmpty():
        others = materialize(parts.join(F.broadcast(frequent), "gram", "left_anti")
                             .groupBy("key", "gram").count(), "url-others")
        # Written apart, so that adaptive execution can split a substring that very many keys have.
        found = materialize(others.join(rest, "gram").select(
            "key", (F.col("weight") * F.col("count")).alias("total")), "url-found")
        totals = totals.union(found).groupBy("key").agg(F.sum("total").alias("total"))
    return totals.select("key", (F.col("total") / (F.length("key") + 1)).alias("score"))


def calibrate(scored: DataFrame, bins: int = 400, limit: float = 10.0) -> float:
    """The cut of ``scored`` (score, accepted, n) with the lowest mean error of both sides."""
    width = 2 * limit / bins
    place = F.floor((F.greatest(F.lit(-limit), F.least(F.lit(limit), F.col("score"))) + limit) / width)
    rows = sorted(map(tuple, scored.groupBy(place.alias("bin")).agg(
        F.sum(F.when(F.col("accepted"), F.col("n")).otherwise(0)),
        F.sum(F.when(~F.col("accepted"), F.col("n")).otherwise(0))).collect()))
    good, bad = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not good or not bad:
        return 0.0
    best, cut, lost, left = 1.0, 0.0, 0, bad
    for at, a, r in rows:
        if (error := (lost / good + left / bad) / 2) < best:
            best, cut = error, at * width - limit
        lost, left = lost + a, left - r
    return cut


def judge(pages: DataFrame, url: str = "url", rules: tuple[UrlRule, ...] = RULES,
          order: int = 4) -> DataFrame:
    """``pages`` with host, path, rule (null where none fits), score and verdict.

    Null and malformed URLs have an empty host and path and are judged by the model as an empty
    text. Repeated pages get a row each; equal keys are scored once. Without labels of both kinds
    every score is 0 and the models allow. Columns of these names in ``pages`` are replaced.
    """
    parts = pages.drop("host", "path", "rule", "verdict", "score").withColumns(split_url(url))
    found = matched_rule(rules)
    parts = parts.withColumns({"rule": found["rule"], "__u_by_rule": found["verdict"],
                               "__u_key": F.concat("host", "path")})
    keys = materialize(parts.groupBy(F.col("__u_key").alias("key"), "__u_by_rule").count()
                       .withColumnsRenamed({"count": "n"}), "url-keys")
    labelled = keys.where("__u_by_rule is not null").select(
        "key", (F.col("__u_by_rule") == "allow").alias("accepted"), "n")
    model = train(labelled, order)
    # A key makes hundreds of substrings: deal the keys out before they are exploded.
    parallel = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.select("key").repartition(parallel, "key").distinct()
    scores = materialize(score(dealt, model, order), "url-scores")
    cut = calibrate(labelled.join(scores, "key"))
    by_model = F.when(F.col("score") >= cut, "allow").otherwise("block")
    return (parts.join(scores.withColumnRenamed("key", "__u_key"), "__u_key")
            .withColumn("verdict", F.coalesce("__u_by_rule", by_model)).drop("__u_key", "__u_by_rule"))
