"""Secret scan: fixed patterns, and probabilistic automata inferred from the credentials they find.

The credentials of each kind form a prefix tree with counts. States whose frequencies agree within
Hoeffding's bound, and whose successors agree likewise, are merged; what is left is a deterministic
probabilistic automaton of the format. The tree of all credentials is counted and compared by Spark,
only the automaton itself is on the driver. Every candidate string of a text is scored by its likelihood
under the automata, a character at a time, and reported where it is as likely as the labelled ones.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import map_texts
from usagelens.operators.rank_select import exact_percentile
from usagelens.session import materialize

KINDS = ("assign", "access", "hex")
LEARNED = "format"

# Fixed patterns. Greedy runs are matched whole and short ones dropped afterwards; for the runs of
# one class this is the same as asking for their length in the pattern.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}(?![A-Za-z0-9+/_=-])")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[tuple[Span, str]]:
    """Spans (kind, start, end in code points) of the fixed patterns with their credentials, by
    start and then kind."""
    found = [(("assign", m.start(), m.end()), m[2]) for m in ASSIGN.finditer(text)
             if len(m[2]) >= ASSIGN_LEAST]
    found += [(("access", m.start(), m.end()), m[0]) for m in ACCESS.finditer(text)]
    found += [(("hex", m.start(), m.end()), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[0][1], KINDS.index(f[0][0])))


class Automaton(NamedTuple):
    """``moves[state]``: symbol to (probability, next state); ``stop[state]``: probability to end."""

    kind: str
    moves: list[dict[str, tuple[float, int]]]
    stop: list[float]
    threshold: float


def infer(samples: list[str], alpha: float = 0.05) -> tuple[list[dict[str, tuple[float, int]]], list[float]]:
    """The automaton of a few ``samples`` by state merging, in the order of the prefix tree's levels:
    the plain form of :func:`infer_all`."""
    edges: list[dict[str, int]] = [{}]
    passed, ended = [0], [0]
    for sample in samples:
        state = 0
        passed[0] += 1
        for symbol in sample:
            if symbol not in edges[state]:
                edges[state][symbol] = len(edges)
                edges.append({})
                passed.append(0)
                ended.append(0)
            state = edges[state][symbol]
            passed[state] += 1
        ended[state] += 1
    used = [{s: passed[t] for s, t in e.items()} for e in edges]
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def differs(f1: int, n1: int, f2: int, n2: int) -> bool:
        return n1 > 0 and n2 > 0 and abs(f1 / n1 - f2 / n2) > bound * (n1 ** -0.5 + n2 ** -0.5)

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            if differs(ended[x], passed[x], ended[y], passed[y]):
                return False
            for s in used[x].keys() | used[y].keys():
                if differs(used[x].get(s, 0), passed[x], used[y].get(s, 0), passed[y]):
                    return False
                if s in edges[x] and s in edges[y]:
                    todo.append((edges[x][s], edges[y][s]))
        return True

    def fold(a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            passed[x] += passed[y]
            ended[x] += ended[y]
            for s, t in edges[y].items():
                used[x][s] = used[x].get(s, 0) + used[y][s]
                if s in edges[x]:
                    todo.append((edges[x][s], t))
                else:
                    edges[x][s] = t

    red = [0]
    blue = [(0, s) for s in sorted(edges[0])]
    while blue:
        source, symbol = blue.pop(0)
        state = edges[source][symbol]
        if state in red:
            continue
        for r in red:
            if compatible(r, state):
                edges[source][symbol] = r
                fold(r, state)
                break
        else:
            red.append(state)
        blue = [(r, s) for r in red for s in sorted(edges[r]) if edges[r][s] not in red]
    number = {r: i for i, r in enumerate(red)}
    moves = [{s: (used[r][s] / passed[r], number[t]) for s, t in edges[r].items()} for r in red]
    return moves, [ended[r] / passed[r] for r in red]


Moves = dict[tuple[int, str], int]
#: Code points by which prefixes are lengthened at a time, so that long credentials stay cheap.
DEPTH = 32


def follow(moves: Moves, state: int, word: str) -> tuple[int, int]:
    """Where ``word`` leads from a state: the last state, and how many symbols were read till there."""
    for i, symbol in enumerate(word):
        if (after := moves.get((state, symbol))) is None:
            return state, i
        state = after
    return state, len(word)


def _paths(credentials: DataFrame, moves: dict[str, Moves]) -> DataFrame:
    """Counts of (kind, state, symbol) that the credentials pass, the symbol "" being the end; and, where a
    symbol leads to no state yet, also counts with the ``rest`` that follows it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = Counter()
            for kind, value in zip(batch["kind"], batch["value"]):
                state = 0
                for i, symbol in enumerate(value):
                    counts[kind, state, symbol, None] += 1
                    if (kind_moves := moves[kind].get((state, symbol))) is None:
                        counts[kind, state, symbol, value[i + 1:]] += 1
                        break
                    state = kind_moves
                else:
                    counts[kind, state, "", None] += 1
            yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["kind", "state", "symbol", "rest", "n"])

    schema = "kind string, state int, symbol string, rest string, n long"
    return credentials.mapInPandas(run, schema).groupBy("kind", "state", "symbol", "rest").agg(F.sum("n").alias("n"))


def _tree(paths: DataFrame) -> DataFrame:
    """Nodes (kind, state, symbol, at) below the edges without a state, ``at`` being the string from there,
    with ``used``: how often each symbol follows, "" being the end.

    Only nodes that are passed twice or more: by the bound, a node that is passed once differs from none.
    """
    edge = ["kind", "state", "symbol"]
    rests, out, depth = paths.where("rest is not null"), None, 0
    while True:
        steps = F.sequence(F.lit(depth), F.least(F.length("rest"), F.lit(depth + DEPTH - 1)))
        places = F.transform(steps, lambda i: F.struct(
            F.substring("rest", F.lit(1), i).alias("at"), F.substring("rest", i + 1, F.lit(1)).alias("next")))
        counted = rests.where(F.length("rest") >= depth).select(*edge, "n", F.explode(places).alias("p")).groupBy(
            *edge, "p.at", "p.next").agg(F.sum("n").alias("n"))
        nodes = materialize(counted.groupBy(*edge, "at").agg(
            F.map_from_entries(F.collect_list(F.struct("next", "n"))).alias("used"), F.sum("n").alias("passed")
        ).where("passed > 1"), "credential-tree")
        out = nodes if out is None else out.unionByName(nodes)
        depth += DEPTH
        # What still has company this deep is followed further.
        deep = nodes.where(F.length("at") == depth - 1).select(*edge, "at")
        if deep.isEmpty():
            return out
        rests = materialize(rests.withColumn("at", F.substring("rest", 1, depth - 1)).join(
            deep, [*edge, "at"], "left_semi").drop("at"), "credential-rests")


def _differ(bound: float, a: str, b: str) -> Column:
    """Whether two maps of counts differ in some share by more than Hoeffding's bound."""
    total = lambda m: F.aggregate(F.map_values(m), F.lit(0).cast("long"), lambda s, v: s + v).cast("double")
    n1, n2 = total(a), total(b)
    share = lambda m, n, k: F.coalesce(F.element_at(m, k), F.lit(0)) / n
    return F.exists(F.array_union(F.map_keys(a), F.map_keys(b)), lambda k: F.abs(
        share(a, n1, k) - share(b, n2, k)) > bound * (1 / F.sqrt(n1) + 1 / F.sqrt(n2)))


def _clashes(tree: DataFrame, reds: dict[str, list[Counter]], moves: dict[str, Moves], bound: float) -> set[tuple]:
    """(kind, state, symbol, red) for each edge without a state and each state that it cannot be merged with."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = {kind: [sum(c.values()) for c in states] for kind, states in reds.items()}
        for batch in batches:
            out = []
            for kind, state, symbol, at, used, passed in batch.itertuples(index=False):
                used = dict(used)
                for red in range(len(reds[kind])):
                    there, read = follow(moves[kind], red, at)
                    if read < len(at):
                        out.append((kind, state, symbol, red, used, there, at[read], at[read + 1:]))
                        continue
                    seen, n = reds[kind][there], totals[kind][there]
                    if n and any(abs(seen[s] / n - used.get(s, 0) / passed) > bound * (n ** -0.5 + passed ** -0.5)
                                 for s in seen.keys() | used.keys()):
                        out.append((kind, state, symbol, red, None, None, None, None))
            yield pd.DataFrame(out, columns=names)

    names = ["kind", "state", "symbol", "red", "used", "to_state", "to_symbol", "to_at"]
    found = tree.select("kind", "state", "symbol", "at", "used", "passed").mapInPandas(
        run, "kind string, state int, symbol string, red int, used map<string,long>, to_state int, to_symbol string, to_at string")
    other = tree.select("kind", F.col("state").alias("to_state"), F.col("symbol").alias("to_symbol"),
                        F.col("at").alias("to_at"), F.col("used").alias("other"))
    joined = found.join(other, ["kind", "to_state", "to_symbol", "to_at"], "left")
    clash = F.col("to_state").isNull() | (F.col("other").isNotNull() & _differ(bound, "used", "other"))
    return {tuple(r) for r in joined.where(clash).select("kind", "state", "symbol", "red").distinct().collect()}


def _edges_apart(tree: DataFrame, edges: DataFrame, bound: float) -> set[tuple]:
    """(kind, state, symbol, state, symbol) for pairs of ``edges`` that cannot be merged with each other."""
    own = tree.join(F.broadcast(edges), ["kind", "state", "symbol"], "left_semi")
    a, b = (own.select("kind", "at", *[F.col(c).alias(f"{c}{i}") for c in ("state", "symbol", "used")]) for i in (1, 2))
    pairs = a.join(b, ["kind", "at"]).where("(state1, symbol1) < (state2, symbol2)").where(_differ(bound, "used1", "used2"))
    return {tuple(r) for r in pairs.select("kind", "state1", "symbol1", "state2", "symbol2").distinct().collect()}


def infer_all(credentials: DataFrame, kinds: list[str], alpha: float = 0.05) -> dict[str, tuple[list, list[float]]]:
    """The automata of all ``credentials`` (kind, value) by state merging, for all kinds at once.

    In each round the credentials run through the automata found so far. An edge that leads to no state yet
    is merged with the first state it agrees with, on the counts of that round. Of the edges that agree with
    none those become states that agree with no new one either; the rest wait for the next round. So the
    rounds follow the automaton's depth, and the driver holds counts by state and symbol only.
    """
    bound = math.sqrt(0.5 * math.log(2 / alpha))
    moves: dict[str, Moves] = {kind: {} for kind in kinds}
    states = {kind: 1 for kind in kinds}
    credentials = credentials.where(F.col("kind").isin(kinds))
    while True:
        paths = materialize(_paths(credentials, moves), "credential-paths")
        reds = {kind: [Counter() for _ in range(states[kind])] for kind in kinds}
        for kind, state, symbol, n in paths.where("rest is null").select("kind", "state", "symbol", "n").collect():
            reds[kind][state][symbol] = n
        blue = [(kind, state, symbol) for kind in kinds for state, seen in enumerate(reds[kind])
                for symbol in sorted(seen) if symbol and (state, symbol) not in moves[kind]]
        if not blue:
            break
        tree = _tree(paths)
        clashes = _clashes(tree, reds, moves, bound)
        left = []
        for kind, state, symbol in blue:
            fits = (r for r in range(len(reds[kind])) if (kind, state, symbol, r) not in clashes)
            if (red := next(fits, None)) is None:
                left.append((kind, state, symbol))
            else:
                moves[kind][state, symbol] = red
        apart = set()
        if len(left) > 1:
            apart = _edges_apart(tree, credentials.sparkSession.createDataFrame(
                left, "kind string, state int, symbol string"), bound)
        made = defaultdict(list)
        for kind, *edge in left:
            if all((kind, *min(edge, e), *max(edge, e)) in apart for e in made[kind]):
                made[kind].append(edge)
                moves[kind][tuple(edge)] = states[kind]
                states[kind] += 1
    out = {}
    for kind in kinds:
        totals = [sum(seen.values()) or 1 for seen in reds[kind]]
        out[kind] = ([{s: (n / totals[state], moves[kind][state, s]) for s, n in seen.items() if s}
                      for state, seen in enumerate(reds[kind])],
                     [seen[""] / totals[state] for state, seen in enumerate(reds[kind])])
    return out


#: Probability of a symbol that a state has never seen.
RARE = 1e-4


def likelihood(text: str, moves: list[dict[str, tuple[float, int]]], stop: list[float]) -> float:
    """Log-likelihood of ``text`` for each character; an unseen symbol stays in its state."""
    state, total = 0, 0.0
    for symbol in text:
        p, after = moves[state].get(symbol, (RARE, state))
        total += math.log(max(p, RARE))
        state = after
    return (total + math.log(max(stop[state], RARE))) / (len(text) + 1)


def train(docs: DataFrame, text: str = "text", margin: float = 0.02) -> list[Automaton]:
    """Automata of the credentials that the fixed patterns find in ``docs``.

    All distinct credentials are used. Half of them, by hash, build the automaton of their kind. The
    threshold lets pass all but a share of ``margin`` of the other half, so it is not fitted to strings
    already seen. A kind with fewer than ten credentials, or with one half empty, has no automaton.
    """

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = {(span[0], value) for t in batch[text] if t for span, value in base_spans(t)}
            yield pd.DataFrame(sorted(out), columns=["kind", "value"])

    found = materialize(docs.select(text).mapInPandas(label, "kind string, value string").distinct().withColumn(
        "builds", F.xxhash64("value") % 2 == 0), "credentials")
    halves = Counter()
    for kind, builds, n in found.groupBy("kind", "builds").count().collect():
        halves[kind, builds] = n
    kinds = [k for k in KINDS if halves[k, True] and halves[k, False] and halves[k, True] + halves[k, False] >= 10]
    if not kinds:
        return []
    inferred = infer_all(found.where("builds").select("kind", "value"), kinds)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"kind": batch["kind"], "score": [
                likelihood(v, *inferred[k]) for k, v in zip(batch["kind"], batch["value"])]})

    others = found.where(~F.col("builds") & F.col("kind").isin(kinds)).select("kind", "value")
    scores = materialize(others.mapInPandas(score, "kind string, score double"), "credential-scores")
    cut = exact_percentile(scores, ["kind"], "score", margin, "cut")
    # The cut may lie between two scores; the lower one still passes.
    least = scores.join(cut, "kind").groupBy("kind").agg(
        F.coalesce(F.max(F.when(F.col("score") <= F.col("cut"), F.col("score"))), F.min("score")))
    thresholds = {r[0]: r[1] for r in least.collect()}
    return [Automaton(kind, *inferred[kind], thresholds[kind]) for kind in kinds]


def learned_spans(text: str, base: list[Span], automata: list[Automaton]) -> list[Span]:
    """Candidates with a letter and a digit that touch no base span and that some automaton takes
    for one of its format."""
    out = []
    for m in CANDIDATE.finditer(text):
        value = m[0]
        if value.isalpha() or not any(map(str.isdigit, value)) or not any(map(str.isalpha, value)):
            continue
        if any(start < m.end() and m.start() < end for _, start, end in base):
            continue
        if any(likelihood(value, a.moves, a.stop) >= a.threshold for a in automata):
            out.append((LEARNED, m.start(), m.end()))
    return out


def find_spans(docs: DataFrame, automata: list[Automaton], text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (kind, start, end) by start, then kind.

    Places are code points, the end exclusive. ``spans`` has the base spans and those the automata
    add. Null and empty texts have none; columns of these names are replaced. Nothing is shuffled.
    """
    span = "array<struct<kind: string, start: int, end: int>>"
    shared = docs.sparkSession.sparkContext.broadcast(automata)
    order = {kind: i for i, kind in enumerate((*KINDS, LEARNED))}

    def make(texts: list[str | None]) -> list:
        base = [[s for s, _ in base_spans(t)] if t else [] for t in texts]
        more = [learned_spans(t, own, shared.value) if t else [] for t, own in zip(texts, base, strict=True)]
        every = [sorted(a + b, key=lambda s: (s[1], order[s[0]])) for a, b in zip(base, more, strict=True)]
        return [[[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in rows]
                for rows in (base, every)]

    return map_texts(docs, text, f"base {span}, spans {span}", lambda: make)


def redact(docs: DataFrame, automata: list[Automaton], text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with ``mark`` in place of every span; overlapping spans become one mark.

    A document without spans is unchanged, and so is a null text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(automata)

    def clean(t: str | None) -> str | None:
        if not t:
            return t
        own = [s for s, _ in base_spans(t)]
        out, at = [], 0
        for _, start, end in sorted(own + learned_spans(t, own, shared.value), key=lambda s: s[1:]):
            if start >= at:
                out += [t[at:start], mark]
            at = max(at, end)
        return "".join([*out, t[at:]])

    cleaned = map_texts(docs, text, "__s_clean string", lambda: lambda texts: [[clean(t) for t in texts]])
    return cleaned.withColumn(text, F.col("__s_clean")).select(docs.columns)
