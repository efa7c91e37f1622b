"""Repair of conversation structure by iterative-deepening A*.

A conversation should be blank, or a system row at most and then pairs of user and assistant rows. Rows
are kept, given another role, deleted, or inserted; the cheapest edits are found by depth-first search
in the ASCII order of the edits' letters under a bound on the cost. The bound rises to the least cost
that the last search could not rule out, so the first path found is the cheapest, and of equally cheap
ones the least in ASCII order. States that failed are kept with the cost below which they fail.

Long conversations are searched in stretches from the end on: the costs from the start of one stretch
are what is added at the end of the stretch before, for each state it may end in. That gives the same
path as one search, in time linear in the rows. Of a conversation only a few bytes a row are held at
once; its texts pass through one after another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from usagelens.llm.common import SPACE_CLASS
from usagelens.session import materialize

DELETE, INSERT, KEEP, REROLE = "DIKR"
COSTS = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
#: States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a user or assistant row, whichever may follow, leads to.
FOLLOWING = (USER, USER, ASSISTANT, USER)
#: Cost and inserted rows that complete a conversation which ends in each state.
ENDINGS = ((0, ""), (4, "II"), (2, "I"), (0, ""))
#: A row's faults, the first that holds counts.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
SYSTEM_ROW, USER_ROW, ASSISTANT_ROW, OTHER_ROW = range(4)
STRETCH = 32
ROLE_NAMES = {"u": "user", "a": "assistant"}


@cache
def moves(kind: int, fault: int, state: int) -> tuple[tuple[str, int, int, int], ...]:
    """(edit, cost, rows used, next state) in ASCII order for a row in a state."""
    out = [(DELETE, COSTS[DELETE], 1, state), (INSERT, COSTS[INSERT], 0, FOLLOWING[state])]
    if fault not in (BLANK, DUPLICATE):
        extra = int(fault == TRUNCATED)
        if kind == SYSTEM_ROW and state == START:
            out.append((KEEP, extra, 1, SYSTEM))
        elif kind in (USER_ROW, ASSISTANT_ROW) and FOLLOWING[state] == (USER, ASSISTANT)[kind - USER_ROW]:
            out.append((KEEP, extra, 1, FOLLOWING[state]))
        out.append((REROLE, COSTS[REROLE] + extra, 1, FOLLOWING[state]))
    return tuple(out)


class Stretch:
    """Searches in a run of rows, given as (kind, fault); ``after``: the cost added for each state it
    ends in."""

    def __init__(self, rows: list[tuple[int, int]], after: list[int]) -> None:
        self.rows, self.after = rows, after
        least = [min(after)]
        for _, fault in reversed(rows):
            least.append(least[-1] + (0, COSTS[DELETE], COSTS[DELETE], 1)[fault])
        self.least = least[::-1]
        #: For states that failed, the least cost they may succeed with.
        self.failed: dict[tuple[int, int], int] = {}

    def need(self, at: int, state: int) -> int:
        return self.failed.get((at, state), self.least[at])

    def find(self, at: int, state: int, budget: int) -> str | None:
        """The first path within the budget; without one, the state's entry in ``failed`` rises."""
        if self.need(at, state) > budget:
            return None
        if at == len(self.rows):
            if self.after[state] <= budget:
                return ""
            self.failed[at, state] = self.after[state]
            return None
        lacking = []
        for edit, cost, used, following in moves(*self.rows[at], state):
            rest = self.find(at + used, following, budget - cost)
            if rest is not None:
                return edit + rest
            lacking.append(cost + self.need(at + used, following))
        self.failed[at, state] = min(lacking)
        return None

    def cheapest(self, state: int) -> tuple[int, str]:
        """Cost and path from the first row in a state."""
        while True:
            bound = self.need(0, state)
            path = self.find(0, state, bound)
            if path is not None:
                return bound, path


def cheapest_edits(rows: list[tuple[int, int]], stretch: int = STRETCH) -> tuple[int, str]:
    """Cost and letters of the cheapest edits for a conversation of (kind, fault) rows."""
    after, plans = [cost for cost, _ in ENDINGS], []
    for low in reversed(range(0, len(rows), stretch)):
        search = Stretch(rows[low:low + stretch], after)
        found = [search.cheapest(state) for state in range(len(ENDINGS))] if low else [search.cheapest(START)]
        after = [cost for cost, _ in found]
        plans.append([path for _, path in found])
    state, at, out = START, 0, []
    for paths in reversed(plans):
        out.append(paths[state])
        for _, state, at in walk(rows, paths[state], state, at):
            pass
    out.append(ENDINGS[state][1])
    return after[START], "".join(out)


def walk(rows: list[tuple[int, int]], path: str, state: int = START, at: int = 0) -> Iterator[tuple[str, int, int]]:
    """(edit, state after it, rows used so far) for the letters of a path."""
    for edit in path:
        if edit == KEEP and rows[at][0] == SYSTEM_ROW:
            state = SYSTEM
        elif edit != DELETE:
            state = FOLLOWING[state]
        at += edit != INSERT
        yield edit, state, at


def row_edits(rows: list[tuple[int, int]], path: str) -> list[tuple[str, str]]:
    """(edits, roles they give) for each row: those up to the one that uses it; the last row also
    has what follows it. Roles: u, a, k for the row's own, - for none."""
    out, edits, roles = [], "", ""
    for edit, state, at in walk(rows, path):
        edits += edit
        roles += "-" if edit == DELETE else "k" if edit == KEEP else "ua"[state - USER]
        if edit != INSERT and at < len(rows):
            out.append((edits, roles))
            edits = roles = ""
    return [*out, (edits, roles)]


def ordered(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, at): rows numbered within a conversation by turn, nulls first, then role
    and text in code-point order; null roles and texts are one space."""
    filled = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                         *[F.coalesce(F.col(c), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    order = W.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return filled.withColumn("at", F.row_number().over(order).cast("long"))


def row_kind(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    out = F.lit(OTHER_ROW)
    for letter, kind in (("s", SYSTEM_ROW), ("u", USER_ROW), ("a", ASSISTANT_ROW)):
        out = F.when(first == letter, F.lit(kind)).otherwise(out)
    return out


def by_conversation(rows: DataFrame, *order: str) -> DataFrame:
    """Whole conversations in one partition each, in order, so that they can be read as a stream."""
    return rows.repartition("conv").sortWithinPartitions("conv", *order)


def planned_edits(placed: DataFrame) -> DataFrame:
    """(conv, at, fault, edits, roles) for each row of ``placed`` (see :func:`ordered`).

    The search sees a byte for role and faults and a 16-byte digest of role and text of each row.
    """
    blank = ~F.col("text").rlike("[^ \\t\\n\\x0B\\f\\r]")
    truncated = ~F.col("text").rlike(f"[.!?]{SPACE_CLASS}*\\z")
    # The length of the role tells where the text starts.
    digest = F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text"))
    light = placed.select(
        "conv", "at", row_kind(F.col("role")).cast("byte").alias("kind"),
        F.when(blank, BLANK).when(truncated, TRUNCATED).otherwise(SOUND).cast("byte").alias("fault"),
        F.unhex(digest).alias("digest"))
    key = placed.schema["conv"]
    schema = T.StructType([key, *T.StructType.fromDDL(
        "at long, fault byte, edits string, roles string").fields])
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def plan(conv: object, kind: bytearray, fault: bytearray, digests: bytearray) -> Iterator[pa.RecordBatch]:
        faults = np.frombuffer(fault, np.uint8).copy()
        seen = np.zeros(len(faults), bool)
        seen[np.unique(np.frombuffer(digests, "S16"), return_index=True)[1]] = True
        faults[~seen & (faults != BLANK)] = DUPLICATE
        rows = list(zip(kind, faults.tolist(), strict=True))
        edits = row_edits(rows, cheapest_edits(rows)[1])
        for low in range(0, len(rows), 10_000):
            part = edits[low:low + 10_000]
            columns = ([conv] * len(part), range(low + 1, low + len(part) + 1), faults[low:low + 10_000].tolist(),
                       [e for e, _ in part], [r for _, r in part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, None
        for batch in batches:
            for conv, at, kind, fault, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at == 1:
                    if held:
                        yield from plan(current, *held)
                    current, held = conv, (bytearray(), bytearray(), bytearray())
                held[0].append(kind)
                held[1].append(fault)
                held[2].extend(digest)
        if held:
            yield from plan(current, *held)

    return by_conversation(light, "at").mapInArrow(run, schema)


class Report:
    """Figures of one conversation, and the digest of its repaired rows, from its rows in order."""

    def __init__(self, conv: object) -> None:
        self.conv, self.turns, self.first, self.last, self.rows = conv, 0, None, None, 0
        self.counts = [0] * 4
        self.illegal = self.cost = self.lines = 0
        self.before = None
        self.audit: list[str] = []
        self.digest = hashlib.sha256()

    def add(self, turn: int | None, role: str, text: str, fault: int, edits: str, roles: str) -> None:
        if turn is not None and turn != self.last:
            self.turns, self.last = self.turns + 1, turn
            self.first = turn if self.first is None else self.first
        self.counts[fault] += 1
        if self.rows and (self.before or " ") + (role[:1] or " ") not in ("su", "ua", "au"):
            self.illegal += 1
        self.before, self.rows = role[:1], self.rows + 1
        self.audit.append(edits)
        for edit, given in zip(edits, roles, strict=True):
            self.cost += COSTS[edit] + (fault == TRUNCATED and edit in (KEEP, REROLE))
            if edit != DELETE:
                line = f"{ROLE_NAMES.get(given, role)}:{'' if edit == INSERT else text}"
                self.digest.update((("\n" if self.lines else "") + line).encode("utf-8", "surrogatepass"))
                self.lines += 1

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv, gaps, *self.counts[BLANK:], self.illegal, self.cost, "".join(self.audit),
                self.digest.hexdigest())


REPORT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def reports(placed: DataFrame, planned: DataFrame) -> DataFrame:
    """One row of figures for each conversation; texts are read one at a time."""
    none = lambda *names: [F.lit(None).cast(placed.schema[n].dataType).alias(n) for n in names]
    told = [F.lit(None).cast(planned.schema[n].dataType).alias(n) for n in ("fault", "edits", "roles")]
    rows = planned.select("conv", "at", F.lit(0).alias("part"), *none("turn", "role", "text"),
                          "fault", "edits", "roles").unionByName(
        placed.select("conv", "at", F.lit(1).alias("part"), "turn", "role", "text", *told))
    key = placed.schema["conv"]
    schema = T.StructType([key, *T.StructType.fromDDL(REPORT).fields])
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def batch_of(done: list[Report]) -> pa.RecordBatch:
        columns = zip(*(r.row() for r in done), strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        report, plan = None, None
        for batch in batches:
            done = []
            for conv, at, part, turn, role, text, *plans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part == 0:
                    plan = plans
                    continue
                if at == 1:
                    done += [report] if report else []
                    report = Report(conv)
                report.add(turn, role, text, *plan)
            if done:
                yield batch_of(done)
        if report:
            yield batch_of([report])

    return by_conversation(rows, "at", "part").mapInArrow(run, schema)


def repaired(placed: DataFrame, planned: DataFrame) -> DataFrame:
    """(conv, at, edit, role, text): the rows of the repaired conversations, ``at`` from 1."""
    steps = F.filter(F.transform(F.split("edits", ""), lambda e, i: F.struct(
        i.alias("step"), e.alias("edit"), F.substring(F.col("roles"), i + 1, F.lit(1)).alias("given"))),
        lambda s: ~s["edit"].isin(DELETE, ""))
    given = F.col("one.given")
    role = F.when(given == "k", F.col("role"))
    for letter, name in ROLE_NAMES.items():
        role = F.when(given == letter, F.lit(name)).otherwise(role)
    rows = placed.join(planned.select(F.col("conv").alias("its"), F.col("at").alias("place"), "edits", "roles"),
                       F.col("conv").eqNullSafe(F.col("its")) & (F.col("at") == F.col("place")))
    rows = rows.select("conv", "at", "role", "text", F.explode(steps).alias("one"))
    order = W.partitionBy("conv").orderBy("at", "one.step")
    return rows.select("conv", F.row_number().over(order).cast("long").alias("at"), F.col("one.edit").alias("edit"),
                       role.alias("role"), F.when(F.col("one.edit") != INSERT, F.col("text")).otherwise("").alias("text"))


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The repaired rows (conv, at, edit, role, text) and a row of figures for each conversation (conv,
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    Rows of a conversation go by turn, nulls first; rows of one turn by role and text. Null roles and
    texts are one space, which is blank; a null key is a conversation of its own. A repeated row is a
    duplicate, whatever its turn. Very long texts are read once and not held. An empty table gives
    empty tables; other columns are not read, whatever their names. A conversation with very many rows
    is read by one task, as its digest goes through them in order, but is not held by it: sorting may
    spill, and the search keeps some 25 bytes of a row.
    """
    placed = materialize(ordered(rows, conv, turn, role, text), "conversation-rows")
    planned = materialize(planned_edits(placed), "conversation-edits")
    return (repaired(placed, planned).withColumnRenamed("conv", conv),
            reports(placed, planned).withColumnRenamed("conv", conv))


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with planted faults, by crc32(`conv_id:turn`) % 20.

    0 drops a row, 1 empties its text, 2 removes sentence marks, 3 repeats it, 4 makes it a user row.
    Nulls are one space, in the key too; turns and conversations themselves stay null.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn"))) % 20
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
        F.col("text"))
    filled = rows.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), fate.alias("fate"))
    return filled.where("fate <> 0").select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(F.sequence(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def figures(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """The figures of :func:`repair` for each of ``conversations`` (conv_id); without rows: zeros."""
    _, found = repair(rows)
    found = found.withColumnRenamed("conv_id", "its")
    empty = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    names = [c for c in found.columns if c != "its"]
    return conversations.select("conv_id").distinct().join(
        found, F.col("conv_id").eqNullSafe(F.col("its")), "left").select(
        "conv_id", *[F.coalesce(F.col(c), F.lit(empty.get(c, 0)).cast(found.schema[c].dataType)).alias(c) for c in names])
