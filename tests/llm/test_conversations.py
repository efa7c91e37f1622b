"""Conversation repair against a shortest-path search over all edits."""

import hashlib
import heapq
import os
import random
import re
import time
from zlib import crc32

import pytest

from usagelens.llm import conversations as c
from usagelens.llm import queries
from usagelens.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\f\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_best(rows):
    """(cost, edits, lines) of the cheapest path, visited in the order of cost and edits; rows: (role,
    text, fault)."""
    todo, done = [(0, "", (0, ""), ())], set()
    while True:
        cost, edits, state, lines = heapq.heappop(todo)
        if state in done:
            continue
        done.add(state)
        at, before = state
        if at == len(rows) and before in ("", "a"):
            return cost, edits, lines
        after = {"": "u", "s": "u", "u": "a", "a": "u"}[before]
        name = {"u": "user", "a": "assistant"}[after]
        steps = [(2, "I", (at, after), (f"{name}:",))]
        if at < len(rows):
            role, text, fault = rows[at]
            steps.append((3, "D", (at + 1, before), ()))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] == after or (role[:1] == "s" and before == ""):
                    steps.append((extra, "K", (at + 1, role[:1]), (f"{role}:{text}",)))
                steps.append((2 + extra, "R", (at + 1, after), (f"{name}:{text}",)))
        for more, edit, goal, line in steps:
            heapq.heappush(todo, (cost + more, edits + edit, goal, lines + line))


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        inner = text.strip(SPACES)
        fault = ("blank" if not inner else "duplicate" if (role, text) in seen
                 else "truncated" if inner[-1] not in ".!?" else "sound")
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def plain_row(conv, rows):
    """Figures of a conversation of (turn, role, text) rows."""
    rows = sorted([(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows],
                  key=lambda row: (row[0] is not None, row[0] or 0, row[1], row[2]))
    told = faults([r[1:] for r in rows])
    turns = [r[0] for r in rows if r[0] is not None]
    cost, edits, lines = plain_best(told)
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[sum(f == k for _, _, f in told) for k in ("blank", "duplicate", "truncated")],
            sum((a[:1] + b[:1]) not in ("su", "ua", "au") for (a, _, _), (b, _, _) in zip(told, told[1:])),
            cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        fate = crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate:
            row = (conv, turn, "user" if fate == 4 else role,
                   "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text)
            out += [row] * (2 if fate == 3 else 1)
    return out


def plain_table(rows, conversations=()):
    groups = {k: [] for k in conversations}
    for conv, *row in rows:
        groups.setdefault(conv, []).append(row)
    return {plain_row(k, v) for k, v in groups.items()}


def table_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_row(rng):
    return (rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]),
            rng.choice(["One.", "Two!", "Three", "Four ? ", "", " \n", "\xa0", "x.y", None]))


def test_search_equals_shortest_paths():
    rng = random.Random(1)
    kinds = {"s": c.SYSTEM_ROW, "u": c.USER_ROW, "a": c.ASSISTANT_ROW}
    names = {"sound": c.SOUND, "blank": c.BLANK, "duplicate": c.DUPLICATE, "truncated": c.TRUNCATED}
    for _ in range(400):
        rows = faults([(r or " ", t or " ") for r, t in (random_row(rng) for _ in range(rng.randint(1, 12)))])
        codes = [(kinds.get(r[:1], c.OTHER_ROW), names[f]) for r, _, f in rows]
        cost, edits, _ = plain_best(rows)
        for stretch in (1, 2, 5, 100):
            assert c.cheapest_edits(codes, stretch) == (cost, edits)
        assert "".join(e for e, _ in c.row_edits(codes, edits)) == edits


def test_known_repairs(spark):
    rows = [
        (1, 0, "system", "S."), (1, 1, "user", "Q?"), (1, 2, "assistant", "A."),
        (2, 0, "assistant", "A."), (2, 1, "user", "Q?"),
        (3, 0, "user", "Q?"), (3, 1, "user", "Q?"),
        (4, 0, "system", "S."),
        (5, 3, "user", "cut"), (5, 9, "assistant", " \t"),
    ]
    found = {r["conv_id"]: r for r in c.repair(spark.createDataFrame(rows, SCHEMA))[1].collect()}
    assert {k: (r["cost"], r["audit"]) for k, r in found.items()} == {
        1: (0, "KKK"), 2: (4, "IKKI"), 3: (5, "KDI"), 4: (3, "D"), 5: (6, "DD")}
    assert found[5]["gaps"] == 5 and found[3]["duplicate"] == 1 and found[5]["truncated"] == 1


def random_rows(rng, count):
    return [(rng.choice([None, *range(40)]), rng.choice([None, -1, 0, 1, 2, 3, 5, 5]), *random_row(rng))
            for _ in range(count)]


def test_random_tables_with_nulls_ties_and_repeats(spark):
    rows = random_rows(random.Random(2), 400)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", at string, edits int").repartition(3)
    assert table_of(c.repair(df)[1]) == plain_table(rows)


def test_repaired_rows_have_the_digest(spark):
    rows = random_rows(random.Random(4), 200)
    fixed, figures = c.repair(spark.createDataFrame(rows, SCHEMA))
    lines = {}
    for r in sorted(fixed.collect(), key=lambda r: r["at"]):
        lines.setdefault(r["conv_id"], []).append((r["edit"], f"{r['role']}:{r['text']}"))
    for r in figures.collect():
        own = lines.get(r["conv_id"], [])
        assert hashlib.sha256("\n".join(t for _, t in own).encode()).hexdigest() == r["repaired_sha256"]
        assert "".join(e for e, _ in own) == r["audit"].replace("D", "")


def test_long_conversations(spark):
    rng = random.Random(6)
    long = [(7, i, rng.choice(["user", "assistant"]), rng.choice(["One.", f"Two {i}."])) for i in range(700)]
    same = [(8, 0, "user", "Again.")] * 3_000
    text = [(9, 0, "user", "word " * 200_000), (9, 1, "assistant", "word " * 200_000 + ".")]
    start = time.time()
    found = table_of(c.repair(spark.createDataFrame(long + same + text, SCHEMA))[1])
    assert found == plain_table(long + same + text) and time.time() - start < 60


def test_one_sided_conversation_takes_linear_time():
    start = time.time()
    cost, edits = c.cheapest_edits([(c.USER_ROW, c.SOUND)] * 20_000)
    assert cost == 20_000 and time.time() - start < 30 and len(edits) >= 20_000


def test_damage_and_conversations_without_rows(spark):
    rng = random.Random(8)
    rows = random_rows(rng, 300) + [(k, rng.randint(0, 50), "user", "Hm.") for k in range(100, 140)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(str, map(tuple, c.damage(df).collect()))) == sorted(map(str, plain_damage(rows)))
    found = table_of(c.figures(c.damage(df), df))
    assert found == plain_table(plain_damage(rows), {r[0] for r in rows})
    assert any(r[7] == "" and r[8] == hashlib.sha256().hexdigest() for r in found)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    fixed, figures = c.repair(df)
    assert fixed.count() == figures.count() == c.figures(c.damage(df), df).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_query_on_a_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert table_of(queries.op12_conversation_repair(spark, SF_DIR)) == plain_table(
        plain_damage(rows), {r[0] for r in rows})
