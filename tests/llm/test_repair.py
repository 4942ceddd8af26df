"""Repair of conversations against a plain dynamic program over all edits, and rows that tables seldom hold."""

import hashlib
import random

import pytest

from postlens.llm import queries, repair
from tests.compare import connect, difference

SCHEMA = "conv_id bigint, turn bigint, role string, text string, gaps int, audit string"
ODD = [
    (1, None, "user", "Hi.", 1, "x"),
    (1, None, None, None, 1, "x"),
    (1, 2, "assistant", "So.", 1, "x"),
    (1, 2, "assistant", "So.", 1, "x"),
    (None, 0, "assistant", "No id", 1, "x"),
    (2, 5, "tool", "", 1, "x"),
    (3, 5, "", " \t", 1, "x"),
    (4, 0, "system", "Be.", 1, "x"),
    (5, 0, "user", "very long " * 20000 + ".", 1, "x"),
]


def plain_repair(rows):
    """Cheapest (cost, audit) by a table over rows and states; rows are (role, fault)."""
    best = {"E": (0, "")}

    def offer(to, state, cost, audit):
        if state not in to or (cost, audit) < to[state]:
            to[state] = (cost, audit)

    def with_inserted(now):
        for _ in range(3):
            for state, (cost, audit) in list(now.items()):
                offer(now, "A" if state == "U" else "U", cost + 3, audit + "I")
        return now

    for role, fault in rows:
        after = {}
        more = 3 if fault == "truncated" else 0
        for state, (cost, audit) in with_inserted(dict(best)).items():
            offer(after, state, cost + 4, audit + "D")
            if fault in ("blank", "duplicate"):
                continue
            if (state, role[:1]) in (("E", "s"), ("E", "u"), ("S", "u"), ("U", "a"), ("A", "u")):
                offer(after, role[:1].upper(), cost + more, audit + "K")
            offer(after, "A" if state == "U" else "U", cost + 3 + more, audit + "R")
        best = after
    return min(v for k, v in with_inserted(dict(best)).items() if k in "EA")


def test_search_equals_the_plain_table():
    rng = random.Random(5)
    search = repair.searcher()
    for _ in range(3000):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), rng.choice([None, None, *repair.FAULTS])) for _ in range(rng.randint(0, 12))]
        assert search([(r[:1], f) for r, f in rows], "E", repair.ENDS, True) == plain_repair(rows)


def test_query_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    name = "op12_repaired_conversations"
    assert difference(spark, connect(sf_dir), sf_dir, queries.QUERIES[name], queries.ORACLE[name]) is None


def test_one_conversation_in_many_segments(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT_ROWS", 5)
    rng = random.Random(9)
    rows = [(7, i, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "No", f"Turn {i}.", f"Turn {i}", " "])) for i in range(400)]
    rows += [(8, i, "user", f"{i}.") for i in range(3)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    found = {r.conv_id: r for r in repair.repaired_conversations(df).collect()}
    seen, plain = set(), []
    for _, _, role, text in rows[:400]:
        blank, again = not text.strip(), (role, text) in seen
        seen.add((role, text))
        plain.append((role, "blank" if blank else "duplicate" if again else None if text[-1] in ".!?" else "truncated"))
    assert (found[7].cost, found[7].audit) == plain_repair(plain)
    lines, state = repair.applied(found[7].audit, "E", [r[2] for r in rows[:400]], [r[3] for r in rows[:400]])
    assert state in repair.ENDS
    assert found[7].repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert found[7].illegal == sum(a[2][0] + b[2][0] not in ("su", "ua", "au") for a, b in zip(rows[:399], rows[1:400]))
    assert (found[8].cost, found[8].audit) == (6, "KIKR")


def test_odd_rows(spark):
    found = {r.conv_id: r for r in repair.repaired_conversations(spark.createDataFrame(ODD, SCHEMA)).collect()}
    assert set(found) == {1, 2, 3, 4, 5, None}
    # A blank turn first, then the user, then one of two equal turns.
    assert (found[1].blank, found[1].duplicate, found[1].audit, found[1].cost) == (1, 1, "DKKD", 8)
    assert (found[None].audit, found[None].cost) == ("D", 4)
    assert (found[2].audit, found[2].blank) == ("D", 1)
    assert (found[3].audit, found[3].cost) == ("D", 4)
    assert (found[4].audit, found[4].cost) == ("D", 4)
    assert (found[5].audit, found[5].cost) == ("KI", 3)
    assert found[4].repaired_sha256 == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("function", [repair.repaired_conversations, repair.repaired_after_damage])
def test_empty_table(spark, function):
    assert function(spark.createDataFrame([], SCHEMA)).collect() == []


def test_conversations_without_a_row_after_damage(spark):
    # crc32("1:8") % 20 is 0.
    import zlib

    turn = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    (row,) = repair.repaired_after_damage(spark.createDataFrame([(1, turn, "user", "x")], "conv_id bigint, turn bigint, role string, text string")).collect()
    assert (row.gaps, row.cost, row.audit, row.repaired_sha256) == (0, 0, "", hashlib.sha256(b"").hexdigest())
