"""Conversations brought to the form "maybe a system turn, then user and assistant in turn" by their cheapest edits.

The edits of a conversation are found by iterative-deepening A*: a depth-first search that tries edits in the order of
their initials under a bound on the cost, keeps the states that failed under it, and starts again with the least cost
that went beyond the bound. The first path that is accepted is the cheapest one, and the least of those in ASCII order.

Rows are sorted by conversation and turn over all tasks. A task solves every conversation that lies inside its rows.
Conversations that reach its first or last row, or have more than SEGMENT_ROWS rows, are cut into segments; the search then
gives the best path of a segment for each state before and after it, and paths of segments are joined. Edits cost what
their letters say, so two paths of equal cost over the same rows are never one the beginning of the other, and the least
of joined paths is made of least paths.

Null conv_id is one conversation; null roles and texts count as one space. Rows of one turn are taken by role, then text,
so repeated rows stand together. Other columns are not read. An empty table gives no rows.
"""

import hashlib

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import stored

SEGMENT_ROWS = 16
SHOWN = "[^\\x20\\x09-\\x0D]"
FAULTS = ("blank", "duplicate", "truncated")
# Before any row, after a system, a user and an assistant turn.
STATES = "ESUA"
ENDS = ("E", "A")
KEPT = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}
# The role that a changed or inserted turn must have, and the state after it.
NEEDED = {"E": ("user", "U"), "S": ("user", "U"), "U": ("assistant", "A"), "A": ("user", "U")}
RETURNED = "cost long, audit string, repaired_sha256 string, blank long, duplicate long, truncated long, illegal long"


def damaged(rows: DataFrame) -> DataFrame:
    """Turns dropped, emptied, cut at the end, repeated or given to the user by the crc32 of `conv_id:turn` modulo 20."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(blank("text"), "[.!?]", ""))
    return (
        rows.withColumn("_kind", kind)
        .where("_kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_kind") == 4, "user").otherwise(blank("role")).alias("role"),
            text.otherwise(blank("text")).alias("text"),
            F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
        )
        .drop("_copy")
    )


def faults(rows: DataFrame) -> DataFrame:
    """Every row with the first of its faults, or null, and its place among equal rows of one turn.

    Equal rows of a turn are counted before they are shuffled; the first turn of a text comes from sums of tasks.
    """
    text_key = F.md5(F.col("text").cast("binary"))
    keyed = rows.select(
        F.struct(F.col("conv_id").cast("string").alias("conv_id")).alias("conv"),
        F.struct(F.col("turn").isNotNull().alias("known"), "turn").alias("at"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    counted = keyed.groupBy("conv", "at", "role", "text").agg(F.count("*").alias("copies"))
    first = counted.groupBy("conv", "role", text_key.alias("text_key")).agg(F.min("at").alias("first"))
    shown = F.regexp_replace("text", "[\\x20\\x09-\\x0D]+$", "")
    fault = (
        F.when(~F.col("text").rlike(SHOWN), "blank")
        .when((F.col("at") > F.col("first")) | (F.col("copy") > 1), "duplicate")
        .when(~F.substring(shown, -1, 1).isin(".", "!", "?"), "truncated")
    )
    return (
        counted.withColumn("text_key", text_key)
        .join(first, ["conv", "role", "text_key"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select("conv", "at", "role", "text", "copy", fault.alias("fault"))
    )


def searcher():
    """search(rows, state, goals, tail): the cheapest edits of (role initial, fault) rows and their cost.

    The path starts in state and ends in one of goals, by a row's edit, or, with tail, by turns inserted after the last row.
    None if no edits lead there.
    """
    never = float("inf")

    def least(row):
        initial, fault = row
        if fault in ("blank", "duplicate"):
            return 4
        more = 3 if fault == "truncated" else 0
        return more if initial in ("s", "u", "a") else min(4, 3 + more)

    def search(rows, state, goals, tail):
        n = len(rows)
        ahead = [0] * (n + 1)
        # No edit leads back to the states before the first user turn.
        early = all(g in "ES" for g in goals)
        if early and state not in ("E", max(goals)):
            return None
        for i in range(n - 1, -1, -1):
            ahead[i] = ahead[i + 1] + (4 if early else least(rows[i]))
        if early and goals == ("S",) and state == "E":
            # One system turn is kept.
            ahead = [max(0, x - 4) for x in ahead]

        def edits(i, now, inserted):
            if i < n:
                yield "D", 4, i + 1, now, 0
            # After two inserted turns a third only leads back.
            if (i < n or tail) and inserted < 2:
                yield "I", 3, i, NEEDED[now][1], inserted + 1
            if i < n and rows[i][1] not in ("blank", "duplicate"):
                initial, fault = rows[i]
                more = 3 if fault == "truncated" else 0
                if (now, initial) in KEPT:
                    yield "K", more, i + 1, KEPT[now, initial], 0
                yield "R", 3 + more, i + 1, NEEDED[now][1], 0

        def deepen(i, now, inserted, cost, path):
            """The whole cost of the first accepted path, or None; the next bound is kept in beyond."""
            nonlocal beyond
            if i == n and now in goals:
                return cost
            key = (i, now, inserted)
            if failed.get(key, -1) >= bound - cost:
                return None
            for letter, price, j, after, count in edits(i, now, inserted):
                total = cost + price + ahead[j]
                if early and after in "UA":
                    continue
                if total > bound:
                    beyond = min(beyond, total)
                    continue
                path.append(letter)
                found = deepen(j, after, count, cost + price, path)
                if found is not None:
                    return found
                path.pop()
            failed[key] = bound - cost
            return None

        bound = ahead[0]
        while bound < never:
            beyond, failed, path = never, {}, []
            cost = deepen(0, state, 0, 0, path)
            if cost is not None:
                return cost, "".join(path)
            bound = beyond
        return None

    return search


def applied(audit, state, roles, texts):
    """Lines `role:text` after the edits, and the state they end in."""
    lines, i = [], 0
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        if letter == "K":
            role, after = roles[i], KEPT[state, roles[i][:1]]
        else:
            role, after = NEEDED[state]
        lines.append(f"{role}:{'' if letter == 'I' else texts[i]}")
        i += letter != "I"
        state = after
    return lines, state


def illegal_pairs(initials):
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def sha256(lines):
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def repaired_conversations(rows: DataFrame) -> DataFrame:
    """For each conversation of rows: cost, audit (initials of the edits), hash of the result and counts of faults."""
    kind = rows.schema["conv_id"].dataType
    sorted_rows = (
        faults(rows)
        .repartitionByRange("conv", "at", "role", "text", "copy")
        .sortWithinPartitions("conv", "at", "role", "text", "copy")
        .select(F.col("conv.conv_id").alias("conv_id"), "role", "text", "fault")
    )
    search, most = searcher(), SEGMENT_ROWS

    def counts(buffer):
        return [sum(r[2] == f for r in buffer) for f in FAULTS]

    def whole(conv_id, buffer):
        roles, texts, found = zip(*buffer)
        cost, audit = search([(r[:1], f) for r, f in zip(roles, found)], "E", ENDS, True)
        lines, _ = applied(audit, "E", roles, texts)
        return [conv_id, None, None, cost, audit, sha256(lines), *counts(buffer), illegal_pairs([r[:1] for r in roles]), *[None] * 6]

    def segment(conv_id, part, number, buffer):
        roles, texts, found = zip(*buffer)
        plain = [(r[:1], f) for r, f in zip(roles, found)]
        paths = [(a, b, *best) for a in STATES for b in STATES if (best := search(plain, a, (b,), False))]
        froms, tos, costs, audits = (list(x) for x in zip(*paths))
        initials = [r[:1] for r in roles]
        ends = [froms, tos, costs, audits, list(roles), list(texts)]
        return [conv_id, part, number, None, initials[0] + "|" + initials[-1], None, *counts(buffer), illegal_pairs(initials), *ends]

    names = f"conv_id string, part int, segment long, {RETURNED}, froms array<string>, tos array<string>, costs array<long>, audits array<string>, roles array<string>, texts array<string>"  # noqa: E501
    columns = [c.split(" ")[0] for c in names.split(", ")]

    def solve(frames):
        part = TaskContext.get().partitionId()
        current, buffer, number, begun = None, [], 0, 0
        for frame in frames:
            out = []
            for conv_id, role, text, fault in zip(frame["conv_id"], frame["role"], frame["text"], frame["fault"]):
                conv_id = None if pd.isna(conv_id) else conv_id
                if begun == 0 or conv_id != current:
                    if buffer:
                        inside = begun > 1 and number == 0
                        out.append(whole(current, buffer) if inside else segment(current, part, number, buffer))
                    current, buffer, number, begun = conv_id, [], 0, begun + 1
                elif len(buffer) == most:
                    out.append(segment(current, part, number, buffer))
                    buffer, number = [], number + 1
                buffer.append((role, text, None if pd.isna(fault) else fault))
            if out:
                yield pd.DataFrame(out, columns=columns)
        if buffer:
            yield pd.DataFrame([segment(current, part, number, buffer)], columns=columns)

    solved = stored(sorted_rows.mapInPandas(solve, names), "repair-segments")
    results = [c.split(" ")[0] for c in RETURNED.split(", ")]
    inside = solved.where("part IS NULL").select("conv_id", *results)
    cut = joined_segments(solved.where("part IS NOT NULL")).select("conv_id", *results)
    return inside.unionByName(cut).withColumn("conv_id", F.col("conv_id").cast(kind))


def joined_segments(segments: DataFrame) -> DataFrame:
    """One row for each conversation that was cut: the best path through all of its segments.

    Segments of a conversation pass one task in order, first their paths, then their repaired lines; neither the rows nor
    the texts of a conversation are held at once. What stays in memory is its audit, which is returned whole.
    """
    search = searcher()
    key = F.struct("conv_id")
    in_order = lambda df: df.repartition(key).sortWithinPartitions("conv_id", "part", "segment")

    def through(paths):
        """Chosen (state before, audit) of each segment, the inserted end, the whole cost and audit."""
        best, steps = {"E": 0}, []
        for froms, tos, costs, audits in paths:
            found = {}
            for a, b, cost, audit in zip(froms, tos, costs, audits):
                if a in best and (b not in found or (best[a] + cost, steps_audit(steps, a) + audit) < found[b][:2]):
                    found[b] = (best[a] + cost, steps_audit(steps, a) + audit, a, audit)
            best = {b: x[0] for b, x in found.items()}
            steps.append(found)
        ends = []
        for state, cost in best.items():
            tail = search([], state, ENDS, True)
            ends.append((cost + tail[0], steps_audit(steps, state) + tail[1], state, tail[1]))
        cost, audit, state, tail = min(ends)
        chosen = [(state, tail)]
        for found in reversed(steps):
            _, _, before, own = found[state]
            chosen.append((before, own))
            state = before
        return chosen[::-1], cost, audit

    def steps_audit(steps, state):
        return steps[-1][state][1] if steps else ""

    def fold(frames):
        current, rows = None, []

        def close():
            chosen, cost, audit = through([r[2] for r in rows])
            ends = [r[3].split("|") for r in rows]
            between = sum(a[1] + b[0] not in ("su", "ua", "au") for a, b in zip(ends, ends[1:]))
            sums = [int(sum(r[4][k] for r in rows)) for k in range(4)]
            sums[3] += between
            out = [[current, r[0], r[1], a, own, None, None, None, None, None, None] for r, (a, own) in zip(rows, chosen)]
            return out + [[current, rows[-1][0], rows[-1][1] + 1, *chosen[-1], cost, audit, *sums]]

        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                conv_id = None if pd.isna(r.conv_id) else r.conv_id
                if rows and conv_id != current:
                    out += close()
                    rows = []
                current = conv_id
                rows.append((r.part, r.segment, (r.froms, r.tos, r.costs, r.audits), r.audit, (r.blank, r.duplicate, r.truncated, r.illegal)))
            if out:
                yield pd.DataFrame(out, columns=columns)
        if rows:
            yield pd.DataFrame(close(), columns=columns)

    names = "conv_id string, part int, segment long, state string, own string, cost long, audit string, blank long, duplicate long, truncated long, illegal long"  # noqa: E501
    columns = [c.split(" ")[0] for c in names.split(", ")]
    narrow = segments.drop("roles", "texts", "cost", "repaired_sha256")
    chosen = stored(in_order(narrow).mapInPandas(fold, names), "repair-paths")

    def hashed(frames):
        current, digest, empty = None, None, True
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                conv_id = None if pd.isna(r.conv_id) else r.conv_id
                if digest is None or conv_id != current:
                    current, digest, empty = conv_id, hashlib.sha256(), True
                lines, _ = applied(r.own, r.state, r.roles, r.texts)
                if lines:
                    digest.update((("" if empty else "\n") + "\n".join(lines)).encode())
                    empty = False
                if not pd.isna(r.audit):
                    out.append([conv_id, digest.hexdigest(), r.audit, r.cost, r.blank, r.duplicate, r.truncated, r.illegal])
            if out:
                yield pd.DataFrame(out, columns=done)

    done = ["conv_id", "repaired_sha256", "audit", "cost", *FAULTS, "illegal"]
    texts = segments.select(key.alias("conv"), "part", "segment", "roles", "texts")
    lined = chosen.withColumn("conv", key).join(texts, ["conv", "part", "segment"], "left").drop("conv")
    return in_order(lined).mapInPandas(
        hashed, "conv_id string, repaired_sha256 string, audit string, cost long, blank long, duplicate long, truncated long, illegal long"
    )


def repaired_after_damage(conversations: DataFrame) -> DataFrame:
    """Every conv_id of the table, with gaps in its turns, faults and repair of what damaged() leaves of it."""
    rows = damaged(conversations)
    gaps = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    key = lambda df: df.withColumn("conv", F.struct("conv_id"))
    found = key(gaps).join(key(repaired_conversations(rows)).drop("conv_id"), "conv").drop("conv_id")
    every = key(conversations.select("conv_id").distinct())
    numbers = ["gaps", *FAULTS, "illegal", "cost"]
    return every.join(found, "conv", "left").select(
        "conv_id",
        *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
