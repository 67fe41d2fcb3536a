"""Repair of conversations against a search over all edit strings."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from boxloom.llm import repair

FACTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, key string, part int, Seen int, gone boolean"


def hurt(rows):
    """The damage of the contract, row by row: conversation -> rows."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        one = out.setdefault(conv, [])
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        one += [] if lot == 0 else [(turn, "user" if lot == 4 else role, text)] * (2 if lot == 3 else 1)
    return out


def cheapest(faults, roles):
    """Least (cost, edits) by best-first search over (rows read, initials so far), edits compared as strings; and the path."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, edits, i, made, path = heapq.heappop(heap)
        if (i, made) in done or len(made) > 2 * len(roles) + 3:
            continue
        done.add((i, made))
        if i == len(roles) and re.fullmatch("(s?(ua)+)?", made):
            return cost, edits, path
        for to in ("user", "assistant"):
            heapq.heappush(heap, (cost + 2, edits + "I", i, made + to[0], path + ((to, None),)))
        if i < len(roles):
            heapq.heappush(heap, (cost + 3, edits + "D", i + 1, made, path))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                if roles[i]:  # an empty role has no initial, so it can't stay
                    heapq.heappush(heap, (cost + more, edits + "K", i + 1, made + roles[i][:1], path + ((roles[i], i),)))
                for to in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 2 + more, edits + "R", i + 1, made + to[0], path + ((to, i),)))
    raise AssertionError


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last[0] in ".!?" else "truncated")
        seen.add((role, text))
    roles = [r[1] for r in rows]
    turns = {r[0] for r in rows} - {None}
    cost, edits, path = cheapest(faults, roles)
    text = "\n".join(f"{role}:{'' if i is None else rows[i][2]}" for role, i in path)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, "blank": faults.count("blank"), "duplicate": faults.count("duplicate"),
        "truncated": faults.count("truncated"), "illegal": sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])),
        "cost": cost, "audit": edits, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}, text


def threads(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in rng.sample(range(12), rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ärger"])
            text = rng.choice(["Well.", "So!", "no end", "", " \n", "Why?  ", None, "é.", "Well.", "a\nb."])
            rows.append((conv if conv else None, None if rng.random() < 0.05 else turn, role, text))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, True) for r in rows], SCHEMA)


@pytest.mark.parametrize("spill_rows", [1, 3, repair.SPILL_ROWS])
def test_against_search(spark, spill_rows):
    rows = threads(3, 250, 6)
    expected = {conv: plain(one) for conv, one in hurt(rows).items()}
    hurt_rows = repair.damaged(table(spark, rows).repartition(7))
    got = repair.repairs(hurt_rows, gone="gone", spill_rows=spill_rows).collect()
    assert {r["conv_id"]: {f: r[f] for f in FACTS} for r in got} == {c: e[0] for c, e in expected.items()}
    assert len(got) == len(expected)
    lines = {}
    for r in repair.repaired(hurt_rows, gone="gone", spill_rows=spill_rows).orderBy("position").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        assert r["edit"] in "KRI" and (r["turn"] is None or r["edit"] != "I")
    assert {c: "\n".join(lines.get(c, [])) for c in expected} == {c: e[1] for c, e in expected.items()}


def test_dropped_whole(spark):
    """A conversation of which nothing is left still has its row."""
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    one = repair.repairs(repair.damaged(table(spark, [(conv, 0, "user", "Yes.")])), gone="gone").collect()
    assert [r.asDict() for r in one] == [{"conv_id": conv, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
                                          "repaired_sha256": hashlib.sha256(b"").hexdigest()}]


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()]
    got = {r["conv_id"]: {f: r[f] for f in FACTS} for r in repair.op11_repair(spark, "/root/testdata/sf0.001").collect()}
    assert got == {c: plain(one)[0] for c, one in hurt(rows).items()}


def test_giant_conversation_over_batches(spark):
    """A long conversation, many parts of backpointers, small batches: same as in one part; long texts, string ids."""
    rng = random.Random(9)
    rows = [("x", t, rng.choice(["user", "assistant", "system"]), rng.choice(["ok.", "no", "", f"{t}.", "long " * 4000 + "." if t % 999 == 0 else f"t{t}!"]))
            for t in range(5000)] + [("y", 1, "user", "Hi.")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        small = {r["conv_id"]: r for r in repair.repairs(df, spill_rows=100).collect()}
        lines = [f"{r['role']}:{r['text']}" for r in repair.repaired(df, spill_rows=100).where("conv_id = 'x'").orderBy("position").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert small == {r["conv_id"]: r for r in repair.repairs(df).collect()}
    assert small["y"]["audit"] == "KI" and sum(c != "I" for c in small["x"]["audit"]) == 5000
    assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == small["x"]["repaired_sha256"]


def test_empty(spark):
    assert repair.repairs(repair.damaged(table(spark, []))).collect() == []
    assert repair.repaired(table(spark, [])).collect() == []


def test_ties():
    """Among equally cheap edits the ASCII-least string wins, at every row."""
    for n in range(6):
        for roles in itertools.islice(itertools.product("sua", repeat=n), 300):
            one = repair._Conversation("k")
            for i, r in enumerate(roles):
                one.row(str(i), r, f"{i}.", False)
            got = list(one.closed())[-1]
            assert (got[6], got[7]) == cheapest([""] * n, list(roles))[:2]
