"""Conversation repair next to an exhaustive search over all edits."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from llm.support import sf  # noqa: F401
from tidemark.llm import queries, turns

DDL = "conv_id long, turn long, role string, text string"


def search(messages):
    """Cheapest edits of (initial, faults) messages, by best-first search over whole audits and role strings."""
    heap, best = [(0, "", 0, "")], None
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        if best is not None and cost > best[0]:
            break
        if not re.fullmatch("(s?(ua)*u?)?", roles):
            continue
        if at == len(messages) and re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
            best = cost, audit
        if audit.count("I") <= len(messages) + 2:
            for r in "ua":
                heapq.heappush(heap, (cost + 2, audit + "I", at, roles + r))
        if at < len(messages):
            initial, fault = messages[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, roles))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                heapq.heappush(heap, (cost + more, audit + "K", at + 1, roles + (initial if initial in ("s", "u", "a") else "x")))
                for r in "ua":
                    heapq.heappush(heap, (cost + 2 + more, audit + "R", at + 1, roles + r))
    return best


def order(row):
    _, turn, role, text = row
    return turn is not None, turn or 0, role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    after = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(name.encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        after[conv] += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    out = []
    for conv, messages in after.items():
        messages.sort(key=order)
        seen, faults = set(), []
        for _, _, role, text in messages:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = search([(m[2][:1], f) for m, f in zip(messages, faults, strict=True)])
        fixed, at = [], 0
        for letter in audit:
            free = "assistant" if fixed and fixed[-1][0][:1] == "u" else "user"
            if letter == "I":
                fixed.append((free, ""))
                continue
            _, _, role, text = messages[at]
            at += 1
            if letter != "D":
                fixed.append((free if letter == "R" else role, text))
        numbers = [m[1] for m in messages if m[1] is not None]
        initials = [m[2][:1] for m in messages]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        out.append((conv, max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()))
    return sorted(out, key=repr)


def mended(frame):
    return sorted(map(tuple, turns.repair_conversations(turns.damaged(frame)).collect()), key=repr)


def test_query(caller, sf):
    rows = [tuple(r) for r in caller.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, queries.QUERIES["op13_weighted_repair"](caller, sf).collect()), key=repr)
    assert got == brute(rows)


def test_crafted(caller):
    rng = random.Random(8)
    texts = ["Yes.", "No!", "cut", "", " \t", "Why? ", "..", "é日", None]
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, *range(-2, 40)]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "Sys"]),
             rng.choice(texts)) for _ in range(190)]
    rows = [r for r in rows if r[0] is not None] + [(None, t, "user", "Hi.") for t in (None, 1, 1, 5)] + rows[:12]
    frame = caller.createDataFrame(rows, DDL).withColumn("digest", F.lit("own")).withColumn("gone", F.lit(1)).repartition(3)
    assert mended(frame) == brute(rows)


def test_nothing_left(caller):
    dropped = [(c, t, "user", "Hi.") for c in range(200) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert len(dropped) > 10
    got = mended(caller.createDataFrame(dropped, DDL))
    assert got == brute(dropped)
    assert {r[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert mended(caller.createDataFrame([], DDL)) == []


def test_long_and_hot_conversation(caller):
    """Most rows in one conversation with long texts; its batches are cut, and its repair is legal and no dearer than deleting all."""
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes. ", "cut ", "no? "]) * rng.randint(1, 400) + str(t) + ".") for t in range(3000)]
    rows += [(2, t, "user", "x.") for t in range(3)]
    caller.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = {r.conv_id: r for r in turns.repair_conversations(turns.damaged(caller.createDataFrame(rows, DDL))).collect()}
    finally:
        caller.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    kept = [r for r in got[1].audit if r != "I"]
    assert len(kept) == sum({0: 0, 3: 2}.get(zlib.crc32(f"1:{t}".encode()) % 20, 1) for t in range(3000))
    assert got[1].cost < 3 * len(kept)


def code(initial, fault=0):
    return "sua".find(initial) % 4 + fault


def test_repair_is_least():
    codes = [code("s"), code("u"), code("a"), code("x"), turns.BLANK, code("u", turns.CUT), code("a", turns.CUT)]
    names = {turns.BLANK: "blank", turns.DUPLICATE: "duplicate", turns.CUT: "truncated", 0: ""}
    for n in range(4):
        for listed in itertools.product(codes, repeat=n):
            assert turns.repair(bytes(listed)) == search([("sua"[c & 3] if c & 3 < 3 else "x", names[c & ~3]) for c in listed])


def test_blocks_change_nothing(monkeypatch):
    rng = random.Random(2)
    long = bytes(rng.choice([0, 1, 2, 3, 5, 10, 16, 17, 18, 19]) for _ in range(700))
    whole = turns.repair(long)
    for size in (1, 2, 31, 1000):
        monkeypatch.setattr(turns, "BLOCK", size)
        monkeypatch.setattr(turns, "DIGITS", 3 * size + 2)
        monkeypatch.setattr(turns, "LETTER_BITS", 3 * turns.DIGITS)
        monkeypatch.setattr(turns, "LOW", (1 << turns.LETTER_BITS) - 1)
        monkeypatch.setattr(turns, "EDGES", turns._edges())
        monkeypatch.setattr(turns, "INSERTED", turns._edge("I", turns.INSERT))
        assert turns.repair(long) == whole
