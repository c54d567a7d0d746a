"""Repair of conversation structure: the cheapest edits that make a conversation's roles legal, found as the least of whole numbers.

Messages are kept (cost 0), given the role of user or assistant (2), deleted (3; blank and duplicate ones must be), and empty messages
of a user or an assistant are inserted anywhere (2); a truncated message that stays adds 1. Role initials must then read
``(s?(ua)+)?``. An audit names the edits in order by their initials, and of the cheapest audits the least in ASCII is taken.

A weight is one integer: the cost in its high digits, and below it a fixed number of low digits of three bits in which the audit's
letters stand from the left, with zeros at the end. Putting an edit in front adds its cost, moves the letters on by one
digit and sets the first one. The graph has a node for each place between messages and each state of the roles (nothing yet,
after s, u, a), and an ordinary dynamic program from the end takes the least integer at each node, which settles cost and
audit at once. Edits that leave one node have different initials, so a node's choice never depends on letters behind the
first one where costs are equal. Long conversations are therefore weighed in blocks of ``BLOCK`` messages: a block starts from the costs of
the one behind it with no letters, and keeps each state's letters and the state they end in. Work is linear in the messages.

Only initials and faults, one byte a message, are held for a conversation while it is weighed. They come sorted by conversation,
as do the texts afterwards, which pass by once behind their conversation's audit. So a conversation of any length is one task's
stream, as its digest demands, and never its memory (but for a few bytes a message).

Defined cases: null roles and texts are one blank, and so are null ``conv_id`` and ``turn`` in the name that damage is drawn by; rows
with a null ``conv_id`` are one conversation; null turns come first; rows of one turn are taken by role and then by the digest
of role and text, so repeated rows are next to each other; roles other than s, u and a cannot stay as they are, nor can an empty
role; gaps of turns beyond 2^63 wrap; other columns are not read; an empty table has no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

# The blanks, the ends of a sentence.
BLANKS, STOPS = r"[\x20\x09-\x0D]+", r"[.!?]"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LETTERS = " DIKR"  # a letter's digit; digits rise as the letters do
BLOCK = 128
DIGITS = 3 * BLOCK + 2  # two insertions and one other edit a message, and two insertions at the end
LETTER_BITS = 3 * DIGITS
LOW = (1 << LETTER_BITS) - 1
# The states of the roles, and the state that a message of initial s, u or a leads to.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
NEXT = {state: AFTER[state, initial] for state in range(4) for initial in "ua" if (state, initial) in AFTER}  # a user or an assistant, as it may be
INITIALS = "sua"
# Faults of a message, beside its initial (a number below 4) in one byte.
BLANK, DUPLICATE, CUT, GONE = 4, 8, 16, 32
KNOWN = 100_000  # short conversations a worker remembers


def _edge(letter: str, cost: int) -> tuple[int, int]:
    return cost << LETTER_BITS, LETTERS.index(letter) << (LETTER_BITS - 3)


def _edges() -> dict[int, list[list[tuple[int, int, int]]]]:
    """For each byte of a message, the edits from each state: (cost, first letter, state behind it)."""
    table = {}
    for code in range(32):
        initial, fault = INITIALS[code & 3] if code & 3 < 3 else "", code & ~3
        table[code] = []
        for state in range(4):
            edits = [(*_edge("D", DELETE), state)]
            if not fault & (BLANK | DUPLICATE):
                stays = TRUNCATED if fault & CUT else 0
                if (state, initial) in AFTER:
                    edits.append((*_edge("K", KEEP + stays), AFTER[state, initial]))
                edits.append((*_edge("R", REROLE + stays), NEXT[state]))
            table[code].append(edits)
    return table


EDGES = _edges()
INSERTED = _edge("I", INSERT)


def _ahead(edge: tuple[int, int], weight: int) -> int:
    """The weight of an edit and all that follows it."""
    letters = weight & LOW
    return (weight ^ letters) + edge[0] + edge[1] + (letters >> 3)


def _insert(weights: list[int | None], ends: list[int]) -> None:
    """At a place, put up to two messages in; three in a row only come back to where one leads."""
    for _ in range(2):
        found = [None if weights[NEXT[s]] is None else _ahead(INSERTED, weights[NEXT[s]]) for s in range(4)]
        for s, weight in enumerate(found):
            if weight is not None and (weights[s] is None or weight < weights[s]):
                weights[s], ends[s] = weight, ends[NEXT[s]]


def _weigh(codes: bytes, costs: list[int] | None) -> tuple[list[int], list[int]]:
    """Each state's least weight before these messages, and the state it ends in; ``costs`` are those behind them, None at the end."""
    ends = list(range(4))
    if costs is None:
        weights = [0, None, None, 0]  # what may end
        _insert(weights, ends)
    else:
        weights = [cost << LETTER_BITS for cost in costs]
    for code in reversed(codes):
        before, ends_before = [], []
        for edits in EDGES[code]:
            least, state = min((_ahead((cost, letter), weights[then]), then) for cost, letter, then in edits)
            before.append(least)
            ends_before.append(ends[state])
        weights, ends = before, ends_before
        _insert(weights, ends)
    return weights, ends


def _letters(weight: int) -> str:
    digits = weight & LOW
    return "".join(LETTERS[digits >> (LETTER_BITS - 3 * (i + 1)) & 7] for i in range(DIGITS)).rstrip()


def repair(codes: bytes) -> tuple[int, str]:
    """The least cost of a conversation, and the least audit of that cost."""
    if not codes:
        return 0, ""
    blocks, costs = [], None
    for start in range((len(codes) - 1) // BLOCK * BLOCK, -1, -BLOCK):
        weights, ends = _weigh(codes[start:start + BLOCK], costs)
        costs = [w >> LETTER_BITS for w in weights]
        blocks.append((weights, ends))
    audit, state = [], NOTHING
    for weights, ends in reversed(blocks):
        audit.append(_letters(weights[state]))
        state = ends[state]
    return costs[NOTHING], "".join(audit)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone`` after damage; a dropped message stays as a row that is ``gone``."""
    def blank(column: Column) -> Column:
        return F.coalesce(column, F.lit(" "))

    draw = F.crc32(F.concat(blank(F.col("conv_id").cast("string")), F.lit(":"), blank(F.col("turn").cast("string")))) % 20
    rows = conversations.select("conv_id", "turn", blank(F.col("role")).alias("role"), blank(F.col("text")).alias("text"), draw.alias("draw"))
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", STOPS, "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("draw") == 0).alias("gone"), F.explode(times).alias("copy"))
    return rows.drop("copy")


class _Facts:
    """What is held of a conversation while its messages pass."""

    def __init__(self, conv_id):
        self.conv_id, self.codes = conv_id, bytearray()
        self.low = self.high = None
        self.turns = 0

    def add(self, codes: np.ndarray, turns: np.ndarray, has_turn: np.ndarray) -> None:
        here = codes != GONE
        self.codes += codes[here].tobytes()
        turns = turns[here & has_turn]  # rising
        if len(turns):
            self.turns += int(np.count_nonzero(turns[1:] != turns[:-1])) + (self.high is None or int(turns[0]) != self.high)
            self.low = int(turns[0]) if self.low is None else self.low
            self.high = int(turns[-1])

    def report(self, known: dict[bytes, tuple[int, str]]) -> tuple:
        codes = bytes(self.codes)
        found = known.get(codes)
        if found is None:
            found = repair(codes)
            if len(codes) <= 64:
                if len(known) >= KNOWN:
                    known.clear()
                known[codes] = found
        of = np.frombuffer(codes, np.uint8)
        initials = of & 3
        legal = (initials[:-1] != 1) & (initials[1:] == 1) & (initials[:-1] != 3) | (initials[:-1] == 1) & (initials[1:] == 2)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        counts = [int(np.count_nonzero(of & fault)) for fault in (BLANK, DUPLICATE, CUT)]
        return (self.conv_id, gaps, *counts, int(np.count_nonzero(~legal)), *found)


AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audits(facts: DataFrame, kind: str) -> DataFrame:
    """``conv_id`` and ``AUDIT`` of each conversation, from its messages' codes."""
    names = ["conv_id", *(f.split()[0] for f in AUDIT.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        known, current, id_type = {}, None, None

        def rows(reports: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*reports, strict=True)) if reports else [[]] * len(names)
            kinds = [id_type, *[pa.int64()] * 6, pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            id_type, done, start = batch.schema.field("conv_id").type, [], 0
            codes = batch.column("code").to_numpy(zero_copy_only=False).astype(np.uint8)
            turns, has_turn = batch.column("turn"), batch.column("turn").is_valid().to_numpy(zero_copy_only=False)
            turns = pc.fill_null(turns, 0).to_numpy()
            runs = pc.run_end_encode(batch.column("conv_id"))
            for conv_id, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        done.append(current.report(known))
                    current = _Facts(conv_id)
                current.add(codes[start:end], turns[start:end], has_turn[start:end])
                start = end
            yield rows(done)
        if current is not None:
            yield rows([current.report(known)])

    return facts.select("conv_id", "turn", "code").mapInArrow(run, f"conv_id {kind}, {AUDIT}")


class _Digest:
    """The digest of a repaired conversation, message by message."""

    def __init__(self, conv_id, found: dict):
        self.conv_id, self.found, self.at, self.state = conv_id, found, 0, NOTHING
        self.hash, self.between = hashlib.sha256(), b""

    def put(self, role: str, text: str) -> None:
        self.hash.update(self.between + f"{role}:{text}".encode())
        self.between = b"\n"

    def _free(self) -> str:
        """The role that may stand here."""
        self.state = NEXT[self.state]
        return "user" if self.state == USER else "assistant"

    def insert(self) -> None:
        while self.found["audit"][self.at:self.at + 1] == "I":
            self.put(self._free(), "")
            self.at += 1

    def take(self, role: str, text: str) -> None:
        self.insert()
        letter = self.found["audit"][self.at]
        self.at += 1
        if letter == "R":
            self.put(self._free(), text)
        elif letter == "K":
            self.state = AFTER[self.state, role[0]]
            self.put(role, text)

    def row(self) -> tuple:
        self.insert()
        return (self.conv_id, *self.found.values(), self.hash.hexdigest())


def _digests(rows: DataFrame, kind: str) -> DataFrame:
    """Texts behind their conversation's audit, read once."""
    names = ["conv_id", *(f.split()[0] for f in AUDIT.split(", ")), "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, id_type = None, None

        def out(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [[]] * len(names)
            kinds = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            id_type, done = batch.schema.field("conv_id").type, []
            for conv_id, found, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "found", "role", "text")), strict=True):
                if found is not None:
                    if current is not None:
                        done.append(current.row())
                    current = _Digest(conv_id, found)
                else:
                    current.take(role, text)
            yield out(done)
        if current is not None:
            yield out([current.row()])

    return rows.select("conv_id", "found", "role", "text").mapInArrow(run, f"conv_id {kind}, {AUDIT}, repaired_sha256 string")


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Repair conversations of ``conv_id, turn, role, text``; rows that are ``gone`` only name their conversation.

    Returns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    solid, initial = F.regexp_replace("text", BLANKS, ""), F.substring("role", 1, 1)
    first = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    keyed = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "gone", first.alias("first"),
                        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"),
                        F.when(solid == "", BLANK).when(~F.substring(solid, -1, 1).isin(".", "!", "?"), CUT).otherwise(0).alias("fault"))
    seen = F.row_number().over(Window.partitionBy("conv_id", "digest", "gone").orderBy(F.asc_nulls_first("turn")))
    fault = F.when(F.col("fault") == BLANK, BLANK).when(F.col("seen") > 1, DUPLICATE).otherwise(F.col("fault"))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest"]
    facts = (keyed.drop("text").repartition("conv_id").withColumn("seen", seen)
             .withColumn("code", F.when(F.col("gone"), GONE).otherwise(F.col("first") + fault).cast("int"))
             .sortWithinPartitions(*order, "seen"))
    found = _audits(facts, kind)
    nothing = {"turn": "long", "role": "string", "text": "string", "digest": "string"}
    heads = found.select("conv_id", F.lit(0).alias("part"), F.struct(*[c for c in found.columns if c != "conv_id"]).alias("found"),
                         *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
    bodies = keyed.where(~F.col("gone")).select("conv_id", F.lit(1).alias("part"), F.lit(None).cast(heads.schema["found"].dataType).alias("found"), *nothing)
    return _digests(heads.unionByName(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "part", *order[1:]), kind)
