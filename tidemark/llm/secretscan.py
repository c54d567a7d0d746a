"""Secrets: fixed patterns, and values in a credential's context that are costly to guess.

``guess_cost`` is the decimal logarithm of the guesses that find a value under its cheapest segmentation, by
dynamic programming over all segmentations: a segment is a word, a date, a repeat, a keyboard walk or a span of brute force, and ends with a
factor of two for where it does. Words are frequent password words and the words and word parts of a vocabulary file, by rank. A repeat is a
unit of up to ``UNITS`` characters and a factor of ten for how often it stands; a walk is its first key, a factor of ten for its length and a factor
of six for each turn. All of these grow by one character at a time, so a value's segmentation takes time linear in its length, and
values of any length are taken whole.

A value in a credential context (``CONTEXT``) whose cost is at least ``MIN_COST`` is a ``cost`` span, beside the
patterns' spans; a placeholder such as ``password=changeme123`` is not. A value that is a context word itself gives
way to the value behind it (``Authorization: Bearer ...``). Where nothing but blanks stands between context and value, the value
may be the next word of a sentence, in a language whose words the file lacks; it must cost ``MIN_LOOSE``.

Spans are code points, end exclusive; patterns match left to right without overlap, each kind for itself. A null text
is an empty one; an empty text has no spans and cost 0; rows that repeat are scanned row by row; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re

from pyspark.sql import DataFrame

from tidemark.llm.common import map_slices, texts

# The patterns of the three base kinds, and the lengths below which a match is dropped.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")  # the runs of hex digits that are 24 or longer
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "api")

# Words that announce a credential.
NAMES = r"(?:passphrase|passcode|password|passwd|pwd|secret|token|api[ _-]?key|access[ _-]?key|credentials?|bearer|authorization)"
NAME = re.compile(NAMES, re.I | re.A)
CONTEXT = re.compile(NAMES + r"""["']?(?:(?P<sign>[\x20\t]*(?::|=>?|>)[\x20\t]*|[\x20\t]+is(?:[\x20\t]*[:=])?[\x20\t]+)|[\x20\t]+)["'`]?(?P<value>[^\s"'`,;<>()]{6,})""", re.I | re.A)
CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "bearer", "authorization")
MIN_COST, MIN_LOOSE = 10.0, 14.0

# Frequent password words, most frequent first.
WORDS = ("password pass admin welcome letmein login master hello secret monkey dragon shadow sunshine princess football "
         "baseball superman batman iloveyou love trust freedom whatever ninja mustang access flower cheese summer winter "
         "spring autumn computer internet server root user test guest default changeme qwerty abc token key api private "
         "public service system database backup example sample demo house family friend money happy lucky angel tiger "
         "eagle falcon star moon orange purple silver golden diamond matrix hunter ranger soccer hockey killer pepper ginger").split()
WORD_CHARS = (3, 24)  # the shortest and longest word
LEET = str.maketrans("4@3105$7!", "aaeiosstl")
ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
PLACE = {c: (r, k) for r, row in enumerate(ROWS) for k, c in enumerate(row)}
DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d")
YEAR = re.compile(r"(?:19|20)\d\d")
UNITS = 8  # the longest unit of a repeat
JOINT = math.log10(2)  # for each segment: where it ends


def _alphabet(c: str) -> int:
    return 10 if c.isdigit() else 26 if "a" <= c <= "z" or "A" <= c <= "Z" else 33 if c < "\x7f" else 100


def _step(a: str, b: str) -> tuple[int, int] | None:
    """The move from one key to a neighbour, or to the next or previous letter or digit."""
    if a.isalnum() and b.isalnum() and abs(ord(a) - ord(b)) == 1:
        return (9, ord(b) - ord(a))
    here, there = PLACE.get(a), PLACE.get(b)
    if here is None or there is None:
        return None
    move = (there[0] - here[0], there[1] - here[1])
    return move if move in ((0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1)) else None


def word_ranks(path: str | None) -> dict[str, int]:
    """Words and their ranks: the password words, and the letters-only tokens of a file of byte tokens by rank."""
    ranks = {w: i + 1 for i, w in enumerate(WORDS)}
    if path is not None:
        with open(path, "rb") as file:
            for rank, line in enumerate(file, 1):
                word = base64.b64decode(line.split()[0]).decode("utf-8", errors="replace").strip().lower()
                if word.isalpha() and WORD_CHARS[0] <= len(word) <= WORD_CHARS[1]:
                    ranks.setdefault(word, rank + len(WORDS))
    return ranks


def _word_cost(part: str, low: str, ranks: dict[str, int]) -> float | None:
    plain = ranks.get(low)
    rank = plain or ranks.get(low.translate(LEET))
    if rank is None:
        return None
    upper = sum(c.isupper() for c in part)
    case = 0.0 if not upper else JOINT if upper == len(part) or part[0].isupper() and upper == 1 else math.log10(2) * min(upper, len(part) - upper) + JOINT
    return math.log10(rank) + case + (0.0 if plain else 2 * JOINT)


def segment(value: str, ranks: dict[str, int]) -> tuple[float, list[tuple[str, int, int]]]:
    """The cheapest segmentation: cost as a decimal logarithm, and (kind, start, end) of its segments.

    ``best[j]`` is the least cost of the first ``j`` characters. Brute force, repeats and walks that end at ``j`` go on from those that ended
    earlier; each carries its cost and where it began.
    """
    n, low = len(value), value.lower() if len(value.lower()) == len(value) else value
    each = [math.log10(_alphabet(c)) for c in value]
    sums = [0.0]
    for cost in each:
        sums.append(sums[-1] + cost)
    best, back = [0.0] + [math.inf] * n, [("", 0)] * (n + 1)
    never = (math.inf, 0)
    brute, pair, walk = never, never, never
    repeats = [[never] * unit for unit in range(UNITS + 1)]  # of each unit, those that end at the last so many places
    period = [0] * (UNITS + 1)  # characters up to here that equal the one a unit before
    before = None  # the last move
    for j in range(1, n + 1):
        options = []
        brute = min(brute, (best[j - 1] + JOINT, j - 1))
        brute = (brute[0] + each[j - 1], brute[1])
        options.append(("brute", *brute))
        for i in range(max(0, j - WORD_CHARS[1]), j - WORD_CHARS[0] + 1):
            cost = _word_cost(value[i:j], low[i:j], ranks)
            if cost is not None:
                options.append(("word", best[i] + cost + JOINT, i))
        for length, pattern, count in ((4, YEAR, 120), (8, DATE, 365 * 120), (10, DATE, 365 * 120)):
            if j >= length and pattern.fullmatch(value, j - length, j):
                options.append(("date", best[j - length] + math.log10(count) + JOINT, j - length))
        for unit in range(1, UNITS + 1):
            period[unit] = period[unit] + 1 if j > unit and value[j - 1] == value[j - 1 - unit] else 0
            least = (3 if unit == 1 else 2) * unit
            begun = (best[j - least] + sums[j] - sums[j - unit] + 1 + JOINT, j - least) if period[unit] >= least - unit else never
            last = repeats[unit][j % unit] if period[unit] >= unit else never
            repeats[unit][j % unit] = min(begun, last)
            options.append(("repeat", *repeats[unit][j % unit]))
        move = _step(low[j - 2], low[j - 1]) if j > 1 else None
        turn = math.log10(6) if move != before else 0.0
        walk = min((pair[0] + turn, pair[1]), (walk[0] + turn, walk[1])) if move is not None else never
        pair = (best[j - 2] + math.log10(47) + 1 + JOINT, j - 2) if move is not None else never
        before = move
        options.append(("walk", *walk))
        kind, best[j], start = min(options, key=lambda o: o[1])
        back[j] = (kind, start)
    parts, end = [], n
    while end:
        kind, start = back[end]
        parts.append((kind, start, end))
        end = start
    return best[n], parts[::-1]


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    return segment(value, ranks)[0]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three patterns, by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(hint in low for hint in ASSIGN_HINTS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda span: span[1])  # stable, so kinds stay in their order


def scan(text: str | None, ranks: dict[str, int]) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], float]:
    """Base spans, added spans, and the highest cost among values of credential contexts."""
    text = text or ""
    base, added, highest = base_spans(text), [], 0.0
    low = text.lower()
    if any(hint in low for hint in CONTEXT_HINTS):
        at = 0
        while m := CONTEXT.search(text, at):
            start, at = m.span("value")
            value = m["value"].rstrip(".!?:")
            end = start + len(value)
            name = NAME.match(text, start)
            if name and name.end() >= start + len(value.rstrip("=:")):
                at = start  # a context word itself: the value is behind it
                continue
            cost = guess_cost(value, ranks)
            highest = max(highest, cost)
            if cost >= (MIN_COST if m["sign"] else MIN_LOOSE):
                added.append(("cost", start, end))
    return base, added, highest


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_secrets(docs: DataFrame, words: str | None = None) -> DataFrame:
    """Per document: counts, the digest of the base spans, all spans, and the highest guess cost.

    ``words`` is a file of byte tokens by rank, from which words are taken beside the password words.
    """
    ranks = word_ranks(words)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def of(piece):
        rows = [scan(text, ranks) for text in texts(piece)]
        count = lambda name: [sum(k == name for k, _, _ in base + added) for base, added, _ in rows]
        return [piece.column("doc_id"), count("assign"), count("access"), count("hex"),
                [hashlib.sha256(joined(base).encode()).hexdigest() for base, _, _ in rows],
                [joined(sorted(base + added, key=lambda s: s[1])) for base, added, _ in rows], count("cost"),
                [cost for _, _, cost in rows]]

    return map_slices(docs.select("doc_id", "text"), f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, "
                      "spans string, n_cost long, max_cost double", of)
