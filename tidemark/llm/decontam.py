"""Benchmark decontamination by spaced-seed hashing.

Tokens are runs of letters (ASCII ones lower-cased), marks and digits, and each letter of a script that is written without spaces is a token of its
own; everything else separates. A mask reads some positions of a window and
ignores the others. Windows of benchmark items and of documents that agree under a mask are hits; around each the item
is laid along the document. A document is contaminated by an item if of ``WINDOW`` tokens that lie on each other one after the other
at least ``MIN_PERCENT`` percent are the same. The four masks were chosen so that any such window holds a hit, wherever its
differing tokens are, so none is missed.

An item of fewer than ``WINDOW`` tokens is one window of its own length, in the same proportion: two tokens of ten may differ, one of five, none of four.
Its masks read every second or third position, one more mask than tokens may differ, so that one of them reads none of these.
The benchmark's index is sent to the tasks in parts of at most ``PART_CHARS`` characters, measured first; each
part takes a pass over the documents, and no document's text is ever shuffled.

Defined cases: null texts are empty; an empty document or item has no hit; an empty benchmark contaminates nothing; items that repeat
are items of their own, and so are items with a null id, which come first in ``found``; rows that repeat are judged row by row; other columns are passed on.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import map_slices, texts

WINDOW, MIN_PERCENT = 13, 80
PART_CHARS = 16 << 20  # of benchmark text in one index

# Positions read (1) and ignored (0). Together they hit every window of 13 with two differing tokens.
MASKS = ("11110111", "1110100111", "1100111011", "111010010011")

ASCII = re.compile(rb"[0-9a-z]+")
# The scripts that are written without spaces.
UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}"
TOKEN = regex.compile(rf"[{UNSPACED}&&[\p{{L}}\p{{N}}]]\p{{M}}*|[[\p{{L}}\p{{M}}\p{{N}}]--[{UNSPACED}]]+", regex.V1)
_FACTORS = np.random.default_rng(11).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def tokens(text: str | None) -> np.ndarray:
    """A hash of each token."""
    low = (text or "").encode().lower()
    found = ASCII.findall(low) if low.isascii() else TOKEN.findall(low.decode())
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def short_masks(size: int) -> list[str]:
    """The masks of an item of ``size`` tokens, fewer than ``WINDOW``."""
    count = 1 + size * (100 - MIN_PERCENT) // 100
    return ["".join("1" if k % count == first else "0" for k in range(size)) for first in range(count)]


def windows(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The hash under the mask of the window that starts at each position."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, len(mask), np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            total += hashes[k:k + n] * _FACTORS[k]
    total ^= total >> np.uint64(29)
    return total * np.uint64(0xBF58476D1CE4E5B9)


class Index:
    """Window hashes of some items, each with item and position, and the items' tokens."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.ids = [i for i, _ in items]
        self.items = [tokens(t) for _, t in items]
        short = sorted({len(t) for t in self.items if 0 < len(t) < WINDOW})
        sized = [*((mask, None) for mask in MASKS), *((mask, n) for n in short for mask in short_masks(n))]
        self.masks = [mask for mask, _ in sized]
        self.keys, self.owners, self.places = [], [], []
        for mask, size in sized:
            own = [(k, windows(t, mask)) for k, t in enumerate(self.items) if (len(t) >= WINDOW if size is None else len(t) == size)]
            keys = np.concatenate([np.zeros(0, np.uint64), *[w for _, w in own]])
            owners = np.concatenate([np.zeros(0, np.int64), *[np.full(len(w), k) for k, w in own]])
            places = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(w)) for _, w in own]])
            order = np.argsort(keys, kind="stable")
            self.keys.append(keys[order])
            self.owners.append(owners[order])
            self.places.append(places[order])
        self.sieves = []
        for keys in self.keys:
            sieve = np.zeros(1 << 20, bool)
            sieve[(keys >> np.uint64(44)).astype(np.int64)] = True
            self.sieves.append(sieve)

    def hits(self, hashes: np.ndarray) -> set[tuple[int, int]]:
        """(item, offset of the document's position from the item's) of all windows that agree under a mask."""
        found = set()
        for mask, keys, owners, places, sieve in zip(self.masks, self.keys, self.owners, self.places, self.sieves, strict=True):
            own = windows(hashes, mask)
            at = np.nonzero(sieve[(own >> np.uint64(44)).astype(np.int64)])[0]
            if not len(at):
                continue
            first, stop = (np.searchsorted(keys, own[at], side) for side in ("left", "right"))
            for position, a, b in zip(at[stop > first].tolist(), first[stop > first].tolist(), stop[stop > first].tolist(), strict=True):
                found.update(zip(owners[a:b].tolist(), (position - places[a:b]).tolist(), strict=True))
        return found

    def overlap(self, hashes: np.ndarray, item: int, offset: int) -> tuple[int, int] | None:
        """Start in the document and tokens of the stretch that contaminated windows cover, or none."""
        own = self.items[item]
        first, stop = max(0, -offset), min(len(own), len(hashes) - offset)
        same = (own[first:stop] == hashes[first + offset:stop + offset]).astype(np.int64)
        if len(own) < WINDOW:
            return (offset, len(own)) if stop - first == len(own) and same.sum() * 100 >= len(own) * MIN_PERCENT else None
        if len(same) < WINDOW:
            return None
        sums = np.convolve(same, np.ones(WINDOW, np.int64), "valid")
        good = np.nonzero(sums * 100 >= WINDOW * MIN_PERCENT)[0]
        if not len(good):
            return None
        return int(first + offset + good[0]), int(good[-1] - good[0] + WINDOW)

    def found(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item id, start, tokens) of each item in the text, the longest stretch of each item."""
        hashes = tokens(text)
        best: dict[int, tuple[int, int]] = {}
        for item, offset in sorted(self.hits(hashes)):
            stretch = self.overlap(hashes, item, offset)
            if stretch and (item not in best or stretch[1] > best[item][1]):
                best[item] = stretch
        return sorted(((self.ids[k], *stretch) for k, stretch in best.items()), key=lambda f: (f[0] is not None, f[0] or 0, *f[1:]))


FOUND = "array<struct<item_id: bigint, start: bigint, tokens: bigint>>"


def _part(rows: DataFrame, index: Index) -> DataFrame:
    """``row, found`` with the items of the index added; a text goes to the task once, inside its row."""
    kind = rows.schema["row"].dataType.simpleString()
    made = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("tokens", pa.int64())]))

    def of(piece):
        row = piece.column("row")
        found = [[*known, *[{"item_id": i, "start": s, "tokens": n} for i, s, n in index.found(text)]]
                 for known, text in zip(piece.column("found").to_pylist(), row.field("text").to_pylist(), strict=True)]
        return [row, pa.array(found, made)]

    return map_slices(rows, f"row {kind}, found {FOUND}", of)


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``row`` (the document's columns) and ``found``: item, start and length in tokens of every benchmark item in it."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    chars = items.agg(F.sum(F.length("text"))).head()[0] or 0
    parts = -(-chars // PART_CHARS) or 1
    out = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.array().cast(FOUND).alias("found"))
    for part in range(parts):  # one, unless the benchmark is over the size that may be sent to every task
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        out = _part(out, Index([(r.item_id, r.text) for r in own.orderBy("item_id", "text").collect()]))
    return out.select("row", F.array_sort(F.array_distinct("found")).alias("found"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no item contaminates, with the same columns."""
    kept = find_contamination(docs, benchmark).where(F.size("found") == 0)
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
