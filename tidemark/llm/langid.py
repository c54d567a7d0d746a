"""Language identification by error-correcting output codes.

Each language has a codeword. For every bit a binary naive Bayes classifier over hashed byte trigrams is learned:
languages whose bit is 1 against those whose bit is 0. A text's margins on all bits are compared with the codewords;
the language with the smallest sum of logistic losses wins (loss-weighted decoding), and the result is ambiguous if
the runner-up's loss is close.

Learning: at most about ``PER_LANGUAGE`` documents of each language, chosen by a hash of the id, whole texts; their
trigrams are counted in Spark, so the driver holds one weight per language and bucket. Scoring is one map over the table.

Defined cases: a text that is null or has no letter is ``und`` with score 0; with one learned language every other text
gets it; with none every text is ``und``; ties go to the language first in alphabetical order; rows with a null id are
learned from as if the id were empty; rows that repeat are scored row by row; other columns are ignored.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import map_slices, slices

STRETCH = 1 << 18  # bytes whose trigrams are held at once, so that a text of any length takes little more than itself
BUCKETS = 1 << 14
PER_LANGUAGE = 1500
SCALE = 4.0  # of a margin per square root of a trigram
AMBIGUOUS = 0.7  # a best language below this share is flagged

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_ASCII_LETTER = re.compile("[A-Za-z]")


def id_remainder(doc_id: Column, divisor: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor).cast("long"))


def codewords(languages: list[str], seed: int = 7) -> np.ndarray:
    """One row of +1 and -1 for each language: every split of up to seven languages, else random splits far apart."""
    n = len(languages)
    if n < 2:
        return np.ones((n, 0), np.float32)
    if n <= 7:
        splits = [[1 if i == n - 1 or not (s >> i) & 1 else -1 for i in range(n)] for s in range(1, 1 << (n - 1))]
        return np.array(splits, np.float32).T
    rng = random.Random(seed)
    bits, best, far = math.ceil(10 * math.log2(n)), None, -1
    for _ in range(50):
        columns = []
        while len(columns) < bits:
            column = [rng.choice((-1, 1)) for _ in range(n)]
            if abs(sum(column)) < n:
                columns.append(column)
        code = np.array(columns, np.float32).T
        gap = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if gap > far:
            best, far = code, gap
    return best


def _folded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The folded bytes of the texts one after the other, and each text's first, then the end."""
    filled = pc.fill_null(column, "")
    raw = pc.cast(filled, pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = raw.buffers()[2]
    codes = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return _FOLD[codes].astype(np.uint8, copy=False), offsets - offsets[0]


def _trigrams(codes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Stretch by stretch of at most ``STRETCH`` bytes: the texts that have trigrams in it, the first trigram of each, all buckets.

    A text's last two bytes begin no trigram; those places have bucket ``BUCKETS``.
    """
    ends = np.maximum(starts[:-1], starts[1:] - 2)
    for a in range(0, len(codes) - 2, STRETCH):
        b = min(a + STRETCH, len(codes) - 2)
        part = codes[a:b + 2].astype(np.uint32)
        mixed = (part[:-2] * np.uint32(0x9E3779B1)) ^ (part[1:-1] * np.uint32(0x85EBCA77)) ^ (part[2:] * np.uint32(0xC2B2AE3D))
        mixed ^= mixed >> np.uint32(15)
        buckets = ((mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(18)).astype(np.int32)
        low, high = np.searchsorted(starts, a, "right") - 1, np.searchsorted(starts, b, "left")
        texts = np.arange(low, high)
        for back in (1, 2):
            last = starts[texts + 1] - back
            last = last[(last >= starts[texts]) & (last >= a) & (last < b)]
            buckets[last - a] = BUCKETS
        texts = texts[(ends[texts] > a) & (starts[texts] < np.minimum(ends[texts], b))]
        if len(texts):
            yield texts, np.maximum(starts[texts], a) - a, buckets


def _counted(docs: DataFrame) -> DataFrame:
    """``lang, bucket, n``: how often each trigram bucket occurs in the texts of a language."""
    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in slices(batch):
                langs = piece.column("lang").to_pylist()
                for texts, first, buckets in _trigrams(*_folded(piece.column("text"))):
                    for i, own in zip(texts, np.split(buckets, first[1:]), strict=True):
                        before = counts.setdefault(langs[i], np.zeros(BUCKETS + 1, np.int64))
                        before += np.bincount(own, minlength=BUCKETS + 1)
        for lang, own in counts.items():
            used = np.nonzero(own[:BUCKETS])[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(own[used])],
                                             names=["lang", "bucket", "n"])

    return docs.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Languages, their codewords and each bit's weight for every bucket."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages, self.code = languages, codewords(languages)
        chances = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True) if len(languages) else counts
        self.weights = np.zeros((BUCKETS + 1, self.code.shape[1]), np.float32)  # the last for places without a trigram
        for bit in range(self.code.shape[1]):
            ones = self.code[:, bit] > 0
            self.weights[:BUCKETS, bit] = np.log(chances[ones].mean(axis=0) / chances[~ones].mean(axis=0))

    def shares(self, column: pa.Array) -> np.ndarray:
        """For each text the languages' shares of belief, by loss-weighted decoding."""
        codes, starts = _folded(column)
        margins = np.zeros((len(column), self.weights.shape[1]))
        for texts, first, buckets in _trigrams(codes, starts) if self.weights.shape[1] else ():
            margins[texts] += np.add.reduceat(self.weights[buckets], first, axis=0)
        sizes = np.maximum(starts[1:] - starts[:-1] - 2, 1)
        margins *= (SCALE / np.sqrt(sizes))[:, None]
        losses = np.logaddexp(0, -margins[:, None, :] * self.code[None, :, :]).sum(axis=2)
        believed = np.exp(-(losses - losses.min(axis=1, keepdims=True)))
        return believed / believed.sum(axis=1, keepdims=True)


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """``docs`` needs ``doc_id``, ``text`` and ``lang``; it holds only what may be learned from."""
    known = docs.where("lang IS NOT NULL").select("doc_id", "text", "lang")
    sizes = dict(known.groupBy("lang").count().collect())  # a row for each language
    if not sizes:
        return Model([], np.zeros((0, BUCKETS)))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_language / n))])
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("drawn")), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20)
    languages = sorted(sizes)
    counts = np.zeros((len(languages), BUCKETS))
    for lang, bucket, n in _counted(known.where(drawn).where("text IS NOT NULL")).toLocalIterator():
        counts[languages.index(lang), bucket] = n
    return Model(languages, counts)


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` in ``row``, then ``lang_pred``, ``score`` and ``ambiguous``."""
    kept = [docs[c] for c in keep or docs.columns]
    inside = "text" in (keep or docs.columns)  # then the text goes to the task once, inside its row
    ids = docs.select(F.struct(*kept).alias("row"), *([] if inside else [docs["text"].alias("text")]))
    languages = model.languages

    def of(piece: pa.RecordBatch) -> list:
        pred, score = [], []
        for part in slices(piece, max(1 << 17, (1 << 23) // max(8, model.weights.shape[1]))):
            texts = part.column("row").field("text") if inside else part.column("text")
            shares = model.shares(texts) if languages else np.zeros((len(texts), 1))
            best = shares.argmax(axis=1)
            for i, text in enumerate(texts.to_pylist()):
                named = bool(languages) and has_letter(text)
                pred.append(languages[best[i]] if named else "und")
                score.append(float(shares[i, best[i]]) if named else 0.0)
        return [piece.column("row"), pred, score, [s < AMBIGUOUS for s in score]]

    kind = ids.schema["row"].dataType.simpleString()
    return map_slices(ids, f"row {kind}, lang_pred string, score double, ambiguous boolean", of)
