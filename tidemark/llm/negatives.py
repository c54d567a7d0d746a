"""Hard negatives by a secondary sort: an anchor's pairs arrive by falling score, and positives open windows on what follows.

Components become ``floor(256 * x)`` and scores are integer inner products. An anchor's positives are its first ``positives`` other rows
of the same label, by falling score and then by ``vec_id``. Each positive of score ``p`` opens a window on the rows of
other labels with ``low * p <= 100 * score <= high * p``, and the first ``negatives`` of them are its hard negatives.

Pairs are keyed by (anchor, falling score, positives before negatives, id), dealt by anchor and sorted within partitions; an
iterator walks them once, opens a window for each positive it meets and emits negatives while a window has room. It holds the
open windows of one anchor and nothing else, because a window lies at or behind its positive's place (``high`` is 100 at most).

Only pairs that can matter are shuffled. Anchors and candidates meet in cells, one partition each: a block of anchors of bounded
bytes stays in memory while a share of the candidates streams past, and each anchor keeps its best in running tables. The
first pass over the cells finds the positives, the second one, which then knows every window, keeps ``negatives`` rows a window.
What a cell returns is bounded by its anchors, whatever labels or copies the candidates have. Candidates are copied once per block of
anchors and anchors once per share, so the work is that of all anchors against all rows, as a stated query set's is.

Defined cases: a vector that is null, or holds a null or a component that is not finite, takes no part, nor does a null label or a null
``vec_id``; vectors of different lengths are not compared; of rows that repeat an anchor's ``vec_id`` the one with the smallest
vector and label is the anchor, and none of them is its candidate; other repeated rows each take a place; a positive of negative score
has no window; fewer rows give fewer; an empty table gives none. 100 times a score must stay below 2^63.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import stash

ANCHOR_BYTES = 64 << 20  # of a block of anchors
ANCHORS = 1 << 16  # of a block, at most
SHARE = 1 << 20  # candidates that stream past a block in one task
TILE = 256  # anchors whose scores are held at once
NONE = np.iinfo(np.int64).min
CELL = "cell int, kind int, vec_id long, label long, v array<long>, windows array<long>"


def prepared(vectors: DataFrame, label: Column) -> DataFrame:
    """``vec_id, label, v``: the rows that take part, in whole numbers."""
    whole = F.col("embedding").cast("array<double>")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), whole.alias("embedding"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite)
            .select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x * 256).cast("long")).alias("v")))


@dataclass
class Best:
    """Each anchor's ``k`` best rows so far, by falling score, then id, then arrival."""

    k: int
    anchors: int
    scores: np.ndarray = field(init=False)
    ids: np.ndarray = field(init=False)
    serials: np.ndarray = field(init=False)

    def __post_init__(self):
        self.scores = np.full((self.anchors, self.k), NONE, np.int64)
        self.ids = np.zeros((self.anchors, self.k), np.int64)
        self.serials = np.full((self.anchors, self.k), -1, np.int64)

    def add(self, first: int, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, serials: np.ndarray) -> None:
        """Offer the allowed scores of the anchors from ``first`` on."""
        tile, n = slice(first, first + len(scores)), scores.shape[1]
        allowed &= scores >= self.scores[tile, -1][:, None]
        crowded = np.nonzero(np.count_nonzero(allowed, axis=1) > 4 * self.k)[0]
        if len(crowded) and n > self.k:
            least = np.partition(np.where(allowed[crowded], scores[crowded], NONE), n - self.k, axis=1)[:, n - self.k]
            allowed[crowded] &= scores[crowded] >= least[:, None]
        rows, columns = np.nonzero(allowed)
        if not len(rows):
            return
        touched, at = np.unique(rows, return_inverse=True)
        old = touched + first
        at = np.concatenate([at, np.repeat(np.arange(len(touched)), self.k)])
        all_scores = np.concatenate([scores[rows, columns].astype(np.int64), self.scores[old].ravel()])
        all_ids = np.concatenate([ids[columns], self.ids[old].ravel()])
        all_serials = np.concatenate([serials[columns], self.serials[old].ravel()])
        order = np.lexsort((all_serials, all_ids, ~all_scores, at))
        starts = np.searchsorted(at[order], np.arange(len(touched)))
        chosen = order[starts[:, None] + np.arange(self.k)]
        self.scores[old], self.ids[old], self.serials[old] = all_scores[chosen], all_ids[chosen], all_serials[chosen]


class Block:
    """Anchors of one vector length, and what each keeps of the candidates that stream past."""

    def __init__(self, rows: pa.Table, positives: int, negatives: int, low: int, high: int):
        self.ids, self.labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        self.vectors = _matrix(rows["v"])
        self.windows = None
        if rows["windows"].null_count < rows.num_rows:
            listed = rows["windows"].to_pylist()
            p = np.array([w + [-1] * (positives - len(w)) for w in listed], np.int64).reshape(len(listed), positives)
            self.windows = [(-((-low * p[:, i]) // 100), high * p[:, i] // 100) for i in range(positives)]
        self.best = [Best(k, len(self.ids)) for k in ([positives] if self.windows is None else [negatives] * positives)]
        self.largest = float(np.abs(self.vectors).max(initial=0))

    def meet(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, serials: np.ndarray) -> None:
        exact = self.largest * float(np.abs(vectors).max(initial=0)) * max(1, vectors.shape[1]) < 2.0 ** 52
        kind = np.float64 if exact else np.int64
        columns = vectors.T.astype(kind)
        for first in range(0, len(self.ids), TILE):
            tile = slice(first, first + TILE)
            scores = self.vectors[tile].astype(kind) @ columns
            other, same = self.ids[tile][:, None] != ids, self.labels[tile][:, None] == labels
            if self.windows is None:
                self.best[0].add(first, scores, other & same, ids, serials)
                continue
            other &= ~same
            for best, (least, most) in zip(self.best, self.windows, strict=True):
                best.add(first, scores, other & (scores <= most[tile][:, None]) & (scores >= least[tile][:, None]), ids, serials)

    def kept(self) -> pa.RecordBatch:
        """(anchor, row, score) of what any running table holds, each row once."""
        serials = np.concatenate([b.serials for b in self.best], axis=1)
        at, column = np.nonzero(serials >= 0)
        _, once = np.unique(np.stack([at, serials[at, column]]), axis=1, return_index=True)
        at, column = at[once], column[once]
        ids, scores = (np.concatenate([getattr(b, name) for b in self.best], axis=1)[at, column] for name in ("ids", "scores"))
        return pa.RecordBatch.from_arrays([pa.array(self.ids[at]), pa.array(ids), pa.array(scores)], names=["anchor_id", "vec_id", "score"])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    flat = (column if isinstance(column, pa.Array) else column.chunk(0)).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.int64)


def _by_length(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, pa.Table]]:
    rows = batch if isinstance(batch, pa.Table) else pa.Table.from_batches([batch])
    sizes = np.array([len(v) for v in rows["v"]]) if rows.num_rows else np.zeros(0, int)
    for size in np.unique(sizes):
        yield int(size), rows.filter(pa.array(sizes == size))


def _meet(cells: DataFrame, count: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """Run the cells: what each anchor keeps of each share of the candidates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, blocks, seen = [], None, 0
        for batch in batches:
            is_anchor = batch.column("kind").to_numpy() == 0
            if is_anchor.any():
                waiting.append(batch.filter(pa.array(is_anchor)))
            if is_anchor.all():
                continue
            if blocks is None:  # anchors come first
                blocks = {n: Block(rows, positives, negatives, low, high) for n, rows in _by_length(pa.Table.from_batches(waiting))} if waiting else {}
                waiting = []
            for n, rows in _by_length(batch.filter(pa.array(~is_anchor))):
                if n in blocks:
                    serials = np.arange(seen, seen + rows.num_rows)
                    seen += rows.num_rows
                    blocks[n].meet(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["v"]), serials)
        for block in (blocks or {}).values():
            yield block.kept()

    dealt = cells.repartitionById(count, F.col("cell")).sortWithinPartitions("kind")
    return dealt.mapInArrow(run, "anchor_id long, vec_id long, score long")


def _walk(pairs: DataFrame, negatives: int, low: int, high: int) -> DataFrame:
    """The streaming pass over sorted pairs."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, windows = None, []  # positive id, its score, how many were emitted
        for batch in batches:
            out = []
            for at, fall, kind, row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                score = ~fall
                if at != anchor:
                    anchor, windows = at, []
                if kind == 0:
                    windows.append([row, score, 0])
                    continue
                for window in windows:
                    if window[2] < negatives and low * window[1] <= 100 * score <= high * window[1]:
                        window[2] += 1
                        out.append((anchor, window[0], window[2], row, window[1], score))
            columns = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "rank" else pa.int64()) for c, n in zip(columns, names, strict=True)], names=names)

    by_anchor = pairs.repartition("anchor_id").sortWithinPartitions("anchor_id", "fall", "kind", "vec_id")
    return by_anchor.select("anchor_id", "fall", "kind", "vec_id").mapInArrow(
        run, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def hard_negatives(vectors: DataFrame, label: Column, is_anchor: Column, positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    if not 0 <= low < high <= 100:
        raise ValueError("a window lies between 0 and 100 per cent of its positive's score")
    rows = stash(prepared(vectors, label).withColumn("is_anchor", is_anchor)
                 .withColumn("deal", F.xxhash64("vec_id", F.monotonically_increasing_id())), "vectors")
    n, n_anchors, widest = rows.agg(F.count("*"), F.count_if("is_anchor"), F.max(F.size("v"))).head()
    block = max(1, min(ANCHORS, ANCHOR_BYTES // (8 * max(1, widest or 0))))
    blocks = max(1, math.ceil(n_anchors / block))
    shares = max(1, math.ceil(n / SHARE), math.ceil(vectors.sparkSession.sparkContext.defaultParallelism / blocks))
    anchors = rows.where("is_anchor").groupBy("vec_id").agg(F.min(F.struct("v", "label")).alias("own"))
    anchors = anchors.select("vec_id", "own.label", "own.v", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"))
    share = F.pmod("deal", F.lit(shares)).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: b * shares + share)
    candidates = rows.select(F.explode(cells).alias("cell"), F.lit(1).alias("kind"), "vec_id", "label", "v",
                             F.lit(None).cast("array<long>").alias("windows"))

    def meet(anchors: DataFrame) -> DataFrame:
        cells = F.sequence(F.col("block") * shares, F.col("block") * shares + (shares - 1))
        dealt = anchors.select(F.explode(cells).alias("cell"), F.lit(0).alias("kind"), "vec_id", "label", "v", "windows")
        return _meet(dealt.unionByName(candidates), blocks * shares, positives, negatives, low, high)

    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id"))
    first = stash(meet(anchors.withColumn("windows", F.lit(None).cast("array<long>"))).withColumn("n", rank)
                  .where(F.col("n") <= positives).drop("n"), "positives")
    windows = first.groupBy("anchor_id").agg(F.sort_array(F.collect_list("score"), False).alias("windows"))
    second = meet(anchors.join(windows, anchors.vec_id == windows.anchor_id).drop("anchor_id"))
    pairs = first.withColumn("kind", F.lit(0)).unionByName(second.withColumn("kind", F.lit(1)))
    return _walk(pairs.withColumn("fall", F.bitwise_not("score")), negatives, low, high)
