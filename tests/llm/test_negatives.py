"""Hard negatives next to all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from llm.support import sf  # noqa: F401
from tidemark.llm import negatives, queries

DDL = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, count=10, low=30, high=90, every=100, move=7):
    whole = []
    for vec_id, vector, label in rows:
        if vec_id is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            whole.append((vec_id, tuple(math.floor(256 * x) for x in vector), (label + 1) % 10 if vec_id % move == 0 else label))
    out = []
    for anchor in {r[0] for r in whole if r[0] % every == 0}:
        _, vector, label = min((r for r in whole if r[0] == anchor), key=lambda r: r[1:])
        others = sorted((-sum(a * b for a, b in zip(vector, v, strict=True)), i, k) for i, v, k in whole if i != anchor and len(v) == len(vector))
        for p, i, k in [o for o in others if o[2] == label][:positives]:
            hits = [o for o in others if o[2] != label and low * -p <= 100 * -o[0] <= high * -p][:count]
            out += [(anchor, i, n, h[1], -p, -h[0]) for n, h in enumerate(hits, 1)]
    return sorted(out)


def mine(frame, every=100, **more):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, negatives.hard_negatives(frame, label, F.col("vec_id") % every == 0, **more).collect()))


def crafted(seed, n, dims=3):
    rng = random.Random(seed)
    rows = [(i, [rng.randint(-6, 12) / 8 for _ in range(dims)], rng.choice([0, 1, 1, 1, 2, 9])) for i in range(n)]
    rows += [(None, [1.0] * dims, 1), (500, None, 1), (501, [1.0, None, 0.0], 1), (502, [1.0, float("nan"), 0.0], 1), (503, [float("inf"), 0.0, 0.0], 1),
             (504, [1.0] * dims, None), (505, [1.0] * (dims + 1), 1), (10, [0.5] * dims, 2), (11, [0.5] * dims, 1), (11, [0.5] * dims, 1), (520, [], 1), (530, [0.0] * dims, 2)]
    return rows


def test_query(caller, sf):
    rows = [tuple(r) for r in caller.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, queries.QUERIES["op12_secondary_sort"](caller, sf).collect())) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_crafted(caller, seed):
    rows = crafted(seed, 90)
    frame = caller.createDataFrame(rows, DDL).withColumn("kind", F.lit("x")).withColumn("score", F.lit(1)).repartition(3)
    assert mine(frame, every=10) == brute(rows, every=10)


def test_blocks_and_shares(caller, monkeypatch):
    rows = crafted(5, 150)
    monkeypatch.setattr(negatives, "ANCHORS", 4)
    monkeypatch.setattr(negatives, "SHARE", 40)
    monkeypatch.setattr(negatives, "TILE", 2)
    frame = caller.createDataFrame(rows, DDL).repartition(4)
    assert mine(frame, every=10, positives=2, negatives=3) == brute(rows, every=10, positives=2, count=3)


def test_one_label_and_many_copies(caller):
    rows = [(i, [1.0, 0.5], 3 if i % 40 else 4) for i in range(400)] + [(1000 + i, [0.75, 0.25], 8) for i in range(300)]
    assert mine(caller.createDataFrame(rows, DDL)) == brute(rows)


def test_few_rows(caller):
    assert mine(caller.createDataFrame([], DDL)) == []
    assert mine(caller.createDataFrame([(100, [1.0], 1)], DDL)) == []
    big = [(100, [float(2 ** 18)] * 4, 1), (101, [float(2 ** 18)] * 4, 1), (102, [float(2 ** 17)] * 4, 2), (103, [float(2 ** 17) + 0.25] * 4, 2)]
    assert mine(caller.createDataFrame(big, "vec_id long, embedding array<double>, label int")) == brute(big)
    with pytest.raises(ValueError):
        mine(caller.createDataFrame(big, "vec_id long, embedding array<double>, label int"), low=50, high=50)
