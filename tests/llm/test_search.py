"""Top-k search and contamination against brute force."""

import itertools
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.support import corpus, documents, sf  # noqa: F401
from tidemark.llm import decontam, topk
from tidemark.llm.queries import QUERIES


def brute_top(rows, step, k):
    import math
    vectors = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in vectors if i % step == 0}):
        own = min(v for i, v in vectors if i == q)
        scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in vectors if i != q and len(v) == len(own))[:k]
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores)]
    return out


@pytest.mark.parametrize("candidates,queries", [(8192, 1024), (7, 3)])
def test_top_k(spark, monkeypatch, candidates, queries):
    monkeypatch.setattr(topk, "CANDIDATES", candidates)
    monkeypatch.setattr(topk, "QUERIES", queries)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=19) * (3 if i % 7 else 30)]) for i in range(120)]
    rows += [(200 + i, rows[5][1]) for i in range(9)] + [(0, rows[3][1]), (11, rows[3][1]), (None, rows[3][1]), (300, None), (301, [1.0, None] * 9 + [1.0]), (302, [float("nan")] * 19),
             (303, [float("inf")] * 19), (310, [1.0, 2.0]), (320, [0.5, -2.0]), (330, []), (340, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("score", F.lit(1)).repartition(3)
    got = topk.top_k(frame, F.col("vec_id") % 10 == 0, 4)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 10, 4)


def test_top_k_of_large_numbers():
    rng = np.random.default_rng(1)
    c, q = rng.integers(-10 ** 8, 10 ** 8, (50, 20)), rng.integers(-10 ** 8, 10 ** 8, (3, 20))
    got = topk.best_of_block(q, np.array([-1, -2, -3]), c, np.arange(50), 5)
    scores = q.astype(object) @ c.T.astype(object)
    assert got == [(-1 - i, int(j), int(scores[i][j])) for i in range(3) for j in sorted(range(50), key=lambda j: (-scores[i][j], j))[:5]]


def test_top_k_empty(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(frame, F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(one, F.col("vec_id") % 50 == 0).count() == 0


UNSPACED = [(0x0E00, 0x0EFF), (0x0F00, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3041, 0x3096), (0x309D, 0x309F), (0x30A1, 0x30FA), (0x30FD, 0x30FF), (0x3400, 0x9FFF), (0x20000, 0x3FFFF)]


def words(text):
    """Character by character."""
    out, open_ = [], False
    for c in (text or ""):
        c, kind = c.lower() if c.isascii() else c, unicodedata.category(c)[0]
        if kind not in "LMN":
            open_ = False
        elif kind != "M" and any(low <= ord(c) <= high for low, high in UNSPACED):
            out.append(c)
            open_ = None  # marks go on, letters do not
        elif open_ or open_ is None and kind == "M":
            out[-1] += c
        else:
            out.append(c)
            open_ = True
    return out


def brute_items(text, items):
    found, doc = set(), words(text)
    for item_id, t in items:
        own = words(t)
        size = min(len(own), decontam.WINDOW)
        if own and any(100 * sum(a == b for a, b in zip(doc[p:p + size], own[i:i + size])) >= decontam.MIN_PERCENT * size
                       for p in range(len(doc) - size + 1) for i in range(len(own) - size + 1)):
            found.add(item_id)
    return found


def contaminated(frame):
    return sorted(((r.row.doc_id, {f.item_id for f in r.found}) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("part_chars", [decontam.PART_CHARS, 60])
def test_contamination(spark, monkeypatch, part_chars):
    monkeypatch.setattr(decontam, "PART_CHARS", part_chars)
    rng = np.random.default_rng(6)
    item = [f"q{i}" for i in range(20)]
    items = [(1, " ".join(item)), (2, "five short words stand here"), (3, "four words are few"), (4, None), (5, ""), (None, " ".join(item)), (1, "Another Ünïcode item, that has – in all – at least thirteen words or so: yes!"), (6, "of the " * 8)]
    texts = [None, "", " ".join(item), "x " + " ".join(item[3:16]) + " y", " ".join(item[3:15]), "Five, short WORDS (stand) here", "five short words stood here", "of the " * 4000,
             "another ünïcode item that has in all at last thirteen words or no yes", "four words are few"]
    items += [(7, "one"), (8, "日本の首都は東京です。"), (9, "ten words of which two may differ from the text here"), (10, "กรุงเทพ"), (11, "don’t “quote” me")]
    texts += ["ONE", "someone", "昔、日本の首都は東京でした！", "日本の首都は京都です", "x ten words of this two may be from the text here y", "ten words of this two may be from a text here",
              "ไปกรุงเทพแล้ว", "he said: don’t quote me", "don't quote us", "five short kinds stand here", "four words are new"]
    for _ in range(25):
        noisy = list(item)
        for at in rng.choice(20, rng.integers(0, 7), replace=False):
            noisy[at] = "zz"
        texts.append("pre " * int(rng.integers(0, 4)) + " ".join(noisy) + " post")
    docs = documents(spark, [(i, t) for i, t in enumerate(texts)] + [(2, texts[2]), (None, texts[2])], row=1, found="f", _row=2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = [(i, brute_items(t, items)) for i, t in enumerate(texts)] + [(2, {1, None}), (None, {1, None})]
    assert contaminated(decontam.find_contamination(docs, bench)) == sorted(expected, key=repr)
    kept = decontam.clean_documents(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [i for i, t in enumerate(texts) if not brute_items(t, items)]


def test_no_short_item_escapes_its_masks():
    for size in range(1, decontam.WINDOW):
        differ = size * (100 - decontam.MIN_PERCENT) // 100
        masks = decontam.short_masks(size)
        assert all("1" in mask for mask in masks)
        for gone in itertools.combinations(range(size), differ):
            assert any(all(bit == "0" or k not in gone for k, bit in enumerate(mask)) for mask in masks)


def test_no_window_escapes_the_masks():
    for gone in itertools.combinations(range(decontam.WINDOW), 2):
        assert any(all(bit == "0" or at + k not in gone for k, bit in enumerate(mask)) for mask in decontam.MASKS for at in range(decontam.WINDOW - len(mask) + 1))


def test_contamination_of_nothing(spark):
    docs, none = documents(spark, [(1, "a b c d e f")]), spark.createDataFrame([], "item_id long, text string")
    assert contaminated(decontam.find_contamination(docs, none)) == [(1, set())]
    assert decontam.find_contamination(documents(spark, []), spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")).count() == 0


def test_contamination_of_documents(caller, sf, corpus):
    items = [tuple(r) for r in caller.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: r for r in QUERIES["op3_spaced_seeds"](caller, sf).collect()}
    short = [(d, t) for d, t, _, _ in corpus if len(t) <= 3000]
    assert {d: set(got[d].item_ids) for d, _ in short if d in got} == {d: found for d, t in short if (found := brute_items(t, items))}
    assert got and all(r.item_ids and r.longest > 0 for r in got.values())
