"""Near-duplicate groups against all pairs, and connected components against union-find."""

import random

from llm.support import corpus, documents, sf  # noqa: F401
from tidemark.llm import neardup
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES


def brute(rows, percent=85):
    """Per doc_id: (set sizes, smallest linked doc_id), from all pairs of rows."""
    sets = []
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        sets.append((doc_id, {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()))
    parent = {d: d for d, _ in sets if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if None not in (a, b) and x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return sorted(((d, len(s), None if d is None else find(d)) for d, s in sets), key=repr)


def got(frame):
    rows = frame.collect()
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)


def test_documents(caller, sf, corpus):
    assert got(QUERIES["op2_lsh_forest"](caller, sf)) == brute([(d, t) for d, t, _, _ in corpus])


def test_defined_cases(spark):
    rows = [(5, None), (6, ""), (7, " \n"), (1, "a b"), (9, "A  B"), (2, "a b c"), (None, "a b"), (3, "one two three four five six"), (3, "a b c"),
            (4, "w " * 30000), (8, "w " * 9), (11, "é É x y z"), (12, "é É x y z")]
    assert got(neardup.near_duplicates(documents(spark, rows, rep=1, set_id="x", size=3, branch="b"))) == brute(rows)
    assert neardup.near_duplicates(documents(spark, [])).count() == 0


def test_crowded_regions_go_deeper(spark, monkeypatch):
    """A large group of near copies, of which many are linked only through others, in regions of at most eight."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(150):
        words = list(base)
        for _ in range(rng.choice((0, 1, 1, 2, 3))):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10 ** 6)}"
        rows.append((d, " ".join(words)))
    rows += [(500 + d, rows[0][1]) for d in range(20)]
    expected = brute(rows)
    assert got(neardup.near_duplicates(documents(spark, rows))) == expected
    monkeypatch.setattr(neardup, "REGION", 40)
    assert got(neardup.near_duplicates(documents(spark, rows))) == expected


def test_alike_in_all_hashes(spark, monkeypatch):
    monkeypatch.setattr(neardup, "REGION", 1)
    monkeypatch.setattr(neardup, "DEPTHS", (1, 2))
    body = " ".join(f"w{i}" for i in range(4000))
    rows = [(d, body + f" end{d}") for d in range(12)]
    assert {r.component_id for r in neardup.near_duplicates(documents(spark, rows)).collect()} == {0}


def test_clean_documents(spark):
    docs = documents(spark, [(2, "a b c d e f", "en", "s"), (1, "a b c d e f", "fr", "t"), (3, None, None, None)], kept=False, gone=4)
    out = neardup.clean_documents(docs)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {1, 3}


def test_components(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, rng.randrange(101, 160)) for _ in range(60)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    found = components(spark.createDataFrame(pairs, "a long, b long").repartition(4))
    assert dict(map(tuple, found.collect())) == {v: find(v) for v in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_linked_pairs_in_a_crowd_of_half_similar_texts(spark, monkeypatch):
    """No region of two classes fits, and most pairs are apart at the greater depths."""
    rng, rows = random.Random(6), []
    base = [f"w{i}" for i in range(140)]
    for d in range(0, 24, 2):
        words = base + [f"d{d}w{i}" for i in range(60)]
        rows.append((d, " ".join(words)))
        for at in rng.sample(range(144, 196, 8), 3):
            words[at] += "x"
        rows.append((d + 1, " ".join(words)))
    expected = brute(rows)
    assert len({c for _, _, c in expected}) == 12
    monkeypatch.setattr(neardup, "REGION", 1)
    monkeypatch.setattr(neardup, "DEPTHS", (3, 4, 24, 256))
    assert got(neardup.near_duplicates(documents(spark, rows))) == expected


def test_texts_too_long_for_a_region(spark, monkeypatch):
    """Two texts with more shingles than a region may have, and a group of them."""
    rng, rows = random.Random(8), []
    for d, copies in ((0, 2), (10, 5)):
        for k in range(copies):
            words = [f"d{d}w{i}" for i in range(400)]
            for at in rng.sample(range(8, 390, 8), 2):
                words[at] += f"x{k}"
            rows.append((d + k, " ".join(words)))
    expected = brute(rows)
    assert {c for _, _, c in expected} == {0, 10}
    monkeypatch.setattr(neardup, "REGION_SHINGLES", 700)
    monkeypatch.setattr(neardup, "DEPTHS", (3, 4, 128, 256))
    assert got(neardup.near_duplicates(documents(spark, rows))) == expected
