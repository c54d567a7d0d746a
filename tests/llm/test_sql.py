"""Queries that SQL can express, next to that SQL, and their defined cases."""

import pytest
from compare import connect, rows_of

from llm.support import corpus, documents, sf  # noqa: F401
from tidemark.llm import licenses, linededup
from tidemark.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(caller, sf, name):
    frame = QUERIES[name](caller, sf)
    relation = connect(sf).execute(ORACLE[name])
    assert rows_of(frame.columns, frame.collect()) == rows_of([d[0] for d in relation.description], relation.fetchall())


def lines(docs, **options):
    found = linededup.drop_site_lines(docs, **options).collect()
    return sorted((r.row.doc_id or 0, r.clean, r.n_lines, r.n_dropped) for r in found if r.clean is not None)


def test_lines_of_a_site(spark):
    docs = documents(spark, [(i, f"menu\nown {i}\n\nmenu", None, "a") for i in range(6)] + [(9, "menu\nx", None, "b"), (10, "menu", None, None)], line=1, key="k", keys=2)
    got = lines(docs, max_percent=50, min_pages=3)
    assert got == [(i, f"own {i}\n", 4, 2) for i in range(6)] + [(9, "menu\nx", 2, 0), (10, "menu", 1, 0)]


def test_lines_defined_cases(spark):
    rows = [(1, None, None, "a"), (2, "", None, "a"), (3, "same", None, "a"), (3, "same", None, "a"), (None, "same", None, "a"), (4, "y " * 40000, None, "a")]
    got = linededup.drop_site_lines(documents(spark, rows), max_percent=40, min_pages=2).collect()
    assert sorted((str(r.row.doc_id), None if r.clean is None else len(r.clean), r.n_dropped) for r in got) == [
        ("1", None, 0), ("2", 0, 0), ("3", 0, 1), ("3", 0, 1), ("4", 80000, 0), ("None", 0, 1)]
    assert linededup.drop_site_lines(documents(spark, [])).count() == 0
    # a share that is met exactly is not over it
    assert [r[3] for r in lines(documents(spark, [(1, "s", None, "a"), (2, "s", None, "a"), (3, "t", None, "a"), (4, "u", None, "a")]), max_percent=50, min_pages=1)] == [0] * 4


def test_clean_documents_keep_their_columns(spark):
    docs = documents(spark, [(i, "top\nbody %d" % i, "en", "s") for i in range(5)], n_chars=99, clean="c", row="r")
    out = linededup.clean_documents(docs, max_percent=50, min_pages=2)
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} == {(i, f"body {i}", "en", "s", 6, "c", "r") for i in range(5)}


def brute_licenses(text, percent=licenses.MIN_PERCENT):
    import re
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    places = [(i, label) for label, phrase in licenses.PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    labels, best = {label for _, label in places}, 0.0
    length = max(len(t.split()) for t in licenses.TEMPLATES.values())
    for start in range(0, max(len(words) - length, 1), length):
        block = set(words[start:start + 2 * length])
        for name, template in licenses.TEMPLATES.items():
            own = set(template.split())
            if 100 * len(own & block) >= percent * len(own):
                labels.add(name)
                best = max(best, len(own & block) / len(own))
    starts = [i for i, _ in places]
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})),
            ",".join(sorted(labels)), 1.0 if places else best)


def test_wrapped_notices(spark):
    """A notice is found wherever its lines break and wherever in the text it begins."""
    texts, names = [], []
    for name, template in licenses.TEMPLATES.items():
        words = template.split()
        for before in (0, 1, 20, 21, 22, 43, 44, 100):
            broken = "".join(w + (" ", "\n * ", "\n\n")[k % 3] for k, w in enumerate(words))
            texts.append("word " * before + broken + "more " * (before % 7))
            names.append(name)
    got = {r.doc_id: r for r in licenses.find_licenses(documents(spark, list(enumerate(texts)))).collect()}
    assert all(name in got[i].labels.split(",") and got[i].score == 1.0 for i, name in enumerate(names))
    apart = " ".join(w + " filler" * 9 for w in licenses.TEMPLATES["mit-grant"].split())
    assert licenses.find_licenses(documents(spark, [(1, apart)])).head().labels == ""


def test_licenses_against_brute_force(spark):
    texts = ["Released under the MIT License.", "MIT\nlicense mit LICENSE", "", None, "is released under the MIT", "Licensed under CC BY-NC 4.0.", "a\n" * 3000 + "GNU general public license",
             "Apache License, ver 2.0: under the license licensed version", "permission hereby granted, free of charge, to any person obtaining copy of this software and files",
             "MİT License ımıt K license", "License", "general public", "x" * 50000 + " mit license"]
    docs = documents(spark, [(i, t) for i, t in enumerate(texts)] + [(1, texts[1]), (None, "mit license")], words=1, lowered="z", template="t", row_id=5)
    got = sorted((tuple(r)[1:] for r in licenses.find_licenses(docs).collect()), key=repr)
    assert got == sorted([brute_licenses(t) for t in [*texts, texts[1], "mit license"]], key=repr)
    assert licenses.find_licenses(documents(spark, [])).count() == 0
    assert licenses.find_licenses(docs, templates={}).where("n_base > 0").count() == 7
