"""The pipeline against a brute-force version, stage by stage on the rows the one before kept."""

import random
from collections import Counter

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from llm.support import corpus, documents, sf  # noqa: F401
from llm.test_models import slow_shares
from llm.test_neardup import brute
from llm.test_search import brute_items
from llm.test_tokens import naive
from tidemark.llm import langid, linededup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_lines(rows):
    pages, held = Counter(r[3] for r in rows), Counter()
    for _, text, _, source, _ in rows:
        held.update((source, line) for line in set((text or "").split("\n")) if line.strip(" "))
    bad = {k for k, n in held.items() if k[0] is not None and n >= linededup.MIN_PAGES and n * 100 > pages[k[0]] * linededup.MAX_PERCENT}
    out = []
    for doc_id, text, lang, source, chars in rows:
        text = None if text is None else "\n".join(line for line in text.split("\n") if (source, line) not in bad)
        out.append((doc_id, text, lang, source, chars if text is None else len(text)))
    return out


def test_documents(caller, sf):
    docs = caller.read.parquet(f"{sf}/documents.parquet").select(*COLUMNS)
    rows = sorted(map(tuple, docs.collect()))
    model = langid.learn(docs.where(langid.id_remainder(F.col("doc_id"), 3) != 1))
    rows = [r for r in rows if langid.has_letter(r[1]) and slow_shares(model, r[1]).max() >= corpus_pipeline.LEAST_BELIEF]
    rows = brute_lines(rows)
    groups = {d: c for d, _, c in brute([(r[0], r[1]) for r in rows], corpus_pipeline.NEAR_PERCENT)}
    rows = [r for r in rows if groups[r[0]] == r[0]]
    items = [tuple(r) for r in caller.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r for r in rows if not brute_items(r[1], items)]
    coder = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in corpus_pipeline.run(caller, sf).collect()}
    assert sorted(got) == [r[0] for r in rows]
    assert all(r.round_trip for r in got.values())
    for doc_id, text, *_ in [r for r in rows if len(r[1]) < 4000][:40]:
        assert got[doc_id].ids == naive(coder, text)


def test_stages_keep_columns_and_odd_rows(spark, sf):
    rows = [(1, None), (2, ""), (3, "the cat sat on the mat"), (3, "the cat sat on the mat"), (4, "x " * 30000, None, "s"), (None, "the cat sat")]
    docs = documents(spark, rows, n_chars=5, row=1, score="s", kept=True, found=2, clean="c")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        empty = stage(spark, docs.limit(0), sf)
        assert empty.columns == docs.columns and empty.count() == 0
        out.collect()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == len(rows)


def test_missing_language_is_filled_in(spark, sf):
    docs = documents(spark, [(i, "the cat and the dog", "en", "s") for i in range(30)] + [(99, "the dog and the cat", None, "s"), (100, "1 2 3", "en", "s")])
    out = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, docs, sf).collect()}
    assert out[99] == "en" and 100 not in out


def test_near_dedup_at_its_own_threshold(spark, sf):
    """Near copies from 0.80 to 0.85 go too, and one row stays of repeats and of copies without an id."""
    rng, rows = random.Random(3), []
    for d in range(40):
        words = [f"t{d}w{i}" for i in range(200)]
        rows.append((2 * d, " ".join(words)))
        for at in rng.sample(range(8, 190, 14), 3 + d % 6):
            words[at] += "x"
        rows.append((2 * d + 1, " ".join(words)))
    sets = {d: {tuple(t.split()[i:i + 5]) for i in range(196)} for d, t in rows}
    linked = {d for d in range(1, 80, 2) if 100 * len(sets[d] & sets[d - 1]) >= 80 * len(sets[d] | sets[d - 1])}
    between = {d for d in linked if 100 * len(sets[d] & sets[d - 1]) < 85 * len(sets[d] | sets[d - 1])}
    assert between and len(linked) < 40
    odd = [(0, rows[0][1]), (None, rows[0][1]), (None, "held by no other row"), (None, "held by no other row"), (0, "another text of it"), (None, ""), (None, None)]
    out = corpus_pipeline.near_dedup(spark, documents(spark, rows + odd), sf).collect()
    expected = [r for r in rows if r[0] not in linked] + odd[2:3] + odd[4:]
    assert sorted(((r.doc_id, r.text) for r in out), key=repr) == sorted(expected, key=repr)
