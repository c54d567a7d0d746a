"""Token shards, pieces and their edge cases, against the libraries and brute force."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm.support import corpus, documents, sf  # noqa: F401
from tidemark.llm import grammar, pieces
from tidemark.llm.queries import QUERIES
from tidemark.session import workspace

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a <|endoftext|> b", "A<|ENDOFTEXT|>", "naïve x\ty\x1fz İstanbul ΑΣ Σ", "e ̈x J̌ ǰ", "  q", "don't I'LL 'S", "w.) x., y,. Z. É, é.", "\x01 a\x01b", "x" * 300, "日本語 、テキスト。", "k\r\n m",
       "1,000.5 a1. 2,", "𝄞 ﬁ", '"quoted" 1 "', "a" * 30 + " " + "ab" * 40]


def expected(tokenizer, rows):
    start, out = 0, []
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_shards_of_documents(caller, sf, corpus):
    got = [tuple(r)[:4] for r in QUERIES["op1_repair_shards"](caller, sf).collect()]
    assert sorted(got) == expected(Tokenizer.from_file(WORD), sorted((d, t) for d, t, _, _ in corpus))


def test_shards_defined_cases(spark, caller, monkeypatch):
    monkeypatch.setattr(grammar, "BLOCK_IDS", 40)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (51, ""), (-3, "the the the"), (52, "long words " * 5000)]
    path = workspace(caller, "shards")
    grammar.write_shards(documents(spark, rows, start=1, part=2, tie="t"), WORD, path)
    assert sorted(map(tuple, grammar.read_shards(spark, path).collect())) == expected(Tokenizer.from_file(WORD), sorted(rows))
    again = workspace(caller, "shards")
    grammar.write_shards(documents(spark, [(None, "x"), (7, "y z"), (7, "y z"), (7, "q")]), WORD, again)
    found = sorted((tuple(r) for r in grammar.read_shards(spark, again).collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == [None, 7, 7, 7] and [r[1] for r in found[1:]] == list(np.cumsum([r[2] for r in found])[:-1])
    empty = workspace(caller, "shards")
    grammar.write_shards(documents(spark, []), WORD, empty)
    assert grammar.read_shards(spark, empty).count() == 0


@pytest.fixture
def words():
    with open(WORD, encoding="utf-8") as file:
        return grammar.WordEncoder(file.read())


@pytest.mark.parametrize("most", [0, 1 << 26])
def test_words_are_encoded_as_by_the_library(words, corpus, monkeypatch, most):
    monkeypatch.setattr(grammar, "KNOWN_BYTES", most)
    rng, tokenizer = random.Random(5), Tokenizer.from_file(WORD)
    letters = "aZéÉÿßœİ .,'!&<|>_1\n\t日\x01\u0308"
    cases = [t for _, t, _, _ in corpus[:30]] + ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(300)] + ["", None, " ", "\n"]
    assert words.direct
    for kind in (pa.string(), pa.large_string()):
        for text, ids in zip(cases, words.encode(pa.array(cases, kind)), strict=True):
            assert ids.tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], text


def test_a_run_is_encoded_once(words, monkeypatch):
    """Words that differ in case or in the signs behind them cost no call of the whole tokenizer and share their letters."""
    asked, split = [], words.split
    monkeypatch.setattr(words, "split", lambda run: asked.append(run) or split(run))
    monkeypatch.setattr(words, "known", {})
    monkeypatch.setattr(words, "_whole", lambda rest: [] if not rest else pytest.fail(f"by the whole tokenizer: {rest}"))
    texts = ["quellez quellez, Quellez&&& QUELLEZ*** quellez!? &&&", "Quellez. quellez&&&", "quellez"]
    got = [ids.tolist() for text in texts for ids in words.encode(pa.array([text]))]
    assert sorted(asked) == sorted(["quellez", ",", ".", "&&&", "***", "!?"])
    assert got == [[*Tokenizer.from_file(WORD).encode(text, add_special_tokens=False).ids, 1] for text in texts]


@pytest.mark.parametrize("seed", range(5))
def test_grammar_round_trip(seed):
    rng = np.random.default_rng(seed)
    coded = [np.append(rng.integers(0, (3, 5, 40, 400, 5)[seed], rng.integers(0, 3000)), 1).astype(np.uint32) for _ in range(12)]
    coded += [np.array([1], np.uint32), np.array([7] * 999 + [1], np.uint32), np.array([1, 1, 1], np.uint32)]
    block = grammar.Block(grammar.pack([None, *range(len(coded) - 1)], coded, 500 if seed else 70000))
    assert block.doc_ids[0] is None and len(block.rules) and len(block.symbols) < sum(map(len, coded))
    for k, ids in enumerate(coded):
        assert (block.document(k) == ids).all()
        for start, count in ((0, 1), (len(ids) // 2, 50), (len(ids) - 1, 9)):
            assert (block.ids(k, start, count) == ids[start:start + count]).all()
    for k, (a, b) in enumerate(block.rules.tolist()):
        assert len(block.expand(np.array([block.base + k]))) == block.lengths[k] and 1 not in (a, b)


def naive(model, text):
    """Viterbi by characters, over the whole text, with dictionaries."""
    size = model.get_piece_size()
    scores = {model.id_to_piece(i): (model.get_score(i), i) for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    data = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
    low = min(s for s, _ in scores.values()) - 10
    chars = "▁" + text.replace(" ", "▁") if text else ""
    best = [(0.0, None, None)] + [(-1e300, None, None)] * len(chars)
    for i in range(len(chars)):
        for j in range(i + 1, min(len(chars), i + 48) + 1):
            score, piece = scores.get(chars[i:j], (low, -1) if j == i + 1 else (None, None))
            if piece is not None and best[i][0] + score > best[j][0]:
                best[j] = (best[i][0] + score, i, piece)
    ids, at = [], len(chars)
    while at:
        _, start, piece = best[at]
        ids[:0] = [piece] if piece >= 0 else [data[b] for b in chars[start:at].encode()]
        at = start
    return ids


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE)


def test_pieces_against_naive_viterbi(model, corpus):
    coder, rng = pieces.Pieces(PIECE), random.Random(1)
    letters = "aäeinst ▁\nß日x𝄞  "
    cases = [t[:400] for _, t, _, _ in corpus[:40]] + [o for o in ODD] + ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(80)] + ["", "ab" * 300, "é" * 90]
    for text, ids in zip(cases, coder.encode(cases), strict=True):
        assert ids.tolist() == naive(model, text), text
        assert coder.decode(ids) == text.replace("▁", " ")
        assert coder.segment(("▁" + text.replace(" ", "▁")).encode() if text else b"") == naive(model, text)


def test_known_parts_are_bounded(model, monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN", 5)
    coder = pieces.Pieces(PIECE)
    for _ in range(2):
        for text in ("one two three four", "five six seven eight", "one six"):
            assert coder.encode([text])[0].tolist() == naive(model, text)


def test_pieces_of_documents(caller, spark, sf, model, corpus):
    got = {r.doc_id: r for r in QUERIES["op6_unigram_viterbi"](caller, sf).collect()}
    assert len(got) == len(corpus) and all(r.round_trip and r.n_ids == len(r.ids) for r in got.values())
    for doc_id, text, _, _ in corpus[:8]:
        assert got[doc_id].ids == naive(model, text)
    rows = [(1, None), (2, ""), (3, "▁"), (3, "a"), (None, "\U0010ffff"), (4, "x" * 20000 + " " + "y z " * 5000)]
    out = sorted(((r.doc_id, r.n_ids, r.n_byte_ids, r.round_trip) for r in pieces.encode_documents(documents(spark, rows, ids=1, n_ids=2), PIECE).collect()), key=repr)
    assert [r[1:] for r in out if r[0] in (1, 2)] == [(0, 0, True)] * 2 and (None, 5, 4, True) in out
    assert sorted(r[3] for r in out) == [False] + [True] * 5
    assert pieces.encode_documents(documents(spark, []), PIECE).count() == 0


def counted(symbols):
    """How often each pair can be replaced, the end id left out."""
    places, last = {}, {}
    for i, pair in enumerate(itertools.pairwise(symbols)):
        if grammar.END not in pair and last.get(pair) != i - 1:
            places[pair] = places.get(pair, 0) + 1
            last[pair] = i
    return places


def naive_repair(symbols, base):
    """One pair at a time, the most frequent one, until none stands often enough."""
    symbols, rules = list(symbols), 0
    while (places := counted(symbols)) and max(places.values()) >= grammar.LEAST:
        pair, out, i = max(places, key=places.get), [], 0
        while i < len(symbols):
            hit = tuple(symbols[i:i + 2]) == pair
            out.append(base + rules if hit else symbols[i])
            i += 2 if hit else 1
        symbols, rules = out, rules + 1
    return symbols, rules


@pytest.mark.parametrize("seed,per_round", [(1, 4096), (2, 4096), (3, 5), (4, 1)])
def test_repair_goes_on_until_no_pair_is_frequent(monkeypatch, seed, per_round):
    monkeypatch.setattr(grammar, "PER_ROUND", per_round)
    rng = np.random.default_rng(seed)
    phrases = [rng.integers(2, 40, rng.integers(2, 9)).tolist() for _ in range(12)] + [[7] * 9]
    documents_ = [[x for k in rng.integers(0, len(phrases), rng.integers(0, 40)) for x in phrases[k]] + [grammar.END] for _ in range(60)]
    ids, sizes = np.concatenate(documents_).astype(np.uint32), np.array([len(d) for d in documents_])
    symbols, rules, spans = grammar.compress(ids, sizes, 50)
    assert max(counted(symbols.tolist()).values(), default=0) < grammar.LEAST
    expand = {i: [i] for i in range(50)}
    for k, (a, b) in enumerate(rules.tolist()):
        expand[50 + k] = expand[a] + expand[b]
    assert [x for s in symbols.tolist() for x in expand[s]] == ids.tolist()
    assert [sum(len(expand[s]) for s in part) for part in np.split(symbols, np.cumsum(spans)[:-1])] == sizes.tolist()
    plain, plain_rules = naive_repair(ids.tolist(), 50)
    assert len(symbols) + 2 * len(rules) <= 1.25 * (len(plain) + 2 * plain_rules)


@pytest.mark.parametrize("bits", [4, 18])
def test_rounds_look_at_few_places(monkeypatch, bits):
    """The places that all rounds look at together are a few times the ids, however many rounds there are."""
    monkeypatch.setattr(grammar, "SLOT_BITS", bits)
    monkeypatch.setattr(grammar, "SLOTS", 1 << bits)
    rng, looked, frequent = np.random.default_rng(3), [], grammar._frequent
    monkeypatch.setattr(grammar, "_frequent", lambda keys: looked.append(len(keys)) or frequent(keys))
    phrases = [rng.integers(2, 400, rng.integers(2, 40)) for _ in range(60)]
    coded = [np.concatenate([*(part for k in rng.integers(0, 60, 30) for part in (phrases[k], rng.integers(2, 4000, 30))), [grammar.END]]) for _ in range(60)]
    ids, sizes = np.concatenate(coded).astype(np.uint32), np.array([len(c) for c in coded])
    symbols, rules, _ = grammar.compress(ids, sizes, 4000)
    assert max(counted(symbols.tolist()).values()) < grammar.LEAST and len(rules) > 100
    assert len(looked) >= 8 and (bits < 18 or sum(looked) <= 3 * len(ids))
