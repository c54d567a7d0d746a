"""The tokenization automaton next to the library, and its table on a small file."""

import hashlib
import itertools
import json
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from llm.support import documents, sf  # noqa: F401
from tokenizers import Tokenizer

from tidemark.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n\n  x", "naïve café — 日本語 \U0001f642‍", "it's we'll I'D 's", "<|endoftext|>", "a<|endoftext|><|endoftext|> b <|endof", "x" * 5000,
       " " * 5000 + "y", "ab" * 3000, "١٢٣ ½²ⅷ", "\x00\x1c\x85᠎ ", "՘\U00010940\U0001e5d0₏", "-" * 300, "tab\tand\r\nline"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def model():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Automaton(file.read())


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_query(caller, library, sf):
    rows = caller.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op11_merge_automaton"](caller, sf).collect()}
    assert got == {r.doc_id: expected(library, r.text) for r in rows}


def test_odd_documents(caller, library):
    docs = documents(caller, [(None if i == 3 else i, t) for i, t in enumerate(ODD + ODD[:3])], ids=7, decoded="own", row="own")
    rows = bpe.encode_documents(docs, PATH).select("row.doc_id", "ids", "decoded", F.col("row.ids").alias("own")).collect()
    got = sorted((r.ids, r.decoded, r.own) for r in rows)
    assert got == sorted((library.encode(t or "", add_special_tokens=False).ids, t or "", 7) for t in ODD + ODD[:3])
    assert bpe.encode_documents(documents(caller, []), PATH).collect() == []


def test_random_texts(model, library):
    rng = random.Random(11)
    parts = ["a", "th", "e", " ", "  ", "\n", "é", "ß", "日", "\U0001f642", "'s", "'", "12", "ing", "<|endoftext|>", "--", "՘", "̀", "\x00", "‍"]
    for n in range(4000):
        text = "".join(rng.choice(parts if n % 2 else "abcdeinorst ") for _ in range(rng.randint(0, 30)))
        ids = model.encode(text).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert model.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_tables_of_bounded_size(library, model, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 5)
    monkeypatch.setattr(bpe, "KNOWN_ARCS", 5)
    monkeypatch.setattr(bpe, "STRETCH", 3)
    text = "one two three four five six seven eight one two three four"
    assert model.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def plain_merges(word, merges):
    """Every merge in turn, from the left."""
    parts = list(word)
    for u, v in merges:
        at = 0
        while at + 1 < len(parts):
            if (parts[at], parts[at + 1]) == (u, v):
                parts[at:at + 2] = [u + v]
            at += 1
    return parts


def definition(merges):
    vocab = {c: i for i, c in enumerate(bpe.byte_signs())}
    for u, v in merges:
        vocab[u + v] = len(vocab)
    return json.dumps({"added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True},
                       "model": {"type": "BPE", "vocab": vocab, "merges": merges}})


def test_automaton_of_small_files():
    rng = random.Random(3)
    words = ["".join(w) for n in range(1, 7) for w in itertools.product("abc", repeat=n)]
    for _ in range(12):
        tokens, merges = ["a", "b", "c"], []
        while len(merges) < 8:
            u, v = rng.choice(tokens), rng.choice(tokens)
            if u + v not in tokens and len(u + v) <= 6:
                merges.append([u, v])
                tokens.append(u + v)
        model = bpe.Automaton(definition(merges))
        for word in words:
            assert [model.labels[i].decode() for i in model.read(word.encode())] == plain_merges(word, merges)


def test_every_accepted_path_is_a_tokenization():
    merges = [["a", "b"], ["a", "a"], ["ab", "c"], ["aa", "ab"], ["b", "c"]]
    model = bpe.Automaton(definition(merges))
    tokens = [i for i in model.live if set(model.labels[i]) <= set(b"abc")]
    for n in range(1, 5):
        for path in itertools.product(tokens, repeat=n):
            state, accepted = 0, True
            for token in path:
                accepted &= model.has_arc(state, token)
                state = model.leads[token]
            word = b"".join(model.labels[t] for t in path)
            assert accepted == (list(path) == model.read(word))


def test_other_files_are_refused():
    spec = json.loads(definition([["a", "b"]]))
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": None}, {"model": {**spec["model"], "byte_fallback": True}},
                   {"model": {**spec["model"], "merges": [["a", "b"], ["a", "b"]]}}):
        with pytest.raises(ValueError):
            bpe.Automaton(json.dumps(spec | change))
