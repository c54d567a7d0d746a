"""Byte-level BPE by a tokenization automaton: words are encoded by table lookups, decoded by emitting arc labels.

The automaton reads tokens. It starts with one state that every byte leads back to, and each merge ``u v -> w``, in order,
adds its gadget: let ``q`` be where ``u`` leads, and let ``q`` have an arc ``v``. A copy of ``q`` without the arc ``v`` becomes the place
where ``u`` leads, and every state with an arc ``u`` gets an arc ``w`` to where ``v`` leads. What the automaton accepts after the last merge
are just the token sequences that the merges produce, one for each string of bytes.

All arcs of a token lead to one state, so the states are kept as they were made: a copy names its origin, the arc it lost
and the merge it came with. The arc ``(state, token)`` follows from what the state's line of copies has lost among
the left parts of the token; answers go into a transition table of bounded size. A word is read longest token first,
through a trie of the labels. Each place in a word can be reached in one way only, so one that led nowhere is not tried again, and
the work is linear in the word. Words met before are kept in a table of bounded size.

Texts are split by the file's pattern, around its added tokens, which are matched as they stand. A character met for the first time
is compared with the library's splitter; texts that hold one whose class differs here are split by the library.

Defined cases: a null text is an empty one, with no ids and an empty decoded text; very long texts are encoded a stretch of words at
a time; repeated rows are encoded row by row; other columns come along in ``row`` and may have any name; ids that the
file does not know fail on decoding; a file of another kind (other splitters, normalisers, tokens made by two merges) is refused.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import pre_tokenizers

from tidemark.llm.common import map_slices, texts, worker_store

PATTERN = r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed: how a byte-level file splits
KNOWN_WORDS, WORD_CHARS = 400_000, 64  # words a worker remembers, and their length
KNOWN_ARCS = 400_000
STRETCH = 100_000  # words encoded at once


def byte_signs() -> dict[str, int]:
    """The sign of each byte in a vocabulary file: itself where it prints, else the next free one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Words(dict):
    """Ids of the words met; a new word is read by the automaton."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = tuple(self.automaton.read(word.encode()))
        if len(word) <= WORD_CHARS:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = ids
        return ids


class Automaton:
    """What a byte-level BPE file defines, compiled."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model, splitter = spec["model"], spec["pre_tokenizer"] or {}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        split = (splitter.get("type"), splitter.get("add_prefix_space"), splitter.get("use_regex")) == ("ByteLevel", False, True)
        added = [t for t in spec["added_tokens"] if not (t["single_word"] or t["lstrip"] or t["rstrip"])]
        if not (model["type"] == "BPE" and plain and split and spec["normalizer"] is None and len(added) == len(spec["added_tokens"])):
            raise ValueError("not a plain byte-level BPE file")
        signs = byte_signs()
        self.labels = {i: bytes(signs[c] for c in sign) for sign, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in added}
        self.labels |= {i: content.encode() for content, i in self.added.items()}
        self._compile(model["vocab"], model["merges"])
        self._grow_trie()
        self.pattern = regex.compile(PATTERN)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.words, self.arcs = Words(self), {}
        self.alike, self.other = set(), set()  # characters whose class is the library's, or not

    def _compile(self, vocab: dict[str, int], merges: list) -> None:
        """One gadget a merge. State 0 is the start; the state that merge ``k`` adds is ``k``, counted from 1."""
        size = self.size = max(vocab.values()) + 1
        self.left = [-1] * size  # a token's left part
        self.made = [0] * size  # the merge that made it
        self.leads = [0] * size  # where its arcs lead
        self.origin = [0] * size  # where they led when it was made
        self.owner = [-1] * (len(merges) + 1)  # the token on whose arcs a state lies
        self.lost: dict[int, int] = {}  # token * size + arc -> the state in which the token's line lost the arc
        self.live = {i for i, label in self.labels.items() if len(label) == 1 and i < size}
        for k, merge in enumerate(merges, 1):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            if self.made[w] or max(self.made[u], self.made[v]) >= k:
                raise ValueError(f"merge {k} makes a token again or comes before its parts")
            self.left[w], self.made[w] = u, k
            if u not in self.live or v not in self.live or not self.has_arc(self.leads[u], v):
                continue  # other merges always take one of the parts first
            self.live.add(w)
            self.leads[w] = self.origin[w] = self.leads[v]
            self.lost[u * size + v] = self.leads[u] = k
            self.owner[k] = u

    def has_arc(self, state: int, token: int) -> bool:
        """Whether ``state`` has the arc ``token``, itself or from the states it was copied from."""
        while state:
            owner, part, later = self.owner[state], token, len(self.owner)
            while part >= 0:
                when = self.lost.get(owner * self.size + part)
                if when is not None and when <= state and self.made[part] < when <= later:
                    return False
                later, part = self.made[part], self.left[part]
            state = self.origin[owner]
        return True

    def _grow_trie(self) -> None:
        self.next, self.ends, nodes = {}, {}, 1  # node * 256 + byte -> node; node -> token
        self.longest = max(len(self.labels[token]) for token in self.live)
        for token in sorted(self.live):
            node = 0
            for byte in self.labels[token]:
                at = self.next.get(node << 8 | byte)
                if at is None:
                    at = self.next[node << 8 | byte] = nodes
                    nodes += 1
                node = at
            self.ends[node] = token

    def _ahead(self, word: bytes, at: int) -> list[int]:
        """Tokens that the word goes on with, the longest last."""
        found, node, following, ends = [], 0, self.next, self.ends
        for byte in word[at:at + self.longest]:
            node = following.get(node << 8 | byte)
            if node is None:
                break
            token = ends.get(node)
            if token is not None:
                found.append(token)
        return found

    def read(self, word: bytes) -> list[int]:
        """The tokens of a word: the one path through the automaton whose labels spell it."""
        path, open_, nowhere, at, state, n = [], [], set(), 0, 0, len(word)
        ahead = self._ahead(word, 0) if n else []
        while at < n:
            while ahead:
                token = ahead.pop()
                end = at + len(self.labels[token])
                if end in nowhere or not self._arc(state, token):
                    continue
                open_.append((at, state, ahead))
                path.append(token)
                at, state = end, self.leads[token]
                ahead = self._ahead(word, at) if at < n else []
                break
            else:
                nowhere.add(at)
                if not open_:
                    raise ValueError("the file has no token for a byte")
                at, state, ahead = open_.pop()
                path.pop()
        return path

    def _arc(self, state: int, token: int) -> bool:
        key = state * self.size + token
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= KNOWN_ARCS:
                self.arcs.clear()
            known = self.arcs[key] = self.has_arc(state, token)
        return known

    def _differs(self, text: str) -> bool:
        chars = set(text)
        for c in chars - self.alike - self.other:
            probe = f"a{c}1{c}!{c} "
            theirs = [probe[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(probe)]
            (self.alike if theirs == self.pattern.findall(probe) else self.other).add(c)
        return not self.other.isdisjoint(chars)

    def split(self, text: str) -> Iterator[str]:
        """The words of a text without added tokens."""
        if self._differs(text):
            return (text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text))
        if len(text) < 4 * STRETCH:
            return iter(self.pattern.findall(text))
        return (match.group() for match in self.pattern.finditer(text))

    def encode(self, text: str) -> np.ndarray:
        out = []
        for k, part in enumerate(self.marks.split(text) if self.marks else [text]):
            if k % 2:
                out.append(np.array([self.added[part]], np.int32))
                continue
            words = self.split(part)
            while stretch := list(islice(words, STRETCH)):
                out.append(np.fromiter(chain.from_iterable(map(self.words.__getitem__, stretch)), np.int32))
        return np.concatenate(out) if out else np.zeros(0, np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", errors="replace")


def automaton(definition: str) -> Automaton:
    """The compiled file, once per worker."""
    store, key = worker_store(), f"automaton of {zlib.crc32(definition.encode())}"
    if key not in store:
        store[key] = Automaton(definition)
    return store[key]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Each document in ``row`` with ``ids`` of its ``text`` and the text that they decode to, ``decoded``."""
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), "text")

    def of(piece: pa.RecordBatch) -> list:
        model = automaton(definition)
        coded = [model.encode(t or "") for t in texts(piece)]
        flat = np.concatenate([np.zeros(0, np.int32), *coded])
        ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, coded)]).astype(np.int32)), pa.array(flat, pa.int32()))
        return [piece.column("row"), ids, pa.array([model.decode(i.tolist()) for i in coded], pa.string())]

    return map_slices(rows, f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>, decoded string", of)
