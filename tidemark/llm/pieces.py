"""SentencePiece encoding by unigram Viterbi over a double-array trie, with byte fallback, and decoding.

The pieces and their scores come from a model file; the scores count as log probabilities, whatever kind of model they
were made for. Blanks become the marker ``▁``, one marker goes in front, and nothing else is normalised. The best
segmentation has the largest sum of scores; a character that is no piece costs the smallest score less 10 and is
written as the pieces of its bytes; of equal sums the one found from the earlier start wins.

A text is cut before each marker that follows another character, and around line ends. No piece spans such a place (checked
when the model is read), so the parts' segmentations make up the text's. Parts of a slice that are not yet known are segmented
together in NumPy; results stay in a table of bounded size.

Defined cases: a null text is an empty one, which has no ids; decoding turns markers back into blanks, so a text that holds ``▁``
itself does not come back the same (``round_trip`` is false); ids outside the model fail; rows that repeat are encoded row by row.
"""

from __future__ import annotations

import re
from collections import deque

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame

from tidemark.llm.common import map_slices, texts

MARK = "▁"
PART = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
KNOWN = 150_000  # parts a worker remembers
LONG = 96  # bytes from which a part is segmented by itself


class Trie:
    """A double-array trie: the child of state ``s`` by byte ``b`` is ``base[s] + b + 1`` if ``check`` there is ``s``."""

    def __init__(self, words: dict[bytes, int]):
        tree: list[dict[int, int]] = [{}]
        value = [-1]
        for word, number in words.items():
            node = 0
            for byte in word:
                child = tree[node].get(byte)
                if child is None:
                    child = tree[node][byte] = len(tree)
                    tree.append({})
                    value.append(-1)
                node = child
            value[node] = number
        size = 2 * len(tree) + 1024
        base, check, leaf = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        taken = bytearray(size)
        taken[0] = 1
        first, wide, queue = 257, 0, deque([(0, 0)])  # single children fill the holes from ``first`` on, others go on from ``wide``
        while queue:
            node, state = queue.popleft()
            leaf[state] = value[node]
            children = sorted(tree[node])
            if not children:
                continue
            while taken[first]:
                first += 1
            start = max(wide, first - children[0] - 1) if len(children) > 1 else max(0, first - children[0] - 1)
            while any(taken[start + b + 1] for b in children):
                start += 1
                if start + 300 > size:
                    grown = size // 2
                    base, check, leaf = (np.append(x, np.full(grown, fill, np.int32)) for x, fill in ((base, 0), (check, -1), (leaf, -1)))
                    taken.extend(bytes(grown))
                    size += grown
            wide = start if len(children) > 1 else wide
            base[state] = start
            for b in children:
                slot = start + b + 1
                taken[slot], check[slot] = 1, state
                queue.append((tree[node][b], slot))
        pad = np.full(257, -1, np.int32)  # any byte can be looked up from any state
        self.base, self.check, self.leaf = np.append(base, pad * 0), np.append(check, pad), np.append(leaf, pad)


class Pieces:
    """A model's pieces, ready to encode and decode; it is sent to the workers as arrays."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        spans = [names[i] for i in plain if re.search(f"[^{MARK}]{MARK}|\n", names[i])]
        if spans:
            raise ValueError(f"pieces that go over a marker or a line: {spans[:3]}")
        self.scores = np.array([model.get_score(i) for i in range(size)], np.float64)
        self.trie = Trie({names[i].encode(): i for i in plain})
        self.bytes = {int(names[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.unknown = model.unk_id()
        self.unknown_score = float(self.scores[plain].min()) - 10
        made = {i: bytes([b]) for b, i in self.bytes.items()}
        self.made = [made[i] if i in made else names[i].encode() if self.is_text(model, i) else b"" for i in range(size)]
        self.is_byte = np.isin(np.arange(size), list(self.bytes.values()))
        self.known: dict[str, bytes] = {}

    @staticmethod
    def is_text(model, i: int) -> bool:
        return not (model.is_control(i) or model.is_unknown(i))

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def encode(self, many: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        parts = [PART.findall(MARK + text.replace(" ", MARK)) if text else [] for text in many]
        new = {p for own in parts for p in own if p not in self.known}
        if len(self.known) + len(new) > KNOWN:
            self.known.clear()
            new = {p for own in parts for p in own}
        self._learn(sorted(new, key=len))
        found = self.known.__getitem__
        return [np.frombuffer(b"".join(map(found, own)), np.int32) for own in parts]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.made.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text[:1] == " " else text

    def _fallback(self, data: bytes) -> list[int]:
        return [self.bytes[b] for b in data] if len(self.bytes) == 256 else [self.unknown]

    def _learn(self, parts: list[str]) -> None:
        coded = [p.encode() for p in parts]
        short = [i for i, data in enumerate(coded) if len(data) < LONG]
        for at in range(0, len(short), 8192):
            group = short[at:at + 8192]
            flat, ends = self._segment_many([coded[i] for i in group])
            raw, start = flat.tobytes(), 0
            for i, end in zip(group, (4 * ends).tolist(), strict=True):
                self.known[parts[i]] = raw[start:end]
                start = end
        for i, data in enumerate(coded):
            if len(data) >= LONG:
                self.known[parts[i]] = np.array(self.segment(data), np.int32).tobytes()

    def segment(self, data: bytes) -> list[int]:
        """Viterbi over one part."""
        base, check, leaf, scores = self.trie.base, self.trie.check, self.trie.leaf, self.scores
        n = len(data)
        best, back = [0.0] + [-np.inf] * n, [(0, -1)] * (n + 1)
        for i in range(n):
            if data[i] & 0xC0 == 0x80:
                continue
            width = 1
            while i + width < n and data[i + width] & 0xC0 == 0x80:
                width += 1
            state, alone = 0, False
            for j in range(i, n):
                following = base[state] + data[j] + 1
                if check[following] != state:
                    break
                state = following
                piece = leaf[state]
                if piece >= 0:
                    alone |= j + 1 == i + width
                    if best[i] + scores[piece] > best[j + 1]:
                        best[j + 1], back[j + 1] = best[i] + scores[piece], (i, int(piece))
            if not alone and best[i] + self.unknown_score > best[i + width]:
                best[i + width], back[i + width] = best[i] + self.unknown_score, (i, -1)
        ids, end = [], n
        while end:
            start, piece = back[end]
            ids += [piece] if piece >= 0 else self._fallback(data[start:end])[::-1]
            end = start
        return ids[::-1]

    def _segment_many(self, many: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi over short parts at once, position by position: all ids, and where each part's end."""
        base, check, leaf, scores = self.trie.base, self.trie.check, self.trie.leaf, self.scores
        lengths = np.array([len(d) for d in many])
        n, longest = len(many), int(lengths.max(initial=0))
        grid = np.frombuffer(b"".join([d.ljust(longest, b"\0") for d in many]), np.uint8).reshape(n, longest).T.astype(np.int32)
        starts = (grid & 0xC0) != 0x80
        best = np.full((longest + 1, n), -np.inf)
        best[0] = 0
        back, piece_at = np.zeros((longest + 1, n), np.int32), np.full((longest + 1, n), -1, np.int32)
        for i in range(longest):
            rows = np.nonzero((lengths > i) & starts[i])[0]
            if not len(rows):
                continue
            width = np.ones(len(rows), np.int64)
            for step in range(1, min(4, longest - i)):
                width += (width == step) & (i + step < lengths[rows]) & ~starts[i + step][rows]
            first_end = np.zeros(n, np.int64)
            first_end[rows] = i + width
            alone, sums_here = np.zeros(n, bool), best[i]
            going, state = rows, np.zeros(len(rows), np.int32)
            for j in range(i, longest):
                following = base[state] + grid[j][going] + 1
                on = check[following] == state
                if j > i:
                    on &= lengths[going] > j
                going, state = going[on], following[on]
                if not len(going):
                    break
                piece = leaf[state]
                has = piece >= 0
                ended, piece = going[has], piece[has]
                alone[ended] |= first_end[ended] == j + 1
                sums = sums_here[ended] + scores[piece]
                better = sums > best[j + 1][ended]
                ended = ended[better]
                best[j + 1][ended], back[j + 1][ended], piece_at[j + 1][ended] = sums[better], i, piece[better]
            lone = rows[~alone[rows]]
            ends = first_end[lone]
            sums = sums_here[lone] + self.unknown_score
            better = sums > best[ends, lone]
            lone, ends = lone[better], ends[better]
            best[ends, lone], back[ends, lone], piece_at[ends, lone] = sums[better], i, -1
        steps, rows, at = [], np.arange(n), lengths.copy()
        while len(rows):
            steps.append((rows, piece_at[at, rows]))
            at = back[at, rows]
            rows, at = rows[at > 0], at[at > 0]
        counts = np.bincount(np.concatenate([r for r, _ in steps]), minlength=n)
        ends = np.cumsum(counts)
        flat = np.empty(ends[-1], np.int32)
        for k, (rows, ids) in enumerate(steps):
            flat[ends[rows] - 1 - k] = ids
        rest, done = [], 0
        for row in np.unique(np.searchsorted(ends, np.nonzero(flat < 0)[0], side="right")):  # parts with characters that are no pieces
            ids = np.array(self.segment(many[row]), np.int32)
            rest += [flat[done:ends[row] - counts[row]], ids]
            done, counts[row] = ends[row], len(ids)
        return np.concatenate([*rest, flat[done:]]), np.cumsum(counts)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Per document: ``doc_id, ids, n_ids, n_byte_ids, round_trip`` (whether decoding the ids gives the text)."""
    pieces, kind = Pieces(path), docs.schema["doc_id"].dataType.simpleString()

    def of(piece):
        import pyarrow as pa
        many = texts(piece)
        coded = pieces.encode(many)
        sizes = [len(ids) for ids in coded]
        flat = np.concatenate(coded) if coded else np.zeros(0, np.int32)
        ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]).astype(np.int32)), pa.array(flat, pa.int32()))
        return [piece.column("doc_id"), ids, pa.array(sizes, pa.int64()), pa.array([int(pieces.is_byte[i].sum()) for i in coded], pa.int64()),
                [pieces.decode(i) == (t or "") for i, t in zip(coded, many, strict=True)]]

    return map_slices(docs.select("doc_id", "text"), f"doc_id {kind}, ids array<int>, n_ids long, n_byte_ids long, round_trip boolean", of)
