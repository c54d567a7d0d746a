"""Token ids in grammar-compressed shards (Re-Pair) that are read back by document or by position.

Documents are dealt by ranges of ``doc_id`` and cut into blocks of about ``BLOCK_IDS`` ids. In each block frequent pairs
of neighbouring symbols are replaced by nonterminals, round after round, until none stands ``LEAST`` times; a round takes its most frequent pairs at once and,
where two overlap, the more frequent one. The end id is never in a pair, so a document is a run of symbols of its own.
A block stores the rules, the length each expands to, and for each document its id, its symbols' end and its number of ids;
with these one document, or a range of its ids, is decoded without the rest.

A block is one row's ``payload``, little-endian: ``RPG1``, then uint32 base, rules, symbols, documents; the rules as uint32
pairs; their lengths as uint32; per document int64 id, uint8 null flag, uint64 symbols' end, uint64 ids; the symbols
as uint16 (they are kept below 2^16 where the vocabulary allows, else uint32). The rows are written by Spark's
committer, so a lost executor leaves no half-written block.

Defined cases: a null text is an empty one, and an empty text has only the end id; a null ``doc_id`` comes first; rows
that repeat a ``doc_id`` follow each other in the order of a hash of their text, then of the text; other columns are ignored;
special tokens that stand in a text get their ids, as the tokenizer's default is.
"""

from __future__ import annotations

import os
import struct
import zlib
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import slices, worker_store

END = 1
BLOCK_IDS = 1 << 20
LEAST = 8  # a pair in a block this often is worth a rule, which takes 12 bytes and saves 2 at each place
PER_ROUND = 4096
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
ENCODE_BYTES = 16 << 20  # texts whose different words are looked for at once
KNOWN_BYTES = 64 << 20  # of runs that a worker remembers
ENTRY_BYTES = 100  # that a run takes besides its letters

RUNS = r"\A(?P<stem>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<signs>[!-/:-@\[-`{-~]*)\z"  # Latin letters, and ASCII signs behind them
# How byte-level models write a byte: itself where it is a printable sign, else the next sign from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SIGNS = [chr(b) if b in _PRINTED else chr(256 + sum(c not in _PRINTED for c in range(b))) for b in range(256)]
SIGN_OF = dict(enumerate(BYTE_SIGNS))
MARK = "\x01"  # a word of its own, whose id no other word has
PROBES = [("the", ""), ("Straße", "."), ("ÉTÉ", ","), ("ñandú", "&&&"), ("zzyzx", "."), ("internationalisation", "!?"), ("", "..."), ("don", "'"), ("a", "<|")]

HEAD = "<4s4I"


def _in_signs(word: str) -> str:
    return word.encode().decode("latin-1").translate(SIGN_OF)


class WordEncoder:
    """Ids of whole texts, by the words between blanks and line ends.

    For the given tokenizer no token, and nothing that decides on tokens, goes over white space, and white space has none itself;
    so the ids of a text are those of its words. Arrow cuts a slice of texts into words and finds the different ones, the library
    encodes those, and Arrow puts their ids together again.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        self.known: dict[str, bytes] = {}
        self.held = 0
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        if len(mark) != 1:
            raise ValueError("the tokenizer has no single id for the mark between words")
        self.mark = mark[0]
        self.split = self.tokenizer.model.tokenize
        self.raw = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.direct = all(b"".join(self._runs([run.lower() for run in runs])) == self._lone("".join(runs)) for runs in PROBES)

    def _runs(self, runs: list[str]) -> list[bytes]:
        """The ids of runs of letters or of signs, which go to the tokenizer's model right away. They are remembered."""
        known, raw, split, join = self.known, self.raw, self.split, b"".join
        coded = list(map(known.get, runs))
        for k in [k for k, ids in enumerate(coded) if ids is None]:
            run = runs[k]
            known[run] = coded[k] = join([raw[token.id] for token in split(run if run.isascii() else _in_signs(run))]) if run else b""
            self.held += len(run) + ENTRY_BYTES
        if self.held > KNOWN_BYTES:
            self.known, self.held = dict(zip(runs, coded, strict=True)), sum(map(len, runs)) + ENTRY_BYTES * len(runs)
        return coded

    def _lone(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _whole(self, words: list[str]) -> list[bytes]:
        """The ids of words by the whole tokenizer: many in one call, with a mark of their own between them."""
        coded, plain = {}, [w for w in words if MARK not in w]
        for at in range(0, len(plain), 2000):
            group = plain[at:at + 2000]
            found = self.tokenizer.encode_batch_fast([f" {MARK} ".join([*group, ""])], add_special_tokens=False)
            ids = np.array(found[0].ids, "<u4")
            raw, start = ids.tobytes(), 0
            for word, end in zip(group, (4 * np.nonzero(ids == self.mark)[0]).tolist(), strict=True):
                coded[word] = raw[start:end]
                start = end + 4
        return [coded[w] if w in coded else self._lone(w) for w in words]

    def _words(self, words: pa.Array) -> pa.Array:
        """The ids of different words.

        The tokenizer folds case, and cuts between letters and signs. So Latin letters with ASCII signs behind them are two runs
        for the model; any other word goes through the whole tokenizer.
        """
        cut = pc.extract_regex(words, RUNS)
        plain = cut.is_valid().to_numpy(zero_copy_only=False) if self.direct else np.zeros(len(words), bool)
        others = self._whole(words.filter(pa.array(~plain)).to_numpy(zero_copy_only=False).tolist())
        stems, signs = cut.filter(pa.array(plain)).flatten()
        runs = pa.concat_arrays([pc.utf8_lower(stems), signs]).dictionary_encode()
        coded = pa.array(self._runs(runs.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(runs.indices)
        joined = pc.binary_join_element_wise(coded.slice(0, len(stems)), coded.slice(len(stems)), pa.scalar(b"", pa.large_binary()))
        order = np.empty(len(words), np.int64)
        order[plain], order[~plain] = np.arange(len(stems)), np.arange(len(stems), len(words))
        return pa.concat_arrays([joined, pa.array(others, pa.large_binary())]).take(pa.array(order))

    def encode(self, many: pa.Array) -> list[np.ndarray]:
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(many, ""), "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        end = pa.array([np.array([END], "<u4").tobytes()], pa.large_binary())
        table = pa.concat_arrays([self._words(words.dictionary), end])
        ends = np.cumsum(pc.list_value_length(split).to_numpy())
        coded = table.take(pa.array(np.insert(words.indices.to_numpy(), ends, len(table) - 1)))  # a document's end is a word
        _, offsets, ids = coded.buffers()
        stops = np.frombuffer(offsets, np.int64)[ends + np.arange(1, len(ends) + 1)] // 4
        return np.split(np.frombuffer(ids, "<u4", stops[-1]), stops[:-1])


def _frequent(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that stand ``LEAST`` times or more, most frequent first; which ``keys`` have a rank among them, and their ranks.

    Of two pairs in one hash slot the more frequent one has the rank. The other's places come with it, as places of a pair past the last.
    """
    slots, full = _slots(keys), slice(None)
    if len(keys) > SLOTS:  # only what is in slots that are full enough needs to be sorted
        full = np.nonzero((np.bincount(slots, minlength=SLOTS) >= LEAST)[slots])[0]
        keys, slots = keys[full], slots[full]
    ordered = np.sort(keys)
    starts = np.nonzero(np.concatenate([np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1]]))[0]
    counts = np.diff(np.append(starts, len(ordered)))
    often = np.nonzero(counts >= LEAST)[0]
    often = often[np.argsort(-counts[often], kind="stable")]
    pairs = ordered[starts[often]]
    holder = np.full(SLOTS, -1, np.int32)
    holder[_slots(pairs)[::-1]] = np.arange(len(pairs) - 1, -1, -1)
    rank = holder[slots]
    held = np.nonzero(rank >= 0)[0]
    rank, keys = rank[held], keys[held]
    rank[pairs[rank] != keys] = len(pairs)
    return pairs, held if isinstance(full, slice) else full[held], rank


def _slots(keys: np.ndarray) -> np.ndarray:
    slots = keys * np.uint64(0x9E3779B97F4A7C15)
    slots >>= np.uint64(64 - SLOT_BITS)
    return slots.view(np.int64)


def compress(ids: np.ndarray, sizes: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, rules (pairs; rule ``k`` is symbol ``base + k``) and each document's number of symbols.

    Symbols keep their places until the end, and ``after`` and ``before`` lead to the next ones that are left. The first round looks at all places, the
    others at those of frequent pairs and those next to what has just been replaced. Only a rule that is used again can add to a pair that is no longer
    looked at: when no frequent pair is left, all places of such rules are looked at once more.
    """
    symbols = np.append(ids, END).astype(np.uint32)  # the last one is for places before the first and after the last
    last = len(symbols) - 1
    after, before = np.arange(1, last + 2), np.arange(-1, last)
    after[last] = before[0] = last
    stops = np.nonzero(symbols == END)[0]
    gone, look = np.zeros(last + 1, bool), np.ones(last + 1, bool)
    number: dict[int, int] = {}
    again: set[int] = set()
    while True:
        look[stops] = look[before[stops]] = False
        places = np.nonzero(look)[0]
        keys = symbols[places].astype(np.uint64)
        keys <<= np.uint64(32)
        keys |= symbols[after[places]]
        pairs, held, rank = _frequent(keys)
        look[places] = False
        look[places[held]] = True
        chosen = np.nonzero(rank < min(PER_ROUND, len(pairs)))[0]
        where, dead, rank, pairs = _taken(places[held[chosen]], after, rank[chosen], pairs[:PER_ROUND])
        if len(where):
            used, rules = np.nonzero(np.bincount(rank, minlength=len(pairs)))[0], base + len(number)
            codes = [number.setdefault(pair, base + len(number)) for pair in pairs[used].tolist()]
            again.update([code for code in codes if code < rules])
            code = np.zeros(len(pairs), np.uint32)
            code[used] = codes
            symbols[where] = code[rank]
            following = after[dead]
            after[where], before[following] = following, where
            gone[dead] = True
            look[where] = look[before[where]] = True
            look[dead] = False
        elif again:
            marked = np.zeros(base + len(number), bool)
            marked[list(again)] = True
            again.clear()
            met = np.nonzero(marked[symbols] & ~gone)[0]
            look[met] = look[before[met]] = True
        else:
            break
    kept = np.nonzero(~gone[:-1])[0]
    pairs = np.array(list(number), np.uint64)
    pairs = np.column_stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)]).astype("<u4").reshape(-1, 2)
    return symbols[kept], pairs, np.diff(np.concatenate([[0], np.searchsorted(kept, np.cumsum(sizes) - 1) + 1]))


def _taken(places: np.ndarray, after: np.ndarray, rank: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The places that a round replaces, those of their second symbols, the ranks of their pairs, and the pairs."""
    dead = after[places]
    close = np.nonzero(dead[:-1] == places[1:])[0]
    left, right = np.full((2, len(places)), len(pairs), np.int32)
    left[close + 1], right[close] = rank[close], rank[close + 1]
    take = (rank < left) & (rank < right)  # more frequent than the pairs that overlap it
    runs = np.nonzero((pairs >> np.uint64(32) == pairs & np.uint64(0xFFFFFFFF))[rank])[0]  # aaa overlaps itself: every second one of a run
    if len(runs):
        begun = np.concatenate([[True], dead[runs[:-1]] != places[runs[1:]]])
        ended = np.append(begun[1:], True)
        first = np.maximum.accumulate(np.where(begun, np.arange(len(runs)), 0))
        even = (np.arange(len(runs)) - first) % 2 == 0
        take[runs] = even & (~begun | (rank[runs] < left[runs])) & (~ended | (rank[runs] < right[runs]))
    # A pair that overlaps itself may be counted often and yet have a single place; a rule is for two.
    take &= (np.bincount(rank[take], minlength=len(pairs)) > 1)[rank]
    return places[take], dead[take], rank[take], pairs


def pack(doc_ids: list[int | None], coded: list[np.ndarray], base: int) -> bytes:
    sizes = np.array([len(c) for c in coded])
    symbols, rules, spans = compress(np.concatenate(coded), sizes, base)
    lengths = [1] * base
    for a, b in rules.tolist():
        lengths.append(lengths[a] + lengths[b])
    kind = "<u2" if base + len(rules) <= 1 << 16 else "<u4"
    return b"".join([
        struct.pack(HEAD, b"RPG1", base, len(rules), len(symbols), len(coded)), rules.tobytes(), np.array(lengths[base:], "<u4").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.cumsum(spans).astype("<u8").tobytes(), sizes.astype("<u8").tobytes(), symbols.astype(kind).tobytes()])


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of each stretch, one stretch after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Block:
    """A block read back."""

    def __init__(self, payload: bytes):
        magic, self.base, n_rules, n_symbols, n_docs = struct.unpack_from(HEAD, payload)
        if magic != b"RPG1":
            raise ValueError("not a block of this format")
        at = struct.calcsize(HEAD)

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(payload, kind, count, at)
            at += part.nbytes
            return part

        self.rules = take("<u4", 2 * n_rules).reshape(-1, 2)
        self.lengths = take("<u4", n_rules)
        ids, nulls = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if null else int(d) for d, null in zip(ids, nulls, strict=True)]
        self.ends, self.sizes = take("<u8", n_docs).astype(np.int64), take("<u8", n_docs).astype(np.int64)
        self.symbols = take("<u2" if self.base + n_rules <= 1 << 16 else "<u4", n_symbols)

    @cached_property
    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What each symbol expands to, one after the other: all ids, each symbol's start and length."""
        lengths = np.concatenate([np.ones(self.base, np.int64), self.lengths.astype(np.int64)])
        starts = np.cumsum(lengths) - lengths
        ids = np.zeros(starts[-1] + lengths[-1], np.uint32)
        ids[:self.base] = np.arange(self.base)
        rules = self.rules.astype(np.int64)
        done = 0
        while done < len(rules):  # as many rules at once as use only symbols that are there
            fresh = np.nonzero(rules[done:].max(axis=1) >= self.base + done)[0]
            stop = done + int(fresh[0]) if len(fresh) else len(rules)
            pairs = rules[done:stop].reshape(-1)
            at = starts[self.base + done]
            part = ids[_spread(starts[pairs], lengths[pairs])]
            ids[at:at + len(part)] = part
            done = stop
        return ids, starts, lengths

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of a run of symbols."""
        ids, starts, lengths = self.flat
        return ids[_spread(starts[symbols], lengths[symbols])]

    def document(self, k: int) -> np.ndarray:
        return self.expand(self.symbols[self.ends[k - 1] if k else 0:self.ends[k]])

    def ids(self, k: int, start: int, count: int) -> np.ndarray:
        """``count`` ids of document ``k`` from ``start`` on; only the symbols that reach over them are expanded."""
        symbols = self.symbols[self.ends[k - 1] if k else 0:self.ends[k]].astype(np.int64)
        lengths = np.ones(len(symbols), np.int64)
        nested = symbols >= self.base
        lengths[nested] = self.lengths[symbols[nested] - self.base]
        ends = np.cumsum(lengths)
        first, stop = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, start + count, side="left") + 1
        skipped = start - (ends[first - 1] if first else 0)
        return self.expand(symbols[first:stop])[skipped:skipped + count]


def write_shards(docs: DataFrame, tokenizer_file: str, path: str, base: int | None = None) -> None:
    """Encode the documents into blocks below ``path``, in ascending ``doc_id`` order."""
    with open(tokenizer_file, encoding="utf-8") as file:
        definition = file.read()
    spark = docs.sparkSession
    if base is None:
        from tokenizers import Tokenizer
        base = Tokenizer.from_str(definition).get_vocab_size(with_added_tokens=True)

    def run(batches):
        store, key = worker_store(), f"words of {zlib.crc32(definition.encode())}"
        if key not in store:
            store[key] = WordEncoder(definition)
        encoder, held, doc_ids = store[key], [], []
        part, block, before, size = TaskContext.get().partitionId(), 0, 0, 0

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"part": part, "block": block, "start": before, "n_docs": len(held), "n_ids": size,
                                                "payload": pack(doc_ids, held, base)}], schema=pa.schema([
                ("part", pa.int32()), ("block", pa.int64()), ("start", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())]))

        for batch in batches:
            for piece in slices(batch, ENCODE_BYTES):
                for doc_id, ids in zip(piece.column("doc_id").to_pylist(), encoder.encode(piece.column("text")), strict=True):
                    held.append(ids)
                    doc_ids.append(doc_id)
                    size += len(ids)
                    if size >= BLOCK_IDS:
                        yield full()
                        block, before, size, held, doc_ids = block + 1, before + size, 0, [], []
        if held:
            yield full()

    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("tie", tie)
             .repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text"))
    dealt.mapInArrow(run, "part int, block long, start long, n_docs long, n_ids long, payload binary").write.parquet(path)


def read_shards(spark, path: str) -> DataFrame:
    """Per document, from the blocks: ``doc_id, start, n_tokens, ids_crc32``."""
    blocks = spark.read.schema("part int, block long, start long, n_docs long, n_ids long, payload binary").parquet(path)
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("ids"))  # a row for each part
    before = sums.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    placed = blocks.join(F.broadcast(before), "part").select((F.col("before") + F.col("start")).alias("start"), "payload")

    def run(batches):
        for batch in batches:
            for start, payload in zip(batch.column("start").to_pylist(), batch.column("payload"), strict=True):
                block = Block(payload.as_buffer().to_pybytes())
                ids = block.expand(block.symbols).astype("<u4")
                ends = np.cumsum(block.sizes)
                crcs = [zlib.crc32(ids[e - n:e].tobytes()) for e, n in zip(ends, block.sizes, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(block.doc_ids, pa.int64()), pa.array(start + ends - block.sizes), pa.array(block.sizes),
                                                  pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
