"""Near-duplicates: an LSH forest finds candidates, full shingle sets confirm them, connected components group them.

A document's words are its runs of bytes other than ASCII white space, A-Z lower-cased; its set holds the distinct runs of
five words (with fewer words, all of them as one). Two documents are linked if ``100 * intersection >= percent * union``;
``percent`` is 85 unless the caller gives another.

Equal sets are one class, of which the smallest ``doc_id`` stands for all. Each class has ``HASHES`` minimum hashes.
``TREES`` orders of these hashes make a forest: in a tree, classes whose first hashes agree form a region. A region of more
than ``REGION`` classes or ``REGION_SHINGLES`` shingles is split by one more hash, and so on down its branch, so depth adapts to how
crowded the region is; within a region every class is compared with every other by the sketch of all its hashes, in one task of
bounded size. Pairs whose sketch may come from linked sets (four standard deviations of slack) are candidates, in the first tree that
has them together. A second pass brings the texts of the classes with candidates to their regions and confirms candidates on
the full sets, leaving out pairs that confirmed links connect already; so neither pass makes a row for each pair.
Classes that agree in all hashes, and are still too many, are compared with the smallest of them.

Splitting alone would lose pairs, so the regions that don't fit at the last depth with a miss chance of ``MOST_MISSED`` (crowds: at
depth 4 for 85, 3 for 80) are then compared whole: their classes are dealt to blocks, two blocks are a tile, and each pair that
no link connects yet is in one tile. Texts of candidates that have more than ``REGION_SHINGLES`` shingles together are confirmed in
pairs of pages of at most half of that, or of one longer text; so two texts of any length are compared. A crowd all of whose classes are connected already has no tiles; the work on another one grows with the square of its classes.

So a linked pair is together in no tree with a chance of 3e-7 (similarity 0.85) where its regions fit at depth 3, and 1e-5
at depth 4, however crowded they are; for 0.80 it is 1.0e-5, at depth 3.

Defined cases: null and blank texts have empty sets and are linked with nothing; rows with a null ``doc_id`` are linked with nothing and
kept; rows that repeat a ``doc_id`` are one document with all their texts; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import map_slices, stash, texts
from tidemark.llm.components import components

WORDS, PERCENT = 5, 85
HASHES, TREES = 256, 16
DEPTHS = (3, 4, 5, 6, 8, 10, 12, 16, 24, 32, 64, 128, 256)
REGION, REGION_SHINGLES = 1024, 8 << 20
MOST_MISSED = 2e-5  # of linked pairs, by all trees at the depth from which on crowds are compared whole

_RNG = np.random.default_rng(5)
_A = (_RNG.integers(1, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_FACTORS = _RNG.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """The set, as sorted 64-bit hashes."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    if n < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b"\x20".join(words))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    total = np.zeros(n - WORDS + 1, np.uint64)
    for k in range(WORDS):
        total += hashes[k:n - WORDS + 1 + k] * _FACTORS[k]
    total ^= total >> np.uint64(32)
    total *= np.uint64(0x9E3779B97F4A7C15)
    return np.unique(total ^ (total >> np.uint64(29)))


def signature(found: np.ndarray) -> bytes:
    """Low bytes of the minimum hashes, then their second bytes."""
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    short = (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 1024):
        least = np.minimum(least, (short[at:at + 1024, None] * _A + _B).min(axis=0))
    return least.astype(np.uint8).tobytes() + (least >> np.uint32(8)).astype(np.uint8).tobytes()


def least_same(percent: int) -> int:
    """Hashes of the sketch that agree at least, four standard deviations below ``percent``."""
    share = percent / 100
    return int(HASHES * share - 4 * (HASHES * share * (1 - share)) ** 0.5)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    if not len(a) or not len(b):
        return False
    shared = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def document_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_id, sig`` of every row; the last two are null for an empty set."""
    def of(piece):
        sets = [shingles(t) for t in texts(piece)]
        return [piece.column("doc_id"), [len(s) for s in sets],
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([signature(s) if len(s) else None for s in sets], pa.binary())]

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id long, n_shingles long, set_id binary, sig binary", of)


def _branch(sig: Column, tree: Column, depth: int) -> Column:
    """The tree and its first ``depth`` hashes, as one number."""
    start = tree * (HASHES // TREES) + 1
    planes = [F.concat(F.substring(sig, 1 + k * HASHES, HASHES), F.substring(sig, 1 + k * HASHES, HASHES)) for k in (0, 1)]
    return F.xxhash64(tree, *[F.substring(plane, start, F.lit(depth)) for plane in planes])


def missed(percent: int, depth: int) -> float:
    """The chance that a pair of this similarity is together in no tree at this depth."""
    return (1 - (percent / 100) ** depth) ** TREES


def _regions(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``branch, tree, rep`` of all regions that fit, (``a, b``) of what agrees in all hashes and doesn't fit, and the crowds.

    Crowds are the regions (``branch, tree, rep``) that don't fit at the greatest depth at which few enough linked pairs are missed.
    """
    whole = max([d for d in DEPTHS if missed(percent, d) <= MOST_MISSED], default=DEPTHS[0])
    crowds = None
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    rows, fitting = classes.select("rep", "size", "sig", tree), []
    fits = (F.col("classes") <= REGION) & (F.col("shingles") <= REGION_SHINGLES)
    for depth in DEPTHS:
        branches = rows.select(_branch(F.col("sig"), F.col("tree"), depth).alias("branch"), "rep", "tree", "size")
        sizes = branches.groupBy("branch").agg(F.count("*").alias("classes"), F.sum("size").alias("shingles")).where("classes > 1")
        level = stash(branches.drop("size").join(sizes, "branch"), f"forest-{depth}")
        fitting.append(level.where(fits).select("branch", "tree", "rep"))
        crowded = level.where(~fits)
        if crowds is None and depth >= whole:
            crowds = crowded.select("branch", "tree", "rep")
        if crowded.isEmpty():
            break
        rows = crowded.select("rep", "tree").join(classes, "rep").select("rep", "size", "sig", "tree")
    regions = fitting[0]
    for more in fitting[1:]:
        regions = regions.union(more)
    heads = crowded.groupBy("branch").agg(F.min("rep").alias("b"))
    alike = crowded.join(heads, "branch").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct()
    return regions, alike, regions.limit(0) if crowds is None else crowds


def _whole_regions(batches):
    """Tables of whole regions, from rows sorted by ``branch``; a region may go over several batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        first, final = held[0].column("branch")[0].as_py(), batch.column("branch")[-1].as_py()
        if first == final:
            continue
        table = pa.Table.from_batches(held)
        whole = int(np.searchsorted(table.column("branch").to_numpy(), final))
        yield table.slice(0, whole)
        held = table.slice(whole).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _cuts(branch: np.ndarray) -> list[tuple[int, int]]:
    edges = [0, *(np.nonzero(np.diff(branch))[0] + 1).tolist(), len(branch)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def _pages(sizes: np.ndarray, involved: np.ndarray) -> np.ndarray:
    """For each place a page; the involved classes of two pages have ``REGION_SHINGLES`` shingles, or a page's first class is larger."""
    ends = np.cumsum(np.where(involved, sizes, 0))
    return ends // (REGION_SHINGLES // 2) if ends[-1] > REGION_SHINGLES else np.zeros(len(sizes), np.int64)


def _candidates(groups: np.ndarray, blocks: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, branches: np.ndarray, tree: int,
                percent: int) -> list[tuple[int, np.ndarray]]:
    """For places in a region the later places whose sketch is close enough, unless an earlier tree has the two in a region too.

    Places of one group are linked already. Of two blocks of a crowd only pairs across them count.
    """
    found, least = [], least_same(percent)
    across = blocks.min() != blocks.max()
    for i in range(len(groups) - 1):
        rest = slice(i + 1, None)
        fit = (np.minimum(sizes[rest], sizes[i]) * 100 >= np.maximum(sizes[rest], sizes[i]) * percent) & (groups[rest] != groups[i])
        if across:
            fit &= blocks[rest] != blocks[i]
        if not fit.any():
            continue
        fit &= ~((branches[rest, :tree] == branches[i, :tree]) & (branches[i, :tree] != 0)).any(axis=1)
        at = np.nonzero(fit)[0] + i + 1
        at = at[(sketches[at] == sketches[i]).sum(axis=1) >= least]
        if len(at):
            found.append((i, at))
    return found


def _involved(regions: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``branch, rep, partners``: the classes of each region that have candidates there, each pair at one of the two, in one tree."""
    return _compared(_paths(regions).withColumns({"group": F.col("rep"), "block": F.lit(0).cast("long")}), classes, percent)


def _involved_crowds(crowds: DataFrame, classes: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """The same for regions that don't fit, in tiles of two blocks of classes, for pairs that ``groups`` doesn't connect already."""
    named = crowds.join(groups.select(F.col("vertex").alias("rep"), "component"), "rep", "left").withColumn("group", F.coalesce("component", "rep"))
    split = (named.groupBy("branch").agg(F.count("*").alias("n"), F.min("group").alias("least"), F.max("group").alias("most"))
             .where("least <> most").select("branch", F.ceil(2 * F.col("n") / REGION).alias("blocks")))
    rows = stash(_paths(named.join(split, "branch").select("branch", "tree", "rep", "group", "blocks").distinct()), "crowds")
    tiles = (rows.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .withColumn("branch", F.xxhash64("branch", F.least("block", "other"), F.greatest("block", "other"))))
    return _compared(tiles, classes, percent)


def _paths(regions: DataFrame) -> DataFrame:
    """The rows, with the branch of their class in each tree."""
    number = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.coalesce(F.try_element_at("by_tree", t), F.lit(0).cast("long")))
    one = F.when(F.min("branch") == F.max("branch"), F.min("branch")).otherwise(0)  # a rep with several classes may be in two
    forest = (regions.groupBy("rep", "tree").agg(one.alias("branch")).groupBy("rep")
              .agg(F.map_from_entries(F.collect_list(F.struct("tree", "branch"))).alias("by_tree")).select("rep", number.alias("branches")))
    return regions.join(forest, "rep")


def _compared(regions: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    rows = (regions.join(classes.select("rep", "size", F.substring("sig", 1, HASHES).alias("sketch")), "rep")
            .repartition("branch").sortWithinPartitions("branch", "rep")
            .select("branch", "tree", "rep", "group", "block", "size", "sketch", "branches"))

    def run(batches):
        for table in _whole_regions(batches):
            branch, tree = table.column("branch").to_numpy(), table.column("tree").to_numpy()
            ids, sizes, groups, blocks = (table.column(c).to_numpy() for c in ("rep", "size", "group", "block"))
            sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, HASHES)
            paths = table.column("branches").combine_chunks().flatten().to_numpy().reshape(-1, TREES)
            out: dict[tuple[int, int], list[int]] = {}
            for a, b in _cuts(branch):
                found = _candidates(groups[a:b], blocks[a:b], sizes[a:b], sketches[a:b], paths[a:b], int(tree[a]), percent)
                involved = np.zeros(b - a, bool)
                for i, at in found:
                    involved[i] = involved[at] = True
                pages = _pages(sizes[a:b], involved)  # texts too long to be confirmed in one task are confirmed page by page
                for i, at in found:
                    for k in at.tolist():
                        key = int(branch[a])
                        if pages[-1]:
                            key = xxhash.xxh3_64_intdigest(np.array([key, pages[i], pages[k]], np.int64).tobytes()) - (1 << 63)
                        out.setdefault((key, int(ids[a + i])), []).append(int(ids[a + k]))
                        out.setdefault((key, int(ids[a + k])), [])
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([r for _, r in out], pa.int64()),
                                              pa.array(list(out.values()), pa.list_(pa.int64()))], names=["branch", "rep", "partners"])

    return rows.mapInArrow(run, "branch long, rep long, partners array<bigint>")


def _own_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id, text`` of the documents in ``ids`` (``doc_id``)."""
    ids = stash(ids.distinct(), "ids")
    return stash(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi"), "texts")


def _confirm_regions(involved: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links between the classes of each region that connect all that are linked there, confirmed on their full sets.

    A candidate pair that other links of the region connect already needs no test, so a region gives fewer links than it has classes.
    """
    own = _own_texts(docs, involved.select(F.col("rep").alias("doc_id")))
    rows = (involved.join(own, F.col("rep") == F.col("doc_id")).repartition("branch").sortWithinPartitions("branch", "rep")
            .select("branch", "rep", "partners", "text"))

    def run(batches):
        for table in _whole_regions(batches):
            ids, partners, bodies = (table.column(c).to_pylist() for c in ("rep", "partners", "text"))
            left, right = [], []
            for first, stop in _cuts(table.column("branch").to_numpy()):
                sets: dict[int, list[np.ndarray]] = {}
                parent: dict[int, int] = {}
                for i in range(first, stop):
                    sets.setdefault(ids[i], []).append(shingles(bodies[i]))

                def find(x: int) -> int:
                    while parent.setdefault(x, x) != x:
                        parent[x] = parent[parent[x]]
                        x = parent[x]
                    return x

                for i in range(first, stop):
                    for other in partners[i]:
                        a, b = find(ids[i]), find(other)
                        if a != b and any(linked(x, y, percent) for x in sets[ids[i]] for y in sets.get(other, [])):
                            parent[max(a, b)] = min(a, b)
                            left.append(ids[i])
                            right.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _confirm_pairs(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a, b``) whose full sets are linked."""
    own = _own_texts(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))
    sides = [own.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")) for side in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")

    def of(piece):
        keep = [linked(shingles(x), shingles(y), percent) for x, y in zip(texts(piece, "text_a"), texts(piece, "text_b"), strict=True)]
        kept = piece.filter(pa.array(keep, pa.bool_()))
        return [kept.column("a"), kept.column("b")]

    return map_slices(both, "a long, b long", of)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``, where sets of ``percent`` similarity are linked."""
    sets = stash(document_sets(docs), "sets")
    whole = sets.where("set_id IS NOT NULL AND doc_id IS NOT NULL")
    classes = stash(whole.groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("size"), F.min("sig").alias("sig")), "classes")
    members = stash(whole.select("doc_id", "set_id").join(classes.select("set_id", "rep"), "set_id").select("doc_id", "rep"), "members")

    regions, alike, crowds = _regions(classes, percent)
    links = _confirm_regions(stash(_involved(stash(regions.distinct(), "regions"), classes, percent), "involved"), docs, percent)
    # A doc_id with several texts is in several classes.
    several = members.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("most")).where("b <> most").select("doc_id", "b")
    same = members.join(several, "doc_id").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct()
    group = stash(components(links.union(same).union(_confirm_pairs(stash(alike, "alike"), docs, percent))), "groups")
    if not crowds.isEmpty():
        more = stash(_confirm_regions(stash(_involved_crowds(crowds, classes, group, percent), "crowded"), docs, percent), "links")
        if not more.isEmpty():
            group = stash(components(more.union(group.select("vertex", "component"))), "groups")

    named = members.distinct().join(group, F.col("rep") == F.col("vertex"), "left").groupBy("doc_id").agg(
        F.min(F.coalesce("component", "rep")).alias("component_id"))
    found = sets.select("doc_id", "n_shingles").join(named, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def clean_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each group, one with the smallest ``doc_id``, with the same columns.

    Each row is a document of its own here, so one row stays of repeats and of copies without a ``doc_id``, and what a row with a
    repeated ``doc_id`` has alone stays. Empty texts stay.
    """
    rows = stash(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number")), "rows")
    groups = stash(near_duplicates(rows.select(F.col("number").alias("doc_id"), "row.text"), percent).select("doc_id", "component_id"), "numbered")
    keys = rows.select(F.col("number").alias("doc_id"), F.col("row.doc_id").cast("long").alias("own"), F.xxhash64("row.text").alias("tie"))
    order = F.struct(F.col("own").isNull(), "own", "tie", "doc_id")  # ids first, then none
    # Each group's first row is found before the shuffle; rows meet on their own numbers, so no group is one task's, however large.
    first = groups.join(keys, "doc_id").groupBy("component_id").agg(F.min_by("doc_id", order).alias("doc_id")).select("doc_id")
    gone = stash(groups.join(first, "doc_id", "left_anti").select(F.col("doc_id").alias("number")), "gone")
    return rows.join(gone, "number", "left_anti").select("row.*")
