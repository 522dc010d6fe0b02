"""N-gram Jaccard self-join through a MinHash LSH forest.

1. Each text becomes the set of its word 5-gram hashes; texts with equal sets
   are one *class*, and only classes go on.
2. A class has, for each of ``trees`` trees, a label of ``depth`` minhashes.
   Sorted labels with a common beginning are one node of a prefix trie.  The
   matched beginning is shortened from the full label until a pair at the
   threshold shares a node with at least the target probability
   ``1 - (1 - t ** length) ** trees``; nodes are found by grouping on that
   prefix, and each member is tied to the node's least member.
   The length follows from the parameters alone (:meth:`Forest.shortest`).
3. Candidate components of these ties are compared exactly: their members are
   dealt into blocks of bounded size, each pair of blocks of a component is one
   group, and a matrix product of members x shingles gives all intersections.
   A pair belongs to one component only, so links are counted once and no pair
   is written: a group returns every member's number of links and a spanning
   forest of them.
4. The forests' components are the near-duplicate groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mixed, odd_numbers, row_chunks, store, utf8, word_hashes
from .components import components


@dataclass(frozen=True)
class Forest:
    words: int = 5
    #: similarity of a link, as tenths to compare whole numbers
    tenths: int = 8
    trees: int = 32
    depth: int = 8
    target: float = 0.9999
    #: shingles of a block in the exact comparison
    block_shingles: int = 150_000

    #: :func:`matched_length` looks at one of so many nodes: at all of them
    sampled_nodes: int = 1
    #: members of a block in the exact comparison
    block_members: int = 2_000

    def recall(self, length: int, similarity: np.ndarray) -> np.ndarray:
        """The probability that a pair shares a node of so long a prefix."""
        return 1 - (1 - similarity ** length) ** self.trees

    def shortest(self) -> int:
        """The longest prefix with the target recall at the threshold itself."""
        for length in range(self.depth, 1, -1):
            if self.recall(length, np.float64(self.tenths / 10)) >= self.target:
                return length
        return 1


FOREST = Forest()


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes row after row, offsets).  A row with
    fewer than n words, but some, has one shingle of all its words."""
    words, counts = word_hashes(data, offsets)
    ends = np.concatenate([[0], np.cumsum(counts)])
    factors = odd_numbers(5, n)
    rows = len(counts)
    if len(words) >= n:
        grams = np.zeros(len(words) - n + 1, np.uint64)
        for j in range(n):
            grams += words[j: len(words) - n + 1 + j] * factors[j]
        grams = mixed(grams)
    else:
        grams = np.empty(0, np.uint64)
    out, sizes = [], np.zeros(rows, np.int64)
    for i in range(rows):
        a, b = ends[i], ends[i + 1]
        if b - a >= n:
            own = np.unique(grams[a: b - n + 1])
        elif b > a:
            own = mixed((words[a:b] * factors[: b - a]).sum(dtype=np.uint64, keepdims=True) ^ np.uint64(b - a))
        else:
            continue
        out.append(own)
        sizes[i] = len(own)
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def _set_keys(shingles: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Two longs for each non-empty row's set."""
    full = at[:-1] < at[1:]
    keys = np.zeros((len(at) - 1, 2), np.uint64)
    if full.any():
        starts = at[:-1][full]
        keys[full, 0] = np.add.reduceat(mixed(shingles ^ np.uint64(0x51ED270B)), starts)
        keys[full, 1] = np.add.reduceat(mixed(shingles * np.uint64(0xC2B2AE3D27D4EB4F)), starts)
        keys[full, 0] = mixed(keys[full, 0] ^ (at[1:] - at[:-1])[full].astype(np.uint64))
    return keys


def _minhashes(shingles: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """k minhashes of every row (rows must not be empty), 16 bits of each."""
    a, b = odd_numbers(11, k), odd_numbers(12, k)
    out = np.empty((len(at) - 1, k), "<u2")
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(k):
        mul, add = np.uint32(int(a[i]) >> 32 | 1), np.uint32(int(b[i]) >> 32)
        least = np.minimum.reduceat(low * mul + add, at[:-1])
        out[:, i] = (mixed(least.astype(np.uint64)) >> np.uint64(20)).astype("<u2")
    return out


def signatures(docs: DataFrame, forest: Forest = FOREST) -> DataFrame:
    """``doc_id, h1, h2, key binary, id, size, labels binary`` of every row;
    ``h1, h2`` are hashes of the text, ``key``
    is the set's 128-bit hash and ``id`` half of it; key and labels are null
    for a text without words."""
    k = forest.trees * forest.depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(3))
            for a, b in row_chunks(offsets):
                shingles, at = shingle_sets(data, offsets[a: b + 1], forest.words)
                keys, sizes = _set_keys(shingles, at), np.diff(at)
                full = sizes > 0
                labels = iter(_minhashes(shingles, np.unique(at), k)) if full.any() else iter(())
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(i).slice(a, b - a) for i in range(3)],
                    pa.array([keys[i].tobytes() if f else None for i, f in enumerate(full)], pa.binary()),
                    pa.array(keys[:, 0].copy().view(np.int64)), pa.array(sizes, pa.int64()),
                    pa.array([next(labels).tobytes() if f else None for f in full], pa.binary())],
                    ["doc_id", "h1", "h2", "key", "id", "size", "labels"])

    return with_text_hashes(docs).mapInArrow(
        run, "doc_id bigint, h1 bigint, h2 bigint, key binary, id bigint, size bigint, labels binary")


def text_hashes(text: Column) -> tuple[Column, Column]:
    """Two hashes that name a text, a null one too."""
    return F.xxhash64(text.cast("string"), F.lit(1)), F.xxhash64(F.lit(2), text.cast("string"))


def with_text_hashes(docs: DataFrame) -> DataFrame:
    """``doc_id, h1, h2, text``."""
    h1, h2 = text_hashes(F.col("text"))
    return docs.select(F.col("doc_id").cast("bigint"), h1.alias("h1"), h2.alias("h2"), F.col("text").cast("string"))


def matched_length(classes: DataFrame, forest: Forest = FOREST) -> int:
    """The prefix length that this corpus would need for the target recall: a
    measure to look at, as its linked pairs are mostly closer than the threshold.
    The join does not depend on it.

    From the full label, the prefix is shortened while the recall measured on
    linked pairs is below the target, at most to the length that has it for
    pairs all at the threshold.  Pairs are those of a class and the least one in
    its node, in the first tree at that shortest length, for one of
    ``sampled_nodes`` nodes; equal minhashes of all trees tell their similarity,
    and a pair counts by the inverse of its chance to meet in that tree.
    """
    least_length, k = forest.shortest(), forest.trees * forest.depth
    if least_length == forest.depth:
        return least_length
    nodes = classes.select(F.substring("labels", 1, 2 * least_length).alias("prefix"), "id", "labels").where(
        F.pmod(F.xxhash64("prefix"), F.lit(forest.sampled_nodes)) == 0)
    least = nodes.groupBy("prefix").agg(F.min(F.struct("id", "labels")).alias("least"), F.count("*").alias("n")).where("n > 1")
    pairs = nodes.join(least, "prefix").where("id <> least.id").select("labels", F.col("least.labels").alias("other"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(c.to_pylist()), "<u2").reshape(-1, k) for c in batch.columns)
                equal, n = np.unique((a == b).sum(axis=1), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(equal, pa.int64()), pa.array(n, pa.int64())], ["equal", "n"])

    # at most one row per number of equal minhashes
    found = pairs.mapInArrow(run, "equal bigint, n bigint").groupBy("equal").agg(F.sum("n").alias("n")).where(
        F.col("equal") * 10 >= forest.tenths * k).collect()
    if not found:
        return least_length
    similarity = np.array([r.equal / k for r in found])
    weight = np.array([r.n for r in found]) / similarity ** least_length
    for length in range(forest.depth, least_length, -1):
        if (weight * forest.recall(length, similarity)).sum() >= forest.target * weight.sum():
            return length
    return least_length


def candidate_ties(classes: DataFrame, forest: Forest = FOREST, length: int | None = None) -> DataFrame:
    """``a, b``: the ids of a class and the least class of a trie node of both."""
    length, label = length or forest.shortest(), 2 * forest.depth
    rows = classes.select("id", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(forest.trees - 1)),
        lambda t: F.substr(F.col("labels"), t * label + 1, F.lit(2 * length)))).alias("tree", "prefix"))
    rows = rows.select("id", F.xxhash64("tree", "prefix").alias("node"))
    least = rows.groupBy("node").agg(F.min("id").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(least, "node").where("id <> b").select(F.col("id").alias("a"), "b").distinct()


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """Whole groups of a stream sorted by its first ``n_keys`` columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*[batch.column(i).to_pylist() for i in range(n_keys)]))
        start = 0
        for i, key in enumerate(keys):
            if key != last:
                if i > start or held:
                    held.append(batch.slice(start, i - start))
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, key
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _linked(left: list[np.ndarray], right: list[np.ndarray], tenths: int) -> np.ndarray:
    """Whether each left set and each right set are linked, exactly.  With
    ``right`` the same list the diagonal is of no meaning."""
    sizes_l, sizes_r = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    if len(left) * len(right) <= 4:
        inter = np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left])
    else:
        same = left is right
        every, place = np.unique(np.concatenate(left if same else [*left, *right]), return_inverse=True)
        if same:
            shared = np.flatnonzero(np.bincount(place) > 1)
        else:
            shared = np.intersect1d(place[: sizes_l.sum()], place[sizes_l.sum():])
        column = np.full(len(every), -1, np.int64)
        column[shared] = np.arange(len(shared))
        at = column[place]
        order = np.argsort(at, kind="stable")
        order = order[np.searchsorted(at[order], 0):]
        member = np.repeat(np.arange(len(left) + (0 if same else len(right))),
                           sizes_l if same else np.concatenate([sizes_l, sizes_r]))
        inter = np.zeros((len(left), len(right)), np.float64)
        step = 2048
        for lo in range(0, len(shared), step):
            a, b = np.searchsorted(at[order], [lo, lo + step])
            x = np.zeros((len(left) + (0 if same else len(right)), min(step, len(shared) - lo)), np.float32)
            x[member[order[a:b]], at[order[a:b]] - lo] = 1
            inter += x @ x.T if same else x[: len(left)] @ x[len(left):].T
        inter = inter.astype(np.int64)
    return inter * (10 + tenths) >= tenths * (sizes_l[:, None] + sizes_r[None, :])


def _roots(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns of a link matrix, the first row of their tree."""
    rows, columns = np.full(hit.shape[0], -1), np.full(hit.shape[1], -1)
    for i in np.flatnonzero(hit.any(axis=1)):
        if rows[i] >= 0:
            continue
        rows[i] = i
        new = np.array([i])
        while len(new):
            reached = hit[new].any(axis=0) & (columns < 0)
            columns[reached] = i
            found = hit[:, reached].any(axis=1) & (rows < 0)
            rows[found] = i
            new = np.flatnonzero(found)
    return rows, columns


def compare_blocks(members: DataFrame, forest: Forest = FOREST) -> DataFrame:
    """``key, links, root`` for rows ``component, key, copies, own, blocks,
    shingles``: per pair of blocks of a component, each member's linked
    documents and a member that stands for its links there."""
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = ["component", "low", "high"]
    dealt = dealt.select("component", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                         "own", "key", "copies", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            key = group.column(4).to_pylist()
            one = np.array(list({k: i for i, k in enumerate(key)}.values()))  # repeated rows count once
            own, copies = group.column(3).to_numpy()[one], group.column(5).to_numpy()[one]
            key = [key[i] for i in one]
            lists = group.column(6).combine_chunks()
            at = lists.offsets.to_numpy()
            flat = lists.values.to_numpy().view(np.uint64)
            sets = [flat[at[i]: at[i + 1]] for i in one]
            low, high = group.column(1)[0].as_py(), group.column(2)[0].as_py()
            left = np.flatnonzero(own == low)
            right = left if low == high else np.flatnonzero(own == high)
            if not len(left) or not len(right) or (low == high and len(left) < 2):
                continue
            x = [sets[i] for i in left]
            hit = _linked(x, x if low == high else [sets[i] for i in right], forest.tenths)
            links, root = np.zeros(len(own), np.int64), np.full(len(own), -1)
            if low == high:
                np.fill_diagonal(hit, False)
                links[left] = hit @ copies[left]
                np.fill_diagonal(hit, hit.any(axis=1))
                root[left] = left[_roots(hit)[0]]
            else:
                links[left] = hit @ copies[right]
                links[right] = hit.T @ copies[left]
                rows, columns = _roots(hit)
                root[left], root[right] = left[rows], left[columns]
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[i] for i in some], pa.binary()), pa.array(links[some], pa.int64()),
                 pa.array([key[root[i]] for i in some], pa.binary())], ["key", "links", "root"])

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        run, "key binary, links bigint, root binary")


def near_duplicates(docs: DataFrame, forest: Forest = FOREST) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``class_id`` (least doc_id of
    its near-duplicate group), ``copy_id`` (least doc_id with the same shingle
    set), ``n_copies`` (rows with that set) and ``n_links`` (other rows with a
    Jaccard similarity of at least the threshold, copies included).

    A text without words, null or empty, links to nothing and is a class of
    its own; shorter texts than a shingle are one shingle; repeated rows are
    copies of each other; a null ``doc_id`` stays null (a class of only such
    rows has a null id); other columns are not read; no rows give none.
    """
    return judged_rows(docs, forest).select("doc_id", "class_id", "copy_id", "n_copies", "n_links")


def judged_rows(docs: DataFrame, forest: Forest = FOREST) -> DataFrame:
    """:func:`near_duplicates` with the row's text hashes ``h1, h2`` and
    ``head``: whether the row's id and text are those that stand for its group
    (the least id that is not null, then the least hashes)."""
    signed = store(signatures(docs, forest), "signatures")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2")
    # a set's labels and size are the same in all its rows
    classes = store(signed.where("key is not null").groupBy("key", "id", "size").agg(
        F.min(row).alias("least"), F.count("*").alias("copies"), F.first("labels").alias("labels")), "classes")
    candidates = components(candidate_ties(classes, forest))
    found = store(candidates.join(classes, F.col("vertex") == F.col("id")).select(
        "component", "key", "copies", "least", "size"), "candidates")
    sets = candidate_shingles(docs, found, forest)
    compared = store(compare_blocks(sets, forest), "links")
    links = compared.groupBy("key").agg(F.sum("links").alias("links"))
    groups = components(compared.select(F.col("key").alias("a"), F.col("root").alias("b")))
    per_class = classes.join(links, "key", "left").join(
        groups.select(F.col("vertex").alias("key"), "component"), "key", "left").select(
        "key", "least", "copies", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("component", "key").alias("component"))
    per_class = store(per_class, "per-class")
    heads = per_class.groupBy("component").agg(F.min("least").alias("top"))
    per_class = per_class.join(heads, "component").select(
        F.col("key").alias("k"), "top", F.col("least.doc_id").alias("copy_id"), "copies", "links")
    rows = signed.select("doc_id", "h1", "h2", "key").join(per_class, F.col("key") == F.col("k"), "left")
    alone = F.col("key").isNull()
    return rows.select(
        "doc_id", "h1", "h2", F.when(alone, F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("copies", F.lit(1)).cast("bigint").alias("n_copies"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("bigint").alias("n_links"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("h1") == F.col("top.h1"))
                  & (F.col("h2") == F.col("top.h2")))).alias("head"))


def candidate_shingles(docs: DataFrame, found: DataFrame, forest: Forest = FOREST) -> DataFrame:
    """The shingles of one text of each class ``component, key, copies, least
    (no_id, doc_id, h1, h2), size``, with its block and the number of blocks."""
    blocks = found.groupBy("component").agg(F.greatest(
        F.ceil(F.sum("size") / forest.block_shingles), F.ceil(F.count("*") / forest.block_members)).cast("int").alias("blocks"))
    wanted = found.join(blocks, "component").select(
        "component", "key", "copies", "blocks", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("own"),
        F.col("least.doc_id").alias("wanted_id"), F.col("least.h1").alias("w1"), F.col("least.h2").alias("w2"))
    # rows of one id and text go to the shuffle once a task, and to the join once;
    # the table of candidates grows with the corpus: one plan for every size
    texts = with_text_hashes(docs).groupBy("doc_id", "h1", "h2").agg(F.first("text").alias("text")).join(
        wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("wanted_id"))
        & (F.col("h1") == F.col("w1")) & (F.col("h2") == F.col("w2")))
    names = ["component", "key", "copies", "own", "blocks"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in row_chunks(offsets):
                shingles, at = shingle_sets(data, offsets[a: b + 1], forest.words)
                keys = _set_keys(shingles, at)
                want = batch.column(2).slice(a, b - a).to_pylist()
                if [k.tobytes() for k in keys] != want:
                    raise ValueError("two texts of one doc_id have equal hashes")
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(shingles.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(a, b - a) for i in range(1, 6)], lists], [*names, "shingles"])

    return texts.select("text", *names).mapInArrow(
        run, "component bigint, key binary, copies bigint, own int, blocks int, shingles array<bigint>")
