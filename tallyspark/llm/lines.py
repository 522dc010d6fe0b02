"""Line dedup through sharded minimal perfect hashes.

Every distinct line key (128-bit hash) belongs to one shard.  A shard holds a
minimal perfect hash over its keys and, at each key's index, a fingerprint,
the number of documents with the key and the largest of their ids.  Documents
send only (shard, hash, doc_id) to the shards and probe the arrays; neither
lines nor counts are joined.

The perfect hash is a cascade of bit arrays: a key is settled on the first
level at which it meets no other key; its index is its bit's rank.

A probe partition is a stream sorted so that a shard's arrays come before its
probes, and the probes of one shard are salted over several partitions (each
gets a copy of the arrays).  The number of salts follows the shard's counted
probes, so a line that a third of all documents share is no hot task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, store

MIN_CHARS = 20
MIN_DOCS = 3
SHARD_KEYS = 100_000
#: partitions of a shard's probes; a busier shard has one for each PROBES
SALTS = 4
PROBES = 1_000_000
#: bound on the shards with salts of their own, four times over
MAX_BUSY = 100_000
_GAMMA = 2.0


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, total = [], 0
        for bits in levels:
            ones = np.cumsum(np.unpackbits(bits).reshape(-1, 64).sum(axis=1, dtype=np.int64))
            self.ranks.append(total + np.concatenate([[0], ones[:-1]]))
            total += int(ones[-1])
        self.size = total

    @staticmethod
    def _at(keys: np.ndarray, level: int, n_bits: int) -> np.ndarray:
        seed = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
        return (mixed(keys ^ seed) % np.uint64(n_bits)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            n_bits = max(64, -(-int(_GAMMA * len(keys)) // 64) * 64)
            at = cls._at(keys, len(levels), n_bits)
            hits = np.bincount(at, minlength=n_bits)
            levels.append(np.packbits(hits == 1))
            keys = keys[hits[at] > 1]
            if len(levels) > 200:
                raise ValueError("the keys are not distinct")
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; -1 (or any index) for a key not in the set."""
        out = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            at = self._at(keys[rest], level, len(bits) * 8)
            hit = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            won, block = at[hit], at[hit] >> 6
            words = bits.reshape(-1, 8)[block]
            inside = np.unpackbits(words, axis=1).cumsum(axis=1, dtype=np.int64)
            low = won & 63
            out[rest[hit]] = ranks[block] + inside[np.arange(len(won)), low] - 1
            rest = rest[~hit]
            if not len(rest):
                break
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels)], "<i8")
        return head.tobytes() + b"".join(x.tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        sizes = np.frombuffer(raw, "<i8", n, 8)
        at, levels = 8 * (n + 1), []
        for size in sizes:
            levels.append(np.frombuffer(raw, np.uint8, int(size), at))
            at += int(size)
        return cls(levels)


def line_key(line: bytes) -> bytes:
    """White space stripped at both ends, A-Z lower-cased."""
    return line.strip().lower()


def long_keys(text: str, min_chars: int) -> list[bytes]:
    """The key of each line, empty where it has under ``min_chars`` code points."""
    keys = [line_key(x) for x in text.encode("utf-8").split(b"\n")]
    return [k if len(k) >= min_chars and (len(k) >= 4 * min_chars or len(k.decode("utf-8")) >= min_chars) else b""
            for k in keys]


def hash128(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def document_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, key, mark``: each row's distinct long keys as two longs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids, raw = [], []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if text:
                        own = {hash128(k) for k in long_keys(text, min_chars) if k}
                        raw.extend(own)
                        ids.extend([doc] * len(own))
                both = np.frombuffer(b"".join(raw), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())],
                    ["doc_id", "key", "mark"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, key bigint, mark bigint")


_ARRAYS = "shard int, hash binary, marks binary, counts binary, keepers binary, clashes binary"


def build_shards(keys: DataFrame, shards: int) -> DataFrame:
    """One row of arrays per shard from ``shard, key, mark, n, keeper``.

    Two keys with one 64-bit half are told apart by the other half: all but
    one go to the shard's clash list (key, mark, count, keeper)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(shard: int, parts: list[np.ndarray]) -> pa.RecordBatch:
            key, mark, n, keeper = np.concatenate(parts).T
            _, one = np.unique(key, return_index=True)
            rest = np.ones(len(key), bool)
            rest[one] = False
            found = PerfectHash.build(key[one].view(np.uint64))
            at = found.index(key[one].view(np.uint64))
            arrays = []
            for column in (mark, n, keeper):
                values = np.empty(len(one), "<i8")
                values[at] = column[one]
                arrays.append(values.tobytes())
            clashes = np.stack([key, mark, n, keeper], axis=1)[rest].astype("<i8").tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32())] + [pa.array([x], pa.binary()) for x in
                                                  (found.to_bytes(), *arrays, clashes)], names)
        open_shard, parts = None, []
        for batch in batches:
            shard = batch.column(0).to_numpy()
            rows = np.stack([batch.column(i).to_numpy() for i in range(1, 5)], axis=1)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if open_shard is not None and shard[a] != open_shard:
                    yield finish(open_shard, parts)
                    parts = []
                open_shard = int(shard[a])
                parts.append(rows[a:b])
        if parts:
            yield finish(open_shard, parts)

    names = [x.split()[0] for x in _ARRAYS.split(", ")]
    return (keys.repartition(shards, "shard").sortWithinPartitions("shard")
            .select("shard", "key", "mark", "n", "keeper").mapInArrow(run, _ARRAYS))


def busy_shards(distinct: DataFrame, probes: int = PROBES) -> DataFrame:
    """``shard, salts`` of the shards whose keys (``shard, n``) are probed more
    than ``SALTS * probes`` times.  With more than ``MAX_BUSY * probes`` probes
    in all a salt takes more of them, so the table has at most ``MAX_BUSY /
    SALTS`` rows at any size of the corpus."""
    total = distinct.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    each = max(probes, -(-total // MAX_BUSY))
    return distinct.groupBy("shard").agg(F.sum("n").alias("n")).where(F.col("n") > SALTS * each).select(
        "shard", F.ceil(F.col("n") / each).cast("int").alias("salts"))


def probe(own: DataFrame, arrays: DataFrame, busy: DataFrame, shards: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows ``doc_id, key, mark`` of ``own`` (with ``shard``) whose key is
    in at least ``min_docs`` documents and kept by another one."""
    names = ["hash", "marks", "counts", "keepers", "clashes"]
    parts = shards * SALTS + busy.agg(F.coalesce(F.sum("salts"), F.lit(0))).first()[0]
    dealt = F.broadcast(busy.withColumnRenamed("salts", "own_salts"))  # see busy_shards for its bound
    salts = F.coalesce("own_salts", F.lit(SALTS))
    copies = arrays.join(dealt, "shard", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).select(
        "shard", "salt", F.lit(0).alias("kind"), *names,
        *[F.lit(None).cast("bigint").alias(c) for c in ("doc_id", "key", "mark")])
    probes = own.join(dealt, "shard", "left").select(
        "shard", F.pmod(F.xxhash64("doc_id", "mark"), salts).cast("int").alias("salt"), F.lit(1).alias("kind"),
        *[F.lit(None).cast("binary").alias(c) for c in names], "doc_id", "key", "mark")
    stream = (copies.unionByName(probes).repartition(parts, "shard", "salt")
              .sortWithinPartitions("shard", "salt", "kind"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = ()
        for batch in batches:
            kind = batch.column(2).to_numpy()
            table_at = np.flatnonzero(kind == 0)
            bounds = np.concatenate([[0], table_at, [len(kind)]])
            for a, b in zip(bounds[:-1], bounds[1:]):
                if a < len(kind) and kind[a] == 0 and a < b:
                    raw = [batch.column(i)[int(a)].as_py() for i in range(3, 8)]
                    held = (PerfectHash.from_bytes(raw[0]), *[np.frombuffer(x, "<i8") for x in raw[1:4]],
                            {(k, m): (n, d) for k, m, n, d in np.frombuffer(raw[4], "<i8").reshape(-1, 4).tolist()})
                    a += 1
                if a >= b:
                    continue
                part = batch.slice(a, b - a)
                doc = part.column(8).to_numpy(zero_copy_only=False)
                doc = np.where(np.isnan(doc), _NO_ID, doc).astype(np.int64) if doc.dtype.kind == "f" else doc
                if part.column(8).null_count:
                    doc = part.column(8).fill_null(_NO_ID).to_numpy()
                key, mark = part.column(9).to_numpy(), part.column(10).to_numpy()
                index, marks, counts, keepers, clashes = held
                at = index.index(key.view(np.uint64))
                gone = (marks[at] == mark) & (counts[at] >= min_docs) & (keepers[at] != doc)
                if clashes:
                    for i in np.flatnonzero(marks[at] != mark):
                        n, keeper = clashes[int(key[i]), int(mark[i])]
                        gone[i] = n >= min_docs and keeper != doc[i]
                if gone.any():
                    out = pa.RecordBatch.from_arrays([part.column(i) for i in (8, 9, 10)], ["doc_id", "key", "mark"])
                    yield out.filter(pa.array(gone))

    return stream.select("shard", "salt", "kind", *names, "doc_id", "key", "mark").mapInArrow(
        run, "doc_id bigint, key bigint, mark bigint")


_NO_ID = -(1 << 63)  # stands for a null doc_id, smaller than any id


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                shard_keys: int = SHARD_KEYS, probes: int = PROBES) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, plus ``n_lines``
    (before) and ``n_dropped``.

    A line's key loses its lines everywhere but in the largest ``doc_id``
    holding it, if the key has ``min_chars`` code points and is found in
    ``min_docs`` rows; the remaining lines stay, joined by one line feed.  A
    null text counts as one empty line and stays null; a null ``doc_id`` is
    smaller than any id; rows with one ``doc_id`` keep or lose a line
    together; other columns, also ones named like the helpers here, pass
    through (``n_lines`` and ``n_dropped`` are replaced); no rows give none.
    """
    own = store(document_keys(docs, min_chars), "line-keys")
    distinct = own.groupBy("key", "mark").agg(
        F.count("*").alias("n"), F.coalesce(F.max("doc_id"), F.lit(_NO_ID)).alias("keeper"))
    distinct = store(distinct, "line-counts")
    shards = max(1, -(-distinct.count() // shard_keys))
    shard = F.pmod(F.col("mark"), F.lit(shards)).cast("int")
    distinct = distinct.withColumn("shard", shard)
    arrays = build_shards(distinct, shards)
    busy = store(busy_shards(distinct, probes), "line-busy")
    gone = probe(own.withColumn("shard", shard), arrays, busy, shards, min_docs)
    gone = store(gone.groupBy("doc_id").agg(F.collect_set(F.struct("key", "mark")).alias("gone")), "line-drops")
    gone = gone.select(F.col("doc_id").alias("__doc"), "gone")

    plain = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in plain]).alias("row")).join(
        gone, F.col("row.doc_id").cast("bigint").eqNullSafe(F.col("__doc")), "left")
    cut = "__cut"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                row = part.column(0)
                texts = row.field(text_at).to_pylist()
                found = part.column(1)
                new, lines, dropped = [], [], []
                for i, text in enumerate(texts):
                    n = 1 if text is None else text.count("\n") + 1
                    lines.append(n)
                    if not found[i].is_valid or not text:
                        new.append(text)
                        dropped.append(0)
                        continue
                    drop = {np.array([g["key"], g["mark"]], "<i8").tobytes() for g in found[i].as_py()}
                    stay = [x for x, k in zip(text.split("\n"), long_keys(text, min_chars))
                            if not k or hash128(k) not in drop]
                    new.append("\n".join(stay))
                    dropped.append(n - len(stay))
                fields = [pa.array(new, pa.string()) if i == text_at else row.field(i) for i in range(len(plain))]
                yield pa.RecordBatch.from_arrays(
                    [*fields, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                    [f"c{i}" for i in range(len(plain))] + ["n_lines", cut])

    text_at = plain.index("text")
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    schema = ", ".join(f"c{i} {kinds[c].simpleString() if c != 'text' else 'string'}" for i, c in enumerate(plain))
    out = kept.select("row", "gone").mapInArrow(run, f"{schema}, n_lines bigint, {cut} bigint")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(plain)], "n_lines",
                      F.col(cut).alias("n_dropped"))
