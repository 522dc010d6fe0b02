"""Best-fit packing of tokenised documents into sequences.

The plan is made on the histogram of piece lengths, which has one entry per
length up to the capacity however many documents there are:

1. *Large items* (over a third of the capacity) share a sequence with at most
   one other large item: greedy matching, longest first, each with the longest
   partner that fits.
2. *Small items*, longest first, go to the smallest gap that holds them.

Equal sequences are handled together, so the plan is a list of slots
``(length, first rank, bins, items a bin, first sequence, offset)`` whose size
depends on the capacity alone; it is broadcast with that bound.  Spark ranks
the pieces of each length (salted, so that one frequent length is no hot
group) and each piece finds its slot by rank.
"""

from __future__ import annotations

import base64
import bisect
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import store

CAPACITY = 2048
END_ID = 0
SALTS = 1024
_ENCODINGS: dict[str, Encoder] = {}


def _of_json(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """(ranks, added tokens) of a byte-level BPE file of the tokenizers
    library; raises where its ids would differ from those of the ranks."""
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    model, split = given["model"], given["pre_tokenizer"]
    vocab, added = model["vocab"], given["added_tokens"]
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    if (model["type"] != "BPE" or given["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"]
            or not split["use_regex"] or model["dropout"] or model.get("ignore_merges")
            or any(a < b for a, b in zip(map(vocab.get, merged[1:]), map(vocab.get, merged)))):
        raise ValueError(f"{path} is not byte-level BPE with ids in the order of the merges")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added) or any(
            a["content"] != b["content"] and b["content"].startswith(a["content"]) for a in added for b in added):
        raise ValueError(f"{path} has added tokens that are not plain strings")
    # the library writes the bytes that are not printable as characters from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"]: t["id"] for t in added}
    return {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}, special


#: characters of white space in a row beyond which the pattern's look-ahead runs out of stack
_LONG_GAP = 20_000
_SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: what the pattern's \\s matches (Python's own has U+001C to U+001F besides)
_GAPS = re.compile(f"[{_SPACES}]+")


class Encoder:
    """Token ids of texts by ``pattern`` and ranks; added tokens are found first.

    The pattern takes a run of white space in one match, but for its last
    character where something else follows.  Long runs are cut out that way
    before matching, and encoded as the one piece they are.
    """

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int], pattern: str) -> None:
        self.special = special
        self._matches = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self._whole = tiktoken.Encoding("packing-piece", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self._added = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def ids(self, text: str) -> list[int]:
        # a long run holds one of the blocks of half its length
        half = _LONG_GAP // 2
        if not any(not text[i: i + half].strip(_SPACES) for i in range(0, len(text) - half + 1, half)):
            return self._matches.encode(text, allowed_special="all")
        out: list[int] = []
        for part in self._added.split(text) if self._added else [text]:
            if part in self.special:
                out.append(self.special[part])
                continue
            at = 0
            for gap in _GAPS.finditer(part):
                if len(gap[0]) >= _LONG_GAP:
                    end = gap.end() - (gap.end() < len(part))
                    out += self._matches.encode_ordinary(part[at: gap.start()])
                    out += self._whole.encode_ordinary(part[gap.start(): end])
                    at = end
            out += self._matches.encode_ordinary(part[at:])
        return out


def _encoding(path: str, pattern: str) -> Encoder:
    if path not in _ENCODINGS:
        if path.endswith(".json"):
            ranks, special = _of_json(path)
        else:
            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
            special = {}
        _ENCODINGS[path] = Encoder(ranks, special, pattern)
    return _ENCODINGS[path]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY,
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each text's ids and the
    closing id, cut from the end into pieces of ``capacity`` ids, so that only
    the first may be shorter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encoding.ids(text) if text else []
                    ids.append(END_ID)
                    raw = np.array(ids, "<u4")
                    bounds = list(range(len(ids), 0, -capacity))[::-1]
                    begin = 0
                    for k, end in enumerate(bounds):
                        rows.append((doc, k, begin, end - begin, zlib.crc32(raw[begin:end].tobytes())))
                        begin = end
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def plan_slots(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, ...]], int]:
    """(slots, number of sequences) for so many pieces of each length.

    A slot ``(length, rank, bins, each, sequence, offset)`` takes the pieces
    of ``length`` with ranks ``rank .. rank + bins * each - 1``, ``each`` side
    by side from ``offset`` in the sequences ``sequence .. sequence + bins - 1``.
    """
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError("every length must be between 1 and the capacity")
    left = {n: c for n, c in counts.items() if c}
    used: dict[int, int] = dict.fromkeys(left, 0)
    slots: list[tuple[int, ...]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> [(first sequence, bins)]
    sequences = 0

    def place(length: int, bins: int, each: int, sequence: int, offset: int) -> None:
        slots.append((length, used[length], bins, each, sequence, offset))
        used[length] += bins * each
        left[length] -= bins * each

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    rising = large[::-1]
    for length in large:
        while left[length]:
            # the longest large partner that fits and is not used up
            k = bisect.bisect_right(rising, capacity - length) - 1
            while k >= 0 and not (left[rising[k]] - (rising[k] == length)) > 0:
                k -= 1
            partner = rising[k] if k >= 0 else None
            if partner is None:
                bins, gap = left[length], capacity - length
                place(length, bins, 1, sequences, 0)
            elif partner == length:
                bins, gap = left[length] // 2, capacity - 2 * length
                place(length, bins, 2, sequences, 0)
            else:
                bins, gap = min(left[length], left[partner]), capacity - length - partner
                place(length, bins, 1, sequences, 0)
                place(partner, bins, 1, sequences, length)
            gaps.setdefault(gap, []).append((sequences, bins))
            sequences += bins
    open_gaps = sorted(gaps)
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            k = bisect.bisect_left(open_gaps, length)
            if k == len(open_gaps):
                gap, sequence = capacity, sequences
                bins = max(1, left[length] // (capacity // length))
                sequences += bins
            else:
                gap = open_gaps[k]
                sequence, bins = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], open_gaps[k]
            each = min(gap // length, left[length])
            taken = min(bins, left[length] // each)
            place(length, taken, each, sequence, capacity - gap)
            for rest, first, n in ((gap, sequence + taken, bins - taken), (gap - each * length, sequence, taken)):
                if n and rest:
                    if rest not in gaps:
                        bisect.insort(open_gaps, rest)
                    gaps.setdefault(rest, []).append((first, n))
    return slots, sequences


def place_pieces(cut: DataFrame, capacity: int = CAPACITY, salts: int = SALTS) -> DataFrame:
    """Adds ``sequence_id, offset`` to stored pieces (see :func:`pieces`)."""
    spark = cut.sparkSession
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    per_salt = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = per_salt.select("length", "salt", (F.sum("n").over(
        Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    # at most one row per length up to the capacity
    counts = {r.length: r.n for r in per_salt.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots, _ = plan_slots(counts, capacity)
    by_length: dict[int, list[tuple[int, ...]]] = {}
    for length, *slot in slots:
        by_length.setdefault(length, []).append(slot)
    plan = spark.sparkContext.broadcast({n: np.array(s, np.int64).T for n, s in by_length.items()})
    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1
    ranked = (salted.withColumn("rank", rank).join(before, ["length", "salt"])
              .withColumn("rank", F.col("rank") + F.coalesce(F.col("before"), F.lit(0)))
              .select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("bigint")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for at in np.split(order, cuts) if len(order) else []:
                n = int(length[at[0]])
                first, _, each, seq, off = plan.value[n]
                k = np.searchsorted(first, rank[at], side="right") - 1
                nth = rank[at] - first[k]
                sequence[at] = seq[k] + nth // each[k]
                offset[at] = off[k] + nth % each[k] * n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                  "sequence_id bigint, offset bigint")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every row's text: ``doc_id, piece, start, length,
    ids_crc32, sequence_id, offset``.

    A null or empty text is the closing id alone; repeated rows are packed
    each; a null ``doc_id`` stays null; other columns are not read; no rows
    give no rows.  ``path`` is, with the same path on every machine, a JSON file
    of the tokenizers library, whose added tokens are found in the text as that
    library finds them, or a rank file, which has none.
    """
    return place_pieces(store(pieces(docs, path, capacity), "pieces"), capacity)
