"""Character n-gram classifier with naive Bayes scaled features.

Features are the n-grams of characters (code points, n from a parameter) of the
lower-cased text with each run of white space as one space, known by their
64-bit hashes.  The unit of training and of scoring is a window: a text is cut
into windows that cover all of it, each half over the next, and one of up to a
window's length is one window.  A window has a feature or not.  Each feature is
scaled by its log-count ratio ``log((p + a) / |p|) - log((q + a) / |q|)`` of the
toxic and the other training windows, and a logistic regression is fitted on the
scaled features.  A toxic text need not be toxic all over: after a first fit the
model is fitted again with only the highest window of each toxic text.

A text's score is that of its highest window, less what the highest of so many
clean windows gains by chance: the log of their number times the scale of the
upper tail of clean windows, measured on the training rows by models that have
not seen them.

Training reads a bounded sample of the labelled rows (``max_training_rows``,
those with the smallest hash of their id, ``max_training_windows`` evenly spread
windows of each).  All n-grams of the sample are counted.  The model is at most
``max_features`` hashes with a weight each, so scoring is the same work for any
corpus.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, mixed, row_chunks, store, utf8


@dataclass(frozen=True)
class Training:
    orders: tuple[int, ...] = (3, 4, 5, 6)
    smoothing: float = 1.0
    #: features in at least so many training windows, the best of them
    min_windows: int = 3
    #: 65,536 at most
    max_features: int = 4096
    max_training_rows: int = 6_000
    max_training_windows: int = 16
    #: tasks that the sample is dealt over
    parts: int = 24
    ridge: float = 2.0
    #: the fit ends when no slope is over this a window, or after so many steps
    slope: float = 1e-4
    steps: int = 250
    threshold: float = 0.3
    #: characters of folded text a window, an even number
    window: int = 2048
    #: share of clean windows above which their margins' tail is measured
    tail: float = 0.05


TRAINING = Training()
#: half windows that a long text is hashed at a time
_HALVES = 512
#: training windows that a step of the fit expands at a time
_BLOCK = 4096
#: steps that the fit remembers
_PAST = 10
#: distinct hashes that a training task holds before it passes on their counts
_PENDING = 1 << 22
#: code points of this prefix table hold all letters with a lower case
_LOWER = np.arange(1 << 17, dtype=np.int32)
for _c in range(1 << 17):
    if len(chr(_c).lower()) == 1:
        _LOWER[_c] = ord(chr(_c).lower())
_LOWER[9:14] = 32


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def _characters(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower-case code points of UTF-8 bytes, first character of each row that
    begins at a byte of ``at``).  Bytes that are not UTF-8 give some number, the
    same each time."""
    if not len(body) or body.max() < 128:
        return _LOWER[body], at
    lead = (body & 0xC0) != 0x80
    lead[at[at < len(body)]] = True
    starts = np.flatnonzero(lead)
    code = body[starts].astype(np.int32)
    size = np.diff(starts, append=len(body))
    more = np.flatnonzero(size > 1)
    first, size = starts[more], np.minimum(size[more], 4)
    value = code[more] & (0xFF >> (size + 1))
    for k in (1, 2, 3):
        has = size > k
        value[has] = value[has] << 6 | body[first[has] + k] & 0x3F
    code[more] = value
    small = code < len(_LOWER)
    code[small] = _LOWER[code[small]]
    return code, np.searchsorted(starts, at)


def _single_spaced(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``codes`` without spaces that follow a space, but for those at ``starts``."""
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    keep[starts] = True
    return codes[keep], np.concatenate([[0], np.cumsum(keep)])[starts]


def folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every row as `` text `` in lower case with single spaces, a row's last
    space being the next one's first."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    body, at = _characters(data[lo:hi], offsets - lo)
    n = len(offsets) - 1
    padded = np.full(len(body) + n + 1, 32, np.int32)
    padded[np.arange(len(body)) + np.repeat(np.arange(1, n + 1), np.diff(at))] = body
    return _single_spaced(padded, at + np.arange(n + 1))


@dataclass(frozen=True)
class Piece:
    """Some rows, or a stretch of one long row with whole half windows."""
    row: int  # number of the first row
    codes: np.ndarray
    at: np.ndarray  # rows' first characters and the end of the last
    ends: np.ndarray  # where the n-grams of each row end at the latest
    windows: np.ndarray  # of each row


def _piece(row: int, codes: np.ndarray, at: np.ndarray, ends: np.ndarray, training: Training) -> Piece:
    # window k is the halves k and k + 1
    halves = -(-np.diff(at) // (training.window // 2))
    return Piece(row, codes, at, ends, np.maximum(halves - 1, 1))


def pieces(data: np.ndarray, offsets: np.ndarray, training: Training, chunk: int = CHUNK_BYTES) -> Iterator[Piece]:
    half, reach = training.window // 2, max(training.orders)
    for a, b in row_chunks(offsets, chunk):
        lo, hi = int(offsets[a]), int(offsets[b])
        if hi - lo <= chunk:
            codes, at = folded(data, offsets[a: b + 1])
            yield _piece(a, codes, at, at[1:] + 1, training)
            continue
        held = np.array([32], np.int32)
        while lo < hi:
            stop = min(lo + chunk, hi)
            for _ in range(3):
                if stop < hi and data[stop] & 0xC0 == 0x80 and stop > lo + 1:
                    stop -= 1
            body, _ = _characters(data[lo:stop], np.zeros(1, np.int64))
            held, _ = _single_spaced(np.concatenate([held, body]), np.zeros(1, np.int64))
            lo = stop
            while len(held) > _HALVES * half + reach:
                own = _HALVES * half
                codes = held[: own + reach]
                yield _piece(a, codes, np.array([0, own]), np.array([len(codes)]), training)
                # the last half is the first of the next window
                held = held[own - half:]
        codes = np.append(held, np.int32(32))
        yield _piece(a, codes, np.array([0, len(held)]), np.array([len(codes)]), training)


def hashes_of(codes: np.ndarray, orders: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray]]:
    """(n, hashes of the n-grams by their first character), orders rising."""
    mix = mixed(codes.astype(np.uint64) + np.uint64(1))
    rolled = np.zeros(len(mix), np.uint64)
    for n in range(1, min(max(orders), len(mix)) + 1):
        rolled = rolled[: len(mix) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + mix[n - 1:]
        if n in orders:
            yield n, (rolled ^ (rolled >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)


def _distinct_pairs(unit: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((what, unit))
    unit, what = unit[order], what[order]
    new = np.ones(len(unit), bool)
    new[1:] = (unit[1:] != unit[:-1]) | (what[1:] != what[:-1])
    return unit[new], what[new]


class Chosen:
    """Looks hashes up among the sorted ``hashes`` of a model."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes, self.shift = hashes, np.uint64(64 - 20)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[hashes >> self.shift] = True

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the chosen ones in ``ids``, their numbers)"""
        if not len(self.hashes):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(self.maybe[ids >> self.shift])
        number = np.minimum(np.searchsorted(self.hashes, ids[at]), len(self.hashes) - 1)
        same = self.hashes[number] == ids[at]
        return at[same], number[same]

    def windows_of(self, piece: Piece, training: Training) -> tuple[np.ndarray, np.ndarray]:
        """(window, feature) of each chosen n-gram in a piece, each pair once;
        windows are numbered through the piece's rows."""
        half, first = training.window // 2, np.cumsum(piece.windows) - piece.windows
        units, numbers = [], []
        for n, ids in hashes_of(piece.codes, training.orders):
            pos, number = self.find(ids)
            row = np.searchsorted(piece.at, pos, side="right") - 1
            own = row < len(piece.windows)
            own[own] = pos[own] + n <= piece.ends[row[own]]
            pos, number, row = pos[own], number[own], row[own]
            part = (pos - piece.at[row]) // half
            for k in (np.minimum(part, piece.windows[row] - 1), np.maximum(part - 1, 0)):
                units.append(first[row] + k)
                numbers.append(number)
        if not units:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        m = max(len(self.hashes), 1)
        key = np.unique(np.concatenate(units) * m + np.concatenate(numbers))
        return key // m, key % m


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # hashes, uint64, rising
    ratios: np.ndarray  # log-count ratio of each feature
    weights: np.ndarray  # of each feature, with its ratio
    bias: float
    #: taken off the highest margin of n windows, times log(n)
    discount: float
    training: Training

    def scores(self, data: np.ndarray, offsets: np.ndarray, chunk: int = CHUNK_BYTES) -> np.ndarray:
        n = len(offsets) - 1
        highest, windows = np.full(n, -np.inf), np.zeros(n, np.int64)
        chosen = Chosen(self.features)
        for piece in pieces(data, offsets, self.training, chunk):
            unit, number = chosen.windows_of(piece, self.training)
            margin = np.bincount(unit, self.weights[number], int(piece.windows.sum()))
            rows = slice(piece.row, piece.row + len(piece.windows))
            most = np.maximum.reduceat(margin, np.cumsum(piece.windows) - piece.windows)
            highest[rows] = np.maximum(highest[rows], most)
            windows[rows] += piece.windows
        margin = highest + self.bias - self.discount * np.log(np.maximum(windows, 1))
        return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def sampled(docs: DataFrame, labels: DataFrame, training: Training = TRAINING, label: str = "toxic") -> DataFrame:
    """``id, y, text`` of the training rows: labelled and not held out.

    Rows without an id, a 0/1 label or a document are left out; of labels that
    contradict each other the larger counts; of rows with one id the least text.
    """
    marked = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(
        F.col("doc_id").cast("bigint").alias("id")).agg(F.max(label).cast("int").alias("y"))
    marked = marked.orderBy(F.xxhash64("id"), "id").limit(training.max_training_rows)
    # at most max_training_rows rows of two numbers
    joined = _texts(docs).join(F.broadcast(marked), F.col("doc_id") == F.col("id"))
    # one row an id, so that repeated rows don't pass the bound
    return joined.repartition(training.parts, "id").groupBy("id").agg(
        F.max("y").alias("y"), F.min("text").alias("text"))


def _training_windows(batches: Iterator[pa.RecordBatch], training: Training) -> Iterator[tuple[int, int, int, Piece]]:
    """(id, y, number, piece) of each training window, as a piece of its own."""
    half, reach = training.window // 2, max(training.orders)
    for batch in batches:
        data, offsets = utf8(batch.column(2))
        ids, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        total = np.zeros(len(ids), np.int64)
        for piece in pieces(data, offsets, training):
            total[piece.row: piece.row + len(piece.windows)] += piece.windows
        begun = np.zeros(len(ids), np.int64)
        for piece in pieces(data, offsets, training):
            for i, windows in enumerate(piece.windows.tolist()):
                row = piece.row + i
                most = min(int(total[row]), training.max_training_windows)
                wanted = np.arange(most) * int(total[row]) // most
                for k in wanted[(wanted >= begun[row]) & (wanted < begun[row] + windows)].tolist():
                    a = int(piece.at[i]) + (k - int(begun[row])) * half
                    own = min(2 * half, int(piece.at[i + 1]) - a)
                    codes = piece.codes[a: min(a + own + reach, int(piece.ends[i]))]
                    yield int(ids[row]), int(y[row]), k, Piece(
                        0, codes, np.array([0, own]), np.array([len(codes)]), np.ones(1, np.int64))
                begun[row] += windows


def _grams(piece: Piece, training: Training) -> np.ndarray:
    own = int(piece.at[1])
    found = [ids[:own] for _, ids in hashes_of(piece.codes, training.orders)]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


def counted(sample: DataFrame, training: Training = TRAINING) -> DataFrame:
    """``feature, p, q``: windows of the toxic and of the other training texts
    with each n-gram that ``min_windows`` of them have; feature null: all windows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
        n = [0, 0]

        def counts() -> Iterator[pa.RecordBatch]:
            for y, found in enumerate(held):
                if found:
                    seen, times = np.unique(np.concatenate(found), return_counts=True)
                    found.clear()
                    both = [np.zeros_like(times), times]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(seen.view(np.int64)), pa.array(both[y]), pa.array(both[1 - y])], ["feature", "p", "q"])

        pending = 0
        for _, y, _, piece in _training_windows(batches, training):
            n[y] += 1
            held[y].append(_grams(piece, training))
            pending += len(held[y][-1])
            if pending >= _PENDING:
                yield from counts()
                pending = 0
        yield from counts()
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([n[1]], pa.int64()), pa.array([n[0]], pa.int64())], ["feature", "p", "q"])

    return sample.mapInArrow(count, "feature bigint, p bigint, q bigint").groupBy("feature").agg(
        F.sum("p").alias("p"), F.sum("q").alias("q")).where(
        F.col("feature").isNull() | (F.col("p") + F.col("q") >= training.min_windows))


def fit(docs: DataFrame, labels: DataFrame, training: Training = TRAINING, label: str = "toxic") -> Model:
    """A model of ``label`` from the rows of ``labels`` that are not held out
    (see :func:`sampled`).  Without rows of both labels every text scores the
    share of ones."""
    sample = store(sampled(docs, labels, training, label), "toxicity-sample")
    counts = store(counted(sample, training), "toxicity-counts")
    # one row
    total = counts.where("feature is null").first()
    n_p, n_q = (total.p, total.q) if total else (0, 0)
    if not n_p or not n_q:
        share = n_p / (n_p + n_q) if n_p + n_q else 0.0
        return Model(np.empty(0, np.uint64), np.empty(0), np.empty(0),
                     float(np.log((share + 1e-6) / (1 - share + 1e-6))), 0.0, training)
    a = training.smoothing
    ratio = F.log((F.col("p") + a) / F.lit(n_p + 2 * a)) - F.log((F.col("q") + a) / F.lit(n_q + 2 * a))
    surety = F.abs(ratio) / F.sqrt(1 / (F.col("p") + a) + 1 / (F.col("q") + a))
    best = counts.where("feature is not null").select("feature", ratio.alias("ratio"), surety.alias("z")).where(
        "ratio != 0").orderBy(F.desc("z"), "feature").limit(training.max_features).collect()
    hashes = np.array([r.feature for r in best], np.int64).view(np.uint64)
    rising = np.argsort(hashes)
    hashes, ratios = hashes[rising], np.array([r.ratio for r in best], np.float64)[rising]
    shared = sample.sparkSession.sparkContext.broadcast(hashes)  # at most max_features

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = Chosen(shared.value)
        for doc, y, k, piece in _training_windows(batches, training):
            _, ids = chosen.windows_of(piece, training)
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc], pa.int64()), pa.array([y], pa.int32()), pa.array([k], pa.int64()),
                 pa.array([ids.astype(np.uint16).tobytes()], pa.binary())], ["id", "y", "k", "ids"])

    # at most max_training_rows * max_training_windows rows of at most max_features numbers
    data = sample.mapInArrow(rows, "id bigint, y int, k bigint, ids binary").orderBy("id", "k").toArrow()
    lists = data.column("ids").combine_chunks()
    numbers = Rows(np.frombuffer(b"".join(lists.to_pylist()), np.uint16),
                   pa.compute.binary_length(lists).to_numpy(zero_copy_only=False).astype(np.int64) // 2)
    y = data.column("y").to_numpy().astype(np.float64)
    return trained(data.column("id").to_numpy(), y, numbers, hashes, ratios, training)


@dataclass(frozen=True)
class Rows:
    """Windows' feature numbers one after another, and how many each has."""
    numbers: np.ndarray  # uint16
    sizes: np.ndarray

    def where(self, own: np.ndarray) -> "Rows":
        return Rows(self.numbers[np.repeat(own, self.sizes)], self.sizes[own])

    def _blocks(self) -> Iterator[tuple[int, int, np.ndarray]]:
        at = np.concatenate([[0], np.cumsum(self.sizes)])
        for a in range(0, len(self.sizes), _BLOCK):
            b = min(a + _BLOCK, len(self.sizes))
            yield a, b, self.numbers[at[a]: at[b]]

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of each row's features."""
        out = np.zeros(len(self.sizes))
        for a, b, numbers in self._blocks():
            sums = np.concatenate([[0.0], np.cumsum(weights[numbers])])
            ends = np.cumsum(self.sizes[a:b])
            out[a:b] = sums[ends] - sums[ends - self.sizes[a:b]]
        return out

    def sums(self, values: np.ndarray, m: int) -> np.ndarray:
        """Sum of the values of each feature's rows."""
        out = np.zeros(m)
        for a, b, numbers in self._blocks():
            out += np.bincount(numbers, np.repeat(values[a:b], self.sizes[a:b]), m)
        return out


def trained(doc: np.ndarray, y: np.ndarray, rows: Rows, hashes: np.ndarray, ratios: np.ndarray,
            training: Training) -> Model:
    """The model of the windows ``rows`` of texts ``doc`` (rising) labelled ``y``."""
    w, b = logistic(y, rows, ratios, training)
    # again with the highest window of each toxic text
    order = np.lexsort((-rows.margins(w * ratios), doc))
    kept = y == 0
    kept[order[np.append(True, doc[order][1:] != doc[order][:-1])]] = True
    if not kept.all():
        w, b = logistic(y[kept], rows.where(kept), ratios, training, (w, b))
    # clean windows as models of the other half of the texts see them
    fold = mixed(doc.view(np.uint64)) >> np.uint64(63) == 1
    clean = []
    for half in (fold & kept, ~fold & kept):
        other = kept & ~half
        if 0 < y[other].sum() < other.sum() and (half & (y == 0)).any():
            v, _ = logistic(y[other], rows.where(other), ratios, training)
            clean.append(rows.where(half & (y == 0)).margins(v * ratios))
    discount = 0.0
    if clean:
        margins = np.sort(np.concatenate(clean))
        upper = margins[-max(1, int(len(margins) * training.tail)):]
        discount = float((upper - upper[0]).mean())
    return Model(hashes, ratios, w * ratios, b, discount, training)


def logistic(y: np.ndarray, rows: Rows, scale: np.ndarray, training: Training,
             start: tuple[np.ndarray, float] | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic regression on the scaled features, by
    limited-memory quasi-Newton steps until the slope is ``slope`` a row at most."""
    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        margin = np.clip(rows.margins(scale * x[:-1]) + x[-1], -35, 35)
        down = np.exp(-margin)
        off = 1 / (1 + down) - y
        total = (np.log1p(down) + (1 - y) * margin).sum() + training.ridge / 2 * x[:-1] @ x[:-1]
        return float(total), np.append(scale * rows.sums(off, len(scale)) + training.ridge * x[:-1], off.sum())

    share = y.mean()
    x = np.append(*(start or (np.zeros(len(scale)), np.log(share / (1 - share)))))
    (value, slope), past = loss(x), deque(maxlen=_PAST)
    for _ in range(training.steps):
        if np.abs(slope).max() <= training.slope * len(y):
            break
        step = _towards(slope, past)
        size, most = 1.0, slope @ step
        while True:
            after, after_slope = loss(x + size * step)
            # rounding of the sum is no rise
            if after <= value + 1e-4 * size * most + 1e-12 * abs(value) or size < 1e-9:
                break
            size /= 2
        moved, turned = size * step, after_slope - slope
        if moved @ turned > 1e-12 * np.sqrt((moved @ moved) * (turned @ turned)):
            past.append((moved, turned))
        x, value, slope = x + moved, after, after_slope
    return x[:-1], float(x[-1])


def _towards(slope: np.ndarray, past: deque) -> np.ndarray:
    """The downward step that the curvature seen in the ``past`` steps suggests."""
    if not past:
        return -slope / np.abs(slope).sum()
    step, shares = -slope, []
    for moved, turned in reversed(past):
        shares.append(moved @ step / (moved @ turned))
        step = step - shares[-1] * turned
    moved, turned = past[-1]
    step = step * (moved @ turned / (turned @ turned))
    for moved, turned in past:
        step = step + moved * (shares.pop() - turned @ step / (moved @ turned))
    return step


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row; a null or empty text scores as one
    without features; repeated rows stay repeated."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: max_features hashes and weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own.scores(*utf8(batch.column(1))))], ["doc_id", "score"])

    return _texts(docs).mapInArrow(run, "doc_id bigint, score double")


def judged(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted``."""
    return score(docs, model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= model.training.threshold).cast("int").alias("predicted"))


def keep_civil(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    names = docs.columns
    text_at = names.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            civil = own.scores(*utf8(batch.column(text_at))) < own.training.threshold
            yield batch.filter(pa.array(civil))

    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    return plain.mapInArrow(run, plain.schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
