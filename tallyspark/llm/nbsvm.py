"""Quality classifier: naive Bayes support vectors.

Features of a text are indicators of n-grams: its words (folded to lower case)
and the 1- to 3-grams of its words' *forms*, known by 64-bit hashes.  A form is
the word with each run of lower-case letters (and bytes beyond ASCII) as ``a``,
of capitals as ``A``, of digits as ``0``; a word equal to the one before it has
the form ``=``.

1. A bounded sample of the labelled rows is read once and its distinct features
   written; Spark counts each feature's texts by label.
2. A feature's log-count ratio is ``log((p + s) / |p|) - log((q + s) / |q|)``
   for p good and q bad texts; the ``max_features`` surest of those in at least
   ``min_texts`` texts are the model's.
3. A text is the vector of its features' ratios, scaled to length 1, with a
   constant beside it: training and scoring see the same vector whatever the
   text's length.  A linear hinge-loss model is fitted by dual coordinate
   descent, in one task on the bounded sample.
4. Margins become scores by a logistic curve that is fitted on the margins of
   training rows under models that did not see them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, mixed, odd_numbers, row_chunks, store, utf8, word_hashes


@dataclass(frozen=True)
class Training:
    #: the longest n-gram of forms
    forms: int = 3
    smoothing: float = 1.0
    min_texts: int = 5
    max_features: int = 16_384
    max_training_rows: int = 12_000
    #: the bound of a dual variable: a row's greatest pull
    cost: float = 1.0
    passes: int = 60
    #: passes end early where no gradient of one is beyond this
    tolerance: float = 1e-3
    folds: int = 3
    threshold: float = 0.5
    #: bytes up to which a text is read in one piece
    piece: int = 1 << 22


TRAINING = Training()
_LETTER = np.arange(256, dtype=np.uint8)
_LETTER[ord("a"): ord("z") + 1] = ord("a")
_LETTER[128:] = ord("a")
_LETTER[ord("A"): ord("Z") + 1] = ord("A")
_LETTER[ord("0"): ord("9") + 1] = ord("0")
_RUNS = np.zeros(256, bool)
_RUNS[[ord("a"), ord("A"), ord("0")]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32
_WHITE = np.zeros(256, bool)
_WHITE[list(WHITE)] = True
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_REPEATED = np.uint64(0x3D)
#: features that a training task holds before it passes on their counts
_PENDING = 1 << 20


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3 == 1


def features(data: np.ndarray, offsets: np.ndarray, training: Training = TRAINING) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature hash) of the rows ``data[offsets[i]:offsets[i + 1]]``,
    repeats included.  A long text alone is read in pieces."""
    if len(offsets) != 2 or offsets[1] - offsets[0] <= training.piece:
        return _features(data, offsets, training)
    start, end = int(offsets[0]), int(offsets[1])
    begin, cut, found = start, start, np.empty(0, np.uint64)
    view = memoryview(np.ascontiguousarray(data))
    while cut < end:
        gap = _GAP.search(view, cut + training.piece, end) if cut + training.piece < end else None
        cut = gap.start() if gap else end
        _, own = _features(data, np.array([begin, cut]), training, begin > start)
        found = np.union1d(found, own)
        # the next piece repeats as many words as the longest n-gram has; its
        # first is only there to compare the second with
        white = _WHITE[data[begin:cut]]
        words = np.flatnonzero(~white & np.concatenate([[True], white[:-1]]))
        begin = begin + int(words[-training.forms:][0]) if len(words) else cut
    return np.zeros(len(found), np.int64), found


def _features(data: np.ndarray, offsets: np.ndarray, training: Training,
              without_first: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`features`; ``without_first`` leaves out n-grams that begin with
    the first word."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    body, at = data[lo:hi], offsets - lo
    words, counts = word_hashes(_LOWER[body], at)
    if not len(words):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    kinds = _LETTER[body]
    keep = np.ones(len(body), bool)
    keep[1:] = (kinds[1:] != kinds[:-1]) | ~_RUNS[kinds[1:]]
    begins = at[:-1][at[:-1] < at[1:]]
    keep[begins] = True
    forms, _ = word_hashes(kinds[keep], np.concatenate([[0], np.cumsum(keep)])[at])
    row = np.repeat(np.arange(len(counts)), counts)
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    forms[same] = _REPEATED
    salts = odd_numbers(31, training.forms + 1)
    rows, out = [row], [mixed(words ^ salts[0])]
    gram = forms
    for n in range(1, training.forms + 1):
        if n > 1:
            gram = mixed(gram[:-1] * salts[0] + forms[n - 1:])
        inside = row[: len(gram)] == row[n - 1:]
        rows.append(row[: len(gram)][inside])
        out.append(mixed(gram[inside] ^ salts[n]))
    if without_first:
        rows, out = [r[1:] for r in rows], [f[1:] for f in out]
    return np.concatenate(rows), np.concatenate(out)


def _distinct(row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((feature, row))
    row, feature = row[order], feature[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (feature[1:] != feature[:-1])
    return row[new], feature[new]


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # hashes, uint64, rising
    ratios: np.ndarray  # of each feature, float64
    weights: np.ndarray  # of each feature's ratio, then of the constant
    slope: float
    shift: float
    training: Training

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature number) of the model's features in each row, once each."""
        row, feature = features(data, offsets, self.training)
        if not len(self.features):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        number = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
        known = self.features[number] == feature
        key = np.unique(row[known] * len(self.features) + number[known])
        return key // len(self.features), key % len(self.features)

    def margins(self, row: np.ndarray, number: np.ndarray, n: int) -> np.ndarray:
        r = self.ratios[number]
        norm = np.sqrt(np.bincount(row, r * r, n))
        dot = np.bincount(row, r * self.weights[number], n)
        return np.divide(dot, norm, out=np.zeros(n), where=norm > 0) + self.weights[-1]

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        margin = self.margins(*self.rows(data, offsets), len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -35, 35)))


def descend(y: np.ndarray, x: list[tuple[np.ndarray, np.ndarray]], size: int, training: Training) -> np.ndarray:
    """Weights (the constant's last) of the hinge-loss model ``min |w|^2 / 2 +
    cost * sum(max(0, 1 - y w x))`` for rows ``x`` of (numbers, values), by dual
    coordinate descent: one row's dual variable at a time to its optimum."""
    w = np.zeros(size + 1)
    dual = np.zeros(len(y))
    square = np.array([float(v @ v) for _, v in x]) + 1
    rng = np.random.default_rng(7)
    for _ in range(training.passes):
        worst = 0.0
        for i in rng.permutation(len(y)):
            at, value = x[i]
            gradient = y[i] * (float(value @ w[at]) + w[-1]) - 1
            old = dual[i]
            if (old <= 0 and gradient >= 0) or (old >= training.cost and gradient <= 0):
                continue
            worst = max(worst, abs(gradient))
            dual[i] = min(max(old - gradient / square[i], 0.0), training.cost)
            step = (dual[i] - old) * y[i]
            w[at] += step * value
            w[-1] += step
        if worst <= training.tolerance:
            break
    return w


def logistic_curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of the logistic curve of ``y`` (0 or 1) on the margins, by
    Newton steps with a slight pull to zero."""
    z = np.array([1.0, 0.0])
    design = np.stack([margin, np.ones(len(margin))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ z, -35, 35)))
        gradient = design.T @ (p - y) + 1e-3 * z
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        z -= step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(z[0]), float(z[1])


def fit(docs: DataFrame, labels: DataFrame, training: Training = TRAINING, label: str = "quality") -> Model:
    """A model of ``label`` from the rows of ``labels`` that are not held out.

    Read are at most ``max_training_rows`` labelled rows, those with the smallest
    hashes of their ids.  Rows without an id, a 0/1 label or a document are left
    out; of labels that contradict each other the larger counts; of rows with one
    id the least text counts.  Without rows of both labels every text scores the
    share of ones.
    """
    spark = docs.sparkSession
    marked = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(
        F.col("doc_id").cast("bigint").alias("id")).agg(F.max(label).cast("int").alias("y"))
    # at most max_training_rows rows of two numbers
    chosen = F.broadcast(marked.orderBy(F.xxhash64("id"), "id").limit(training.max_training_rows))
    sample = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(
        chosen, F.col("doc_id") == F.col("id")).groupBy("id").agg(F.max("y").alias("y"), F.min("text").alias("text"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in row_chunks(offsets):
                row, feature = _distinct(*features(data, offsets[a: b + 1], training))
                at = np.searchsorted(row, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(feature.view(np.int64)))],
                    ["id", "y", "features"])

    sample = store(sample.select("id", "y", "text").mapInArrow(
        listed, "id bigint, y int, features array<bigint>"), "quality-sample")
    totals = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_p, n_q = totals.get(1, 0), totals.get(0, 0)
    if not n_p or not n_q:
        share = n_p / (n_p + n_q) if n_p + n_q else 0.0
        return Model(np.empty(0, np.uint64), np.empty(0), np.zeros(1), 0.0,
                     float(np.log((share + 1e-6) / (1 - share + 1e-6))), training)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])

        def counts() -> Iterator[pa.RecordBatch]:
            for y, found in enumerate(held):
                if found:
                    seen, n = np.unique(np.concatenate(found), return_counts=True)
                    found.clear()
                    both = [np.zeros_like(n), n]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(seen), pa.array(both[y]), pa.array(both[1 - y])], ["feature", "p", "q"])

        size = 0
        for batch in batches:
            lists = batch.column(1)
            at, flat, y = lists.offsets.to_numpy(), lists.values.to_numpy(), batch.column(0).to_numpy()
            for i in range(batch.num_rows):
                held[y[i]].append(flat[at[i]: at[i + 1]])
                size += int(at[i + 1] - at[i])
                if size >= _PENDING:
                    yield from counts()
                    size = 0
        yield from counts()

    s = training.smoothing
    counts = sample.select("y", "features").mapInArrow(counted, "feature bigint, p bigint, q bigint").groupBy(
        "feature").agg(F.sum("p").alias("p"), F.sum("q").alias("q")).where(F.col("p") + F.col("q") >= training.min_texts)
    ratio = F.log((F.col("p") + s) / F.lit(n_p + 2 * s)) - F.log((F.col("q") + s) / F.lit(n_q + 2 * s))
    surety = F.abs(ratio) / F.sqrt(1 / (F.col("p") + s) + 1 / (F.col("q") + s))
    # max_features rows of two numbers
    best = counts.select("feature", ratio.alias("ratio"), surety.alias("z")).where("ratio <> 0").orderBy(
        F.desc("z"), "feature").limit(training.max_features).select("feature", "ratio").collect()
    hashes = np.array([r.feature for r in best], np.int64).view(np.uint64)
    rising = np.argsort(hashes)
    hashes, ratios = hashes[rising], np.array([r.ratio for r in best], np.float64)[rising]
    shared = spark.sparkContext.broadcast(hashes)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            lists = batch.column(2)
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
            out = []
            for i in range(batch.num_rows):
                ids = flat[at[i]: at[i + 1]]
                number = np.minimum(np.searchsorted(own, ids), max(len(own) - 1, 0))
                found = number[own[number] == ids] if len(own) else np.empty(0, np.int64)
                out.append(np.sort(found).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["id", "y", "numbers"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, sets = [], []
        for batch in batches:
            y += batch.column(1).to_pylist()
            sets += [np.frombuffer(b, np.int32) for b in batch.column(2).to_pylist()]
        weights, slope, shift = _fitted(np.array(y, np.int64), sets, ratios, training)
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.tobytes()], pa.binary()), pa.array([slope]), pa.array([shift])],
            ["weights", "slope", "shift"])

    # one task, at most max_training_rows rows of at most max_features numbers
    row = sample.mapInArrow(numbered, "id bigint, y int, numbers binary").repartition(1).sortWithinPartitions(
        F.xxhash64("id"), "id").mapInArrow(fitted, "weights binary, slope double, shift double").first()
    return Model(hashes, ratios, np.frombuffer(row.weights), row.slope, row.shift, training)


def _fitted(y: np.ndarray, sets: list[np.ndarray], ratios: np.ndarray,
            training: Training) -> tuple[np.ndarray, float, float]:
    """(weights, slope, shift) from labels and the numbers of each row's features."""
    x = []
    for numbers in sets:
        value = ratios[numbers]
        x.append((numbers, value / (np.sqrt(value @ value) or 1.0)))
    sign = 2.0 * y - 1
    margins = np.zeros(len(y))
    fold = np.arange(len(y)) % training.folds
    for k in range(training.folds):
        seen, other = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        w = descend(sign[seen], [x[i] for i in seen], len(ratios), training)
        margins[other] = [float(x[i][1] @ w[x[i][0]]) + w[-1] for i in other]
    return descend(sign, x, len(ratios), training), *logistic_curve(margins, y.astype(np.float64))


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, from the text alone.

    A null or empty text scores as one without features; a null ``doc_id`` stays
    null and is not held out; repeated rows stay repeated; other columns are not
    read; no rows give none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most max_features hashes, ratios and weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in row_chunks(offsets):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(own.scores(data, offsets[a: b + 1]))],
                    ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, score double")
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= model.training.threshold).cast("int").alias("predicted"))
