"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad. A line is described by its share of upper-case letters,
digits, spaces, bars, exclamation marks, symbols, other punctuation and non-ASCII bytes, by its
length, by how few different words it has and by whether it repeats an earlier line; the same
numbers of the line before and after are its neighbouring-line features. The field has one weight
per feature and a weight per pair of adjacent labels. Forward-backward passes give each line's
chance to be good; their mean, weighted by length, is mapped to a score by a logistic curve.

Training takes a bounded sample: per label about ``PER_LABEL`` labelled documents, chosen by a hash
of their id, and of each a run of at most ``RUN_LINES`` lines from its middle, whose features are
computed in tasks; a document's label stands for its lines. Scoring is one pass over whole texts,
no shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import fresh_name, hashed_share, only

PER_LABEL = 1000
RUN_LINES = 64
ROUNDS = 200
RATE = 0.1
PENALTY = 1e-3
LEAST_SCORE = 0.3
# Bytes of text that are described at once.
SLAB_BYTES = 4 << 20

_CLASSES = (
    bytes(range(0x41, 0x5B)),
    b"0123456789",
    b" \t",
    b"|",
    b"!",
    b"#$%&*+/<=>@[\\]^_`{}~",
    b"\"'(),-.:;?",
    bytes(range(0x80, 0x100)),
)
FEATURES = len(_CLASSES) + 5


def _marks() -> np.ndarray:
    marks = np.zeros(256, np.uint8)
    for i, members in enumerate(_CLASSES, 1):
        marks[list(members)] = i
    return marks


_MARKS = _marks()


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and bytes of all lines, and the number of lines of each text (one at least)."""
    joined = b"\n".join(texts)
    raw = np.frombuffer(joined, np.uint8)
    ends = np.append(np.flatnonzero(raw == 10), len(raw))
    starts = np.append(0, ends[:-1] + 1)
    size = ends - starts
    lines = joined.split(b"\n")
    numbers = np.array([t.count(b"\n") + 1 for t in texts])
    base = np.maximum(size, 1).astype(np.float64)
    marks = _MARKS[raw]
    columns = [np.ones(len(lines)), np.log1p(size) / 5]
    for i in range(1, len(_CLASSES) + 1):
        at = np.flatnonzero(marks == i)
        columns.append(np.sqrt((np.searchsorted(at, ends) - np.searchsorted(at, starts)) / base))
    words = [line.split() for line in lines]
    counts = np.array([len(w) for w in words])
    different = np.array([len(set(w)) for w in words])
    # Few words repeat by chance in a short line, many in a long one.
    columns.append(1 - np.minimum(1.0, different / np.maximum(counts, 1) ** 0.9))
    columns.append((size < 20).astype(float))
    again = np.zeros(len(lines))
    line = 0
    for number in numbers.tolist():
        seen: set[bytes] = set()
        for i in range(line, line + number):
            if lines[i] in seen:
                again[i] = 1.0
            seen.add(lines[i])
        line += number
    columns.append(again)
    return np.stack(columns, 1), size, numbers


def with_neighbours(features: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Features of a line, the line before and the line after; zeros where there is none."""
    first = np.cumsum(numbers) - numbers
    before = np.roll(features, 1, 0)
    before[first] = 0
    after = np.roll(features, -1, 0)
    after[first + numbers - 1] = 0
    return np.concatenate([features, before, after], 1)


class LineField:
    """Weights of the field: ``emit`` for bad against good, ``move`` between adjacent labels."""

    def __init__(self) -> None:
        self.mean = np.zeros(3 * FEATURES)
        self.spread = np.ones(3 * FEATURES)
        self.emit = np.zeros(3 * FEATURES)
        self.move = np.zeros((2, 2))
        self.slope, self.level = 1.0, 0.0

    def potentials(self, features: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        rows = (with_neighbours(features, numbers) - self.mean) / self.spread
        return np.clip(rows @ self.emit, -30, 30)

    def chances(self, odds: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(bad) of every line and the expected moves, by forward and backward passes that take
        all texts one line further at a time."""
        order = np.argsort(-numbers, kind="stable")
        first = (np.cumsum(numbers) - numbers)[order]
        counts = numbers[order]
        live = [int(n) for n in np.searchsorted(-counts, -np.arange(int(counts[0])), "left")]
        local = np.stack([np.ones(len(odds)), np.exp(odds)], 1)
        move = np.exp(self.move)
        forward, backward = np.empty((len(odds), 2)), np.ones((len(odds), 2))
        for t, n in enumerate(live):
            at = first[:n] + t
            now = local[at] if t == 0 else (forward[at - 1] @ move) * local[at]
            forward[at] = now / now.sum(1, keepdims=True)
        moves = np.zeros((2, 2))
        for t in range(len(live) - 2, -1, -1):
            n = live[t + 1]
            at = first[:n] + t
            later = local[at + 1] * backward[at + 1]
            now = later @ move.T
            backward[at] = now / now.sum(1, keepdims=True)
            both = forward[at][:, :, None] * move[None] * later[:, None]
            moves += (both / both.sum((1, 2), keepdims=True)).sum(0)
        chance = forward * backward
        return chance[:, 1] / chance.sum(1), moves

    def goodness(self, features: np.ndarray, size: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Length-weighted mean of P(good) per text."""
        bad, _ = self.chances(self.potentials(features, numbers), numbers)
        first = np.cumsum(numbers) - numbers
        weight = size + 1.0
        return 1 - np.add.reduceat(bad * weight, first) / np.add.reduceat(weight, first)

    def score(self, goodness: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * _logit(goodness) + self.level)))

    def fit(self, features: np.ndarray, size: np.ndarray, numbers: np.ndarray, good: np.ndarray) -> None:
        rows = with_neighbours(features, numbers)
        self.mean = rows.mean(0)
        self.spread = np.maximum(rows.std(0), 1e-6)
        constant = rows.std(0) < 1e-6
        self.mean[constant], self.spread[constant] = 0, 1
        rows = (rows - self.mean) / self.spread
        bad = np.repeat(1 - good, numbers).astype(float)
        seen = np.zeros((2, 2))
        kept = np.maximum(numbers - 1, 0)
        seen[0, 0], seen[1, 1] = kept[good == 1].sum(), kept[good == 0].sum()
        # Both kinds of documents weigh the same for the weights; the curve restores the balance.
        values = [self.emit, self.move]
        moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
        for step in range(1, ROUNDS + 1):
            odds = np.clip(rows @ self.emit, -30, 30)
            chance, moves = self.chances(odds, numbers)
            slopes = [
                rows.T @ (chance - bad) / len(bad) + PENALTY * self.emit,
                (moves - seen) / len(bad) + PENALTY * self.move,
            ]
            for v, (m, s), g in zip(values, moments, slopes, strict=True):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                v -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
        self._fit_curve(self.goodness(features, size, numbers), good)

    def _fit_curve(self, goodness: np.ndarray, good: np.ndarray) -> None:
        """Logistic regression of the label on the logit of the goodness, by Newton steps."""
        x = np.stack([_logit(goodness), np.ones(len(goodness))], 1)
        theta = np.array([1.0, 0.0])
        for _ in range(25):
            p = 1 / (1 + np.exp(-(x @ theta)))
            slope = x.T @ (p - good) + 0.1 * (theta - [1, 0])
            bend = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
            theta = theta - np.linalg.solve(bend, slope)
        self.slope, self.level = max(0.05, float(theta[0])), float(theta[1])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


# -------------------------------------------------------------------- jobs


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc, good, features, size) in line order; docs has doc_id, body; labels doc_id, quality."""
    known = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("good"), F.max("quality").alias("most"))
        .where("good = most")
    )
    chosen = hashed_share(known, "good", PER_LABEL).limit(4 * PER_LABEL)

    def describe(batches):
        for batch in batches:
            good, features, sizes, doc = [], [], [], []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, size, _ = line_features([text or b""])
                start = max(0, (len(rows) - RUN_LINES) // 2)
                part = slice(start, start + RUN_LINES)
                doc.append(len(rows[part]))
                good.append(label)
                features.append(rows[part].tobytes())
                sizes.append(size[part].astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int32()),
                    pa.array(good, pa.int32()),
                    pa.array(features, pa.binary()),
                    pa.array(sizes, pa.binary()),
                ],
                ["lines", "good", "features", "size"],
            )

    # About 2 x PER_LABEL ids, 4 x at most.
    texts = docs.join(F.broadcast(chosen.select("doc_id", "good")), "doc_id").select(
        F.col("good").cast("int"), "body"
    )
    return texts.mapInArrow(describe, "lines int, good int, features binary, size binary")


def train(docs: DataFrame, labels: DataFrame) -> LineField | None:
    """The field learnt from labelled documents, or None unless both labels occur."""
    sample = training_sample(docs, labels).limit(4 * PER_LABEL).toPandas()
    sample = sample.sort_values(["good", "features"], kind="stable")
    good = sample["good"].to_numpy()
    if len(set(good.tolist())) < 2:
        return None
    features = np.frombuffer(b"".join(sample["features"])).reshape(-1, FEATURES)
    size = np.frombuffer(b"".join(sample["size"]), np.int64)
    field = LineField()
    field.fit(features, size, sample["lines"].to_numpy().astype(np.int64), good)
    return field


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    least: float = LEAST_SCORE,
) -> DataFrame:
    """``docs`` plus quality_score (0 to 1) and predicted (1 if the score reaches ``least``).

    ``labels`` are the rows to learn from; ids with both labels are left out. Null texts count as
    empty, which is one empty line. Unless both labels can be learnt every score is 0.5. Rows,
    repeated or not, keep their columns; added names that clash get underscores.
    """
    bodies = only(docs, doc_id=doc_id, body=text).withColumn("body", F.col("body").cast("binary"))
    field = train(bodies, only(labels, doc_id=doc_id, quality=quality))
    scored, named = fresh_name(docs.columns, "quality_score"), fresh_name(docs.columns, "predicted")
    at_text = docs.columns.index(text)
    schema = docs.withColumn(scored, F.lit(0.0)).schema
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column(at_text).cast(pa.binary()).to_pylist()]
            scores = np.full(len(texts), 0.5)
            if sent.value:
                for part in _slabs(texts):
                    found = sent.value.goodness(*line_features(texts[part]))
                    scores[part] = sent.value.score(found)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, scored])

    return docs.mapInArrow(run, schema).withColumn(named, (F.col(scored) >= least).cast("int"))


def _slabs(texts: list[bytes]):
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= SLAB_BYTES:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents predicted good, with their own columns, whatever their names.

    Null and empty texts are scored like any other text; repeated rows and ids are judged each
    by its text, so ties and copies share a verdict. Labels without a document, with a null
    or repeated as the model's docstring says; an empty table stays empty.
    """
    named = fresh_name(docs.columns, "predicted")
    kept = score_quality(docs, labels).where(F.col(named) == 1)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
