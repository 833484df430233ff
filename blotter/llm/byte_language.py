"""Language identification by a byte convolutional network, written in numpy.

A text is cut into windows of ``WINDOW`` bytes that overlap by the widest filter less one, so every
byte n-gram of the whole text lies in one window. Bytes are embedded, filters of several widths
run over them, each filter keeps its maximum over the window, and a softmax layer gives the
languages; a document's probabilities are the softmax of its windows' mean scores, weighted by
their bytes.

Training takes a bounded sample on the driver: about ``PER_LANGUAGE`` texts of every language, or
equal shares of ``SAMPLE_ROWS`` when there are many languages, but about ``LEAST_ROWS`` each and
never none. Texts are chosen by a hash of themselves, equal ones once, ``WINDOWS_PER_DOC`` windows
each, spread over the whole text and cut out in tasks. The gradient of a maximum reaches one position, so a step costs little more than the
forward pass. A text in no learnt language can still score high, as the softmax only compares the
learnt ones; so the sample also gives the chances of byte pairs, and for each language how far a
window's mean log chance falls below the usual, learnt on one half and taken on the other.
For prediction embedding and filters are multiplied out into look-up tables for
single bytes and byte pairs. Prediction is one pass over all documents, no shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import fresh_name, only

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
PER_LANGUAGE = 300
SAMPLE_ROWS = 64 * 300
LEAST_ROWS = 10
WINDOWS_PER_DOC = 6
EPOCHS = 4
RATE = 0.01
SEED = 7
# Of a language's windows, the share that may lie lower than the bound before the margin, and the
# least fall in bits that the bound starts from.
LOWEST = 0.005
MARGIN = 1.5
LEAST_FALL = 1.0
UNKNOWN = "und"
# Windows that go through the network at once.
SLAB = 64


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def windows(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text, padded with zeros, and the number of bytes of each."""
    hop = WINDOW - max(WIDTHS) + 1
    n = max(1, -(-(len(text) - WINDOW) // hop) + 1)
    padded = np.zeros(hop * (n - 1) + WINDOW, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    found = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::hop]
    sizes = np.minimum(WINDOW, len(text) - hop * np.arange(n))
    return found, np.maximum(sizes, 1)


class ByteNetwork:
    def __init__(self, languages: list[str]):
        rng = np.random.default_rng(SEED)
        self.languages = languages
        self.embed = rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)
        self.filters = [
            rng.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS
        ]
        self.shift = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.dense = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    # ---- training

    def _forward(self, batch: np.ndarray):
        vectors = self.embed[batch]
        n = len(batch)
        peaks, places = [], []
        for width, weights in zip(WIDTHS, self.filters, strict=True):
            span = WINDOW - width + 1
            grams = np.concatenate([vectors[:, i : i + span] for i in range(width)], 2)
            heights = (grams.reshape(n * span, -1) @ weights).reshape(n, span, FILTERS)
            place = heights.argmax(1)
            places.append(place)
            peaks.append(np.take_along_axis(heights, place[:, None], 1)[:, 0])
        pooled = np.concatenate(peaks, 1) + self.shift
        hidden = np.maximum(pooled, 0)
        return vectors, places, hidden, hidden @ self.dense + self.bias

    def fit(self, found: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
        """Adam on the weighted cross-entropy; the order of the batches is fixed."""
        rng = np.random.default_rng(SEED)
        values = [self.embed, *self.filters, self.shift, self.dense, self.bias]
        moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(found))
            for at in range(0, len(order), 32):
                step += 1
                some = order[at : at + 32]
                gradients = self._gradients(found[some], label[some], weight[some])
                rate = RATE / (1 + epoch)
                for v, (m, s), g in zip(values, moments, gradients, strict=True):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-7)

    def _gradients(self, batch: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        vectors, places, hidden, scores = self._forward(batch)
        n = len(batch)
        error = softmax(scores)
        error[np.arange(n), label] -= 1
        error *= (weight / weight.sum())[:, None].astype(np.float32)
        d_hidden = error @ self.dense.T * (hidden > 0)
        d_embed = np.zeros_like(self.embed)
        d_filters = []
        rows = np.arange(n)[:, None]
        for i, (width, weights) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            d_peak = d_hidden[:, i * FILTERS : (i + 1) * FILTERS]
            at = places[i][:, :, None] + np.arange(width)
            gram = vectors[rows[:, :, None], at].reshape(n, FILTERS, -1)
            d_filters.append(np.einsum("nf,nfe->ef", d_peak, gram))
            d_gram = (d_peak[:, :, None] * weights.T).reshape(n, FILTERS, width, EMBEDDING)
            np.add.at(d_embed, batch[rows[:, :, None], at], d_gram)
        return [d_embed, *d_filters, d_hidden.sum(0), hidden.T @ error, error.sum(0)]

    # ---- prediction

    def tables(self) -> "Tables":
        return Tables(self)


class Pairs:
    """How usual the byte pairs of a text are, and how unusual those of a learnt language get.

    A deviation is the mean log2 chance of the pairs less the language's mean, times the root of
    the share of a window that the text fills, so a short text has to be odder to fall out.
    """

    def __init__(self, found: np.ndarray, size: np.ndarray, label: np.ndarray, weight: np.ndarray, n: int):
        half = np.zeros(len(found), bool)
        half[::2] = True
        usual = np.empty(len(found))
        for part in (half, ~half):
            table = self._learn(found[part], size[part], weight[part]) if part.any() else np.zeros(1 << 16)
            usual[~part] = [self._mean(table, w[:s]) for w, s in zip(found[~part], size[~part], strict=True)]
        self.table = self._learn(found, size, weight)
        self.centre = np.array([np.median(usual[label == k]) for k in range(n)])
        fallen = (usual - self.centre[label]) * np.sqrt(size / WINDOW)
        lowest = [np.quantile(fallen[label == k], LOWEST, method="lower") for k in range(n)]
        self.bound = MARGIN * np.minimum(lowest, -LEAST_FALL)

    @staticmethod
    def _learn(found: np.ndarray, size: np.ndarray, weight: np.ndarray) -> np.ndarray:
        seen = np.zeros(1 << 16)
        inside = np.arange(WINDOW - 1)
        for at in range(0, len(found), 4096):
            some = found[at : at + 4096].astype(np.int32)
            real = inside < size[at : at + 4096, None] - 1
            seen += np.bincount(
                (some[:, :-1] << 8 | some[:, 1:])[real],
                np.broadcast_to(weight[at : at + 4096, None], real.shape)[real],
                1 << 16,
            )
        return np.log2(0.99 * seen / max(seen.sum(), 1e-9) + 0.01 / (1 << 16))

    @staticmethod
    def _mean(table: np.ndarray, text: np.ndarray) -> float:
        joined = text[:-1].astype(np.int32) << 8 | text[1:]
        return float(table.take(joined).mean()) if len(joined) else 0.0

    def usual(self, text: bytes, language: int) -> bool:
        if len(text) < 2:
            return True
        fallen = self._mean(self.table, np.frombuffer(text, np.uint8)) - self.centre[language]
        return bool(fallen * min(1.0, len(text) / WINDOW) ** 0.5 >= self.bound[language])


class Tables:
    """The network with embedding and filters multiplied out, for prediction."""

    def __init__(self, network: ByteNetwork):
        self.languages = network.languages
        self.shift, self.dense, self.bias = network.shift, network.dense, network.bias
        self.pairs, self.singles = [], []
        for width, weights in zip(WIDTHS, network.filters, strict=True):
            single = [network.embed @ w for w in np.split(weights, width)]
            pairs = [
                (single[i][:, None] + single[i + 1][None]).reshape(1 << 16, FILTERS) for i in range(0, width - 1, 2)
            ]
            self.pairs.append(pairs)
            self.singles.append(single[-1] if width % 2 else None)

    def hidden(self, found: np.ndarray) -> np.ndarray:
        out = np.empty((len(found), len(self.shift)), np.float32)
        for at in range(0, len(found), SLAB):
            batch = found[at : at + SLAB]
            joined = batch[:, :-1].astype(np.int32) << 8 | batch[:, 1:]
            peaks = []
            for width, pairs, single in zip(WIDTHS, self.pairs, self.singles, strict=True):
                span = WINDOW - width + 1
                heights = pairs[0].take(joined[:, :span], 0)
                for k, more in enumerate(pairs[1:], 1):
                    heights += more.take(joined[:, 2 * k : 2 * k + span], 0)
                if single is not None:
                    heights += single.take(batch[:, width - 1 :], 0)
                peaks.append(heights.max(1))
            out[at : at + SLAB] = np.maximum(np.concatenate(peaks, 1) + self.shift, 0)
        return out

    def scores(self, found: np.ndarray) -> np.ndarray:
        return self.hidden(found) @ self.dense + self.bias

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language and its probability, for texts with bytes."""
        cut = [windows(t) for t in texts]
        sizes = np.concatenate([s for _, s in cut]).astype(np.float64)
        starts = np.cumsum([0, *(len(s) for _, s in cut[:-1])])
        # The mean of the scores is the score of the mean, whose size does not grow with the languages.
        hidden = np.concatenate([self.hidden(f) for f in grouped([f for f, _ in cut])])
        total = np.add.reduceat(hidden * sizes[:, None], starts, axis=0)
        mean = total / np.add.reduceat(sizes, starts)[:, None]
        chances = softmax(mean @ self.dense + self.bias)
        best = chances.argmax(1)
        return best, chances[np.arange(len(best)), best]


def grouped(parts: list[np.ndarray]):
    """Short texts' windows joined into slabs."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part)
        if n >= SLAB:
            yield np.concatenate(held)
            held, n = [], 0
    if held:
        yield np.concatenate(held)


def softmax(scores: np.ndarray) -> np.ndarray:
    chances = np.exp(scores - scores.max(1, keepdims=True))
    return chances / chances.sum(1, keepdims=True)


# -------------------------------------------------------------------- jobs


def training_windows(rows: DataFrame) -> DataFrame:
    """(lang, window, size) of the sample, each once; ``rows`` has body and lang."""
    place = F.pmod(F.xxhash64(F.lit("sample"), "body"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    usable = rows.where("lang IS NOT NULL AND octet_length(body) > 0")
    usable = usable.select("lang", "body", place.alias("_place"))
    counts = usable.select("lang", "_place").distinct().groupBy("lang")
    # One row per language, as the network has one class per language; the texts stay in their tasks.
    found = counts.agg(F.count(F.lit(1)).alias("texts"), F.min("_place").alias("first")).collect()
    about = max(LEAST_ROWS, min(PER_LANGUAGE, SAMPLE_ROWS // max(1, len(found))))
    upto = pa.table(
        {
            "lang": pa.array([r["lang"] for r in found], pa.string()),
            "_upto": pa.array([max(r["first"], about / r["texts"]) for r in found], pa.float64()),
        }
    )
    shares = F.broadcast(rows.sparkSession.createDataFrame(upto))

    def cut(batches):
        for batch in batches:
            lang, found, size = [], [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts, sizes = windows(text)
                some = np.unique(np.linspace(0, len(parts) - 1, WINDOWS_PER_DOC).astype(int))
                for i in some:
                    lang.append(name)
                    found.append(parts[i].tobytes())
                    size.append(int(sizes[i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(found, pa.binary()), pa.array(size, pa.int32())],
                ["lang", "window", "size"],
            )

    texts = usable.join(shares, "lang").where("_place <= _upto").select("lang", "body")
    return texts.mapInArrow(cut, "lang string, window binary, size int").distinct()


def train(rows: DataFrame) -> ByteNetwork | None:
    """A network from rows (doc_id, body, lang), or None if no row can teach."""
    sample = training_windows(rows).toPandas()
    if not len(sample):
        return None
    sample = sample.sort_values(["lang", "window"], kind="stable")
    languages = sorted(sample["lang"].unique())
    label = np.searchsorted(languages, sample["lang"].to_numpy())
    found = np.frombuffer(b"".join(sample["window"]), np.uint8).reshape(-1, WINDOW)
    # Each language weighs the same.
    weight = 1.0 / np.bincount(label)[label]
    network = ByteNetwork(languages)
    network.fit(found, label, weight * len(label))
    network.pairs = Pairs(found, sample["size"].to_numpy(), label, weight, len(languages))
    return network


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict_languages(
    docs: DataFrame,
    learn_from: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    least: float | None = None,
) -> DataFrame:
    """``docs`` plus lang_pred and lang_score.

    With ``least``, only rows whose language is known: it is not ``und``, its score lies at least
    that share of the way from chance (one by the number of languages) to 1, and the text's byte
    pairs are as usual as those of the language's sample.

    Learns from the rows where ``learn_from`` holds and the language is not null, and predicts from
    the text alone. Null texts and texts without a letter are ``und`` with score 0, and so is
    everything when no row can teach. Rows, repeated or not, keep their columns; added names that
    clash get underscores.
    """
    teaching = only(docs.where(learn_from), doc_id=doc_id, body=text, lang=lang)
    network = train(teaching.withColumn("body", F.col("body").cast("binary")))
    named, scored = fresh_name(docs.columns, "lang_pred"), fresh_name(docs.columns, "lang_score")
    at_text = docs.columns.index(text)
    schema = docs.withColumns({named: F.lit(""), scored: F.lit(0.0)}).schema
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        tables = sent.value.tables() if sent.value else None
        for batch in batches:
            lang_pred, score = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            known = [False] * batch.num_rows
            texts = batch.column(at_text).to_pylist()
            able = [i for i, t in enumerate(texts) if tables and t and has_letter(t)]
            for at in range(0, len(able), 256):
                some = able[at : at + 256]
                best, chance = tables.predict([texts[i].encode() for i in some])
                for i, b, c in zip(some, best.tolist(), chance.tolist(), strict=True):
                    lang_pred[i], score[i] = tables.languages[b], min(1.0, max(0.0, c))
                    if least is not None:
                        chance_alone = 1 / len(tables.languages)
                        clear = score[i] >= chance_alone + least * (1 - chance_alone)
                        known[i] = clear and sent.value.pairs.usual(texts[i].encode(), b)
            out = pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang_pred, pa.string()), pa.array(score, pa.float64())],
                [*batch.schema.names, named, scored],
            )
            yield out if least is None else out.filter(pa.array(known, pa.bool_()))

    return docs.mapInArrow(run, schema)


def keep_known_languages(docs: DataFrame, least: float = 1 / 15) -> DataFrame:
    """Documents with a letter in a learnt language (see ``predict_languages``); own columns.

    A score of 1/15 of the way is 0.3 with four languages. Null and empty texts and texts without
    a letter go; equal texts share a verdict, so repeated rows all stay or all go. Without any
    language to learn from, and from an empty table, nothing stays.
    """
    found = predict_languages(docs, fold(F.col("doc_id"), 4) != 2, least=least)
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
