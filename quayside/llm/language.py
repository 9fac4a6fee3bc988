"""Language identification with a small convolutional network over bytes.

A text is its UTF-8 bytes, ASCII letters in lower case, cut into windows of ``WINDOW``
bytes; the last one is filled up with zeros.  A window's bytes are embedded, filters of
several widths slide over them, each filter keeps its largest response, and a softmax over
these gives the probability of each language.  A text's probabilities are the mean over
its windows, weighted by their bytes, so every byte of a text counts.

Training is plain numpy on the driver, on about ``languages * DOCS_PER_LANGUAGE *
WINDOWS_PER_DOC`` windows and never more than twice as many, however large the table.  For prediction the embedding and each
filter's weights are multiplied out into tables over pairs of bytes, so that a response is
the sum of at most two rows looked up.

``und`` with score 0 is the answer for a null text and for one without a letter, and for
every text if nothing could be learned.  Any other score is the probability of the language
named.  Documents without language, and texts without a letter, teach nothing.  Only
``doc_id``, ``text`` and, for training, ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.batches import bounded

UNDETERMINED = "und"
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDED = 8
DOCS_PER_LANGUAGE = 1000
WINDOWS_PER_DOC = 3
STEPS = 900
BATCH = 96
SEED = 42
PREDICTED = "doc_id bigint, lang_pred string, score double"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CHUNK = 2048  # windows looked up at a time


@dataclass
class Network:
    """languages, embedding (256, E), filters by width (width * E, F), biases, softmax layer."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    offset: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.weights, self.offset]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(text: bytes) -> np.ndarray:
    """The text's bytes as rows of one window each, lower case, filled with zeros."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    rows = -(-len(data) // WINDOW)
    filled = np.zeros(rows * WINDOW, np.uint8)
    filled[: len(data)] = data
    return filled.reshape(rows, WINDOW)


def new_network(languages: list[str], rng: np.random.Generator) -> Network:
    return Network(
        languages,
        rng.normal(0, 0.5, (256, EMBEDDED)),
        [rng.normal(0, (w * EMBEDDED) ** -0.5, (w * EMBEDDED, FILTERS)) for w in WIDTHS],
        [np.zeros(FILTERS) for _ in WIDTHS],
        rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))),
        np.zeros(len(languages)),
    )


def _step(net: Network, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """The gradients of the mean cross-entropy, in the order of ``Network.parameters``."""
    n = len(windows)
    embedded = net.embedding[windows]
    rows = np.arange(n)[:, None]
    tops, places = [], []
    for width, filters, bias in zip(WIDTHS, net.filters, net.biases):
        slices = [embedded[:, i : WINDOW - width + 1 + i] for i in range(width)]
        responses = np.concatenate(slices, axis=2) @ filters + bias
        place = responses.argmax(axis=1)
        top = np.take_along_axis(responses, place[:, None], axis=1)[:, 0]
        tops.append(np.maximum(top, 0))
        places.append(place)
    pooled = np.concatenate(tops, axis=1)
    error = softmax(pooled @ net.weights + net.offset)
    error[np.arange(n), labels] -= 1
    error /= n
    back = (error @ net.weights.T) * (pooled > 0)
    d_embedding = np.zeros_like(net.embedding)
    d_filters, d_biases = [], []
    for k, (width, filters) in enumerate(zip(WIDTHS, net.filters)):
        part = back[:, k * FILTERS : (k + 1) * FILTERS]
        seen = np.stack([windows[rows, places[k] + i] for i in range(width)], axis=2)  # n, F, width
        inputs = net.embedding[seen].reshape(n, FILTERS, width * EMBEDDED)
        d_filters.append(np.einsum("nf,nfe->ef", part, inputs))
        d_biases.append(part.sum(axis=0))
        d_inputs = (part[:, :, None] * filters.T[None]).reshape(n * FILTERS * width, EMBEDDED)
        np.add.at(d_embedding, seen.reshape(-1), d_inputs)
    return [d_embedding, *d_filters, *d_biases, pooled.T @ error, error.sum(axis=0)]


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = STEPS) -> Network:
    """Adam on batches with as many windows of each language; the same data give the same network."""
    rng = np.random.default_rng(SEED)
    net = new_network(languages, rng)
    by_language = [np.flatnonzero(labels == k) for k in range(len(languages))]
    each = max(4, BATCH // len(languages))
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(own, each) for own in by_language])
        rate = 0.01 * (1 - step / (steps + 1))
        for p, g, m, v in zip(net.parameters(), _step(net, windows[chosen], labels[chosen]), first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


class Predictor:
    """The network with embedding and filters multiplied out."""

    def __init__(self, net: Network):
        self.net = net
        self.tables = []
        for width, filters, bias in zip(WIDTHS, net.filters, net.biases):
            one = [net.embedding @ filters[i * EMBEDDED : (i + 1) * EMBEDDED] for i in range(width)]
            pairs = [one[i][:, None] + one[i + 1][None] for i in range(0, width - 1, 2)]
            pairs[0] = pairs[0] + bias
            rest = one[width - 1] if width % 2 else None
            self.tables.append(
                (
                    [p.reshape(65536, FILTERS).astype(np.float32) for p in pairs],
                    None if rest is None else rest.astype(np.float32),
                )
            )

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """One row of probabilities for each window."""
        found = []
        for i in range(0, len(windows), _CHUNK):
            chunk = windows[i : i + _CHUNK]
            pair = chunk[:, :-1].astype(np.uint16) << 8 | chunk[:, 1:]
            tops = []
            for width, (pairs, rest) in zip(WIDTHS, self.tables):
                n = WINDOW - width + 1
                responses = pairs[0][pair[:, :n]]
                for k, table in enumerate(pairs[1:], 1):
                    responses += table[pair[:, 2 * k : 2 * k + n]]
                if rest is not None:
                    responses += rest[chunk[:, width - 1 : width - 1 + n]]
                tops.append(np.maximum(responses.max(axis=1), 0))
            found.append(softmax(np.concatenate(tops, axis=1) @ self.net.weights + self.net.offset))
        return np.concatenate(found) if found else np.zeros((0, len(self.net.languages)))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict_texts(predictor: Predictor, texts: list[str | None]) -> list[tuple[str, float]]:
    answers: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(texts)
    if not predictor.net.languages:
        return answers
    chosen = [i for i, t in enumerate(texts) if t and has_letter(t)]
    encoded = [texts[i].encode("utf-8", "replace") for i in chosen]
    group: list[int] = []
    size = 0
    for k in range(len(chosen) + 1):
        # Short texts go through together, and a long one does not make others wait in memory.
        if group and (k == len(chosen) or size + len(encoded[k]) > WINDOW * _CHUNK):
            _answer(predictor, [encoded[j] for j in group], [chosen[j] for j in group], answers)
            group, size = [], 0
        if k < len(chosen):
            group.append(k)
            size += len(encoded[k]) + WINDOW
    return answers


def _answer(predictor: Predictor, texts: list[bytes], places: list[int], answers: list) -> None:
    parts = [windows_of(t) for t in texts]
    each = predictor.probabilities(np.concatenate(parts))
    start = 0
    for text, part, place in zip(texts, parts, places):
        weight = np.full(len(part), WINDOW, np.float64)
        weight[-1] = len(text) - WINDOW * (len(part) - 1)
        mean = weight @ each[start : start + len(part)] / weight.sum()
        start += len(part)
        best = int(mean.argmax())
        answers[place] = (predictor.net.languages[best], float(min(mean[best], 1.0)))


def training_windows(docs: DataFrame, learn_from: Column) -> list[tuple[str, bytes]]:
    """(lang, window) from a sample of bounded size, about as many documents for each language.

    A document is chosen by a hash of its id, with a share that follows from the number of
    documents of its language; its windows begin at places that follow from the hash too.
    """
    labelled = docs.where(learn_from & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    labelled = labelled.select("doc_id", "text", "lang")
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return []
    spread = 1 << 30
    share = F.create_map(
        *[F.lit(x) for k, n in counts.items() for x in (k, int(min(1.0, DOCS_PER_LANGUAGE / n) * spread))]
    )
    draw = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(SEED))
    chosen = labelled.where(F.pmod(draw, F.lit(spread)) < share[F.col("lang")])
    places = F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1
    starts = [(F.pmod(F.xxhash64("doc_id", F.lit(k)), places) + 1).cast("int") for k in range(WINDOWS_PER_DOC)]
    pieces = chosen.select("lang", "text", F.explode(F.array_distinct(F.array(*starts))).alias("start")).select(
        "lang", F.substring("text", F.col("start"), F.lit(WINDOW)).alias("piece")
    )
    limit = 2 * DOCS_PER_LANGUAGE * WINDOWS_PER_DOC * len(counts)
    rows = pieces.limit(limit).collect()
    return sorted((r["lang"], r["piece"].encode("utf-8", "replace")[:WINDOW]) for r in rows)


def fit(docs: DataFrame, learn_from: Column) -> Network:
    """The network learned from the documents that ``learn_from`` names."""
    examples = [(lang, w) for lang, w in training_windows(docs, learn_from) if w.strip()]
    languages = sorted({lang for lang, _ in examples})
    if not languages:
        return new_network([], np.random.default_rng(SEED))
    windows = np.concatenate([windows_of(w) for _, w in examples])
    labels = np.array([languages.index(lang) for lang, _ in examples])
    return train(windows, labels, languages)


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, lang_pred, score of every document."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(net)
        for batch in batches:
            answers = predict_texts(predictor, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([a[0] for a in answers], pa.string()),
                    pa.array([a[1] for a in answers], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return bounded(rows).mapInArrow(answer, PREDICTED)


def keep_identified(docs: DataFrame, net: Network) -> DataFrame:
    """The documents in one of the learned languages, with their columns as they are.

    Columns of any name stay.  A network that has learned no language, for want of labelled
    documents, can tell none apart: then all documents with a letter stay.
    """
    if not net.languages:
        return docs.where(F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)))
    columns = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(columns))])  # names with dots cannot go to Python

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(net)
        for batch in batches:
            answers = predict_texts(predictor, batch.column(columns.index("text")).to_pylist())
            yield batch.filter(pa.array([a[0] != UNDETERMINED for a in answers], pa.bool_()))

    return bounded(plain).mapInArrow(answer, plain.schema).toDF(*columns)
