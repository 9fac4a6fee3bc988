"""Scores of texts under a subword model that sums over all segmentations.

A text is its words, ASCII letters in lower case, and one end.  The pieces of an existing
vocabulary are drawn independently, each with its own probability, until the end is drawn.
A word is the sum over all ways to spell it, with the mark of a word's beginning, by pieces;
a character that is no piece itself is spelled by its byte pieces.  The sum is taken by a
forward recursion in log space over the lattice of pieces.  The probability of a text is the
product over its words and the end.

The probabilities follow the training documents: every word is segmented once by the
vocabulary's own merges, its pieces are counted as often as the word occurs, and ``ALPHA``
is added to every piece, so that each text has a positive probability.  All words of all
training documents count.

Each distinct word is scored once, in a table that Spark shuffles by word.  Words that make
up at least 1 / ``FREQUENT`` of all tokens, which can be no more than ``FREQUENT``, are sent
to every task, which also takes the hot keys out of the join; the others are joined.

``base_score`` is the add-0.1 unigram score over whole words.  A null or empty text has one
token, the end.  Without training documents all pieces are alike and the base score is that
of an empty vocabulary.  Rows that repeat a doc_id, or have none, are documents like any
other.  Only doc_id and text are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import exp, log, log10

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.batches import bounded
from quayside.session import cut_lineage

VOCABULARY = "piece_bpe_32k.model"
BEGIN = "▁"  # the vocabulary's mark of a word's beginning
ALPHA = 0.1
BASE_ALPHA = 0.1
FREQUENT = 1_000_000
LONGEST_SENT = 64  # bytes of a word that is sent to every task
COUNTED_AT_ONCE = 200_000  # distinct words a task counts before it passes them on

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_LN10 = log(10.0)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _processor(path: str | None):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path or default_vocabulary())


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_LOWER).split()


class Lattice:
    """Marginal log-probabilities of words; ``scores`` are natural logarithms by piece."""

    def __init__(self, scores: dict[str, float]):
        self.bytes = [scores[f"<0x{b:02X}>"] for b in range(256)]
        # Every beginning of a piece, with the score of the piece that it is, if it is one.
        self.table: dict[str, float | None] = {}
        for piece, score in scores.items():
            if not (len(piece) == 6 and piece.startswith("<0x")):
                for n in range(1, len(piece)):
                    self.table.setdefault(piece[:n], None)
                self.table[piece] = score

    def log_probability(self, word: str) -> float:
        spelled, get, table = BEGIN + word, self.table.get, self.table
        n = len(spelled)
        arrivals: list[list[float]] = [[] for _ in range(n + 1)]
        arrivals[0].append(0.0)
        for i in range(n):
            # Every position is reached, by bytes if by nothing else.
            forward = log_sum(arrivals[i])
            arrivals[i] = []
            single = get(spelled[i])
            if single is None:
                spelled_bytes = spelled[i].encode("utf-8", "replace")
                arrivals[i + 1].append(forward + sum(self.bytes[b] for b in spelled_bytes))
            else:
                arrivals[i + 1].append(forward + single)
            j = i + 2
            while j <= n and (beginning := spelled[i:j]) in table:
                score = table[beginning]
                if score is not None:
                    arrivals[j].append(forward + score)
                j += 1
        return log_sum(arrivals[n])


def log_sum(values: list[float]) -> float:
    if len(values) == 1:
        return values[0]
    top = max(values)
    return top + log(sum([exp(v - top) for v in values]))


def _text_rows(docs: DataFrame, train: Column) -> DataFrame:
    return bounded(docs).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )


def _batch(columns: dict, types: dict) -> pa.RecordBatch:
    arrays = [
        pa.array(v, pa.binary()).cast(pa.string()) if types[k] == pa.string() else pa.array(v, types[k])
        for k, v in columns.items()
    ]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {"word": pa.string(), "train": pa.int64(), "total": pa.int64()}
    train: Counter[bytes] = Counter()
    rest: Counter[bytes] = Counter()

    def flush():
        words = list(train.keys() | rest.keys())
        yield _batch(
            {"word": words, "train": [train[w] for w in words], "total": [train[w] + rest[w] for w in words]}, types
        )
        train.clear()
        rest.clear()

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for text, learn in zip(texts, batch.column("train").to_pylist()):
            (train if learn else rest).update(words_of(text.as_py()))
            if len(train) + len(rest) >= COUNTED_AT_ONCE:
                yield from flush()
    if train or rest:
        yield from flush()


def count_words(rows: DataFrame) -> DataFrame:
    """word, train, total: how often each word occurs in training documents and in all."""
    counted = rows.mapInArrow(_count, "word string, train bigint, total bigint")
    return counted.groupBy("word").agg(F.sum("train").alias("train"), F.sum("total").alias("total"))


def count_pieces(words: DataFrame, vocabulary: str | None = None) -> np.ndarray:
    """How often each piece occurs in the training words, segmented by the vocabulary's merges."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = _processor(vocabulary)
        counts = np.zeros(processor.vocab_size(), np.int64)
        for batch in batches:
            ids = processor.encode(batch.column("word").to_pylist(), num_threads=1)
            times = np.repeat(batch.column("train").to_numpy(), [len(x) for x in ids])
            np.add.at(counts, np.fromiter((i for x in ids for i in x), np.int64, len(times)), times)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["piece", "n"])

    counts = np.zeros(_processor(vocabulary).vocab_size(), np.int64)
    found = words.where("train > 0").select("word", "train").mapInArrow(count, "piece bigint, n bigint")
    # No more rows than the vocabulary has pieces.
    for row in found.groupBy("piece").agg(F.sum("n").alias("n")).collect():
        counts[row["piece"]] = row["n"]
    return counts


def piece_scores(counts: np.ndarray, n_ends: int, vocabulary: str | None = None) -> tuple[dict[str, float], float]:
    """Natural logarithms of the probabilities of all pieces, and of the end."""
    processor = _processor(vocabulary)
    pieces = {
        i: processor.id_to_piece(i)
        for i in range(processor.vocab_size())
        if not processor.is_control(i) and not processor.is_unknown(i)
    }
    total = sum(int(counts[i]) for i in pieces) + n_ends + ALPHA * (len(pieces) + 1)
    scores = {piece: log((int(counts[i]) + ALPHA) / total) for i, piece in pieces.items()}
    return scores, log((n_ends + ALPHA) / total)


def score_words(words: DataFrame, scores: dict[str, float]) -> DataFrame:
    """word, train, total and score, the marginal log10 probability."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(scores)
        for batch in batches:
            found = [lattice.log_probability(w) / _LN10 for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "score"]
            )

    return words.mapInArrow(score, "word string, train bigint, total bigint, score double")


def _split(known: dict[bytes, tuple[bool, float, float]]):
    """One row for each rare word of a document, and one, with a name no word has, of the rest.

    ``known`` has, for each frequent word, whether it is known, its base score and its score.
    """
    types = {
        "row": pa.int64(),
        "word": pa.string(),
        "n": pa.int64(),
        "doc_id": pa.int64(),
        "n_tokens": pa.int64(),
        "n_known": pa.int64(),
        "base_score": pa.float64(),
        "score": pa.float64(),
    }
    names = list(types)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 33
        get = known.get
        columns: list[list] = [[] for _ in names]
        add_row, add_word, add_n = columns[0].append, columns[1].append, columns[2].append
        summaries: list[tuple[int, tuple]] = []

        def flush():
            size = len(columns[0])
            rest = [[None] * size for _ in names[3:]]
            for at, values in summaries:
                for column, value in zip(rest, values):
                    column[at] = value
            yield _batch(dict(zip(names, [*columns[:3], *rest])), types)
            for column in columns:
                column.clear()
            summaries.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                words = Counter(words_of(text.as_py()))
                n_known, base, score = 0, 0.0, 0.0
                for word, n in words.items():
                    found = get(word)
                    if found is None:
                        add_row(row)
                        add_word(word)
                        add_n(n)
                    else:
                        n_known += n * found[0]
                        base += n * found[1]
                        score += n * found[2]
                summaries.append((len(columns[0]), (doc_id, words.total() + 1, n_known, base, score)))
                add_row(row)
                add_word(b" %d" % row)
                add_n(0)
                row += 1
                if len(columns[0]) >= COUNTED_AT_ONCE:
                    yield from flush()
        if columns[0]:
            yield from flush()

    ddl = (
        "row bigint, word string, n bigint, doc_id bigint, n_tokens bigint, n_known bigint, "
        "base_score double, score double"
    )
    return split, ddl


def score_texts(docs: DataFrame, train: Column, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every document."""
    rows = _text_rows(docs, train)
    words = cut_lineage(count_words(rows))
    ends = rows.where("train").count()
    totals = words.agg(F.sum("train"), F.sum("total"), F.count(F.when(F.col("train") > 0, 1))).first()
    train_tokens, all_tokens = (totals[0] or 0) + ends, (totals[1] or 0)
    base_total = train_tokens + BASE_ALPHA * (totals[2] + (ends > 0) + 1)

    scores, end_score = piece_scores(count_pieces(words, vocabulary), ends, vocabulary)
    scored = cut_lineage(score_words(words, scores))
    frequent = scored.where(
        (F.col("total") * FREQUENT >= all_tokens) & (F.octet_length("word") <= LONGEST_SENT)
    ).collect()
    known = {
        r["word"].encode(): (r["train"] > 0, log10((r["train"] + BASE_ALPHA) / base_total), r["score"])
        for r in frequent
    }
    split, ddl = _split(known)
    parts = rows.select("doc_id", "text").mapInArrow(split, ddl)
    joined = parts.join(scored.select("word", "train", F.col("score").alias("word_score")), "word", "left")
    base = F.log10((F.col("train") + BASE_ALPHA) / F.lit(base_total))
    nothing = F.lit(0.0)
    found = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("n_known", F.lit(0)) + F.when(F.col("train") > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.coalesce("base_score", nothing) + F.coalesce(F.col("n") * base, nothing)).alias("base_score"),
        F.sum(F.coalesce("score", nothing) + F.coalesce(F.col("n") * F.col("word_score"), nothing)).alias("score"),
    )
    return found.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + (1 if ends else 0)).alias("n_known"),
        F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + log10((ends + BASE_ALPHA) / base_total)).alias("base_score"),
        (F.col("score") + end_score / _LN10).alias("score"),
    )
