"""Token ids, packing and binary output: against the tokenizer and brute force."""

import json
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from quayside.llm import config_packing, token_output, tokens

SF = "/root/testdata/sf0.001"
TEXTS = [
    "", None, " \n\t", "It's I'LL don't A1B2 ÉtÉ é İ ΣΣ ß", "a" * 5_000, "word " * 9_000, "<|endoftext|>a <|startoftext|>",
    "ﬁ Å ẞ 中文 \U0001f600 a\x00b a\x1cb x\x01y", "´ ` ¨a x́ ́x  x　y z", "ª º µ ÿ Ÿ × ÷", "'s's 'S 're'll", "12,345.67 $$$***",
]


def plain_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokens.default_path())


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode((text or "").encode()), "<u4").tolist()


@pytest.mark.parametrize("remembered", [3, tokens.REMEMBERED])
def test_ids_are_those_of_the_tokenizer(tokenizer, remembered):
    encoder = tokens.WordEncoder(remembered=remembered)
    texts = [t for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()]
    for text in TEXTS + (texts if remembered > 3 else texts[:5]):
        assert ids_of(encoder, text) == plain_ids(tokenizer, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aeéÉñ 's.,\n ́<|>09")), max_size=40))
def test_ids_of_any_text(text):
    encoder = tokens.encoder()
    assert ids_of(encoder, text) == plain_ids(encoder.tokenizer, text)


def test_new_words_of_many_texts_are_learned_in_one_go(tokenizer, monkeypatch):
    encoder = tokens.WordEncoder()
    learned = []
    learn = encoder._learn_simple
    monkeypatch.setattr(encoder, "_learn_simple", lambda words, lines: learned.append(len(words)) or learn(words, lines))
    texts = [f"word{i} and Word{i}'s é{i}" for i in range(500)] + [t or "" for t in TEXTS]
    found = list(encoder.encode_all(t.encode() for t in texts))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [plain_ids(tokenizer, t) for t in texts]
    assert len(learned) == 1 and learned[0] > 1_500


def test_every_token_is_what_its_own_text_is_encoded_to(tokenizer):
    """Then joining neighbours by the rank of their union is the same as by named pairs."""
    with open(tokens.default_path(), encoding="utf-8") as file:
        model = json.load(file)["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    assert len({a + b for a, b in merges}) == len(merges)
    inner = models.BPE(vocab=model["vocab"], merges=merges)
    for a, b in merges:
        token = a + b
        if token.endswith(tokens.END):
            found = tokenizer.model.tokenize(token.removesuffix(tokens.END))
        else:
            found = inner.tokenize(token)
        assert [t.value for t in found] == [token]


# --- Segment tree and best fit decreasing


def slow_best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, r in enumerate(rooms) if r >= length]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(capacity - length)
    return sorted(capacity - r for r in rooms)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 70).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=80))))
def test_best_fit_with_the_segment_tree(case):
    capacity, lengths = case
    found = token_output.best_fit_decreasing(lengths, capacity)
    assert sorted(i for s in found for i in s) == list(range(len(lengths)))
    assert sorted(sum(lengths[i] for i in s) for s in found) == slow_best_fit(lengths, capacity)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 70).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=80))))
def test_best_fit_by_groups_is_best_fit(case):
    capacity, lengths = case
    plan = config_packing.best_fit(dict(Counter(lengths)), capacity)
    filled = sorted(sum(n * t for n, t in content) for content, copies in plan for _ in range(copies))
    assert filled == slow_best_fit(lengths, capacity)


def test_binary_rows_round_trip(spark, docs, tokenizer, tmp_path):
    table = docs(*enumerate(TEXTS), (3, "again"), (None, "no id"), schema="doc_id bigint, text string, ids string")
    path = str(tmp_path / "packed")
    token_output.write_packed(table, path, capacity=64, group_tokens=500)
    rows = spark.read.parquet(path).collect()
    pieces = defaultdict(list)
    for row in rows:
        ids = np.frombuffer(row.ids, "<u2")
        positions = np.frombuffer(row.positions, "<u2").tolist()
        ends = np.frombuffer(row.cu_seqlens, "<i4").tolist()
        assert len(ids) == len(positions) == 64 and ends[0] == 0 and ends[-1] == row.n_tokens <= 64
        lengths = np.diff(ends).tolist() + ([64 - row.n_tokens] if row.n_tokens < 64 else [])
        assert positions == [p for n in lengths for p in range(n)]
        assert set(ids[row.n_tokens :].tolist()) <= {token_output.END_ID}
        for k, (doc_id, piece, start) in enumerate(zip(row.doc_ids, row.pieces, row.starts)):
            pieces[doc_id].append((piece, start, ids[ends[k] : ends[k + 1]].tolist()))
    assert len({r.sequence_id for r in rows}) == len(rows)
    for doc_id, text in [*enumerate(TEXTS), (None, "no id")]:
        if doc_id != 3:
            whole = sorted(pieces[doc_id])
            assert [p for p, _, _ in whole] == list(range(len(whole)))
            joined = [i for _, _, ids in whole for i in ids]
            assert joined == plain_ids(tokenizer, text) + [token_output.END_ID]
            assert all(len(ids) == 64 and start == 64 * p for p, start, ids in whole[:-1])
    assert len(pieces[3]) == 2
    read = token_output.read_segments(spark, path).collect()
    assert all(r.positions_ok for r in read) and len(read) == sum(map(len, pieces.values()))
    assert token_output.packed(docs()).count() == 0


def test_wrong_positions_are_seen(spark, docs, tmp_path):
    path = str(tmp_path / "packed")
    packed = token_output.packed(docs((1, "a b c"), (2, "d")), capacity=16)
    packed.selectExpr("* except (positions)", "cast(repeat('x', 32) AS binary) AS positions").write.parquet(path)
    assert not any(r.positions_ok for r in token_output.read_segments(spark, path).collect())


# --- Configurations


def slow_knapsack(lengths, worth, most, capacity):
    best = {0: 0.0}
    for length, value, times in zip(lengths, worth, most):
        for _ in range(times):
            for used, got in list(best.items()):
                if used + length <= capacity:
                    best[used + length] = max(best.get(used + length, -1), got + value)
    return max(best.values())


@settings(max_examples=60, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(1, 12), st.integers(1, 9), st.integers(1, 4)), min_size=1, max_size=5, unique_by=lambda x: x[0]
    )
)
def test_knapsack(items):
    lengths, worth, most = (list(x) for x in zip(*items))
    found = config_packing.knapsack(np.array(lengths), np.array(worth, float), np.array(most), 17)
    value = dict(zip(lengths, worth))
    limit = dict(zip(lengths, most))
    assert sum(n * t for n, t in found) <= 17 and all(t <= limit[n] for n, t in found)
    assert sum(value[n] * t for n, t in found) == pytest.approx(slow_knapsack(lengths, worth, most, 17))


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece_once_and_needs_few_sequences(seed):
    rng = random.Random(seed)
    counts = Counter(rng.choice([rng.randint(1, 512), 512, rng.randint(200, 300)]) for _ in range(3_000))
    plan = config_packing.make_plan(counts, 512)
    used = Counter()
    for content, copies in plan:
        assert sum(n * t for n, t in content) <= 512
        used.update({n: t * copies for n, t in content} if len({n for n, _ in content}) == len(content) else {})
        if len({n for n, _ in content}) != len(content):
            for n, t in content:
                used[n] += t * copies
    assert used == counts
    assert sum(copies for _, copies in plan) <= len(slow_best_fit(counts.elements(), 512)) + 1


def test_plan_needs_fewer_sequences_than_best_fit_where_that_is_not_best():
    rng = random.Random(1)
    counts = Counter(rng.randint(100, 200) for _ in range(3_000))
    least = -(-sum(n * c for n, c in counts.items()) // 512)
    found = sum(copies for _, copies in config_packing.make_plan(counts, 512))
    assert found <= 1.015 * least and found < 0.98 * len(slow_best_fit(counts.elements(), 512))


def test_amounts_cover_lengths_with_little_more_than_the_least():
    counts = {60: 100, 40: 100, 50: 200, 30: 60, 10: 100}
    amounts = config_packing.fractional_cover(counts, 100, 500)
    for length, count in counts.items():
        assert sum(a * dict(c).get(length, 0) for c, a in amounts.items()) == pytest.approx(count)
    assert sum(amounts.values()) <= 1.1 * sum(n * c for n, c in counts.items()) / 100


def test_program_places_every_piece_if_all_lengths_occur():
    counts = {n: 40 + 100_000 // (n + 100) for n in range(1, config_packing.CAPACITY + 1)}
    used = Counter()
    amounts = config_packing.fractional_cover(counts, config_packing.CAPACITY)
    for content, copies in amounts.items():
        used.update({n: t * copies for n, t in content})
    assert used == counts
    assert sum(amounts.values()) <= 1.005 * sum(n * c for n, c in counts.items()) / config_packing.CAPACITY


def test_pack(spark, docs, tokenizer):
    table = docs(*enumerate(TEXTS), (3, "again"), (None, None), schema="doc_id bigint, text string, piece int, rank string")
    found = config_packing.pack(table, capacity=64).collect()
    texts = [*enumerate(TEXTS), (3, "again"), (None, None)]
    expected = []
    for doc_id, text in texts:
        ids = plain_ids(tokenizer, text) + [0]
        for k in range(0, len(ids), 64):
            piece = ids[k : k + 64]
            crc = zlib.crc32(np.array(piece, "<u4").tobytes())
            expected.append((doc_id, k // 64, k, len(piece), crc))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 64
    assert len(sequences) <= len(slow_best_fit([r.length for r in found], 64)) + 1
    assert config_packing.pack(docs()).count() == 0


def test_a_length_of_most_pieces_is_ranked_in_many_tasks(spark):
    rows = spark.range(6_000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "5L AS length", "1L AS ids_crc32")
    ranked = config_packing._ranked(rows.selectExpr("*", "cast(doc_id % 16 AS int) AS part"))
    assert sorted(r["rank"] for r in ranked.select("rank").collect()) == list(range(6_000))
    text = ranked._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert windows and all("part#" in line.split("ROWS")[0] for line in windows)


# --- Packing in order


def test_pieces_of_a_length_keep_their_order_and_sequences_follow_it():
    rng = random.Random(2)
    lengths = np.array([rng.choice([rng.randint(1, 64), 64, 20]) for _ in range(2_000)])
    plan = config_packing.make_plan(dict(Counter(lengths.tolist())), 64)
    sequence, offset = config_packing.in_order(lengths, plan)
    assert len(set(sequence.tolist())) == sequence.max() + 1 == sum(n for _, n in plan)
    filled = defaultdict(list)
    for s, o, n in zip(sequence.tolist(), offset.tolist(), lengths.tolist()):
        filled[s].append((o, n))
    for placed in filled.values():
        placed.sort()
        assert [o for o, _ in placed] == [sum(n for _, n in placed[:k]) for k in range(len(placed))]
        assert sum(n for _, n in placed) <= 64
    for n in set(lengths.tolist()):
        own = list(zip(sequence[lengths == n].tolist(), offset[lengths == n].tolist()))
        assert own == sorted(own)
    assert np.corrcoef(sequence, np.arange(len(lengths)))[0, 1] > 0.9


def test_windows_of_the_order_are_packed_one_after_the_other(spark, docs, tokenizer):
    rng = random.Random(3)
    rows = [(i, "word " * rng.randint(0, 90)) for i in range(300)] + [(7, None), (None, "a b"), (301, "x " * 700)]
    table = docs(*rows, schema="doc_id bigint, text string").repartition(5)
    by = [F.expr("coalesce(doc_id, 400) * 7919 % 1009").alias("at")]
    found = config_packing.pack_in_order(table, by, capacity=64, window_tokens=1_000).collect()
    plain = config_packing.pieces(table, 64).collect()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(tuple(r[c] for c in columns) for r in found) == Counter(map(tuple, plain))
    key = lambda r: ((400 if r.doc_id is None else r.doc_id) * 7919 % 1009, r.doc_id or 0, r.piece)
    before = 0
    windows = defaultdict(set)
    for r in sorted(found, key=key):
        assert r.sequence_id // 1_000 == before // 1_000 or r.doc_id == 7
        windows[before // 1_000].add(r.sequence_id)
        before += r.length
    assert len(windows) > 10
    filled = defaultdict(list)
    for r in found:
        filled[r.sequence_id].append((r.offset, r.length))
    for placed in filled.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 64
    assert len(filled) <= -(-before // 64) + 2 * len(windows)
    assert config_packing.pack_in_order(docs(), by).count() == 0
