"""Exact copies, near copies, components, near vectors: against brute force."""

import random

import numpy as np
import pytest
import xxhash
from llm_reference import roots, words
from pyspark.sql import functions as F

from quayside.llm import components, exact_dedup, grid_join, simhash

# --- Exact copies


def exact(rows):
    found = []
    for doc_id, text in rows:
        same = [i for i, t in rows if (t or "") == (text or "")]
        ids = [i for i in same if i is not None]
        keep = max(ids) if ids else None
        found.append((doc_id, keep, len(same), doc_id == keep))
    return sorted(found, key=repr)


def weak(text):
    return F.substring(F.md5(text.cast("binary")), 1, 1)


TEXTS = ["", None, "a", "A", "a ", "é", "é", "long " * 20_000, "a", "", "x\x00y", "long " * 20_000, "b", "b", "b"]


@pytest.mark.parametrize("digest", [exact_dedup.sha256_hex, weak])
def test_exact_copies_even_if_digests_clash(docs, digest):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "b"), (None, "alone"), (12, "b")]
    found = exact_dedup.exact_dedup(docs(*rows), digest=digest).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found), key=repr) == exact(rows)


def test_exact_copies_of_an_empty_table_and_of_extra_columns(spark, docs):
    assert exact_dedup.exact_dedup(docs()).count() == 0
    clashing = docs((1, "a"), (2, "a"), (3, "b")).selectExpr(
        "doc_id", "text", "'x' AS digest", "0 AS kept", "1 AS arrivals", "2 AS bit", "3 AS locator", "4 AS __other"
    )
    found = exact_dedup.exact_dedup(clashing)
    assert {r.doc_id: r.kept for r in found.collect()} == {1: False, 2: True, 3: True}
    kept = exact_dedup.drop_copies(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_an_id_with_unlike_texts_loses_copies_only(docs):
    kept = exact_dedup.drop_copies(docs((5, "A"), (9, "A"), (5, "B"), (3, "B"), (3, "C"), (None, "C")))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(3, "C"), (5, "B"), (9, "A")]


def test_state_takes_up_later_arrivals(spark, docs, tmp_path):
    state = exact_dedup.DigestState(spark, str(tmp_path / "state"))
    state.ingest(docs((1, "a"), (5, "b")))
    state.ingest(docs((3, "a"), (4, "b"), (6, "c")))
    assert {(r.keep_id, r.arrivals) for r in state.entries().collect()} == {(3, 2), (5, 2), (6, 1)}


def test_settings_of_the_session_are_left_as_they_were(spark, docs):
    before = {k: spark.conf.get(k, None) for k in exact_dedup.STATE_SETTINGS}
    exact_dedup.exact_dedup(docs((1, "a"))).collect()
    assert {k: spark.conf.get(k, None) for k in exact_dedup.STATE_SETTINGS} == before


def test_bitmap_keeps_all_marked_rows(spark):
    digests = spark.range(5_000).selectExpr("md5(cast(cast(id AS string) AS binary)) AS digest")
    some = digests.where("digest < '4'")
    bitmap = exact_dedup.bitmap_of(some)
    hit = exact_dedup.marked(digests, bitmap, F.col("digest"))
    miss = exact_dedup.marked(digests, bitmap, F.col("digest"), keep=False)
    assert hit.join(some, "digest", "left_semi").count() == some.count()
    assert hit.count() + miss.count() == 5_000
    assert hit.count() < some.count() + 50


# --- Near copies by fingerprint


def slow_print(text):
    w = words(text)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_prints(prints):
    ordered = sorted(prints)
    return {
        (a, b) for i, a in enumerate(ordered) for b in ordered[i + 1 :] if (a ^ b).bit_count() <= simhash.MAX_BITS
    }


def signed(n):
    return n - (1 << 64) if n >= 1 << 63 else n


def test_fingerprints(docs):
    rng = random.Random(1)
    texts = ["", None, " \n\t", "One", "one TWO", "a b c", "a a a a a a", "É é x y z", "w " * 70_000]
    texts += [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(3, 60))) for _ in range(20)]
    found = simhash.fingerprints(docs(*enumerate(texts))).collect()
    assert {r.doc_id: r.print for r in found} == {i: signed(slow_print(t)) for i, t in enumerate(texts)}


@pytest.mark.parametrize("bucket", [1, 4, 512])
def test_near_fingerprints_are_found_once_in_full_buckets_and_others(spark, bucket):
    rng = random.Random(bucket)
    prints = {0, (1 << 64) - 1, 1, 1 << 63, (1 << 32) - 1, 1 << 32}
    for _ in range(40):
        centre = rng.getrandbits(64)
        prints.add(centre)
        for _ in range(rng.randint(0, 12)):
            flips = rng.sample(range(64), rng.randint(1, 4))
            prints.add(centre ^ sum(1 << b for b in flips))
    dense = rng.getrandbits(64)
    prints |= {dense ^ (1 << i) ^ (1 << j) for i in range(0, 64, 5) for j in range(0, 64, 7)}
    table = spark.createDataFrame([(signed(p),) for p in prints], "print bigint")
    found = [(r.a % 2**64, r.b % 2**64) for r in simhash.near_prints(table, bucket).collect()]
    assert len(found) == len({tuple(sorted(p)) for p in found})
    assert {tuple(sorted(p)) for p in found} == near_prints(prints)


def test_near_copies_keep_one_of_each_component(spark, docs):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(7, base), (3, base + " tail"), (5, base.upper()), (9, None), (4, " "), (1, "quite different words here")]
    table = docs(*rows, (None, "another text without number"))
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(table).collect()}
    prints = {i: slow_print(t) for i, t in rows}
    links = [(a, b) for a in prints for b in prints if (prints[a] ^ prints[b]).bit_count() <= 2]
    assert {i: found[i] for i in prints} == roots(prints, links)
    kept = simhash.drop_near_copies(table.withColumn("print", F.lit(1)).withColumn("component_id", F.lit(2)))
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted({*found.values(), None}, key=repr)
    assert simhash.near_duplicates(docs()).count() == 0


def test_an_id_with_unlike_texts_loses_near_copies_only(docs):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(3, base), (7, base.upper()), (7, "quite different words here"), (7, None), (8, base)]
    kept = simhash.drop_near_copies(docs(*rows)).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == [(3, base), (7, ""), (7, "quite different words here")]


# --- Components


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(i, i + 1) for i in range(100, 160)]  # a path
    links += [(500, 500 + rng.randint(1, 80)) for _ in range(60)]  # a star
    links += [(rng.randint(0, 90), rng.randint(0, 90)) for _ in range(40)] + [(3, 3), (-5, 7), (7, -5)]
    table = spark.createDataFrame(links + links[:10], "a bigint, b bigint")
    found = components.components(table).collect()
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert len(found) == len(nodes)
    assert {r.node: r.component_id for r in found} == roots(nodes, [p for p in links if p[0] != p[1]])


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- Near vectors


def cosine_links(rows):
    usable = {
        k: np.array(v, float)
        for k, (i, v) in enumerate(rows)
        if i is not None and v and None not in v and np.all(np.isfinite(v)) and np.any(v)
    }
    return [
        (a, b)
        for a, x in usable.items()
        for b, y in usable.items()
        if a < b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9
    ]


@pytest.mark.parametrize("block,leaf", [(4096, 256), (7, 3)])
def test_near_vectors(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(grid_join, "LEAF", leaf)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 16))
    vectors = [(centres[rng.integers(8)] + rng.normal(size=16) * rng.choice([0.05, 0.25, 0.6])).tolist() for _ in range(150)]
    vectors += vectors[:20] + [[0.0] * 16, None, [], [float("nan")] * 16, [1.0, None], [1e-30, 2e-30], [1.0, 2.0], [3.0]]
    vectors += [[float("inf")] + [1.0] * 15, [-3.0], [5.0]]
    rows = [(int(i), v) for i, v in zip(rng.permutation(len(vectors)), vectors)] + [(None, vectors[0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("label", F.lit("x"))
    links = cosine_links(rows)
    low = roots([i for i, _ in rows if i is not None], [(rows[a][0], rows[b][0]) for a, b in links])
    counts = [sum(k in pair for pair in links) for k in range(len(rows))]
    expected = {i: (counts[k], low.get(i), i == low.get(i)) for k, (i, _) in enumerate(rows)}
    found = grid_join.near_vectors(table, block=block).collect()
    assert len(found) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == expected


def test_repeated_rows_and_empty_tables_of_vectors(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert grid_join.near_vectors(spark.createDataFrame([], schema)).count() == 0
    found = grid_join.near_vectors(spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (0, [0.0, 1.0])], schema))
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found.collect()) == [
        (0, 0, 0, True), (1, 1, 1, True), (1, 1, 1, True)
    ]


def test_distant_intervals_are_skipped():
    vectors = np.repeat(np.eye(2), 600, axis=0)
    seen = []

    class Counting(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ np.asarray(other)

    links, root = grid_join.join_intervals(
        vectors.view(Counting), vectors, np.ones(1200, np.int64), 0, 0.9, float(np.sqrt(0.2))
    )
    assert links.tolist() == [599] * 1200 and set(root.tolist()) == {0, 600}
    assert sum(seen) < 2 * 1200 * 5  # far fewer leaves than all pairs have


def test_pairs_at_the_threshold_are_decided_in_double_precision():
    """Cosines a billionth above and below the threshold, which single precision cannot tell apart."""
    base = np.eye(1, 64)[0]
    rows = [base]
    for i, off in enumerate([1e-9, -1e-9, 1e-12, -1e-12, 0.05, -0.05]):
        row = np.zeros(64)
        row[0], row[i + 1] = 0.9 + off, np.sqrt(1 - (0.9 + off) ** 2)
        rows.append(row)
    rows = np.array(rows)
    counts = np.ones(len(rows), np.int64)
    links, _ = grid_join.join_intervals(rows, rows[:, :8], counts, 0, 0.9, float(np.sqrt(0.2)))
    expected = (rows @ rows.T >= 0.9).sum(axis=1) - 1
    assert links.tolist() == expected.tolist() and links[0] == 3


@pytest.mark.parametrize("kind,dimension", [("float", 64), ("float", 700), ("int", 5)])
def test_vectors_stored_in_any_type_and_length(spark, kind, dimension):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(4, dimension)) * 100
    vectors = centres[rng.integers(4, size=60)] + rng.normal(size=(60, dimension)) * 35
    vectors = vectors.astype({"float": np.float32, "int": np.int32}[kind])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")
    links = cosine_links(rows)
    low = roots([i for i, _ in rows], links)
    found = {r.vec_id: (r.n_links, r.component_id) for r in grid_join.near_vectors(table, block=16).collect()}
    assert found == {i: (sum(i in pair for pair in links), low[i]) for i, _ in rows}


def test_axes_of_few_long_vectors():
    sample = np.random.default_rng(3).normal(size=(20, 300))
    axes = grid_join.principal_axes(sample)
    wide = sample - sample.mean(axis=0)
    _, expected = np.linalg.eigh(wide.T @ wide)
    assert np.allclose(axes.T @ axes, np.eye(8))
    assert np.allclose(np.abs((axes * expected[:, ::-1][:, :8]).sum(axis=0)), 1)
    assert grid_join.principal_axes(sample[:1]).shape == (300, 1)
    assert grid_join.principal_axes(sample[:0]).tolist() == np.eye(300, 1).tolist()


def test_blocks_are_sent_in_proportion_to_rows_and_bounded_by_bytes():
    def copies(n, dimension, cores):
        """How often a vector is sent if no pair of blocks can be skipped."""
        blocks = -(-n // grid_join.rows_per_block(n, dimension, cores))
        return blocks, blocks * (blocks + 1) // 2

    few, many = copies(10_000, 64, 6), copies(200_000, 64, 6)
    assert few == many and many[1] >= 6 * grid_join.TASKS_PER_CORE
    for n, dimension in [(10**9, 64), (10**6, 4096), (100, 1 << 20), (5, 1 << 24)]:
        rows = grid_join.rows_per_block(n, dimension, 6)
        assert rows == 1 or rows * dimension * 8 <= grid_join.BLOCK_BYTES


def test_unlike_vectors_with_one_id_are_not_linked(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [1.0, 0.01, 0.0]), (3, [0.0, 1.0, 0.01])]
    rows += [(4, [0.0, 1.0, 0.02])]
    found = grid_join.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == [
        (1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 2, 1), (4, 2, 1)
    ]
