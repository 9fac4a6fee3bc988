"""The registered queries against their SQL, and the pipeline against a slow version of it."""

import os
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from llm_reference import roots

import __spark_entry__ as contract
import corpus_pipeline
from quayside import session
from quayside.llm import config_packing, language, simhash, tokens
from quayside.llm.queries import ORACLE_SQL, REGISTRY, remainder

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = REGISTRY[name](spark, SF)
    answer = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in answer.description]
    expected = sorted((tuple(r[columns.index(c)] for c in df.columns) for r in answer.fetchall()), key=repr)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.collect()), key=repr) == expected


def test_all_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in REGISTRY)
    assert numbers == list(range(1, 14))
    assert set(REGISTRY) | {"pipeline"} <= set(contract.queries())
    assert contract.queries()["pipeline"] is corpus_pipeline.run


def test_rows_of_the_whole_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op3_lattice_lm", "op7_simhash", "op8_language"):
        assert REGISTRY[name](spark, SF).count() == docs
    found = REGISTRY["op1_token_output"](spark, SF).collect()
    assert len({r.doc_id for r in found}) == docs and all(r.positions_ok for r in found)


def test_pipeline_gives_what_its_stages_mean(spark, tmp_path):
    """All five stages on documents with copies, near copies and texts without a language."""
    source = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(150)
    extra = [(9001, None), (9002, ""), (9003, "1 2 3"), (9004, "12 % 4")]
    rows = [tuple(r) for r in source.collect()]
    rows += [(8000 + i, rows[i][1], rows[i][2], rows[i][3], rows[i][4]) for i in range(0, 60, 7)]
    rows += [(8200 + i, rows[i][1] + " end", rows[i][2], None, rows[i][4]) for i in range(0, 60, 5)]
    rows += [(i, t, "en", "s", 0) for i, t in extra]
    folder = str(tmp_path / "sf")
    spark.createDataFrame(rows, source.schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    result = corpus_pipeline.run(spark, folder).collect()

    net = language.fit(docs, remainder(4) != 2)
    predicted = language.predict_texts(language.Predictor(net), [r[1] for r in rows])
    kept = [r for r, p in zip(rows, predicted) if p[0] != "und"]
    assert {r[0] for r in rows} - {r[0] for r in kept} == {9001, 9002, 9003, 9004}
    largest = {}
    for r in kept:
        largest[r[1]] = max(largest.get(r[1], r[0]), r[0])
    kept = [r for r in kept if largest[r[1]] == r[0]]
    prints = {r[0]: simhash.fingerprint(r[1].encode()) for r in kept}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    first = roots(prints, links)
    kept = [r for r in kept if first[r[0]] == r[0]]
    encoder = tokens.encoder()
    expected = set()
    for r in kept:
        ids = encoder.encode(r[1].encode()) + np.array([0], "<u4").tobytes()
        for k in range(0, len(ids), 4 * config_packing.CAPACITY):
            piece = ids[k : k + 4 * config_packing.CAPACITY]
            expected.add((r[0], k // (4 * config_packing.CAPACITY), k // 4, len(piece) // 4, zlib.crc32(piece)))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in result} == expected
    assert len(result) == len(expected)
    filled = defaultdict(int)
    for r in result:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= config_packing.CAPACITY


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "/root/testdata/sf0.001").columns == docs.columns


CLASHING = (
    "__own __id __bit __bits __piece __place __digest __gone __gone_digest __print id row digest print gone gone_id "
    "gone_digest mixed_id place position start block source_key kept keep_id component_id lang_pred score `a.b`"
).split()


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]], ids=lambda f: f.__name__)
def test_stages_keep_columns_of_any_name(spark, stage):
    texts = ["One text here with words in it", "Another text, und noch ein Wort", "One text here with words in it", "third"]
    rows = [(i, t, "en" if i % 2 else "de", "s", len(t)) for i, t in enumerate(texts * 3)]
    rows += [(2, "unlike the other one of this id", "en", None, 1), (None, "no id", "en", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.selectExpr("*", *[f"concat(doc_id, '{c.strip('`')}') AS {c}" for c in CLASHING]).repartition(3)
    found = stage(spark, docs, "unused")
    assert found.schema == docs.schema
    given, kept = Counter(map(tuple, docs.collect())), Counter(map(tuple, found.collect()))
    assert kept and not kept - given
    plain = Counter(map(tuple, stage(spark, docs.select(*docs.columns[:5]), "unused").collect()))
    assert Counter(row[:5] for row in kept.elements()) == plain


def test_without_labelled_documents_all_with_a_letter_stay(spark):
    rows = [(1, "An ordinary text", None), (2, "123", None), (3, None, None), (4, "Noch einer é", None), (5, "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = corpus_pipeline.identify_language(spark, docs, "unused")
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == [1, 4]


def test_pipeline_leaves_its_result_only(spark, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(shared))
    rows = [(i, f"text {i % 7} of some words", "en", "s", 1) for i in range(40)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "sf")).count() > 0
    left = [str(p.relative_to(shared)).split("/", 1)[1] for p in shared.glob("*/*")]
    assert left == ["packing"] and len(list(shared.glob("*"))) == 1

    def fail(spark, docs, sf_dir):
        raise OSError("lost")

    stages = [*corpus_pipeline.STAGES[:2], ("broken", fail)]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    with pytest.raises(OSError):
        corpus_pipeline.run(spark, str(tmp_path / "sf"))
    assert len(list(shared.glob("*"))) == 1


def test_pipeline_of_an_empty_table_and_of_a_very_long_text(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    rows = [(1, "many words " * 100_000, None, None, None), (2, "few words", None, None, None)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "long" / "documents.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path / "long")).collect()
    assert {r.doc_id for r in found} == {1, 2} and sum(r.length for r in found if r.doc_id == 1) == 200_001


def test_packed_sequences_follow_the_mix(spark, tmp_path):
    rows = [(100 * s + i, "word " * (9_000 + 37 * i), "en", f"s{s}", 1) for s in range(2) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    path = str(tmp_path / "mixed")
    mixed = corpus_pipeline.mix_sources(spark, docs, "unused")
    order = {r.doc_id: n for n, r in enumerate(mixed.collect())}
    mixed.write.parquet(path)
    found = corpus_pipeline.pack_sequences(spark, spark.read.parquet(path), "unused").collect()
    found.sort(key=lambda r: (r.sequence_id, r.offset))
    whole = [(order[r.doc_id], r.piece) for r in found if r.length == config_packing.CAPACITY]
    assert len(whole) >= 4 * len(rows) and whole == sorted(whole)
    total, had = sum(r.length for r in found), Counter()
    for r in found:
        had[r.doc_id // 100] += r.length
        assert abs(had[0] - had[1]) <= 0.2 * total
