"""Pfair mixing and WARC archives: against the definitions and by round trips."""

import hashlib
import struct
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from quayside.llm import pfair_mixing, warc

# --- Mixing


def shares_of(spark, weights):
    return spark.createDataFrame(list(weights.items()), "source_key string, k int")


@pytest.mark.parametrize(
    "weights", [{"a": 1000}, {"a": 500, "b": 500}, {"a": 990, "b": 5, "c": 5}, {"a": 333, "b": 333, "c": 333, "d": 1},
                {"a": 500, **{f"s{i}": 10 for i in range(50)}}]
)
def test_every_block_runs_within_its_window_and_no_source_is_a_block_off(spark, weights):
    rows = pfair_mixing.frame_schedule(shares_of(spark, weights)).collect()
    assert sorted(r.slot for r in rows) == list(range(1000))
    assert Counter(r.source_key for r in rows) == weights
    assert all(r.release <= r.slot < r.deadline for r in rows)
    assert all(r.release == (r.i - 1) * 1000 // r.k and r.deadline == -(-r.i * 1000 // r.k) for r in rows)
    order = [r.source_key for r in sorted(rows, key=lambda r: r.slot)]
    had = Counter()
    for t, source in enumerate(order, 1):
        had[source] += 1
        assert all(abs(had[s] - t * k / 1000) < 1 for s, k in weights.items())


def test_earliest_deadline_of_the_released_blocks_runs(spark):
    weights = {"a": 610, "b": 240, "c": 150}
    rows = {(r.source_key, r.i): r for r in pfair_mixing.frame_schedule(shares_of(spark, weights)).collect()}
    waiting = {s: 1 for s in weights}
    for t in range(1000):
        ready = [
            (rows[s, i].deadline, s) for s, i in waiting.items() if (s, i) in rows and rows[s, i].release <= t
        ]
        chosen = min(ready)[1]
        assert rows[chosen, waiting[chosen]].slot == t
        waiting[chosen] += 1


def test_weights_are_whole_and_add_up(spark):
    for sizes in ([("=a", 10**12), ("=b", 0), ("-", 5)], [(f"={i}", i * i) for i in range(300)], [("=a", 7)]):
        found = pfair_mixing.weights(spark.createDataFrame(sizes, "source_key string, chars bigint")).collect()
        k = {r.source_key: r.k for r in found}
        assert sum(k.values()) == 1000 and min(k.values()) >= 1 and len(k) == len(sizes)
        ordered = [k[s] for s, _ in sorted(sizes, key=lambda x: x[1])]
        assert all(a <= b + 1 for a, b in zip(ordered, ordered[1:]))


def test_mix_of_documents(spark, docs, monkeypatch):
    monkeypatch.setattr(pfair_mixing, "RANGE_ROWS", 7)
    rows = [(i, "x" * (i * 37 % 400), None, ("s0" if i % 3 else f"s{i % 5}") if i % 11 else None) for i in range(400)]
    rows += [(400, None, None, "s0"), (None, "abc", None, "s1"), (5, "x" * 185, None, rows[5][3]), (402, "y" * 90_000, None, "s2")]
    table = docs(*rows).withColumns({"k": F.lit("k"), "block": F.lit(1), "start": F.lit(2), "digest": F.lit(3)})
    found = pfair_mixing.mix(table, block_chars=1000).collect()
    assert len(found) == len(rows)
    key = {None: "-"}
    by_source = defaultdict(list)
    for doc_id, text, _, source in rows:
        digest = hashlib.md5(str(doc_id if doc_id is not None else "").encode()).hexdigest()
        by_source[key.get(source, f"={source}")].append((digest, doc_id, len(text or "")))
    expected = set()
    for source, members in by_source.items():
        start = 0
        for _, doc_id, chars in sorted(members, key=lambda m: (m[0], m[1] is not None, m[1] or 0)):
            expected.add((source, doc_id, start))
            start += chars
    assert {(r.source_key, r.doc_id, r.start) for r in found} == expected
    assert all(r.block == r.start // 1000 + 1 and r.release <= r.position < r.deadline for r in found)
    places = defaultdict(set)
    for r in found:
        places[r.position].add((r.source_key, r.block))
    assert all(len(p) == 1 for p in places.values())


def test_mixed_order_keeps_all_rows_and_columns(spark, docs):
    rows = [(i, "word " * 10_000, "en", f"s{i % 2}") for i in range(30)] + [(None, "a"), (None, "b"), (3, "c", None, "s1")]
    table = docs(*rows).withColumn("position", F.lit(1))
    mixed = pfair_mixing.in_mixed_order(table)
    assert mixed.columns == table.columns
    got = mixed.collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, table.collect()), key=repr)
    order = [r.source for r in got if r.source]
    assert all(abs(order[:n].count("s0") - n / 2) <= 9 for n in range(1, 31))  # blocks of four documents
    assert pfair_mixing.in_mixed_order(docs()).count() == 0


def test_more_sources_than_slots_lose_no_document(spark, docs):
    rows = [(i, "x" * 50, None, f"s{i}") for i in range(1_001)]
    rows += [(2_000 + i, "x" * 90_000, None, "hot") for i in range(20)]
    found = pfair_mixing.mix(docs(*rows), block_chars=100_000).collect()
    assert sorted(r.doc_id for r in found) == [r[0] for r in rows]
    k = {r.source_key: r.k for r in found}
    assert sum(k.values()) == pfair_mixing.frame_for(1_002) > 1_002 and min(k.values()) >= 1
    assert k["=hot"] == max(k.values()) and all(r.release <= r.position < r.deadline for r in found)
    assert len({(r.position) for r in found}) == len({(r.source_key, r.block) for r in found})


def test_long_frames_are_filled_by_the_same_rule(spark):
    weights = {"a": 590, "é": 240, "b": 150, **{f"s{i}": 1 for i in range(20)}}
    found = pfair_mixing._long_schedule(list(weights.items()), 1000)
    assert sorted(found) == sorted(map(tuple, pfair_mixing.frame_schedule(shares_of(spark, weights)).collect()))


def test_a_source_without_slots_is_an_error(spark, docs):
    with pytest.raises(ValueError, match="=b"):
        pfair_mixing.mix(docs((1, "x", None, "a"), (2, "y", None, "b")), shares_of(spark, {"=a": 1000}))


# --- Archives


def plain(rows):
    found = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [i for i, _, h in rows if (h or "").encode() == data and i is not None]
        first = min(same) if same else None
        revisit = len(data) >= 100 and page_id is not None and page_id != first
        found.append(
            (page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None)
        )
    return sorted(found, key=repr)


LONG = "<p>é</p>" * 30
PAGES = [
    (5, "http://a/x?y=1#z", LONG), (3, "http://a/ü b\r\nX: y", LONG), (9, None, LONG), (None, "u", LONG), (3, "again", LONG),
    (1, "", ""), (2, "u", None), (4, "u", "x" * 99), (6, "u", "x" * 99), (7, "u", "y" * 100), (8, "u", "y" * 100),
    (10, "u", "z" * 3_000_000), (11, "u", "WARC/1.1\r\n\r\n\x00"),
]


@pytest.mark.parametrize("size", [1, 2_000, warc.ARCHIVE_BYTES])
def test_pages_come_back_from_the_archives(spark, tmp_path, size):
    table = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").repartition(2)
    table = table.withColumns({"digest": F.lit("d"), "first": F.lit(1), "refers_to": F.lit(2), "n": F.lit(3)})
    collection = warc.write_archives(table, str(tmp_path / "w"), size)
    assert sum(r.records for r in collection.collect()) == len(PAGES)
    whole = warc.archive_bytes([warc.page_record(77, "u", b"x", hashlib.sha256(b"x").hexdigest(), None)])
    for n, left in enumerate((whole, whole[:-9], whole[:5], b"", b"x" * 300)):
        (tmp_path / "w" / f"pages-of-lost-task-{n}.warc.zst").write_bytes(left)
    records = warc.read_archives(spark, str(tmp_path / "w"), collection)
    got = [tuple(r)[1:] for r in records.collect()]
    assert sorted(got, key=repr) == plain(PAGES)
    assert collection.count() == (len(PAGES) if size == 1 else collection.count())


def test_an_archive_is_frames_behind_its_dictionary():
    records = [warc.page_record(i, "http://a/", f"<p>{i} some common text</p>".encode() * 9, "d", None) for i in range(400)]
    data = warc.archive_bytes(records)
    magic, size = struct.unpack_from("<II", data)
    assert magic == warc.DICTIONARY_MAGIC
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    assert dictionary.dict_id()  # a trained one
    read = list(warc.read_archive(data))
    assert [r.headers["WARC-Type"] for r in read] == ["warcinfo"] + ["response"] * 400
    assert read[1].block.endswith(b"<p>0 some common text</p>")
    assert len(data) - size < sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records) / 2
    # Any record can be read alone, and plain tools skip the dictionary.
    frames = data[8 + size :]
    one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
    assert one.decompress(frames).startswith(b"WARC/1.1")
    assert zstandard.ZstdDecompressor(dict_data=dictionary).decompress(one.unused_data).startswith(b"WARC/1.1")


def test_a_compressed_dictionary_is_read_too():
    data = warc.archive_bytes([b"x"])
    _, size = struct.unpack_from("<II", data)
    smaller = zstandard.ZstdCompressor().compress(data[8 : 8 + size])
    again = struct.pack("<II", warc.DICTIONARY_MAGIC, len(smaller)) + smaller + data[8 + size :]
    with pytest.raises(ValueError, match="not a whole WARC record"):
        list(warc.read_archive(again))  # the second record is no record, the first one is read
    assert next(warc.read_archive(again)).headers["WARC-Type"] == "warcinfo"


def test_damage_is_seen(spark, tmp_path):
    folder = tmp_path / "w"
    folder.mkdir()
    wrong = warc.page_record(1, "u", b"payload", hashlib.sha256(b"other").hexdigest(), None)
    (folder / "pages-x.warc.zst").write_bytes(warc.archive_bytes([wrong]))
    collection = spark.createDataFrame([("pages-x.warc.zst", 1, 1)], warc.COLLECTION)
    with pytest.raises(Exception, match="does not hold the payload"):
        warc.read_archives(spark, str(folder), collection).collect()
    with pytest.raises(ValueError, match="begin with a dictionary"):
        list(warc.read_archive(zstandard.ZstdCompressor().compress(b"x")))


def test_no_pages(spark, tmp_path):
    table = spark.createDataFrame([], "page_id bigint, url string, html string")
    (tmp_path / "w").mkdir()
    collection = warc.write_archives(table, str(tmp_path / "w"))
    assert collection.count() == 0 and warc.read_archives(spark, str(tmp_path / "w"), collection).count() == 0
