"""WARC archives and sharding."""
import gzip
import hashlib
import os
import zlib

from pyspark.sql import functions as F

from parcelkit.llm import sharding, warc


def pages(spark):
    big = "<p>" + "x\xe9" * 800
    rows = [(1, "http://a/", big), (2, "http://b/\r\nX: y", big), (9, None, big), (3, "http://c/", "small"),
            (4, "http://d/", "small"), (5, "http://e/", None), (6, "http://f/", ""), (None, "http://g/", big),
            (9, "http://h/", big), (7, "http://i/", big + "\r\n\r\nWARC/1.1\r\n"), (8, "u", "y" * 1000), (10, "u", "y" * 999),
            (11, "u", "y" * 1000), (12, "u", "y" * 999)]
    return spark.createDataFrame([(*r, "extra") for r in rows], "page_id bigint, url string, html string, file string"), rows


def expected(rows):
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        same = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        response = max(same) if len(raw) >= 1000 else i
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if i == response else "revisit",
                    None if i == response else response))
    return sorted(out, key=str)


def test_archives_round_trip(spark):
    df, rows = pages(spark)
    folder = warc.archive_folder(spark)
    index = warc.write_archives(df, folder, file_bytes=2000)
    back = warc.read_records(index, folder, payloads=True).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=str)
    assert got == expected(rows)
    texts = {r.page_id: bytes(r.payload) for r in back if r.record_type == "response"}
    assert texts[7] == rows[9][2].encode() and texts[5] == b""
    assert {r.url for r in back if r.page_id == 2} == {"http://b/%0D%0AX: y"}
    # The index places every record, and the files are plain gzip members.
    for r in index.collect():
        with open(os.path.join(folder.removeprefix("file:"), r.file), "rb") as f:
            raw = f.read()
        record = warc.parse_record(zlib.decompress(raw[r.offset:r.offset + r.length], 31))
        assert (record["page_id"], record["payload_digest"]) == (r.page_id, r.payload_digest)
        assert gzip.decompress(raw).count(b"WARC-Type: warcinfo") == 1


def test_selected_records_and_empty_table(spark):
    df, _ = pages(spark)
    folder = warc.archive_folder(spark)
    index = warc.write_archives(df, folder)
    some = warc.read_records(index.where("url = 'u'"), folder)
    assert sorted(r.page_id for r in some.collect()) == [8, 10, 11, 12]
    empty = warc.archive_folder(spark)
    assert warc.read_records(warc.write_archives(df.where("page_id > 99"), empty), empty).collect() == []


def test_ranges_are_joined_and_bounded():
    places = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 90, 10), ("b", 0, 10), ("b", 10, 500)]
    assert list(warc.coalesce_ranges(iter(places), gap=10, most=100)) == [
        ("a", 0, 30, [(0, 10), (10, 10), (25, 5)]), ("a", 90, 100, [(90, 10)]), ("b", 0, 10, [(0, 10)]),
        ("b", 10, 510, [(10, 500)])]


def check_shards(rows, n, shards):
    sizes = [sum(r.shard == s for r in rows) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_shards(spark):
    rows = [(i * 37 % 501, f"text {i % 40}") for i in range(501)] + [(7, "hot")] * 300 + [(None, None), (None, ""), (5, "\xe9")]
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id bigint, text string, shard int")
    out = sharding.shard_rows(df)
    got = out.collect()
    check_shards(got, len(rows), 16)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=str)
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    assert [r.row_no for r in sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id, r.size, r.text_crc32, r.row_no))] == list(
        range(len(rows)))
    # The same rows in other partitions go to the same places.
    again = sharding.shard_rows(df.repartition(5)).collect()
    place = lambda r: (r.doc_id, r.size, r.text_crc32, r.shard, r.slot)
    assert sorted(map(place, got), key=str) == sorted(map(place, again), key=str)
    back = sharding.row_number_at(spark.createDataFrame(got, out.schema).withColumnRenamed("row_no", "was"), len(rows))
    assert back.where("row_no <> was").isEmpty()


def test_small_and_empty_tables(spark):
    df = spark.createDataFrame([(i, "x") for i in range(40)], "doc_id bigint, text string")
    for n in (0, 1, 2, 3, 7, 17, 31):
        check_shards(sharding.shard_rows(df.where(F.col("doc_id") < n)).collect(), n, 16)


def test_network_is_a_bijection(spark):
    for n in (1, 2, 12, 97, 100):
        a, b = sharding.box(n)
        assert a * b >= n and a * b - n < a
        df = spark.range(a * b).select("id", sharding.network(F.col("id"), n).alias("p"))
        df = df.withColumn("q", sharding.network(F.col("p"), n, inverse=True))
        rows = df.collect()
        assert sorted(r.p for r in rows) == list(range(a * b)) and all(r.q == r.id for r in rows)
