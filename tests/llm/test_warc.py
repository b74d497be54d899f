from __future__ import annotations

import gzip
import io
import zlib

import brute
import pytest

from tributary.llm import warc
from tributary.session import scratch_dir

COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def rows_of(spark, rows, least_bytes=0, schema="page_id long, url string, html string"):
    return [tuple(r) for r in warc.round_trip(spark, spark.createDataFrame(rows, schema), least_bytes).select(COLUMNS).collect()]


def test_round_trip_equals_brute_force(spark):
    rows = [(i, f"http://h{i}.example/é\n{i}", ["x" * i, "same", None, "", "ü\r\n\r\nWARC/1.1"][i % 5]) for i in range(60)]
    assert sorted(rows_of(spark, rows), key=str) == sorted(brute.warc([(i, h) for i, _, h in rows]), key=str)


def test_ties_null_ids_and_clashing_columns(spark):
    rows = [(7, None, "a", 1), (7, None, "a", 2), (3, "u", "a", 3), (None, "u", "b", 4), (None, "u", "b", 5), (None, "u", "c", 6)]
    found = rows_of(spark, rows, schema="page_id long, url string, html string, refers_to int")
    assert sorted(r[3:] for r in found if r[0] == 7) == [("response", None), ("revisit", 7)] or [
        r[3] for r in found if r[0] == 7
    ].count("response") == 1
    assert [r[3:] for r in found if r[0] == 3] == [("revisit", 7)]
    assert sorted(r[3] for r in found if r[0] is None) == ["response", "response", "revisit"]


def test_small_payloads_are_all_responses_below_the_limit(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    assert {r[0]: r[3] for r in rows_of(spark, rows, 5)} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_empty_table(spark):
    assert rows_of(spark, []) == []


def test_archives_are_gzip_members_of_records(spark, tmp_path):
    rows = spark.createDataFrame([(i, "u", "p" * (3000 * i)) for i in range(30)], "page_id long, url string, html string")
    folder = scratch_dir(spark, "warc-test")
    manifest = warc.write_archives(spark, warc.with_record_types(rows), folder, archive_bytes=400)
    assert manifest.count() > 5
    from tributary.llm.storage import join_path, open_folder

    files, root = open_folder(folder)
    for row in manifest.collect():
        data = files.open_input_stream(join_path(root, row.path), compression=None).read()
        assert len(data) == row.bytes and gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_payloads_come_back(spark):
    rows = spark.createDataFrame([(1, "u", "é" * 70_000), (2, "u", None)], "page_id long, url string, html string")
    folder = scratch_dir(spark, "warc-test")
    manifest = warc.write_archives(spark, warc.with_record_types(rows), folder)
    found = {r.page_id: bytes(r.payload).decode() for r in warc.read_archives(spark, manifest, folder).collect()}
    assert found == {1: "é" * 70_000, 2: ""}


@pytest.mark.parametrize("damage", ["cut", "flip", "length", "digest"])
def test_damaged_archives_are_refused(damage):
    data = warc.page_record(1, "u", b"payload", None, False) + warc.page_record(2, "u", b"more", None, False)
    if damage == "cut":
        data = data[:-5]
    elif damage == "flip":
        data = data[:40] + bytes([data[40] ^ 1]) + data[41:]
    else:
        plain = gzip.decompress(data)
        plain = plain.replace(b"Content-Length: 7", b"Content-Length: 6") if damage == "length" else plain.replace(b"payload", b"PAYLOAD")
        data = gzip.compress(plain)
    with pytest.raises((warc.CorruptArchive, zlib.error)):
        list(warc.read_records(io.BytesIO(data)))


def test_reader_takes_any_piece_size():
    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(min(n, 3))

    data = warc.page_record(1, "u", b"x" * 1000, None, False) + warc.page_record(2, "u", b"", 1, True)
    found = list(warc.read_records(Slow(data)))
    assert [h["WARC-Type"] for h, _ in found] == ["response", "revisit"] and found[0][1] == b"x" * 1000
