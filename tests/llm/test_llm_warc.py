import hashlib
import random
import re
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from tillroll.llm import warc

SCHEMA = "page_id bigint, url string, html string, digest string, payload int"


def pages_of(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)


def rows():
    rng, big = random.Random(1), "é" * 60 + "copy"
    body = ["<p>" + " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(80)) + f"{i}</p>" for i in range(40)]
    out = [(i, f"http://h{i}.org/\n{i}", h) for i, h in enumerate(body)]
    out += [(100 + i, "u", big) for i in range(30)] + [(200, None, None), (201, "v", None), (202, "w", "short"), (203, "w", "short")]
    return out + [(100, "u", big), (None, "n", big), (None, "m", "lone " * 40), (204, "z", "w\r\n\r\n" * 50), (204, "z", "w\r\n\r\n" * 50)]


def expected(data):
    out = []
    for page, _, html in data:
        payload = (html or "").encode()
        same = [p for p, _, h in data if (h or "").encode() == payload and p is not None]
        refers = min(same) if same and len(payload) >= 100 and page != min(same) else None
        out.append((page, len(payload), hashlib.sha256(payload).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("archive_bytes", [500, 1 << 30])
def test_archives_give_back_every_page(spark, tmp_path, archive_bytes):
    data, folder = rows(), str(tmp_path / "warc")
    manifest = warc.write(pages_of(spark, data), folder, archive_bytes=archive_bytes).collect()
    assert sum(r["records"] for r in manifest) == len(data)
    back = warc.read(spark, folder).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back]
    assert sorted(got, key=str) == expected(data)
    assert sorted(bytes(r.payload).decode() for r in back if r.record_type == "response" and r.payload_bytes) == sorted(
        h for p, _, h in data if h and (len(h.encode()) < 100 or p == 100 and h.startswith("é") or not h.startswith("é")))


def test_each_record_is_a_frame_behind_the_dictionary(spark, tmp_path):
    folder = str(tmp_path / "warc")
    (archive, *_), = [warc.write(pages_of(spark, rows(), 1).coalesce(1), folder).select("path").collect()]
    data = open(archive["path"].removeprefix("file://"), "rb").read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and 0 < size <= warc.DICTIONARY_BYTES
    known = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    first = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
    assert first.decompress(data[8 + size :]).startswith(b"WARC/1.1\r\n")
    assert zstandard.get_frame_parameters(data[8 + size :]).dict_id == known.dict_id()


def test_an_empty_table_and_one_without_html(spark, tmp_path):
    warc.write(pages_of(spark, []), str(tmp_path / "none"))
    assert warc.read(spark, str(tmp_path / "none")).count() == 0
    warc.write(pages_of(spark, [(1, None, None)]), str(tmp_path / "one"))
    (row,) = warc.read(spark, str(tmp_path / "one")).collect()
    assert (row.page_id, row.url, row.payload_bytes, row.record_type) == (1, "", 0, "response")


def test_damage_is_noticed(spark, tmp_path):
    path = str(tmp_path / "a.warc.zst")
    writer = warc.ArchiveWriter(f"file://{path}", b"")
    writer.add(warc.record("response", "1", "u", b"x" * 50, hashlib.sha256(b"x" * 50).hexdigest(), None))
    writer.close()
    data = open(path, "rb").read()
    assert len(list(warc.read_archive(f"file://{path}"))) == 1
    open(path, "wb").write(data[:-6])
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.read_archive(f"file://{path}"))


def test_archives_are_read_by_a_task_each_and_records_have_the_mandatory_fields(spark, tmp_path):
    folder = str(tmp_path / "warc")
    manifest = warc.write(pages_of(spark, rows()), folder, archive_bytes=500).select("path").collect()
    back = warc.read(spark, folder)
    assert len(manifest) > 4 and back.rdd.getNumPartitions() == len(manifest)
    read = back.select(F.spark_partition_id().alias("task"), "payload_digest").groupBy("task").count().count()
    assert read == len(manifest)
    for archive in manifest:
        for data in warc.read_archive(archive["path"]):
            fields, _ = warc.parse(data)
            assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(fields)
            assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["WARC-Date"])
