import base64
import gzip
import hashlib
import zlib

import pytest

from tessera.llm import warc
from tessera.session import scratch_path


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


PAGES = (
    [(i, f"http://s{i % 7}.Example.com/p/{i % 40}?q=é", f"<p>{i % 25}</p>é") for i in range(300)]
    + [(1000, None, None), (1001, "no scheme", ""), (1002, "http://hot.org/", "hot"), (None, "http://null.org/a\r\nb", "<p>3</p>é"), (None, None, "only null")]
    + [(2000 + i, "http://hot.org/", "hot") for i in range(200)]
    + [(5, "http://s5.Example.com/p/5?q=é", "<p>5</p>é")]
)


def expected(min_bytes=0):
    first = {}
    for i, _, html in PAGES:
        body = (html or "").encode()
        if i is not None and len(body) >= min_bytes:
            first[body] = min(i, first.get(body, i))
    out = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        n = sum(1 for _, _, h in PAGES if (h or "").encode() == body)
        refers = first.get(body) if n > 1 and first.get(body) != i else None
        out.append((i, len(body), digest(body), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def archive(spark):
    folder = scratch_path(spark, "warc-test")
    df = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, key string").repartition(4)
    manifest = warc.write_archives(df, folder)
    shards = warc.build_index(manifest, folder, block_lines=16)
    return df, folder, manifest, shards


def test_round_trip_through_the_index(spark, archive):
    df, folder, manifest, shards = archive
    keys = df.select(warc.url_key(df["url"]).alias("key"))
    back = warc.read_records(warc.lookup(keys, shards, folder), folder).collect()
    got = sorted(((int(r["record_id"]) if r["record_id"] else None, r["payload_bytes"], r["payload_digest"], r["record_type"], int(r["refers_to"]) if r["refers_to"] else None) for r in back), key=repr)
    assert got == expected()
    bodies = sorted((html or "").encode() for _, _, html in PAGES)
    for r in back:
        assert r["payload"] is None if r["record_type"] == "revisit" else digest(bytes(r["payload"])) == r["payload_digest"]
        assert r["payload"] is None or bytes(r["payload"]) in bodies


def test_index_is_sorted_and_finds_exactly_a_key(spark, archive):
    df, folder, manifest, shards = archive
    fs, base = warc.open_folder(folder)
    lines = []
    for s in sorted(shards.collect(), key=lambda r: r["first"].encode()):
        f = warc.IndexFile(fs, f"{base}/{s['file']}")
        for k in range(len(f.directory)):
            f.block(k)
            lines += [x[0].encode() for x in f.lines]
    assert lines == sorted(lines) and len(lines) == len(PAGES)
    keys = spark.createDataFrame([("org,hot)/",), ("org,missing)/",), ("",), ("~",), (None,), ("org,hot)/",)], "key string")
    found = warc.lookup(keys, shards, folder).collect()
    assert len(found) == 201 + sum(u is None or "://" not in u for _, u, _ in PAGES)


def test_files_are_standard_gzip_members(spark, archive):
    _, folder, manifest, _ = archive
    fs, base = warc.open_folder(folder)
    r = manifest.orderBy("file", "offset").first()
    raw = fs.open_input_file(f"{base}/{r['file']}").read()
    assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == manifest.where(manifest["file"] == r["file"]).count()
    one = zlib.decompress(raw[r["offset"] : r["offset"] + r["length"]], 31)
    assert one.startswith(b"WARC/1.1\r\nWARC-Type: ") and one.endswith(b"\r\n\r\n")


def test_min_bytes(spark):
    df = spark.createDataFrame([(2, "u", "long enough"), (1, "u", "long enough"), (3, "u", "x"), (4, "u", "x")], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-min")
    m = warc.write_archives(df, folder, min_bytes=5)
    back = warc.read_records(m, folder).collect()
    assert sorted((r["record_id"], r["record_type"], r["refers_to"]) for r in back) == [("1", "response", None), ("2", "revisit", "1"), ("3", "response", None), ("4", "response", None)]


def test_keys(spark):
    rows = [("https://www.A.com/x?y#z", "com,a,www)/x?y#z"), ("http://a.com", "com,a)"), (None, ""), ("x", ""), ("s://", ")")]
    df = spark.createDataFrame([(u,) for u, _ in rows], "url string")
    assert [r[0] for r in df.select(warc.url_key(df["url"])).collect()] == [k for _, k in rows]


def test_empty_table(spark):
    folder = scratch_path(spark, "warc-empty")
    df = spark.createDataFrame([], "page_id long, url string, html string")
    shards = warc.build_index(warc.write_archives(df, folder), folder)
    assert warc.read_records(warc.lookup(spark.createDataFrame([("a",)], "key string"), shards, folder), folder).count() == 0


def test_digest_mismatch_fails(spark):
    raw = warc.record("1", None, b"body", None).replace(b"body", b"bode")
    w, h, body = warc.parse_record(raw)
    assert warc.base32_sha1(body) != w["warc-payload-digest"].removeprefix("sha1:")
