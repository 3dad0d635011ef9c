"""WARC writing, reading back and salvage of damaged archives."""

import base64
import gzip
import hashlib
import io
import random

import pytest

from loanlake.llm import queries, warc_salvage as W
from conftest import SMALL


def record(i, payload, **kw):
    return W.page_record(i, b"http://x/%d" % i, payload, W.digest32(payload), False, None)


def read(data):
    return list(W.salvage(io.BytesIO(data), len(data)))


def covered(found, size):
    at = 0
    for f in found:
        assert f[1] == at and f[2] > 0
        at += f[2]
    assert at == size


@pytest.mark.parametrize("pack", [W.gzip_member, bytes])
def test_salvage_after_damage(pack):
    rng = random.Random(5)
    payloads = [b"page %d WARC/1.1\r\n \x1f\x8b\x08" % i + rng.randbytes(rng.randint(0, 4000)) for i in range(30)]
    members = [pack(record(i, p)) for i, p in enumerate(payloads)]
    whole = b"".join(members)
    assert [f[4] for f in read(whole)] == payloads
    for trial in range(40):
        broken, lost = list(members), set()
        for i in rng.sample(range(30), rng.randint(1, 4)):
            m, kind = bytearray(broken[i]), rng.randrange(4)
            if kind == 0:
                m[rng.randrange(len(m) // 2, len(m) - 8)] ^= 0x55
            elif kind == 1:
                m = m[:rng.randrange(1, len(m) - 1)]
            elif kind == 2:
                m = bytearray(b"junk\x1f\x8b\x08 WARC/1.0\r\n junk") + m
            else:
                m = bytearray(rng.randbytes(rng.randint(1, 900)))
            broken[i] = bytes(m)
            if kind != 2:
                lost.add(i)
        data = b"".join(broken)
        found = read(data)
        covered(found, len(data))
        got = [f[4] for f in found if f[0] == "record"]
        assert [p for i, p in enumerate(payloads) if i not in lost] == got
        assert any(f[0] == "gap" and f[3] for f in found)


def test_foreign_archives():
    plain = (b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
             b"WARC/1.0\r\nwarc-type: resource\r\ncontent-length:0\r\n\r\n\r\n\r\n")
    assert [f[4] for f in read(plain)] == [b"abcd", b""]
    cut = plain.index(b"WARC/1.0", 1)
    assert [f[4] for f in read(gzip.compress(plain[:cut]) + plain[cut:])] == [b"abcd", b""]
    assert read(b"") == []
    assert [f[0] for f in read(b"no archive at all" * 50000)] == ["gap"]
    assert [f[0] for f in read(plain + b"WARC/1.0\r\nContent-Length: 99\r\n\r\nshort")] == ["record", "record", "gap"]


def expected(rows):
    first = {}
    for i, html in rows:
        if i is not None:
            key = (html or "").encode()
            first[key] = min(first.get(key, i), i)
    out = []
    for i, html in rows:
        p = (html or "").encode()
        d = base64.b32encode(hashlib.sha1(p).digest()).decode()
        to = first.get(p)
        out.append((i, len(p), d, "response" if to is None or to == i else "revisit", None if to is None or to == i else to))
    return sorted(out, key=str)


def test_round_trip_with_revisits(spark):
    rows = [(i, f"<p>{i % 5}</p>" if i < 40 else f"<b>é{i}</b>") for i in range(80)]
    rows += [(90, None), (91, ""), (None, "<p>0</p>"), (None, "only without id"), (95, "x" * 300000), (92, None), (90, None)]
    df = spark.createDataFrame([(i, f"http://a/{i}\r\n x", h, 1) for i, h in rows], "page_id long, url string, html string, sha int")
    out = W.round_trip(df)
    got = sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers) for r in out.where("kind = 'record'").select(
        W.page_number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        W.page_number("refers_to").alias("refers")).collect()], key=str)
    assert got == expected(rows)
    assert out.where("kind = 'gap'").count() == 0
    texts = {bytes(r.payload) for r in out.where("record_type = 'response'").collect()}
    assert texts == {(h or "").encode() for _, h in rows}
    assert W.round_trip(df.limit(0)).collect() == []


def test_archives_damaged_on_disk_are_salvaged(spark, tmp_path):
    df = spark.createDataFrame([(i, f"<p>{i}</p>" * 50) for i in range(20)], "page_id long, html string").coalesce(1)
    manifest = W.write_archives(df, str(tmp_path / "a"), url=None).collect()
    assert sum(r.records for r in manifest) == 20
    path = manifest[0].path
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 0xFF
    open(path, "wb").write(data + b"tail")
    out = W.read_archives(spark.createDataFrame([(r.path,) for r in manifest], "path string")).collect()
    kinds = [r.kind for r in out]
    assert kinds.count("record") == 19 and kinds.count("gap") == 2
    assert sum(r.length for r in out) == len(data) + 4 + sum(r.size for r in manifest[1:])


def test_query_on_pages(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "html").collect()]
    assert sorted(map(tuple, queries.op9_warc_salvage(spark, SMALL).collect()), key=str) == expected(rows)


def test_long_and_folded_headers_and_digest_spellings():
    payload = b"<p>body</p>"
    long = W.page_record(1, b"http://x/" + b"u" * (3 << 20), payload, W.digest32(payload), False, None)
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    sha, of_block = hashlib.sha1(payload), hashlib.sha1(block)
    digests = [b"sha1:" + sha.hexdigest().encode(), b"SHA1:" + sha.hexdigest().upper().encode(),
               b"sha1:" + W.digest32(payload).lower(), b"md5:whatever", b"sha1:no-digest"]
    records = [long]
    for d in digests:
        records.append(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: <http://a/\r\n  b>\r\nContent-Type: application/http\r\n"
                       b"WARC-Payload-Digest: " + d + b"\r\nWARC-Block-Digest: sha1:" + of_block.hexdigest().encode()
                       + b"\r\nContent-Length:\r\n %d\r\n\r\n" % len(block) + block + b"\r\n\r\n")
    for pack in (bytes, W.gzip_member):
        found = read(b"".join(map(pack, records)))
        assert [f[0] for f in found] == ["record"] * 6 and {f[4] for f in found} == {payload}
        assert found[1][3][b"warc-target-uri"] == b"<http://a/ b>" and len(found[0][3][b"warc-target-uri"]) == 9 + (3 << 20)
    wrong = records[1].replace(sha.hexdigest().encode(), b"0" * 40)
    # a header without an end is given up at the next version line
    endless = b"WARC/1.0\r\nX: " + b"y" * 5_000_000 + b"\r\n"
    found = read(wrong + endless + records[2])
    assert [(f[0], f[3]) for f in found][0] == ("gap", "payload digest") and [f[0] for f in found] == ["gap", "record"]
    covered(found, len(wrong + endless + records[2]))


def test_pages_with_very_long_urls_come_back(spark):
    rows = [(1, "http://a", "x"), (2, "http://b/" + "u" * (1 << 20), "y"), (3, "http://c", "x")]
    out = W.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"), payloads=False)
    assert "payload" not in out.columns and out.where("kind = 'gap'").count() == 0
    assert sorted(W_ids(out)) == [1, 2, 3]


def W_ids(records):
    return [r[0] for r in records.where("kind = 'record'").select(W.page_number("record_id")).collect()]


def test_an_archive_is_read_by_a_task_of_its_own(spark, tmp_path):
    df = spark.createDataFrame([(i, f"<p>{i}</p>") for i in range(90)], "page_id long, html string").repartition(9)
    manifest = W.write_archives(df, str(tmp_path / "a"), url=None)
    read = W.read_archives(manifest.select("path"))
    tasks = read.selectExpr("spark_partition_id() AS task", "path").distinct().groupBy("task").count().collect()
    assert len(tasks) == manifest.count() == 9 and {r["count"] for r in tasks} == {1}
    W.check_counts(manifest, read)
    with pytest.raises(RuntimeError, match="records written"):
        W.check_counts(manifest, read.where("record_id <> '<urn:page:7>'"))
