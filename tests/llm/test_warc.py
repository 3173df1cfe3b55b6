import base64
import gzip
import hashlib

import pytest
from pyspark.sql import Row

from tessera.llm import warc as op

SF = "/root/testdata/sf0.001"


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    top = {t: max((x for x in ids if x is not None), default=None) for t, ids in groups.items()}
    out, seen = [], set()
    for i, t in rows:
        t = t or ""
        first = i == top[t] and t not in seen
        if first:
            seen.add(t)
        out.append((i, len(t.encode()), digest(t), "response" if first else "revisit", None if first else top[t]))
    return sorted(out, key=str)


def test_query_against_brute_force(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert sorted(map(tuple, op.q_warc(spark, SF).collect()), key=str) == brute(rows)


def test_edge_cases(spark, tmp_path):
    odd = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n"
    rows = [(1, None), (2, ""), (2, ""), (3, odd), (4, odd + "\r\n"), (None, odd), (None, "n"), (None, "n"), (5, "ü" * 300_000),
            (6, "ü" * 300_000), (7, "\n"), (8, "\x00\x01")] + [(100 + i, "hot") for i in range(2000)]
    urls = [None, "", "http://x.org", "https://h/p?q#f", "no url", "http://a\r\nWARC-Type: x/b"]
    df = spark.createDataFrame([Row(page_id=i, url=urls[k % 6], html=t, n="x", row=1, sha=2) for k, (i, t) in enumerate(rows)],
                               "page_id long, url string, html string, n string, row int, sha int").repartition(4)
    path = str(tmp_path / "w")
    op.write_archives(df, path)
    got = sorted(map(tuple, op.captures(spark, path).collect()), key=str)
    assert got == brute(rows)
    nested = op.assemble(op.read_records(spark, path)).collect()
    assert len(nested) == len(rows) and all(len(r.requests) == len(r.metadata) == 1 for r in nested)
    assert {bytes(r.payload) for r in nested if r.type == "response"} == {(t or "").encode() for _, t in rows}
    ids = [r.record_id for r in op.read_records(spark, path).collect()]
    assert len(ids) == len(set(ids)) == 3 * len(rows)
    empty = str(tmp_path / "e")
    op.write_archives(df.limit(0), empty)
    assert op.captures(spark, empty).count() == 0


def test_small_payloads_are_all_responses(spark, tmp_path):
    df = spark.createDataFrame([Row(page_id=i, url="u", html=t) for i, t in [(1, "ab"), (2, "ab"), (3, "abc"), (4, "abc")]])
    op.write_archives(df, str(tmp_path / "w"), least_revisit=3)
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in op.captures(spark, str(tmp_path / "w")).collect())
    assert got == [(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)]


def test_parser():
    block = b"HTTP/1.1 200 OK\r\n\r\nhi"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    got = list(op.parse_records(record * 3))
    assert len(got) == 3 and all(r["block"] == block and r["record_id"] == "<urn:x>" for r in got)
    zipped = gzip.compress(record) + gzip.compress(record * 2)
    assert [r["block"] for r in op.parse_records(zipped)] == [block] * 3
    with pytest.raises(ValueError):
        list(op.parse_records(record[:-10]))
    with pytest.raises(ValueError):
        list(op.parse_records(b"junk" + record))
    with pytest.raises(ValueError):
        op._checked(got[0] | {"payload_digest": "sha1:WRONG"}, True)
    assert op._checked(got[0], False)["block"] == b"HTTP/1.1 200 OK\r\n\r\n" and op._checked(got[0], False)["payload_bytes"] == 2
