import base64
import gzip
import hashlib

import pytest

from salesforge.llm import warc_convert as W

SCHEMA = "page_id long, url string, html string, digest string, path int"


def _digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_both_arc_versions_are_read():
    for version in (1, 2):
        head = W.arc_head("x.arc", version)
        body = W.http_response(7, "a\n\nWARC/1.1\r\n\r\né".encode())
        data = head + W.arc_record("http://a/b c\n", body, version, len(head), "x.arc")
        (_, info, _), (at, fields, got) = W.read_arc(data)
        assert at == len(head) and got == body and info["URL"].startswith("filedesc://")
        assert fields["URL"] == "http://a/b%20c%0A" and fields["Archive-length"] == str(len(body))
        assert (fields.get("Checksum") == hashlib.md5(body).hexdigest()) == (version == 2)


def test_broken_archives_raise():
    head = W.arc_head("x.arc", 1)
    with pytest.raises(ValueError, match="cut off"):
        list(W.read_arc(head + b"http://a 0.0.0.0 20000101000000 text/html 99\nshort"))
    with pytest.raises(ValueError, match="fields"):
        list(W.read_arc(head + b"http://a 0.0.0.0 text/html 1\nx\n"))
    with pytest.raises(ValueError, match="version"):
        list(W.read_arc(head.replace(b"\n1 0 ", b"\n3 0 ")))
    with pytest.raises(ValueError, match="closed"):
        list(W.read_warc(b"WARC/1.1\r\nContent-Length: 2\r\n\r\nabcdef"))


@pytest.mark.parametrize("target", [1, 10**6])
def test_round_trip(spark, tmp_path, target):
    pages = [(5, "http://a/1", "same", "x", 1), (3, "http://a/2", "same", "x", 1), (9, None, "same", "x", 1),
             (1, "http://b/ x", None, "x", 1), (2, "u", "", "x", 1), (4, "u", "WARC/1.1\r\n\r\nContent-Length: 1", "x", 1),
             (6, "u", "é" * 50_000, "x", 1), (7, "u", "lone", "x", 1), (7, "u", "lone", "x", 1),
             (None, "u", "same", "x", 1)]
    W.write_arc(spark.createDataFrame(pages, SCHEMA), f"file://{tmp_path}/arc", target)
    W.convert(spark, f"file://{tmp_path}/arc", f"file://{tmp_path}/warc")
    got = sorted(map(tuple, W.read_records(spark, f"file://{tmp_path}/warc").collect()), key=repr)
    first = {}
    for page, _, html, *_ in pages:
        key = html or ""
        first[key] = min(first.get(key, 10**9), 10**9 if page is None else page)
    want, seen = [], set()
    for page, _, html, *_ in pages:
        key = html or ""
        response = page == first[key] and page not in seen
        seen.add(page)
        want.append((page, len(key.encode()), _digest(html), "response" if response else "revisit",
                     None if response else first[key]))
    assert got == sorted(want, key=repr)


def test_records_have_the_synthesised_headers(spark, tmp_path):
    pages = [(k, f"http://a/{k}", "same", "x", 1) for k in range(2)]
    W.write_arc(spark.createDataFrame(pages, SCHEMA).coalesce(1), f"file://{tmp_path}/arc")
    W.convert(spark, f"file://{tmp_path}/arc", f"file://{tmp_path}/warc")
    files = list((tmp_path / "warc").glob("part-*.gz"))
    assert len(files) == 1
    info, response, revisit = (h for h, _ in W.read_warc(gzip.decompress(files[0].read_bytes())))
    assert info["WARC-Type"] == "warcinfo" and response["WARC-Date"] == "2000-01-01T00:00:00Z"
    assert revisit["WARC-Refers-To"] == response["WARC-Record-ID"] != revisit["WARC-Record-ID"]
    assert response["WARC-Record-ID"].startswith("<urn:uuid:") and response["WARC-Target-URI"] == "http://a/0"


def test_empty_table(spark, tmp_path):
    W.write_arc(spark.createDataFrame([], SCHEMA), f"file://{tmp_path}/arc")
    W.convert(spark, f"file://{tmp_path}/arc", f"file://{tmp_path}/warc")
    assert W.read_records(spark, f"file://{tmp_path}/warc").count() == 0


def test_repeated_pages_have_ids_of_their_own(spark, tmp_path):
    rows = [(1, "http://a.org/", "same")] * 2 + [(2, "http://b.org/", "other")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    W.write_arc(df, f"{tmp_path}/arc")
    W.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    headers = [h for r in W.read_files(spark, f"{tmp_path}/warc").collect() for h, _ in W.read_warc(W._plain(r["content"]))]
    ids = [h["WARC-Record-ID"] for h in headers]
    assert len(set(ids)) == len(ids)
    (revisit,) = [h for h in headers if h["WARC-Type"] == "revisit"]
    assert revisit["WARC-Refers-To"] in ids and revisit["WARC-Refers-To"] != revisit["WARC-Record-ID"]
