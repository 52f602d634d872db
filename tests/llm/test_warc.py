import base64
import hashlib

from gleanery.llm import warc

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
HTML = ["", "a" * 5000, "x" + FAKE + "y", "WARC/1.0\r\n" * 300, FAKE, "héé", None,
        "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 999999\r\n\r\n"]
ROWS = [(i, "http://x/é", h, "c") for i, h in enumerate(HTML * 3)] + [(None, "u\r\nv", "z", None), (None, None, "héé", None)]
SCHEMA = "page_id long, url string, html string, payload_bytes string"


def expected(rows):
    largest = {}
    for page, _, html, _ in rows:
        if page is not None:
            largest[html or ""] = max(page, largest.get(html or "", page))
    out = []
    for page, _, html, _ in rows:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        first = largest.get(html or "")
        revisit = first is not None and page != first
        out.append((page, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def read_back(spark, rows, span):
    path = warc.archive_folder(spark)
    warc.write_archive(spark.createDataFrame(rows, SCHEMA).coalesce(2), path)
    return warc.read_archive(spark, path, span=span, with_payload=True).collect()


def test_magic_in_payloads_small_splits_and_spans(spark, setting):
    setting("spark.sql.files.maxPartitionBytes", "1000")
    setting("spark.sql.files.openCostInBytes", "100")
    found = read_back(spark, ROWS, 700)
    assert sorted(
        [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found], key=str
    ) == expected(ROWS)
    assert all(r.intact for r in found if r.record_type == "response")
    payloads = {r.page_id: bytes(r.payload).decode() for r in found if r.record_type == "response"}
    assert payloads[18] == HTML[2] and payloads[19] == HTML[3]


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "u", "same", "c"), (1, "u", "same", "c"), (0, "u", "same", "c")]
    found = sorted((r.page_id, r.record_type) for r in read_back(spark, rows, warc.SPAN))
    assert found == [(0, "revisit"), (1, "response"), (1, "response")]
    assert read_back(spark, [], warc.SPAN) == []


def test_join_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_PAYLOADS", 0)
    found = read_back(spark, ROWS[:20], warc.SPAN)
    assert sorted(
        [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found], key=str
    ) == expected(ROWS[:20])


def test_pointer_jumping_equals_a_walk(spark):
    nodes = [("f", i * 10, i * 10 + (20 if i % 3 == 0 else 10)) for i in range(400)] + [("g", 5, 15), ("h", 0, 7)]
    df = spark.createDataFrame(nodes, "file string, offset long, next long")
    found = {(r.file, r.offset) for r in warc.reachable(df, span=64).collect()}
    walk, at, follow = {("h", 0)}, 0, {o: n for f, o, n in nodes if f == "f"}
    while at in follow:
        walk.add(("f", at))
        at = follow[at]
    assert found == walk
