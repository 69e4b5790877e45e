"""WARC files of both versions, framed by length, against a reader that walks the bytes."""

from jobstrata.llm import warc


def record(version, kind, key, block, more=b""):
    return b"WARC/%b\r\nWARC-Type: %b\r\nWARC-Record-ID: <urn:%b>\r\n%bContent-Length: %d\r\n\r\n" % (version, kind, key, more, len(block)) + block + b"\r\n\r\n"


def walked(data):
    out, at = [], 0
    while data.startswith(b"WARC/1.", at):
        end = data.index(b"\r\n\r\n", at)
        fields = dict(line.split(b": ", 1) for line in data[at:end].split(b"\r\n")[1:])
        size = int(fields[b"Content-Length"])
        block = data[end + 4 : end + 4 + size]
        out.append((fields[b"WARC-Record-ID"].decode(), block, len(block) == size))
        at = end + 8 + size
    return sorted(out)


def read(spark, path):
    return sorted((r["record_id"], bytes(r["block"]), r["complete"]) for r in warc.read_warc(spark, str(path)).collect())


def test_versions_and_heads(spark, tmp_path):
    blocks = [b"", b"plain", b"two\r\n\r\nparts", bytes(range(256)), b"x" * 200_000]
    data = b"".join(record((b"1.0", b"1.1")[k % 2], b"resource", b"r%d" % k, b, b"X-Odd: caf\xe9 \xff\r\n" if k == 3 else b"") for k, b in enumerate(blocks))
    (tmp_path / "a b%.warc").write_bytes(data)
    assert read(spark, tmp_path) == walked(data) and len(walked(data)) == 5


def test_blocks_that_hold_records(spark, tmp_path):
    inner = record(b"1.1", b"response", b"inner", b"body") + record(b"1.0", b"response", b"second", b"more" * 9)
    # An inner head that announces more than there is claims nothing.
    greedy = b"a\r\n\r\nWARC/1.0\r\nContent-Length: 99999\r\n\r\nrest\r\n\r\nWARC/1.1 and on"
    data = b"".join(record(b"1.1", b"resource", b"r%d" % k, b) for k, b in enumerate([b"first", inner, greedy, b"WARC/1.0", inner + inner, b"last"]))
    (tmp_path / "nested.warc").write_bytes(data)
    (tmp_path / "plain.warc").write_bytes(record(b"1.0", b"resource", b"p", b"p") + record(b"1.1", b"resource", b"q", b"q"))
    assert read(spark, tmp_path) == sorted(walked(data) + [("<urn:p>", b"p", True), ("<urn:q>", b"q", True)])


def test_a_file_that_is_cut_off(spark, tmp_path):
    data = (record(b"1.0", b"resource", b"a", b"one") + record(b"1.1", b"resource", b"b", b"x" * 100))[:-40]
    (tmp_path / "cut.warc").write_bytes(data)
    assert read(spark, tmp_path) == walked(data) and not walked(data)[1][2]


def test_metadata_against_what_was_written(spark):
    page = b"<html lang=\"pt\"><head><title> A &amp; B </title></head><body><a href='/x'>x</a> <a href=\"http://h/y?z=1&amp;k=2\">y</a></body></html>"
    http = b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html; charset=utf-8\r\nServer: s\r\n\r\n" + page
    head = {"WARC-Record-ID": "<urn:1>", "WARC-Target-URI": "http://h/p", "WARC-IP-Address": "1.2.3.4"}
    rows = spark.createDataFrame(
        [("response", "<urn:1>", "http://h/p", "2024-01-01T00:00:00Z", "application/http; msgtype=response", head, bytearray(http))],
        "warc_type string, record_id string, target_uri string, warc_date string, content_type string, headers map<string,string>, block binary",
    )
    made = {r["warc_type"]: r for r in warc.derive(rows).collect()}
    text = bytes(made["metadata"]["block"]).decode()
    for part in ("404", "A & B", "pt", "outlink: /x", "outlink: http://h/y?z=1&k=2"):
        assert part in text, (part, text)
    for kind in ("metadata", "conversion"):
        fields = made[kind]["headers"]
        assert fields["WARC-Refers-To"] == "<urn:1>" and fields["WARC-IP-Address"] == "1.2.3.4" and made[kind]["target_uri"] == "http://h/p"
        assert int(fields["Content-Length"]) == len(bytes(made[kind]["block"]))
