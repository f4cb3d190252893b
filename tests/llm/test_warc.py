import base64
import gzip
import hashlib
import io
import random
from pathlib import Path

import pytest

from millrace.llm import warc

SCHEMA = "page_id long, url string, html string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], SCHEMA)


def brute(rows, least=0):
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        ids = [j for j, _, g in rows if (g or "").encode() == raw and j is not None]
        first = max(ids, default=None)
        older = len(raw) >= least and first is not None and i != first
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if older else "response", first if older else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    rnd = random.Random(least)
    payloads = [None, "", "a", "é" * 10, "\r\n\r\nWARC/1.1\r\n", "long" * 50_000, "".join(chr(rnd.randrange(32, 900)) for _ in range(3000))]
    rows = [(i, rnd.choice([None, "http://x/\r\ny", "http://é"]), rnd.choice(payloads)) for i in range(60)] + [(60, "u", f"own {i}") for i in range(2)] + [(None, "u", "a"), (None, None, "alone"), (7, "u", "a"), (7, "u", "a")]
    got = warc.round_trip(pages(spark, rows), least)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == brute(rows, least)


def test_no_pages(spark):
    assert warc.round_trip(pages(spark, [])).count() == 0


def record(payload=b"p", refers=None):
    return warc.record(5, "u", payload, hashlib.sha1(payload).digest(), refers)


def read(data, piece=None):
    f = io.BytesIO(data)
    return list(warc.read_records(lambda n: f.read(piece or n)))


def test_one_member_a_record():
    data = warc.member(record()) + warc.member(record(b"q" * 100_000)) + warc.member(record(b"z", 9))
    assert gzip.decompress(data) == record() + record(b"q" * 100_000) + record(b"z", 9)
    for piece in (1, 7, 100, None):
        got = read(data, piece)
        assert [(r[0], r[1], r[3], r[4]) for r in got] == [(5, 1, "response", None), (5, 100_000, "response", None), (5, 1, "revisit", 9)]
        assert [r[5] for r in got] == [0, len(warc.member(record())), len(warc.member(record())) + len(warc.member(record(b"q" * 100_000)))]


@pytest.mark.parametrize("harm", [
    lambda r: warc.member(r)[:-12], lambda r: warc.member(r.replace(b"\r\n\r\np", b"\r\n\r\nx")), lambda r: warc.member(r[:-4]), lambda r: warc.member(r + b"x"), lambda r: r,
    lambda r: warc.member(r.replace(b"WARC/1.1", b"NOPE/1.1")), lambda r: warc.member(r.replace(b"WARC-Type", b"WARC-Tipe")), lambda r: warc.member(r.replace(b"\r\n\r\n", b"\r\n")),
])
def test_broken_archives(harm):
    with pytest.raises(warc.WarcError):
        read(harm(record()))


def test_files_are_real_archives(spark, tmp_path):
    files = warc.write_archives(warc.decide(pages(spark, [(i, "u", "same") for i in range(5)])), f"file://{tmp_path}/w")
    assert sum(n for _, n in files) == 5 and sorted(p.name for p in Path(tmp_path, "w").iterdir()) == [n for n, _ in files]
    text = b"".join(gzip.decompress(Path(tmp_path, "w", n).read_bytes()) for n, _ in files)
    assert text.count(b"WARC-Type: response") == 1 and text.count(b"WARC-Refers-To: <urn:x-page:4>") == 4


def test_a_very_long_url(spark):
    rows = [(1, "http://x/" + "u" * 3_000_000, "a"), (2, "http://y/", "a"), (3, None, "b")]
    assert sorted((tuple(r)[:5] for r in warc.round_trip(pages(spark, rows)).collect()), key=str) == brute(rows)


def test_a_revisit_needs_its_response(spark):
    kind = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    rows = [(5, 1, "A", "response", None), (4, 1, "A", "revisit", 5), (3, 1, "A", "revisit", 5), (2, 2, "A", "revisit", 5), (1, 1, "B", "revisit", 5), (0, 1, "A", "revisit", 9)]
    assert warc.dangling(spark.createDataFrame(rows[:3], kind)).isEmpty()
    assert sorted(tuple(r) for r in warc.dangling(spark.createDataFrame(rows, kind)).collect()) == [(5, "A", 2), (5, "B", 1), (9, "A", 1)]
