"""Archives: round trips, and what is recovered from damaged ones."""

import gzip
import os
import random
import time

import pytest

from docmill.llm import warc
from docmill.llm.common import new_path


def record(n, payload):
    return warc.encode_record(n, f"http://x.example/{n}", payload, warc.sha1_base32(payload), None)


def ids(data):
    return [x.headers["warc-record-id"] for x in warc.salvage(data) if isinstance(x, warc.Record)]


def gaps(data):
    return [(x.offset, x.length) for x in warc.salvage(data) if isinstance(x, warc.Gap)]


MEMBERS = [record(n, b"payload %d " % n * 50) for n in range(5)]


def test_whole():
    data = b"".join(MEMBERS)
    assert len(ids(data)) == 5 and gaps(data) == []
    assert list(warc.salvage(b"")) == []


def test_damaged_member():
    at = len(MEMBERS[0]) + len(MEMBERS[1])
    data = bytearray(b"".join(MEMBERS))
    data[at + 30] ^= 0xFF
    assert ids(bytes(data)) == [f"<urn:page:{n}>" for n in (0, 1, 3, 4)]
    assert gaps(bytes(data)) == [(at, len(MEMBERS[2]))]


def test_cut_end_and_noise():
    data = b"noise" + MEMBERS[0] + b"\x1f\x8b\x08 more WARC/1. noise" + MEMBERS[1] + MEMBERS[2][:-9]
    assert ids(data) == ["<urn:page:0>", "<urn:page:1>"]
    assert [n for _, n in gaps(data)] == [5, 22, len(MEMBERS[2]) - 9]


def test_plain_records():
    parts = [gzip.decompress(m) for m in MEMBERS]
    data = parts[0] + parts[1][:-30] + parts[2] + b"\0\0" + parts[3]
    assert ids(data) == [f"<urn:page:{n}>" for n in (0, 2, 3)]


def test_wrong_digest():
    bad = gzip.decompress(MEMBERS[0]).replace(b"payload 0", b"payload 9", 1)
    assert ids(bad + gzip.decompress(MEMBERS[1])) == ["<urn:page:1>"]


def test_round_trip(spark):
    """Nulls, empty pages, equal payloads, repeated rows, clashing columns; all payloads come back."""
    rows = [(1, "u1", "same"), (5, "u5", "same"), (3, None, None), (4, "a b", ""), (None, "n", "same"), (7, "u7", "é" * 100_000), (5, "u5", "same"), (None, "m", "alone")]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, uid string, payload string")
    path = new_path(spark, "warc-test")
    warc.archive(pages, path)
    got = warc.read(spark, path).collect()
    assert all(r.gap_bytes is None for r in got) and len(got) == len(rows)
    seen = sorted((r.record_id, r.record_type, r.refers_to or "", r.payload_bytes) for r in got)
    assert seen == sorted([
        ("<urn:page:1>", "revisit", "<urn:page:5>", 4), ("<urn:page:5>", "response", "", 4), ("<urn:page:5>", "response", "", 4), ("<urn:page:>", "revisit", "<urn:page:5>", 4),
        ("<urn:page:3>", "revisit", "<urn:page:4>", 0), ("<urn:page:4>", "response", "", 0), ("<urn:page:7>", "response", "", 200_000), ("<urn:page:>", "response", "", 5),
    ])
    assert {r.payload_digest for r in got} == {warc.sha1_base32((h or "").encode()) for _, _, h in rows}


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = new_path(spark, "warc-test")
    assert warc.archive(pages, path).count() == 0
    assert warc.read(spark, path).count() == 0


def test_any_damage_by_brute_force():
    """Single bytes changed anywhere: records whose bytes are whole are found, gaps cover the rest, and nothing overlaps."""
    rng = random.Random(2)
    starts = [sum(map(len, MEMBERS[:i])) for i in range(6)]
    for _ in range(200):
        data = bytearray(b"".join(MEMBERS))
        at = rng.randrange(len(data))
        data[at] ^= 1 << rng.randrange(8)
        hurt = max(i for i in range(5) if starts[i] <= at)
        found = list(warc.salvage(bytes(data)))
        assert {f"<urn:page:{n}>" for n in range(5) if n != hurt} <= {x.headers["warc-record-id"] for x in found if isinstance(x, warc.Record)}
        end = 0
        for x in found:
            assert x.offset == end
            end += x.length
        assert end == len(data)


@pytest.mark.parametrize("window", [16, 100, 5000])
def test_windows_change_nothing(window, monkeypatch):
    """Records, headers and damage that lie across windows."""
    parts = [gzip.decompress(m) for m in MEMBERS]
    data = b"noise" + MEMBERS[0] + parts[1] + MEMBERS[2][:-9] + b"WARC/1" + parts[3] + MEMBERS[4]
    whole, places = [x for x in warc.salvage(data) if isinstance(x, warc.Record)], gaps(data)
    monkeypatch.setattr(warc, "WINDOW", window)
    monkeypatch.setattr(warc, "CHUNK", 7)
    assert [x for x in warc.salvage(data) if isinstance(x, warc.Record)] == whole and gaps(data) == places and len(whole) == 4


@pytest.mark.parametrize("plain", [False, True])
def test_time_is_in_proportion(plain):
    """Archives of 32 and 128 MB, with damage in both: four times the bytes take about four times as long."""
    payload = os.urandom(60_000)
    one = record(1, payload)
    one = gzip.decompress(one) if plain else one
    took = []
    for n in (32, 128):
        data = bytearray(one * (n * (1 << 20) // len(one)))
        for at in range(30_000, len(data), len(data) // 20):
            data[at] ^= 0xFF
        began = time.process_time()
        found = list(warc.salvage(bytes(data)))
        took.append(time.process_time() - began)
        assert sum(isinstance(x, warc.Record) for x in found) >= len(data) // len(one) - 22
    assert took[1] < 8 * took[0] + 0.5


def test_an_end_that_never_comes():
    """Version lines without an end, and members that unpack to no record, are given up early."""
    bomb = gzip.compress(b"x" * (50 << 20))
    began = time.process_time()
    assert ids(bomb * 20 + b"WARC/1.1 " * 20000 + MEMBERS[0]) == ["<urn:page:0>"]
    assert time.process_time() - began < 20


def test_gaps_are_logged(spark, caplog):
    """Damaged archives: records come back, and gaps are in a table of their own."""
    path = new_path(spark, "warc-test")
    warc.archive(spark.createDataFrame([(i, f"u{i}", f"page {i} " * 50) for i in range(40)], "page_id long, url string, html string").coalesce(1), path)
    root = path.removeprefix("file://")
    name = next(f for f in sorted(os.listdir(root)) if f.endswith(".warc.gz"))
    data = bytearray(open(f"{root}/{name}", "rb").read())
    data[len(data) // 2] ^= 0xFF
    open(f"{root}/{name}", "wb").write(bytes(data))
    found = warc.read(spark, path).cache()
    with caplog.at_level("WARNING"):
        kept = warc.quarantine(found, path)
    gaps = spark.read.parquet(f"{path}-quarantine").collect()
    assert kept.count() == 39 and len(gaps) == 1 and gaps[0].gap_bytes > 0 and gaps[0].archive.endswith(name)
    assert "1 gaps" in caplog.text
    assert kept.columns == [c.split()[0] for c in warc.READ.split(", ") if not c.startswith("gap_")]
