import hashlib
import os
import random
import re

from docmill.llm import dedup


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def test_edge_rows(docs):
    rows, found = dedup.groups(docs)
    got = found.collect()
    assert sorted([(r.id, r.keep_id, r.group_size, r.digest) for r in got], key=str) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r._uid == r.keep_uid for r in got) == len({r.digest for r in got})


def test_one_row_of_each_group_stays(docs):
    kept = dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len({(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")) for r in docs.collect()})
    assert sorted(r.doc_id for r in rows if r.text and r.text.startswith("Hello")) == [1]


def test_empty(none):
    assert dedup.deduplicate(none).count() == 0


def test_spills_and_recursion(tmp_path, monkeypatch):
    """A bucket beyond the table is cut again and again, and its groups are the same."""
    monkeypatch.setattr(dedup, "TABLE_BYTES", 300)
    rng = random.Random(1)
    rows = [(i, rng.getrandbits(60), b"x" * 20) for i in range(200)]
    rows += [(1000 + i, rows[i % 50][1], rows[i % 50][2]) for i in range(200)]
    got = [p for pairs in dedup._grace(iter(rows), str(tmp_path), 0, [], 0) for p in pairs]
    assert len(got) == 400
    first = {h: i for i, h, _ in reversed(rows)}
    assert {i: first[h] for i, h, _ in rows} == dict(got)


def test_copies_take_no_room(tmp_path, monkeypatch):
    """A group of equal texts beyond the table's bytes is neither spilled nor held, before others and among them."""
    monkeypatch.setattr(dedup, "TABLE_BYTES", 300)
    spilled = []
    monkeypatch.setattr(dedup.pickle, "dump", lambda row, f, protocol, dump=dedup.pickle.dump: (spilled.append(row), dump(row, f, protocol)))
    copies = [(i, 77, b"y" * 200) for i in range(500)]
    assert [p for pairs in dedup._grace(iter(copies), str(tmp_path), 0, [], 0) for p in pairs] == [(i, 0) for i in range(500)]
    assert not spilled
    mixed = [r for i, c in enumerate(copies) for r in (c, (1000 + i, i * 0x9E3779B97F4A7C15 % (1 << 60), b"%d" % i * 9))]
    got = [p for pairs in dedup._grace(iter(mixed), str(tmp_path), 0, [], 0) for p in pairs]
    assert dict(got) == {uid: 0 if h == 77 else uid for uid, h, _ in mixed} and len(got) == 1000
    assert spilled and not [r for r in spilled if r[1] == 77]


def test_equal_hashes_are_compared_in_full():
    table = dedup.Table()
    assert table.find(5, b"a") == (0, True)
    assert table.find(5, b"b") == (1, True)
    assert table.find(5, b"a") == (0, False)
    for i in range(500):
        table.find(i, b"%d" % i)
    assert table.find(5, b"b") == (1, False)


def test_release_deletes_what_was_staged(spark, docs):
    from docmill.llm import common

    staged = [common.stage(docs, "one"), common.stage(docs, "two")]
    paths = [df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").replace("//", "/") for df in staged]
    assert all(map(os.path.exists, paths))
    assert common.release(spark) >= 2 and common.release(spark) == 0
    assert not any(map(os.path.exists, paths))
