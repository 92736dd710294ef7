"""Encoding, token files, separator scan, packing and byte-level BPE against the libraries themselves."""

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docmill.llm import bytebpe, packing, pieces, tokenfiles

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tik():
    import tiktoken

    ranks = {t: i for i, t in enumerate(pieces.read_ranks(BYTE))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def expected(docs, plain, end):
    """(doc_id, ids) in ascending order of doc_id, null first."""
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.collect()), key=lambda r: r[:2])
    return [(i if there else None, [*plain(t), end]) for there, i, t in rows]


TEXTS = st.lists(st.text(st.one_of(st.sampled_from(" \n\t'abcABCst.,*0é́日\x1c \u0085"), st.characters(codec="utf-8")), max_size=40), min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_word_pieces(plain, texts):
    ids, counts = pieces.word_encoder(WORD).encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [plain(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_byte_pieces(tik, texts):
    ids, counts = pieces.byte_encoder(BYTE, P.PATTERN).encode(pa.array(texts))
    each = np.split(ids, np.cumsum(counts)[:-1])
    assert [x.tolist() for x in each] == [tik.encode_ordinary(t) for t in texts]
    table = bytebpe.byte_table(BYTE)
    assert [bytebpe.decode_text(table, x) for x in each] == texts


def test_pieces_beyond_memory(plain, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    encoder = pieces.WordEncoder(pieces.word_encoder(WORD).tokenizer)
    for texts in (["one two three four five"], ["two six seven", "one eight"], ["nine two"]):
        ids, counts = encoder.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [plain(t) for t in texts]


def test_offsets():
    ids, _ = pieces.byte_encoder(BYTE, P.PATTERN).encode(pa.array(["a \U0001f600é"]))
    table = bytebpe.byte_table(BYTE)
    starts, chars = table.byte_offsets(ids), table.character_offsets(ids)
    data = "a \U0001f600é".encode()
    assert starts[0] == 0 and chars[0] == 0
    assert all(len(data[:s].decode("utf-8", "ignore")) == c for s, c in zip(starts, chars, strict=True))


def test_split_character_is_replaced():
    table = bytebpe.byte_table(BYTE)
    one = {t: i for i, t in enumerate(pieces.read_ranks(BYTE))}
    assert bytebpe.decode_text(table, np.array([one[b"\xc3"]])) == "�"
    assert bytebpe.decode_text(table, np.array([one[b"\xc3"], one[b"\xa9"]])) == "é"


def test_byte_bpe(docs, none, tik):
    got = bytebpe.digest(docs, BYTE, P.PATTERN).drop("offsets_crc32", "n_split").collect()
    want = [(r.doc_id, len(ids := tik.encode_ordinary(r.text or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bytebpe.digest(none, BYTE, P.PATTERN).count() == 0


def test_encode_with_offsets(docs):
    for r in bytebpe.encode(docs, BYTE, P.PATTERN, offsets=True).collect():
        assert len(r.byte_starts) == len(r.character_starts) == len(r.ids) == 4 * r.n_tokens


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_numbers(values):
    control, data = tokenfiles.pack_numbers(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert tokenfiles.unpack_numbers(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(values)).tolist() == values


def test_ranked_files(docs, none, plain):
    got = sorted(tokenfiles.ranked_round_trip(docs).collect(), key=lambda r: r.start)
    start = 0
    for r, (doc_id, ids) in zip(got, expected(docs, plain, 1), strict=True):
        assert (r.doc_id, r.start, r.n_tokens) == (doc_id, start, len(ids)) and r.ids_crc32 == crc(ids)
        start += len(ids)
    assert tokenfiles.ranked_round_trip(none).count() == 0


def test_ranks_follow_frequency(docs, plain):
    table = tokenfiles.encoded(docs, WORD, 1, 49408)
    counts = np.zeros(49408, int)
    for r in docs.collect():
        np.add.at(counts, [*plain(r.text), 1], 1)
    assert tokenfiles.ranks(table, 49408).tolist() == np.lexsort((np.arange(49408), -counts)).tolist()


@pytest.mark.parametrize("block", [7, 1000, 1 << 20])
def test_separator_scan(docs, none, plain, block):
    got = sorted(tokenfiles.scan_counts(docs, block=block).collect(), key=lambda r: r.start)
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens + 1
    assert sorted([(r.doc_id, r.n_tokens) for r in got], key=str) == sorted([(r.doc_id, len(plain(r.text))) for r in docs.collect()], key=str)
    assert tokenfiles.scan_counts(none).count() == 0


def test_packing(docs, none, plain):
    got = packing.pack(docs, size=64).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in got if r.doc_id) == sorted((i, s, len(ids[s : s + 64]), crc(ids[s : s + 64])) for i, ids in expected(docs, plain, 0) if i for s in range(0, len(ids), 64))
    assert all(r.start == 64 * r.piece for r in got)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) <= -(-sum(r.length for r in got) // 64) + 2
    assert packing.pack(none).count() == 0


def test_packed_ids(docs, plain):
    table = packing.cut(docs, WORD, 0, 64)
    placed = packing.assign(table.drop("ids"), 64)
    got = packing.sequences(table, placed).collect()
    assert all(len(r.ids) == 4 * r.n_tokens <= 256 for r in got)
    assert sum(r.n_tokens for r in got) == sum(len(ids) for _, ids in expected(docs, plain, 0))


def test_packing_in_few_tasks(spark):
    """Groups share tasks, each of which writes a file; full pieces take no tasks beside them, and each group is packed as if by itself."""
    table = spark.range(1200).selectExpr("id as uid", "0 as piece", "if(id % 3 = 0, 64, 1 + pmod(hash(id), 63)) as length").withColumn("length", F.col("length").cast("long"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        placed = packing.assign(table, 64, 20)  # 40 groups, and 20 of full pieces
        assert placed.rdd.getNumPartitions() == 15
        got = placed.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(r.uid for r in got) == list(range(1200))
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sorted(parts)[k][0] == sum(n for _, n in sorted(parts)[:k]) for parts in by.values() for k in range(len(parts)))
    assert sum(parts == [(0, 64)] for parts in by.values()) == 400
    groups = {}
    for r in table.withColumn("g", F.expr("pmod(xxhash64(uid, piece), 40)")).filter("length < 64").collect():
        groups.setdefault(r.g, []).append(r.length)
    made = 0
    for lengths in groups.values():
        packer = packing.SumOfSquares(64)
        for n in sorted(lengths, reverse=True):
            packer.place(n)
        made += packer.made
    assert len(by) == 400 + made


@pytest.mark.parametrize(("groups", "partitions", "tasks"), [(1, 50, 1), (3, 50, 3), (12, 50, 4), (78, 51, 19), (4000, 3000, 1000), (4000, 100, 100)])
def test_packing_tasks(spark, groups, partitions, tasks):
    """A task for each core (4 here) while groups are few, then one for each TASK_GROUPS."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        assert packing.tasks(spark, groups) == tasks
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=120))
def test_sum_of_squares(lengths):
    """Each placement is as good as any, and a new sequence is opened only if none has room."""
    packer, gaps = packing.SumOfSquares(50), {}

    def squares(gaps):
        held = [g for g in gaps.values() if g]
        return sum(held.count(g) ** 2 for g in set(held))

    for n in sorted(lengths, reverse=True):
        options = [squares({**gaps, s: g - n}) for s, g in gaps.items() if g >= n]
        nth, offset = packer.place(n)
        assert 50 - offset == gaps.get(nth, 50)
        gaps[nth] = 50 - offset - n
        assert (squares(gaps) == min(options)) if options else nth == len(gaps) - 1


@pytest.fixture(scope="module")
def default():
    """The library as it comes: strings of its special tokens are those tokens."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


MARKED = st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", "e", "\u0301", "é", " ", "\n", "A", ".", "don't", "日"]), max_size=12).map("".join), min_size=1, max_size=6)


@settings(max_examples=200, deadline=None)
@given(MARKED)
def test_special_tokens_in_texts(default, plain, texts):
    for added, want in ((True, default), (False, plain)):
        ids, counts = pieces.word_encoder(WORD, added).encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [want(t) for t in texts]


def test_special_tokens_in_files_and_sequences(spark, default, plain):
    texts = ["one<|endoftext|>two", "<|startoftext|> Hello <|endoftext|>", "<|ENDOFTEXT|>x", "plain", "<|endoftext|>" * 100]
    docs = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")
    want = expected(docs, default, 1)
    assert 49407 in want[0][1] and 49407 not in want[2][1]
    got = sorted(tokenfiles.ranked_round_trip(docs).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == [(i, len(ids), crc(ids)) for i, ids in want]
    packed = packing.pack(docs, size=64).collect()
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in packed) == sorted((i, s, crc(ids[s : s + 64])) for i, ids in expected(docs, default, 0) for s in range(0, len(ids), 64))
    assert sorted((r.doc_id, r.n_tokens) for r in tokenfiles.scan_counts(docs).collect()) == [(i, len(plain(t))) for i, t in enumerate(texts, 1)]


def test_round_trip_with_offsets(docs):
    """The one pass gives what encode() and decode() give, and splits of characters are counted."""
    two = {(r.doc_id, bytes(r.ids)): r for r in bytebpe.encode(docs, BYTE, P.PATTERN, offsets=True).collect()}
    table = bytebpe.byte_table(BYTE)
    for r in bytebpe.round_trip(docs, BYTE, P.PATTERN).collect():
        same = two[r.doc_id, bytes(r.ids)]
        assert r.n_tokens == same.n_tokens and r.character_starts == same.character_starts
        ids = np.frombuffer(r.ids, "<u4")
        assert bytes(r.decoded).decode() == bytebpe.decode_text(table, ids)
        assert r.n_split == sum((table.decode(ids[i : i + 1])[0] & 0xC0) == 0x80 for i in range(len(ids)))


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_offsets_of_many_texts_at_once(texts):
    """Texts of one batch don't shift one another's characters."""
    ids, counts = pieces.byte_encoder(BYTE, P.PATTERN).encode(pa.array(texts))
    table = bytebpe.byte_table(BYTE)
    for text, part in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        starts = table.character_offsets(part)
        assert all(len(text.encode()[:b].decode("utf-8", "ignore")) == c for b, c in zip(table.byte_offsets(part), starts, strict=True))


def test_other_tokenizers_get_whole_texts(spark, tmp_path):
    """A cased tokenizer, one with another pattern, and one with tokens of its own: ids are the library's."""
    import json

    from tokenizers import Tokenizer

    with open(WORD, encoding="utf-8") as f:
        spec = json.load(f)
    assert pieces.cuts_at_spaces(spec)
    cased = spec | {"normalizer": {"type": "Sequence", "normalizers": spec["normalizer"]["normalizers"][:2]}}
    pattern = spec | {"pre_tokenizer": {"type": "Sequence", "pretokenizers": [spec["pre_tokenizer"]["pretokenizers"][0] | {"pattern": {"Regex": "[^ ]+"}}, spec["pre_tokenizer"]["pretokenizers"][1]]}}
    tokens = spec | {"added_tokens": [*spec["added_tokens"], {**spec["added_tokens"][0], "id": 49408, "content": "old news", "special": False}]}
    texts = ["Hello World, AT once.", "", None, "a<|endoftext|>B old news", "it's  ALL\tnew!!", "word " * 3000]
    for n, other in enumerate((cased, pattern, tokens)):
        path = str(tmp_path / f"{n}.json")
        with open(path, "w", encoding="utf-8") as f:
            json.dump(other, f)
        assert not pieces.cuts_at_spaces(other)
        for added in (False, True):
            library = Tokenizer.from_file(path)
            library.encode_special_tokens = not added
            ids, counts = pieces.word_encoder(path, added).encode(pa.array(texts))
            assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


#: Letters whose case or composition is out of the ordinary, beside Latin ones and punctuation.
LETTERS = st.lists(st.lists(st.sampled_from([*"abzAZ'sß×÷ÀÖØÞàöøþÿªºµŸİıſKÅΣςẖ̱́̇̌̈_.,*9 \n\x0b\x0c\x00\x7f", "­", "</w>", "é.", "É,", "j", "h", "T", "it's", "ÑA's", "日", "<|endoftext|>"]), max_size=14).map("".join), min_size=1, max_size=6)


@settings(max_examples=400, deadline=None)
@given(LETTERS)
def test_letters_of_any_kind(default, plain, texts):
    for added, want in ((True, default), (False, plain)):
        ids, counts = pieces.word_encoder(WORD, added).encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [want(t) for t in texts]


def test_words_of_letters_pass_no_patterns(plain, monkeypatch):
    """Words of Latin letters, in any case and before punctuation, go to the bare model; only others to normalizers and patterns."""
    tokenizer, seen = pieces.word_encoder(WORD).tokenizer, []
    encoder = pieces.WordEncoder(tokenizer)
    monkeypatch.setattr(encoder, "_encode", lambda texts: seen.extend(texts) or tokenizer.encode_batch(texts, add_special_tokens=False))
    texts = ["Over the RIVER, Élan vital; straße.", "over (the) river's Ñandú, ĺong x2"]
    ids, counts = encoder.encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [plain(t) for t in texts]
    assert sorted(" ".join(seen).split()) == sorted([",", ";", ".", "(the", ")", "river's", "ĺong", "x2"])


def test_models_that_mark_no_ends(tmp_path):
    """Without a suffix of last tokens, and with characters that the vocabulary lacks, ids are the library's."""
    import json

    from tokenizers import Tokenizer

    with open(WORD, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = {t: i for i, t in enumerate([*"abcdefgh", *(f"{x}</w>" for x in "abcdef"), "ab", "ab</w>", "abc</w>"])}
    for n, suffix in enumerate((None, "</w>")):
        merges = [["a", "b"], ["a", "b</w>"], ["ab", "c</w>"]] if suffix else [["a", "b"]]
        other = spec | {"added_tokens": [], "model": spec["model"] | {"end_of_word_suffix": suffix, "vocab": vocab, "merges": merges}}
        with open(path := str(tmp_path / f"{n}.json"), "w", encoding="utf-8") as f:
            json.dump(other, f)
        assert pieces.cuts_at_spaces(other)
        texts = ["abc ab ah, hab", "a abcabc xyz ab", "", "gh", "xyz"]
        ids, counts = pieces.word_encoder(path).encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]


RUNS = st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=9), min_size=1, max_size=6)


@settings(max_examples=150, deadline=None)
@given(RUNS)
def test_numbers_of_many_documents_at_once(runs):
    """Coded together, documents are the bytes that each is alone; they are decoded together too, and read from a slice of rows."""
    lengths = np.array([len(r) for r in runs], np.int64)
    flat = np.array([x for r in runs for x in r], "<u4")
    alone = [tokenfiles.pack_numbers(np.array(r, "<u4")) for r in runs]
    control, data = tokenfiles.pack_numbers(flat, lengths)
    assert (control, data) == (b"".join(c for c, _ in alone), b"".join(d for _, d in alone))
    assert tokenfiles.unpack_numbers(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), lengths).tolist() == flat.tolist()
    assert pieces.numbers(pieces.binary_rows(flat, lengths)[1:], "<u4").tolist() == flat[lengths[0] :].tolist()


@pytest.mark.parametrize(("run_bytes", "run_ids", "file_ids"), [(1, 1, 1), (8, 5, 3), (400, 300, 200), (1 << 20, 1 << 19, 4 << 20)])
def test_runs_of_documents(docs, plain, monkeypatch, tmp_path, run_bytes, run_ids, file_ids):
    """Wherever runs and files are cut, each file ends with the document that fills it, and documents come back in order."""
    want = expected(docs, plain, 1)
    rows = [(0, i, n, len(ids), np.array(ids, "<u2").tobytes()) for n, (i, ids) in enumerate(want)]
    table = docs.sparkSession.createDataFrame(rows, "kind int, doc_id long, uid long, n long, ids binary")
    for name, value in (("RUN_BYTES", run_bytes), ("FILE_IDS", file_ids)):
        monkeypatch.setattr(tokenfiles, name, value)
    ranks = np.arange(49408, dtype=np.uint32)[::-1].copy()
    written = {r.file: (r.documents, r.ids) for r in tokenfiles.write_coded(table, ranks, f"file://{tmp_path}").collect()}
    monkeypatch.setattr(tokenfiles, "RUN_IDS", run_ids)
    got = []
    for file in sorted(written):
        with open(file, "rb") as f:
            runs = list(tokenfiles.decode_file(f.read(), ranks))
        here = [(None if null else int(i), x.tolist()) for ids_, nulls, n, flat in runs for i, null, x in zip(ids_, nulls, np.split(flat, np.cumsum(n)[:-1]), strict=True)]
        assert written[file] == (len(here), sum(len(x) for _, x in here))
        assert sum(len(x) for _, x in here[:-1]) <= file_ids
        got += here
    assert got == want
    back = sorted(tokenfiles.read_coded(docs.sparkSession, f"file://{tmp_path}").collect(), key=lambda r: (r.part, r.file, r.nth))
    assert [(r.doc_id, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in back] == [(i, len(x), crc(x), np.array(x, "<u4").tobytes()) for i, x in want]
