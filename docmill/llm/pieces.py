"""Tokenizer encoding over Arrow batches, by distinct pieces of text.

A text is cut where the tokenizer's own splits always fall, the distinct pieces of a batch go through the tokenizers
library, and numpy puts the ids of each text together. A worker remembers the pieces that it met first, up to a bound.
Words are cut, put into small letters and looked up as Arrow arrays, so that Python meets only those that are encoded.
"""

from __future__ import annotations

import base64
import functools
import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that a worker remembers. Later ones are encoded again in each batch that has them.
REMEMBERED = 250_000
#: Bytes of text that are worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 6 << 20
#: Pieces given to the library as one text.
JOINED = 2000


def slices(array: pa.Array, size: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The array in runs of about `size` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(array):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield array.slice(start, stop - start)
        start = stop


def gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """flat[start[i] : start[i] + length[i]] for each i, one after the other."""
    total = int(length.sum())
    first = np.cumsum(length) - length
    return flat[np.repeat(start - first, length) + np.arange(total)]


class Encoder:
    """Base of both encoders: pieces(), misses() and odd() say how a tokenizer's texts are cut and encoded."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.at: dict[str, int] = {}
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]):
        return self.tokenizer.encode_batch(texts, add_special_tokens=False)

    def _joined(self, words: list[str], gap: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, and how many each has, from texts in which gap stands between words."""
        flats, counts = [], []
        groups = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        for i in range(0, len(groups), 16):
            part = groups[i : i + 16]
            for group, got in zip(part, self._encode([gap.join(g) for g in part]), strict=True):
                sizes = np.fromiter(map(len, group), np.int64, len(group))
                starts = np.cumsum(sizes + len(gap)) - sizes - len(gap)
                ids = np.array(got.ids, np.uint32)
                where = np.fromiter((o[0] for o in got.offsets), np.int64, len(ids))
                of = np.searchsorted(starts, where, side="right") - 1
                inside = where < starts[of] + sizes[of] if gap else np.ones(len(ids), bool)
                flats.append(ids[inside])
                counts.append(np.bincount(of[inside], minlength=len(group)))
        return np.concatenate(flats or [np.zeros(0, np.uint32)]), np.concatenate(counts or [np.zeros(0, np.int64)])

    def coded(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, flat): where in flat the ids of each of these distinct pieces are. New ones are encoded."""
        at, distinct = self.at, pieces.to_pylist()
        mark = len(self.start), len(self.flat), len(at)
        place = np.fromiter((at.get(p, -1) for p in distinct), np.int64, len(distinct))
        new = np.flatnonzero(place < 0)
        if len(new):
            words = [distinct[i] for i in new]
            flat, count, order = self.misses(words)
            place[new[order]] = len(self.start) + np.arange(len(new))
            self.start = np.append(self.start, len(self.flat) + np.cumsum(count) - count)
            self.length = np.append(self.length, count)
            self.flat = np.append(self.flat, flat)
            if len(at) < REMEMBERED:
                at.update((distinct[i], int(place[i])) for i in new)
        found = self.start[place], self.length[place], self.flat
        if len(at) == mark[2]:  # no more room to remember new ones
            self.start, self.length, self.flat = self.start[: mark[0]], self.length[: mark[0]], self.flat[: mark[1]]
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32), and the number of ids of each text. A null text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = self.odd(texts)
        lists = self.pieces(texts)
        n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        start, length, flat = self.coded(coded.dictionary)
        code = coded.indices.to_numpy() if len(coded) else np.zeros(0, np.int64)
        lengths = length[code]
        ids = gather(flat, start[code], lengths)
        sums = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(n)
        counts = sums[ends] - sums[ends - n]
        if len(odd):
            ids, counts = self._whole(texts, odd, ids, counts)
        return ids, counts

    def _whole(self, texts: pa.Array, odd: np.ndarray, ids: np.ndarray, counts: np.ndarray):
        """Texts that can't be cut safely: encoded whole, and put into their places."""
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i in odd:
            parts[i] = np.array(self._encode([texts[int(i)].as_py()])[0].ids, np.uint32)
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        return np.concatenate(parts), counts

    def batches(self, array: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, counts) of each slice."""
        at = 0
        for part in slices(array):
            yield at, *self.encode(part)
            at += len(part)


class WholeEncoder(Encoder):
    """Whole texts by the library: for tokenizers whose texts can't be cut by rule."""

    def odd(self, texts: pa.Array) -> np.ndarray:
        return np.arange(len(texts))

    def pieces(self, texts: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.zeros(len(texts) + 1, np.int32)), pa.array([], pa.large_string()))

    def misses(self, words: list[str]):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)


#: Punctuation that is always split from a letter before it.
TAILS = ".,;:!?*$%&#<>|()[]{}\"/@+=~^_-"
#: Small letters that no normalizer changes, and the characters that become them or stay as they are when put into small letters.
SMALL = "a-z\\x{df}-\\x{f6}\\x{f8}-\\x{ff}"
SIMPLE = "^[\\x{0}-\\x{7f}\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{ff}]*$"


class WordEncoder(Encoder):
    """For tokenizers that drop white space and never merge across it: cut at ASCII white space.

    What is encoded and remembered is stems: words of simple characters in small letters, and without the punctuation
    after their last letter, which is a piece of its own; other words as they are. `added` has the ids of strings that
    are tokens wherever they stand, as the library takes them out before all else.
    """

    def __init__(self, tokenizer, added: dict[str, int] | None = None) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__(tokenizer)
        self.added = added or {}
        self.known = pa.array(["", *(f" {token}" for token in self.added)], pa.large_string())  # no word has a space
        self.length = np.array([0] + [1] * len(self.added), np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.array(list(self.added.values()), np.uint32)
        # the same model without normalizers and patterns, for words of small letters, which these leave as they are
        self.model = Tokenizer.from_str(tokenizer.to_str())
        self.model.encode_special_tokens = True
        self.model.normalizer = None
        self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=False)])
        vocab, suffix = tokenizer.get_vocab(), getattr(tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(max(vocab.values(), default=0) + 1, bool)  # whether a token ends a word
        self.last[[i for token, i in vocab.items() if suffix and token.endswith(suffix)]] = True

    def odd(self, texts: pa.Array) -> np.ndarray:
        return np.zeros(0, np.int64)

    def pieces(self, texts: pa.Array) -> pa.Array:
        for token in self.added:
            texts = pc.replace_substring(texts, token, f" {token} ")
        for c in "\n\t\r":
            texts = pc.replace_substring(texts, c, " ")
        return pc.split_pattern(texts, " ")

    def coded(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        stems, tails = self._cut(pieces)
        both = pa.concat_arrays([stems, tails]).dictionary_encode()
        place = self._places(both.dictionary)[both.indices.to_numpy()].reshape(2, -1).T.reshape(-1) if len(both) else np.zeros(0, np.int64)
        each = self.length[place]
        flat, length = gather(self.flat, self.start[place], each), each.reshape(-1, 2).sum(1)
        n = len(self.known)  # what is beyond is not remembered
        self.start, self.length, self.flat = self.start[:n], self.length[:n], self.flat[: int(self.length[:n].sum())]
        return np.cumsum(length) - length, length, flat

    def _cut(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Stem and tail of each word; no tail is empty text."""
        none = pa.scalar("", pa.large_string())
        simple = pc.match_substring_regex(words, SIMPLE)
        small = pc.if_else(simple, pc.utf8_lower(words), words)
        stems = pc.ascii_rtrim(small, characters=TAILS)
        cut = pc.and_(pc.and_(simple, pc.match_substring_regex(stems, f"[{SMALL}]$")), pc.not_equal(stems, small))
        tails = pc.if_else(cut, small, none)
        tails = pc.replace_with_mask(tails, cut, pc.replace_substring_regex(tails.filter(cut), f"^.*[{SMALL}]", ""))
        stems = pc.if_else(cut, stems, small)
        if self.added:
            token = pc.is_in(words, value_set=pa.array(list(self.added), pa.large_string()))
            stems = pc.if_else(token, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), words, none), stems)
            tails = pc.if_else(token, none, tails)
        return stems, tails

    def _places(self, distinct: pa.Array) -> np.ndarray:
        """Places of distinct pieces in start and length; new ones are encoded, and remembered if there is room."""
        place = pc.fill_null(pc.index_in(distinct, value_set=self.known), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        if len(new):
            words = distinct.take(pa.array(new))
            plain = pc.match_substring_regex(words, f"^[{SMALL}]+$")
            other = pc.invert(plain)
            parts = [self._letters(words.filter(plain)), self._joined(words.filter(other).to_pylist(), " ")]
            order = np.concatenate([np.flatnonzero(x.to_numpy(zero_copy_only=False)) for x in (plain, other)])
            count = np.concatenate([p[1] for p in parts])
            place[new[order]] = len(self.start) + np.arange(len(new))
            self.start = np.append(self.start, len(self.flat) + np.cumsum(count) - count)
            self.length = np.append(self.length, count)
            self.flat = np.concatenate([self.flat, *(p[0] for p in parts)])
            if len(self.known) < REMEMBERED:
                self.known = pa.concat_arrays([self.known, words.take(pa.array(order))])
        return place

    def _letters(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of small letters, and how many each has: a word ends with the only token of it that can be a last one."""
        words, flats, counts = words.to_pylist(), [], []
        groups = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        for i in range(0, len(groups), 16):
            part = groups[i : i + 16]
            for group, got in zip(part, self.model.encode_batch_fast([" ".join(g) for g in part], add_special_tokens=False), strict=True):
                ids = np.array(got.ids, np.uint32)
                count = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
                if len(count) != len(group) or count.sum() != len(ids):  # a model that marks no ends, or lacks a character
                    ids, count = self._joined(group, " ")
                flats.append(ids)
                counts.append(count)
        return np.concatenate(flats or [np.zeros(0, np.uint32)]), np.concatenate(counts or [np.zeros(0, np.int64)])


#: Texts that the byte-level encoder doesn't cut: white space other than single inner spaces and line feeds, or \x01.
ODD = "^[ \\n]|[ \\n]$|[ \\n][ \\n]|[\\t\\v\\f\\r\\x{1}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


class ByteEncoder(Encoder):
    """For byte-level BPE: a single space before a word goes with it, a single line feed is a piece of its own."""

    def odd(self, texts: pa.Array) -> np.ndarray:
        return np.flatnonzero(pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False))

    def pieces(self, texts: pa.Array) -> pa.Array:
        odd = pc.match_substring_regex(texts, ODD)
        texts = pc.if_else(odd, pa.scalar("", pa.large_string()), texts)
        texts = pc.replace_substring(pc.replace_substring(texts, " ", "\x01 "), "\n", "\x01\n\x01")
        return pc.split_pattern(texts, "\x01")

    def misses(self, words: list[str]):
        kind = np.fromiter((2 if w in ("\n", "") else 1 if w[0] == " " else 0 for w in words), np.int64, len(words))
        parts = []
        for k, gap in ((0, "\n"), (1, "")):
            parts.append(self._joined([words[i] for i in np.flatnonzero(kind == k)], gap))
        alone = [np.array(e.ids, np.uint32) for e in self._encode([words[i] for i in np.flatnonzero(kind == 2)])]
        parts.append((np.concatenate(alone or [np.zeros(0, np.uint32)]), np.fromiter(map(len, alone), np.int64, len(alone))))
        order = np.concatenate([np.flatnonzero(kind == k) for k in (0, 1, 2)])
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), order


#: Fixed values of the tokenizer files that WordEncoder is right for: what they do to a text, and where they split it.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITS = [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def cuts_at_spaces(spec: dict) -> bool:
    """Whether a tokenizer.json is of the kind whose words can be encoded by themselves, in small letters, and without their last punctuation."""
    plain = all(t["special"] and not any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized")) for t in spec.get("added_tokens") or [])
    normalizer, splitter, model = (spec.get(k) or {} for k in ("normalizer", "pre_tokenizer", "model"))
    return (
        plain and normalizer.get("type") == splitter.get("type") == "Sequence" and normalizer.get("normalizers") == NORMALIZERS and splitter.get("pretokenizers") == SPLITS
        and model.get("type") == "BPE" and not model.get("dropout") and not spec.get("post_processor")
    )


@functools.lru_cache(maxsize=2)
def word_encoder(path: str, added: bool = False) -> Encoder:
    """The encoder of a tokenizer.json, one for each worker. A file of another kind than cuts_at_spaces() knows is applied to whole texts.

    With `added`, ids are the library's with add_special_tokens=False: special tokens' strings in a text are those tokens.
    Without, they are ordinary text, so that no text yields their ids.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if not cuts_at_spaces(spec):
        tokenizer.encode_special_tokens = not added
        return WholeEncoder(tokenizer)
    tokenizer.encode_special_tokens = True
    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items() if t.special}
    return WordEncoder(tokenizer, special if added else None)


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file, by id."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, f))
    return [token for _, token in pairs]


@functools.cache
def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@functools.lru_cache(maxsize=2)
def byte_encoder(path: str, pattern: str) -> ByteEncoder:
    """The tokenizers library on the ranks of a tiktoken file.

    Every split of a token into two others is a merge; merges come in the order of the token that they make.
    """
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokens = read_ranks(path)
    rank = {t: i for i, t in enumerate(tokens)}
    names = byte_characters()
    name = [("".join(names[b] for b in t)) for t in tokens]
    merges = []
    for t in tokens:
        cuts = [(rank[t[:i]], rank[t[i:]]) for i in range(1, len(t)) if t[:i] in rank and t[i:] in rank]
        merges += [(name[a], name[b]) for a, b in sorted(cuts)]
    tokenizer = Tokenizer(models.BPE(vocab=dict(zip(name, range(len(name)), strict=True)), merges=merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=False),
    ])
    return ByteEncoder(tokenizer)


def binary_rows(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary array whose i-th value holds the bytes of the next counts[i] numbers of flat."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * flat.dtype.itemsize
    return pa.Array.from_buffers(
        pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat))],
    ).cast(pa.binary())


def numbers(rows: pa.Array, kind: str) -> np.ndarray:
    """All numbers of a binary array as binary_rows() makes it, one row after the other."""
    rows = rows.cast(pa.large_binary())
    _, ends, data = rows.buffers()
    ends = np.frombuffer(ends, np.int64)[rows.offset : rows.offset + len(rows) + 1]
    return np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]].view(kind)
