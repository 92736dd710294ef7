"""Phrase collocations by prefix-free parsing: texts become overlapping chunks, cut where the content says so.

A chunk owns the words before the next cut and shows up to four more, so each phrase begins in just one chunk. Distinct
chunks are a dictionary with frequencies, and phrases are counted inside of it, weighted; equal passages are read once.

Phrases are counted in two passes over the dictionary, after one for the words: hashes of word pairs whose words are
both frequent, then, exactly, phrases all of whose pairs may be frequent. What is frequent is handed to tasks as bits of
a filter of fixed size. A filter has no false negatives, so where it is too full it only lets more phrases be counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import attach, discard, stage
from .pieces import gather, slices

#: Words of a phrase at most, occurrences that it needs, and phrases that are shown for each language.
WORDS, LEAST, SHOWN = 5, 100, 2000
#: A chunk is cut before about each so-manieth pair of words.
MEAN = 48
#: Bytes of text that are worked on at once; a longer text is a slice of its own.
SLICE = 8 << 20
#: Bits of a filter, as a power of two: 4 MB, whatever the size of the corpus.
FILTER_BITS = 25
#: Slices of a language in which the best phrases are found first.
SLICES = 64
#: Bits of a pair's hash that are shuffled.
PAIR_BITS = 40
UNKNOWN = "und"

#: Bytes by what they are: separators of pieces become \n, blanks become spaces, A-Z become a-z.
MAP = np.arange(256, dtype=np.uint8)
MAP[65:91] += 32
MAP[9] = 32
for _c in b".,;:!?\n\x0b\x0c\r":
    MAP[_c] = 10

_rng = np.random.default_rng(20250117)
MIX = [np.uint64(x | 1) for x in _rng.integers(0, 2**63, 3, np.uint64).tolist()]


class Words:
    """The words of some texts, one after the other."""

    def __init__(self, texts: pa.Array) -> None:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = MAP[np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]] if raw is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        first = np.zeros(len(data) + 1, bool)
        first[offsets[:-1]] = True  # an empty text's mark falls on the next one, or behind all
        first = first[:-1]
        inside = (data != 32) & (data != 10)
        before = np.concatenate([[False], inside[:-1]]) & ~first
        start = np.flatnonzero(inside & ~before)
        kept = np.cumsum(inside)
        #: bytes of all words, and where each begins; the piece and the text of each
        self.data = data[inside]
        self.at = np.append(kept[start] - 1, len(self.data)).astype(np.int64)
        self.piece = np.cumsum((data == 10) | first)[start]
        self.text = np.searchsorted(offsets, start, side="right") - 1
        self.n = len(start)

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """Each word's place among the distinct words, and these."""
        words = pa.Array.from_buffers(pa.large_string(), self.n, [None, pa.py_buffer(self.at), pa.py_buffer(np.ascontiguousarray(self.data))])
        coded = words.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _hashes(values: pa.Array) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in values.to_pylist()), np.uint64, len(values))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = (a * MIX[0] + b) * MIX[1]
    return (out ^ (out >> np.uint64(29))) * MIX[2] ^ (out >> np.uint64(32))


def _ranks(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (whole numbers below size), in order, and each key's place among them."""
    if size > 8 * len(key) + (1 << 20):
        return np.unique(key, return_inverse=True)
    there = np.zeros(size, bool)
    there[key] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[key]


def _sums(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each distinct key first is, the sum of its weights)."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    runs = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return order[runs], np.add.reduceat(weight[order], runs) if len(key) else np.zeros(0, np.int64)


def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) to distinct chunks of some texts: (lang, chunk, owned words, times)."""
    for batch in batches:
        at = 0
        for texts in slices(batch.column(1), SLICE):
            langs, at = batch.column(0).slice(at, len(texts)), at + len(texts)
            w = Words(texts)
            if not w.n:
                continue
            code, distinct = w.coded()
            h = _hashes(distinct)[code]
            new = np.diff(w.text, prepend=-1) > 0
            inner = np.append(~new[1:], False)
            cut = new | (inner & (_pair(h, np.append(h[1:], np.uint64(0))) % np.uint64(MEAN) == 0))
            start = np.flatnonzero(cut)
            stop = np.append(start[1:], w.n)
            pieces = np.concatenate([w.piece, np.full(WORDS, -1)])
            shown = sum((pieces[stop + j] == w.piece[stop - 1]).astype(np.int64) for j in range(WORDS - 1))
            # words with what stands before each: a space, or \n where a piece begins
            mark = w.at[:-1] + np.arange(w.n)
            data = np.empty(len(w.data) + w.n, np.uint8)
            is_mark = np.zeros(len(data), bool)
            is_mark[mark] = True
            data[mark] = np.where(np.diff(w.piece, prepend=-1) != 0, 10, 32)
            data[~is_mark] = w.data
            ends = np.append(mark, len(data))
            begin = mark[start] + 1
            sizes = ends[stop + shown] - begin
            chunks = pa.Array.from_buffers(
                pa.large_string(), len(start), [None, pa.py_buffer(np.append(0, np.cumsum(sizes)).astype(np.int64)), pa.py_buffer(gather(data, begin, sizes))],
            )
            lang = langs.take(pa.array(w.text[start]))
            found = pa.table({"lang": lang, "chunk": chunks.cast(pa.string()), "owned": stop - start}).group_by(["lang", "chunk", "owned"]).aggregate([([], "count_all")])
            yield from found.select(["lang", "chunk", "owned", "count_all"]).rename_columns(["lang", "chunk", "owned", "n"]).combine_chunks().to_batches()


class Chunks:
    """A slice of the dictionary: its words, each one's language, weight and whether its chunk owns it."""

    def __init__(self, lang: pa.Array, chunk: pa.Array, owned: np.ndarray, n: np.ndarray) -> None:
        w = self.words = Words(chunk)
        self.code, self.distinct = w.coded()
        coded = lang.dictionary_encode()
        self.langs = coded.dictionary
        self.lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[w.text]
        #: a number for each word in its language, and by that number its places in langs and distinct
        named, self.term = _ranks(self.lang * len(self.distinct) + self.code, len(self.langs) * len(self.distinct))
        self.terms = named // max(1, len(self.distinct)), named % max(1, len(self.distinct))
        self.weight = n[w.text]
        self.owned = np.arange(w.n) - np.searchsorted(w.text, w.text) < owned[w.text]
        #: hash of each word in its language, as Spark's xxhash64(lang, word) gives it
        self.term_hash = _term_hashes(self.langs, self.distinct, *self.terms)
        self.hash = self.term_hash[self.term]
        self.together = np.append(w.piece[1:] == w.piece[:-1], False) if w.n else np.zeros(0, bool)
        #: hash of each word and the next one, of so many bits that pairs seldom share it
        self.pair = _pair(self.hash, np.append(self.hash[1:], np.uint64(0))) >> np.uint64(64 - PAIR_BITS) if w.n else self.hash


def _term_hashes(langs: pa.Array, words: pa.Array, lang: np.ndarray, word: np.ndarray) -> np.ndarray:
    import xxhash

    seeds = [xxhash.xxh64_intdigest(x, seed=42) for x in langs.to_pylist()]
    texts = words.to_pylist()
    return np.fromiter((xxhash.xxh64_intdigest(texts[w], seed=seeds[k]) for k, w in zip(lang.tolist(), word.tolist(), strict=True)), np.uint64, len(word))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunks]:
    for batch in batches:
        at = 0
        for chunk in slices(batch.column(1), SLICE):
            part = batch.slice(at, len(chunk))
            at += len(chunk)
            c = Chunks(part.column(0), chunk, part.column(2).to_numpy(), part.column(3).to_numpy())
            if c.words.n:
                yield c


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, n) of words."""
    for c in _slices(batches):
        n = np.zeros(len(c.term_hash), np.int64)
        np.add.at(n, c.term[c.owned], c.weight[c.owned])
        at = np.flatnonzero(n)
        lang, word = (pa.array(x[at]) for x in c.terms)
        yield pa.record_batch([c.langs.take(lang), c.distinct.take(word).cast(pa.string()), pa.array(n[at])], ["lang", "phrase", "n"])


def _filter(hashes: DataFrame, name: str = "hash") -> np.ndarray:
    """The bits of some hashes. The driver gets at most 2 ** (FILTER_BITS - 6) numbers of 64 bits, however many hashes there are."""
    place = F.shiftrightunsigned(name, 6).bitwiseAND(F.lit((1 << (FILTER_BITS - 6)) - 1))
    bits = hashes.select(place.alias("at"), F.expr(f"shiftleft(1L, cast({name} & 63 as int))").alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[bits["at"].to_numpy(np.int64)] = bits["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def _maybe(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes >> np.uint64(6)) & np.uint64(len(bits) - 1)
    return (bits[at.astype(np.int64)] >> (hashes & np.uint64(63))) & np.uint64(1) == 1


def _pairs(frequent):
    """(hash, n) of pairs of words that may both be frequent."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = frequent.value
        for c in _slices(batches):
            word = _maybe(bits, c.hash)
            at = np.flatnonzero(c.owned & c.together & word & np.append(word[1:], False))
            if len(at):
                first, n = _sums(c.pair[at].view(np.int64), c.weight[at])
                yield pa.record_batch([pa.array(c.pair[at[first]].view(np.int64)), pa.array(n)], ["hash", "n"])

    return task


def _phrases(frequent):
    """(lang, phrase, n) of phrases of two and more words, all of whose pairs may be frequent."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = frequent.value
        for c in _slices(batches):
            linked = c.together & _maybe(bits, c.pair)
            at = np.flatnonzero(c.owned & linked)
            # phrases that begin at the same place are numbered from the shorter to the longer one
            size = len(c.distinct)
            group = c.term[at]
            for k in range(2, WORDS + 1):
                if not len(at):
                    break
                group = np.unique(group, return_inverse=True)[1] * size + c.code[at + k - 1]
                first, n = _sums(group, c.weight[at])
                one = at[first]
                text = pc.binary_join_element_wise(*[c.distinct.take(pa.array(c.code[one + j])) for j in range(k)], pa.scalar(" ", pa.large_string()))
                yield pa.record_batch([c.langs.take(pa.array(c.lang[one])), text.cast(pa.string()), pa.array(n)], ["lang", "phrase", "n"])
                if k < WORDS:
                    more = linked[at + k - 1]  # the last word of a phrase is never the last of all if it is linked to the next
                    at, group = at[more], group[more]

    return task


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Distinct chunks of all texts and how often each occurs: (lang, chunk, owned, n)."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    return rows.mapInArrow(parse, "lang string, chunk string, owned long, n long").groupBy("lang", "chunk", "owned").agg(F.sum("n").alias("n"))


def frequencies(docs: DataFrame, least: int = LEAST, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): (lang, phrase, words, a) of all phrases of one to WORDS words with a >= least, and (lang, n): all words."""
    context = docs.sparkSession.sparkContext
    chunks = stage(dictionary(docs, text, lang), "phrase-chunks")
    words = stage(chunks.mapInArrow(_words, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("a")), "phrase-words")
    totals = stage(words.groupBy("lang").agg(F.sum("a").alias("n")), "phrase-totals")
    frequent = stage(words.filter(F.col("a") >= least).withColumn("hash", F.xxhash64("lang", "phrase")), "phrase-frequent")
    bits = context.broadcast(_filter(frequent))
    pairs = chunks.mapInArrow(_pairs(bits), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    linked = context.broadcast(_filter(pairs))
    counted = chunks.mapInArrow(_phrases(linked), "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)
    all_ = frequent.select("lang", "phrase", F.lit(1).cast("long").alias("words"), "a").unionByName(counted.withColumn("words", F.size(F.split("phrase", " ")).cast("long")))
    out = stage(all_, "phrase-counts")
    discard(chunks, words, frequent)
    return out, totals


def score() -> Column:
    """floor(1000 a n / (l r)), with products as decimals of 38 digits."""
    return F.expr("cast(1000 as decimal(4,0)) * cast(a as decimal(19,0)) * cast(n as decimal(19,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")


def collocations(docs: DataFrame, least: int = LEAST, shown: int = SHOWN, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to WORDS words that occur `least` times or more.

    A-Z are lower-cased; pieces end at `.,;:!?` and line ends, words at spaces and tabs. A null text is empty, a null
    language is "und", and so one group with rows that say "und". score = floor(1000 a n / (l r)) for the cut with the
    lowest score (the first of equals), l and r being the counts of its two parts, n that of all words. A phrase with a
    longer one around it that occurs as often is left out. Repeated rows count each time. An empty table gives no rows.
    Counts are exact; products are decimals of 38 digits.
    """
    phrases, totals = frequencies(docs, least, text, lang)
    found = phrases.filter("words > 1")
    split = F.split("phrase", " ")
    cuts = found.withColumn("w", split).select("lang", "phrase", "words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words").cast("int") - 1)).alias("cut"))

    def part(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"), part(F.col("cut") + 1, F.col("words").cast("int") - F.col("cut")).alias("right"))
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("count"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(parts.withColumnsRenamed({"part": side, "count": name}), ["lang", side])
    per = stage(found.groupBy("lang").agg(F.count("*").alias("found")).join(totals, "lang"), "phrase-langs")
    sizes = per.withColumn("cuts", F.col("found") * (WORDS - 1))  # at most
    total = found.count() * (WORDS - 1)
    wide = attach(cuts, sizes, "lang", "cuts", total)
    scored = wide.withColumn("score", score()).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("best"), F.first("a").alias("a"), F.first("n").alias("n"),
    )
    # a phrase inside a longer one that is as frequent is also inside one that is a word longer and as frequent
    longer = found.filter("words > 2").withColumn("w", split).select(
        "lang", F.explode(F.array(part(F.lit(1), F.col("words").cast("int") - 1), part(F.lit(2), F.col("words").cast("int") - 1))).alias("phrase"), "a",
    )
    around = longer.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = scored.join(around, ["lang", "phrase"], "left").filter("around is null or around < a")
    flat = stage(kept.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score"), "phrase-scored")
    discard(phrases, per)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = flat.withColumn("rank", F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SLICES))).orderBy(*order))).filter(F.col("rank") <= shown)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= shown)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_prefix_free_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 best phrases of all documents."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"))


#: Every phrase of every piece, counted as text; sums and products in 128 bits.
OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS MATERIALIZED (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, range(1, 6) r(k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
c AS (
  SELECT f.lang, f.phrase, f.k, f.a, i AS cut, array_to_string(string_split(f.phrase, ' ')[1:i], ' ') AS head, array_to_string(string_split(f.phrase, ' ')[i + 1:], ' ') AS tail
  FROM f, range(1, 5) r(i) WHERE i < f.k
),
s AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.cut, x.a AS l, y.a AS r, t.n, CAST((1000 * CAST(c.a AS HUGEINT) * t.n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail JOIN t ON t.lang = c.lang
),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT DISTINCT f.lang, array_to_string(string_split(f.phrase, ' ')[i:i + m - 1], ' ') AS phrase, f.a FROM f, range(2, 5) q(m), range(1, 5) r(i) WHERE m < f.k AND i + m - 1 <= f.k
),
o AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM inside z WHERE z.lang = b.lang AND z.phrase = b.phrase AND 100 * z.a >= 100 * b.a))
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank, phrase, a, l, r, n, score FROM o
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
