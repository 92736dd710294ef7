"""Near-duplicate join: a MinHash LSH forest proposes, exact Jaccard similarity decides.

A text has a label of DEPTH numbers, a byte each, in each of TREES trees, so that a label is one integer whose order is
the order of the tree's sorted trie, and a trie node at some depth is the run of labels with the same leading bytes.
Matched prefixes begin at full length. The links that they give are verified exactly, and from their similarities
follows how many links such prefixes miss; while that is too many, prefixes are shortened by one number.

A node of many near copies is not compared pair by pair. Jaccard distance is a metric, so texts within half of the greatest
distance from one text, a ball's centre, are all linked: one comparison for each text shows it.
"""

from __future__ import annotations

import functools
import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, components, discard, fresh, stage
from .pieces import gather, slices

WORDS, SIMILARITY = 5, 0.8
#: Trees, and the numbers of a label, which is the longest prefix. Labels and a tree's number fit into 61 bits.
TREES, DEPTH = 20, 7
#: Prefixes are shortened until this share of all links is expected to be found.
RECALL = 0.999
#: Steps of similarity in which found links are counted.
STEPS = 200
#: Texts, and distinct shingles, that a side of a verified block holds (about, as texts are dealt by a hash).
BLOCK_TEXTS, BLOCK_SHINGLES = 256, 1 << 18

log = logging.getLogger(__name__)

_rng = np.random.default_rng(20240501)
#: Odd multipliers and offsets of the labels' hash functions.
FACTORS = _rng.integers(0, 2**63, TREES * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _rng.integers(0, 2**63, TREES * DEPTH, np.uint64)
MIX = [np.uint64(x | 1) for x in _rng.integers(0, 2**63, WORDS, np.uint64).tolist()]


def recall(depth: int, similarity: float) -> float:
    """Chance that two texts share a prefix of this depth in some tree."""
    return 1 - (1 - similarity**depth) ** TREES


def depth_for(similarity: float, target: float) -> int:
    """The longest prefix whose recall reaches the target for every link; 0, where all texts are candidates, if none does.

    No shorter prefix is ever tried.
    """
    return next((d for d in range(DEPTH, 0, -1) if recall(d, similarity) >= target), 0)


def expected_recall(found: np.ndarray, depth: int, similarity: float, certain: int = 0) -> float:
    """The share of all links that prefixes of a depth find, from the similarities of those that they found.

    found[i] counts links from step i of STEPS between the least similarity and 1. A link that is found with chance r
    stands for 1 / r links. One more link at the least similarity is taken as found, so few links prove little. `certain`
    links are inside of balls, which no prefix can miss.
    """
    if depth == 0:
        return 1.0
    steps = similarity + (1 - similarity) * np.arange(STEPS) / STEPS
    counts = np.append(found, 1)
    return float((counts.sum() + certain) / ((counts / recall(depth, np.append(steps, similarity))).sum() + certain))


def _hash(words: pa.Array) -> np.ndarray:
    import xxhash

    coded = words.dictionary_encode()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return hashes[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all five-word shingles, and how many each text has. A text of fewer words is one shingle, of none none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    for c in "\n\t\r\x0b\x0c":
        texts = pc.replace_substring(texts, c, " ")
    lists = pc.split_pattern(texts, " ")
    flat = lists.flatten()
    there = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
    seen = np.concatenate([[0], np.cumsum(there)])
    n = np.diff(seen[np.concatenate([[0], ends])])
    words = _hash(flat.filter(pa.array(there)))
    count = np.where(n >= WORDS, n - WORDS + 1, np.minimum(n, 1))
    first = np.repeat(np.cumsum(n) - n - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    size = np.repeat(np.minimum(n, WORDS), count)
    out = np.repeat(np.minimum(n, WORDS), count).astype(np.uint64)
    padded = np.concatenate([words, np.zeros(WORDS, np.uint64)])
    for k in range(WORDS):
        out = out * MIX[k] + np.where(size > k, padded[first + k], np.uint64(0))
    out ^= out >> np.uint64(31)
    return out * MIX[0] ^ (out >> np.uint64(29)), count


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (..., text) to (..., n_shingles, set_id, labels): text is the last column and goes."""
    import hashlib

    for batch in batches:
        texts, at = batch.column(batch.num_columns - 1), 0
        for part in slices(texts, 4 << 20):
            flat, count = shingles(part)
            some = count > 0
            labels = np.zeros((len(count), TREES), np.int64)
            if some.any():
                starts = (np.cumsum(count) - count)[some]
                for j in range(TREES * DEPTH):
                    least = np.minimum.reduceat(flat * FACTORS[j] + OFFSETS[j], starts)
                    byte = (least * MIX[1]) >> np.uint64(56)  # a byte of the least value's hash is enough for a prefix
                    labels[some, j // DEPTH] = (labels[some, j // DEPTH] << 8) | byte.astype(np.int64)
            sets = [np.unique(x) for x in np.split(flat, np.cumsum(count)[:-1])]
            ids = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
            n = len(count)
            columns = [
                pa.array([len(x) for x in sets], pa.int64()), pa.array(ids, pa.binary()),
                pa.ListArray.from_arrays(np.arange(0, n * TREES + 1, TREES, dtype=np.int32), labels.reshape(-1)),
            ]
            yield pa.record_batch([*[c.slice(at, n) for c in batch.columns[:-1]], *columns], [*batch.schema.names[:-1], "n_shingles", "set_id", "labels"])
            at += n


class Forest:
    """Disjoint sets of 0 to n - 1."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _verify(uids: np.ndarray, own: np.ndarray, copies: np.ndarray, labels: np.ndarray, balls: np.ndarray, flat: np.ndarray, count: np.ndarray, across: bool, tree: int, depth: int, similarity: float):
    """Links of a block of a trie node: (edges of a spanning forest, weighted links of each text, links by similarity).

    Of pairs that share a prefix in several trees, the first tree's block takes each; of those that share a longer one
    somewhere, an earlier depth's did. So each pair is compared once in the whole join, but those of one ball (-1: in none),
    which never are. `own` tells the two sides of a
    block between two chunks of a node, inside of which other blocks look.
    """
    n = len(uids)
    _, ids = np.unique(flat, return_inverse=True)
    marked = np.zeros(len(flat), bool)
    starts = np.cumsum(count) - count
    prefix = labels >> (8 * (DEPTH - depth))
    longer = labels >> (8 * (DEPTH - depth - 1)) if depth < DEPTH else None
    links, forest, edges, found = np.zeros(n, np.int64), Forest(n), [], np.zeros(STEPS, np.int64)
    for a in range(n):
        if across and own[a]:
            continue
        others = np.flatnonzero(own) if across else np.arange(a + 1, n)
        # sizes alone rule out some
        others = others[np.minimum(count[others], count[a]) >= similarity * np.maximum(count[others], count[a])]
        if balls[a] >= 0:
            others = others[balls[others] != balls[a]]
        others = others[~(prefix[others, :tree] == prefix[a, :tree]).any(1)]
        if longer is not None:
            others = others[~(longer[others] == longer[a]).any(1)]
        if not len(others):
            continue
        mine = ids[starts[a] : starts[a] + count[a]]
        marked[mine] = True
        shared = np.add.reduceat(marked[gather(ids, starts[others], count[others])].astype(np.int64), np.cumsum(count[others]) - count[others])
        marked[mine] = False
        jaccard = shared / (count[a] + count[others] - shared)
        hit = jaccard >= similarity
        np.add.at(
            found,
            np.minimum(STEPS - 1, ((jaccard[hit] - similarity) / (1 - similarity) * STEPS).astype(np.int64)) if similarity < 1 else np.zeros(hit.sum(), np.int64),
            1,
        )
        for b in others[hit].tolist():
            links[a] += copies[b]
            links[b] += copies[a]
            if forest.join(a, b):
                edges.append((uids[a], uids[b]))
    return edges, links, found


def _sets(rows: list) -> list[np.ndarray]:
    """Sorted shingle hashes of rows whose last field is the text."""
    flat, count = shingles(pa.array([r[-1] for r in rows], pa.large_string()))
    return [np.unique(x) for x in np.split(flat, np.cumsum(count)[:-1])]


def _inside(similarity: float):
    """(uid, ball) of texts that lie in their candidate ball; rows arrive sorted by block, the centre first: (block, centre, ball, uid, text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, middle = None, np.zeros(0, np.uint64)
        for batch in batches:
            blocks, centre, balls, uids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            at, near = 0, np.zeros(batch.num_rows, bool)
            for part in slices(batch.column(4), 4 << 20):
                for text in _sets([(t,) for t in part.to_pylist()]):
                    if centre[at]:
                        block, middle = blocks[at], text
                    else:
                        assert blocks[at] == block, "a block has no centre"
                        shared = len(np.intersect1d(text, middle, assume_unique=True))
                        near[at] = shared >= (1 + similarity) / 2 * (len(text) + len(middle) - shared) * (1 + 1e-12)
                    at += 1
            if near.any():
                yield pa.record_batch([pa.array(uids[near]), pa.array(balls[near])], ["uid", "ball"])

    return task


def _blocks(depth: int, similarity: float):
    """Verified blocks: rows arrive sorted by block, (block, tree, across, second, uid, copies, labels, ball, text).

    Out come rows (kind, a, b, n): 0 an edge from a to b, 1 the n links of a, 2 the n links of similarity step a.
    """
    names = ["kind", "a", "b", "n"]

    def flush(rows: list, tree: int, across: bool) -> pa.RecordBatch | None:
        own, uids, copies, labels, balls = (np.array([r[i] for r in rows], t) for i, t in enumerate((bool, np.int64, np.int64, np.int64, np.int64)))
        sets = _sets(rows)
        count = np.fromiter(map(len, sets), np.int64, len(sets))
        edges, links, found = _verify(uids, own, copies, labels, balls, np.concatenate(sets), count, across, tree, depth, similarity)
        out = [(0, int(a), int(b), 0) for a, b in edges] + [(1, int(uids[i]), 0, int(links[i])) for i in np.flatnonzero(links)] + [(2, int(i), 0, int(found[i])) for i in np.flatnonzero(found)]
        return pa.record_batch([pa.array(c) for c in zip(*out, strict=True)], names) if out else None

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for block, tree, across, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and block != now[0] and (found := flush(rows, *now[1:])) is not None:
                    yield found
                rows = rows if now is not None and block == now[0] else []
                now = block, tree, across
                rows.append(row)
        if rows and (found := flush(rows, *now[1:])) is not None:
            yield found

    return task


def classes(docs: DataFrame, similarity: float = SIMILARITY, target: float = RECALL, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows, found): docs with a row number, and for each row (_uid, id, class_id, keep_uid, n_links).

    Texts with the same set of shingles are one text with copies. Texts that share a prefix of their labels in some tree
    are candidates; prefixes are shortened until the expected recall reaches the target, at most down to the depth that
    has it for every link. Each candidate pair is verified exactly, in blocks of its trie node, so a node's size never
    makes a task large, and no table of pairs is written. A class is what verified links connect; its id is its smallest
    doc_id (null last). n_links counts a row's links: its copies, and all rows of texts that it is similar to. A text
    without words has none.
    """
    uid = fresh(docs, "_uid")
    rows = stage(docs.withColumn(uid, F.monotonically_increasing_id()), "near-rows")
    slim = rows.select(F.col(uid).alias("uid"), F.col(key).cast("long").alias("id"), "text")
    signed = stage(slim.mapInArrow(_signatures, "uid long, id long, n_shingles long, set_id binary, labels array<long>"), "near-signed")
    sets = stage(
        signed.filter("n_shingles > 0").groupBy("set_id").agg(
            F.min(F.struct(F.col("id").isNull().alias("no"), "id", "uid")).alias("least"), F.count("*").alias("copies"),
        ),
        "near-sets",
    )
    reps = sets.select(F.col("least.uid").alias("uid"), "set_id", "copies", F.col("least").alias("first"))
    labelled = stage(signed.select("uid", "labels", "n_shingles").join(reps.select("uid", "copies").hint("merge"), "uid"), "near-reps")
    parts = _links(slim, labelled, similarity, target)
    links = functools.reduce(DataFrame.unionByName, parts)
    joined = components(links.filter("kind = 0").select("a", "b"), "near-classes")
    counted = links.filter("kind = 1").groupBy("a").agg(F.sum("n").alias("n_links")).withColumnRenamed("a", "uid")
    known = reps.join(joined.withColumnRenamed("node", "uid"), "uid", "left").join(counted, "uid", "left").select(
        "set_id", "copies", "first", F.coalesce("component", "uid").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    known = stage(known, "near-known")
    discard(sets, labelled, *parts)
    named = known.groupBy("class").agg(F.min("first").alias("keep"), F.count("*").alias("sets"))
    with_class = attach(known, named, "class", "sets", known.count())
    by_set = stage(
        with_class.select(
            "set_id", "copies", F.col("keep.id").alias("class_id"), F.col("keep.uid").alias("keep_uid"),
            (F.col("n_links") + F.col("copies") - 1).alias("n_links"),
        ),
        "near-named",
    )
    plain = signed.select("uid", "id", "set_id")
    found_rows = attach(plain.filter("set_id is not null"), by_set, "set_id", "copies", plain.count()).select("uid", "id", "class_id", "keep_uid", "n_links")
    alone = plain.filter("set_id is null").select("uid", "id", F.col("id").alias("class_id"), F.col("uid").alias("keep_uid"), F.lit(0).cast("long").alias("n_links"))
    return rows, found_rows.unionByName(alone).withColumnRenamed("uid", "_uid")


def _node(depth: int) -> Column:
    """A trie node as a number: the tree, and the first `depth` numbers of the label."""
    return F.shiftleft(F.col("tree").cast("long"), 8 * DEPTH).bitwiseOR(F.shiftright("label", 8 * (DEPTH - depth)))


def _links(slim: DataFrame, labelled: DataFrame, similarity: float, target: float) -> list[DataFrame]:
    """Staged tables of what _blocks finds, one for each depth that is needed, and one of what balls give."""
    least = depth_for(similarity, target)
    company = _company(slim, labelled, least)
    balls = _balls(company, similarity)
    texts = stage(company.select("uid", "copies", "n_shingles", "labels", "trees").join(balls, "uid", "left"), "near-texts")
    parts, found = [_ball_links(texts)], np.zeros(STEPS, np.int64)
    certain = parts[0].filter("kind = 3").agg(F.sum("n")).first()[0] or 0
    for depth in range(DEPTH, least - 1, -1):
        parts.append(_at_depth((texts, company), depth, similarity))
        for r in parts[-1].filter("kind = 2").groupBy("a").agg(F.sum("n").alias("n")).collect():  # STEPS rows at most
            found[r.a] += r.n
        reached = expected_recall(found, depth, similarity, certain)
        log.info("prefixes of %d numbers: %d links and %d in balls, expected recall %.5f", depth, found.sum(), certain, reached)
        if reached >= target:
            break
    discard(company, balls, texts)
    return parts


def _keyed(texts: DataFrame, depth: int) -> DataFrame:
    """A row for each text and tree in which it has company, with its node at a depth."""
    trees = F.col("trees") if depth else F.array(F.lit(0))
    return texts.withColumn("tree", F.explode(trees)).withColumn("label", F.get("labels", "tree")).withColumn("node", _node(depth)).drop("trees", "label")


def _balls(company: DataFrame, similarity: float) -> DataFrame:
    """Stage (uid, ball): texts of large nodes that are within half of the greatest distance from their candidate centre.

    The centre of a node of more than BLOCK_TEXTS is its text with the smallest uid; a text's candidate is the smallest
    centre of its nodes. Texts are dealt in blocks, each of which gets the centre's text, so each text is sent once.
    A text is in one ball, and a ball's texts are all linked, whether or not its centre is one of them.
    """
    texts = company.select("uid", "labels", "trees")
    keyed = _keyed(texts, DEPTH).select("uid", "node")
    large = keyed.groupBy("node").agg(F.count("*").alias("n"), F.min("uid").alias("ball")).filter(F.col("n") > BLOCK_TEXTS)
    candidates = stage(attach(keyed, large, "node", "n", keyed.count()).groupBy("uid").agg(F.min("ball").alias("ball")), "near-candidates")
    sizes = candidates.groupBy("ball").agg(F.ceil(F.count("*") / BLOCK_TEXTS).cast("int").alias("parts"), F.count("*").alias("n"))
    sizes = stage(sizes, "near-balls-sizes")
    words = company.select("uid", "text")
    dealt = attach(candidates, sizes, "ball", "n", candidates.count()).withColumn("part", F.pmod(F.xxhash64("uid"), "parts").cast("int"))
    members = dealt.select("uid", "ball", "part", F.lit(False).alias("centre"))
    centres = sizes.select(F.col("ball").alias("uid"), "ball", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("centre"))
    both = members.unionByName(centres).join(words.hint("merge"), "uid")
    rows = both.select(F.xxhash64("ball", "part").alias("block"), "centre", "ball", "uid", "text")
    ordered = rows.repartition("block").sortWithinPartitions("block", F.desc("centre"), "uid")
    out = stage(ordered.mapInArrow(_inside(similarity), "uid long, ball long"), "near-balls")
    discard(candidates, sizes)
    return out


def _ball_links(texts: DataFrame) -> DataFrame:
    """Stage the links inside of balls, as rows of _blocks(): 0 from a text to its centre, 1 a text's links; and 3 the number of linked pairs."""
    held = texts.filter("ball is not null").select("uid", "copies", "ball")
    sizes = stage(held.groupBy("ball").agg(F.sum("copies").alias("rows"), F.count("*").alias("n")), "near-ball-rows")
    with_size = attach(held, sizes, "ball", "n", held.count())
    zero = F.lit(0).cast("long")
    edges = held.filter("uid <> ball").select(F.lit(0).cast("long").alias("kind"), F.col("uid").alias("a"), F.col("ball").alias("b"), zero.alias("n"))
    links = with_size.select(F.lit(1).cast("long").alias("kind"), F.col("uid").alias("a"), zero.alias("b"), (F.col("rows") - F.col("copies")).alias("n")).filter("n > 0")
    pairs = sizes.select(F.lit(3).cast("long").alias("kind"), zero.alias("a"), zero.alias("b"), F.floor(F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("n"))
    out = stage(edges.unionByName(links).unionByName(pairs), "near-ball-links")
    discard(sizes)
    return out


def _company(slim: DataFrame, labelled: DataFrame, least: int) -> DataFrame:
    """Stage the texts that share a trie node with another at the least depth, and in which trees: longer prefixes need no others."""
    if least == 0:
        some = labelled.withColumn("trees", F.sequence(F.lit(0), F.lit(TREES - 1)))
    else:
        keyed = labelled.select("uid", F.posexplode("labels").alias("tree", "label")).select("uid", "tree", _node(least).alias("node"))
        nodes = keyed.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1")
        trees = attach(keyed, nodes, "node", "n", TREES * labelled.count()).groupBy("uid").agg(F.collect_list("tree").alias("trees"))  # TREES at most
        some = labelled.join(trees.hint("merge"), "uid")
    return stage(some.join(slim.select("uid", "text").hint("merge"), "uid"), "near-company")


def _at_depth(tables: tuple[DataFrame, DataFrame], depth: int, similarity: float) -> DataFrame:
    """Stage the links of pairs whose longest common prefix in any tree has this depth, but for those inside of a ball.

    tables: texts by their labels and balls, and with their words.
    """
    texts, company = tables
    keyed = _keyed(texts, depth)
    ends = [f(F.get("labels", F.lit(t))) for f in (F.min, F.max) for t in range(TREES)]
    nodes = keyed.groupBy("node").agg(
        F.first("tree").alias("tree"), F.count("*").alias("n"), F.sum("n_shingles").alias("size"), F.array(*ends[:TREES]).alias("low"),
        F.array(*ends[TREES:]).alias("high"), ((F.count("ball") == F.count("*")) & (F.min("ball") == F.max("ball"))).alias("one_ball"),
    )

    def together(depth: int) -> Column:
        """In which trees all texts of the node share a prefix: where the least and the largest label do."""
        return F.zip_with("low", "high", lambda a, b: F.shiftright(a, 8 * (DEPTH - depth)) == F.shiftright(b, 8 * (DEPTH - depth)))

    # a node is done if an earlier tree has all its texts in one node, if longer prefixes have in any tree, or if a ball has
    done = F.exists(F.slice(together(depth), F.lit(1), F.col("tree")), lambda x: x) | F.coalesce("one_ball", F.lit(False))
    if depth < DEPTH:
        done |= F.exists(together(depth + 1), lambda x: x)

    def chunks(n: Column, size: Column) -> Column:
        return F.greatest(F.ceil(n / BLOCK_TEXTS), F.ceil(size / BLOCK_SHINGLES)).cast("int")

    total = keyed.count()
    some = stage(nodes.filter(F.col("n") > 1).filter(~done).select("node", "n", "size", chunks(F.col("n"), F.col("size")).alias("chunks")), "near-some")
    # the largest ball of each node that is cut: its texts meet the others, not one another
    cut = some.filter("chunks > 1").select("node", F.col("n").alias("texts"))
    balls = attach(keyed.filter("ball is not null").select("node", "ball", "n_shingles"), cut, "node", "texts", total).groupBy("node", "ball").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("s"))
    largest = balls.groupBy("node").agg(F.max(F.struct("m", "s", "ball")).alias("b")).select("node", "b.*")
    n, size, m, s = F.col("n"), F.col("size"), F.coalesce("m", F.lit(0)), F.coalesce("s", F.lit(0))
    open_ = stage(
        some.join(largest.withColumnRenamed("ball", "big"), "node", "left").select(
            "node", "n", "big", F.greatest(F.lit(1), chunks(n - m, size - s)).alias("rest"), F.when(F.col("big").isNotNull(), chunks(m, s)).otherwise(0).alias("more"),
        ),
        "near-open",
    )
    member = attach(keyed.select("uid", "tree", "node", "ball"), open_, "node", "n", total)
    in_big = F.coalesce(F.col("ball") == F.col("big"), F.lit(False))
    mine = F.when(in_big, F.col("rest") + F.pmod(F.xxhash64("uid"), "more")).otherwise(F.pmod(F.xxhash64("uid"), "rest")).cast("int")
    # a text goes to the blocks of its chunk with each chunk that it must meet
    last = F.when(in_big, F.col("rest") - 1).otherwise(F.col("rest") + F.col("more") - 1)
    dealt = member.select("uid", "tree", "node", F.coalesce("ball", F.lit(-1)).alias("ball"), mine.alias("mine"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
    block = F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other"))
    parts = dealt.select("uid", "tree", "ball", block.alias("block"), (F.col("mine") != F.col("other")).alias("across"), (F.col("mine") > F.col("other")).alias("second"))
    full = parts.join(company.select("uid", "copies", "labels", "text").hint("merge"), "uid").select("block", "tree", "across", "second", "uid", "copies", "labels", "ball", "text")
    ordered = full.repartition("block").sortWithinPartitions("block", "uid")
    out = stage(ordered.mapInArrow(_blocks(depth, similarity), "kind long, a long, b long, n long"), f"near-links-{depth}")
    discard(some, open_)
    return out


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class (the smallest doc_id), with the columns of docs as they were."""
    rows, found = classes(docs)
    uid = rows.columns[-1]
    stays = found.filter("_uid = keep_uid").select(F.col("_uid").alias(uid))
    return rows.join(stays, uid, "left_semi").select(*docs.columns)


def op7_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near-equal texts among all documents: class_id, and the number of a document's links."""
    _, found = classes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links", (F.col("_uid") == F.col("keep_uid")).alias("kept"))


#: All pairs that share a shingle, by brute force; classes by walking along links.
OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 5 THEN [array_to_string(l, ' ')]
    ELSE list_transform(range(1, len(l) - 3), lambda i: array_to_string(l[i:i + 4], ' ')) END) AS g FROM w
),
k AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
j AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM j JOIN k x ON x.doc_id = a JOIN k y ON y.doc_id = b WHERE 10 * c >= 8 * (x.n + y.n - c)),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node),
m AS (SELECT node, min(root) AS class_id FROM r GROUP BY node)
SELECT doc_id, class_id, (SELECT count(*) FROM l WHERE a = doc_id) AS n_links, doc_id = class_id AS kept
FROM documents JOIN m ON node = doc_id
"""
