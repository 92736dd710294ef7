"""Vector compression by product quantisation, with exact nearest entries found over metric trees.

Vectors are held in chunks, and each part position of a chunk has a tree of balls, built from the middle out: anchors
(about the root of the number of points) take points from one another by the triangle inequality, are merged upwards in
pairs, and are split downwards by anchors of their own. A ball caches the sums and the count of its points. A round sends
the codebook down all trees at once, a level at a time: a ball inherits the entries that its parent kept, drops those
that can't be nearest to any of its points, and is done when one entry is left, as its sums then go to that entry whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, discard, stage
from .topk import integers

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of a chunk, and points of a ball that isn't split.
CHUNK, LEAF = 2048, 64
#: Components must be smaller than this, so that squared distances and their sums fit into 64 bits.
LARGEST = 1 << 28
#: Below this, squared distances made of products are exact in float64.
SMALL = 1 << 21
#: Fields of a tree: of each ball its centre, radius, sums, count, children (-1: none) and run of points; and the points' order.
TREE = "centre array<double>, radius array<double>, sums array<long>, left array<int>, right array<int>, start array<int>, stop array<int>, place array<int>"
POINTS = pa.list_(pa.int64())


class Balls:
    """A metric tree over points (rows of whole numbers)."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points.astype(float)
        self.place: list[np.ndarray] = []
        self.seen = 0
        self.rows: list[list] = []
        self.build(np.arange(len(points)))
        order = np.concatenate(self.place)
        self.order = order.astype(np.int32)
        self.left, self.right, self.start, self.stop = (np.array([r[i] for r in self.rows], np.int32) for i in range(4))
        sorted_ = points[order]
        total = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(sorted_, axis=0)])
        self.sums = total[self.stop] - total[self.start]
        self.centre = self.sums / (self.stop - self.start)[:, None]
        self.radius = np.array([math.sqrt(((sorted_[r[2] : r[3]] - c) ** 2).sum(1).max()) for r, c in zip(self.rows, self.centre, strict=True)])

    def leaf(self, ids: np.ndarray) -> int:
        self.rows.append([-1, -1, self.seen, self.seen + len(ids)])
        self.place.append(ids)
        self.seen += len(ids)
        return len(self.rows) - 1

    def build(self, ids: np.ndarray) -> int:
        """The ball of some points: their anchors, merged in pairs from the closest up, each split downwards in turn."""
        if len(ids) <= LEAF:
            return self.leaf(ids)
        at, owner, radius = self.anchors(ids)
        if len(at) == 1:
            return self.leaf(ids)
        # what to do with each ball: an anchor's points, or a pair of balls
        balls: list = [ids[owner == i] for i in range(len(at))]
        centres, radii, live = self.points[at], radius.copy(), list(range(len(at)))
        gap = (np.linalg.norm(centres[:, None] - centres[None], axis=2) + radii[:, None] + radii[None]) / 2
        np.fill_diagonal(gap, np.inf)
        while len(live) > 1:
            i, j = np.unravel_index(np.argmin(gap), gap.shape)
            i, j = min(i, j), max(i, j)
            balls[i] = (balls[i], balls[j])
            radii[i], centres[i] = gap[i, j], (centres[i] + centres[j]) / 2
            live.remove(j)
            gap[j], gap[:, j] = np.inf, np.inf
            others = np.array([x for x in live if x != i], int)
            gap[i, others] = gap[others, i] = (np.linalg.norm(centres[others] - centres[i], axis=1) + radii[others] + radii[i]) / 2
        return self.pair(balls[live[0]])

    def pair(self, ball) -> int:
        if not isinstance(ball, tuple):
            return self.build(ball)
        row = [0, 0, self.seen, 0]
        self.rows.append(row)
        nth = len(self.rows) - 1
        row[0], row[1] = self.pair(ball[0]), self.pair(ball[1])
        row[3] = self.seen
        return nth

    def anchors(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(points that are anchors, each point's anchor, radii). A new anchor is the farthest point of the widest one.

        It takes the points that are closer to it; of an anchor at distance d, none within d / 2 of that anchor is.
        """
        x = self.points[ids]
        owner, far = np.zeros(len(ids), int), np.linalg.norm(x - x[0], axis=1)
        at, radius = [0], [far.max()]
        for _ in range(math.isqrt(len(ids) - 1)):
            widest = int(np.argmax(radius))
            if radius[widest] == 0:
                break
            mine = np.flatnonzero(owner == widest)
            new = mine[np.argmax(far[mine])]
            apart = np.linalg.norm(x[at] - x[new], axis=1)
            near = np.flatnonzero(far > apart[owner] / 2)
            d = np.linalg.norm(x[near] - x[new], axis=1)
            taken = d < far[near]
            lost = np.unique(owner[near[taken]])
            owner[near[taken]], far[near[taken]] = len(at), d[taken]
            at.append(new)
            radius.append(0.0)
            for i in [*lost.tolist(), len(at) - 1]:
                inside = far[owner == i]
                radius[i] = inside.max() if len(inside) else 0.0
        return ids[at], owner, np.array(radius)


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole numbers."""
    if max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0)) < SMALL:
        a, b = points.astype(float), entries.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((points - e) ** 2).sum(1) for e in entries], 1)


def assign(tree: dict[str, np.ndarray], points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(entry of each point in the tree's order, sums and counts by entry, points that were compared one by one).

    The nearest entry is exact, ties go to the lower one: bounds only drop entries that are farther than another for
    every point of a ball.
    """
    n, code = len(entries), np.full(len(points), -1, np.int64)
    sums, counts = np.zeros((n, points.shape[1]), np.int64), np.zeros(n, np.int64)
    at, kept, single = np.array([0]), np.ones((1, n), bool), 0
    size = tree["stop"] - tree["start"]
    while len(at):
        d = np.where(kept, np.linalg.norm(tree["centre"][at][:, None] - entries[None], axis=2), np.inf)
        least = d.min(1)
        kept &= d <= (least + 2 * tree["radius"][at] + 1e-9 * (1 + least + tree["radius"][at]))[:, None]
        whole = kept.sum(1) == 1
        entry = kept.argmax(1)
        np.add.at(sums, entry[whole], tree["sums"][at[whole]])
        np.add.at(counts, entry[whole], size[at[whole]])
        for ball, e in zip(at[whole].tolist(), entry[whole].tolist(), strict=True):
            code[tree["start"][ball] : tree["stop"][ball]] = e
        leaf = ~whole & (tree["left"][at] < 0)
        if leaf.any():
            balls = at[leaf]
            rows = np.concatenate([np.arange(tree["start"][b], tree["stop"][b]) for b in balls])
            near = np.where(np.repeat(kept[leaf], size[balls], axis=0), distances(points[rows], entries), np.iinfo(np.int64).max)
            code[rows] = near.argmin(1)
            np.add.at(sums, code[rows], points[rows])
            counts += np.bincount(code[rows], minlength=n)
            single += len(rows)
        down = ~whole & ~leaf
        at, kept = np.concatenate([tree["left"][at[down]], tree["right"][at[down]]]), np.concatenate([kept[down], kept[down]])
    return code, sums, counts, single


def _chunks(width: int):
    """Rows (uid, x) to a row for each chunk: uids, and of each part its points in tree order, and its tree."""

    def chunk(uids: list[int], x: np.ndarray) -> pa.RecordBatch:
        parts = []
        for part in np.split(x, PARTS, axis=1):
            t = Balls(part)
            parts.append({
                "points": part[t.order].reshape(-1), "centre": t.centre.reshape(-1), "radius": t.radius, "sums": t.sums.reshape(-1), "left": t.left, "right": t.right,
                "start": t.start, "stop": t.stop, "place": t.order,
            })
        return pa.RecordBatch.from_pylist([{"uids": uids, "parts": parts}], schema=CHUNKS)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uids, held = [], []
        for batch in batches:
            column = batch.column(1)
            lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            if np.abs(flat).max(initial=0) >= LARGEST:
                raise ValueError(f"a component is beyond {LARGEST} after scaling")
            x = np.zeros((len(lengths), width), np.int64)
            x[np.arange(width) < lengths[:, None]] = flat.astype(np.int64)
            uids += batch.column(0).to_pylist()
            held.append(x)
            if len(uids) >= CHUNK:
                x = np.concatenate(held)
                while len(uids) >= CHUNK:
                    yield chunk(uids[:CHUNK], x[:CHUNK])
                    uids, x = uids[CHUNK:], x[CHUNK:]
                held = [x]
        if uids:
            yield chunk(uids, np.concatenate(held))

    return task


_types = {"double": pa.float64(), "long": pa.int64(), "int": pa.int32()}
CHUNKS = pa.schema([
    ("uids", pa.list_(pa.int64())),
    ("parts", pa.list_(pa.struct([("points", POINTS), *[(n, pa.list_(_types[t.removeprefix("array<").removesuffix(">")])) for n, t in (x.strip().split(" ") for x in TREE.split(","))]]))),
])


def _trees(parts: pa.Array, row: int) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """(tree, points in its order) of each part position of a chunk."""
    all_ = parts[row].values
    for j in range(len(all_)):
        tree = {all_.type.field(i).name: all_.field(i)[j].values.to_numpy(zero_copy_only=False) for i in range(all_.type.num_fields)}
        points = tree.pop("points")
        points = points.reshape(len(tree["place"]), -1)
        tree["centre"], tree["sums"] = (tree[k].reshape(len(tree["radius"]), -1) for k in ("centre", "sums"))
        yield tree, points


def refine(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one more round: floors of the means of what is nearest to each entry; the driver gets a row for each entry."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = [np.zeros(b.shape, np.int64) for b in books], [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for row in range(batch.num_rows):
                for j, (tree, points) in enumerate(_trees(batch.column(0), row)):
                    _, s, n, _ = assign(tree, points, books[j])
                    sums[j] += s
                    counts[j] += n
        rows = [(j, e, counts[j][e], sums[j][e].tolist()) for j in range(len(books)) for e in range(len(books[j])) if counts[j][e]]
        if rows:
            yield pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], ["part", "entry", "n", "sums"])

    found = trees.select("parts").mapInArrow(task, "part long, entry long, n long, sums array<long>").select("part", "entry", "n", F.posexplode("sums").alias("at", "v"))
    means = found.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    out = [b.copy() for b in books]
    for r in means.collect():  # PARTS * ENTRIES * components of a part
        out[r.part][r.entry, r["at"]] = int(r.v) // r.n
    return out


def compress(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each vector that takes part.

    Rows whose vector is null, or holds a null or non-finite component, are dropped; null and repeated ids stay, each
    row by itself. A component is floor(SCALE * x), which must be below LARGEST (else the job ends). Vectors are padded
    with zeros to the next multiple of PARTS of the longest one's length, and cut into PARTS equal parts. The first
    codebook has the parts of the vectors with the ENTRIES smallest ids (null last; rows with one id by their
    components), or of all where there are fewer. ROUNDS times, each part goes to its nearest entry (the lower one of
    equals), and an entry becomes the floor of the mean of its parts; without parts it stays. An empty table gives no rows.

    Nothing is shuffled but sums by entry, errors by label, and the codes, back to their rows.
    """
    source = stage(vectors.select(F.monotonically_increasing_id().alias("uid"), F.col(id).alias("_id"), F.col(vector).alias("_x"), F.col(label).cast("string").alias("_label")), "codes-source")
    rows = stage(integers(source, F.col("uid"), "_id", "_x", SCALE).select("uid", "id", "size", "x"), "codes-rows")
    width = rows.agg(F.max("size")).first()[0] or 1
    width = -(-width // PARTS) * PARTS
    first = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(ENTRIES).select("x").toPandas()["x"]
    start = np.array([np.pad(v, (0, width - len(v))) for v in first]).reshape(len(first), width)
    if np.abs(start).max(initial=0) >= LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} after scaling")
    books = [np.ascontiguousarray(b) for b in np.split(start.astype(np.int64), PARTS, axis=1)]
    schema = f"uids array<long>, parts array<struct<{', '.join(x.strip().replace(' ', ':') for x in ('points array<long>,' + TREE).split(','))}>>"
    trees = stage(rows.select("uid", "x").mapInArrow(_chunks(width), schema), "codes-trees")
    for _ in range(ROUNDS if len(first) else 0):
        books = refine(trees, books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                uids = batch.column(0)[row].values
                codes, errors = np.zeros((len(uids), PARTS), np.uint8), np.zeros(len(uids), np.int64)
                for j, (tree, points) in enumerate(_trees(batch.column(1), row)):
                    got, _, _, _ = assign(tree, points, books[j])
                    codes[tree["place"], j] = got
                    errors[tree["place"]] += ((points - books[j][got]) ** 2).sum(1)
                yield pa.record_batch([uids, pa.array([c.tobytes().hex() for c in codes]), pa.array(errors)], ["uid", "code", "error"])

    coded = trees.mapInArrow(code, "uid long, code string, error long")
    # null and every label have keys of their own
    named = source.select("uid", F.col("_id").alias("vec_id"), F.coalesce(F.concat(F.lit("="), "_label"), F.lit("")).alias("key"))
    both = stage(coded.join(named, "uid").select("vec_id", "code", "error", "key"), "codes-coded")
    by_label = stage(both.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "codes-labels")
    total = both.count()
    discard(source, rows, trees)
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e.tolist()).encode()).hexdigest()
    return attach(both, by_label, "key", "n", total).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_metric_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all vectors."""
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))


def _sql() -> str:
    """Plain rounds: every part against every entry. Floors of quotients are made of remainders, so all is exact."""
    head = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
p AS MATERIALIZED (SELECT vec_id, part, x[part * len(x) // {PARTS} + 1 : (part + 1) * len(x) // {PARTS}] AS v FROM kept, range({PARTS}) r(part)),
b0 AS MATERIALIZED (
  SELECT part, nth AS entry, v FROM p JOIN (SELECT vec_id, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS BIGINT) AS nth FROM kept ORDER BY vec_id LIMIT {ENTRIES}) f USING (vec_id)
)"""

    def nearest(k: int) -> str:
        square = "CAST(list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
        return f"""
a{k} AS MATERIALIZED (
  SELECT vec_id, part, v, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (SELECT p.vec_id, p.part, p.v, b.entry, {square} AS d FROM p JOIN b{k} b USING (part)) t GROUP BY vec_id, part, v
)"""

    def book(k: int) -> str:
        return f"""
b{k} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{k - 1} b LEFT JOIN (
    SELECT part, entry, list(q ORDER BY i) AS v FROM (
      SELECT part, entry, i, (sum(c) - (((sum(c) % count(*)) + count(*)) % count(*))) // count(*) AS q
      FROM (SELECT part, entry, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM a{k - 1}) u GROUP BY part, entry, i
    ) w GROUP BY part, entry
  ) m USING (part, entry)
)"""

    steps = [x for k in range(1, ROUNDS + 1) for x in (nearest(k - 1), book(k))] + [nearest(ROUNDS)]
    return f"""{head},{','.join(steps)},
c AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id),
e AS (SELECT k.label, CAST(sum(error) AS BIGINT) AS label_error FROM c JOIN kept k USING (vec_id) GROUP BY k.label),
s AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, label_error, codebooks_sha256 FROM c JOIN kept k USING (vec_id) JOIN e ON e.label IS NOT DISTINCT FROM k.label, s
"""


OP12_SQL = _sql()
