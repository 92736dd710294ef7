"""Exact top-k search by inner product: candidates in falling order of length, rotated partial sums, residual bounds.

Components are whole numbers, so scores are exact. An orthogonal rotation (from the eigenvectors of all vectors' Gram
matrix, so from their singular vectors) moves most of the length to the leading components; after some of them,
Cauchy-Schwarz on what is left bounds a score from above, and pairs that can't reach a query's k-th best score go. As
candidates come in falling order of length, a query ends at the first block whose longest vector is too short for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, shared_files, stage

#: Neighbours of a query in op11, and what its components are multiplied by.
K, SCALE = 5, 256
#: Candidates that a task holds while the queries stream past it (about: ranges are drawn from a sample), and queries at once.
BUCKET, QUERIES = 8192, 1024
#: Candidates of a bucket that are bounded at once.
BLOCK = 1024
#: Longest vectors that give each query its first bound.
SEEDS = 1024
#: Leading components that are rotated; later ones stay as they are. The driver gets a number for each pair of them.
ROTATED = 256
#: Below this share of pairs left, scores are made pair by pair.
SPARSE = 0.05
#: Sums of products below this are exact in float64.
EXACT = float(1 << 53)
#: Relative error that bounds allow for, far beyond that of float64 sums.
SLACK = 1e-9


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of a matrix, padded with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def integers(vectors: DataFrame, uid: Column, id: str, vector: str, scale: int) -> DataFrame:
    """(uid, id, norm, size, x) of the rows that take part: x has floor(scale * component) as whole doubles, uid is the row's own number.

    A row whose vector is null, or holds a null or non-finite component, has none. A null id stays.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            there = column.is_valid().to_numpy(zero_copy_only=False)
            lengths = np.where(there, column.value_lengths().to_numpy(zero_copy_only=False), 0).astype(np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False)  # nulls come as nan
            with np.errstate(over="ignore"):
                flat = np.floor(scale * flat)
            row = np.repeat(np.arange(len(lengths)), lengths)
            there = there & (np.bincount(row, ~np.isfinite(flat), len(lengths)) == 0)
            if not there.any():
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                norms = np.sqrt(np.bincount(row, np.where(np.isfinite(flat), flat, 0) ** 2, len(lengths)))[there]
            kept, sizes = flat[there[row]], lengths[there]
            x = pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32), kept)
            mask = pa.array(there)
            yield pa.record_batch([batch.column(0).filter(mask), batch.column(1).filter(mask), pa.array(norms), pa.array(sizes), x], ["uid", "id", "norm", "size", "x"])

    rows = vectors.select(uid.alias("uid"), F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x"))
    return rows.mapInArrow(task, "uid long, id long, norm double, size long, x array<double>")


def rotation(rows: DataFrame, width: int) -> np.ndarray:
    """An orthogonal matrix whose first columns hold most of all vectors' length, from the whole table's Gram matrix."""
    lead = min(width, ROTATED)
    upper = np.triu_indices(lead)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((lead, lead))
        for batch in batches:
            x = _matrix(batch.column(0), width)[:, :lead]
            with np.errstate(over="ignore", invalid="ignore"):
                gram += x.T @ x
        yield pa.record_batch([pa.array(np.arange(len(upper[0]))), pa.array(gram[upper])], ["at", "v"])

    sums = rows.select("x").mapInArrow(task, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()  # ROTATED squared at most
    gram = np.zeros((lead, lead))
    for r in sums:
        gram[upper[0][r.at], upper[1][r.at]] = gram[upper[1][r.at], upper[0][r.at]] = r.v
    out = np.eye(width)
    if np.isfinite(gram).all():
        out[:lead, :lead] = np.linalg.eigh(gram)[1][:, ::-1]
    return out


class Side:
    """Vectors of one side of a comparison: whole numbers, rotated numbers, lengths, and lengths of what is left after each step."""

    def __init__(self, uid: np.ndarray, x: np.ndarray, turn: np.ndarray, steps: list[int]) -> None:
        self.uid, self.x = uid, x
        with np.errstate(over="ignore", invalid="ignore"):
            self.norm = np.linalg.norm(x, axis=1)
            self.y = x @ turn
            self.tails = [np.linalg.norm(self.y[:, h:], axis=1) for h in steps]


def steps_of(width: int) -> list[int]:
    """Numbers of leading components after which pairs are bounded."""
    return sorted({h for h in (width // 8, width // 4, width // 2) if h})


def _whole(x: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)


def exact_scores(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """All inner products, as exact float64, or as Python's integers where they may not fit."""
    return a @ b.T if bound < EXACT else _whole(a) @ _whole(b).T


class Best:
    """The k best candidates of each query so far; equal scores go to the smaller id (null last)."""

    def __init__(self, n: int, k: int, floor: np.ndarray) -> None:
        self.k, self.floor = k, floor.copy()
        self.row, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.none = np.zeros(0, bool)
        self.n = n

    def add(self, row: np.ndarray, score: np.ndarray, id: np.ndarray, none: np.ndarray) -> None:
        score = score if score.dtype == object else score.astype(np.int64)
        row, score = np.concatenate([self.row, row]), np.concatenate([self.score, score])
        id, none = np.concatenate([self.id, id]), np.concatenate([self.none, none])
        rank = np.unique(score, return_inverse=True)[1] if score.dtype == object else score
        order = np.lexsort((id, none, -rank, row))
        row = row[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        order, full = order[place < self.k], order[place == self.k - 1]
        self.row, self.score, self.id, self.none = row[place < self.k], score[order], id[order], none[order]
        lowest = score[full].astype(float)
        self.floor[row[place == self.k - 1]] = np.maximum(self.floor[row[place == self.k - 1]], np.where(np.abs(lowest) < EXACT, lowest, np.nextafter(lowest, -np.inf)))


def search(queries: Side, candidates: Side, id: np.ndarray, none: np.ndarray, best: Best, steps: list[int]) -> None:
    """Add to `best` what candidates, in falling order of length, give to the queries. Rows with the same uid are the same row."""
    for at in range(0, len(candidates.uid), BLOCK):
        longest = candidates.norm[at]
        slack = SLACK * queries.norm * longest + 1e-6
        rows = np.flatnonzero(~(queries.norm * longest + slack < best.floor))
        if not len(rows):
            return  # the candidates that follow are no longer than this one
        cols = np.arange(at, min(at + BLOCK, len(candidates.uid)))
        sums, before, alive = np.zeros((len(rows), len(cols))), 0, None
        with np.errstate(over="ignore", invalid="ignore"):
            for h, q_tail, c_tail in zip(steps, queries.tails, candidates.tails, strict=True):
                sums += queries.y[rows, before:h] @ candidates.y[cols, before:h].T
                bound = sums + q_tail[rows, None] * c_tail[None, cols] + slack[rows, None]
                alive = ~(bound < best.floor[rows, None])
                r, c = alive.any(1), alive.any(0)
                rows, cols, before = rows[r], cols[c], h
                sums, alive = sums[np.ix_(r, c)], alive[np.ix_(r, c)]
                if not len(rows):
                    break
        if not len(rows):
            continue
        limit = float(queries.norm[rows].max() * candidates.norm[cols].max())
        if alive is not None and alive.mean() < SPARSE and limit < EXACT:
            i, j = np.nonzero(alive)
            score = np.einsum("ij,ij->i", queries.x[rows[i]], candidates.x[cols[j]])
            hit = (score >= best.floor[rows[i]]) & (queries.uid[rows[i]] != candidates.uid[cols[j]])
            i, j, score = i[hit], j[hit], score[hit]
        else:
            scores = exact_scores(queries.x[rows], candidates.x[cols], limit)
            _, own_r, own_c = np.intersect1d(queries.uid[rows], candidates.uid[cols], return_indices=True)
            least = best.floor[rows]
            if scores.dtype != object:
                scores[own_r, own_c] = -np.inf
                if scores.shape[1] > best.k:
                    least = np.maximum(least, np.partition(scores, -best.k, axis=1)[:, -best.k])
            hit = (scores >= least[:, None]).astype(bool)
            hit[own_r, own_c] = False
            i, j = np.nonzero(hit)
            score = scores[i, j]
        if len(i):
            best.add(rows[i], score, id[cols[j]], none[cols[j]])


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.fill_null(0).to_numpy(zero_copy_only=False), column.is_null().to_numpy(zero_copy_only=False)


def top_k(vectors: DataFrame, queries: Column, k: int = K, scale: int = SCALE, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that `queries` names, the k other rows with the highest inner products.

    Scores are of floor(scale * component); ties go to the smaller id, null last. Fewer rows than k give fewer results.
    Rows whose vector is null, or holds a null or non-finite component, are neither queries nor candidates. Rows with
    one id, or with equal vectors, are rows of their own. Shorter vectors count as padded with zeros, so an empty one
    scores 0. A score beyond 64 bits ends the job. `queries` is a condition on the id. No row is left out: bounds only
    skip pairs that can't be among the k best.

    Candidates are dealt in ranges of length; a task holds one bucket of them, and the queries, which are files in the
    shared folder, stream past it in blocks. So neither side is broadcast or gathered.
    """
    rows = stage(integers(vectors, F.monotonically_increasing_id(), id, vector, scale), "topk-rows")
    n, width = rows.agg(F.count("*"), F.max("size")).first()
    width = max(1, width or 0)
    turn, steps = rotation(rows, width), steps_of(width)
    longest = rows.orderBy(F.desc("norm"), "uid").limit(SEEDS).select("uid", "x").toPandas()
    seeds = Side(longest["uid"].to_numpy(np.int64), np.array([np.pad(v, (0, width - len(v))) for v in longest["x"]]).reshape(len(longest), width), turn, steps)

    def first_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros(len(seeds.uid), np.int64), np.zeros(len(seeds.uid), bool)
        for batch in batches:
            for part in (batch.slice(at, QUERIES) for at in range(0, batch.num_rows, QUERIES)):
                side = Side(part.column(0).to_numpy(), _matrix(part.column(2), width), turn, steps)
                best = Best(len(side.uid), k, np.full(len(side.uid), -np.inf))
                search(side, seeds, *nothing, best, steps)
                yield pa.record_batch([*part.columns, pa.array(best.floor)], ["uid", "id", "x", "floor"])

    asked = stage(rows.filter(queries).select("uid", "id", "x").mapInArrow(first_bounds, "uid long, id long, x array<double>, floor double"), "topk-queries")
    files, names = shared_files(asked), ["quid", "query_id", "vec_id", "score"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in _buckets(batches):
            uid, (ids, none) = bucket["uid"].to_numpy(), _ids(bucket["id"].combine_chunks())
            candidates = Side(uid, _matrix(bucket["x"].combine_chunks(), width), turn, steps)
            for part in files(QUERIES):
                side = Side(part.column("uid").to_numpy(), _matrix(part.column("x"), width), turn, steps)
                best = Best(len(side.uid), k, part.column("floor").to_numpy())
                search(side, candidates, ids, none, best, steps)
                if len(best.row):
                    row = pa.array(best.row)
                    yield pa.record_batch([part.column("uid").take(row), part.column("id").take(row), pa.array(best.id, pa.int64(), mask=best.none), pa.array(best.score.tolist(), pa.int64())], names)

    dealt = rows.repartitionByRange(max(1, -(-n // BUCKET)), F.desc("norm"), "uid").sortWithinPartitions(F.desc("norm"), "uid")
    found = stage(dealt.select("uid", "id", "x").mapInArrow(task, "quid long, query_id long, vec_id long, score long"), "topk-found")
    discard(rows, asked)
    order = Window.partitionBy("quid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """A partition's rows in runs of at most BUCKET."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while held and sum(b.num_rows for b in held) + batch.num_rows > BUCKET:
            room = BUCKET - sum(b.num_rows for b in held)
            yield pa.Table.from_batches([*held, batch.slice(0, room)])
            held, batch = [], batch.slice(room)
        held.append(batch)
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def op11_norm_sorted_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each fiftieth vector's 5 highest scores among all others."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"), F.col("id") % 50 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
