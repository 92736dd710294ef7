"""Quality classifier: heuristic labellers, their estimated accuracies, and a hashed linear scorer trained on posteriors."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage
from .weak import ABSTAIN, BAD, GOOD, fit_votes

#: Rows that the scorer is trained on, at most. Distinct texts, drawn by a hash of the text; bad ones more often.
SAMPLE = 6000
#: Hashed features: character shapes, and steps of the labellers' measures.
SHAPES, STEPS = 1024, 256
#: Texts are rejected below this score.
THRESHOLD = 0.5

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
#: A measure's limits: bad beyond the first, good beyond the second, nothing said between. Ratios of a text's words or characters.
LABELLERS = {
    "symbols": (0.04, 0.01),  # symbols to characters of words
    "capitals": (0.4, 0.15),  # capitals to characters of words
    "repeats": (0.15, 0.05),  # words that equal the one before
    "commonest": (0.3, 0.15),  # the commonest word's share
    "sameness": (0.7, 0.55),  # words that occurred before
    "shouts": (0.3, 0.05),  # words with a double exclamation mark
    "length": (8.5, 7.0),  # characters of a word
}
#: Fewer words than this, and a labeller that counts words abstains.
ENOUGH = 20
#: Words of a window in which sameness is measured: long texts repeat words, but not within one.
WINDOW = 3000


def measures(text: str) -> tuple[int, list[float]]:
    """The number of words of a whole text, and the labellers' measures; 0 for one without words."""
    words = WORD.findall(text)
    n = len(words)
    if not n:
        return 0, [0.0] * len(LABELLERS)
    counts = Counter(words)
    chars = sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    lower = text.lower()
    capitals = sum(a != b for a, b in zip(text, lower)) if len(lower) == len(text) else sum(map(str.isupper, text))
    repeats = sum(map(str.__eq__, words, words[1:]))
    distinct = len(counts) if n <= WINDOW else sum(len(set(words[i : i + WINDOW])) for i in range(0, n, WINDOW))
    return n, [symbols / chars, capitals / chars, repeats / n, max(counts.values()) / n, 1 - distinct / n, text.count("!!") / n, chars / n]


def votes(n: int, got: list[float]) -> list[int]:
    """Votes of a text of n words; none for one without words."""
    out = []
    for (name, (bad, good)), x in zip(LABELLERS.items(), got, strict=True):
        silent = n == 0 or (name in ("repeats", "commonest", "sameness") and n < ENOUGH)
        out.append(ABSTAIN if silent else BAD if x > bad else GOOD if x < good else ABSTAIN)
    return out


def _shape_table() -> np.ndarray:
    """Bytes to kinds: small letters and all beyond ASCII, capitals, digits, and each other character by itself."""
    table = np.arange(256, dtype=np.int64)
    for i in range(256):
        c = chr(i)
        table[i] = 1 if i >= 128 or c.islower() else 2 if c.isupper() else 3 if c.isdigit() else i
    return table


SHAPE = _shape_table()


def features(text: str, got: list[float]) -> np.ndarray:
    """Hashed features of a whole text: how often each triple of character kinds occurs (root of the share), and the measures' steps."""
    kinds = SHAPE[np.frombuffer(text.encode(), np.uint8)]
    x = np.zeros(SHAPES + STEPS, np.float32)
    if len(kinds) > 2:
        triples = (kinds[:-2] << 16) | (kinds[1:-1] << 8) | kinds[2:]
        hashed = ((triples * 0x9E3779B1) & 0xFFFFFFFF) >> 22
        x[:SHAPES] = np.sqrt(np.bincount(hashed, minlength=SHAPES) / len(triples))
    for j, v in enumerate(got):
        step = min(15, int(np.log2(1 + 1000 * v)))
        x[SHAPES + (j * 0x9E3779B1 + step * 0x85EBCA6B) % STEPS] = 1
    return x


def packed(x: np.ndarray) -> bytes:
    """Places and values of the features that aren't 0, 16 bits each."""
    at = np.flatnonzero(x)
    return at.astype("<u2").tobytes() + x[at].astype("<f2").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    at, values = np.frombuffer(data, "<u2").reshape(2, -1)
    x = np.zeros(SHAPES + STEPS, np.float32)
    x[at] = values.view("<f2")
    return x


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [votes(*measures(t or "")) for t in batch.column(0).to_pylist()]
        yield pa.record_batch([pa.array([r[j] for r in rows], pa.int32()) for j in range(len(LABELLERS))], list(LABELLERS))


def train(docs: DataFrame) -> tuple[np.ndarray, float]:
    """Weights and bias. All documents are labelled and counted; the scorer sees SAMPLE rows at most."""
    text = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    labelled = stage(text.mapInArrow(_label, ", ".join(f"{n} int" for n in LABELLERS)), "labels")
    trust = fit_votes(labelled, list(LABELLERS))
    n = max(1, labelled.count())
    rate = SAMPLE / n
    odds = [rate / 2, min(1.0, rate * 4)]  # chances of good and bad ones

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, outs = [], []
            for key, chance, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                n_words, got = measures(t)
                p = float(trust.posterior(np.array([votes(n_words, got)]))[0])
                if chance < odds[p > 0.5]:
                    keys.append(key)
                    outs.append((p, packed(features(t, got))))
            if keys:
                yield pa.record_batch([pa.array(keys), pa.array([o[0] for o in outs]), pa.array([o[1] for o in outs], pa.binary())], ["key", "bad", "x"])

    key = F.xxhash64("text")
    chance = F.pmod(F.xxhash64(key, F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = text.select(key.alias("key"), chance.alias("chance"), "text").filter(F.col("chance") < max(odds))
    rows = some.mapInArrow(draw, "key long, bad double, x binary").dropDuplicates(["key"]).orderBy("key").limit(SAMPLE).collect()
    x = np.zeros((len(rows), SHAPES + STEPS), np.float32)
    for i, r in enumerate(rows):
        x[i] = unpacked(r["x"])
    return _logistic(x, np.array([1 - r["bad"] for r in rows]))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 300, rate: float = 2.0, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by gradient steps with momentum; both classes weigh the same."""
    w, b, dw, db = np.zeros(SHAPES + STEPS, np.float32), 0.0, np.zeros(SHAPES + STEPS, np.float32), 0.0
    if not len(y):
        return w, b
    weight = np.where(y > 0.5, 0.5 / max(1.0, (y > 0.5).sum()), 0.5 / max(1.0, (y <= 0.5).sum()))
    if (y > 0.5).all() or (y <= 0.5).all():
        return w, float(np.where(y.mean() > 0.5, 4.0, -4.0))
    for _ in range(steps):
        off = ((1 / (1 + np.exp(-(x @ w + b))) - y) * weight).astype(np.float32)
        dw = 0.9 * dw - rate * (off @ x + decay * w)
        db = 0.9 * db - rate * float(off.sum())
        w, b = w + dw, b + db
    return w, b


def score(docs: DataFrame, w: np.ndarray, b: float, name: str) -> DataFrame:
    """docs with a column of scores: the scorer's probability that a text is good. A null text counts as empty."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            x = np.array([float(features(t or "", measures(t or "")[1]) @ w) for t in texts])
            yield pa.record_batch([*batch.columns, pa.array(1 / (1 + np.exp(-(x + b))))], [*batch.schema.names, name])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(task, f"{types}, `{name}` double")


def op4_weak_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, score and kept of all documents. An empty text has no vote, and what the scorer makes of none."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    w, b = train(docs)
    return score(docs, w, b, "score").select("doc_id", "score", (F.col("score") >= THRESHOLD).alias("kept"))
