"""Quality scores by a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import learn_in_task, small_batches

WORDS = 2048  # hashed word features
RANK = 8  # of the interactions
TRAIN_ROWS = 5000  # labelled documents to learn from, at most
STATS = 16

_SYMBOL = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])
_DIGIT = np.array([48 <= b < 58 for b in range(256)])
_UPPER = np.array([65 <= b < 91 for b in range(256)])


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold`` when divided by ``folds``; NULL ids are in no fold."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def features(text: str, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a whole text: hashed words (unit length), then statistics and metadata."""
    raw = text.encode()
    words = text.lower().split()
    counts = Counter(words)
    index = np.fromiter((zlib.crc32(w.encode()) for w in counts), dtype=np.int64, count=len(counts)) % WORDS
    value = np.log1p(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))
    hashed = np.bincount(index, value, WORDS) if len(index) else np.zeros(WORDS)
    index = np.flatnonzero(hashed)
    value = hashed[index] / max(np.sqrt((hashed ** 2).sum()), 1e-9)
    seen = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n, m = max(len(raw), 1), max(len(words), 1)
    lines = text.split("\n")
    stats = [
        np.log1p(len(raw)), np.log1p(len(words)), len(raw) / m, seen[_SYMBOL].sum() / n, seen[_DIGIT].sum() / n,
        seen[_UPPER].sum() / n, seen[128:].sum() / n, seen[32] / n, len(counts) / m,
        max(counts.values(), default=0) / m, sum(map(eq, words, words[1:])) / m, np.log1p(len(lines)),
        1 - len(set(lines)) / len(lines), seen[_SYMBOL].max() / n, float(n_chars is not None), np.log1p(max(n_chars or 0, 0)),
    ]
    return np.append(index, WORDS + np.arange(STATS)), np.append(value, stats)


class Machine:
    """score = bias + sum w x + 1/2 sum over factors of ((sum v x)^2 - sum v^2 x^2)."""

    def __init__(self, bias: float = 0.0, weight=None, factor=None, mean=None, scale=None):
        self.bias = bias
        self.weight = np.zeros(WORDS + STATS) if weight is None else weight
        self.factor = np.zeros((WORDS + STATS, RANK)) if factor is None else factor
        self.mean = np.zeros(STATS) if mean is None else mean
        self.scale = np.ones(STATS) if scale is None else scale

    def standard(self, value: np.ndarray) -> np.ndarray:
        """Values with the statistics at their end brought to mean 0 and deviation 1, cut at 4."""
        stats = np.clip((value[..., -STATS:] - self.mean) / self.scale, -4, 4)
        return np.concatenate([value[..., :-STATS], stats], axis=-1)

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        """Probability of label 1, linear in the number of features and factors."""
        value = self.standard(value)
        v = self.factor[index] * value[:, None]
        pairs = 0.5 * ((v.sum(axis=0) ** 2).sum() - (v ** 2).sum())
        return float(_sigmoid(self.bias + value @ self.weight[index] + pairs))

    @classmethod
    def fit(cls, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 30, seed: int = 5) -> Machine:
        """Adam on the log loss, with weight decay on words. Without both labels the score is a constant."""
        share = (labels.sum() + 1) / (len(labels) + 2)
        if not len(labels) or labels.min() == labels.max():
            return cls(bias=float(np.log(share / (1 - share))))
        x = np.zeros((len(rows), WORDS + STATS), dtype=np.float32)
        for i, (index, value) in enumerate(rows):
            x[i, index] = value
        stats = x[:, WORDS:].astype(np.float64)
        self = cls(0.0, mean=stats.mean(axis=0), scale=np.maximum(stats.std(axis=0), 1e-6))
        x[:, WORDS:] = np.clip((stats - self.mean) / self.scale, -4, 4)
        rng = np.random.default_rng(seed)
        params = [np.zeros(1), np.zeros(WORDS + STATS), rng.normal(0, 0.01, (WORDS + STATS, RANK))]
        decay = np.full(WORDS + STATS, 1e-4)
        decay[:WORDS] = 3e-3
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for first in range(0, len(x), 256):
                part = order[first:first + 256]
                b, y = x[part].astype(np.float64), labels[part]
                inner = b @ params[2]
                square = b ** 2
                raw = params[0] + b @ params[1] + 0.5 * ((inner ** 2).sum(axis=1) - (square @ params[2] ** 2).sum(axis=1))
                error = (_sigmoid(raw) - y) / len(part)
                grads = [
                    np.array([error.sum()]), b.T @ error + decay * params[1],
                    b.T @ (error[:, None] * inner) - (square.T @ error)[:, None] * params[2] + decay[:, None] * params[2],
                ]
                step += 1
                for p, g, (m, s) in zip(params, grads, moments):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g ** 2 - s)
                    p -= 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
        self.bias, self.weight, self.factor = float(params[0][0]), params[1], params[2]
        return self


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str, text_col: str, *more: str) -> DataFrame:
    """At most ``rows`` labelled documents, chosen by a hash of the id; of several labels of an id the largest counts."""
    chosen = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(id_col).agg(F.max(label).alias("target"))
        .orderBy(F.xxhash64(id_col), id_col).limit(rows)
    )
    # The sample is bounded by a parameter, so it may be sent to every task.
    return small_batches(docs).select(id_col, text_col, *more).join(F.broadcast(chosen), id_col).dropDuplicates([id_col])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS, id_col: str = "doc_id",
        text_col: str = "text", chars_col: str = "n_chars") -> Machine:
    """Learn from at most ``rows`` of the labelled documents, in one task; the driver gets the model alone.

    Whole texts of any length are read. Other columns of ``docs`` and ``labels`` are ignored, whatever their names.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 200):
                target, text, chars = (c.to_pylist() for c in batch.slice(first, 200).columns)
                found = [features(t or "", c) for t, c in zip(text, chars)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(target, pa.int32()), pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
                    pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32())),
                ], ["target", "index", "value"])

    sample = labelled_sample(docs, labels, label, rows, id_col, text_col, chars_col)
    found = sample.select(F.col("target").cast("int"), text_col, F.col(chars_col).cast("long")).mapInArrow(
        run, "target int, index array<int>, value array<float>"
    )
    return learn_in_task(found, _learn) or Machine.fit([], np.zeros(0))


def _learn(got: pa.Table) -> Machine:
    index, value = ([x.values.to_numpy() for x in got.column(c)] for c in ("index", "value"))
    # An order of its own, so that the model does not depend on how Spark dealt the rows out.
    order = sorted(range(got.num_rows), key=lambda i: (zlib.crc32(value[i].tobytes()), zlib.crc32(index[i].tobytes())))
    target = got.column("target").to_numpy()[order].astype(np.float64)
    return Machine.fit([(index[i], value[i]) for i in order], target)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars",
          keep: list[str] | None = None) -> DataFrame:
    """``docs`` (columns ``keep``, by default the id) with ``score``, the probability of label 1 of each whole text.

    NULL and empty texts are scored like any other, by their statistics. Rows repeated with one id are scored each;
    an empty table gives an empty result; no other column than text and length has a part in the score.
    """
    keep = keep or [id_col]
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fm = model.value
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                found = [fm.score(*features(t or "", c)) for t, c in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns[2:], pa.array(found, pa.float64())], [*names, "score"])

    names = [f"k{i}" for i in range(len(keep))]
    rows = small_batches(docs).select(
        F.col(text_col).alias("_text"), F.col(chars_col).cast("long").alias("_chars"), *(F.col(c).alias(n) for c, n in zip(keep, names))
    )
    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes[2:])
    scored = rows.mapInArrow(run, f"{kinds}, score double")
    return scored.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "score")
