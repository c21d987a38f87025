"""Toxicity scores by a classifier whose scores may not change when identity terms are swapped."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import learn_in_task, small_batches

TRAIN_ROWS = 3000  # labelled documents of each label to learn from, at most
MOST_FEATURES = 2000
PREFIXES = (4, 5, 6)
PENALTY = 5.0
EDGES = ".,;:!?\"'()[]{}<>*#%&$@-_/\\|~^+=`"

# Fixed word lists: group names that may be swapped for one another.
IDENTITY_GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "locals", "foreigners"),
    ("german", "french", "spanish", "turkish", "polish", "mexican", "chinese", "american"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
    ("musulmans", "chrétiens", "juifs"),
    ("musulmanes", "cristianos", "judíos"),
    ("muslime", "christen", "juden"),
    ("disabled", "deaf", "blind"),
    ("old", "young"),
)
SWAP = {word: group[(i + 1) % len(group)] for group in IDENTITY_GROUPS for i, word in enumerate(group)}


SENTENCE_END = re.compile(r"[.!?]+\s|\n")


def words_of(text: str) -> set[str]:
    return {w.strip(EDGES) for w in text.lower().split()} - {""}


def word_features(words: set[str]) -> np.ndarray:
    """32-bit hashes of words and of the beginnings of words, each once."""
    found = {w.encode() for w in words}
    for n in PREFIXES:
        found.update(w[:n].encode() + b"\x00" for w in words if len(w) > n)
    return np.unique(np.fromiter(map(zlib.crc32, found), dtype=np.uint32, count=len(found)))


Change = tuple[tuple[int, ...], tuple[int, ...]]


def swaps(text: str) -> set[Change]:
    """What swapping one identity term in one sentence does to the features of the sentence: those that go, those that come.

    Terms are swapped one at a time for the next of their group, so a sentence that names several members of a group, or
    several groups, gives a change for each.
    """
    found: set[Change] = set()
    for sentence in SENTENCE_END.split(text):
        words = words_of(sentence)
        for term in words.intersection(SWAP):
            rest = word_features(words - {term})
            before, after = np.union1d(rest, word_features({term})), np.union1d(rest, word_features({SWAP[term]}))
            gone, come = np.setdiff1d(before, after), np.setdiff1d(after, before)
            found.add((tuple(gone.tolist()), tuple(come.tolist())))
    return found


class Toxicity:
    """A linear model over the presence of chosen features (sorted hashes)."""

    def __init__(self, hashes: np.ndarray, weight: np.ndarray, bias: float):
        self.hashes, self.weight, self.bias = hashes, weight, bias

    def score(self, text: str) -> float:
        found = word_features(words_of(text))
        if not len(self.hashes) or not len(found):
            return float(_sigmoid(self.bias))
        at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        hit = self.hashes[at] == found
        return float(_sigmoid(self.bias + self.weight[at[hit]].sum()))

    @classmethod
    def fit(cls, rows: list[np.ndarray], changes: Mapping[Change, int], labels: np.ndarray, weights: np.ndarray,
            penalty: float = PENALTY, steps: int = 300) -> Toxicity:
        """Weighted log loss, decay, and ``penalty`` times the mean squared change of the logit under the swaps in ``changes``.

        A change of no chosen feature leaves the score as it is; ``changes`` has how often each occurs.
        """
        share = float((weights * labels).sum() + 0.5) / float(weights.sum() + 1.0)
        bias = float(np.log(share / (1 - share)))
        if not len(labels) or labels.min() == labels.max():
            return cls(np.zeros(0, np.uint32), np.zeros(0), bias)
        changed = sorted(changes)
        sides = [[np.array(c[side], dtype=np.uint32) for c in changed] for side in (0, 1)]
        hashes = _choose(rows, labels, [x for side in sides for x in side])
        x = _presence(rows, hashes)
        change = _presence(sides[1], hashes) - _presence(sides[0], hashes)
        often = np.array([changes[c] for c in changed], dtype=np.float32)
        weight, m, s = np.zeros(len(hashes), np.float32), np.zeros(len(hashes) + 1), np.zeros(len(hashes) + 1)
        total = weights.sum()
        for step in range(1, steps + 1):
            error = (weights * (_sigmoid(bias + x @ weight) - labels) / total).astype(np.float32)
            grad = x.T @ error + 2e-4 * weight
            if len(changed):
                grad += penalty * 2 * (change.T @ (often * (change @ weight))) / often.sum()
            grad = np.append(grad, error.sum())
            m = 0.9 * m + 0.1 * grad
            s = 0.999 * s + 0.001 * grad ** 2
            move = 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
            weight, bias = weight - move[:-1].astype(np.float32), bias - float(move[-1])
        return cls(hashes, weight, bias)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _choose(rows: list[np.ndarray], labels: np.ndarray, changed: list[np.ndarray]) -> np.ndarray:
    """At most MOST_FEATURES features found clearly more often under one label, and those of all identity terms that occur."""
    flat = np.concatenate(rows)
    owner = np.repeat(labels, [len(r) for r in rows])
    names, at = np.unique(flat, return_inverse=True)
    toxic = np.bincount(at, owner, len(names))
    clean = np.bincount(at, 1 - owner, len(names))
    n_toxic, n_clean = labels.sum(), (1 - labels).sum()
    share = (toxic + clean) / (n_toxic + n_clean)
    spread = np.sqrt(share * (1 - share) * (1 / n_toxic + 1 / n_clean)) + 1e-9
    z = (toxic / n_toxic - clean / n_clean) / spread
    often = np.flatnonzero((np.abs(z) > 4) & (toxic + clean >= 6))
    often = often[np.argsort(-np.abs(z[often]), kind="stable")][:MOST_FEATURES]
    terms = word_features(set(SWAP))
    present = np.intersect1d(terms, np.concatenate([flat, *changed]))
    return np.union1d(names[often], present).astype(np.uint32)


def _presence(rows: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    x = np.zeros((len(rows), len(hashes)), dtype=np.float32)
    for i, found in enumerate(rows):
        x[i] = np.isin(hashes, found, assume_unique=True)
    return x


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS, penalty: float = PENALTY,
        id_col: str = "doc_id", text_col: str = "text") -> Toxicity:
    """Learn from at most ``rows`` documents of each label; weights restore how common the labels are.

    The documents are chosen by a hash of the id; of several labels of an id the largest counts. One task learns from their
    hashed features, and from what swaps of identity terms change in the sentences of a text (see ``swaps``); the driver gets the model alone. Of a very
    long text all words and sentences count; other columns of ``labels`` and ``docs`` are ignored, whatever their names.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        pair = pa.list_(pa.struct([("gone", kind), ("come", kind)]))
        for batch in batches:
            for first in range(0, batch.num_rows, 100):
                target, text = (c.to_pylist() for c in batch.slice(first, 100).columns)
                changes = [[{"gone": gone, "come": come} for gone, come in sorted(swaps(t or ""))] for t in text]
                yield pa.RecordBatch.from_arrays([
                    pa.array(target, pa.int32()), pa.array([word_features(words_of(t or "")).astype(np.int64) for t in text], kind),
                    pa.array(changes, pair),
                ], ["target", "found", "changes"])

    known = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(id_col)
        .agg(F.max((F.col(label) > 0).cast("int")).alias("target"))
    )
    sizes = {r.target: r.n for r in known.groupBy("target").agg(F.count("*").alias("n")).collect()}
    order = (F.xxhash64(id_col), F.col(id_col))
    chosen = known.filter("target = 1").orderBy(*order).limit(rows).unionByName(
        known.filter("target = 0").orderBy(*order).limit(rows)
    )
    # At most twice ``rows`` ids: a bounded sample may be sent to every task.
    sample = small_batches(docs).select(id_col, text_col).join(F.broadcast(chosen), id_col).dropDuplicates([id_col])
    found = sample.select("target", text_col).mapInArrow(
        run, "target int, found array<long>, changes array<struct<gone: array<long>, come: array<long>>>"
    )
    model = learn_in_task(found, lambda got: _learn(got, sizes, penalty))
    return model or Toxicity.fit([], {}, np.zeros(0), np.zeros(0), penalty)


def _learn(got: pa.Table, sizes: Mapping[int, int], penalty: float) -> Toxicity:
    found = [x.values.to_numpy().astype(np.uint32) for x in got.column("found")]
    changes = Counter((tuple(c["gone"]), tuple(c["come"])) for x in got.column("changes").to_pylist() for c in x)
    turn = sorted(range(got.num_rows), key=lambda i: zlib.crc32(found[i].tobytes()))
    target = got.column("target").to_numpy()[turn].astype(np.float64)
    taken = {t: max(int((target == t).sum()), 1) for t in (0, 1)}
    weights = np.where(target == 1, sizes.get(1, 0) / taken[1], sizes.get(0, 0) / taken[0])
    return Toxicity.fit([found[i] for i in turn], changes, target, weights, penalty)


def score(docs: DataFrame, model: Toxicity, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (columns ``keep``, by default the id) with ``score``, the probability that each whole text is toxic.

    NULL and empty texts have the score of a text without any known feature. Rows repeated with one id are scored each;
    an empty table gives an empty result; no column but the text has a part in the score.
    """
    keep = keep or [id_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                found = [judge.score(t or "") for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(found, pa.float64())], [*names, "score"])

    names = [f"k{i}" for i in range(len(keep))]
    rows = small_batches(docs).select(F.col(text_col).alias("_text"), *(F.col(c).alias(n) for c, n in zip(keep, names)))
    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes[1:])
    scored = rows.mapInArrow(run, f"{kinds}, score double")
    return scored.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "score")
