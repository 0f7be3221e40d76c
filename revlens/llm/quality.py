"""Document quality: histogram gradient-boosted trees over document statistics.

Statistics of every whole text are computed once and staged (they are some dozens of
bytes a document). The trees are fitted on a bounded sample of labelled rows, flattened
into arrays and sent to the tasks, where numpy walks all documents of a batch at once.

Defined results: a null text counts as empty, and empty texts have statistics of 0 and get
a score too; a null ``doc_id`` is kept; repeated rows are scored each; without labelled rows, or
with one class only, the score is that class's share (0.5 without any); an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, texts

SAMPLE = 30_000      # labelled documents that the trees are fitted on, at most
TREES, DEPTH, BINS, RATE, L2, MIN_WEIGHT = 80, 4, 64, 0.15, 2.0, 3.0

STATISTICS = ("chars", "words", "lines", "word_len", "upper", "digit", "punct", "space", "high", "symbol",
              "bang", "pipe", "stop", "distinct_words", "distinct_lines", "worst_symbol", "worst_upper",
              "worst_pipe", "worst_bang", "long_line", "rare_byte", "entropy", "odd_words", "no_lower")

_LOWER, _UPPER, _DIGIT, _SPACE, _HIGH, _STOP, _PUNCT = range(7)
_KIND = np.full(256, _PUNCT, np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = _LOWER, _UPPER, _DIGIT, _HIGH
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[[44, 46]] = _STOP


def statistics(text: bytes) -> list[float]:
    """STATISTICS of one text; ``worst_*`` is the largest share within a line."""
    x = np.frombuffer(text, np.uint8)
    if not len(x):
        return [0.0] * len(STATISTICS)
    n, count = len(x), np.bincount(x, minlength=256)
    kinds = np.bincount(_KIND[x], minlength=7) / n
    words, lines = text.split(), text.split(b"\n")
    k = max(1, len(words))
    symbol = count[[35, 36, 37, 38, 42, 64, 94, 126]].sum() / n
    ends = np.flatnonzero(np.concatenate([[True], x[:-1] == 10]))
    size = np.maximum(1, np.diff(np.append(ends, n)))

    def worst(codes) -> float:
        hit = np.isin(x, codes)
        sums = np.add.reduceat(hit.astype(np.int64), ends)
        return float(np.max(sums / (size + 20.0)))
    p = count[count > 0] / n
    return [float(np.log1p(n)), float(np.log1p(len(words))), float(np.log1p(len(lines))), n / k,
            kinds[_UPPER], kinds[_DIGIT], kinds[_PUNCT], kinds[_SPACE], kinds[_HIGH], float(symbol),
            count[33] / n, count[124] / n, kinds[_STOP], len(set(words)) / k, len(set(lines)) / len(lines),
            worst([35, 36, 37, 38, 42]), worst(range(65, 91)), worst([124]), worst([33]),
            float(np.log1p(size.max())), count[0:9].sum() / n, float(-(p * np.log2(p)).sum()),
            sum(not w[-1:].isalpha() and w[-1] < 128 for w in words) / k, sum(w.isupper() for w in words) / k]


def _stats(batches):
    for b in batches:
        rows = [statistics(x) for x in b.column("text").cast(pa.binary()).to_pylist()]
        flat = np.array(rows, np.float32).reshape(len(rows), len(STATISTICS))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array([r.tobytes() for r in flat], pa.binary())], ["doc_id", "stats"])


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats): the float32 statistics of every whole text."""
    return texts(docs).mapInArrow(_stats, "doc_id long, stats binary")


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1).astype(np.int64)


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """Boosted trees as flat arrays: per tree a complete binary tree of DEPTH levels."""
    share = float(y.mean()) if len(y) else 0.5
    nodes = 2 ** DEPTH - 1
    model = {"base": share, "feature": np.zeros((0, nodes), np.int64), "cut": np.zeros((0, nodes)),
             "leaf": np.zeros((0, nodes + 1)), "edges": []}
    if share in (0.0, 1.0) or not len(y):
        return model
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    bins, d = _binned(x, edges), x.shape[1]
    flat = bins + np.arange(d) * BINS
    margin = np.full(len(y), np.log(share / (1 - share)))
    trees = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
        for level in range(DEPTH):
            wide, first = 2 ** level, 2 ** level - 1
            key = (flat + ((at - first) * d * BINS)[:, None]).ravel()
            hist = [np.bincount(key, np.repeat(w, d), wide * d * BINS).reshape(wide, d, BINS).cumsum(2)
                    for w in (g, h)]
            left_g, left_h = hist
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g ** 2 / (left_h + L2) + right_g ** 2 / (right_h + L2) - all_g ** 2 / (all_h + L2)
            gain[(left_h < MIN_WEIGHT) | (right_h < MIN_WEIGHT)] = 0
            best = gain.reshape(wide, -1).argmax(1)
            for k, b in enumerate(best):
                if gain[k].flat[b] > 1e-6:
                    j, v = divmod(int(b), BINS)
                    feature[first + k], cut[first + k] = j, edges[j][v] if v < len(edges[j]) else np.inf
            right = x[np.arange(len(y)), feature[at]] > cut[at]
            at = 2 * at + 1 + right
        leaf_at = at - nodes
        sums = [np.bincount(leaf_at, w, nodes + 1) for w in (g, h)]
        leaf = -RATE * sums[0] / (sums[1] + L2)
        margin = margin + leaf[leaf_at]
        trees.append((feature, cut, leaf))
    model |= {k: np.stack([t[i] for t in trees]) for i, k in enumerate(("feature", "cut", "leaf"))}
    return model


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Scores of rows; every tree is walked level by level for all rows at once."""
    base = model["base"]
    if not len(model["feature"]):
        return np.full(len(x), base)
    margin, rows = np.full(len(x), np.log(base / (1 - base))), np.arange(len(x))
    for feature, cut, leaf in zip(model["feature"], model["cut"], model["leaf"]):
        at = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
        margin += leaf[at - len(feature)]
    return 1 / (1 + np.exp(-margin))


def train(stats: DataFrame, labels: DataFrame, keep: Column, sample: int = SAMPLE) -> dict:
    """Fits on at most ``sample`` labelled rows (24 floats each), drawn by a hash of the id."""
    drawn = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
             .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & keep)
             .groupBy("doc_id").agg(F.max("y").alias("y"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (stats.join(F.broadcast(drawn), "doc_id").groupBy("doc_id")
            .agg(F.max("stats").alias("stats"), F.max("y").alias("y")).orderBy("doc_id").collect())
    x = np.array([np.frombuffer(r.stats, np.float32) for r in rows], np.float64).reshape(len(rows), len(STATISTICS))
    return fit(x, np.array([r.y for r in rows], np.float64))


def score(stats: DataFrame, model: dict) -> DataFrame:
    sent = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            raw = b"".join(b.column("stats").to_pylist())
            x = np.frombuffer(raw, np.float32).reshape(b.num_rows, len(STATISTICS)).astype(np.float64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(predict(sent.value, x))],
                                             ["doc_id", "score"])
    return stats.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, keep: Column, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, score) of every document."""
    stats = staged(document_statistics(docs))
    return score(stats, train(stats, labels, keep, sample))
