"""Benchmark decontamination by the q-gram lemma.

Texts and benchmark items are folded alike (lower case, every run of other characters
than letters and digits one space). An item of length L with an edit budget k shares at
least L - q + 1 - k q of its q-grams with any passage within that budget, and their
diagonals (position in the text less position in the item) lie within k of each other.
Shared q-grams are counted in overlapping diagonal bands; regions that reach the bound are
kept and verified by banded alignment of the whole item.

The benchmark goes to the tasks in blocks of at most ``BLOCK_BYTES`` (one block, unless it is
larger), so what is broadcast is bounded. Texts are scanned whole, in slices that overlap.

Defined results: a null or empty text is clean; a null ``doc_id`` is kept; repeated rows are
each judged; items that are null or empty after folding are left out; an item of fewer than
q characters contaminates only a text that folds to the same string; without items every
text is clean; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hold, prepare, texts

Q = 12
BUDGET = 0.06                 # edits, as a share of an item's length
BLOCK_BYTES = 16 * 2 ** 20
_SLICE = 1 << 21
_BITS = 22
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

_FOLD = np.arange(256, dtype=np.uint8)
for _b in range(128):
    if not (48 <= _b < 58 or 97 <= _b < 123):
        _FOLD[_b] = 32


def fold(text: str) -> np.ndarray:
    """The folded text as UTF-8 bytes."""
    x = _FOLD[np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)]
    if not len(x):
        return x
    keep = x != 32
    keep[1:] |= x[:-1] != 32          # the first of each run of spaces stays
    x = x[keep]
    lo, hi = int(len(x) > 0 and x[0] == 32), len(x) - int(len(x) > 1 and x[-1] == 32)
    return x[lo:hi]


def grams(x: np.ndarray) -> np.ndarray:
    """A 64-bit code of the q-gram at each position."""
    if len(x) < Q:
        return np.zeros(0, np.uint64)
    eight = np.ndarray((len(x) - 7,), "<u8", np.ascontiguousarray(x).tobytes(), 0, (1,))
    return eight[:len(x) - Q + 1] * _K1 + eight[Q - 8:] * _K2


class Index:
    """The q-grams of a block of items, and each item's budget and bound."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.folded, self.short = [], [], {}
        for item_id, text in items:
            x = fold(text or "")
            if len(x) >= Q:
                self.ids.append(item_id)
                self.folded.append(x)
            elif len(x):
                self.short.setdefault(x.tobytes(), []).append(item_id)
        size = np.array([len(x) for x in self.folded], np.int64)
        self.size = size
        self.budget = np.minimum((BUDGET * size).astype(np.int64), size // Q - 1)
        self.bound = size - Q + 1 - self.budget * Q
        codes = [grams(x) for x in self.folded]
        flat = np.concatenate([*codes, np.zeros(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        self.item = np.repeat(np.arange(len(codes)), [len(c) for c in codes])[order]
        self.at = np.concatenate([*(np.arange(len(c)) for c in codes), np.zeros(0, np.int64)]).astype(np.int64)[order]
        self.codes, self.first, self.many = np.unique(flat[order], return_index=True, return_counts=True)
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.codes >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def hits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in x, entry of self.codes) of the q-grams that some item has."""
        where, entry = [], []
        for lo in range(0, max(0, len(x) - Q + 1), _SLICE):
            code = grams(x[lo:lo + _SLICE + Q - 1])
            at = np.flatnonzero(self.seen[(code >> np.uint64(64 - _BITS)).astype(np.int64)])
            e = np.searchsorted(self.codes, code[at])
            e[e == len(self.codes)] = 0
            good = self.codes[e] == code[at]
            where.append(at[good] + lo)
            entry.append(e[good])
        none = np.zeros(0, np.int64)
        return np.concatenate([*where, none]), np.concatenate([*entry, none])

    def regions(self, where: np.ndarray, entry: np.ndarray) -> list[tuple[int, int]]:
        """(item, band) pairs whose count of shared q-grams reaches the item's bound."""
        many = self.many[entry]
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        e = np.repeat(self.first[entry], many) + within
        item = self.item[e]
        diagonal = np.repeat(where, many) - self.at[e] + self.size[item]      # never negative
        band = diagonal // (self.budget[item] + 1)
        # bands of twice the step overlap, so that one holds any range of k + 1 diagonals
        key = np.concatenate([np.stack([item, band], 1), np.stack([item, band - 1], 1)])
        pairs, counts = np.unique(key, axis=0, return_counts=True)
        return [(int(i), int(b)) for (i, b), n in zip(pairs, counts) if n >= self.bound[i]]

    def verify(self, x: np.ndarray, item: int, band: int) -> int | None:
        """Edits of the item's best alignment near the band, if within the budget."""
        y, k, size = self.folded[item], int(self.budget[item]), int(self.size[item])
        first = band * (k + 1) - size                  # the band's first diagonal
        lo, width = first - k, 2 * (k + 1) + 2 * k + 1  # the alignment may leave it by k on each side
        region = x[max(0, lo):max(0, lo + width + size)]
        if y.tobytes() in region.tobytes():
            return 0
        # cells[d]: edits of the item's start against the text ending at lo + row + d
        padded = np.full(width + size + 1, 0, np.uint8)
        start = max(0, -lo)
        padded[start:start + len(region)] = region[:max(0, len(padded) - start)]
        step = np.arange(width)
        cells = np.zeros(width, np.int64)
        for row in range(size):
            change = cells + (padded[row:row + width] != y[row])
            change[:-1] = np.minimum(change[:-1], cells[1:] + 1)
            cells = np.minimum.accumulate(change - step) + step
        best = int(cells.min())
        return best if best <= k else None

    def search(self, text: str) -> dict[int, int]:
        """item id -> edits of the items that the text contains."""
        x = fold(text)
        found = {i: 0 for i in self.short.get(x.tobytes(), [])} if len(x) < Q else {}
        where, entry = self.hits(x) if len(self.codes) else ([], [])
        return self.confirm(x, where, entry, found)

    def confirm(self, x, where, entry, found: dict) -> dict[int, int]:
        if len(where) and len(where) >= self.bound.min():
            for item, band in self.regions(where, entry):
                edits = self.verify(x, item, band)
                if edits is not None:
                    found[self.ids[item]] = min(edits, found.get(self.ids[item], edits))
        return found

    def search_all(self, batch: list[str]) -> list[dict[int, int]]:
        """search() of a batch, its texts scanned as one array."""
        folded = [fold(t) for t in batch]
        gap = np.zeros(Q, np.uint8)                    # no item's q-gram holds a zero byte
        flat = np.concatenate([p for x in folded for p in (x, gap)] or [gap])
        starts = np.cumsum([0] + [len(x) + Q for x in folded])
        where, entry = self.hits(flat) if len(self.codes) else (np.zeros(0, np.int64),) * 2
        cut = np.searchsorted(where, starts)
        out = []
        for i, x in enumerate(folded):
            found = {j: 0 for j in self.short.get(x.tobytes(), [])} if len(x) < Q else {}
            a, b = cut[i], cut[i + 1]
            out.append(self.confirm(x, where[a:b] - starts[i], entry[a:b], found))
        return out


def _scan(sent):
    def run(batches):
        hold()
        index = Index(sent.value)
        for b in batches:
            found = index.search_all(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), pa.array([sorted(f.items()) for f in found],
                 pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int64())])))],
                ["row", "doc_id", "items"])
    return run


_FOUND = "row long, doc_id long, items array<struct<item_id:long,edits:long>>"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(row, doc_id, items) of every text: the benchmark items that it holds, with their edits.

    ``row`` is the row's monotonically increasing id within ``texts(docs)``.
    """
    rows = texts(docs).withColumn("row", F.monotonically_increasing_id())
    both = None
    for sent in _blocks(benchmark):
        part = rows.mapInArrow(_scan(sent), _FOUND)
        both = part if both is None else both.unionByName(part).groupBy("row", "doc_id").agg(
            F.array_sort(F.flatten(F.collect_list("items"))).alias("items"))
    return both


def _blocks(benchmark: DataFrame) -> list:
    """The items as broadcast blocks of about BLOCK_BYTES: one, unless the table is larger."""
    items = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
             .where("item_id IS NOT NULL AND text IS NOT NULL"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 8), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    send = benchmark.sparkSession.sparkContext.broadcast
    return [send([(r.item_id, r.text) for r in
                  items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()]) for k in range(blocks)]


def _clean(sent):
    def run(batches):
        hold()
        index = Index(sent.value)
        for b in batches:
            found = index.search_all([t or "" for t in b.column("text").to_pylist()])
            yield b.filter(pa.array([not f for f in found], pa.bool_()))
    return run


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    prepare(docs.sparkSession)
    for sent in _blocks(benchmark):
        docs = docs.mapInArrow(_clean(sent), docs.schema)
    return docs
