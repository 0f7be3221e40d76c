"""Near-duplicates by SimHash, linked through covering locality-sensitive hashing.

A text's fingerprint has bit i set if over half of its four-word shingles' 64-bit hashes
have it set. Fingerprints that differ in at most ``RADIUS`` bits are linked.

Candidates come from a covering family of bit masks. Every bit position gets a non-zero
vector of RADIUS + 1 bits; the mask of a non-zero vector v keeps the positions whose vector
has an odd product with v. The vectors of at most RADIUS differing positions never span the
whole space, so some v is orthogonal to them all: its mask keeps none of the differing
positions, and the two fingerprints are equal under it. No pair is missed.

Copies of a fingerprint are one node. A bucket (mask, kept bits) is never expanded into
pairs: within it a search from member to member yields a spanning forest of its links, at
most one edge a member. A bucket of over ``FULL`` members is dealt anew by a covering family
over the bits that its mask leaves free, which holds for the same reason; that leaves at most
17 free bits, so no bucket of the second dealing can hold over 2^17 fingerprints.

Defined results: texts are lower-cased A-Z; a null, empty or blank text has fingerprint zero
and is linked like any other; fewer than four words are one shingle; rows that repeat a
``doc_id`` are fingerprinted each, and each row gets the component of its own text; a null
``doc_id`` takes part, but is never a component's least id (null if it has no other); an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, texts
from .near_dedup import components

WORDS, SEED, BITS = 4, 42, 64
RADIUS = 4
FULL = 8192            # members of a bucket that are compared in one go
CHUNK = 1 << 16        # hashes turned into bits at once


def fingerprint(text: bytes) -> int:
    """The 64-bit fingerprint of a UTF-8 text."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = min(WORDS, len(words)) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - last].tolist()
    ends = ends[last:].tolist()
    ones, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for lo in range(0, len(starts), CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[lo:lo + CHUNK], ends[lo:lo + CHUNK])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def covering(positions: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over ``positions``: any ``radius`` of them are all left out by one mask at least."""
    top = 2 ** (radius + 1)
    vector = {p: 1 + i % (top - 1) for i, p in enumerate(positions)}
    return [sum(1 << p for p, u in vector.items() if (u & v).bit_count() % 2) for v in range(1, top)]


def _signed(mask: int) -> int:
    return mask - 2 ** BITS if mask >= 2 ** (BITS - 1) else mask


MASKS = covering([*range(BITS)])
_INNER = [covering([p for p in range(BITS) if not mask >> p & 1]) for mask in MASKS]


def forest(members: np.ndarray, radius: int = RADIUS) -> list[tuple[np.ndarray, np.uint64]]:
    """A spanning forest of the links among distinct fingerprints: (children, their parent)."""
    edges, left = [], members
    while len(left) > 1:
        queue, left = [left[:1]], left[1:]
        while queue and len(left):
            for x in queue.pop():
                near = np.bitwise_count(left ^ x) <= radius
                if near.any():
                    edges.append((left[near], x))
                    queue.append(left[near])
                    left = left[~near]
                    if not len(left):
                        break
    return edges


def _fingerprints(batches):
    for b in batches:
        got = np.array([fingerprint(t) for t in b.column("text").cast(pa.binary()).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(got.view(np.int64))], ["doc_id", "fp"])


def _edges(a: list, b: list):
    a, b = np.concatenate([*a, np.zeros(0, np.uint64)]), np.concatenate([*b, np.zeros(0, np.uint64)])
    for lo in range(0, len(a), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[lo:lo + 100_000].view(np.int64)) for x in (a, b)], ["a", "b"])


def _linked(batches):
    """Sorted rows (mask, inner, key, fp) in, a spanning forest of each bucket's links out. What is
    held is the rows of one batch and the bucket that reaches over its end."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        now = np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("mask", "inner", "key", "fp")])
        held = now if held is None else np.concatenate([held, now], 1)
        cut = int(np.flatnonzero((held[:3] != held[:3, -1:]).any(0)).max(initial=-1)) + 1
        if cut:
            yield from _forests(held[:, :cut])
            held = held[:, cut:]
    if held is not None:
        yield from _forests(held)


def _forests(rows: np.ndarray):
    starts = np.flatnonzero(np.concatenate([[True], (rows[:3, 1:] != rows[:3, :-1]).any(0)]))
    sizes = np.diff(np.append(starts, rows.shape[1]))
    fps = rows[3].view(np.uint64)
    two = starts[sizes == 2]                                     # most buckets: all at once
    two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= RADIUS]
    a, b = [fps[two]], [fps[two + 1]]
    for at, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        for children, parent in forest(fps[at:at + n]):
            a.append(children)
            b.append(np.full(len(children), parent))
    yield from _edges(a, b)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row."""
    return texts(docs).mapInArrow(_fingerprints, "doc_id long, fp long")


def _masked(masks: list[int]) -> Column:
    return F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])


def _forests_of(buckets: DataFrame) -> DataFrame:
    return (buckets.repartition("mask", "inner", "key").sortWithinPartitions("mask", "inner", "key")
            .select("mask", "inner", "key", "fp").mapInArrow(_linked, "a long, b long"))


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): a spanning forest of the links among the distinct fingerprints ``fp``, of each bucket."""
    dealt = nodes.select("fp", F.posexplode(_masked(MASKS)).alias("mask", "key"))
    sized = dealt.groupBy("mask", "key").agg(F.count("*").alias("members")).where("members > 1")
    shared = staged(dealt.join(sized, ["mask", "key"]).withColumn("inner", F.lit(-1)))
    inner = F.array(*[F.array(*[F.lit(_signed(m)) for m in masks]) for masks in _INNER])
    again = (shared.where(F.col("members") > FULL)
             .select("mask", F.posexplode(inner[F.col("mask")]).alias("inner", "kept"), "fp")
             .select("mask", "inner", F.col("fp").bitwiseAND(F.col("kept")).alias("key"), "fp"))
    return _forests_of(shared.where(F.col("members") <= FULL)).unionByName(_forests_of(again))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; the fingerprint is 16 lowercase hex digits."""
    made = staged(fingerprints(docs))
    nodes = staged(made.groupBy("fp").agg(F.min("doc_id").alias("least")))
    comps = staged(components(links(nodes.select("fp"))))
    linked = nodes.join(comps, nodes["fp"] == comps["node"], "left")
    linked = linked.select("fp", "least", "comp")
    # the component of a linked fingerprint, itself not among the nodes that hang below another
    inside = linked.where("comp IS NOT NULL")
    roots = comps.select("comp").distinct().join(nodes, F.col("comp") == F.col("fp")).select("fp", "least", "comp")
    inside = inside.unionByName(roots)
    of_comp = inside.groupBy("comp").agg(F.min("least").alias("component_id"))
    reached = (inside.select("fp", "comp").join(of_comp, "comp").select("fp", "component_id")
               .unionByName(linked.where("comp IS NULL").join(roots.select("fp"), "fp", "left_anti")
                            .select("fp", F.col("least").alias("component_id"))))
    return made.join(reached, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
