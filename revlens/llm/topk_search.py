"""Exact top-k search by inner product: tiled matrix products, a partial
selection in every tile, and a tree of merges of the per-query top lists.

Vectors are dealt into shards of at most about ``SHARD_ROWS`` rows and ``SHARD_BYTES``
by a hash of the row and queries into blocks of about ``BLOCK_ROWS``; each (block, shard)
tile is one row of a join on the shard number, so a task holds one block and one shard
whatever the table's size, and nothing is broadcast. Equal rows are counted first: a list
of k can hold at most k of them beside the query itself, so k + 1 stand for all, and a
query's list is put out once for each of its copies.

Defined results: a vector that is null, or holds a null or non-finite component,
takes no part; a null id takes no part; rows that repeat an id are rows of their own,
as queries and as each other's candidates (vectors under one id are told apart by 64 bits);
vectors of other lengths than the query's aren't its candidates; an empty table gives no
rows. Scores beyond the range of a long are held at its ends.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

SHARD_ROWS = 16_384
SHARD_BYTES = 64 * 2 ** 20
BLOCK_ROWS = 2_048
FAN_IN = 64          # tiles whose lists meet in one merge
_STEP = 256          # queries multiplied at once inside a tile
_EXACT = float(2 ** 53)
_LONG = 2 ** 63 - 1


def _usable(vec):
    return vec.isNotNull() & F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def _pack(key, group):
    """One group of vectors as rows (part, width, ids, marks, times, matrix), a row per width."""
    columns = {c: group.column(c).to_numpy() for c in ("id", "mark", "times")}
    vectors = group.column("vec").combine_chunks()
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    widths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    starts = np.cumsum(widths) - widths
    out = {c: [] for c in ("part", "width", "ids", "marks", "times", "matrix")}
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        at = at[np.lexsort((columns["mark"][at], columns["id"][at]))]
        m = np.floor(256.0 * values[starts[at][:, None] + np.arange(w)])
        out["part"].append(key[0].as_py())
        out["width"].append(int(w))
        for name, c in (("ids", "id"), ("marks", "mark"), ("times", "times")):
            out[name].append(columns[c][at].astype("<i8").tobytes())
        out["matrix"].append(m.astype("<f8").tobytes())
    return pa.table(out, schema=pa.schema(
        [("part", pa.int64()), ("width", pa.int32())] + [(c, pa.binary()) for c in ("ids", "marks", "times", "matrix")]))


def _packed(vectors: DataFrame, parts: int) -> DataFrame:
    """All copies of a row share a part: a query meets its own row in one tile only."""
    return (vectors.withColumn("part", F.pmod(F.xxhash64("id", "mark"), F.lit(parts)))
            .groupBy("part")
            .applyInArrow(_pack, "part long, width int, ids binary, marks binary, times binary, matrix binary"))


def _products(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Integer inner products; float64 where that is exact, big integers elsewhere."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(m).max(initial=0)) * max(1, q.shape[1])
    if most < _EXACT:
        return q @ m.T
    big = lambda a: np.array([[int(x) for x in r] for r in a], dtype=object).reshape(a.shape)
    wide = big(q).dot(big(m).T) if q.shape[1] else np.zeros((len(q), len(m)), dtype=object)
    return np.clip(wide, -_LONG, _LONG)


def _select(scores: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k highest scores of a row; ties go to the smaller column."""
    scores = np.delete(scores, own) if len(own) else scores
    cols = np.delete(np.arange(len(scores) + len(own)), own) if len(own) else np.arange(len(scores))
    if len(scores) > k and scores.dtype != object:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        at = np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])
    else:
        at = np.arange(len(scores))
    return cols[sorted(at, key=lambda i: (-scores[i], i))[:k]]


_FOUND = "query_id long, mark long, times long, node long, score long, vec_id long"


def _tile(k: int):
    out = pa.schema([(c.split()[0], pa.int64()) for c in _FOUND.split(", ")])

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                w = r["width"]
                q_ids, q_marks, times, ids, marks = (
                    np.frombuffer(r[c], "<i8") for c in ("q_ids", "q_marks", "q_times", "ids", "marks"))
                q = np.frombuffer(r["q_matrix"], "<f8").reshape(len(q_ids), w)
                m = np.frombuffer(r["matrix"], "<f8").reshape(len(ids), w)
                for lo in range(0, len(q_ids), _STEP):
                    scores = _products(q[lo:lo + _STEP], m)
                    rows = []
                    for i, (qid, mark, n) in enumerate(zip(q_ids[lo:lo + _STEP], q_marks[lo:], times[lo:])):
                        a, b = np.searchsorted(ids, qid), np.searchsorted(ids, qid, "right")
                        own = a + np.flatnonzero(marks[a:b] == mark)[:1]
                        rows += [(int(qid), int(mark), int(n), r["part"], int(scores[i, c]), int(ids[c]))
                                 for c in _select(scores[i], own, k)]
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)
    return run


def top_k(vectors: DataFrame, id_col: str, vec_col: str, is_query, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query row against all other rows.

    ``is_query`` is a column expression over ``id`` that marks the queries.
    """
    prepare(vectors.sparkSession)
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"),
                           F.col(vec_col).cast("array<double>").alias("vec"))
            .where(F.col("id").isNotNull() & _usable(F.col("vec")))
            .groupBy("id", "vec").agg(F.count("*").alias("times"))
            .withColumn("mark", F.xxhash64("vec")))
    n, size, n_q = rows.agg(F.sum(F.least("times", F.lit(k + 1))), F.sum(F.least("times", F.lit(k + 1)) * F.size("vec") * 8),
                            F.count_if(is_query)).first()
    shards = max(1, -(-(n or 0) // SHARD_ROWS), -(-(size or 0) // SHARD_BYTES))
    blocks = max(1, -(-n_q // BLOCK_ROWS))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.least("times", F.lit(k + 1))))
    held = _packed(rows.withColumn("copy", copies).drop("copy"), shards).drop("times")
    asked = (_packed(rows.where(is_query), blocks)
             .select("width", *[F.col(c).alias(f"q_{c}") for c in ("ids", "marks", "times", "matrix")],
                     F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("part")))
    tiles = held.join(asked, ["part", "width"])
    found = tiles.mapInArrow(_tile(k), _FOUND)
    query = ("query_id", "mark", "times")
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id"))), 1, k)
    while shards > FAN_IN:
        shards = -(-shards // FAN_IN)
        found = (found.groupBy(*query, F.expr(f"node div {FAN_IN}").alias("node"))
                 .agg(best.alias("top")).select(*query, "node", F.explode("top").alias("t"))
                 .select(*query, "node", (-F.col("t.less")).alias("score"), "t.vec_id"))
    return (found.groupBy(*query).agg(best.alias("top"))
            .select("query_id", "top", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
            .select("query_id", F.posexplode("top").alias("at", "t"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "t.vec_id",
                    (-F.col("t.less")).alias("score")))
