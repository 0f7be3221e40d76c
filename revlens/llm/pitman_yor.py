"""Language-model scoring by a hierarchical Pitman-Yor model.

Every word and the beginning of a text is a context restaurant; its dishes are the words that
follow, whatever their counts. The restaurants share one parent over all training words, whose
customers are their tables and whose base is uniform over the words and one unseen word.

Seating is sampled by Gibbs sweeps over the numbers of tables: all customers of a dish are taken out
and seated again at once, by drawing their number of tables from its distribution given the other
dishes' tables and the parent (generalised Stirling numbers, exact for parties of up to ``EXACT``;
larger ones sit down in blocks of a thirty-second, within which the odds are held). Shards
draw side by side: what other shards change is seen in the next sweep. After ``BURN`` sweeps,
predictive probabilities are averaged over ``SAMPLES`` sweeps.

Texts are packed into compressed slices once. Slices ask for the words and word pairs that
they hold by hash, shards gather what is asked, count it over the corpus and answer each
slice in the order of its questions, and slices meet their answers to be scored. Pairs are dealt
by context and word together, so no frequent context or word is one shard's alone. Pairs of one
customer have one table for good, so sweeps carry only the others: pair shards send
their further tables to the shards of the words, which add them up, seat the parent and answer
likewise. Nothing but scalars passes the driver, and nothing is broadcast.

What is staged is Parquet in the shared folder, dropped once it is used up (the scores stay for the
caller); shuffle files go with the step that wrote them.

Defined results: a null or empty text is its end token alone; a null ``doc_id`` is learnt
and scored like any; repeated rows are learnt and scored each; without training tokens,
every probability is the uniform base's; an empty table gives no rows.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.session import drop_staged, staging_path

from .common import hold, texts, word_hash

SLICE_BYTES = 16 * 2 ** 20                    # of text
SHARD_BYTES = 6 * 2 ** 20                     # of packed text
BURN, SAMPLES = 2, 3
EXACT = 128                                   # customers whose number of tables is drawn exactly
DISCOUNT, STRENGTH = 0.75, 1.0                # of the context restaurants
PARENT_DISCOUNT, PARENT_STRENGTH = 0.5, 1.0
END = xxhash.xxh64_intdigest(b" end")         # no word holds a space
START = np.uint64(2 ** 64 - 1)                # the beginning of a text, last in the order of contexts
_M = np.uint64(0x9E3779B97F4A7C15)
_P = np.uint64(0xC2B2AE3D27D4EB4F)


def _spread(x: np.ndarray, n: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _M
    return ((x ^ (x >> np.uint64(32))) % np.uint64(n)).astype(np.int64)


def _by_shard(keys: np.ndarray, n: int, *columns):
    """(shard, keys, columns...) of the shards that have keys."""
    shard = _spread(keys.astype(np.uint64), n)
    order = np.argsort(shard, kind="stable")
    found, first = np.unique(shard[order], return_index=True)
    for s, part in zip(found, np.split(order, first[1:])):
        yield int(s), keys[part], *(c[part] for c in columns)


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values in order, place of each value among them)."""
    place, found = pd.factorize(x)
    order = np.argsort(found)
    rank = np.empty(len(found), np.int32)
    rank[order] = np.arange(len(found))
    return found[order], rank[place]


def _batch(rows: list, schema: str) -> pa.RecordBatch:
    """Rows under a DDL schema of longs, binaries, strings and arrays of longs."""
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    fields = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields.types)], schema=fields)


def _table(rows: list, schema: str) -> pa.Table:
    return pa.Table.from_batches([_batch(rows, schema)])


# --- slices -----------------------------------------------------------------

_PACKED = "slice long, ids array<long>, train array<boolean>, sizes array<long>, blob binary"


def _pack(batches):
    part, k, held, size = TaskContext.get().partitionId(), 0, [], 0

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) + k], pa.int64()), pa.array([[h[0] for h in held]], pa.list_(pa.int64())),
             pa.array([[h[1] for h in held]], pa.list_(pa.bool_())),
             pa.array([[len(h[2]) for h in held]], pa.list_(pa.int64())),
             pa.array([zstandard.compress(b"".join(h[2] for h in held), 3)], pa.binary())],
            ["slice", "ids", "train", "sizes", "blob"])

    for b in batches:
        for h in zip(b.column("doc_id").to_pylist(), b.column("train").to_pylist(),
                     b.column("text").cast(pa.binary()).to_pylist()):
            held.append(h)
            size += len(h[2])
            if size >= SLICE_BYTES:
                yield row()
                k, held, size = k + 1, [], 0
    if held:
        yield row()


def _tokens(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct token hashes, each token as a place among them, first token of each text, train flag of
    each token) of a slice."""
    hold(word_hash)
    blob, at, parts = zstandard.decompress(r["blob"]) if sum(r["sizes"]) else b"", 0, []
    for n in r["sizes"]:
        words = blob[at:at + n].lower().split()
        parts.append(np.fromiter(map(word_hash.__getitem__, words), np.uint64, len(words)))
        parts.append(np.array([END], np.uint64))
        at += n
    sizes = np.array([len(parts[i]) + 1 for i in range(0, len(parts), 2)])
    del blob
    joined = np.concatenate(parts)
    del parts
    found, number = _distinct(joined)
    return found, number, np.cumsum(sizes) - sizes, np.repeat(np.array(r["train"], bool), sizes)


def _pairs(found: np.ndarray, number: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, words) of the distinct pairs in order, as places among ``found`` and START, and each
    token's place among them."""
    keys = np.concatenate([[0], number[:-1]]).astype(np.int64)
    keys[starts] = len(found)
    keys *= len(found)
    keys += number
    keys, back = _distinct(keys)
    return keys // len(found), keys % len(found), back


def _small(x: np.ndarray, dtype: str = "<i8") -> bytes:
    """Counts, places and the like: numbers byte by byte, all first bytes before all second ones, so that
    equal high bytes compress to nearly nothing."""
    planes = np.ascontiguousarray(x.astype(dtype)).view(np.uint8).reshape(len(x), -1 if len(x) else 1).T
    return zstandard.compress(np.ascontiguousarray(planes), 1)


def _large(x: bytes, dtype: str = "<i8") -> np.ndarray:
    if not len(x):
        return np.zeros(0, dtype)
    planes = np.frombuffer(zstandard.decompress(x), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


_ASKED = "shard long, slice long, names binary, contexts binary, words binary, counts binary"


def _ask(n: int):
    """What a slice asks of each shard: words (no contexts) and pairs, as places among the names of both,
    with their training counts."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                found, number, starts, train = _tokens(r)
                counts = np.bincount(number[train], minlength=len(found))
                rows = [(s, r["slice"], k.tobytes(), None, None, _small(c)) for s, k, c in _by_shard(found, n, counts)]
                u, w, back = _pairs(found, number, starts)
                counts = np.bincount(back[train], minlength=len(u))
                del back, number, starts, train
                every = np.append(found, START)
                for s, _, x, y, c in _by_shard(every[u] * _P + found[w], n, u, w, counts):
                    named = np.zeros(len(every), bool)
                    named[x] = named[y] = True
                    place = np.cumsum(named, dtype=np.int32) - 1
                    rows.append((s, r["slice"], every[named].tobytes(), _small(np.diff(place[x], prepend=0), "<i4"),
                                 _small(place[y], "<i4"), _small(c)))
                del u, w, counts
                yield _batch(rows, _ASKED)
                pa.default_memory_pool().release_unused()
    return run


_GATHERED = ("shard long, word_slices array<long>, word_sizes array<long>, word_back binary, word_counts binary, "
             "n long, v long, slices array<long>, sizes array<long>, steps binary, names binary, "
             "parts array<long>, u binary, w binary, counts binary")


def _gather(n: int):
    """All that slices ask of a shard, as one row. Words: the place of each asked one among the distinct,
    and the corpus counts of these. Pairs: distinct ones as places ``u`` and ``w`` in the shard's
    ``names``, which stand by word shard (``parts`` of them each); a slice's pairs are in order, so
    ``steps`` between their places are small."""
    def run(key, group):
        rows = list(zip(*(group.column(c).to_pylist() for c in ("slice", "names", "contexts", "words", "counts"))))
        words, asked = (sorted((r for r in rows if (r[2] is None) == lone), key=lambda r: r[0]) for lone in (True, False))
        joined = lambda x: np.concatenate([np.zeros(0, np.int64), *(_large(r[4]) for r in x)])
        found, word_back = _distinct(np.frombuffer(b"".join(r[1] for r in words), "<u8"))
        word_counts = np.bincount(word_back, joined(words), len(found)).astype(np.int64)

        named = [np.frombuffer(r[1], "<u8") for r in asked]
        none, counts = np.zeros(0, np.uint64), joined(asked)
        u = np.concatenate([none, *(x[np.cumsum(_large(r[2], "<i4"))] for x, r in zip(named, asked))])
        w = np.concatenate([none, *(x[_large(r[3], "<i4")] for x, r in zip(named, asked))])
        sizes = [len(_large(r[4])) for r in asked]
        order = np.lexsort((w, u))
        new = np.append(True, (np.diff(u[order]) != 0) | (np.diff(w[order]) != 0))[:len(u)]
        back = np.empty(len(u), np.int64)
        back[order] = np.cumsum(new) - 1
        names, place = _distinct(np.concatenate([u[order][new], w[order][new]]))
        shard = _spread(names, n)
        by_shard = np.argsort(shard, kind="stable")
        at = np.empty(len(names), np.int64)
        at[by_shard] = np.arange(len(names))
        place = at[place]
        half = len(place) // 2
        return _table([(
            key[0].as_py(), [r[0] for r in words], [len(r[1]) // 8 for r in words], _small(word_back, "<i4"),
            _small(word_counts), int(word_counts.sum()), int((word_counts > 0).sum()),
            [r[0] for r in asked], sizes, _small(np.diff(back, prepend=0), "<i4"),
            names[by_shard].tobytes(), np.bincount(shard, minlength=n).tolist(), _small(place[:half], "<i4"),
            _small(place[half:], "<i4"), _small(np.bincount(back, counts, half)))], _GATHERED)
    return run


_ANSWERS = "slice long, shard long, kind string, answer binary"


def _answers(kind: str, shard: int, slices: list, sizes: list, values: np.ndarray, dtype: str) -> list:
    """An answer to each slice of a gathered row, in the order of its questions."""
    ends = np.cumsum(sizes)
    return [(s, shard, kind, _small(values[e - n:e], dtype)) for s, e, n in zip(slices, ends, sizes)]


def _answer_words(batches):
    """To each slice: count of each word that it asked for."""
    for b in batches:
        for r in b.to_pylist():
            counts = _large(r["word_counts"])[_large(r["word_back"], "<i4")]
            yield _batch(_answers("words", r["shard"], r["word_slices"], r["word_sizes"], counts, "<i8"), _ANSWERS)


# --- restaurants ------------------------------------------------------------


def _stirling(discount: float) -> np.ndarray:
    """log S(c, t): the weight of c customers at t tables, for all c up to EXACT."""
    t = np.arange(EXACT + 1)
    s = np.full((EXACT + 1, EXACT + 1), -np.inf)
    s[1, 1] = 0
    for c in range(1, EXACT):
        # the next customer joins a table or opens one
        s[c + 1, 1:] = np.logaddexp(s[c, 1:] + np.log(np.maximum(c - discount * t[1:], 1e-300)), s[c, :-1])
    return s


_LOG_S = {d: _stirling(d) for d in (DISCOUNT, PARENT_DISCOUNT)}


def seat(customers: np.ndarray, mass: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables of each dish when its customers sit down one after another: the next opens a
    table with odds mass : (seated - discount * tables). Large parties sit down in blocks
    of a thirty-second of those seated, within which the odds are held."""
    tables, seated = np.minimum(customers, 1), np.minimum(customers, 1)
    at = np.flatnonzero(customers > 1)
    while len(at):
        i, t, a = seated[at], tables[at], mass[at]
        block = np.minimum(customers[at] - i, np.maximum(1, i // 32))
        tables[at] = t + rng.binomial(block, a / (a + i - discount * t))
        seated[at] = i + block
        at = at[seated[at] < customers[at]]
    return tables


def reseat(customers: np.ndarray, p: np.ndarray, others: np.ndarray, discount: float, strength: float, rng) -> np.ndarray:
    """A Gibbs draw of each dish's number of tables, given the restaurant's tables of ``others`` dishes and
    the parent's probability ``p`` of the dish: t tables have weight S(c, t) times, for each
    table, p and its odds of being opened, strength + discount * (tables before it)."""
    out = np.minimum(customers, 1)
    order = np.argsort(customers, kind="stable")
    sizes, first = np.unique(customers[order], return_index=True)
    for c, members in zip(sizes.tolist(), np.split(order, first[1:])):
        if c < 2:
            continue
        if c > EXACT:
            members = order[first[np.searchsorted(sizes, c)]:]
            out[members] = seat(customers[members], (strength + discount * others[members]) * p[members], discount, rng)
            break
        before, log_s = np.arange(c), _LOG_S[discount][c, 1:c + 1]
        for lo in range(0, len(members), 1 + 1_000_000 // c):
            i = members[lo:lo + 1 + 1_000_000 // c]
            like = np.log((strength + discount * (others[i][:, None] + before)) * p[i][:, None]).cumsum(1) + log_s
            mass = np.exp(like - like.max(1, keepdims=True)).cumsum(1)
            out[i] = 1 + (mass < (rng.random(len(i)) * mass[:, -1])[:, None]).sum(1)
    return out


def _rng(*parts: int):
    return np.random.default_rng([7, *(abs(int(p)) for p in parts)])


def _parts(r: dict):
    """(word shard, its names' places) of a pair shard."""
    ends = np.cumsum(r["parts"])
    return [(s, slice(e - n, e)) for s, (e, n) in enumerate(zip(ends, r["parts"])) if n]


_NAMED = "shard long, source long, keys binary, customers binary, dishes binary, contexts binary"


def _name(batches):
    """To each word shard: a pair shard's names, their customers there as contexts, and their tables as dishes
    and as contexts while each pair has one table."""
    for b in batches:
        for r in b.to_pylist():
            names, u, w, counts = np.frombuffer(r["names"], "<i8"), _large(r["u"], "<i4"), _large(r["w"], "<i4"), _large(r["counts"])
            one, size = counts > 0, len(names)
            all_of = np.bincount(u, counts, size), np.bincount(w[one], minlength=size), np.bincount(u[one], minlength=size)
            yield _batch([(s, r["shard"], names[i].tobytes(), *(_small(x[i]) for x in all_of)) for s, i in _parts(r)], _NAMED)


_TYPES = "shard long, sources array<long>, sizes array<long>, back binary, customers binary, dishes binary, contexts binary"


def _types(key, group):
    """A word shard's words as places of what pair shards name, and their sums over these."""
    named = sorted(zip(*(group.column(c).to_pylist() for c in ("source", "keys", "customers", "dishes", "contexts"))))
    found, back = _distinct(np.frombuffer(b"".join(x[1] for x in named), "<i8"))
    sums = [np.bincount(back, np.concatenate([_large(x[i]) for x in named]), len(found)) for i in (2, 3, 4)]
    return _table([(key[0].as_py(), [x[0] for x in named], [len(x[1]) // 8 for x in named], _small(back, "<i4"),
                    *map(_small, sums))], _TYPES)


_REPLIES = ("shard long, sweep long, part long, dishes binary, own binary, contexts binary, customers binary, "
            "all_dishes long, all_own long")


def _replies(r: dict, sweep: int, dishes, own, contexts, customers=None) -> list:
    """To each pair shard, in the order of its names: tables as dish, the parent's tables of it, tables
    as context. The sums over the word shard's words stand in the first row."""
    back, rows, at = _large(r["back"], "<i4"), [], 0
    sums = int(dishes.sum()), int(own.sum())
    for source, n in zip(r["sources"], r["sizes"]):
        i = back[at:at + n]
        rows.append((source, sweep, r["shard"], _small(dishes[i]), _small(own[i]), _small(contexts[i]),
                     b"" if customers is None else _small(customers[i]), *(sums if not at else (0, 0))))
        at += n
    return rows


def _first_replies(batches):
    """Before the first sweep every pair, and every word at the parent, has one table."""
    for b in batches:
        for r in b.to_pylist():
            dishes = _large(r["dishes"])
            yield _batch(_replies(r, -1, dishes, np.minimum(dishes, 1), _large(r["contexts"]), _large(r["customers"])), _REPLIES)


class _State:
    """What a pair shard is told of its names: the customers of each as a context, and after each sweep
    the parent's predictive probability and the number of tables as a context."""

    def __init__(self, replies: list[dict], types: int, sums: dict):
        self.types, self.sums, self.by, self.seated = types, sums, {}, {}
        for a in sorted(replies, key=lambda a: a["part"]):
            if a["part"] < 0:                 # the shard's own tables, of pairs with several customers
                self.seated[a["sweep"]] = _large(a["dishes"])
            else:
                self.by.setdefault(a["sweep"], []).append(a)

    def vector(self, sweep: int, column: str) -> np.ndarray:
        return np.concatenate([_large(a[column]) for a in self.by[sweep]])

    def after(self, sweep: int) -> tuple[np.ndarray, np.ndarray]:
        dishes, own = self.sums[sweep]
        parent = ((self.vector(sweep, "dishes") - PARENT_DISCOUNT * self.vector(sweep, "own")
                   + (PARENT_STRENGTH + PARENT_DISCOUNT * own) / (self.types + 1)) / (PARENT_STRENGTH + dishes))
        return parent, self.vector(sweep, "contexts")


_MULTIPLE = "shard long, parts array<long>, u binary, w binary, counts binary"


def _multiple(batches):
    """A shard's pairs of several customers."""
    for b in batches:
        for r in b.to_pylist():
            counts = _large(r["counts"])
            at = np.flatnonzero(counts > 1)
            yield _batch([(r["shard"], r["parts"], *(_small(_large(r[c], "<i4")[at], "<i4") for c in ("u", "w")),
                           _small(counts[at]))], _MULTIPLE)


_TABLES = "shard long, source long, dishes binary, contexts binary"


def _sweep(sweep: int, types: int, sums: dict):
    """To each word shard: a pair shard's tables beyond one a pair, by dish and by context; and, with source
    -1, the shard's tables for its next sweep."""
    def run(key, pairs, replies):
        state, rows = _State(replies.to_pylist(), types, sums), []
        for r in pairs.to_pylist():
            u, w, counts = _large(r["u"], "<i4"), _large(r["w"], "<i4"), _large(r["counts"])
            parent, tables = state.after(sweep - 1)
            others = tables[u] - state.seated.get(sweep - 1, np.ones(len(u), np.int64))
            t = reseat(counts, parent[w], others, DISCOUNT, STRENGTH, _rng(r["shard"], sweep))
            dishes, contexts = np.bincount(w, t - 1, len(parent)), np.bincount(u, t - 1, len(parent))
            rows += [(s, r["shard"], _small(dishes[i]), _small(contexts[i])) for s, i in _parts(r)]
            rows.append((r["shard"], -1, _small(t), b""))
        return _table(rows, _TABLES)
    return run


def _parent(sweep: int, types: int, own_tables: int):
    """Tables of a word shard's words over all pair shards, and the parent's tables of them."""
    def run(key, words, tables):
        r = words.to_pylist()[0]
        sent = sorted(zip(*(tables.column(c).to_pylist() for c in ("source", "dishes", "contexts"))))
        back = _large(r["back"], "<i4")
        dishes, contexts = (_large(r[c]) + np.bincount(back, np.concatenate([_large(x[i]) for x in sent]), len(_large(r[c])))
                            .astype(np.int64) for i, c in ((1, "dishes"), (2, "contexts")))
        # every training word is a dish of the parent, whose other tables are as they were
        own = reseat(dishes, np.full(len(dishes), 1 / (types + 1)), np.full(len(dishes), max(0, own_tables - 1)),
                     PARENT_DISCOUNT, PARENT_STRENGTH, _rng(r["shard"], sweep, 1))
        return _table(_replies(r, sweep, dishes, own, contexts), _REPLIES)
    return run


def _answer_pairs(types: int, sums: dict):
    """To each slice: log10 P(word | context) of each pair that it asked for, rounded to single precision."""
    def run(key, pairs, replies):
        state, rows = _State(replies.to_pylist(), types, sums), []
        for r in pairs.to_pylist():
            u, w, c = _large(r["u"], "<i4"), _large(r["w"], "<i4"), _large(r["counts"])
            t, p = np.minimum(c, 1), np.zeros(len(u))
            for sweep in range(BURN, BURN + SAMPLES):
                t[c > 1] = state.seated[sweep]
                parent, tables = state.after(sweep)
                p += ((STRENGTH + DISCOUNT * tables[u]) * parent[w] + c - DISCOUNT * t) / SAMPLES
            p = np.log10(p / (STRENGTH + state.vector(-1, "customers")[u]))
            del t, u, w, c
            places = np.cumsum(_large(r["steps"], "<i4"), dtype=np.int64)
            rows += _answers("pairs", r["shard"], r["slices"], r["sizes"], p[places], "<f4")
        return _table(rows, _ANSWERS)
    return run


_SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _score(n_shards: int, n: int, v: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])

    def run(key, packed, answers):
        held = {(a["kind"], a["shard"]): a["answer"] for a in answers.to_pylist()}
        del answers
        pa.default_memory_pool().release_unused()
        out = []

        def answered(kind: str, keys: np.ndarray, dtype: str):
            """The answers to a slice's distinct words or pairs, in their order."""
            got = np.zeros(len(keys), dtype)
            for shard, _, at in _by_shard(keys, n_shards, np.arange(len(keys))):
                got[at] = _large(held[kind, shard], dtype)
            return got

        for r in packed.to_pylist():
            found, number, starts, _ = _tokens(r)
            c = answered("words", found, "<i8")
            u, w, back = _pairs(found, number, starts)
            score = answered("pairs", np.append(found, START)[u] * _P + found[w], "<f4").astype(np.float64)[back]
            del u, w, back
            base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
            total = lambda x: np.add.reduceat(x, starts)
            out.append(pa.table([pa.array(r["ids"], pa.int64()), pa.array(total(np.ones(len(number), np.int64))),
                                 pa.array(total((c > 0).astype(np.int64)[number])), pa.array(total(base[number])),
                                 pa.array(total(score))], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()
    return run


class _Staged:
    """Tables in the shared folder, until they are dropped."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it again."""
        path = staging_path(self.spark, f"pitman-yor-{name}")
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = out, path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            drop_staged(self.spark, self.paths.pop(id(df))[1])


@contextmanager
def _staging(spark: SparkSession):
    """Staged tables, whose shuffle files are dropped with the step that wrote them; a failure drops all."""
    conf, held = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", _Staged(spark)
    was = spark.conf.get(conf, None)
    spark.conf.set(conf, "true")
    try:
        yield held
    except BaseException:
        held.drop(*(df for df, _ in list(held.paths.values())))
        raise
    finally:
        spark.conf.unset(conf) if was is None else spark.conf.set(conf, was)


def score(docs: DataFrame, train: Column) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score); ``train`` marks the
    texts to learn from, as a column over ``doc_id``."""
    with _staging(docs.sparkSession) as held:
        return _scored(docs, train, held)


def _scored(docs: DataFrame, train: Column, held: _Staged) -> DataFrame:
    kept = held.keep
    packed = kept(texts(docs).withColumn("train", train).mapInArrow(_pack, _PACKED), "slices")
    size = packed.agg(F.coalesce(F.sum(F.length("blob")), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD_BYTES))

    # each shard's row has its words and its pairs
    gathered = kept(packed.mapInArrow(_ask(shards), _ASKED).groupBy("shard").applyInArrow(_gather(shards), _GATHERED), "shards")
    n, v = gathered.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    word_answers = (gathered.select("shard", "word_slices", "word_sizes", "word_back", "word_counts")
                    .mapInArrow(_answer_words, _ANSWERS))
    types = kept(gathered.select("shard", "names", "parts", "u", "w", "counts").mapInArrow(_name, _NAMED)
                 .groupBy("shard").applyInArrow(_types, _TYPES), "words")
    several = kept(gathered.select("shard", "parts", "u", "w", "counts").mapInArrow(_multiple, _MULTIPLE), "pairs")

    totals = lambda df: tuple(df.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("all_dishes", "all_own")]).first())
    first = now = kept(types.mapInArrow(_first_replies, _REPLIES), "replies")
    sums, told, used = {-1: totals(first)}, first, [first]
    before: list = []                         # what only the next sweep reads
    for sweep in range(BURN + SAMPLES):
        tables = kept(several.groupBy("shard").cogroup(now.groupBy("shard"))
                      .applyInArrow(_sweep(sweep, v, dict(sums)), _TABLES), "tables")
        held.drop(*before)
        replies = kept(types.groupBy("shard").cogroup(tables.where("source >= 0").groupBy("shard"))
                       .applyInArrow(_parent(sweep, v, sums[sweep - 1][1]), _REPLIES), "replies")
        sums[sweep] = totals(replies)
        none, zero = F.lit(b""), F.lit(0).cast("long")
        seated = kept(tables.where("source < 0").select(
            "shard", F.lit(sweep).cast("long").alias("sweep"), F.col("source").alias("part"), "dishes", none.alias("own"),
            none.alias("contexts"), none.alias("customers"), zero.alias("all_dishes"), zero.alias("all_own")), "seated")
        held.drop(tables)
        now = replies.unionByName(seated)
        if sweep >= BURN:
            told, before = told.unionByName(now), []
            used += [replies, seated]
        else:
            before = [replies, seated]
    held.drop(several, types)
    answers = kept(gathered.select("shard", "slices", "sizes", "steps", "u", "w", "counts").groupBy("shard")
                   .cogroup(told.groupBy("shard")).applyInArrow(_answer_pairs(v, sums), _ANSWERS).unionByName(word_answers), "answers")
    held.drop(gathered, *used)
    scored = kept(packed.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_score(shards, n, v), _SCORED), "scores")
    held.drop(packed, answers)
    return scored.select("doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                         "base_score", "score")
