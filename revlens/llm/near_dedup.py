"""Near-duplicates by SetSketch registers.

Every document's set of five-word shingles gets ``REGISTERS`` registers: the least of
exponentially distributed hashes, truncated to powers of ``BASE``. Registers of unions are
maxima of registers, and equal registers are as likely as sets are alike. Bands of
``ROWS`` registers find candidates; the joint likelihood of two sketches (with their known
sizes) gives an estimate that drops pairs far below the threshold; the rest are verified
on full sets read from the texts.

Copies are classes of one representative. A bucket is never expanded into pairs, and no pairs
leave it. First every member is tried against one pivot, the bucket's least id, and links are
closed to components. Then only buckets that still hold several components are looked at:
members outside the bucket's largest component meet all others in blocks of bounded size. A
first pass over sketches leaves the members that have a likely partner in another component;
those bring their shingle sets, and pairs are verified in place, each in the first bucket that
its members share. A block puts out at most one link for each component that it joins.

Defined results: texts are lower-cased A-Z; null and empty texts have an empty set, linked
with nothing; fewer than five words are one shingle; rows that repeat a ``doc_id`` are judged
by their own text: one row for each distinct set of an id; a null ``doc_id`` stands for itself:
component null, kept; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hold, prepare, staged, texts, word_hash

WORDS = 5
REGISTERS, ROWS = 128, 4
BASE = 1.02
LIKELY = 0.6           # about four standard errors of the estimate below 0.75
SHARE = 75             # per cent of the union
BLOCK = 256            # members of a mixed bucket compared at once
WIDE = 4096
BROADCAST_IDS = 250_000
_rng = np.random.default_rng(20_011)
_MUL = _rng.integers(1, 2 ** 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2 ** 63, REGISTERS, dtype=np.uint64)
_P = np.uint64(0x9E3779B185EBCA87)
_LOG = float(np.log(BASE))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: bytes) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    x = np.fromiter(map(word_hash.__getitem__, words), np.uint64, len(words))
    if len(x) < WORDS:
        got = np.array([len(x)], np.uint64)
        for w in x:
            got = _mix(got * _P + w)
        return got
    n = len(x) - WORDS + 1
    got = x[:n]
    for i in range(1, WORDS):
        got = got * _P + x[i:i + n]
    return np.unique(_mix(got))


def digest_of(elements: np.ndarray) -> bytes | None:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest() if len(elements) else None


def sketch(elements: np.ndarray) -> np.ndarray:
    """SetSketch registers of a non-empty set."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(elements), 2048):
        h = elements[lo:lo + 2048, None] * _MUL + _ADD
        h ^= h >> np.uint64(32)
        np.minimum(least, (h * _P).min(0), out=least)
    u = (least.astype(np.float64) + 1.0) / 2.0 ** 64
    exponential = -np.log1p(-np.minimum(u, 1 - 1e-12))
    return np.clip(np.floor(1.0 - np.log(exponential) / _LOG), 0, 65_535).astype("<u2")


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One signed 64-bit key for each band of each row of registers."""
    x = registers.reshape(len(registers), -1, ROWS).astype(np.uint64)
    got = np.arange(1, x.shape[1] + 1, dtype=np.uint64)[None, :] * _P
    for i in range(ROWS):
        got = _mix(got * _P + x[:, :, i])
    return got.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The similarity of greatest likelihood for each pair of sketches (rows)."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u = n_a / (n_a + n_b)
    v = 1 - u
    top = np.minimum(u / v, v / u)
    grid = np.linspace(0, 1, 81)[None, :] * top[:, None]
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / _LOG
    p_more, p_less = p(u[:, None] - v[:, None] * grid), p(v[:, None] - u[:, None] * grid)
    ln = lambda x: np.log(np.maximum(x, 1e-9))
    like = more[:, None] * ln(p_more) + less[:, None] * ln(p_less) + same[:, None] * ln(1 - p_more - p_less)
    return grid[np.arange(len(grid)), like.argmax(1)]


def _likely(a, b, n_a, n_b) -> np.ndarray:
    ok = 100 * np.minimum(n_a, n_b) >= SHARE * np.maximum(n_a, n_b)
    if ok.any():
        ok[ok] = estimate(a[ok], b[ok], n_a[ok].astype(float), n_b[ok].astype(float)) >= LIKELY
    return ok


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, REGISTERS)


def _sketched(batches):
    hold(word_hash)
    for b in batches:
        n, digest, regs = [], [], []
        for t in b.column("text").cast(pa.binary()).to_pylist():
            s = shingles(t)
            n.append(len(s))
            digest.append(digest_of(s))
            regs.append(sketch(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(regs, pa.binary())],
            ["doc_id", "n", "digest", "regs"])


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, digest, regs) of every text."""
    return texts(docs).mapInArrow(_sketched, "doc_id long, n long, digest binary, regs binary")


def _banded(batches):
    for b in batches:
        keys = band_keys(_matrix(b.column("regs")))
        yield pa.RecordBatch.from_arrays(
            [b.column("rep"), pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), keys.shape[1])
             .cast(pa.list_(pa.int64()))], ["rep", "keys"])


def _filtered(batches):
    for b in batches:
        ok = _likely(_matrix(b.column("regs_a")), _matrix(b.column("regs_b")),
                     b.column("n_a").to_numpy(), b.column("n_b").to_numpy())
        same = (_matrix(b.column("regs_a")) == _matrix(b.column("regs_b"))).sum(1)
        yield pa.RecordBatch.from_arrays(
            [b.column("a"), b.column("b"), pa.array(same, pa.int64())], ["a", "b", "same"]).filter(pa.array(ok))


_MEMBER = "key long, lb int, rb int, left boolean, minor boolean, rep long, comp long, n long, regs binary"
_MEMBERS = [c.split()[0] for c in _MEMBER.split(", ")]


def _blocks(batches, columns: list[str]):
    """The blocks (key, lb, rb) of sorted rows, each as a list of rows."""
    held, key = [], None
    for b in batches:
        c = b.to_pydict()
        for row in zip(*(c[x] for x in columns)):
            if row[:3] != key:
                if held:
                    yield held
                held, key = [], row[:3]
            held.append(row)
    if held:
        yield held


def _partners(block: list):
    """For each member to be compared: its place among the block's left ones, and the places of its likely
    partners of other components among the right ones. A pair comes up once, in the first bucket it shares."""
    left, right = [r for r in block if r[3]], [r for r in block if not r[3]]
    if not left or not right:
        return
    m_l, m_r = (np.frombuffer(b"".join(r[8] for r in s), "<u2").reshape(-1, REGISTERS) for s in (left, right))
    rep, comp, n = (np.array([r[i] for r in right], np.int64) for i in (5, 6, 7))
    minor = np.array([r[4] for r in right], bool)
    band = int(np.argmax(band_keys(m_l[:1])[0] == block[0][0]))
    bands = m_r.reshape(len(right), -1, ROWS)
    for i, r in enumerate(left):
        at = np.flatnonzero((comp != r[6]) & ~(minor & (rep < r[5])))
        if len(at):
            at = at[(bands[at] == m_l[i].reshape(-1, ROWS)).all(2).argmax(1) == band]
        if len(at):
            at = at[_likely(np.broadcast_to(m_l[i], (len(at), REGISTERS)), m_r[at], np.full(len(at), r[7]), n[at])]
        if len(at):
            yield left, right, i, at


def _involved(batches):
    """The members that have a likely partner."""
    out = []
    for block in _blocks(batches, _MEMBERS):
        found: set = set()
        for left, right, i, at in _partners(block):
            found.add(left[i])
            found.update(right[j] for j in at.tolist())
        out += found
        if len(out) >= 10_000:
            yield _rows(out)
            out = []
    if out:
        yield _rows(out)


def _rows(rows: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], _MEMBERS)


def _confirmed(batches):
    """(a, b): links by which components of a block meet, verified on full sets; a forest of them."""
    for block in _blocks(batches, [*_MEMBERS, "elements"]):
        root: dict = {}
        sets: dict = {}

        def find(x):
            while x in root:
                x = root[x]
            return x

        def elements(row):
            if row[5] not in sets:
                sets[row[5]] = np.frombuffer(row[9], np.uint64)
            return sets[row[5]]
        out = []
        for left, right, i, at in _partners(block):
            a = elements(left[i])
            for j in at.tolist():
                x, y = find(left[i][6]), find(right[j][6])
                if x == y:
                    continue
                b = elements(right[j])
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= SHARE * (len(a) + len(b) - both):
                    root[x] = y
                    out.append((left[i][5], right[j][5]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["a", "b"])


def _element_sets(batches):
    hold(word_hash)
    for b in batches:
        sets = [shingles(t) for t in b.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([digest_of(x) for x in sets], pa.binary()),
                                          pa.array([x.tobytes() for x in sets], pa.binary())], ["doc_id", "digest", "elements"])


def _verified(batches):
    hold(word_hash)
    for b in batches:
        good, was, sets, sets_digest = [], None, None, None
        column = lambda c: b.column(c).cast(pa.binary()).to_pylist()
        for ta, tb, da, db in zip(*map(column, ("text_a", "text_b", "digest_a", "digest_b"))):
            x = shingles(ta)
            if tb != was:
                was, sets = tb, shingles(tb)
                sets_digest = digest_of(sets)
            # a repeated id may bring other texts than the one its sketch was made of
            if digest_of(x) != da or sets_digest != db:
                good.append(False)
                continue
            both = len(np.intersect1d(x, sets, assume_unique=True))
            good.append(100 * both >= SHARE * (len(x) + len(sets) - both))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))


def _only(rows: DataFrame, ids: DataFrame, count: int) -> DataFrame:
    """The rows whose doc_id is among ``ids``: a broadcast up to BROADCAST_IDS ids, else a join."""
    return rows.join(F.broadcast(ids) if count <= BROADCAST_IDS else ids, "doc_id", "left_semi")


def verify(pairs: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    rows = _only(texts(docs), ids, ids.count()).distinct()
    for s in ("a", "b"):
        pairs = pairs.join(reps.select(F.col("rep").alias(s), F.col("digest").alias(f"digest_{s}")), s)
    for s in ("a", "b"):
        pairs = pairs.join(rows.select(F.col("doc_id").alias(s), F.col("text").alias(f"text_{s}")), s)
    return pairs.mapInArrow(_verified, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the least node that each linked node reaches; large and small stars
    alternate until the edges stay the same."""
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u <> v").distinct())
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: every greater neighbour is hung below the least of the neighbourhood
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # small star: the smaller neighbours and the node itself likewise
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        edges = staged(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        mark = now


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, digest, kept) of every document: of every distinct set of an id."""
    prepare(docs.sparkSession)
    made = staged(sketches(docs))
    lone = made.where("doc_id IS NULL").select("doc_id", "n")
    named = made.where("doc_id IS NOT NULL").groupBy("doc_id", "digest").agg(F.first("n").alias("n"), F.first("regs").alias("regs"))
    reps = staged(named.where("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("regs").alias("regs")))
    bands = (reps.select("rep", "regs").mapInArrow(_banded, "rep long, keys array<long>")
             .select("rep", F.explode("keys").alias("key")))
    # one pivot a bucket; buckets of one member are done with
    pivots = bands.groupBy("key").agg(F.min("rep").alias("b"), F.count("*").alias("members")).where("members > 1")
    shared = staged(bands.join(pivots, "key").select("key", "rep", "b"))
    tried = shared.where("rep <> b").select(F.col("rep").alias("a"), "b").distinct()
    side = lambda s: reps.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("regs").alias(f"regs_{s}"))
    near = (tried.join(side("a"), "a").where("n_a IS NOT NULL").join(side("b"), "b")
            .where(f"100 * least(n_a, n_b) >= {SHARE} * greatest(n_a, n_b)")
            .mapInArrow(_filtered, "a long, b long, same long"))
    best = near.groupBy("a").agg(F.max_by("b", F.struct("same", -F.col("b"))).alias("b"))
    links = staged(verify(staged(best), docs, reps))
    comps = components(links)
    # buckets that hold more than one component
    member = (shared.join(comps, F.col("rep") == F.col("node"), "left")
              .select("key", "rep", F.coalesce("comp", "rep").alias("comp")))
    sized = member.groupBy("key", "comp").agg(F.count("*").alias("c"))
    spread = (sized.groupBy("key").agg(F.max_by("comp", F.struct("c", "comp")).alias("major"), F.sum("c").alias("all"),
                                       F.max("c").alias("most"))
              .where("all > most")
              .select("key", "major", F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int").alias("lbs"),
                      F.ceil(F.col("all") / WIDE).cast("int").alias("rbs")))
    mixed = member.join(spread, "key")
    own = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    left = (mixed.where("comp <> major").withColumn("lb", own("lbs"))
            .select("key", "lb", F.explode(every("rbs")).alias("rb"), F.lit(True).alias("left"), F.lit(True).alias("minor"), "rep", "comp"))
    right = (mixed.withColumn("rb", own("rbs"))
             .select("key", F.explode(every("lbs")).alias("lb"), "rb", F.lit(False).alias("left"),
                     (F.col("comp") != F.col("major")).alias("minor"), "rep", "comp"))
    in_blocks = lambda df: df.repartition("key", "lb", "rb").sortWithinPartitions("key", "lb", "rb")
    blocks = left.unionByName(right).join(reps.select("rep", "n", "regs"), "rep").select(*_MEMBERS)
    involved = staged(in_blocks(blocks).mapInArrow(_involved, _MEMBER))
    if not involved.isEmpty():
        wanted = staged(involved.select(F.col("rep").alias("doc_id")).distinct())
        sets = (_only(texts(docs), wanted, wanted.count()).mapInArrow(_element_sets, "doc_id long, digest binary, elements binary")
                .join(reps.select(F.col("rep").alias("doc_id"), "digest"), ["doc_id", "digest"])
                .groupBy("doc_id").agg(F.first("elements").alias("elements")))
        full = involved.join(sets, involved["rep"] == sets["doc_id"]).select(*_MEMBERS, "elements")
        more = staged(in_blocks(full).mapInArrow(_confirmed, "a long, b long").distinct())
        comps = components(links.unionByName(more))
    classes = (reps.select("digest", "rep").join(comps, F.col("rep") == F.col("node"), "left")
               .select("digest", F.coalesce("comp", "rep").alias("component")))
    out = (named.select("doc_id", "n", "digest").join(classes, "digest", "left")
           .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), "digest"))
    return (out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
            .unionByName(lone.select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"),
                                     F.lit(None).cast("binary").alias("digest"), F.lit(True).alias("kept"))))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    return judged(docs).drop("digest")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns: the one of least ``doc_id``. Rows
    without an id stay. Rows that repeat an id are judged by their own text; of those with
    equal sets of shingles one stays."""
    rows = staged(judged(docs).where("doc_id IS NOT NULL").select("doc_id", "digest", "kept"))
    key = F.col("doc_id").cast("long")
    # ids that more than one row of the table has
    often = staged(docs.where("doc_id IS NOT NULL").groupBy(key.alias("often_id")).agg(F.count("*").alias("c"))
                   .where("c > 1").select("often_id"))
    n = often.count()
    kept = rows.where("kept").select(F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest"))
    out = docs.where("doc_id IS NULL")
    ids = F.broadcast(often) if n <= BROADCAST_IDS else often
    once = docs.where("doc_id IS NOT NULL").join(kept.select("kept_id").distinct(), key == F.col("kept_id"), "left_semi")
    if not n:
        return once.unionByName(out)
    once = once.join(ids, key == F.col("often_id"), "left_anti")
    again = docs.where("doc_id IS NOT NULL").join(ids, key == F.col("often_id"), "left_semi")
    whole = again.select(key.alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.struct(*docs.columns).alias("row"))
    told = whole.mapInArrow(_with_digest, whole.drop("text").schema.add("digest", "binary"))
    one = told.groupBy("doc_id", "digest").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    one = one.join(kept, (F.col("doc_id") == F.col("kept_id")) & F.col("digest").eqNullSafe(F.col("kept_digest")), "left_semi")
    return once.unionByName(one.select("row.*")).unionByName(out)


def _with_digest(batches):
    hold(word_hash)
    for b in batches:
        found = [digest_of(shingles(t)) for t in b.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), pa.array(found, pa.binary())], ["doc_id", "row", "digest"])
