"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are shuffled whole, so that copies meet and count as one text with a multiplicity; tasks
combine their own copies first, so a text that many rows hold arrives as one row a task. Each
distinct text is encoded by both libraries and aligned by byte offsets: offsets where tokens of
both end cut the text into groups, and every stretch between neighbouring offsets of either side
is one link, the overlap of one token of each. A link of ids (a, b) counts as often as its text.

The corpus-wide counts of id pairs grow with the corpus and are sent to nobody whole. The
distinct texts lie in slices of about ``SLICE_BYTES``; a slice holds each of its pairs once,
already summed, the sums are added up by pair, and every slice is answered for the pairs that it
asked about and no others. Measures are joined to the rows by the digest of their text.

Defined results: a null or empty text, and one that either side doesn't give back byte by byte,
has no tokens: all measures are 0 and the digest is ''; a null ``doc_id`` is kept; repeated rows
count and are measured each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.session import sized_shuffle, staging_path

from .bpe_codec import byte_symbols
from .common import hold, texts

SLICE_BYTES = 32 << 20
CACHE_WORDS = 1 << 19
# The pre-tokens of the byte-level file, over characters on whose classes every Unicode version agrees.
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa0-ɏ‐-‧€]*")
_aligners: dict = {}


class _Words(dict):
    """pre-token -> its ids, by the library's model; a bounded cache."""

    def __init__(self, library):
        super().__init__()
        self.model, self.symbols = library.model, byte_symbols()

    def __missing__(self, word: str) -> list[int]:
        got = [t.id for t in self.model.tokenize("".join([self.symbols[b] for b in word.encode()]))]
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = got
        return got


class Aligner:
    """Both tokenizers, with the bytes and printed forms of their ids."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"        # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.words = _Words(self.a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        value = {c: i for i, c in enumerate(byte_symbols())}
        vocab = self.a.get_vocab(with_added_tokens=True)
        n_a, self.n_b = max(vocab.values()) + 1, self.b.vocab_size()
        self.bytes_a = [b""] * n_a
        for entry, i in vocab.items():
            self.bytes_a[i] = bytes(value[c] for c in entry) if all(c in value for c in entry) else entry.encode()
        piece = lambda i: bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) \
            else self.b.id_to_piece(i).replace("▁", " ").encode()
        self.bytes_b = [piece(i) for i in range(self.n_b)]
        self.len_a, self.len_b = (np.array([*map(len, x)], np.int64) for x in (self.bytes_a, self.bytes_b))
        # the printed id and what follows it: , within a side of a group, | after its A ids, ; after its B ids
        self.shown = [f"{i}{mark}" for n, last in ((n_a, "|"), (self.n_b, ";")) for i in range(n) for mark in (",", last)]
        self.shown_b = 2 * n_a

    def encode(self, data: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """The ids of both sides for each text; None where either side doesn't give the text back."""
        plain = [_PLAIN.fullmatch(t) is not None for t in data]
        rest = iter(self.a.encode_batch_fast([" " + t for t, p in zip(data, plain) if not p], add_special_tokens=False))
        out = []
        for t, p, b in zip(data, plain, self.b.encode(data, num_threads=1, out_type=int)):
            whole = b" " + t.encode()
            a = [*chain.from_iterable(map(self.words.__getitem__, _WORDS.findall(" " + t)))] if p else next(rest).ids
            good = all(b"".join(map(bits.__getitem__, ids)) == whole for bits, ids in ((self.bytes_a, a), (self.bytes_b, b)))
            out.append((np.array(a, np.int64), np.array(b, np.int64)) if good else None)
        return out

    def measure(self, a: np.ndarray, b: np.ndarray) -> tuple[int, np.ndarray, str]:
        """(groups, pair of each link as a * n_b + b, digest of the printed groups) of two encodings of one text."""
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        ends = np.zeros(end_a[-1] + 1, np.uint8)                  # at each offset: 1 if A ends there, and 2 if B does
        ends[end_a] = 1
        ends[end_b] += 2
        kind = ends[ends > 0]
        by_a, by_b, by_both = (kind & 1) > 0, (kind & 2) > 0, kind == 3
        before = lambda x: np.cumsum(x) - x
        pairs = a[before(by_a)] * self.n_b + b[before(by_b)]
        # all tokens in the order of the groups, in a group those of A first
        group = 2 * before(by_both)
        marks = np.concatenate([2 * a + by_both[by_a], self.shown_b + 2 * b + by_both[by_b]])
        marks = marks[np.argsort(np.concatenate([group[by_a], group[by_b] + 1]), kind="stable")]
        text = "".join(map(self.shown.__getitem__, marks.tolist()))[:-1]
        return int(by_both.sum()), pairs, hashlib.sha256(text.encode()).hexdigest()


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    hold(_aligners[path_a, path_b].words)
    return _aligners[path_a, path_b]


_ALIGNED = "digest binary, slice long, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
_NAMES = [c.split()[0] for c in _ALIGNED.split(", ")]


def _aligned(path_a: str, path_b: str):
    """One row for each distinct text that has tokens; ``pairs`` and ``times`` hold its distinct pairs and how often each is linked."""
    def run(batches):
        al = aligner(path_a, path_b)
        for batch in batches:
            data = batch.column("text").to_pylist()
            rows = []
            for text, at, copies, ids in zip(data, *(batch.column(c).to_pylist() for c in ("slice", "copies")), al.encode(data)):
                if ids is not None:
                    groups, links, sha = al.measure(*ids)
                    pairs, times = np.unique(links, return_counts=True)
                    rows.append((hashlib.sha256(text.encode()).digest(), at, copies, len(ids[0]), len(ids[1]), groups, len(links), sha,
                                 pairs.astype("<u8" if al.n_b * len(al.bytes_a) > 2 ** 32 else "<u4").tobytes(), times.astype("<u4").tobytes()))
            if rows:
                kinds = [pa.binary(), *[pa.int64()] * 6, pa.string(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], _NAMES)
    return run


def _unpacked(pairs: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    times = np.frombuffer(times, "<u4").astype(np.int64)
    return np.frombuffer(pairs, "<u8" if len(pairs) > 4 * len(times) else "<u4").astype(np.int64), times


def _summed(batches):
    """(slice, pair, n): each slice's pairs, summed over a run of its rows."""
    def added(held):
        pairs, where = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
        n = np.zeros(len(pairs), np.int64)
        np.add.at(n, where, np.concatenate([t for _, t in held]))
        return pairs, n

    def put(at, held):
        pairs, n = added(held)
        for lo in range(0, len(pairs), 100_000):
            some = pairs[lo:lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), at)), pa.array(some), pa.array(n[lo:lo + 100_000])],
                                             ["slice", "pair", "n"])
    at, held, size = None, [], 0
    for b in batches:
        for s, copies, pairs, times in zip(*(b.column(c).to_pylist() for c in ("slice", "copies", "pairs", "times"))):
            if s != at and held:
                yield from put(at, held)
                held, size = [], 0
            p, t = _unpacked(pairs, times)
            at, size = s, size + len(p)
            held.append((p, t * copies))
            if size > 2_000_000:
                held, size = [added(held)], 0
    if held:
        yield from put(at, held)


def _measured(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """A slice's texts with the sums over their links of what the corpus says of each pair."""
    if not rows.num_rows:
        return pa.table({"digest": pa.array([], pa.binary()), "n_best": pa.array([], pa.int64()), "count_sum": pa.array([], pa.int64())})
    known, n, best = (answers.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(known)
    known, n, best = known[order], n[order], best[order].astype(np.int64)
    n_best, count_sum = [], []
    for pairs, times in zip(rows.column("pairs").to_pylist(), rows.column("times").to_pylist()):
        p, t = _unpacked(pairs, times)
        at = np.searchsorted(known, p)
        n_best.append(int((best[at] * t).sum()))
        count_sum.append(int((n[at] * t).sum()))
    return pa.table({"digest": rows.column("digest").cast(pa.binary()), "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())})


def _stored(df: DataFrame, name: str) -> DataFrame:
    spark: SparkSession = df.sparkSession
    where = staging_path(spark, name)
    df.write.option("compression", "zstd").parquet(where)
    return spark.read.parquet(where)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    rows, spark = texts(docs), docs.sparkSession
    full = rows.where("text <> ''")
    total = full.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slices = max(1, -(-total // SLICE_BYTES))
    with sized_shuffle(spark, total, SLICE_BYTES):
        parts = max(slices, int(spark.conf.get("spark.sql.shuffle.partitions")))
        # slices follow the partitions of the shuffle by text, so that a task's texts are of one slice or a few
        distinct = (full.groupBy("text").agg(F.count("*").alias("copies"))
                    .withColumn("slice", F.expr(f"pmod(hash(text), {parts}) * {slices}L div {parts}")))
        made = _stored(distinct.mapInArrow(_aligned(path_a, path_b), _ALIGNED), "aligned")
    n_b = aligner(path_a, path_b).n_b
    sums = (made.select("slice", "copies", "pairs", "times").mapInArrow(_summed, "slice long, pair long, n long")
            .groupBy("slice", "pair").agg(F.sum("n").alias("n")))
    sums = _stored(sums, "pairs")
    counts = sums.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair") % n_b)
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    counts = counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    answers = sums.select("slice", "pair").join(counts, "pair").select("slice", "pair", "n", "best")
    asked = made.select("slice", "digest", "pairs", "times")
    found = (asked.groupBy("slice").cogroup(answers.groupBy("slice"))
             .applyInArrow(_measured, "digest binary, n_best long, count_sum long"))
    measures = made.drop("pairs", "times", "copies", "slice").join(found, "digest")
    keyed = rows.select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    out = keyed.join(measures, "digest", "left")
    zero = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return out.select("doc_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in zero], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
