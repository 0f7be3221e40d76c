"""Token counts of whole texts by overlap resynchronisation.

A text of more than ``CHUNK_CHARS`` code points is cut into overlapping chunks that are dealt
out over the cluster and encoded by the library, each on its own, with the offsets of its tokens.
The (start, end, id) runs of two neighbours are then held against each other in their overlap. They
are spliced at a boundary where, in both, a pre-token ends and the same last token stands before it
and the same tokens of the next pre-token, not the chunk's last, stand after it. Pre-tokens are
found from left to right, so two readings that stand at the same place go on alike: the rest of the
second chunk is what the whole text's encoding has. Where an overlap holds no such boundary the
document goes into another round with chunks and overlaps four times as wide, until
one chunk holds it whole.

Defined results: a null text counts as empty; an empty text has 0 tokens and 0 bytes;
a null ``doc_id`` is kept; repeated rows are counted each; an empty table gives no rows.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hold, staged, texts

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
LIMIT = 2_048
WIDEN = 4
CACHE_WORDS = 1 << 20
_counters: dict = {}


class _Counter(dict):
    """Tokens of a stretch between white space, as the library encodes it; a bounded cache for short texts."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer
        self.encode = Tokenizer.from_file(path).encode

    def __missing__(self, word: bytes) -> int:
        n = len(self.encode(word.decode("utf-8"), add_special_tokens=False).ids)
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = n
        return n

    def count(self, text: bytes) -> int:
        return sum(map(self.__getitem__, text.split()))


def _counter(path: str) -> _Counter:
    if path not in _counters:
        _counters[path] = _Counter(path)
    hold(_counters[path])
    return _counters[path]


def _whole(path: str):
    def run(batches):
        count = _counter(path).count
        for b in batches:
            data = b.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(x) for x in data], pa.int64()),
                 pa.array([count(x) for x in data], pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
    return run


_CHUNK = "row long, doc_id long, k int, last boolean, part string"


def _cut(size: int, overlap: int):
    """Chunks [k * (size - overlap), ... + size) of each text."""
    def run(batches):
        for b in batches:
            for row, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                k, at = 0, 0
                while True:
                    last = at + size >= len(text)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row], pa.int64()), pa.array([doc_id], pa.int64()),
                         pa.array([k], pa.int32()), pa.array([last]), pa.array([text[at:at + size]])],
                        ["row", "doc_id", "k", "last", "part"])
                    if last:
                        break
                    k, at = k + 1, at + size - overlap
    return run


_ZONE = "array<struct<at:long,mark:long,n:long>>"
_ENCODED = f"row long, doc_id long, k int, last boolean, n long, n_bytes long, left {_ZONE}, right {_ZONE}"


def boundaries(encoding, start: int, lo: int, hi: int) -> list[dict]:
    """The places in [lo, hi) of a chunk where a pre-token ends: ``at`` (in the text), ``n`` tokens
    before it and ``mark``, a hash of the token before it and those of the pre-token after it.

    The chunk's last pre-token may go on behind its end, so none is followed by that one.
    """
    words, offsets, ids = encoding.word_ids, encoding.offsets, encoding.ids
    firsts = [i for i in range(1, len(ids)) if words[i] != words[i - 1]]
    out = []
    for i, after in zip(firsts, firsts[1:]):
        at = offsets[i - 1][1]
        if lo <= at < hi:
            run = [(start + a, start + b, t) for (a, b), t in zip(offsets[i - 1:after], ids[i - 1:after])]
            mark = xxhash.xxh64_intdigest(repr(run).encode())
            out.append({"at": start + at, "mark": mark - (1 << 63), "n": i})
    return out


def _encode(path: str, size: int, overlap: int):
    """Per chunk: its tokens, and the boundaries of its overlaps."""
    def run(batches):
        encode = _counter(path).encode
        zone = pa.list_(pa.struct([("at", pa.int64()), ("mark", pa.int64()), ("n", pa.int64())]))
        for b in batches:
            rows = b.to_pydict()
            left, right, n = [], [], []
            for k, last, part in zip(rows["k"], rows["last"], rows["part"]):
                start, encoding = k * (size - overlap), encode(part, add_special_tokens=False)
                left.append(boundaries(encoding, start, 0, overlap) if k else [])
                right.append([] if last else boundaries(encoding, start, size - overlap, size))
                n.append(len(encoding.ids))
            # bytes of the part that no later chunk holds too
            own = [len((p if z else p[:size - overlap]).encode()) for p, z in zip(rows["part"], rows["last"])]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), b.column("k"), b.column("last"),
                 pa.array(n, pa.int64()), pa.array(own, pa.int64()),
                 pa.array(left, zone), pa.array(right, zone)],
                ["row", "doc_id", "k", "last", "n", "n_bytes", "left", "right"])
    return run


def _spliced(long: DataFrame, path: str, size: int, overlap: int) -> DataFrame:
    """(row, doc_id, n_bytes, n_tokens); n_tokens is null where a splice failed."""
    chunks = long.mapInArrow(_cut(size, overlap), _CHUNK)
    chunks = chunks.repartition("row", "k")     # the chunks of one huge text spread out
    parts = chunks.mapInArrow(_encode(path, size, overlap), _ENCODED)
    parts = parts.withColumn("next", F.lead("left").over(Window.partitionBy("row").orderBy("k")))
    place = lambda zone: F.transform(zone, lambda x: F.struct(x["at"], x["mark"]))
    # the last common one, farthest from where the second chunk begins in the midst of a word
    common = F.array_max(F.array_intersect(place(F.col("right")), place(F.col("next"))))
    tokens_at = lambda zone: F.get(F.filter(
        zone, lambda x: (x["at"] == F.col("cut.at")) & (x["mark"] == F.col("cut.mark"))), 0)["n"]
    joined = (parts.withColumn("cut", common)
              .withColumn("term", F.when(F.col("last"), F.col("n"))
                          .when(F.col("cut").isNotNull(), tokens_at(F.col("right")) - tokens_at(F.col("next")))))
    return joined.groupBy("row", "doc_id").agg(
        F.sum("n_bytes").alias("n_bytes"),
        F.when(F.count("term") == F.count("*"), F.sum("term")).alias("n_tokens"))


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK_CHARS,
                 overlap: int = OVERLAP_CHARS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every text."""
    rows = texts(docs).withColumn("row", F.monotonically_increasing_id())
    long = F.length("text") > chunk
    done = [rows.where(~long).select("doc_id", "text")
            .mapInArrow(_whole(path), "doc_id long, n_bytes long, n_tokens long")]
    pending = rows.where(long)
    while True:
        out = staged(_spliced(pending, path, chunk, overlap))
        done.append(out.where("n_tokens IS NOT NULL").select("doc_id", "n_bytes", "n_tokens"))
        failed = out.where("n_tokens IS NULL").select("row")
        if failed.isEmpty():
            break
        pending = pending.join(failed, "row", "left_semi")
        chunk, overlap = chunk * WIDEN, overlap * WIDEN
    all_rows = done[0]
    for more in done[1:]:
        all_rows = all_rows.unionByName(more)
    return all_rows.withColumn("over_limit", F.col("n_tokens") > limit)
