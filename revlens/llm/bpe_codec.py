"""Byte-pair encoding and decoding with a public vocabulary file.

Encoding: every pre-token becomes a doubly linked list of symbols; a priority queue
holds the merge ranks of adjacent pairs, and entries whose symbols have changed
meanwhile are stale and skipped. Decoding: the vocabulary strings of the ids are
concatenated, parted by one space where the file names no decoder (as the library does).

Normalisation and pre-tokenisation are the file's own; a stretch between white space
is encoded once per worker and kept in a bounded cache. Special strings of the file
inside a text become their ids, as the library's default has it.

Defined results: a null text is empty; an empty text has no ids and decodes to the empty
text; a null ``doc_id`` is kept; repeated rows are encoded each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import hold, texts

CACHE_WORDS = 1 << 19
_codecs: dict = {}
# Stretches of printable ASCII and Latin-1 letters need no normaliser but lower-casing.
_PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]*")
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Codec(dict):
    """word (bytes without white space) -> (ids as bytes, decoded string)."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.pairs = {}
        for rank, (a, b) in enumerate(m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            self.pairs[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.symbols = byte_symbols()
        library = Tokenizer.from_file(path)
        self.normalise = library.normalizer.normalize_str
        self.pre_tokenise = library.pre_tokenizer.pre_tokenize_str
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.pieces: dict[str, list[int]] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """Merges pairs by rank, the leftmost first among equals."""
        n, pairs = len(ids), self.pairs
        ahead, back = list(range(1, n + 1)), list(range(-1, n))
        queue = [(*pairs[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in pairs]
        queue = [(rank, i, new, p) for rank, new, i, p in queue]
        heapq.heapify(queue)
        while queue:
            _, i, new, pair = heapq.heappop(queue)
            j = ahead[i]
            if j >= n or (ids[i], ids[j]) != pair:
                continue                       # stale: a neighbour has been merged
            ids[i], ids[j], ahead[i] = new, -1, ahead[j]
            back[ahead[j]] = i
            for left, right in ((back[i], i), (i, ahead[i])):
                if left >= 0 and right < n and (found := pairs.get((ids[left], ids[right]))):
                    heapq.heappush(queue, (found[0], left, found[1], (ids[left], ids[right])))
        return [x for x in ids if x >= 0]

    def piece(self, symbols: str) -> list[int]:
        """Ids of one pre-token, given in byte symbols."""
        got = self.pieces.get(symbols)
        if got is None:
            chars = [*symbols[:-1], symbols[-1] + self.suffix]
            got = self.merge([self.vocab[c] for c in chars if c in self.vocab])
            if len(symbols) <= 64:
                if len(self.pieces) >= CACHE_WORDS:
                    self.pieces.clear()
                self.pieces[symbols] = got
        return got

    def stretch(self, text: str) -> list[int]:
        """Ids of a text without special strings."""
        ids: list[int] = []
        if _PLAIN.fullmatch(text):
            for p in _SPLIT.findall(text.lower()):
                ids += self.piece("".join([self.symbols[b] for b in p.encode()]))
        else:
            for p, _ in self.pre_tokenise(self.normalise(text)):
                if p:
                    ids += self.piece(p)
        return ids

    def __missing__(self, word: bytes) -> tuple[bytes, str]:
        ids: list[int] = []
        for part in self.marks.split(word.decode("utf-8")):
            if part:
                ids += [self.special[part]] if part in self.special else self.stretch(part)
        got = np.array(ids, "<u4").tobytes(), self.decode(ids)
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = got
        return got

    def encode(self, text: bytes) -> bytes:
        return b"".join([self[w][0] for w in text.split()])

    def decode(self, ids) -> str:
        return " ".join([self.strings[i] for i in ids])


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    hold(_codecs[path], _codecs[path].pieces)
    return _codecs[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids array<int>) of every text."""
    return _encoded(docs, path, False)


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids array<int>, decoded_sha256) of every text: the digest is of the
    text that its ids decode to."""
    return _encoded(docs, path, True)


def _encoded(docs: DataFrame, path: str, decoded: bool) -> DataFrame:
    names = ["doc_id", "n_tokens", "ids"] + ["decoded_sha256"] * decoded

    def run(batches):
        c = codec(path)
        for b in batches:
            ids = [np.frombuffer(c.encode(x), "<u4") for x in b.column("text").cast(pa.binary()).to_pylist()]
            flat = np.concatenate([*ids, np.zeros(0, "<u4")]).astype(np.int32)
            ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            columns = [b.column("doc_id"), pa.array(np.diff(ends), pa.int64()),
                       pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
            if decoded:
                columns.append(pa.array([hashlib.sha256(c.decode(i.tolist()).encode("utf-8")).hexdigest() for i in ids],
                                        pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)
    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>"
                                  + ", decoded_sha256 string" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); a null list decodes to the empty text."""
    def run(batches):
        c = codec(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([c.decode(x or []) for x in b.column("ids").to_pylist()],
                                              pa.string())], ["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, decode and digest in one
    pass, so that ids and decoded texts don't travel between workers and the JVM."""
    def run(batches):
        c = codec(path)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for x in b.column("text").cast(pa.binary()).to_pylist():
                got = [c[w] for w in x.split()]
                ids = b"".join([g[0] for g in got])
                n.append(len(ids) // 4)
                ids_sha.append(sha(ids))
                text_sha.append(sha(" ".join([g[1] for g in got if g[0]]).encode("utf-8")))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
