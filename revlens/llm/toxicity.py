"""Toxicity by noisy-channel deobfuscation.

A suspicious token (letters mixed with look-alike symbols, letters spelled out with
separators, stretched letters) becomes a lattice: at each position the letters that it
may stand for, or nothing for a repeat or a separator, each with a channel cost. The
path of least cost under a character trigram model of the whole corpus is the restored
word; a run of single characters is decoded as a whole with optional word ends between them,
as its own spaces don't part words. Restored texts are scored by a decision list over words and word beginnings: the
strongest smoothed share of toxic documents among the labelled documents that have it,
calibrated on labelled documents that the list of the other half of the sample scores.

Defined results: a null or empty text scores the prior's base score; a null ``doc_id`` is
kept; repeated rows are scored each; without labelled rows every score is 0; an empty table
gives no rows. Groups of copies among the labelled documents count once per group.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hold, labelled, prepare, staged, texts

SAMPLE = 20_000        # labelled documents that the decision list is fitted on, at most
SMOOTH = 5.0           # documents at the prior that each share starts from
HOLD = 7_000.0         # over the sample's size: how firmly calibration is held to none
MIN_DOCS = 3           # a feature of fewer labelled documents decides nothing
PREFIXES = (4, 5)
CACHE_WORDS = 1 << 18
# The letters a symbol may stand for.
LOOKS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
SWAP, DROP, KEEP, UNDOUBLE = 1.5, 0.7, 0.0, 8.0      # channel costs in nats
MARGIN = 8.0          # over the best path's cost: up to it, words of a run of single characters are looked up
_GAP = "._-*~"
_ALPHABET = "abcdefghijklmnopqrstuvwxyz"
_CODE = {c: i + 1 for i, c in enumerate(_ALPHABET)}
_SIDE = 28                            # end of word, letters, any other letter
_SPELT = re.compile(rb"(?<![^\s])(?:[A-Za-z0-9@$!|+][\s._*-]+){2,}[A-Za-z0-9@$!|+](?![^\s.,;:!?])")
_RUNS = re.compile(r"^[^\w\s]{3,}|[^\w\s]{3,}$")
_STRETCHED = re.compile(r"(.)\1{2,}")
_TWICE = re.compile(r"(.)\1")
_LONG = re.compile(r"(.)\1{4,}", re.S)
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_ENDS = re.compile(r"^[^\w@$!|+€]+|[^\w@$]+$")
# The same classes' ASCII characters, for texts that have no others.
_ASCII = [*map(chr, range(128))]
_EDGE_ASCII = "".join(c for c in _ASCII if not c.isalnum())
_RUNS_ASCII = "".join(c for c in _EDGE_ASCII if c != "_" and not c.isspace())
_FORE_ASCII = "".join(c for c in _EDGE_ASCII if c not in "_@$!|+")
_AFT_ASCII = "".join(c for c in _EDGE_ASCII if c not in "_@$")
# What a token to decode holds: a repeat, a look-alike next to a letter or to another one, a gap
# between such; and a letter, or a look-alike that is no digit (others are numbers).
_SIGNS = "01345789@$!|+€"
_ODD = re.compile(rf"(.)\1|[{_SIGNS}](?:[^\W\d_]|[{_SIGNS}])|[^\W\d_][{_SIGNS}]"
                  rf"|[^\W_][@$!|+€._*~-]+[^\W_]|[a-z][0-9]+[a-z]|[{_SIGNS}][._*~-]+[a-z{_SIGNS}]|[a-z][._*~-]+[{_SIGNS}]")
_LETTERS = re.compile(r"[^\W\d_]|[@$!|€]")


def _char_counts(batches):
    """Counts of character trigrams over the distinct words of each task's batches."""
    hold()
    counts = np.zeros(_SIDE ** 3, np.int64)
    codes = np.full(256, 27, np.int64)
    for c, i in _CODE.items():
        codes[ord(c)] = codes[ord(c.upper())] = i
    codes[[9, 10, 11, 12, 13, 32]] = 0
    plain = np.array([chr(b).isalpha() and b < 128 or b >= 128 or codes[b] == 0 for b in range(256)])
    for b in batches:
        data = b" ".join(b.column("text").cast(pa.binary()).to_pylist())
        x = np.frombuffer(data, np.uint8)
        x = codes[x[plain[x]]]
        if len(x) > 2:
            # a word's end follows from any gap: runs of gaps count as one
            keep = np.concatenate([[True], (x[1:] != 0) | (x[:-1] != 0)])
            x = np.concatenate([[0, 0], x[keep], [0, 0]])
            counts += np.bincount(x[:-2] * _SIDE * _SIDE + x[1:-1] * _SIDE + x[2:], minlength=_SIDE ** 3)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], ["gram", "n"])


def char_model(docs: DataFrame) -> np.ndarray:
    """-ln P(c | a, b) as a 28 x 28 x 28 array, from all texts (its size is fixed)."""
    rows = texts(docs).select("text").mapInArrow(_char_counts, "gram int, n long")
    counts = np.zeros(_SIDE ** 3)
    for r in rows.groupBy("gram").agg(F.sum("n").alias("n")).collect():   # at most 28^3 rows
        counts[r.gram] = r.n
    tri = counts.reshape(_SIDE, _SIDE, _SIDE)
    bi, uni = tri.sum(0), tri.sum((0, 1))
    p1 = (uni + 1) / (uni.sum() + _SIDE)
    p2 = (bi + 20 * p1) / (bi.sum(1, keepdims=True) + 20)
    return -np.log((tri + 20 * p2) / (tri.sum(2, keepdims=True) + 20))


def _repeats(word: str) -> list[float]:
    """What dropping a repeat costs: little in runs of three or more (stretched), a price in doubles."""
    repeat = [UNDOUBLE] * len(word)
    for m in _STRETCHED.finditer(word):
        repeat[m.start():m.end()] = [DROP] * (m.end() - m.start())
    return repeat


def _step(beam: dict, ch: str, repeat: float, cost: np.ndarray) -> dict:
    """The lattice's states after one more character; a key ends in (letter before, last letter, its symbol),
    a value is (cost, (text before, letter))."""
    grown: dict = {}
    options = [(c, KEEP if c == ch else SWAP) for c in (ch if ch.isalpha() else "") + LOOKS.get(ch, "")]
    for (start, a, b, seen), (so_far, out) in beam.items():
        moves = [(b, _CODE.get(c, 27), ch, so_far + fee + cost.item(a, b, _CODE.get(c, 27)), (out, c))
                 for c, fee in options]
        if ch in _GAP or not options:
            moves.append((a, b, seen, so_far + DROP, out))
        elif ch == seen:
            moves.append((a, b, seen, so_far + repeat, out))
        for p, q, s, total, text in moves:
            if (start, p, q, s) not in grown or total < grown[start, p, q, s][0]:
                grown[start, p, q, s] = (total, text)
    return grown


def _text(chain) -> str:
    letters = []
    while chain:
        chain, c = chain
        letters.append(c)
    return "".join(reversed(letters))


def restore(word: str, cost: np.ndarray) -> str:
    """Viterbi decoding of a lower-case token's lattice; states are the last two letters."""
    repeat, beam = _repeats(word), {(0, 0, 0, ""): (0.0, None)}
    for at, ch in enumerate(word):
        beam = _step(beam, ch, repeat[at], cost)
    return _text(min(((so_far + cost.item(a, b, 0), out) for (_, a, b, _), (so_far, out) in beam.items()),
                     key=lambda e: e[0])[1])


def words_in(run: str, cost: np.ndarray) -> list[str]:
    """The words of a run whose spaces are lost: those of paths with word ends after any letter that cost
    at most ``MARGIN`` more than the best up to there. States also hold where their word began."""
    repeat, beam, found = _repeats(run), {(0, 0, 0, ""): (0.0, None)}, set()
    for at, ch in enumerate(run):
        beam = _step(beam, ch, repeat[at], cost)
        ended = [(total + cost.item(a, b, 0), text) for (_, a, b, _), (total, text) in beam.items() if b]
        most = min([t for t, _ in beam.values()] + [t for t, _ in ended]) + MARGIN
        found.update(_text(text) for total, text in ended if total <= most)
        beam = {k: v for k, v in beam.items() if v[0] <= most}
        if ended:
            beam[at + 1, 0, 0, ""] = (min(t for t, _ in ended), None)
    return sorted(found)


def _shortened(word: str, cost: np.ndarray) -> str:
    """Runs of five or more equal characters as four: where a further one is dropped no dearer than
    kept, the best path keeps at most two, and all paths drop the others alike."""
    def four(m):
        c = m[1]
        code = _CODE.get(c, 27)
        return m[0] if c.isalpha() and cost[code, code, code] < DROP else c * 4
    return _LONG.sub(four, word)


class _Classes(dict):
    """Code point -> the class of letters that it may stand for; None for what every path drops."""

    def __missing__(self, code: int) -> str | None:
        c = chr(code)
        got = _CLASS.get(c, c) if c.isalpha() or c in LOOKS else None
        self[code] = got
        return got


_CLASS = {x: letters[0] for c, letters in LOOKS.items() for x in (c, *letters)}    # i and l are one class
_classes = _Classes()
_AGAIN = re.compile(r"(.)\1+", re.S)


def skeleton(word: str) -> str:
    """The classes of a lower-case token's letters and look-alikes, runs folded. A lattice's paths
    choose letters of the same class, drop repeats of a symbol and whatever stands for no letter:
    all its words have the token's skeleton."""
    return _AGAIN.sub(r"\1", word.translate(_classes))


class Wanted:
    """Which tokens can be decoded to a word with a listed feature: those whose skeleton is that
    of a listed word or begins with that of a listed beginning."""

    def __init__(self, table: dict[str, float]):
        self.words = {skeleton(f) for f in table if not f.endswith("*")}
        self.starts = {skeleton(f[:-1]) for f in table if f.endswith("*")}
        self.lengths = sorted({*map(len, self.starts)})
        self.parts = self.words | self.starts
        self.part_lengths = sorted({*map(len, self.parts)})

    def token(self, core: str) -> bool:
        bones = skeleton(core)
        return bones in self.words or any(bones[:n] in self.starts for n in self.lengths)

    def run(self, text: str) -> bool:
        """Of a run of single characters, whose words may begin and end anywhere."""
        bones = skeleton(text)
        return any(bones[i:i + n] in self.parts for n in self.part_lengths for i in range(len(bones) - n + 1))


def _plain(text: str) -> str:
    """Without outer punctuation."""
    return text.strip(_EDGE_ASCII) if text.isascii() else _EDGE.sub("", text)


def _core(text: str) -> str:
    """Without outer punctuation that stands for no letter."""
    if not text.isascii():
        return _ENDS.sub("", _RUNS.sub("", text))
    for strip in (str.lstrip, str.rstrip):
        rest = strip(text, _RUNS_ASCII)
        if len(text) - len(rest) >= 3:
            text = rest
    return text.lstrip(_FORE_ASCII).rstrip(_AFT_ASCII)


def restored(word: bytes, cost: np.ndarray, wanted: Wanted | None = None) -> str:
    """The word that a token of a text stands for, in lower case without outer punctuation; with
    ``wanted`` the empty one where no decoding can give a listed feature."""
    return _restored(_core(word.decode("utf-8", "ignore").lower()), cost, wanted)


def _restored(core: str, cost: np.ndarray, wanted: Wanted | None) -> str:
    if len(core) > 2 and _ODD.search(core) and _LETTERS.search(core):
        if wanted and not wanted.token(core):
            return ""
        core = restore(_shortened(core, cost), cost)
    return _plain(core)


def spelt(text: bytes) -> list[bytes]:
    """The text's runs of single characters, without what parts them."""
    return [re.sub(rb"[\s._*-]+", b"", m[0]) for m in _SPELT.finditer(text)]


def respelt(run: bytes, cost: np.ndarray) -> list[str]:
    """The words that a run of single characters may stand for."""
    text = run.decode("ascii").lower()
    return [] if text.isdigit() else words_in(_shortened(text, cost), cost)


def readings(word: bytes, cost: np.ndarray, wanted: Wanted | None = None) -> set[str]:
    """The restored word, and of letters alone also the word as it stands (its repeats may be its own)."""
    text = word.decode("utf-8", "ignore").lower()
    plain = _plain(text)
    core = text if plain == text else _core(text)
    if not plain.isalpha():
        return {_restored(core, cost, wanted)}
    if plain == core and not _TWICE.search(plain):     # nothing to decode
        return {plain}
    return {plain, _restored(core, cost, wanted)}


def features(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)] if len(word) > 2 else []


def tokens(text: bytes) -> list[bytes]:
    """The text's words, and those that it spells out letter by letter."""
    return text.split() + spelt(text)


def _group_of(text: bytes) -> int:
    """The least hash of the text's five-word runs: near copies mostly share it."""
    words = text.lower().split()
    return min((hash_of(b" ".join(words[i:i + 5])) for i in range(max(1, len(words) - 4))), default=0)


def hash_of(x: bytes) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(x) - 2 ** 63


def _groups(batches):
    hold()
    for b in batches:
        data = b.column("text").cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("label"), pa.array([_group_of(x) for x in data], pa.int64()),
             b.column("text")], ["doc_id", "label", "grp", "text"])


_COUNTED = ("clean_0", "toxic_0", "clean_1", "toxic_1")     # by half of the sample


def _feature_counts(cost: np.ndarray):
    def run(batches):
        hold()
        counts: dict = {}
        for b in batches:
            for half, label, text in zip(b.column("half").to_pylist(), b.column("label").to_pylist(),
                                         b.column("text").cast(pa.binary()).to_pylist()):
                runs = spelt(text)
                words = {w for t in {*text.split(), *runs} for w in readings(t, cost)} | {w for t in runs for w in respelt(t, cost)}
                for f in {f for w in words for f in features(w)}:
                    c = counts.setdefault(f, [0, 0, 0, 0])
                    c[2 * half + label] += 1
        part = [*counts.items()]
        for lo in range(0, len(part), 100_000):
            rows = part[lo:lo + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f for f, _ in rows]), *(pa.array([c[i] for _, c in rows], pa.int64()) for i in range(4))],
                ["feature", *_COUNTED])
    return run


def calibrate(score: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of a logistic curve over the log odds of scores of documents that had no
    part in them; held near (1, 0), the firmer the fewer they are."""
    hold = 4 + HOLD / max(1, len(label))
    x, w = np.log(score / (1 - score)), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(w[0] * x + w[1])))
        grad = np.array([((p - label) * x).sum(), (p - label).sum()]) + hold * (w - [1, 0])
        h = p * (1 - p)
        hess = np.array([[(h * x * x).sum() + hold, (h * x).sum()], [(h * x).sum(), h.sum() + hold]])
        w = w - np.linalg.solve(hess, grad) * 0.8
        w[0] = max(w[0], 0.1)
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, keep: Column, cost: np.ndarray,
        sample: int = SAMPLE) -> tuple[float, dict[str, float], float, float]:
    """(base score, feature -> share, slope, shift) of features that make toxicity likelier.

    What reaches the driver is bounded by the sample: features of at least
    ``MIN_DOCS`` of its documents whose share is over the prior's, and a score of
    each of its documents.
    """
    drawn = labelled(docs, labels, "toxic", keep, sample)
    grouped = drawn.mapInArrow(_groups, "doc_id long, label int, grp long, text string")
    once = staged(grouped.groupBy("grp", "label").agg(F.min_by("text", "doc_id").alias("text"))
                  .select("label", "text", F.pmod("grp", F.lit(2)).cast("int").alias("half")))
    n, toxic = once.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not toxic:
        return 0.0, {}, 1.0, 0.0
    prior, counts = toxic / n, [F.col(c) for c in _COUNTED]
    share = lambda clean, bad: F.when(
        (clean + bad >= MIN_DOCS) & ((bad + SMOOTH * prior) / (clean + bad + SMOOTH) > min(0.4, 2 * prior)),
        (bad + SMOOTH * prior) / (clean + bad + SMOOTH))
    rows = (once.mapInArrow(_feature_counts(cost), "feature string, " + ", ".join(f"{c} long" for c in _COUNTED))
            .groupBy("feature").agg(*[F.sum(c).alias(c) for c in _COUNTED])
            .select("feature", share(counts[0] + counts[2], counts[1] + counts[3]).alias("both"),
                    share(counts[0], counts[1]).alias("first"), share(counts[2], counts[3]).alias("second"))
            .where("both IS NOT NULL OR first IS NOT NULL OR second IS NOT NULL").collect())
    table = {c: {r.feature: r[c] for r in rows if r[c] is not None} for c in ("both", "first", "second")}
    base, seen = prior / 2, []
    for half, other in ((0, "second"), (1, "first")):
        unseen = once.where(F.col("half") == half).select(F.col("label").cast("long").alias("doc_id"), "text")
        seen += score(unseen, (base, table[other], 1.0, 0.0), cost).collect()   # doc_id carries the label
    slope, shift = calibrate(np.array([r.score for r in seen]), np.array([r.doc_id for r in seen], float))
    return base, table["both"], slope, shift


class _Scores(dict):
    def __init__(self, base: float, table: dict[str, float], slope: float, shift: float, cost: np.ndarray):
        super().__init__()
        self.base, self.table, self.slope, self.shift, self.cost = base, table, slope, shift, cost
        self.wanted = Wanted(table)
        self.starts = {f[:-1]: share for f, share in table.items() if f.endswith("*")}

    def strongest(self, word: str) -> float:
        """The largest share of the features of a word of three letters or more."""
        got = self.table.get(word, self.base)
        for n in PREFIXES:
            if len(word) > n and (share := self.starts.get(word[:n], got)) > got:
                got = share
        return got

    def __missing__(self, word: bytes) -> float:
        got = max([self.strongest(w) for w in readings(word, self.cost, self.wanted) if len(w) > 2], default=self.base)
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = got
        return got


def keep_clean(docs: DataFrame, model: tuple[float, dict[str, float], float, float], cost: np.ndarray,
               at: float = 0.5) -> DataFrame:
    """The documents that score below ``at``, with all their columns."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((*model, cost))   # bounded by the sample

    def run(batches):
        hold()
        scores = _Scores(*sent.value)
        for b in batches:
            data = b.column("text").cast(pa.binary()).to_pylist()
            yield b.filter(pa.array([_score(scores, x or b"") < at for x in data], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def _score(scores: _Scores, text: bytes) -> float:
    runs = spelt(text)
    share = max(map(scores.__getitem__, {*text.split(), *runs}), default=scores.base)
    for run in runs:
        if not scores.wanted.run(run.decode("ascii").lower()):
            continue
        share = max([share, *(scores.table.get(f, scores.base) for w in respelt(run, scores.cost) for f in features(w))])
    if not 0 < share < 1:
        return share
    return 1 / (1 + math.exp(-(scores.slope * math.log(share / (1 - share)) + scores.shift)))


def score(docs: DataFrame, model: tuple[float, dict[str, float], float, float], cost: np.ndarray) -> DataFrame:
    """(doc_id, score) of every text."""
    sent = docs.sparkSession.sparkContext.broadcast((*model, cost))   # bounded by the sample

    def run(batches):
        hold()
        scores = _Scores(*sent.value)
        for b in batches:
            got = [_score(scores, x) for x in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(got, pa.float64())], ["doc_id", "score"])
    return texts(docs).mapInArrow(run, "doc_id long, score double")
