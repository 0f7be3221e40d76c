import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from revlens.llm import simhash
from tests.llm.helpers import MIDDLE, SCHEMA, SMALL, no_docs, odd_docs, pandas, table


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    runs = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    """(doc_id, fingerprint, component) of each row, by comparing all pairs of distinct fingerprints."""
    prints = [(k, plain_fingerprint(t)) for k, t in rows]
    distinct = sorted({p for _, p in prints})
    root = {p: p for p in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    x = np.array(distinct, np.uint64)
    for i, p in enumerate(distinct):
        for q in x[i + 1:][np.bitwise_count(x[i + 1:] ^ x[i]) <= 4].tolist():
            root[find(q)] = find(p)
    least = {}
    for k, p in prints:
        if k is not None:
            least[find(p)] = min(k, least.get(find(p), k))
    return sorted(((k, f"{p:016x}", least.get(find(p))) for k, p in prints), key=str)


def result(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)


def frame(spark, docs):
    return spark.createDataFrame([(k, t, *[None] * 6) for k, t in docs], SCHEMA)


@pytest.mark.parametrize("sf_dir", [SMALL, MIDDLE])
def test_tables_against_brute_force(spark, sf_dir):
    docs = pandas("documents", sf_dir)
    got = result(table(spark, "documents", sf_dir))
    assert got == brute([*zip(docs.doc_id, docs.text)])
    assert len({c for *_, c in got}) < len(got)


def test_masks_cover_every_pair_within_the_radius():
    for masks, free in [(simhash.MASKS, range(64))] + [
            (inner, [p for p in range(64) if not m >> p & 1]) for m, inner in zip(simhash.MASKS[:3], simhash._INNER)]:
        rng = random.Random(3)
        for _ in range(3000):
            differ = sum(1 << p for p in rng.sample([*free], rng.randint(0, 4)))
            assert any(differ & m == 0 for m in masks)
    assert max(64 - m.bit_count() - i.bit_count() for m, masks in zip(simhash.MASKS, simhash._INNER) for i in masks) <= 17


def test_forest_spans_what_all_pairs_link():
    rng = np.random.default_rng(4)
    x = np.unique(rng.integers(0, 2 ** 14, 900).astype(np.uint64) << np.uint64(20))
    edges = [(int(c), int(p)) for cs, p in simhash.forest(x) for c in cs]
    pairs = {(a, b) for a, b in combinations(x.tolist(), 2) if (a ^ b).bit_count() <= 4}
    assert all(tuple(sorted(e)) in pairs for e in edges)

    def classes(pairs):
        root = {v: v for v in x.tolist()}

        def find(v):
            while root[v] != v:
                v = root[v]
            return v
        for a, b in pairs:
            root[find(a)] = find(b)
        groups = {}
        for v in root:
            groups.setdefault(find(v), set()).add(v)
        return sorted(map(sorted, groups.values()))
    assert classes(edges) == classes(pairs) and len(edges) == len(x) - len(classes(pairs))


@pytest.mark.parametrize("full", [8192, 4])
def test_hot_groups_and_full_buckets(spark, monkeypatch, full):
    monkeypatch.setattr(simhash, "FULL", full)
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    base = [word() for _ in range(300)]
    docs = [(i, " ".join(base[:i % 290] + [word()] + base[i % 290 + 1:])) for i in range(100, 400)]     # near copies
    docs += [(i, " ".join(base)) for i in range(500, 700)]                                             # exact copies
    docs += [(i, " ".join(word() for _ in range(40))) for i in range(800, 900)]
    docs += [(i, None) for i in range(900, 940)]
    assert result(frame(spark, docs)) == brute(docs)


def test_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in odd_docs(spark).collect()]
    got = result(odd_docs(spark))
    assert got == brute(rows) and len(got) == len(rows)
    by = {k: (f, c) for k, f, c in got}
    assert by[2] == by[3] == by[4] == ("0" * 16, 2)                       # empty, null and blank are linked
    lone = simhash.near_duplicates(frame(spark, [(None, "a b c d e f"), (7, "x"), (7, "other words here")])).collect()
    assert {(r.doc_id, r.component_id) for r in lone} == {(None, None), (7, 7)} and len(lone) == 3
    assert simhash.near_duplicates(no_docs(spark)).collect() == []


def test_long_text_in_chunks(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 64)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text.decode())
