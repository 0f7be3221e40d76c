import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from revlens.llm import token_alignment
from revlens.llm.bpe_codec import byte_symbols
from tests.llm.helpers import MIDDLE, SCHEMA, SMALL, no_docs, odd_docs, pandas, table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def both(text):
    """((id, bytes) of A, (id, bytes) of B), or None."""
    t = Tokenizer.from_file(A) if not hasattr(both, "t") else both.t
    both.t, t.encode_special_tokens = t, True
    both.sp = sp = getattr(both, "sp", None) or sentencepiece.SentencePieceProcessor(model_file=B)
    back = {c: i for i, c in enumerate(byte_symbols())}
    e = t.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(back[c] for c in s)) for i, s in zip(e.ids, e.tokens)]
    b = []
    for i in sp.encode(text):
        p = sp.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p[:3] == "<0x" else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if text and b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else None


def spans(tokens):
    at, out = 0, []
    for i, x in tokens:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def brute(rows):
    """By comparing the byte ranges of all tokens of both sides, for each row by itself."""
    made, counts = [], Counter()
    for k, text in rows:
        got = both(text or "")
        if got is None:
            made.append((k, None))
            continue
        a, b = map(spans, got)
        links, low = [], 0
        for i, x, y in a:
            while b[low][2] <= x:
                low += 1
            at = low
            while at < len(b) and b[at][1] < y:
                links.append((i, b[at][0]))
                at += 1
        cuts = sorted({y for *_, y in a} & {y for *_, y in b})
        parts = [[[], []] for _ in cuts]
        for side, tokens in enumerate((a, b)):
            at = 0
            for i, _, y in tokens:
                at += y > cuts[at]
                parts[at][side].append(str(i))
        groups = ["|".join(map(",".join, p)) for p in parts]
        made.append((k, (len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest())))
        counts.update(links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted([(k, 0, 0, 0, 0, 0, 0, "") if m is None else
                   (k, *m[:3], len(m[3]), sum(counts[p] == most[p[1]] for p in m[3]), sum(counts[p] for p in m[3]), m[4])
                   for k, m in made], key=str)


def result(df):
    return sorted((tuple(r) for r in token_alignment.align(df, A, B).collect()), key=str)


@pytest.mark.parametrize("slice_bytes", [32 << 20, 20_000])
def test_small_table_against_brute_force(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(token_alignment, "SLICE_BYTES", slice_bytes)
    docs = pandas("documents", SMALL)
    docs = docs[docs.text.str.len() < 6000]
    df = table(spark, "documents").where("length(text) < 6000 OR text IS NULL")
    assert result(df) == brute([*zip(docs.doc_id, docs.text)])


def test_copies_weigh_as_often_as_they_occur(spark):
    docs = [(i, "the same words once more") for i in range(40)] + [(50, "the sameness of words"), (51, "  two  spaces "), (52, "<s>x</s><|endoftext|>")]
    df = spark.createDataFrame([(k, t, *[None] * 6) for k, t in docs], SCHEMA).repartition(4)
    got = result(df)
    assert got == brute(docs) and len(got) == len(docs)


def test_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in odd_docs(spark).collect()]
    got = result(odd_docs(spark))
    assert got == brute(rows)
    assert {r[1:] for r in got if r[0] in (2, 3)} == {(0, 0, 0, 0, 0, 0, "")}
    assert result(no_docs(spark)) == []


def test_middle_table_counts_agree_with_the_libraries(spark):
    """Whole table: the sums over all rows follow from the links alone."""
    got = token_alignment.align(table(spark, "documents", MIDDLE), A, B).toPandas()
    docs = pandas("documents", MIDDLE)
    assert len(got) == len(docs) and (got.n_links[got.n_a > 0] == (got.n_a + got.n_b - got.n_groups)[got.n_a > 0]).all()
    sample = docs.sort_values("doc_id").iloc[::23]
    by = got.set_index("doc_id")
    for k, t in zip(sample.doc_id, sample.text):
        e = both(t)
        assert (by.n_a[k], by.n_b[k]) == ((len(e[0]), len(e[1])) if e else (0, 0))


def test_cached_words_are_the_library_s():
    rng = random.Random(2)
    chars = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xA0, 0x250), *range(0x2010, 0x2028), 0x20AC]]
    chars += [" "] * 150 + ["'"] * 30 + ["\n"] * 20
    data = ["".join(rng.choices(chars, k=50)) for _ in range(3000)] + ["\x1c a", "a\x85b", "日本 語"]
    al = token_alignment.aligner(A, B)
    expected = [e.ids for e in al.a.encode_batch([" " + t for t in data], add_special_tokens=False)]
    assert all(got is None or got[0].tolist() == e for got, e in zip(al.encode(data), expected))
    assert sum(got is not None for got in al.encode(data)) > 100
