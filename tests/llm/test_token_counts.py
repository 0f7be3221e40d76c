import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from revlens.llm import token_counts
from tests.llm.helpers import ODD_TEXTS, SMALL, no_docs, odd_docs, pandas, table

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expected(text):
    return len((text or "").encode()), len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("chunk, overlap", [(token_counts.CHUNK_CHARS, token_counts.OVERLAP_CHARS), (256, 32), (64, 6)])
def test_table_against_the_library(spark, chunk, overlap):
    docs = pandas("documents", SMALL)
    got = token_counts.count_tokens(table(spark, "documents", SMALL), PATH, chunk=chunk, overlap=overlap).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == {k: expected(t) for k, t in zip(docs.doc_id, docs.text)}
    assert len(got) == len(docs) and all(r.over_limit == (r.n_tokens > 2048) for r in got)


@pytest.mark.parametrize("chunk, overlap", [(32_768, 512), (40, 4)])
def test_odd_rows(spark, chunk, overlap):
    """A text of 60,000 characters without white space widens the overlap until it is whole."""
    got = token_counts.count_tokens(odd_docs(spark), PATH, chunk=chunk, overlap=overlap).collect()
    assert len(got) == 13
    for r in got:
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_tokens) == expected(ODD_TEXTS[r.doc_id]), r.doc_id
    assert sorted(r.n_tokens for r in got if r.doc_id is None) == [0, expected("a text without an id")[1]]


def test_boundaries_are_common_offsets_and_not_white_space():
    text = "alpha,beta;gamma..delta" * 4
    first, second = (LIBRARY.encode(t, add_special_tokens=False) for t in (text[:60], text[36:]))
    left = token_counts.boundaries(first, 0, 36, 60)
    right = token_counts.boundaries(second, 36, 0, 24)
    same = {(x["at"], x["mark"]) for x in left} & {(x["at"], x["mark"]) for x in right}
    assert same and all(not text[at].isspace() for at, _ in same)
    whole = len(LIBRARY.encode(text, add_special_tokens=False).ids)
    n = {(x["at"], x["mark"]): x["n"] for x in left}
    m = {(x["at"], x["mark"]): x["n"] for x in right}
    assert all(n[p] + len(second.ids) - m[p] == whole for p in same)


def test_offsets_that_disagree_widen_the_overlap(spark, monkeypatch):
    """Words longer than the overlap: chunks cut them at different places and share no boundary."""
    rng = random.Random(8)
    text = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=70)) for _ in range(12))
    rounds, cut = [], token_counts._spliced
    monkeypatch.setattr(token_counts, "_spliced", lambda long, path, size, overlap:
                        rounds.append((size, overlap)) or cut(long, path, size, overlap))
    differ = []
    for at in range(56, len(text) - 64, 56):             # overlaps [at, at + 8)
        before, after = (LIBRARY.encode(text[a:a + 64], add_special_tokens=False) for a in (at - 56, at))
        runs = [{(a + x, a + y) for x, y in e.offsets if at <= a + x and a + y <= at + 8}
                for a, e in ((at - 56, before), (at, after))]
        marks = [{(x["at"], x["mark"]) for x in token_counts.boundaries(*e)}
                 for e in ((before, at - 56, 56, 64), (after, at, 0, 8))]
        differ.append(runs[0] != runs[1] and not marks[0] & marks[1])
    assert any(differ)
    docs = spark.createDataFrame([(1, text), (2, "a b c " * 30)], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, PATH, chunk=64, overlap=8).collect()}
    assert got == {1: expected(text), 2: expected("a b c " * 30)}
    assert rounds[0] == (64, 8) and len(rounds) > 1


@pytest.mark.parametrize("chunk, overlap", [(48, 24), (24, 12)])
def test_random_texts_without_spaces_and_with_marks(spark, chunk, overlap):
    rng = random.Random(3)
    pieces = ["a", "e", "\u0301", "\u0323", "ß", "İ", "Σ", "'s", "'ll", "3", "½", "…", "!", ".", " ", "\n", "你", "ﬁ", "☃", "👩\u200d🚀",
              "<|endoftext|>", "<|startoftext|>", "<|", "|>", "word", "\x1c", "\x85", "\u00a0"]
    docs = [(i, "".join(rng.choices(pieces, k=rng.randint(0, 150)))) for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(frame, PATH, chunk=chunk, overlap=overlap).collect()}
    wrong = [t for i, t in docs if got[i] != expected(t)]
    assert not wrong, wrong[:3]


def test_no_rows(spark):
    assert token_counts.count_tokens(no_docs(spark), PATH).collect() == []
