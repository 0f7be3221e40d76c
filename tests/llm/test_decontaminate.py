import random
import re

import numpy as np

from revlens.llm import decontaminate, queries
from tests.llm.helpers import MIDDLE, no_docs, odd_docs, pandas


def folded(text):
    return " ".join(re.findall(r"[^\W_]+", (text or "").lower()))


def best_edits(item, text):
    """Edits of the item's best alignment anywhere in the text (both folded)."""
    x, cells = np.frombuffer(text.encode(), np.uint8), np.zeros(len(text.encode()) + 1, np.int64)
    step = np.arange(len(cells))
    for c in item.encode():
        new = np.concatenate([[cells[0] + 1], np.minimum(cells[:-1] + (x != c), cells[1:] + 1)])
        cells = np.minimum.accumulate(new - step) + step
    return int(cells.min())


def test_table_against_brute_force(spark):
    docs, items = pandas("documents", MIDDLE), pandas("benchmark", MIDDLE)
    got = {r.doc_id: list(r.item_ids) for r in queries.op9_decontaminate(spark, MIDDLE).collect()}
    index = decontaminate.Index(list(zip(items.item_id.tolist(), items.text)))
    budget = dict(zip(index.ids, index.budget.tolist()))
    needle = {i: folded(t) for i, t in zip(items.item_id, items.text)}
    some = random.Random(1).sample(range(len(docs)), 30)
    for n, (k, t) in enumerate(zip(docs.doc_id, docs.text)):
        text = folded(t)
        exact = {i for i, x in needle.items() if x in text}
        assert exact <= set(got[k])
        if n in some or set(got[k]) != exact:
            assert set(got[k]) == {i for i, x in needle.items() if best_edits(x, text) <= budget[i]}


def edited(rng, text, edits):
    for _ in range(edits):
        at, kind = rng.randrange(len(text)), rng.randrange(3)
        text = text[:at] + ("" if kind == 0 else rng.choice("qz")) + text[at + (kind != 1):]
    return text


def test_edits_within_the_budget_are_found():
    rng = random.Random(9)
    make = lambda n: " ".join("".join(rng.choices("abcdefghijkl", k=rng.randint(2, 8))) for _ in range(n))
    items = [(i, make(rng.randint(4, 60))) for i in range(40)]
    index = decontaminate.Index(items)
    for n, (i, x) in enumerate(items):
        k = int(index.budget[n])
        for edits in range(0, k + 4):
            body = edited(rng, x, edits)
            text = f"{make(30)} {body} {make(30)}"
            true = best_edits(folded(x), folded(text))
            got = index.search(text)
            assert (i in got) == (true <= k) and got.get(i, true) == true
            assert index.search_all([make(5), text, ""])[1] == got


def test_case_space_and_short_items():
    index = decontaminate.Index([(1, "The Quick, brown FOX jumps"), (2, "Tiny one"), (3, ""), (4, "!!"), (1, "The Quick, brown FOX jumps")])
    assert index.search("xx the  quick\nBROWN fox -- jumps yy") == {1: 0}
    assert index.search("tiny ONE!") == {2: 0} and index.search("a tiny one here") == {} and index.search("") == {}


def test_odd_rows_empty_tables_and_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(7, "quick brown fox jumps over the lazy", 1), (8, None, 2), (None, "mail me", 3)],
                                  "item_id long, text string, row int")
    none = spark.createDataFrame([], items.schema)
    for size in (decontaminate.BLOCK_BYTES, 8):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        got = decontaminate.contaminated(odd_docs(spark), items).collect()
        assert len(got) == 13 and sorted((r.doc_id, r["items"][0].item_id) for r in got if r["items"]) == [(1, 7), (1, 7)]
        kept = decontaminate.clean(odd_docs(spark), items)
        assert kept.columns == odd_docs(spark).columns and kept.count() == 11
    assert all(not r["items"] for r in decontaminate.contaminated(odd_docs(spark), none).collect())
    assert decontaminate.clean(no_docs(spark), items).collect() == []
