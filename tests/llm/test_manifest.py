import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from revlens.llm import manifest, queries
from revlens.llm.common import crc_mod
from tests.llm.helpers import MIDDLE, SMALL, no_docs, odd_docs, pandas

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    shown = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha(*["-" if v is None else f"{len(v.encode())}:{v}" for v in shown])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def way(tree, at):
    """(left, right) siblings of node ``at``, level by level."""
    for nodes in tree[:-1]:
        lo = at // 8 * 8
        yield nodes[lo:at], nodes[at + 1:lo + 8]
        at //= 8


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    rows = sorted(rows, key=lambda r: (r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, leaf(*r)))
    langs = [*dict.fromkeys(r[2] for r in rows)]
    trees = {x: levels([leaf(*r) for r in rows if r[2] == x]) for x in langs}
    top = levels([trees[x][-1][0] for x in langs])
    out, at = [], dict.fromkeys(langs, 0)
    for r in rows:
        path = [*way(trees[r[2]], at[r[2]]), *way(top, langs.index(r[2]))]
        at[r[2]] += 1
        text = r[4]
        if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        h = leaf(*r[:4], text)
        for left, right in path:
            h = sha(*left, h, *right)
        out.append((r[0], leaf(*r), trees[r[2]][-1][0], top[-1][0], sha(*[x for left, right in path for x in left + right]), h, h == top[-1][0]))
    return sorted(out, key=str)


def proofs(df):
    tampered = (crc_mod(F.col("doc_id"), 3) == 0) & F.col("doc_id").isNotNull()
    return manifest.proofs(df, tampered)


def result(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in proofs(df).collect()), key=str)


@pytest.mark.parametrize("sf_dir", [SMALL, MIDDLE])
def test_tables_against_brute_force_and_sql(spark, sf_dir):
    docs = pandas("documents", sf_dir)
    expected = brute([*zip(docs.doc_id, docs.source, docs.lang, docs.n_chars, docs.text)])
    got = queries.op12_merkle_manifest(spark, sf_dir)
    assert sorted(map(tuple, got.collect()), key=str) == expected
    assert 0 < sum(not r[-1] for r in expected) < len(expected)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    assert sorted(con.execute(manifest.PROOFS_SQL).fetchall(), key=str) == expected


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 2, 8, 9, 64, 65, 1, 70, 3, 600], [2] * 9])
def test_shapes_of_trees(spark, sizes):
    rng = random.Random(1)
    rows = [(rng.randrange(10 ** 9), f"Text {k} of {i}", None if k == 3 else f"l{k}" if k else "", "s" if i % 3 else None, i)
            for k, n in enumerate(sizes) for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(df) == brute([(d, s, x, n, t) for d, t, x, s, n in rows])


def test_odd_rows(spark):
    df = odd_docs(spark).withColumn("n_chars", F.col("row")).withColumn("leaf", F.lit("clash")).withColumn("tree", F.lit(3))
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]
    got = result(df)
    assert got == brute(rows) and len(got) == len(rows)
    assert all(r[-1] for r in got if r[0] is None)
    assert result(no_docs(spark).withColumn("n_chars", F.col("row"))) == []


def test_one_language_of_copies(spark):
    rows = [(7, "The Same", "en", "s", 8)] * 100
    got = result(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert got == brute([(7, "s", "en", 8, "The Same")] * 100)


def test_paths_lead_to_the_root(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for r in proofs(docs).limit(20).collect():
        h = r.leaf
        for s in r.path:
            h = sha(s.left, h, s.right)
        assert h == r.root
