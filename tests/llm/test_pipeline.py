import hashlib

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from revlens.llm import private_terms
from tests.llm.helpers import SMALL, odd_docs, pandas, table
from tests.llm.test_decontaminate import folded
from tests.llm.test_near_dedup import brute
from tests.llm.test_private_terms import base


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before and after each stage, written and read between them."""
    top, docs, out = tmp_path_factory.mktemp("stages"), table(spark, "documents", SMALL), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{top}/{name}")
        after = spark.read.parquet(f"{top}/{name}")
        out[name] = docs.toPandas().set_index("doc_id"), after.toPandas().set_index("doc_id")
        docs = after
    return out


def test_stages_keep_the_columns_and_whole_rows(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        was, now = stages[name]
        assert list(now.columns) == list(was.columns) and now.index.is_unique and set(now.index) <= set(was.index)
        if name != "personal_data":
            assert now.sort_index().equals(was.loc[now.index].sort_index())


def test_toxic_documents_go_and_clean_ones_stay(stages):
    was, now = stages["toxicity"]
    labels = pandas("labels", SMALL).set_index("doc_id").toxic
    stays = labels.index.isin(now.index)
    assert (stays == (labels == 0)).mean() > 0.9


def test_near_duplicates_against_brute_force(stages):
    was, now = stages["near_dedup"]
    want = brute(was.text.to_dict())
    assert set(now.index) == {k for k, (_, _, kept) in want.items() if kept}


def test_contaminated_documents_go(stages):
    was, now = stages["decontamination"]
    needles = [folded(t) for t in pandas("benchmark", SMALL).text]
    want = {k for k, t in was.text.items() if not any(n in folded(t) for n in needles)}
    assert set(now.index) == want


def test_personal_data_is_masked_and_nothing_else_changes(stages):
    was, now = stages["personal_data"]
    assert set(was.index) == set(now.index)
    for k, t in was.text.items():
        assert (now.text[k] == t) == (base(t) == "") and base(now.text[k]) == ""


def test_last_stage_is_the_encoding(stages):
    was, now = stages["bpe"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for k, t in was.text.items():
        assert list(now.ids[k]) == library.encode(t, add_special_tokens=False).ids and now.n_tokens[k] == len(now.ids[k])


def test_last_stage_decodes_the_ids(stages):
    now = stages["bpe"][1]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for ids, digest in zip(now.ids, now.decoded_sha256):
        assert digest == hashlib.sha256(library.decode([*map(int, ids)], skip_special_tokens=False).encode()).hexdigest()


def test_run_gives_the_last_stage_and_odd_rows_pass(spark, stages):
    got = corpus_pipeline.run(spark, SMALL).toPandas().set_index("doc_id")
    assert set(got.index) == set(stages["bpe"][1].index)
    docs = odd_docs(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == odd_docs(spark).columns
        assert sorted(r.doc_id or 0 for r in docs.collect()) == (
            [0, 0, 1, *range(1, 11)] if name == "toxicity" else [0, 0, *range(1, 11)])
    assert private_terms.KINDS[0] == "email"
