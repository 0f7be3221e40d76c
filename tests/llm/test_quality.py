import numpy as np
from pyspark.sql import functions as F

from revlens.llm import quality, queries
from tests.llm.helpers import MIDDLE, auc, everyone, no_docs, no_labels, odd_docs, pandas


def test_held_out_accuracy(spark):
    got = queries.op3_quality(spark, MIDDLE).toPandas()
    assert len(got) == len(pandas("documents", MIDDLE)) and got.score.between(0, 1).all()
    assert ((got.score >= 0.5).astype(int) == got.predicted).all()
    out = got[got.held_out].merge(pandas("labels", MIDDLE), on="doc_id")
    assert auc(out.quality, out.score) > 0.95 and (out.predicted == out.quality).mean() > 0.93


def test_flat_trees_walk_as_nested_trees():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, len(quality.STATISTICS)))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] > 0)).astype(float)
    model = quality.fit(x, y)

    def walk(row):
        margin = np.log(model["base"] / (1 - model["base"]))
        for feature, cut, leaf in zip(model["feature"], model["cut"], model["leaf"]):
            at = 0
            while at < len(feature):
                at = 2 * at + (2 if row[feature[at]] > cut[at] else 1)
            margin += leaf[at - len(feature)]
        return 1 / (1 + np.exp(-margin))
    got = quality.predict(model, x)
    assert np.allclose(got, [walk(r) for r in x]) and ((got >= 0.5) == (y == 1)).mean() > 0.95


def test_odd_rows_one_class_and_no_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (8, 0, 0), (None, 1, 1), (8, None, None), (77, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    assert len(quality.classify(odd_docs(spark), labels, everyone()).collect()) == 13
    ones = labels.where("quality = 1")
    assert {r.score for r in quality.classify(odd_docs(spark), ones, everyone()).collect()} == {1.0}
    assert {r.score for r in quality.classify(odd_docs(spark), no_labels(spark), everyone()).collect()} == {0.5}
    assert quality.classify(no_docs(spark), labels, F.lit(True)).collect() == []
