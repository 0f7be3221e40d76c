"""Small inputs with every odd case, and the readers that tests share."""

import pyarrow.dataset as ds
from pyspark.sql import functions as F

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, row long, score double, label int, kept string"

ODD_TEXTS = {
    1: "The quick brown fox jumps over the lazy dog.",
    2: "",
    3: None,
    4: " \t\n ",
    5: "x" * 60_000,
    6: "word " * 20_000,
    7: "a\x1cb\x85c d e ́f ÀÉÎ Σίσυφος ΟΔΟΣ İstanbul ﬁne 你好 ☃ <|endoftext|>x<|startoftext|>",
    8: "mail me@example.com or 10.0.0.1, card 4111 1111 1111 1111, +1 (555) 123-4567",
    9: "one two three four",
    10: "it's we'll I'D 3x ½ ...!!! a_b-c",
}


def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, clashing extra columns."""
    rows = [(k, t, "en" if k % 2 else None, "s", k, 0.5, 1, "x") for k, t in ODD_TEXTS.items()]
    rows += [rows[0], (None, "a text without an id", None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def table(spark, name, sf_dir=SMALL):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pandas(name, sf_dir=SMALL):
    return ds.dataset(f"{sf_dir}/{name}.parquet").to_table().to_pandas()


def auc(label, score):
    pos, neg = score[label == 1], score[label == 0]
    return sum((p > neg).mean() + 0.5 * (p == neg).mean() for p in pos) / len(pos)


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def everyone():
    return F.lit(True)
