import random

import pytest

FOLDER = "/root/testdata/sf0.001"
EXTRA = ["k1", "n_words", "marks", "kept", "score", "n_lines", "_k1", "_places", "base", "cid", "ids", "_ref_docs"]


@pytest.fixture(scope="session")
def make(spark):
    """Documents of (doc_id, text) rows, with nulls elsewhere, over several partitions."""

    def docs(data, partitions=4, extra=False):
        rows = [(doc, text, None, None, None) for doc, text in data]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        for name in EXTRA * extra:
            df = df.selectExpr("*", f"'x' as `{name}`")
        return df.repartition(partitions)

    return docs


@pytest.fixture(scope="session")
def real(spark):
    """The documents of the smallest folder, as a table and as rows."""
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty and blank texts, one very long one, ties, repeated rows."""
    long = " ".join(f"w{random.Random(1).randrange(50)}x{i % 977}" for i in range(30_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "A b"), (6, "x y z"), (6, "x y z"), (None, "q q q q q q"),
        (7, long), (8, long), (9, "é 日本 😀 \x00 end"), (10, "same " * 60), (11, "y" * 3000),
    ]


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
