import random

import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
#: Names that operators use for their own columns.
CLASHING = (
    "ids bytes hits spans base lang_pred score held_out id mark start units found kept n_words "
    "matches fp root component_id items copies no piece title"
).split()


def corpus(seed: int = 1) -> list[tuple]:
    """Shared passages, near and exact copies, nulls, empty, long and repeated rows."""
    r = random.Random(seed)
    vocabulary = ["a", "bb", "É", "word", "X1", "Ñ", "foo", "Bar", "baz", "été"]

    def text(n):
        return "".join(r.choice(vocabulary) + r.choice([" ", " ", "\n", "  ", "\t"])
                       for _ in range(n))

    passages = [text(40) for _ in range(4)]
    rows = []
    for i in range(100):
        kind, t = r.random(), text(r.randrange(60))
        if kind < 0.6:
            t = text(r.randrange(20)) + r.choice(passages) + text(r.randrange(20))
            if r.random() < 0.4:
                j = r.randrange(len(t) - 1)
                t = t[:j] + "Z" + t[j + 1:]
        elif kind < 0.7 and rows:
            t = r.choice(rows)[1]
        rows.append((i, t))
    rows += [
        (500, None), (501, ""), (502, " \n "), (503, "ab " * 4000), (503, "ab " * 100),
        (504, "x" * 30_000), rows[0], rows[0], (-5, passages[0]), (None, passages[1] + "end"),
        (None, None),
    ]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


def frame(spark, rows, extra=True):
    """Rows as ``documents`` over several partitions, with columns that clash."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    df = df.withColumns({
        "lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return df.withColumns({c: F.lit(c) for c in CLASHING}) if extra else df


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()


def ordered(rows) -> list:
    return sorted((tuple(r) for r in rows), key=repr)
