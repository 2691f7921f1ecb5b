import pytest
from pyspark.sql import types as T

#: Columns beyond those that an operator reads, under names that operators use themselves.
EXTRA = ["fp", "key", "uid", "spans", "words", "id", "n_words", "kept", "packed", "x0", "grp"]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
    + [T.StructField(c, T.StringType()) for c in EXTRA]
)


@pytest.fixture(scope="session")
def documents(spark):
    """A maker of documents from (doc_id, text[, lang, source]) rows, with extra columns."""

    def make(rows):
        full = [
            (*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1]), *[f"{c} of {r[0]}" for c in EXTRA])
            for r in rows
        ]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Small corpus with the odd cases: nulls, empty texts, ties, repeated rows, a very long text."""
    import random

    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choice("abcdeénoßrstu") for _ in range(rnd.randint(1, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(rnd.choice(vocabulary) for _ in range(n))

    passage = prose(60)
    rows = [(i, f"{prose(rnd.randint(1, 120))}{rnd.choice([' ', chr(10)])}{prose(20)}.", "en", "a") for i in range(60)]
    rows += [(60 + i, f"{prose(40)} {passage} {prose(30)}", "fr", "b") for i in range(12)]
    rows[3] = (3, prose(140), "en", "a")
    rows += [(80 + i, rows[3][1], "en", None) for i in range(5)]
    rows += [(90, None, "en", "a"), (91, "", "en", "a"), (92, " \t\n", None, "a"), (None, rows[5][1], None, None)]
    rows += [(None, None, None, None), rows[7], rows[7], (93, prose(30_000), "de", "c"), (94, "日本語 \U0001f600 Σας İ", "xx", "c")]
    rows += [(95, "a" * 3000, "en", "a"), (96, "ab " * 400, "en", "a"), (97, passage[:49], "en", "a"), (98, passage, "en", "a")]
    return rows
