import pytest
from pyspark.sql import types as T

COLUMNS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    *[T.StructField(c, T.StringType()) for c in ("rec", "row", "key", "fp", "score", "x", "bucket", "epoch", "domain")],
])


def long_text():
    return " ".join(f"word{i % 977} und {i % 31}." for i in range(60_000))


def odd_rows():
    """Nulls, empty and very long texts, copies, repeated rows, shared and null ids."""
    many = "the thing that was in the house of them and there were others with it on that day"
    rows = [(1, "A b c d e f g", "en", "s1"), (2, "A b c d e f g", "en", "s1"), (2, "A b c d e f g", "en", "s1"),
            (3, "", "en", "s2"), (4, None, "de", "s2"), (5, "  \n\t ", None, None), (None, "no id here at all", "en", "s1"),
            (None, "no id here at all", "en", "s1"), (7, long_text(), "de", "s3"), (8, long_text(), "de", "s3"),
            (9, many, "en", None), (9, many + " too", "en", "s1"), (-3, many.upper(), "en", "s1"),
            (10, "<|endoftext|> and\u00a0more \x1c,, 're ''s 中文字 e\u0301.", "zh", "s4"), (11, "x", "en", "s4")]
    return [(i, t, lang, s, None if t is None else len(t), *("?" for _ in range(9))) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)
