import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows and columns whose names clash."""
    long = " ".join(f"word{k % 997} and" for k in range(60_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", None, 4), (4, "one", "en", "s", 3), (5, "Two Words", None, "s", 9),
        (6, long, "en", "s", len(long)), (7, long, "en", "s", len(long)), (7, long, "en", "s", len(long)), (8, "É café ßtraße ΣΑΣ é 😀 x", "fr", "s", 30), (None, "no id here at all", "en", "s", 5),
        (9, "the MIT License and the Apache License, Version 2.0 cc by cc BY-NC 4.0", "en", "s", 60), (10, "a\x00b c\nd\ne\nd\nd", "en", "s", 5),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("n_shingles", "kept", "ids", "labels", "fingerprint", "rules", "classifier", "n_words", "hits", "component_id", "length"):
        df = df.selectExpr("*", f"'clash' as {name}")
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


