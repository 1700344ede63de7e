import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, kept string, size string, row int, n string, content string, fp string, score string, key string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra columns with the names of working columns."""
    long_ = " ".join(f"word{i % 977} of the very long text." for i in range(40_000))
    rows = [
        (1, "The same text as another one, licensed under the MIT License.", "en", "a"),
        (2, "the same text as another one, licensed under the mit license.", "en", "a"),
        (2, "the same text as another one, licensed under the mit license.", "en", "a"),
        (None, "the same text as another one, licensed under the mit license.", None, None),
        (3, None, "en", "a"),
        (4, "", "de", None),
        (None, None, None, None),
        (5, long_, "en", "b"),
        (6, long_ + " end", "en", "b"),
        (7, "...\n...\n \t", "fr", "b"),
        (8, "Öl und Käse, alle Rechte vorbehalten. cc by cc by", "de", "c"),
        (8, "another text under the same id 42", "en", "c"),
        (9, "word\n" * 300, "en", None),
    ]
    extra = ("x", "y", "z", 1, "n", "c", "f", "s", "k")
    return spark.createDataFrame([(*r, 7, *extra) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return odd_docs.where("1 = 0")
