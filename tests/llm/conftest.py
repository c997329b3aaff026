import pytest


@pytest.fixture
def docs(spark):
    """Documents with every oddity: nulls anywhere, empty, long and repeated texts, clashing columns."""
    long = " ".join(f"wort{i % 977} word{i}" for i in range(20_000))
    rows = [
        (1, "The cat sat on the mat with another cat today", "en", "a", 7),
        (1, "The cat sat on the mat with another cat today", "en", "a", 7),
        (2, "The cat  sat on the mat\nwith another cat today", "en", "a", 7),
        (3, None, "en", None, 7),
        (4, "", "de", "b", 7),
        (None, "ein Satz ohne Nummer und ohne Ende", "de", None, 7),
        (None, None, None, None, 7),
        (5, " \t\r\n", None, "b", 7),
        (6, "12345 !!", "de", "b", 7),
        (7, long, "en", "c", 7),
        (8, long + " tail", "en", "c", 7),
        (9, "日本語   é ß <|endoftext|> foo_bar", "de", "c", 7),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, nth int")


@pytest.fixture
def empty(docs):
    return docs.limit(0)
