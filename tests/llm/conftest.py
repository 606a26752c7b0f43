import pytest

MID = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def mid():
    return MID


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, repeated rows, ties, further columns with clashing names."""
    import random
    rng = random.Random(3)
    long = words(rng, 30_000)
    rows = [(1, "", "en", "s", 0), (2, None, "en", "s", None), (None, "No id here, only text.", None, None, 3), (3, "same text here", "de", "s", 9),
            (3, "same text here", "de", "s", 9), (4, "same text here", "de", None, 9), (5, long, "en", "s", len(long)), (6, "   \n\t ", None, "s", 5),
            (7, "123 456 !!! ---", "en", "s", 9), (None, None, None, None, None), (8, "ünï 日本語 \U0001f600 text", "fr", "s", 4), (9, "word", "en", "s", 4)]
    clash = "score double, predicted int, key long, text_key long, fp long, component_id long, rid long, length long, block long, spans string, begin int, lang_pred string, licences string, c0 string"
    return spark.createDataFrame([r + (0.5, 1, 1, 1, 1, 1, 1, 1, 1, "s", 1, "l", "m", "c") for r in rows], f"{DOCS}, {clash}")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
