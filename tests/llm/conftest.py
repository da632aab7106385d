import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names that operators use inside
          "row long, ids string, word string, size long, target string, fingerprint string, score string, "
          "`list` string, new string, key string, range string, k int, digest string, copies int, old string")
EXTRA = (7, "x", "x", 7, "x", "x", "x", "x", "x", "x", "x", 7, "x", 7, "x")


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with clashing extra columns."""

    def make(*rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, *("en", "s")[len(row) - 2:])
            full.append((doc_id, text, lang, source, len(text or ""), *EXTRA))
        return spark.createDataFrame(full, SCHEMA)

    return make


LONG = "lorem ipsum dolor sit amet " * 20_000
#: Nulls, blanks, a repeated row, a row without id, a very long text, characters beyond ASCII.
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one word more"), (4, "one word more"), (None, "without an id"),
       (5, LONG), (6, "ſtraße naïve 𝔘nicode \x00 \x1c\x85 汉字"), (7, "12 34 !!", None, None)]


@pytest.fixture
def odd(docs):
    return docs(*ODD)


@pytest.fixture
def empty(docs):
    return docs()
