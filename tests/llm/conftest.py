import pytest

SF = "/root/testdata/sf0.001"
FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text, lang, source) rows; ``more`` adds columns whose names operators use inside."""

    def make(rows, more=False):
        filled = [(*r, *["en", "s"][len(r) - 2 :]) if len(r) < 4 else r for r in rows]
        fields, extra = FIELDS, ()
        if more:
            names = ["row", "label", "score", "size", "fp", "place", "n_words", "slot", "key", "held_out", "kept", "words"]
            fields, extra = ", ".join([FIELDS, *[f"{n} string" for n in names]]), ("x",) * len(names)
        return spark.createDataFrame([(*r, len(r[1] or ""), *extra) for r in filled], fields)

    return make


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


#: Rows every operator on documents must take: nulls in every column, blank and very long texts, repeats.
ODD = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \t\n\x0b\x0c\r", "en", None),
    (4, "word " * 30_000, None, "a"),
    (5, "one two three four", "en", "b"),
    (5, "one two three four", "en", "b"),
    (None, "one two three four", "en", "b"),
    (None, None, None, None),
    (8, "é ß 一 😀 x" * 20, "fr", "ü"),
]


@pytest.fixture
def odd(documents):
    return documents(ODD, more=True)


@pytest.fixture
def empty(documents):
    return documents([])
