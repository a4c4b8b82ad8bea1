import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def docs(spark):
    """Build documents from (doc_id, text); extra columns have names that operators use inside."""

    def build(*rows):
        extra = "score double, id long, mark long, _id long, _mark long, _spans string, key long, part long, size long, digest binary, n_chars long"
        schema = f"doc_id long, text string, lang string, source string, {extra}"
        return spark.createDataFrame([(i, t, "en", "x", 0.5, 1, 2, 3, 4, "x", 5, 6, 7, b"8", None) for i, t in rows], schema)

    return build


LONG = " ".join(f"w{i * i % 9973}" for i in range(60_000))
# NULL and repeated ids, NULL and empty texts, white space only, control signs, a long text, repeated rows.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "the text without an id is here"), (4, "one"), (4, "one"), (4, "another one"),
    (5, LONG), (6, LONG + " more"), (7, "\x00\x1f\x7f"), (8, "Straße é ñ 漢字 😀"), (9, "."), (-3, "minus three is an id too"),
]


@pytest.fixture
def odd(docs):
    return docs(*ODD)


@pytest.fixture
def none(docs):
    return docs()
