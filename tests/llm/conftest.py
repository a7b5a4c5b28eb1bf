import pytest

LONG = "lorem ipsum dolor sit amet " * 8000
#: Columns that bear names which the operators use themselves.
EXTRA = (
    "_row long, _key string, _any string, row long, key long, n long, sig binary, cls long, block int, shard int, "
    "side int, region long, start long, spans string, kept boolean, copies long, recipe string, lang string"
)
AWKWARD = [
    (1, "Hello World, this is a plain text."), (1, "Hello World, this is a plain text."),
    (2, "hello world, THIS is a plain text."), (3, None), (None, None), (4, ""), (None, "mail me@example.com now"),
    (5, LONG), (6, LONG.upper()), (7, " \n\t "), (8, "one two three"), (9, "ONE two  three"),
    (None, "one two three"), (10, "日本語 テキスト 🎉 é ü"), (11, "123 456 !!!"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing column names."""
    names = "doc_id long, text string, " + EXTRA
    width = EXTRA.count(",") + 1
    rows = [(*r, *[None] * width) for r in AWKWARD]
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def no_documents(awkward):
    return awkward.where("false")
