import pytest

from starmart.llm.common import ready

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(autouse=True)
def prepared(spark):
    ready(spark)


@pytest.fixture
def frame(spark):
    """Documents of (doc_id, text) with an extra column whose name an operator also uses."""

    def make(rows, source="s"):
        rows = [(i, t, "en", source, None if t is None else len(t), 5) for i, t in rows]
        return spark.createDataFrame(rows, SCHEMA + ", n_words int").repartition(3)

    return make


#: null and empty texts, white space only, ties, repeated rows, a row without id, and a very long text
LINE = "the quick brown fox jumps over the lazy dog by the river"
ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b\r\n "), (4, LINE), (4, LINE), (5, f"  {LINE.upper()}\nshort"), (None, LINE + "\n" + LINE),
    (6, "été ÀÉ ünï \U0001f600 " * 40), (7, "a b " * 30_000), (8, "\n".join(f"line number {i} of a long text" for i in range(3000))),
]
