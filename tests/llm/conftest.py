import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LINE = "the quick brown fox jumps over the lazy dog and runs away from the old grey wolf "


def rows():
    """Small documents with nulls, empty texts, ties, copies, near copies, shared passages, odd characters and clashing columns."""
    long = " ".join(f"w{i}" for i in range(400))
    near = long.replace("w200 ", "changed ")
    passage = " ".join(f"p{i}" for i in range(60))
    accents = "été où ça   naïve Ⓐ 😀 " * 12
    texts = [
        long, long, near, None, "", " ", "one", "one two", "One TWO", long.upper(), passage + " " + LINE, "x " + passage + "\n" + LINE * 4,
        LINE * 5 + "\n" + LINE * 5, "ab" * 300, accents, accents, "a\nb\n\n  \n" + LINE, LINE + "\nb", "  lone\r\nsep\tend ", "z" * 450,
    ]
    return [(i, t, ["en", "fr", None][i % 3], None if i % 4 == 0 else "s", None if t is None else len(t)) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def texts():
    return {r[0]: r[1] for r in rows()}


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_ids(spark):
    """Repeated and null ids, with columns whose names the operators use themselves."""
    base = [(1, LINE * 6, 5, "k"), (1, LINE * 6, 5, "k"), (None, LINE * 6, None, None), (2, None, 1, "z"), (None, None, 1, "z")]
    return spark.createDataFrame(base, "doc_id long, text string, key long, z string")
