import itertools

import pytest

_numbers = itertools.count()


@pytest.fixture
def stored(spark, tmp_path):
    """A frame written as Parquet and read again, in a given number of files."""

    def write(rows, schema, files=3):
        path = str(tmp_path / f"t{next(_numbers)}")
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
        return spark.read.parquet(path)

    return write


LONG = "lorem ipsum dolor " * 20_000
#: NULLs in every column, empty and very long texts, ties, repeated rows.
ODD = [
    (1, "Same words here, all of them the same.", "en", "b", 5), (2, "Same  words here, all of them the same.", "en", "b", 5), (3, "Same words here, all of them the same.", None, None, None),
    (4, None, "en", "b", 0), (5, "", "en", "a", 0), (6, " \t\n", "de", "a", 3), (None, "no id at all", None, "a", 1), (None, None, None, None, None),
    (7, LONG, "en", "c", len(LONG)), (8, "repeated row of text", "en", "a", 9), (8, "repeated row of text", "en", "a", 9), (9, "été ß 漢字 🙂 été", "fr", "c", 4), (10, "x", "de", "d", 1),
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd(stored):
    return stored(ODD, DOCS)


@pytest.fixture
def clashing(stored):
    """Columns with the names that operators use themselves."""
    names = ["kept", "_row", "_id", "_text", "size", "score", "target", "n", "_set", "_block", "_lang", "ids", "label"]
    return stored([(*r, *range(len(names))) for r in ODD], DOCS + "".join(f", {n} long" for n in names))


@pytest.fixture
def empty(stored):
    return stored([], DOCS, 1)
