import pytest

#: Names that operators use for columns of their own.
CLASHES = ["k1", "k2", "key", "n_lines", "n_dropped", "__kept", "__drop", "__spans", "__k1", "__lines", "__uid", "uid", "fp", "node", "root", "part", "a.b"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)

#: Nulls, empty and blank texts, ties, repeats, long runs.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "a text without an id that is long enough to be read"), (4, "one two three four five six"),
    (4, "one two three four five six"), (5, "Ünïcödé 語 текст 😀 mail me: a.b@c.de, call +1 (555) 010-9999 or 10.0.0.1"), (6, "x" * 30_000),
    (7, " " * 5_000 + "tail"), (8, "word " * 20_000), (9, "!!!\n???\n...\n"), (10, "Released under the MIT License."), (11, "9" * 20_000), (None, None),
    (12, "0" * 5_001 + ".2.3.4"), (13, "0" * 5_001 + ".999.3.4 and 1.2.3." + "7" * 6_000),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *(f"{c} of {i}" for c in CLASHES)) for i, t in ODD], SCHEMA)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
