import pytest

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; documents may carry them as columns of their own.
CLASH = "score double, key long, rid long, h long, c long, cls long, node long, component long, grp long, p0 string, kept_id long, removable string, label int"
CLASH_NAMES = [c.split()[0] for c in CLASH.split(", ")]

PROSE = "The quick brown fox jumps over the lazy dog while the small river runs along the old mill and sings. "


def edge_rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows, a long text."""
    long = " ".join(f"word{i % 997} next{i}" for i in range(20_000))
    texts = [(1, PROSE * 3, "en", "s0"), (1, PROSE * 3, "en", "s0"), (2, None, "en", "s0"), (3, "", None, "s1"), (4, " \n\t ", "de", None),
             (None, PROSE * 2, "en", "s1"), (None, None, None, None), (5, long, "en", "s0"), (6, "x", "fr", "s2"), (7, "12 34", None, None),
             (8, PROSE * 3, "en", "s0"), (8, "Other words entirely, for one id twice.", "en", "s0"),
             (9, "mail a.b@c.de or +49 30 1234567, card 4111 1111 1111 1111, host 10.0.0.255", "de", "s1"),
             (10, "naïve Ünïcode 日本語 text 🙂 <|endoftext|> it's", "fr", "s2"), (2**40, "|".join("ab"), "es", "s2")]
    return [(i, t, l, s, None if t is None else len(t)) for i, t, l, s in texts]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOC)


@pytest.fixture(scope="session")
def clashing(spark):
    own = (0.5, 1, 2, 3, 4, 5, 6, 7, 8, "p", 9, "0:1", 1)
    return spark.createDataFrame([(*r, *own) for r in edge_rows()], f"{DOC}, {CLASH}")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
