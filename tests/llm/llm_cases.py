import pytest

SF_DIR = "/root/testdata/sf0.001"

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns named like what the operators make themselves.
CLASHING = (
    "fingerprint string, component_id long, copies long, size long, rank long, target double, text_sha256 string, "
    "score double, label double, piece int, n long, key long, spans string, base string, rows long, again boolean"
)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows and ids, and clashing extra columns."""
    words = " ".join(f"word{i % 997} Tail{i % 13}," for i in range(30_000))
    texts = [
        (1, "The cat sat on the mat and then it left again."),
        (2, "the CAT sat on the mat and then it left again."),
        (3, ""),
        (4, None),
        (5, " \t\n"),
        (6, words),
        (6, words),
        (7, "one"),
        (7, "two words"),
        (None, "The cat sat on the mat and then it left again."),
        (None, None),
        (8, "É password = 'abcdef12' ÀÉ idiot idiot IDIOT you! \U0001f600"),
        (9, words + " end"),
    ]
    rows = [(i, t, None if k % 3 else "en", None if k % 4 == 0 else "ab"[k % 2], None) for k, (i, t) in enumerate(texts)]
    names = [c.split()[0] for c in CLASHING.split(", ")]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    kinds = dict(c.split() for c in CLASHING.split(", "))
    return docs.selectExpr("*", *(f"cast(null as {kinds[n]}) as `{n}`" for n in names))


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
