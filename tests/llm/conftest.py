import pytest

LONG = "word. Other words! " * 9000
#: Texts with every awkward case: null, empty, blank, ties, long, odd spaces, other scripts.
TEXTS = [None, "", " ", "\n\n", "a", "same text twice", "same text twice", "  two  spaces \n and\n\n  lines ", "tab\tand space wide\x1cfile", "don't I'll we've 12345 67 §$%&", "日本語のテキスト 한국어 עברית", "é é ŉ Σας ΟΔΟΣ", "<|endoftext|> is text", "x" * 3000, "the " * 50, "😀😀 family 👨‍👩‍👧", LONG, "trailing space ", "trailing \n", " leading", "a \nb", "a\n b", "a\n\n  b"]


@pytest.fixture(scope="session")
def docs(spark):
    """Rows out of order, a repeated row, a null id, and further columns, one named like an output."""
    rows = [(3 * i % 23, t, "src0", "en", "clash") for i, t in enumerate(TEXTS)] + [(None, "no id here", None, None, None), (5, TEXTS[15 * 23 % 23], "src1", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_tokens string").repartition(3)


@pytest.fixture(scope="session")
def none(docs):
    """An empty table."""
    return docs.where("false")
