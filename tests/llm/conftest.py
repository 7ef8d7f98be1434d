import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows with nulls, empty, blank and long texts, ties, repeats, and columns that clash."""
    long_text = " ".join(f"word{i % 5000} the" for i in range(120_000))
    texts = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "src1"),
        (1, "the quick brown fox jumps over the lazy dog", "en", "src1"),
        (2, "the quick brown fox jumps over the lazy dog", "en", None),
        (3, None, "en", "src1"),
        (4, "", None, "src2"),
        (5, " \n\t ", "de", "src9"),
        (6, "ab", "de", ""),
        (None, "the quick brown fox jumps over the lazy dog", "fr", "src9"),
        (None, None, None, None),
        (7, long_text, "en", "src14"),
        (8, long_text + " ", "en", "src14"),
        (9, "a\n\nb\nc\nd\nx\nb\nc\nd\n", "es", "src3"),
        (10, "É ÄÖ 你好 \U0001f600 \x85", "fr", "src3"),
    ]
    rows = [(*r, None if r[1] is None else len(r[1]), "x", 1, 2, "y", 3, "z") for r in texts]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, _salt string, fp int, "
        "_leaf int, _keep_id string, Log_Weight int, _epochs string"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}
