import pytest

ODD = "documents with null, empty and very long texts, repeated rows and ids, and clashing columns"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """NULLs in every column, empty and long texts, ties, repeats, columns named like derived ones."""
    long = " ".join(f"wort{i % 977} und, so weiter." for i in range(30000))
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    rows = [
        (1, base, "en", "keep"),
        (2, base, "en", None),
        (2, base, "en", None),
        (3, None, None, None),
        (4, "", "en", "x"),
        (5, long, "de", "y"),
        (6, long + " ende", "de", "y"),
        (None, base, "en", "z"),
        (None, None, None, None),
        (7, "  \n\n \t x\r\ny ", "fr", "q"),
        (8, "Don't STOP 12345 — naïve café's <|endoftext|> ÀÉ Straße é ﬁn İstanbul ΟΔΥΣΣΕΥΣ, a\x1cb 'S 'll'd", "fr", "q"),
        (9, base.upper(), "en", "q"),
        (7, "another text under an id that is taken", "fr", "q"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, hash string").selectExpr(
        "*", "doc_id as id", "text as digest", "1 as n", "lang as row", "doc_id as source", "1L as n_chars"
    )
