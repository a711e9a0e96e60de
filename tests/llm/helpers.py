"""Small awkward inputs shared by the operator tests."""

from pyspark.sql import functions as F

# Names that operators use for columns of their own.
CLASHING = ("weight", "toxic", "row", "key", "units", "segment", "node", "hub", "block", "kept", "digest", "band", "row_id", "n_words")
AWKWARD = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, shard int, fp bigint, n long"


def awkward(spark):
    """Nulls everywhere, empty and long texts, repeated rows, and columns that clash with results."""
    rows = [
        (1, "alpha beta gamma delta " * 30, "en", "a", 1, 0.1, 3, 7, 1), (1, "alpha beta gamma delta " * 30, "en", "a", 1, 0.1, 3, 7, 1),
        (2, "alpha beta gamma delta " * 30, None, None, None, None, None, None, None), (3, None, "en", "a", 0, 0.0, 1, 1, 1),
        (4, "", "en", "a", 0, 0.0, 1, 1, 1), (None, "no id here", "en", "a", 2, 0.0, 1, 1, 1), (5, " \n\t ", "en", "a", 2, 0.0, 1, 1, 1),
        (6, "x" * 30_000, "en", "a", 2, 0.0, 1, 1, 1), (7, "word " * 20_000, "en", "a", 2, 0.0, 1, 1, 1), (8, "é ß  ü", "en", "a", 2, 0.0, 1, 1, 1),
    ]
    return clashing(spark.createDataFrame(rows, AWKWARD))


def clashing(frame):
    return frame.withColumns({c: F.lit("a text") for c in CLASHING})


def empty(spark):
    return clashing(spark.createDataFrame([], AWKWARD))
