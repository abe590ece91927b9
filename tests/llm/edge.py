"""Rows that every operator has to take: nulls, empty, long, repeated, and clashing columns."""

LONG = "word " * 30_000 + "end."
ROWS = [
    (1, "The cat sat on the mat, and the dog was in the house with them.", "en", "a", 64),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \t\n ", "en", "", 4),
    (5, LONG, "en", "a", len(LONG)),
    (6, "The cat sat on the mat, and the dog was in the house with them.", "en", "b", 64),
    (6, "The cat sat on the mat, and the dog was in the house with them.", "en", "b", 64),
    (7, "Ein Satz mit Umlauten: äöü ÄÖÜ ß.\nUnd noch eine Zeile 😀 日本語.", "de", "c", 60),
    (None, "A text without an id, which is still a text of some length here.", "en", "d", 64),
    (-8, "one", "en", "a", 3),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(spark, *names):
    """The documents with more columns, of the given names and of another type."""
    frame = documents(spark)
    for name in names:
        frame = frame.selectExpr("*", f"array('x') AS {name}")
    return frame


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
