"""Small tables with what every operator must bear."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, _at long, row_number long"


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang); with columns whose names clash with those that operators make."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), 0.5, 7, 8, 9) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


ODD = [
    (1, "the cat sat on the mat and then it went away", "en"),
    (2, None, None),
    (3, "", "en"),
    (None, "no number here but words", "en"),
    (1, "the cat sat on the mat and then it went away", "en"),
    (4, " \n\t ", "de"),
    (5, "12345 !!! ###", "fr"),
    (6, "word " * 30_000, "en"),
    (7, "é中文 \U0001f600 ñandú", None),
    (8, "1," * 5_000, "en"),
    (9, "." * 20_000, "en"),
    (10, "see <|endoftext|> and <|startoftext|> here", "en"),
    (11, "QUJD+/" * 5_000, "en"),
]


def odd(spark):
    return documents(spark, ODD)


def empty(spark):
    return odd(spark).where(F.lit(False))


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
