"""Rows that every operator on documents has to stand."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Columns whose names the operators use themselves.
CLASHES = ("batch", "body", "node", "root", "key", "hash", "code", "part", "score", "rest", "size", "unit", "words")

SENTENCE = "the quick brown fox jumps over the lazy dog while seventeen grey owls watch from an old oak tree"


def odd_rows():
    long = " ".join(f"w{i % 9000}" for i in range(40_000))
    return [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", "a", 4),
        (4, SENTENCE, "en", "a", None),
        (5, SENTENCE, "en", None, None),
        (5, SENTENCE, "en", None, None),
        (6, SENTENCE + " and nothing else at all", "en", "b", None),
        (7, "été où déjà", "fr", "b", None),
        (8, long, None, "b", None),
        (9, "!!! ### 123", "en", "c", None),
        (10, "word", "en", "c", None),
        (None, SENTENCE, "en", "a", None),
        (12, "x" * 100_000, "en", "a", None),
    ]


def documents(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)


def clashing(df):
    for name in CLASHES:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(name))
    return df


def in_folder(folder, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


def as_set(df):
    return sorted(map(tuple, df.collect()), key=repr)
