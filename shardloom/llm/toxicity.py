"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: density of lexicon words, of lexicon words near a second-person word, of
lexicon words behind digits and symbols ("1d10t"), of second-person words; shares of capitals,
capitalised words, punctuation, exclamation and question marks, digits, tokens that mix letters
with digits or symbols; length.  The lexicon is learned: words that are far more frequent in toxic
training documents than their share allows.  Near copies would make any word of a copied text look
so, hence documents count once for each MinHash value of their words.

Learning takes about ``ROWS`` labelled documents at most, drawn by a hash of the id, none of them
of the held-out fold.  One fold of the others only calibrates.  Trees and calibration are Spark's
own; only the lexicon (``LEXICON`` words at most) comes to the driver.

Defined results: null and empty texts have all features 0 and are scored like others; documents
without a label, or with a null one, teach nothing; without labels of both classes every score is
the share of toxic ones (0 without any); very long texts are measured whole; repeated rows are scored
each; equal features get equal scores, and a score of 0.5 counts as toxic; an empty table gives an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm.common import Query, cut, fold, read, shared_folder, small

#: Labelled documents that are learned from, about; words of the lexicon.
ROWS = 20_000
LEXICON = 200

#: A lexicon word: so many toxic documents at least, so many standard deviations over its share,
#: and this share of its documents toxic.
LEAST_DOCUMENTS, LEAST_DEVIATIONS, LEAST_SHARE = 4, 5.0, 0.6

#: Words on either side in which a second-person word counts as near.
NEAR = 5

#: Second-person words; characters that stand for letters.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine deinen "
    "deiner ihr euch euer usted ustedes ti contigo tus vosotros".split()
)
LOOKALIKES = str.maketrans("01345789@$!|+", "oieastbgasiit")

LETTERS = re.compile(r"[^\W\d_]+")
BROKEN = re.compile(r"[^\W\d_][0-9@$!|+*]+[^\W\d_]")

FOLDS, CALIBRATES = 5, 1


def features(text: str | None, lexicon: frozenset[str]) -> list[float]:
    """The dense features of one text."""
    text = text or ""
    low = text.lower()
    words = LETTERS.findall(low)
    tokens = text.split()
    n, chars = max(len(words), 1), max(len(text), 1)
    hits = [i for i, word in enumerate(words) if word in lexicon]
    second = [i for i, word in enumerate(words) if word in SECOND_PERSON]
    near = 0
    for i in hits:
        k = bisect_left(second, i - NEAR)
        near += k < len(second) and second[k] <= i + NEAR
    broken = [token for token in tokens if not token.isalpha() and BROKEN.search(token)]
    # Marks around a token are marks, those inside it stand for letters.
    plain = (token.lower().strip("!|+.,;:?()").translate(LOOKALIKES) for token in broken)
    hidden = sum(word in lexicon for token in plain for word in LETTERS.findall(token))
    capitals = sum(map(str.isupper, text)) if low != text else 0
    shouted = sum(len(token) > 2 and token.isupper() for token in tokens) if capitals else 0
    marks = text.count("!") + text.count("?")
    points = marks + sum(map(text.count, ".,;:"))
    return [
        float(len(words)),
        len(hits) / n,
        float(len(hits)),
        near / n,
        float(hidden),
        len(broken) / max(len(tokens), 1),
        len(second) / n,
        capitals / chars,
        shouted / max(len(tokens), 1),
        marks / chars,
        points / chars,
        sum(map(text.count, "0123456789")) / chars,
        len(low) / n,
    ]


def features_of(spark: SparkSession, text: Column, lexicon: list[str]) -> Column:
    sent = spark.sparkContext.broadcast(frozenset(lexicon))

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series([features(text, sent.value) for text in texts])

    return measured(text)


def learn_lexicon(labelled: DataFrame, most: int = LEXICON) -> list[str]:
    """Words of ``labelled`` (text, label) that point to toxic documents."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    docs = labelled.select("label", words.alias("words")).where(F.size("words") > 0)
    docs = docs.withColumn("like", F.array_min(F.transform("words", lambda word: F.xxhash64(word))))
    share = docs.agg(F.avg("label")).first()[0]
    if not share or share == 1:
        return []
    n, toxic = F.col("n"), F.col("toxic")
    rows = (
        docs.select(F.explode("words").alias("word"), "like", "label")
        .groupBy("word", "like")
        .agg(F.max("label").alias("label"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic"))
        .where(
            (toxic >= LEAST_DOCUMENTS)
            & (toxic >= n * LEAST_SHARE)
            & (toxic - n * share >= LEAST_DEVIATIONS * F.sqrt(n * share * (1 - share)))
        )
        .orderBy(((toxic - n * share) / F.sqrt(n)).desc(), "word")
        .limit(most)
        .collect()
    )
    return [row["word"] for row in rows]


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """``(part, label, text)``: labelled documents outside the held-out fold, ``rows`` about."""
    known = labels.where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold(F.col("doc_id"), FOLDS) != 0)
    ).select(
        F.col("doc_id").alias("label_id"),
        F.col("toxic").cast("double").alias("label"),
        fold(F.col("doc_id"), FOLDS).alias("part"),
    )
    share = min(1.0, rows / max(known.count(), 1))
    draw = F.pmod(F.xxhash64(F.lit(5), "label_id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = small(known.where(draw < share))
    return docs.select("doc_id", "text").join(drawn, F.col("doc_id") == F.col("label_id")).select("part", "label", "text")


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, score)`` for every row of ``docs``."""
    spark = docs.sparkSession
    shared_folder(spark)
    labelled = cut(training_rows(docs, labels))
    counts = {row["label"]: row["count"] for row in labelled.groupBy("label").count().collect()}
    if len(counts) < 2:
        only = 1.0 if counts.get(1.0) else 0.0
        return docs.select("doc_id", F.lit(only).alias("score"))
    lexicon = learn_lexicon(labelled)
    measured = cut(
        labelled.select(
            "part", "label", array_to_vector(features_of(spark, F.col("text"), lexicon)).alias("features")
        ).coalesce(8)
    )
    apart = measured.where(F.col("part") == CALIBRATES).groupBy("label").count()
    split = apart.where("count >= 5").count() == 2 and (
        measured.where(F.col("part") != CALIBRATES).select("label").distinct().count() == 2
    )
    grown = measured.where(F.col("part") != CALIBRATES) if split else measured
    trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, seed=5, minInstancesPerNode=5).fit(grown)

    def raw(rows: DataFrame) -> DataFrame:
        return trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])

    held = measured.where(F.col("part") == CALIBRATES) if split else measured
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(
        raw(held).select("raw", "label")
    )
    rows = docs.select(
        "doc_id", array_to_vector(features_of(spark, F.col("text"), lexicon)).alias("features")
    )
    return calibration.transform(raw(rows).select("doc_id", "raw")).select("doc_id", "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


QUERIES: dict[str, Query] = {"op5_toxicity": op5_toxicity}
ORACLES: dict[str, str] = {}
