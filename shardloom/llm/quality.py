"""Quality without labels: a weak-label model, and a hashed linear scorer trained on its labels.

Heuristic labellers vote on each text: good (+), bad (-) or nothing (0).  They overlap and err.
Expectation-maximisation estimates how often each votes what on good and on bad texts, from the
counts of vote patterns alone (at most 3 to the number of labellers, so they fit the driver at any
size); every pattern gets a posterior.  The posteriors of about ``ROWS`` documents, drawn by a hash
of the id, train a logistic scorer on hashed shapes of words: each task descends on its rows, and
Spark averages the weights by feature.

Defined results: null and empty texts have no votes but those for too few words, and are scored like
others; very long texts are measured whole; repeated rows are scored each; equal texts get equal
scores, and a score of 0.5 is kept; an empty table gives an empty result.  Other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm.common import Query, cut, read, stored

#: Documents that the scorer learns from, about; hashed features; rounds of averaging.
ROWS = 20_000
FEATURES = 1 << 13
ROUNDS = 6

KEPT_SHAPES = 200_000
LETTER = re.compile(r"[^\W\d_]")


#: Whether each ASCII character is a letter, white space, a capital.
_ASCII_KINDS = np.array([[test(chr(c)) for c in range(128)] for test in (str.isalpha, str.isspace, str.isupper)], np.int64)


def _kinds(text: str) -> tuple[int, int, int]:
    """How many characters are letters, white space, capitals: each distinct character is asked once."""
    if text.isascii():
        return tuple((_ASCII_KINDS @ np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=128)).tolist())
    counts = Counter(text).items()
    return tuple(sum(n for c, n in counts if test(c)) for test in (str.isalpha, str.isspace, str.isupper))


def votes(text: str | None) -> str:
    """One character for each labeller: length, symbols, capitals, repeated words, variety,
    repeated lines, word length, lone marks, marks at word ends."""
    text = text or ""
    words = text.split()
    n = len(words)
    if n == 0:
        return "-00000000"
    letters, spaces, upper = _kinds(text)
    symbols = (len(text) - letters - spaces) / max(len(text) - spaces, 1)
    capitals = upper / max(letters, 1)
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
    distinct = len(set(words))
    lines = [line for line in text.split("\n") if line.strip()]
    lines_again = 1 - len(set(lines)) / max(len(lines), 1)
    length = (len(text) - spaces) / n
    lone = sum(not LETTER.search(word) for word in set(words)) and sum(
        len(word) == 1 and not word.isalnum() for word in words
    ) / n
    odd = sum(word[-1] in "#$%&*!|" for word in words) / n

    def vote(value: float, good_below: float, bad_above: float) -> str:
        return "+" if value < good_below else "-" if value > bad_above else "0"

    return "".join(
        (
            "-" if n < 10 else "+" if n >= 40 else "0",
            vote(symbols, 0.10, 0.20),
            vote(capitals, 0.15, 0.40),
            vote(repeats, 0.05, 0.20),
            vote(-distinct / n**0.75, -1.2, -0.5),
            vote(lines_again, 0.10, 0.40) if len(lines) > 1 else "0",
            vote(abs(length - 5.5), 2.5, 5.0),
            vote(lone, 0.02, 0.15),
            vote(odd, 0.02, 0.20),
        )
    )


def fit_votes(patterns: dict[str, int], rounds: int = 100) -> dict[str, float]:
    """Posterior of each pattern, by expectation-maximisation over the labellers' accuracies."""
    if not patterns:
        return {}
    names = sorted(patterns)
    n = np.array([patterns[name] for name in names], dtype=float)
    cast = np.array([["-0+".index(v) for v in name] for name in names])
    seen = np.stack([cast == v for v in range(3)], axis=2).astype(float)
    # Start: labellers seldom call a good text bad; a bad text has faults that some of them see.
    rates = np.tile(np.array([[0.02, 0.13, 0.85], [0.3, 0.2, 0.5]])[:, None, :], (1, cast.shape[1], 1))
    prior = np.array([0.8, 0.2])
    for _ in range(rounds):
        logs = np.log(prior) + np.einsum("pjv,cjv->pc", seen, np.log(rates))
        posterior = np.exp(logs - logs.max(axis=1, keepdims=True))
        posterior /= posterior.sum(axis=1, keepdims=True)
        weight = posterior * n[:, None]
        prior = (weight.sum(axis=0) + 1) / (weight.sum() + 2)
        rates = np.einsum("pc,pjv->cjv", weight, seen) + 0.5
        rates /= rates.sum(axis=2, keepdims=True)
    return dict(zip(names, posterior[:, 0].tolist(), strict=True))


def _shape(word: str) -> int:
    """Hash of a word's shape: runs of lower and upper case letters, of digits, other characters."""
    shape = re.sub(r"[^\W\d_]+", lambda m: "X" if m[0].isupper() else "x" if m[0].islower() else "Xx", word)
    shape = re.sub(r"\d+", "0", shape)[:12]
    return zlib.crc32(f"{shape}|{min(len(word) // 4, 4)}".encode()) % FEATURES


class Shapes:
    """Hashed features of texts; keeps the shapes of words between texts."""

    def __init__(self) -> None:
        self.kept: dict[str, int] = {}

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or "").split()
        if len(self.kept) > KEPT_SHAPES:
            self.kept.clear()
        kept = self.kept
        for word in set(words):
            if word not in kept:
                kept[word] = _shape(word)
        found, counts = np.unique(np.fromiter(map(kept.__getitem__, words), np.int64, len(words)), return_counts=True)
        n = max(len(words), 1)
        extra = {
            "again": sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
            "distinct": min(len(set(words)) / n**0.75, 2.0),
            "few": 1.0 if n < 10 else 0.0,
            "one": 1.0,
        }
        own = np.array([zlib.crc32(f"={name}".encode()) % FEATURES for name in extra])
        return np.r_[found, own], np.r_[counts / n, list(extra.values())]


def _chance(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def train(labelled: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the scorer, from ``(at, value, aim)``.

    The rows are a bounded sample, which six tasks share whatever the number of its files.
    """
    spark = labelled.sparkSession
    rows = cut(labelled.select("at", "value", "aim").repartition(6))
    weights = np.zeros(FEATURES)
    for k in range(rounds):
        sent, step = spark.sparkContext.broadcast(weights), 2.0 / (1 + k)

        def descend(batches: Iterator[pd.DataFrame], sent=sent, step=step) -> Iterator[pd.DataFrame]:
            w, touched = sent.value.copy(), np.zeros(FEATURES, bool)
            for batch in batches:
                for at, value, aim in zip(batch["at"], batch["value"], batch["aim"], strict=True):
                    w[at] += step * (aim - _chance(float(value @ w[at]))) * value
                    touched[at] = True
            at = np.flatnonzero(touched)
            yield pd.DataFrame({"at": at, "w": w[at]})

        found = rows.mapInPandas(descend, "at long, w double").groupBy("at").agg(F.avg("w").alias("w")).toPandas()
        weights = weights.copy()
        weights[found["at"].to_numpy()] = found["w"].to_numpy()
    return weights


def scored(spark: SparkSession, weights: np.ndarray) -> Column:
    """Scores of rows with ``at`` and ``value``."""
    sent = spark.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(at: pd.Series, value: pd.Series) -> pd.Series:
        return pd.Series([_chance(float(v @ sent.value[a])) for a, v in zip(at, value, strict=True)], dtype=float)

    return score("at", "value")


def measured(text: Column) -> Column:
    """A struct ``(votes, at, value)``: the votes of the labellers, and hashed features."""

    @F.pandas_udf("votes string, at array<int>, value array<double>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shapes = Shapes()
        for batch in batches:
            features = [shapes.of(text) for text in batch]
            yield pd.DataFrame(
                {"votes": [votes(text) for text in batch], "at": [a.astype(np.int32) for a, _ in features], "value": [v for _, v in features]}
            )

    return measure(text)


def classify(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """``(doc_id, votes, posterior, score, keep)`` for every row of ``docs``.

    Texts are read once: votes and features of all rows are stored, a few dozen numbers each.
    """
    spark = docs.sparkSession
    found = stored(docs.select("doc_id", measured(F.col("text")).alias("m")).select("doc_id", "m.*"), "quality")
    patterns = {r["votes"]: r["count"] for r in found.groupBy("votes").count().collect()}
    posteriors = fit_votes(patterns)
    table = F.create_map(*[F.lit(x) for item in posteriors.items() for x in item]) if posteriors else (
        F.create_map().cast("map<string,double>")
    )
    posterior = F.element_at(table, F.col("votes")).alias("posterior")
    draw = F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = found.where(draw < min(1.0, rows / max(sum(patterns.values()), 1)))
    weights = train(sample.select("at", "value", posterior.alias("aim")).where(F.col("aim").isNotNull()))
    return found.select("doc_id", "votes", posterior, scored(spark, weights).alias("score")).withColumn(
        "keep", F.col("score") >= 0.5
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {"op8_quality": op8_quality}
ORACLES: dict[str, str] = {}
