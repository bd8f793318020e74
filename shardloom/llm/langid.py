"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of one fixed public vocabulary.  The probability of
a word is the sum over all ways to cut it into pieces of the product of their probabilities: the
forward algorithm.  Piece probabilities are learned by expectation-maximisation (forward and
backward) on the words of labelled documents.  A text is scored by the sum of the logarithms of its
words; the score is the posterior of the best language under equal priors.

Learning takes about ``PER_LANGUAGE`` documents of each language, drawn by a hash of the id; word
counts and expected piece counts are summed by Spark, and only the piece table (vocabulary times
languages) comes to the driver.  Scoring is a pandas UDF on the text alone; words recur, so a task
keeps the scores of up to ``KEPT_WORDS`` words.

Words are runs of letters, lower-cased; longer words are cut every ``LONGEST`` letters.  A letter
that the vocabulary lacks is a piece of its own kind.

Defined results: null texts and texts without a letter are ``und`` with score 0; so is everything
if nothing could be learned; rows without a language teach nothing; very long texts are scored whole;
repeated rows are scored each; ties go to the smaller name; an empty table gives an empty result.
Letters are what ``str.isalpha`` says.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm.common import Query, columns_of, cut, fold, read, release_memory
from shardloom.llm.grams import mix

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
UNDECIDED = "und"
LETTERS = re.compile(r"[^\W\d_]+")
WORD_START = "▁"
MORE = "-"

#: Longest piece and longest word (longer ones are cut) in letters.
PIECE = 16
LONGEST = 24

#: Places for marks of beginnings of pieces of a length.
MARKS = 1 << 18

#: Documents of a language that are learned from, about; rounds of learning; words a task keeps.
PER_LANGUAGE = 4_000
ROUNDS = 4
KEPT_WORDS = 200_000

#: Added to each piece's expected count.
SMOOTHING = 0.05


def vocabulary(path: str = VOCABULARY) -> dict[str, int]:
    """Number of each normal piece of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = (
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    )
    return {piece: i for i, piece in enumerate(piece for piece in normal if len(piece) <= PIECE)}


def _letter_runs(text: str) -> list[str]:
    """Runs of letters; numbers that are no digits (²) are none."""
    found = LETTERS.findall(text)
    if not found or "".join(found).isalpha():
        return found
    return "".join(c if c.isalpha() else " " for c in text).split()


def _parts(text: str) -> list[str]:
    """Words of a text; of a long one its parts, ``MORE`` before all but the first."""
    runs = _letter_runs(text.lower())
    if max(map(len, runs), default=0) <= LONGEST:
        return runs
    return [
        run[i : i + LONGEST] if i == 0 else MORE + run[i : i + LONGEST]
        for run in runs
        for i in range(0, len(run), LONGEST)
    ]


def _spelled(part: str) -> str:
    return part[1:] if part[0] == MORE else WORD_START + part


def words_of(text: str) -> list[str]:
    """Words of a text, each with a mark at its start; parts of long words have none."""
    return list(map(_spelled, _parts(text)))


class Pieces:
    """A vocabulary as sorted hashes of the pieces of each length, and marks of their beginnings."""

    def __init__(self, numbers: dict[str, int]) -> None:
        self.size = len(numbers)
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        self.marks = np.zeros((PIECE, MARKS), bool)
        for length in range(1, PIECE + 1):
            own = [piece for piece in numbers if len(piece) == length]
            hashes = np.zeros(len(own), np.uint64)
            codes = _codes("".join(own)).reshape(len(own), length)
            for k in range(length):
                hashes = _longer(hashes, codes[:, k])
                self.marks[k, hashes % np.uint64(MARKS)] = True
            order = np.argsort(hashes)
            self.tables.append((hashes[order], np.array([numbers[own[i]] for i in order], np.int64)))

    def begun(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """False where no piece begins with the string that has the hash; mostly true elsewhere."""
        return self.marks[length - 1][hashes % np.uint64(MARKS)]

    def find(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Number of the piece with each hash, or -1."""
        known, numbers = self.tables[length - 1]
        if not len(known):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return np.where(known[at] == hashes, numbers[at], -1)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _longer(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of strings that are one letter longer."""
    return mix(hashes * np.uint64(0x9E3779B97F4A7C15) + codes + np.uint64(1))


class Lattice:
    """All pieces at all places of some words, as arrays sorted by end, then word."""

    def __init__(self, words: list[str], pieces: Pieces) -> None:
        self.lengths = np.array([len(word) for word in words], dtype=np.int64)
        self.longest = int(self.lengths.max(initial=0))
        codes = _codes("".join(words))
        ends = np.cumsum(self.lengths)
        word = np.repeat(np.arange(len(words)), self.lengths)
        place = np.arange(len(codes)) - np.repeat(ends - self.lengths, self.lengths)
        at, hashes, found = np.arange(len(codes)), np.zeros(len(codes), np.uint64), []
        for length in range(1, PIECE + 1):
            inside = at + length <= ends[word[at]]
            at, hashes = at[inside], hashes[inside]
            if not len(at):
                break
            hashes = _longer(hashes, codes[at + length - 1])
            begun = pieces.begun(hashes, length)
            if length == 1:
                lone = at[~begun]
                found.append((place[lone] + 1, word[lone], place[lone], np.full(len(lone), pieces.size)))
            at, hashes = at[begun], hashes[begun]
            piece = pieces.find(hashes, length)
            if length == 1:
                piece = np.where(piece < 0, pieces.size, piece)
            hit = piece >= 0
            begin = at[hit]
            found.append((place[begin] + length, word[begin], place[begin], piece[hit]))
        if not found:
            found = [(np.zeros(0, np.int64),) * 4]
        end, of, start, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((of, end))
        self.end, self.word, self.start, self.piece = end[order], of[order], start[order], piece[order]

    def forward(self, p: np.ndarray) -> np.ndarray:
        """``p``: languages by pieces.  Sums over segmentations of each prefix:
        languages by words by lengths."""
        alpha = np.zeros((len(p), len(self.lengths), self.longest + 1))
        alpha[:, :, 0] = 1.0
        _sweep(alpha, p, self.end, self.word, self.start, self.piece, range(1, self.longest + 1))
        return alpha

    def backward(self, p: np.ndarray) -> np.ndarray:
        """As ``forward``, for suffixes that begin at each place."""
        beta = np.zeros((len(p), len(self.lengths), self.longest + 1))
        beta[:, np.arange(len(self.lengths)), self.lengths] = 1.0
        order = np.lexsort((self.word, self.start))
        start, word, end, piece = (x[order] for x in (self.start, self.word, self.end, self.piece))
        _sweep(beta, p, start, word, end, piece, range(self.longest - 1, -1, -1))
        return beta

    def total(self, alpha: np.ndarray) -> np.ndarray:
        return alpha[:, np.arange(len(self.lengths)), self.lengths]

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected piece counts of ``counts`` (languages by words): languages by pieces."""
        alpha, beta = self.forward(p), self.backward(p)
        weight = counts / np.maximum(self.total(alpha), 1e-300)
        used = (
            alpha[:, self.word, self.start]
            * p[:, self.piece]
            * beta[:, self.word, self.end]
            * weight[:, self.word]
        )
        return np.stack([np.bincount(self.piece, row, p.shape[1]) for row in used])


def _sweep(state, p, at, word, source, piece, places) -> None:
    """Fill ``state`` place by place: add what each piece brings from its other side."""
    bounds = np.searchsorted(at, np.arange(at.max(initial=0) + 2))
    for place in places:
        lo, hi = bounds[place], bounds[place + 1]
        if lo == hi:
            continue
        owners = word[lo:hi]
        brought = state[:, owners, source[lo:hi]] * p[:, piece[lo:hi]]
        first = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
        state[:, owners[first], place] += np.add.reduceat(brought, first, axis=1)


class Model:
    """Languages, pieces and ``p``: languages by pieces, the last for letters that no piece has."""

    def __init__(self, languages: list[str], pieces: Pieces, p: np.ndarray) -> None:
        self.languages, self.pieces, self.p = languages, pieces, p

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Logarithms of the probabilities: words by languages."""
        lattice = Lattice(words, self.pieces)
        return np.log(np.maximum(lattice.total(lattice.forward(self.p)), 1e-300)).T

    def predictor(self):
        """A function of a list of texts: names and scores.  It keeps words between calls."""
        index: dict[str, int] = {}
        table = np.zeros((0, len(self.languages)))

        def predict(texts: list[str | None]) -> list[tuple[str, float]]:
            nonlocal table
            split = [_parts(text) if text else [] for text in texts]
            if not self.languages:
                return [(UNDECIDED, 0.0)] * len(texts)
            if len(index) > KEPT_WORDS:
                index.clear()
                table = table[:0]
            new = list(set().union(*split).difference(index))
            for i in range(0, len(new), 4_000):
                part = new[i : i + 4_000]
                index.update(zip(part, range(len(table), len(table) + len(part)), strict=True))
                table = np.concatenate([table, self.word_scores(list(map(_spelled, part)))])
            found = []
            for words in split:
                if not words:
                    found.append((UNDECIDED, 0.0))
                    continue
                rows = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
                total = table[rows].sum(axis=0)
                best = int(total.argmax())
                found.append((self.languages[best], float(1 / np.exp(total - total[best]).sum())))
            return found

        return predict


def learn(
    labelled: DataFrame,
    pieces: Pieces,
    per_language: int = PER_LANGUAGE,
    rounds: int = ROUNDS,
) -> Model:
    """Learn from the text and non-null lang of ``labelled``."""
    spark = labelled.sparkSession
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {row["lang"]: row["n"] for row in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], pieces, np.zeros((0, pieces.size + 1)))
    shares = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, per_language / sizes[lang]))])
    draw = F.pmod(F.xxhash64(F.lit(9), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(draw < F.element_at(shares, F.col("lang"))).select("lang", "text")

    def count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter = Counter()
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                counts.update((lang, word) for word in words_of(text))
            yield pd.DataFrame(
                [(lang, word, n) for (lang, word), n in counts.items()], columns=["lang", "word", "n"]
            )

    counted = cut(
        sample.mapInPandas(count_words, "lang string, word string, n long")
        .groupBy("word", "lang")
        .agg(F.sum("n").alias("n"))
    )
    p = np.full((len(languages), pieces.size + 1), 1.0 / (pieces.size + 1))
    number = {lang: k for k, lang in enumerate(languages)}
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((pieces, p))

        def expect(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            pieces, p = sent.value
            total = np.zeros_like(p)
            for batch in batches:
                for i in range(0, len(batch), 4_000):
                    part = batch.iloc[i : i + 4_000]
                    word_no, words = pd.factorize(part["word"])
                    counts = np.zeros((len(p), len(words)))
                    np.add.at(counts, (part["lang"].map(number).to_numpy(), word_no), part["n"].to_numpy())
                    total += Lattice(list(words), pieces).expected(p, counts)
            lang, piece = np.nonzero(total)
            yield pd.DataFrame({"lang": lang, "piece": piece, "n": total[lang, piece]})

        sums = (
            counted.mapInPandas(expect, "lang int, piece int, n double")
            .groupBy("lang", "piece")
            .agg(F.sum("n").alias("n"))
            .toPandas()
        )
        p = np.full(p.shape, SMOOTHING)
        p[sums["lang"].to_numpy(), sums["piece"].to_numpy()] += sums["n"].to_numpy()
        p /= p.sum(axis=1, keepdims=True)
        sent.unpersist()
    return Model(languages, pieces, p)


def predicted(spark: SparkSession, model: Model, text: Column) -> Column:
    """A struct ``(lang_pred, score)`` for a text column."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = sent.value.predictor()  # freed with the task: workers live on
        for batch in batches:
            rows: list[tuple[str, float]] = []
            for i in range(0, len(batch), 200):
                rows += known([x if isinstance(x, str) else None for x in batch.iloc[i : i + 200]])
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])
        del known
        release_memory()

    return predict(text)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(fold(F.col("doc_id"), 3) != 1)


def identify(docs: DataFrame, vocabulary_path: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``__lang``, a struct ``(lang_pred, score)``, learned from two thirds of them."""
    model = learn(training_rows(docs), Pieces(vocabulary(vocabulary_path)))
    return docs.withColumn("__lang", predicted(docs.sparkSession, model, F.col("text")))


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` without those of no language or with a score under ``least``."""
    kept = (F.col("__lang.lang_pred") != UNDECIDED) & (F.col("__lang.score") >= least)
    return identify(docs).where(kept).select(columns_of(docs))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return identify(docs).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "__lang.lang_pred", "__lang.score"
    )


QUERIES: dict[str, Query] = {"op9_language": op9_language}
ORACLES: dict[str, str] = {}
