"""Text analysis: lower-cased words, no stop words, no stemming.

By default a word is a run of letters and digits.  With ``unicode_words`` boundaries follow the word
rules of Unicode (UAX 29): apostrophes, full stops and the like stay inside a word between letters,
decimal points and commas inside a number between digits, underscores join, marks belong to their letter, and
each ideograph or hiragana is a word of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: what separates two tokens.
SEPARATOR = r"[^\p{L}\p{N}]+"

# Fixed values of the Unicode rules: what may stand between letters, between digits, or between either;
# scripts whose characters are words, or whose runs are.
MID_LETTER = r"\u00B7\u0387\u05F4\u2027"
MID_NUMBER = r",;\u037E\u0589\u060C\u060D\u066C\u07F8\u2044"
MID_EITHER = r"'.\u2018\u2019\u2024\uFE52\uFF07\uFF0E"
SINGLE = r"\p{IsHan}\p{IsHiragana}"
KATAKANA = r"\p{IsKatakana}\u30FC"

_OTHER = rf"&&[^{SINGLE}{KATAKANA}]"
_LETTER, _DIGIT = rf"[\p{{L}}\p{{Nl}}{_OTHER}]", r"\p{Nd}"
_INSIDE = rf"[\p{{L}}\p{{N}}\p{{M}}_{_OTHER}]"
_BETWEEN = (
    rf"(?<=[\p{{L}}\p{{M}}])[{MID_LETTER}{MID_EITHER}](?={_LETTER})"
    rf"|(?<={_DIGIT})[{MID_NUMBER}{MID_EITHER}](?={_DIGIT})"
)
UNICODE_WORD = (
    rf"([{SINGLE}]\p{{M}}*|[{KATAKANA}][{KATAKANA}\p{{M}}]*"
    rf"|_*[\p{{L}}\p{{N}}{_OTHER}](?:{_INSIDE}|{_BETWEEN})*)"
)


def token_array(text: Column | str, unicode_words: bool = False) -> Column:
    """All tokens of a text in order; NULL for NULL."""
    text = F.col(text) if isinstance(text, str) else text
    if unicode_words:
        return F.regexp_extract_all(F.lower(text), F.lit(UNICODE_WORD), F.lit(1))
    return F.array_remove(F.split(F.lower(text), SEPARATOR), "")


def query_terms(spark: SparkSession, text: str, unicode_words: bool = False) -> list[str]:
    """Distinct tokens of a query string, by the very same expression."""
    tokens = token_array(F.lit(text), unicode_words)
    return spark.range(1).select(F.array_distinct(tokens)).first()[0]


def analyze(df: DataFrame, text: str, *keep: str, unicode_words: bool = False) -> DataFrame:
    """One row per token: the ``keep`` columns, ``position`` from 0, ``term``."""
    tokens = token_array(F.col(text), unicode_words)
    return df.select(*keep, F.posexplode(tokens).alias("position", "term"))
