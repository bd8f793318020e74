"""Find test items inside documents: size-partitioned MinHash containment search.

An item is found in a document that holds at least ``percent`` of its distinct shingles of
``WORDS`` words (A-Z lower-cased).  An item of fewer words is one shingle of its own length, and
documents are shingled for the lengths that occur.  Items are short and documents may be very long,
so only items are sketched, and items are partitioned by size: class c has items of 2^c to
2^(c+1)-1 shingles.  The sketch of an item is its bottom-k MinHash, the k smallest shingle hashes.
k is set for the largest item of the class, u: k = 2 * (u - need(u)) + 2, where need(n) is the least
number of shingles that counts as found.  A document lacks at most n - need(n) shingles of an item
that it holds, so it has at least k - (n - need(n)) of the k sketched ones: candidates with fewer are
left out, and none that counts is lost.  Candidates are verified on the shingle texts.

What a text holds depends on the text alone, so texts are searched under their md5, and copies are
verified once.  Each text's hashes meet the sketches in one join, map-side as long as the sketches
are counted to be small; texts are read again for the candidates only.

Defined results: null texts and texts without words hold nothing, and items of that kind are never
found; very long texts are searched whole, in time that grows with their words; op1 leaves out rows
and items without an id, ``without_items`` judges rows without one too, each row by its own text;
repeated rows and ids count once in op1, with the highest containment; ties do not arise, as all
items found are returned; empty tables give an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm.common import (
    BROADCAST_ROWS,
    Query,
    columns_of,
    cut,
    lower_ascii,
    read,
    shingle_hashes,
    shingles,
    small,
    word_list,
)

#: Words of a shingle, and the least share of an item's shingles, in percent.
WORDS = 5
PERCENT = 80

#: Bytes of item shingles that are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 16 << 20


def _need(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100)


def _only(value: Column, name: str) -> Column:
    """``value`` as column ``name``, out of a one-element array.

    The optimizer moves no filter below it and merges no projection into it, so that ``value`` is
    computed once per row however often it is used above.
    """
    return F.inline(F.array(F.struct(value.alias(name))))


def _texts(rows: DataFrame) -> DataFrame:
    """``(key, text)``; equal texts have one key, null texts are left out."""
    text = F.col("text")
    return rows.where(text.isNotNull()).select(F.md5(text.cast("binary")).alias("key"), "text")


def _words(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(*keep, _only(word_list(lower_ascii(F.col("text"))), "words"))


def _hashes(words: Column, sizes: list[int]) -> Column:
    return F.concat(*[shingle_hashes(words, n) for n in sizes])


def item_shingles(items: DataFrame, words: int = WORDS) -> DataFrame:
    """``(item_id, span, shingles, hashes)``: one row per item with words, and words per shingle."""
    named = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("bigint").alias("item_id"), "text"
    )
    span = F.least(F.size("words"), F.lit(words)).alias("span")
    sized = _words(named, "item_id").where(F.size("words") > 0).select("item_id", "words", span)

    def of_span(make) -> Column:
        chosen = F.lit(None)
        for n in range(1, words + 1):
            chosen = F.when(F.col("span") == n, make(F.col("words"), n)).otherwise(chosen)
        return chosen

    return cut(
        sized.select("item_id", "span", of_span(shingles).alias("shingles"), F.sort_array(of_span(shingle_hashes)).alias("hashes"))
    )


def sketches(items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(item_id, item_no, least, hash)`` of ``item_shingles``: sketched hashes of each item, and how
    many a holder has."""
    largest = F.pow(F.lit(2), F.floor(F.log2("n")) + 1) - 1
    k = 2 * (largest - _need(largest, percent)) + 2
    return (
        items.select("item_id", F.xxhash64("shingles").alias("item_no"), "hashes", F.size("hashes").alias("n"))
        .withColumn("k", F.least(k, F.col("n")).cast("int"))
        .withColumn("least", F.col("k") - (F.col("n") - _need(F.col("n"), percent)))
        .select("item_id", "item_no", "least", F.explode_outer(F.slice("hashes", F.lit(1), F.col("k"))).alias("hash"))
    )


def candidates(texts: DataFrame, items: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """``(key, item_id, item_no)`` that the sketches do not rule out.

    Copies of a text add up, which only adds candidates.
    """
    spans = sorted(row["span"] for row in items.select("span").distinct().collect())
    hashes = _words(texts, "key").select(
        "key", F.explode_outer(_hashes(F.col("words"), spans or [words])).alias("hash")
    )
    return (
        hashes.join(small(sketches(items, percent)), "hash")
        .groupBy("key", "item_id", "item_no", "least")
        .agg(F.count(F.lit(1)).alias("hits"))
        .where("hits >= least")
        .select("key", "item_id", "item_no")
    )


def contained(docs: DataFrame, items: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """``(key, item_id, n_shingles, n_contained)``: every item found, by the key of the text."""
    texts, known = _texts(docs), item_shingles(items, words)
    pairs = cut(candidates(texts, known, percent, words))
    few = pairs.count() <= BROADCAST_ROWS
    keys = pairs.select("key").distinct()
    held = known.select("item_id", F.xxhash64("shingles").alias("item_no"), "span", "shingles")
    named = cut(pairs.join(held, ["item_id", "item_no"]))
    size = named.agg(F.sum(F.aggregate("shingles", F.lit(0).cast("bigint"), lambda n, x: n + F.octet_length(x)))).first()[0]
    named = F.broadcast(named) if (size or 0) <= BROADCAST_BYTES else named
    # A copied text is cut to one row per map task before it is shuffled.
    wanted = texts.join(F.broadcast(keys) if few else keys, "key", "left_semi")
    wanted = wanted.groupBy("key").agg(F.first("text").alias("text"))
    own = F.lit(None)
    for n in range(1, words + 1):
        own = F.when(F.col("span") == n, shingles(F.col("words"), n)).otherwise(own)
    return (
        _words(wanted, "key")
        .join(named, "key")
        .select(
            "key",
            "item_id",
            F.size("shingles").cast("bigint").alias("n_shingles"),
            _only(F.size(F.array_intersect("shingles", own)).cast("bigint"), "n_contained"),
        )
        .where(F.col("n_contained") * 100 >= F.col("n_shingles") * percent)
    )


def find_items(docs: DataFrame, items: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """``(doc_id, item_id, n_shingles, n_contained, containment)`` of every item found."""
    found = small(contained(docs, items, percent, words))
    ids = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("key")
    )
    return (
        ids.join(found, "key")
        .withColumn("containment", F.col("n_contained") / F.col("n_shingles"))
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("containment", "n_shingles", "n_contained")).alias("best"))
        .select("doc_id", "item_id", "best.n_shingles", "best.n_contained", "best.containment")
    )


def without_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` but for the rows whose own text holds an item."""
    found = small(contained(docs, items).select(F.col("key").alias("__held")).distinct())
    held = F.md5(F.col("text").cast("binary")) == F.col("__held")
    return docs.join(found, held, "left_anti").select(columns_of(docs))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE = f"""
WITH item_words AS (
  SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM benchmark
), spanned AS (
  SELECT item_id, words, least(len(words), {WORDS}) AS span FROM item_words WHERE len(words) > 0
), item_shingles AS (
  SELECT DISTINCT item_id, span, array_to_string(words[i:i + span - 1], ' ') AS shingle
  FROM (SELECT item_id, span, words, unnest(range(1, len(words) - span + 2)) AS i FROM spanned)
), doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents
), doc_shingles AS (
  SELECT DISTINCT doc_id, span, array_to_string(words[i:i + span - 1], ' ') AS shingle
  FROM (SELECT doc_id, span, words, unnest(range(1, len(words) - span + 2)) AS i
        FROM doc_words, (SELECT DISTINCT span FROM spanned))
), sizes AS (SELECT item_id, count(*) AS n_shingles FROM item_shingles GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, n_contained, n_contained / n_shingles AS containment
FROM (SELECT doc_id, item_id, count(*) AS n_contained
      FROM doc_shingles JOIN item_shingles USING (span, shingle) GROUP BY doc_id, item_id)
JOIN sizes USING (item_id) WHERE n_contained * 100 >= n_shingles * {PERCENT}
"""

QUERIES: dict[str, Query] = {"op1_decontaminate": op1_decontaminate}
ORACLES = {"op1_decontaminate": ORACLE}
