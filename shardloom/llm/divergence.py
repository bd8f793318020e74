"""Audit of how the sources of a language differ in their terms.

Terms are runs of letters A-Z, a-z and characters beyond ASCII, with A-Z lower-cased.  Counting packs them:
a task lays the terms of some texts out as bytes and puts them in buckets by length.  Terms of up to
8 bytes become one uint64, of up to 16 bytes two, big-endian and filled up with zeros, so that numbers
sort like bytes.  Such buckets are sorted by radix, 16 bits at a time, and equal runs are counted, all
in numpy; longer terms go to one bucket of byte strings per power of two of their length, which is
sorted as bytes.  Spark adds up what the tasks counted, per language, source and term.

The kept terms of a language are those in at least ``MIN_DOCS`` of its documents.  A group (language
and source) or a language gives a kept term p = 1 + floor(10^9 * (count + 2) / (N + 2V)); terms are
compared by floor((p - q)^2 / (p + q)).  Pairs of sources are compared in parts: the terms of a language are
dealt by hash over so many parts that counts of a part fit a task, a part adds up each pair of sources once
(the measure is symmetric), and parts are summed.  A language's count of sources is held by one row
per source in a part; more sources only make for more parts.  Everything is whole numbers.

Defined results: null texts, languages and sources count as ''; empty texts have no terms, but their
group occurs; very long texts and terms are counted whole; repeated rows count each; equal values are
ranked by the item's bytes; a language without kept terms has value 0 for all pairs and no terms; an
empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardloom.llm.common import BROADCAST_ROWS, Query, cut, read, stored

#: Fixed values of the measure.
SCALE = 1_000_000_000
ADDED = 2

#: Documents of a language a kept term occurs in, at least; ranks of the list of terms.
MIN_DOCS = 10
TOP = 10

#: Bytes of text that a task counts at a time; counts (terms by sources) of a part.
COUNT_BYTES = 8 << 20
PART_COUNTS = 1 << 20

_COUNTED = "lang string, source string, term string, n bigint, docs bigint"

#: Bytes of a term, and A-Z in lower case.
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def radix_order(columns: list[np.ndarray]) -> np.ndarray:
    """Stable order by unsigned columns, the first one most significant, 16 bits a pass."""
    order = np.arange(len(columns[0]))
    for column in reversed(columns):
        high = int(column.max(initial=0))
        for shift in range(0, 64, 16):
            if high >> shift == 0:
                break
            digit = ((column >> np.asarray(shift, column.dtype)) & np.asarray(0xFFFF, column.dtype)).astype(np.uint16)
            order = order[np.argsort(digit[order], kind="stable")]
    return order


def packed(letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Terms as rows of ``width`` bytes, zeros at their ends."""
    out = np.zeros((len(starts), width), np.uint8)
    for k in range(int(sizes.max(initial=0))):
        has = sizes > k
        out[has, k] = letters[starts[has] + k]
    return out


def counted(texts: list[bytes], groups: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bucket by bucket: group, term (as byte strings), occurrences and documents with it.

    Documents must come in the order of their number, which they have as ``groups`` has theirs.
    """
    letters = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    inside = _INSIDE[letters]
    change = np.diff(np.r_[False, inside, False].astype(np.int8))
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    letters = _LOWER[letters]
    sizes = ends - starts
    doc = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, np.r_[0, np.cumsum([len(t) + 1 for t in texts])])))
    group = groups[doc].astype(np.uint64)
    low, width = 0, 8
    while low < sizes.max(initial=0):
        mine = np.flatnonzero((sizes > low) & (sizes <= width))
        if len(mine):
            rows = packed(letters, starts[mine], sizes[mine], width)
            if width <= 16:
                words = rows.view(">u8").astype(np.uint64)
            else:
                words = np.unique(rows.view(f"S{width}").ravel(), return_inverse=True)[1].astype(np.uint64)[:, None]
            order = radix_order([group[mine], *words.T])
            of, at, words = doc[mine][order], group[mine][order], words[order]
            first = np.r_[True, (at[1:] != at[:-1]) | (words[1:] != words[:-1]).any(axis=1)]
            begin = np.flatnonzero(first)
            n = np.diff(np.r_[begin, len(mine)])
            n_docs = np.add.reduceat(np.r_[True, first[1:] | (of[1:] != of[:-1])].astype(np.int64), begin)
            yield at[begin], rows[order][begin].view(f"S{width}").ravel(), n, n_docs
        low, width = width, width * 2


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def flush(texts: list[bytes], names: dict, groups: list[int]) -> Iterator[pd.DataFrame]:
        pairs = list(names)
        for group, terms, n, docs in counted(texts, np.array(groups, np.int64)):
            lang, source = (np.array([pair[k] for pair in pairs], object)[group.astype(np.int64)] for k in (0, 1))
            yield pd.DataFrame({"lang": lang, "source": source, "term": [t.decode() for t in terms.tolist()], "n": n, "docs": docs})

    texts, names, groups, size = [], {}, [], 0
    for batch in batches:
        for lang, source, text in zip(batch["lang"], batch["source"], batch["text"], strict=True):
            texts.append(text.encode())
            groups.append(names.setdefault((lang, source), len(names)))
            size += len(texts[-1])
            if size >= COUNT_BYTES:
                yield from flush(texts, names, groups)
                texts, names, groups, size = [], {}, [], 0
    if texts:
        yield from flush(texts, names, groups)


def count_terms(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences of each term, and documents that hold it."""
    columns = [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source", "text")]
    return (
        docs.select(*columns)
        .mapInPandas(_count, _COUNTED)
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def share(count: Column, total: Column, kept: Column) -> Column:
    """p of a term, from whole numbers of up to 38 digits."""
    part = (count + ADDED).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return 1 + floor_div(part, (total + 2 * kept).cast("decimal(20,0)"))


def floor_div(a: Column, b: Column) -> Column:
    """Whole part of the quotient of numbers that are not negative, as BIGINT."""
    return F.call_function("div", a, b)


def shares(counts: np.ndarray, totals: np.ndarray, kept: int) -> np.ndarray:
    """The same for an array of sources by terms: three digits of the quotient at a time."""
    whole = (totals + 2 * kept)[:, None]
    rest = counts + ADDED
    quotient = rest // whole
    for _ in range(3):
        rest = (rest % whole) * 1000
        quotient = quotient * 1000 + rest // whole
    return 1 + quotient


def _compare(key, counts: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Sums over the terms of one part for each pair of sources."""
    groups = groups.sort_values("source")
    names = groups["source"].to_numpy(object)
    number = {name: i for i, name in enumerate(names)}
    column, terms = pd.factorize(counts["term"])
    table = np.zeros((len(names), len(terms)), np.int64)
    table[counts["source"].map(number).to_numpy(np.int64), column] = counts["n"].to_numpy(np.int64)
    p = shares(table, groups["total"].to_numpy(np.int64), int(groups["kept"].iloc[0])) if len(terms) else table
    found = []
    for i in range(len(names) - 1):
        gap = p[i + 1 :] - p[i]
        values = (gap * gap // np.maximum(p[i + 1 :] + p[i], 1)).sum(axis=1)
        found.append(pd.DataFrame({"one": names[i], "other": names[i + 1 :], "value": values}))
    out = pd.concat(found) if found else pd.DataFrame({"one": [], "other": [], "value": []})
    return out.assign(lang=key[0])[["lang", "one", "other", "value"]]


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, part_counts: int = PART_COUNTS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: pairs of sources, and the terms that stand out."""
    counts = stored(count_terms(docs), "divergence-counts")
    kept = (
        counts.groupBy("lang", "term")
        .agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= min_docs)
        .drop("docs")
    )
    known = stored(counts.drop("docs").join(kept, ["lang", "term"]), "divergence-kept")
    of_lang = known.groupBy("lang").agg(F.countDistinct("term").alias("kept"), F.sum("n").alias("lang_total"))
    of_group = known.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    lang, source = (F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source"))
    sources = Window.partitionBy("lang")
    zero = {"total": 0, "kept": 0, "lang_total": 0}
    groups = cut(
        docs.select(lang, source)
        .distinct()
        .join(of_group, ["lang", "source"], "left")
        .join(of_lang, "lang", "left")
        .fillna(zero)
        .withColumn("parts", F.ceil(F.col("kept") * F.count(F.lit(1)).over(sources) / part_counts))
        .withColumn("parts", F.greatest("parts", F.lit(1)))
    )
    return pair_values(known, groups).unionByName(term_values(known, groups, top))


def pair_values(known: DataFrame, groups: DataFrame) -> DataFrame:
    parts = groups.groupBy("lang").agg(F.max("parts").alias("parts"))
    part = F.pmod(F.xxhash64("term"), F.col("parts"))
    dealt = known.join(parts, "lang").select("lang", part.alias("part"), "source", "term", "n")
    rows = groups.select(
        F.col("lang").alias("of_lang"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("of_part"),
        "source", "total", "kept",
    )
    sums = (
        dealt.groupBy("lang", "part")
        .cogroup(rows.groupBy("of_lang", "of_part"))
        .applyInPandas(_compare, "lang string, one string, other string, value bigint")
        .groupBy("lang", "one", "other")
        .agg(F.sum("value").alias("value"))
    )
    both = F.inline(
        F.array(
            F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
            F.struct(F.col("other").alias("source"), F.col("one").alias("item")),
        )
    )
    return _ranked(sums.select("lang", "value", both), "pair")


def term_values(known: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    p = share(F.col("n"), F.col("total"), F.col("kept"))
    q = share(F.col("in_lang"), F.col("lang_total"), F.col("kept"))
    n_groups = groups.count()
    compared = (
        known.join(F.broadcast(groups) if n_groups <= BROADCAST_ROWS else groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
        .where("p > q")
    )
    gap = F.col("p") - F.col("q")
    value = floor_div(gap * gap, F.col("p") + F.col("q"))
    return _ranked(compared.select("lang", "source", "item", value.alias("value")), "term").where(F.col("rank") <= top)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    """Ranked within each group; a filter on ranks cuts each task's rows before the shuffle."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"))


ORACLE = f"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), seen AS (
  SELECT lang, source, row, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
), counts AS (SELECT lang, source, term, count(*) AS n FROM seen GROUP BY ALL
), kept AS (SELECT lang, term, count(*) AS n FROM seen GROUP BY ALL HAVING count(DISTINCT row) >= {MIN_DOCS}
), langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), groups AS (SELECT DISTINCT lang, source FROM docs
), grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM groups g JOIN kept k USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), totals AS (SELECT lang, source, sum(n) AS total FROM grid GROUP BY ALL
), p AS (
  SELECT lang, source, term, n, 1 + ({SCALE}::HUGEINT * (n + {ADDED})) // (t.total + 2 * v)::HUGEINT AS p
  FROM grid JOIN totals t USING (lang, source) JOIN langs USING (lang)
), q AS (
  SELECT lang, term, 1 + ({SCALE}::HUGEINT * (n + {ADDED})) // (total + 2 * v)::HUGEINT AS q FROM kept JOIN langs USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), all_pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM all_pairs UNION ALL SELECT * FROM terms)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""

QUERIES: dict[str, Query] = {"op11_divergence": op11_divergence}
ORACLES = {"op11_divergence": ORACLE}
