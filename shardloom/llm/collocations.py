"""Phrases whose words occur together more often than chance, per language: HAT-trie counting.

Texts (A-Z lower-cased) are cut into pieces at punctuation and line ends, pieces into words at blanks.
f(phrase) counts the contiguous occurrences of a phrase within pieces, overlaps included.  Candidates
are phrases of 2 to ``LONGEST`` words with f >= ``LEAST``.

1. A task writes its texts as blocks of one language each: words once with their counts, places as
   numbers (see ``blocks``).  Words are counted over all blocks; each gets an id, the most frequent the
   smallest, and ids are joined back to the blocks.  Rare words keep theirs: to leave them out would
   spare work on small inputs only, where most words are rare, so cost would outgrow the input.
2. From every place a window of up to ``LONGEST`` ids begins; all phrases are prefixes of windows.  A
   block counts its windows in a HAT-trie: a shallow trie by word id over hash containers of the rest
   of the window; a container that grows too large bursts into one per next id.  When the
   trie is full, its largest subtrees are spilled whole, as sorted runs.
3. Runs are dealt to prefix partitions and merged there, and the windows of a prefix add up to the
   count of the phrase.  The prefix that decides the partition reaches to the first word that is not
   heavy (occurs up to ``PART_WINDOWS / HEAVY`` times), so no prefix brings more windows than that.
   Windows that begin alike with heavy words are thus spread; the count of such a beginning is sent for
   itself, once per run, and meets its like in the partition of all its words.
4. Each candidate is cut after each of its first words; both parts are candidates or words, whose
   counts are joined to it.  score = floor(1000 * a * n / (l * r)) in numbers of up to 38 digits.  The
   cut with the lowest score counts, ties go to the first.
5. A candidate that lies inside a longer candidate with the same count is dropped.  If there is one,
   there is one that is longer by a single word, so prefixes and suffixes suffice.

Defined results: null texts are empty, null languages are ``und``; empty texts have no words; very long
texts are counted whole; repeated rows count each; ties in score and count are ranked by the phrase's
bytes; an empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardloom.llm.blocks import Numbers, by_frequency, from_varints, varints
from shardloom.llm.common import Query, read, stored
from shardloom.llm.grams import mix

#: Words of a phrase, its occurrences at least, and phrases returned per language.
LONGEST = 5
LEAST = 100
TOP = 2000

#: What ends a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
NO_LANGUAGE = "und"

#: Words of a block; entries of a container before it bursts, and of a trie before it spills.
BLOCK_WORDS = 1 << 21
BURST = 1 << 12
TRIE_ENTRIES = 1 << 20

#: Windows of a prefix partition, and the share of them that one prefix may bring.
PART_WINDOWS = 1 << 19
HEAVY = 4

#: Places whose windows are put into the trie at a time.
CHUNK = 1 << 17

#: In lower case, blanks as spaces, and a byte that UTF-8 never has for what ends a piece.
_END = b"\xff"
_BYTES = bytes(255 if b in ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))

BLOCKS = "block bigint, lang string, words array<string>, counts array<bigint>, codes binary"


def words_of(text: str) -> list[bytes]:
    """Words in order, ``_END`` between pieces."""
    return text.encode().translate(_BYTES).replace(_END, b" \xff ").split()


class _Open:
    """Texts of one language that are not yet a block; 0 stands for the end of a piece."""

    def __init__(self) -> None:
        self.index = Numbers({_END: 0})
        self.texts: list[np.ndarray] = []

    def add(self, words: list[bytes]) -> None:
        self.texts += [self.index.of(words), np.zeros(1, np.int32)]

    def close(self, block: int, lang: str) -> tuple:
        codes = np.concatenate(self.texts)
        counts = np.bincount(codes, minlength=len(self.index))
        order, new = by_frequency(codes[codes > 0] - 1, len(self.index) - 1)
        names = list(self.index)[1:]
        data, _ = varints(np.r_[0, new + 1][codes])
        return block, lang, [names[i].decode() for i in order], counts[1:][order], data


def _blocks(block_words: int):
    schema = pa.schema(
        [("block", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("codes", pa.binary())]
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        opened: dict[str, _Open] = {}
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for lang, texts in opened.items():
                row = texts.close(number, lang)
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)
            opened.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                words = words_of(text.as_py())
                opened.setdefault(lang.as_py(), _Open()).add(words)
                size += len(words) + 1
                if size >= block_words:
                    yield from close()
                    size = 0
        yield from close()

    return blocks


def with_ids(words: DataFrame) -> DataFrame:
    """A written table with ``id``: whole numbers from 1 without gaps."""
    kept = stored(words.withColumn("__at", F.monotonically_increasing_id()), "phrase-words")
    part = F.shiftright("__at", 33)
    sizes = kept.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    first, offsets = 1, []
    for row in sizes:
        offsets += [F.lit(row["part"]), F.lit(first)]
        first += row["n"]
    start = F.element_at(F.create_map(*offsets), part).cast("bigint") if offsets else F.lit(1).cast("bigint")
    return kept.withColumn("id", start + F.col("__at").bitwiseAND((1 << 33) - 1)).drop("__at")


class HatTrie:
    """Counts of windows: a container of rests for each first id; a large one is split by the second.

    Windows are rows of big-endian ids with zeros at their ends, so that bytes sort like rows.
    """

    def __init__(self, unit: int, burst: int, full: int) -> None:
        self.unit, self.burst, self.full = unit, burst, full
        self.roots: dict[int, Counter | dict[bytes, Counter]] = {}
        self.sizes: dict[int, int] = {}
        self.entries = 0

    def add(self, windows: np.ndarray) -> Iterator[np.ndarray]:
        """Count windows; yields sorted runs of subtrees when there are too many."""
        windows = windows[np.lexsort((windows[:, 1], windows[:, 0]))]
        rests = np.ascontiguousarray(windows[:, 1:]).view(f"S{self.unit * (LONGEST - 1)}").ravel().tolist()
        first, second = windows[:, 0].astype(np.int64), windows[:, 1]
        bounds = np.r_[np.flatnonzero(np.r_[True, first[1:] != first[:-1]]), len(first)].tolist()
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            root = int(first[lo])
            node = self.roots.setdefault(root, Counter())
            before = self.sizes.get(root, 0)
            if isinstance(node, Counter):
                node.update(rests[lo:hi])
                size = len(node)
                if size > self.burst:
                    self.roots[root] = self._children(node)
            else:
                size = before
                inner = np.flatnonzero(np.r_[True, second[lo + 1 : hi] != second[lo : hi - 1]]) + lo
                for a, b in zip(inner.tolist(), [*inner[1:].tolist(), hi], strict=True):
                    child = node.setdefault(rests[a][: self.unit], Counter())
                    size -= len(child)
                    child.update([rest[self.unit :] for rest in rests[a:b]])
                    size += len(child)
            self.sizes[root] = size
            self.entries += size - before
        if self.entries > self.full:
            yield from self.spill(self.entries // 2)

    def _children(self, container: Counter) -> dict[bytes, Counter]:
        children: dict[bytes, Counter] = {}
        for rest, n in container.items():
            children.setdefault(rest[: self.unit], Counter())[rest[self.unit :]] = n
        return children

    def spill(self, leave: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take out the largest subtrees until ``leave`` entries are left: one sorted run."""
        roots, keys, counts = sorted(self.sizes, key=self.sizes.__getitem__, reverse=True), [], []
        for root in roots:
            if self.entries <= leave:
                break
            node, head = self.roots.pop(root), root.to_bytes(self.unit, "big")
            self.entries -= self.sizes.pop(root)
            for second, container in [(b"", node)] if isinstance(node, Counter) else node.items():
                keys += [head + second.ljust(self.unit if second else 0, b"\0") + rest for rest in container]
                counts += container.values()
        if keys:
            found = np.array(keys, f"S{self.unit * LONGEST}")
            order = np.argsort(found, kind="stable")
            yield _rows(found[order], self.unit), np.array(counts, np.int64)[order]


def _rows(keys: np.ndarray, unit: int) -> np.ndarray:
    return np.ascontiguousarray(keys).view(f">u{unit}").reshape(len(keys), LONGEST)


def windows_of(ids: np.ndarray, unit: int) -> np.ndarray:
    """The window from each place that begins a phrase of two words or more; 0 ends a piece."""
    padded = np.r_[ids, np.zeros(LONGEST, ids.dtype)]
    at = np.flatnonzero((ids != 0) & (padded[1 : len(ids) + 1] != 0))
    out = np.zeros((len(at), LONGEST), f">u{unit}")
    inside = np.ones(len(at), bool)
    for k in range(LONGEST):
        inside &= padded[at + k] != 0
        out[:, k] = np.where(inside, padded[at + k], 0)
    return out


def prefix_parts(windows: np.ndarray, parts: int) -> np.ndarray:
    """Partition of each window: by its words up to the first that is not heavy (odd ids are)."""
    value, inside = np.zeros(len(windows), np.uint64), np.ones(len(windows), bool)
    for k in range(LONGEST):
        own = windows[:, k].astype(np.uint64)
        value = np.where(inside, mix(value * np.uint64(0x9E3779B97F4A7C15) + own + np.uint64(1)), value)
        inside &= own % 2 == 1
    return (value % np.uint64(parts)).astype(np.int64)


def with_heavy_prefixes(windows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sorted run in which beginnings of heavy words only stand for themselves: ``m`` heavy ids and
    zeros are the phrase of these ids, with its count in all windows of the run."""
    heavy, changed = np.ones(len(windows), bool), np.zeros(len(windows), bool)
    changed[:1] = True
    found, sums = [], []
    for k in range(LONGEST):
        changed[1:] |= windows[1:, k] != windows[:-1, k]
        heavy &= windows[:, k] % 2 == 1
        if 0 < k < LONGEST - 1:
            at = np.flatnonzero(changed)
            own = heavy[at]
            prefixes = windows[at[own]].copy()
            prefixes[:, k + 1 :] = 0
            found.append(prefixes)
            sums.append(np.add.reduceat(counts, at)[own] if len(at) else counts[:0])
    # Of windows that end early, those of heavy words only are among the beginnings.
    whole = (windows == 0).any(axis=1) & ((windows % 2 == 1) | (windows == 0)).all(axis=1)
    return np.concatenate([windows[~whole], *found]), np.concatenate([counts[~whole], *sums])


def packed_run(windows: np.ndarray, counts: np.ndarray) -> bytes:
    """A run, column by column, the lowest bytes of a column first."""
    n, unit = len(counts), windows.itemsize
    columns = np.ascontiguousarray(windows.T.astype(f"<u{unit}")).view(np.uint8).reshape(LONGEST, n, unit)
    planes = np.ascontiguousarray(columns.transpose(0, 2, 1)).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(n.to_bytes(8, "big") + planes + varints(counts)[0])


def unpacked_run(data: bytes, unit: int) -> tuple[np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(data[:8], "big")
    end = 8 + n * unit * LONGEST
    planes = np.frombuffer(data[8:end], np.uint8).reshape(LONGEST, unit, n)
    columns = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(f"<u{unit}").reshape(LONGEST, n)
    return columns.T, from_varints(data[end:]).astype(np.int64)


def _count(parts: int, unit: int, burst: int, full: int):
    """Runs of one block."""

    def dealt(windows: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        windows, counts = with_heavy_prefixes(windows, counts)
        part = prefix_parts(windows, parts)
        order = np.argsort(part, kind="stable")
        bounds = np.r_[np.flatnonzero(np.r_[True, np.diff(part[order]) != 0]), len(part)]
        rows = [order[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return pd.DataFrame({"part": [part[x[0]] for x in rows], "run": [packed_run(windows[x], counts[x]) for x in rows]})

    def count(blocks: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"part": np.zeros(0, np.int64), "run": np.zeros(0, object)})]
        for data in blocks["codes"]:
            codes = from_varints(data)
            ids = np.zeros(int(codes.max(initial=0)) + 1, np.int64)
            ids[words["no"].to_numpy(np.int64) + 1] = words["id"].to_numpy(np.int64)
            windows = windows_of(ids[codes], unit)
            trie = HatTrie(unit, burst, full)
            for i in range(0, len(windows), CHUNK):
                out += [dealt(*run) for run in trie.add(windows[i : i + CHUNK])]
            out += [dealt(*run) for run in trie.spill()]
        return pd.concat(out)

    return count


def _merge(unit: int, least: int):
    """The frequent phrases of one prefix partition."""

    def merge(runs: pd.DataFrame) -> pd.DataFrame:
        found = [unpacked_run(run, unit) for run in runs["run"]]
        windows = np.concatenate([w for w, _ in found]).astype(f">u{unit}")
        counts = np.concatenate([n for _, n in found])
        # Runs are sorted, and a stable sort of bytes merges them.
        order = np.argsort(np.ascontiguousarray(windows).view(f"S{unit * LONGEST}").ravel(), kind="stable")
        windows, counts = np.ascontiguousarray(windows[order]), counts[order]
        changed, heavy = np.zeros(len(windows), bool), np.ones(len(windows), bool)
        changed[0] = True
        grams, sums = [], []
        for k in range(LONGEST):
            changed[1:] |= windows[1:, k] != windows[:-1, k]
            heavy &= windows[:, k] % 2 == 1
            if k == 0:
                continue
            at = np.flatnonzero(changed)
            # Of heavy words only those rows count that stand for this phrase.
            other = heavy & (windows[:, k + 1] != 0) if k < LONGEST - 1 else np.zeros(len(heavy), bool)
            total = np.add.reduceat(np.where(other, 0, counts), at)
            kept = (windows[at, k] != 0) & (total >= least)
            names = np.ascontiguousarray(windows[at[kept], : k + 1])
            grams += [row.tobytes() for row in names]
            sums.append(total[kept])
        return pd.DataFrame({"gram": grams, "f": np.concatenate(sums)})

    return merge


def count_phrases(docs: DataFrame, least: int, block_words: int, part_windows: int, burst: int, full: int):
    """``(gram, f, word, lang)`` of the words and ``(gram, f)`` of the phrases that occur often enough,
    ``(lang, n)`` of the languages, and the bytes of an id."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang")
    texts = docs.where("text is not null").select(lang, F.col("text").cast("string").alias("text"))
    blocks = stored(texts.mapInArrow(_blocks(block_words), BLOCKS), "phrase-blocks")
    add = F.aggregate("counts", F.lit(0).cast("bigint"), lambda total, n: total + n)
    langs = stored(blocks.groupBy("lang").agg(F.sum(add).alias("n")), "phrase-langs")
    uses = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("no", "use"))
    uses = uses.select("block", "lang", "no", F.col("use.words").alias("word"), F.col("use.counts").alias("n"))
    counted = uses.groupBy("lang", "word").agg(F.sum("n").alias("f"))
    # Small ids for frequent words: most bytes of a window are zero then.
    ranked = with_ids(counted.orderBy(F.desc("f"), "lang", "word"))
    total, n_ids = langs.agg(F.sum("n")).first()[0] or 0, ranked.count()
    unit = 4 if n_ids < (1 << 31) - 1 else 8
    # An odd id is that of a heavy word.
    heavy = (F.col("f") > part_windows // HEAVY).cast("bigint")
    named = ranked.select("lang", "word", "f", (F.col("id") * 2 + heavy).alias("id"))
    known = uses.join(named, ["lang", "word"]).select("block", "no", "id")
    parts = max(1, -(-total // part_windows))
    runs = (
        blocks.select(F.col("block").alias("of"), "codes")
        .groupBy("of")
        .cogroup(known.groupBy("block"))
        .applyInPandas(_count(parts, unit, burst, full), "part bigint, run binary")
    )
    phrases = runs.groupBy("part").applyInPandas(_merge(unit, least), "gram binary, f bigint")
    gram = F.unhex(F.lpad(F.hex("id"), 2 * unit, "0")).alias("gram")
    return named.select(gram, "f", "word", "lang"), stored(phrases, "phrase-counts"), langs, unit


def _bytes(first: Column | int, size: Column | int) -> Column:
    return F.substring(F.col("gram"), F.lit(first) if isinstance(first, int) else first, F.lit(size) if isinstance(size, int) else size)


def scored(words: DataFrame, phrases: DataFrame, langs: DataFrame, unit: int) -> DataFrame:
    """``(gram, lang, n, a, l, r, score)`` of each candidate at its lowest cut."""
    units = (F.octet_length("gram") / unit).cast("int")
    k = F.explode(F.sequence(F.lit(1), units - 1)).alias("k")
    counts = words.select("gram", "f", "lang").unionByName(phrases.select("gram", "f", F.lit(None).cast("string").alias("lang")))
    cut_up = phrases.select("gram", F.col("f").alias("a"), k).select(
        "gram", "a", "k", _bytes(1, F.col("k") * unit).alias("left"), _bytes(F.col("k") * unit + 1, F.octet_length("gram")).alias("right")
    )
    left = counts.select(F.col("gram").alias("left"), F.col("f").alias("l"), "lang")
    right = counts.select(F.col("gram").alias("right"), F.col("f").alias("r"))
    cuts = (
        cut_up.join(left, "left")
        .join(right, "right")
        .groupBy("gram", "a")
        .agg(F.max("lang").alias("lang"), F.collect_list(F.struct("k", "l", "r")).alias("cuts"))
        .join(langs, "lang")
    )

    def wide(name: str | Column) -> Column:
        return (F.col(name) if isinstance(name, str) else name).cast("decimal(19,0)")

    def at(one: Column) -> Column:
        above = (F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(15,0)") * wide("n")).cast("decimal(38,0)")
        score = F.call_function("div", above, wide(one["l"]) * wide(one["r"]))
        return F.struct(score.alias("score"), one["k"].alias("k"), one["l"].alias("l"), one["r"].alias("r"))

    lowest = F.array_min(F.transform("cuts", at)).alias("lowest")
    return cuts.select("gram", "lang", "n", "a", lowest).select("gram", "lang", "n", "a", "lowest.l", "lowest.r", "lowest.score")


def not_inside(candidates: DataFrame, phrases: DataFrame, unit: int) -> DataFrame:
    """``candidates`` but for those inside a longer one with the same count."""
    size = F.octet_length("gram")
    ends = F.array(_bytes(1, size - unit), _bytes(unit + 1, size))
    longer = (
        phrases.where(size > 2 * unit)
        .select(F.explode(ends).alias("gram"), "f")
        .groupBy("gram")
        .agg(F.max("f").alias("longer"))
    )
    return candidates.join(longer, "gram", "left").where("longer is null or longer < a").drop("longer")


def mine(
    docs: DataFrame, least: int = LEAST, top: int = TOP, block_words: int = BLOCK_WORDS,
    part_windows: int = PART_WINDOWS, burst: int = BURST, full: int = TRIE_ENTRIES,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language."""
    words, phrases, langs, unit = count_phrases(docs, least, block_words, part_windows, burst, full)
    candidates = not_inside(scored(words, phrases, langs, unit), phrases, unit)
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # All that tie with the last one stay, until the phrases are spelled out.
    best = candidates.withColumn("place", F.rank().over(by_score)).where(F.col("place") <= top)
    at = F.explode(F.sequence(F.lit(0), (F.octet_length("gram") / unit).cast("int") - 1)).alias("at")
    spelled = (
        best.select("*", at)
        .withColumn("one", _bytes(F.col("at") * unit + 1, unit))
        .join(words.select(F.col("gram").alias("one"), "word"), "one")
        .groupBy("gram", "lang", "a", "l", "r", "n", "score")
        .agg(F.array_join(F.sort_array(F.collect_list(F.struct("at", "word")))["word"], " ").alias("phrase"))
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    numbers = [F.col(name).cast("bigint").alias(name) for name in ("a", "l", "r", "n", "score")]
    return spelled.select("lang", rank.cast("bigint").alias("rank"), "phrase", *numbers).where(F.col("rank") <= top)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(read(spark, sf_dir, "documents"))


ORACLE = f"""
WITH texts AS (
  SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts
), worded AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words FROM pieces
), places AS (
  SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM worded, range(1, {LONGEST + 1}) AS r(m)
), counts AS (SELECT lang, m, words[i:i + m - 1] AS gram, count(*) AS f FROM places GROUP BY ALL
), langs AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang
), candidates AS (SELECT lang, m, gram, f AS a FROM counts WHERE m > 1 AND f >= {LEAST}
), cuts AS (
  SELECT c.lang, c.m, c.gram, c.a, n, k, x.f AS l, y.f AS r, (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
  FROM candidates c JOIN langs USING (lang) JOIN range(1, {LONGEST}) AS r(k) ON k < c.m
  JOIN counts x ON x.lang = c.lang AND x.gram = c.gram[1:k] JOIN counts y ON y.lang = c.lang AND y.gram = c.gram[k + 1:]
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1
), kept AS (
  SELECT lang, array_to_string(gram, ' ') AS phrase, a, l, r, n, score FROM lowest s WHERE NOT EXISTS (
    SELECT 1 FROM candidates b WHERE b.lang = s.lang AND b.m > s.m AND 100 * b.a >= 100 * s.a
    AND contains(' ' || array_to_string(b.gram, ' ') || ' ', ' ' || array_to_string(s.gram, ' ') || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       score::BIGINT AS score
FROM kept QUALIFY rank <= {TOP}
"""

QUERIES: dict[str, Query] = {"op12_collocations": op12_collocations}
ORACLES = {"op12_collocations": ORACLE}
