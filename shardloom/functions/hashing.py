"""The routing hash of a document id, as built-in column expressions.

The hash is MurmurHash3 x86 32-bit, seed 0, over the id in UTF-16 little endian.
Spark's ``hash`` is the same function for inputs whose length is a multiple of 4,
except that it always starts from seed 42 and treats a shorter last block in its own
way.  Both differences are bridged here without leaving whole-stage codegen:

* ``hash(a, b)`` uses ``hash(a)`` as the seed of ``b``, so a literal that hashes to 0
  gives seed 0;
* UTF-16 has an even length, so the only short block is one of 2 bytes.  It is padded
  with zeros to 4 and hashed; then the steps that the standard leaves out for a short
  block (one rotate, one multiply-add) are undone and the length is put right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of MurmurHash3 x86 32-bit.
BLOCK_1 = 0xCC9E2D51
BLOCK_2 = 0x1B873593
MIX_1 = 0x85EBCA6B
MIX_2 = 0xC2B2AE35
BLOCK_MULTIPLIER = 5
BLOCK_ADDEND = 0xE6546B64

# Fixed values of the routing scheme: at most 2**10 virtual shards are reserved up front.
ROUTING_BITS = 10

WORD = 0xFFFFFFFF
SPARK_SEED = 42


INVERSES = {
    c: pow(c, -1, 1 << 32) for c in (BLOCK_1, BLOCK_2, MIX_1, MIX_2, BLOCK_MULTIPLIER)
}


def _signed(word: int) -> int:
    return word - (1 << 32) if word >> 31 else word


def _rotate(word: int, bits: int) -> int:
    return (word << bits | word >> (32 - bits)) & WORD


def int_hashing_to(value: int) -> int:
    """The INT whose ``hash`` in Spark is ``value``: the hash of an INT is one-to-one."""
    inverse = INVERSES
    h = value & WORD
    h = (h ^ h >> 16) * inverse[MIX_2] & WORD
    h = (h ^ h >> 13 ^ h >> 26) * inverse[MIX_1] & WORD
    h = (h ^ h >> 16) ^ 4
    h = _rotate((h - BLOCK_ADDEND) * inverse[BLOCK_MULTIPLIER] & WORD, 19) ^ SPARK_SEED
    return _signed(_rotate(h * inverse[BLOCK_2] & WORD, 17) * inverse[BLOCK_1] & WORD)


# Hashed first, it makes 0 the seed of what follows.
SEED_ZERO = int_hashing_to(0)


def num_routing_shards(num_shards: int) -> int:
    """Number of virtual shards behind ``num_shards`` real ones.

    Always ``num_shards`` times a power of two (at least 2), near 1024 where possible.
    """
    return num_shards << routing_shift(num_shards)


def routing_shift(num_shards: int) -> int:
    """log2 of the number of virtual shards per real shard."""
    if num_shards < 1:
        raise ValueError(f"number of shards must be >= 1, got {num_shards}")
    return max(1, ROUTING_BITS - (num_shards - 1).bit_length())


def _times(word: Column, constant: int) -> Column:
    """32-bit product in BIGINT, by halves so that ANSI mode never sees an overflow."""
    low, high = constant & 0xFFFF, constant >> 16
    return (word * low + (word * high).bitwiseAND(0xFFFF) * 65536).bitwiseAND(WORD)


def _xor_shift(word: Column, *shifts: int) -> Column:
    mixed = word
    for shift in shifts:
        mixed = mixed.bitwiseXOR(F.shiftright(word, shift))
    return mixed


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def with_routing_hash(df: DataFrame, id_column: str = "_id", output: str = "hash") -> DataFrame:
    """Add the signed 32-bit routing hash of ``id_column`` as INT column ``output``.

    Every step is its own projection: nested into one expression, the steps would repeat
    their input several times each and the tree would grow exponentially.  The result passes
    through a one-element ``explode``, still compiled code, because the optimizer moves no
    filter on a generated column below it; moved below the projections, a filter on the hash
    (the null check of a join, say) would be just that nested expression.
    """
    kept = [_quoted(name) for name in df.columns if name != output]
    word, size, whole = "__route_word", "__route_size", "__route_whole"

    def step(frame: DataFrame, value: Column) -> DataFrame:
        return frame.withColumn(word, value)

    w = F.col(word)
    inverse = {c: pow(c, -1, 1 << 32) for c in (MIX_1, MIX_2, BLOCK_MULTIPLIER)}

    out = df.withColumn(word, F.encode(_quoted(id_column), "UTF-16LE"))
    out = out.withColumn(size, F.octet_length(w).cast("bigint"))
    padded = F.when(F.col(size) % 4 == 0, w).otherwise(F.concat(w, F.lit(bytes(2))))
    out = out.withColumn(whole, F.hash(F.lit(SEED_ZERO), padded))
    # Undo the finalizer of the padded input.
    out = step(out, F.col(whole).cast("bigint").bitwiseAND(WORD))
    out = step(out, _times(_xor_shift(w, 16), inverse[MIX_2]))
    out = step(out, _times(_xor_shift(w, 13, 26), inverse[MIX_1]))
    out = step(out, _xor_shift(w, 16).bitwiseXOR(F.col(size) + 2))
    # Undo the multiply-add and the rotate by 13 that a short block does not get.
    out = step(out, _times((w - BLOCK_ADDEND).bitwiseAND(WORD), inverse[BLOCK_MULTIPLIER]))
    out = step(out, F.shiftright(w, 13).bitwiseOR(F.shiftleft(w, 19).bitwiseAND(WORD)))
    # Finalize with the true length.
    out = step(out, w.bitwiseXOR(F.col(size)))
    out = step(out, _times(_xor_shift(w, 16), MIX_1))
    out = step(out, _times(_xor_shift(w, 13), MIX_2))
    out = step(out, _xor_shift(w, 16))
    signed = F.when(w > 0x7FFFFFFF, w - (1 << 32)).otherwise(w).cast("int")
    result = F.when(F.col(size) % 4 == 0, F.col(whole)).otherwise(signed)
    return out.select(*kept, F.explode(F.array(result)).alias(output))
