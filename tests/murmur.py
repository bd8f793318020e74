"""Plain MurmurHash3 x86 32-bit, to test the column expression against."""


def rotate(value: int, bits: int) -> int:
    return (value << bits | value >> (32 - bits)) & 0xFFFFFFFF


def murmur3(data: bytes, seed: int = 0) -> int:
    """Signed hash of any bytes."""
    h = seed
    for start in range(0, len(data), 4):
        block = data[start : start + 4]
        k = int.from_bytes(block, "little") * 0xCC9E2D51 & 0xFFFFFFFF
        h ^= rotate(k, 15) * 0x1B873593 & 0xFFFFFFFF
        if len(block) == 4:
            h = (rotate(h, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def routing_hash(doc_id: str) -> int:
    return murmur3(doc_id.encode("utf-16-le"))
