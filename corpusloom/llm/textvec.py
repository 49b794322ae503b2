"""Vectorised text primitives on Arrow buffers: words, word hashes and shingles without one Python object per word.

A batch is handled as the UTF-8 buffer of an Arrow string column plus its offsets. Words are hashed eight bytes at a time
through a mixer. Sliding spans are hashed from polynomial prefix sums: modulo 2**64, with an odd base P,
H(s, e) = (S[e] - S[s]) * P**-s; structured bytes can collide there at any base, so what must tell spans apart takes
the hash modulo the prime 2**61 - 1 as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # text handled at once by a worker; one longer text makes a chunk of its own

_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(int(_P), -1, 1 << 64))
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all their bits depend on all input bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def rule_values(n: int, seed: int) -> np.ndarray:
    """n pseudo-random 64-bit values, the same in every process."""
    with np.errstate(over="ignore"):
        return mix(mix((np.arange(1, n + 1, dtype=np.uint64) * _P) ^ np.uint64(seed * 0x1000193 + 1)))


_BYTE = rule_values(256, 1)

_ALL = np.arange(256)
LOWER = _ALL.astype(np.uint8)
LOWER[65:91] += 32
#: [^\x20\x09-\x0D]: what the contracts call a word's characters.
NONSPACE = ~((_ALL == 32) | ((_ALL >= 9) & (_ALL <= 13)))
#: Letters of ASCII and every byte of longer characters; digits and punctuation separate.
LETTERS = ((_ALL | 32) >= 97) & ((_ALL | 32) <= 122) & (_ALL < 128) | (_ALL >= 128)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        n = max(n, CHUNK_BYTES + 1)
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)])) for x in (_P, _PINV)]
    return _powers[0], _powers[1]


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of successive row ranges; nulls are empty texts."""
    col = batch.column(batch.schema.get_field_index(column))
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
    n = len(col)
    if not n:
        return
    buffers = col.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[col.offset : col.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def word_spans(data: np.ndarray, offsets: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of `chars` in each text, and each text's offsets into them."""
    inside = chars[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    inner = offsets[1:-1]
    cut = inner[inner < len(data)]
    first[cut] = inside[cut]
    cut = inner[inner > 0] - 1
    last[cut] = inside[cut]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one little-endian number; data has seven bytes of padding at its end."""
    data = np.ascontiguousarray(data)
    return np.ndarray(len(data) - 7, "<u8", data, strides=(1,))


def word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lanes: int = 8) -> np.ndarray:
    """Hashes of spans, eight bytes after another; those of more than 8 * lanes bytes are digests of the whole span."""
    size = ends - starts
    with np.errstate(over="ignore"):
        h = (size.astype(np.uint64) + np.uint64(1)) * _P
    view = words_at(np.concatenate([data, np.zeros(8, np.uint8)]))
    live = np.flatnonzero(size <= 8 * lanes)
    for done in range(0, 8 * lanes, 8):
        live = live[size[live] > done]
        if not len(live):
            break
        unused = np.maximum(0, 8 - (size[live] - done)).astype(np.uint64) * np.uint64(8)
        lane = (view[starts[live] + done] << unused) >> unused
        h[live] = mix(h[live] ^ lane)
    for i in np.flatnonzero(size > 8 * lanes).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """S for span_hash()."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(len(data))[0][: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * _power(len(sums))[1][starts])


PRIME = np.uint64((1 << 61) - 1)
_prime_powers: list[np.ndarray] = []


def _fold(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def prime_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2**61 - 1 of numbers below it, in halves of 31 and 30 bits."""
    low, shift = np.uint64((1 << 31) - 1), np.uint64(31)
    ah, al, bh, bl = a >> shift, a & low, b >> shift, b & low
    middle = ah * bl + al * bh
    total = np.uint64(2) * ah * bh + (middle >> np.uint64(30)) + ((middle & np.uint64((1 << 30) - 1)) << shift)
    return _fold(_fold(total) + _fold(al * bl))


def _prime_power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo the prime, by doubling."""
    if not _prime_powers or len(_prime_powers[0]) < n:
        n = max(n, CHUNK_BYTES + 1)
        base = int(rule_values(1, 61)[0]) % int(PRIME)
        _prime_powers[:] = []
        for x in (base, pow(base, -1, int(PRIME))):
            out = np.ones(1, np.uint64)
            while len(out) < n:
                out = np.concatenate([out, prime_product(out, np.full(len(out), pow(x, len(out), int(PRIME)), np.uint64))])
            _prime_powers.append(out[:n])
    return _prime_powers[0], _prime_powers[1]


def prime_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums for prime_span_hash(), the powers in two halves; of at most 2**23 bytes."""
    power = _prime_power(len(data) + 1)[0][: len(data)]
    value = data.astype(np.uint64) + np.uint64(1)
    halves = power >> np.uint64(31), power & np.uint64((1 << 31) - 1)
    return tuple(np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * h)]) for h in halves)


def prime_span_hash(sums: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes modulo 2**61 - 1 of spans: different spans of n bytes agree for at most n of all bases."""
    high, low = (_fold(s[ends] - s[starts]) for s in sums)
    high = ((high << np.uint64(31)) & PRIME) | (high >> np.uint64(30))  # times 2**31
    return prime_product(_fold(high + low), _prime_power(len(sums[0]))[1][starts])


def gram_hash(words: np.ndarray, n: int, gap: int = 0, seed: int = 0) -> np.ndarray:
    """Hashes of (w[i], w[i+1+gap], ...) of n words for every i they exist for, over a whole chunk."""
    step = 1 + gap
    m = len(words) - (n - 1) * step
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(m, np.uint64(seed * 2654435761 + n), np.uint64)
    for j in range(n):
        h = (h ^ words[j * step : j * step + m]) * _P
        h ^= h >> np.uint64(29)
    return mix(h)


def within(word_offsets: np.ndarray, reach: int, total: int) -> np.ndarray:
    """For i below total - reach: whether words i and i + reach belong to one text."""
    if total <= reach:
        return np.zeros(0, bool)
    owner = np.repeat(np.arange(len(word_offsets) - 1), np.diff(word_offsets))
    return owner[: total - reach] == owner[reach:]
