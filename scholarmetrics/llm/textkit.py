"""Vectorised helpers on the UTF-8 buffer of an Arrow string column.

Functions work on a flat byte array ``u8`` and the offsets of its rows, so no
Python object is made per word.  Memory stays a small multiple of ``PIECE``
bytes however many rows a batch has; a single longer word or row is the only
thing that raises it.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18

_rng = np.random.Generator(np.random.PCG64(20240229))
#: One random 64-bit value per byte; A-Z share those of a-z in the folded table.
BYTE_CODE = _rng.integers(1, 2**64 - 1, 256, dtype=np.uint64) | np.uint64(1)
FOLDED_CODE = BYTE_CODE.copy()
FOLDED_CODE[65:91] = BYTE_CODE[97:123]
#: Spans of bytes are hashed by two polynomials modulo this prime; a power of two as
#: modulus would give whole families of texts one value, whatever the base.
_PRIME = np.uint64(2**31 - 1)
_BASES = (0x3C6EF372 | 1, 0x1F83D9AB | 1)
#: Multipliers of the places in a shingle, and seeds for its number of words.
_PLACE = _rng.integers(1, 2**64 - 1, 64, dtype=np.uint64) | np.uint64(1)
_LENGTH = _rng.integers(1, 2**64 - 1, 64, dtype=np.uint64)

#: White space of the word rule [^\x20\x09-\x0D]+.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Bytes outside of words of ASCII letters and digits and other characters.
IS_MARK = np.ones(256, bool)
IS_MARK[48:58] = IS_MARK[65:91] = IS_MARK[97:123] = IS_MARK[128:] = False

_powers: list[np.ndarray] = []


def _power(base: int, n: int) -> np.ndarray:
    """base**i modulo the prime for i < n."""
    out, p = np.ones(n, np.uint64), int(_PRIME)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, p)) % _PRIME
        done += more
    return out


def powers(n: int) -> list[np.ndarray]:
    """base**i and base**-i of both bases for i < n."""
    if not _powers or len(_powers[0]) < n:
        most = max(n, PIECE + 4096)
        _powers[:] = [_power(b, most) for base in _BASES for b in (base, pow(base, -1, int(_PRIME)))]
    return [x[:n] for x in _powers]


def span_hashes(u8: np.ndarray, begin: np.ndarray, end: np.ndarray, code: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the byte ranges from ``begin`` to ``end`` (not empty): two values
    of 31 bits, mixed.  Ranges of n different bytes agree with a chance of at most
    (n / 2**31)**2 over the choice of the bases, and about 2**-62 over that of the codes."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    code = BYTE_CODE if code is None else code
    held = powers(len(u8))
    out = np.zeros(len(begin), np.uint64)
    for k, (up, down) in enumerate(((held[0], held[1]), (held[2], held[3]))):
        v = ((code >> np.uint64(32 * k)) & _PRIME)[u8]
        v *= up
        v = (v & _PRIME) + (v >> np.uint64(31))  # below 2**32, so sums of 2**31 fit
        total = np.cumsum(v, dtype=np.uint64)
        h = total[end - 1] - np.where(begin > 0, total[begin - 1], np.uint64(0))
        out |= (h % _PRIME * down[begin] % _PRIME) << np.uint64(32 * k)
    return mix(out)


def give_back() -> None:
    """Return freed memory to the system, where the C library keeps it for itself: idle
    workers of earlier stages stay beside those that work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15
_rolling: list[np.ndarray] = []


def rolling(u8: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all ranges of ``width`` bytes, a few hundred at most: one polynomial
    modulo 2**64, whose values are equal for some texts of a thousand bytes or more."""
    if not _rolling or len(_rolling[0]) < len(u8):
        most = max(len(u8), PIECE + 4096)
        for b in (_BASE, pow(_BASE, -1, 2**64)):
            a = np.full(most, b, np.uint64)
            a[0] = 1
            _rolling.append(np.cumprod(a))
        del _rolling[:-2]
    up, down = _rolling
    total = np.append(np.uint64(0), np.cumsum(BYTE_CODE[u8] * up[: len(u8)], dtype=np.uint64))
    return mix((total[width:] - total[:-width]) * down[: len(u8) - width + 1])


def flat(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary Arrow array; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    u8 = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return u8[off[0] : off[-1]], off - off[0]


def blocks(offsets: np.ndarray, most: int | None = None):
    """Ranges of rows whose bytes add up to about ``most`` (``2 * PIECE``), one row at least.
    After the last range, what the caller has freed goes back to the system."""
    most = 2 * PIECE if most is None else most
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j
    give_back()


def words(u8: np.ndarray, offsets: np.ndarray, code: np.ndarray = FOLDED_CODE, blank: np.ndarray = IS_SPACE):
    """(64-bit hash of each word, index of the first word of each row).

    A word is a run without ``blank`` bytes (white space) inside one row.
    """
    n = len(u8)
    out, first_at = [], []
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    at = 0
    while at < n:
        end = min(n, at + PIECE)
        while end < n:  # move on to a blank byte, where no word is cut
            hit = np.flatnonzero(blank[u8[end : end + 65536]])
            if len(hit):
                end += int(hit[0])
                break
            end = min(n, end + 65536)
        part = u8[at:end]
        inside = ~blank[part]
        cuts = begins[np.searchsorted(begins, at) : np.searchsorted(begins, end)] - at
        is_start = inside.copy()
        is_start[1:] &= ~inside[:-1]
        is_start[cuts] = inside[cuts]
        is_last = inside.copy()
        is_last[:-1] &= ~inside[1:]
        cuts = cuts[cuts > 0]
        is_last[cuts - 1] = inside[cuts - 1]
        s, e = np.flatnonzero(is_start), np.flatnonzero(is_last)
        out.append(span_hashes(part, s, e + 1, code))
        first_at.append(s + at)
        at = end
    h = np.concatenate(out) if out else np.zeros(0, np.uint64)
    starts = np.concatenate(first_at) if first_at else np.zeros(0, np.int64)
    return h, np.searchsorted(starts, offsets)


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words of one sequence, in order."""
    m = len(h) - width + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(m, _LENGTH[width], np.uint64)
    for j in range(width):
        acc += h[j : j + m] * _PLACE[j]
    return mix(acc)


def shingle_set(h: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct shingles of one row's words; fewer words than ``width``
    give one shingle of all of them, no words give none."""
    if len(h) == 0:
        return np.zeros(0, np.uint64)
    return np.unique(shingles(h, min(width, len(h))))


def ragged(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list array from one numpy array per row."""
    offs = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offs[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(values, type=kind))
