"""Word and shingle hashes of Arrow string columns with numpy, no Python loop over words.

Words are runs of bytes other than space and the controls from tab to carriage return, A-Z lowered. A word's hash joins two
polynomials in its bytes modulo two primes of 31 bits, each cut out of a running sum, mixed with its length. (Modulo a power of
two, words with a repeating pattern of letters would collide.) Long texts are worked through in segments that end at a
separator, so memory per byte of text stays small.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
# (prime, base): 2^31 - 1 and the prime below it.
FIELDS = ((2147483647, 1640531527), (2147483629, 1181783497))
U = np.uint64


@cache
def _tables():
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    is_word = np.ones(256, dtype=bool)
    is_word[[9, 10, 11, 12, 13, 32]] = False
    return lower, is_word


def _row_of_powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 to base^n modulo a prime, each step doubling the row."""
    out = np.ones(1, dtype=np.int64)
    while len(out) <= n:
        out = np.concatenate([out, out * pow(base, len(out), prime) % prime])
    return out[: n + 1]


@cache
def _powers(n: int):
    """Per field: powers of the base and of its inverse."""
    return [(prime, _row_of_powers(base, prime, n), _row_of_powers(pow(base, -1, prime), prime, n)) for prime, base in FIELDS]


def _running(piece: np.ndarray, up: np.ndarray, prime: int) -> np.ndarray:
    """Sums of the terms before each place, modulo the prime at the start of each block: no sum exceeds 63 bits."""
    out = np.zeros(len(piece) + 1, dtype=np.int64)
    for first in range(0, len(piece), SEGMENT):
        block = piece[first : first + SEGMENT]
        np.cumsum((block.astype(np.int64) + 1) * up[first : first + len(block)], out=out[first + 1 : first + 1 + len(block)])
        out[first + 1 : first + 1 + len(block)] += out[first] % prime
    return out


def polynomials(piece: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """62-bit hashes of the byte ranges [start, end) of ``piece``."""
    h = np.zeros(len(starts), dtype=np.int64)
    for prime, up, down in _powers(max(SEGMENT, 1 << len(piece).bit_length())):
        run = _running(piece, up, prime)
        h = (h << 31) | ((run[ends] - run[starts]) % prime * down[starts] % prime)
    return h.view(U)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> U(30))
        h = h * U(0xBF58476D1CE4E5B9)
        h = h ^ (h >> U(27))
        h = h * U(0x94D049BB133111EB)
        return h ^ (h >> U(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def alphanumeric() -> np.ndarray:
    """Bytes of words made of 0-9, a-z and everything beyond ASCII."""
    inside = np.zeros(256, dtype=bool)
    inside[48:58] = inside[97:123] = inside[128:] = True
    return inside


def _segments(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """(first, last) byte ranges of about SEGMENT bytes that cut no word: they end where a document or a separator ends."""
    first, end = int(offsets[0]), int(offsets[-1])
    while first < end:
        last = min(end, first + SEGMENT)
        if last < end:
            cut = int(offsets[np.searchsorted(offsets, last, side="right") - 1])
            if cut <= first:
                look = last
                while look < end and is_word[data[look]] and look not in offsets:
                    step = np.flatnonzero(~is_word[data[look : look + 4096]])
                    bound = int(offsets[np.searchsorted(offsets, look, side="right")])
                    look = min(bound, look + (int(step[0]) if len(step) else 4096))
                cut = look
            last = cut
        yield first, last
        first = last


def words(data: np.ndarray, offsets: np.ndarray, fold: bool = True, is_word: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document index) of every word, in order. ``is_word`` tells which (folded) bytes belong to words."""
    hashes, owners = [], []
    lower, blank_free = _tables()
    is_word = blank_free if is_word is None else is_word
    with np.errstate(over="ignore"):
        for first, last in _segments(data, offsets, is_word[lower] if fold else is_word):
            piece = lower[data[first:last]] if fold else data[first:last]
            inside = is_word[piece]
            edge = np.zeros(last - first + 1, dtype=bool)
            edge[0] = True
            low, high = np.searchsorted(offsets, (first, last))
            edge[offsets[low:high] - first] = True
            before = np.concatenate([[False], inside[:-1]])
            starts = np.flatnonzero(inside & (~before | edge[:-1]))
            after = np.concatenate([inside[1:], [False]])
            ends = np.flatnonzero(inside & (~after | np.concatenate([edge[1:-1], [True]]))) + 1
            h = polynomials(piece, starts, ends)
            hashes.append(mix(h + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93)))
            owners.append(np.searchsorted(offsets, starts + first, side="right") - 1)
    if not hashes:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def shingles(hashes: np.ndarray, owners: np.ndarray, n_docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``size``-word shingles per document: (sorted hashes, offsets). A shorter document's whole sequence is its only one."""
    counts = np.bincount(owners, minlength=n_docs)
    with np.errstate(over="ignore"):
        full = max(0, len(hashes) - size + 1)
        s = hashes[:full].copy()
        for k in range(1, size):
            s = mix(s * U(3) + hashes[k : k + full])
        keep = owners[:full] == owners[size - 1 : size - 1 + full] if full else np.zeros(0, bool)
        own = owners[:full][keep]
        s = s[keep]
        # Whole sequences of one to size - 1 words; the word count enters, so they equal no full shingle.
        first = np.concatenate([[0], np.cumsum(counts)])
        short = np.flatnonzero((counts > 0) & (counts < size))
        if len(short):
            t = hashes[first[short]].copy()
            for k in range(1, size - 1):
                more = counts[short] > k
                t[more] = mix(t[more] * U(3) + hashes[first[short[more]] + k])
            s = np.concatenate([s, mix(t + counts[short].astype(U))])
            own = np.concatenate([own, short])
    order = np.lexsort((s, own))
    s, own = s[order], own[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s[1:] != s[:-1]) | (own[1:] != own[:-1])
    s, own = s[new], own[new]
    return s, np.concatenate([[0], np.cumsum(np.bincount(own, minlength=n_docs))]).astype(np.int64)


def packed(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Runs of 64-bit values as a binary column."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * 8).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a column that ``packed`` made."""
    data, offsets = buffers(column)
    return np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), dtype=U), (offsets - offsets[0]) // 8
