"""Vectorised hashing of words and word shingles over Arrow batches.

A word is a maximal run of bytes other than ASCII white space (0x20 and
0x09-0x0D) of the lower-cased text. A batch is worked on in slices of about
SLICE_BYTES, and a text that is longer in windows that end at white space, so
what is held besides a batch and a text's word hashes is bounded by SLICE_BYTES
(or by one word, if it is longer).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once.
SLICE_BYTES = 1 << 18
#: Texts handled at once.
SLICE_ROWS = 2048
#: Bytes whose 64-bit sums are held at once.
_PIECE = 1 << 16
#: Words in a shingle.
SHINGLE = 5

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_MIX_A, _MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX_A
    x ^= x >> np.uint64(33)
    x *= _MIX_B
    x ^= x >> np.uint64(33)
    return x


def fresh(name: str, taken: Sequence[str]) -> str:
    """The name, with underscores until none of the taken ones is the same."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def salt(n: int) -> np.uint64:
    return mix(np.array([n], np.uint64) + _BASE)[0]


def unit(x: np.ndarray) -> np.ndarray:
    """Uniform doubles in [0, 1) from 64-bit hashes."""
    return (x >> np.uint64(11)).astype(np.float64) * (1.0 / (1 << 53))


def _powers_of(which: str, base: np.uint64) -> np.ndarray:
    """Powers 0 to _PIECE of ``base`` modulo 2**64."""
    if which not in _powers:
        out = np.full(_PIECE + 1, base, np.uint64)
        out[0] = 1
        _powers[which] = np.multiply.accumulate(out)
    return _powers[which]


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive slices of a string column; null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if not len(texts):
        return
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, min(at + SLICE_ROWS, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1))
        yield at, raw[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def _after_word(here: np.ndarray) -> np.ndarray:
    """For each byte but the first three, whether the character before it is surely no white space, within ASCII or beyond."""
    one, two, three = here[2:-1], here[1:-2], here[:-3]
    wide = (one >= 0x80) & (two != 0xC2) & (three != 0xE1) & (three != 0xE2) & ((three != 0xE3) | (two != 0x80))
    return _VISIBLE[one] | wide


def windows(raw: np.ndarray, tokens: bool = False) -> Iterator[np.ndarray]:
    """One text in parts of about SLICE_BYTES, each but the first beginning with white space, so that no word goes across a cut.

    ``tokens``: only where that white space follows a character of another kind,
    where every byte-level pre-tokenisation cuts as well. A part is longer only
    if it has no such place.
    """
    at = 0
    while len(raw) - at > SLICE_BYTES:
        cut, reach = 0, at + SLICE_BYTES
        while not cut and reach < len(raw):
            first = max(at + 3, reach - SLICE_BYTES)
            here = raw[first - 3 : reach]
            found = np.flatnonzero(_SPACE[here[3:]] & _after_word(here)) if tokens else np.flatnonzero(_SPACE[here[3:]])
            if len(found):
                cut = first + int(found[-1])
            reach += SLICE_BYTES
        if not cut:
            break
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def token_parts(texts: pa.Array, cut: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """(first row, bytes, offsets, whether its rows end here): slices, and for a long text its windows where every byte-level pre-tokenisation cuts (unless not ``cut``)."""
    for at, raw, offsets in slices(texts):
        if len(raw) <= SLICE_BYTES or not cut:
            yield at, raw, offsets, True
            continue
        left = len(raw)
        for part in windows(raw, tokens=True):
            left -= len(part)
            yield at, part, np.array([0, len(part)]), left == 0


def low(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slice with its texts lower-cased."""
    texts = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(raw)))
    _, after, data = pc.utf8_lower(texts).buffers()
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), np.frombuffer(after, np.int64)[: len(offsets)]


def word_hashes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of the lower-cased words, for each row the index of its first word) of consecutive slices of a string column."""
    for at, raw, offsets in slices(texts):
        if len(raw) <= SLICE_BYTES:
            h, _, _, firsts = words(*low(raw, offsets))
        else:
            h, n = np.empty(len(raw) // 2 + 1, np.uint64), 0  # as many words as there can be; what isn't written takes no memory
            for part in windows(raw):
                found = words(*low(part, np.array([0, len(part)])))[0]
                h[n : n + len(found)] = found
                n += len(found)
            h, firsts = h[:n], np.array([0, n])
        given = [h]
        del h  # the caller's alone
        yield at, given.pop(), firsts


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word, and for each row the index of its first word (one more at the end)."""
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    solid = ~_SPACE[raw]
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = ~solid[:-1]
    inner = offsets[:-1][offsets[:-1] < n]
    first[inner] = True
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = ~solid[1:]
    last[inner[inner > 0] - 1] = True
    start = np.flatnonzero(solid & first)
    end = np.flatnonzero(solid & last) + 1
    h = np.zeros(len(start), np.uint64)
    up, down = _powers_of("p", _BASE), _powers_of("i", _INVERSE)
    sums = np.zeros(min(n, _PIECE) + 1, np.uint64)
    for left in range(0, n, _PIECE):
        right = min(n, left + _PIECE)
        np.cumsum((raw[left:right].astype(np.uint64) + np.uint64(1)) * up[: right - left], out=sums[1 : right - left + 1])
        a, b = int(np.searchsorted(end, left, "right")), int(np.searchsorted(start, right))
        if a == b:
            continue
        part = sums[np.minimum(end[a:b], right) - left] - sums[np.maximum(start[a:b] - left, 0)]
        scale = down[np.maximum(start[a:b] - left, 0)]
        if start[a] < left:  # a word that began in an earlier piece
            scale[0] = pow(int(_BASE), int(left - start[a]), 1 << 64)
        h[a:b] += part * scale
    return mix(h ^ ((end - start).astype(np.uint64) << np.uint64(48))), start, end, np.searchsorted(start, offsets)


def shingles(hashes: np.ndarray, firsts: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each shingle of ``size`` words, and for each row the index of its first shingle.

    A row of fewer words, but one at least, has one shingle of all its words.
    """
    if len(firsts) == 2 and len(hashes) > size:  # one long text: no index of places
        out = np.empty(len(hashes) - size + 1, np.uint64)
        for at in range(0, len(out), _PIECE):
            acc = np.zeros(min(_PIECE, len(out) - at), np.uint64)
            for k in range(size):
                acc = _stepped(acc, hashes[at + k : at + k + len(acc)], k)
            out[at : at + len(acc)] = mix(acc)
        return out, np.array([0, len(out)])
    counts = np.diff(firsts)
    per_row = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_firsts = np.concatenate([[0], np.cumsum(per_row)])
    total = int(out_firsts[-1])
    at = np.repeat(firsts[:-1] - out_firsts[:-1], per_row) + np.arange(total)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    left = np.repeat(firsts[1:], per_row)
    acc = np.zeros(total, np.uint64)
    short = bool((counts < size).any())
    for k in range(size):
        h = padded[at + k]
        if short:
            h = np.where(at + k < left, h, np.uint64(0))
        acc = _stepped(acc, h, k)
    return mix(acc), out_firsts


def _stepped(acc: np.ndarray, h: np.ndarray, k: int) -> np.ndarray:
    """Word ``k`` of each shingle taken into its running hash."""
    acc = acc + h * _STEP[k % 5]
    acc ^= acc >> np.uint64(29)
    acc *= _MIX_A
    return acc


def bags(hashes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, element and multiplicity of the distinct shingles of each row, sorted by row and element. ``hashes`` of a single row are sorted in place."""
    if len(firsts) == 2:
        hashes.sort()
        new = np.ones(len(hashes), bool)
        np.not_equal(hashes[1:], hashes[:-1], out=new[1:])
        n = int(new.sum())
        if n == len(hashes):
            return np.broadcast_to(np.int64(0), n), hashes, np.broadcast_to(np.int64(1), n)
        at = np.flatnonzero(new)
        del new
        elem = hashes[at]
        counts = np.empty(n, np.int64)
        np.subtract(at[1:], at[:-1], out=counts[:-1])
        counts[-1:] = len(hashes) - at[-1:]
        return np.broadcast_to(np.int64(0), n), elem, counts
    rows = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    if not len(h):
        return r, h, np.zeros(0, np.int64)
    new = np.empty(len(h), bool)
    new[0] = True
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return r[at], h[at], np.diff(np.concatenate([at, [len(h)]]))
