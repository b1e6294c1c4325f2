"""Byte-level BPE over Arrow batches, one lookup for each pre-token.

The tokenizers library encodes about a megabyte a second, and most of what it
does is repeated: running text consists of few distinct pre-tokens. So the
byte-level pre-tokenisation is done on whole batches with array operations, and
the library encodes each distinct pre-token once for each worker. Results are
the library's, which tests compare text by text.

Texts that hold a special string of the tokenizer, or a character that changed
or got its Unicode category after version 3.2, are encoded by the library
whole, and so is every text if the file asks for a normaliser or for any
pre-tokeniser other than plain byte-level BPE.
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np

from attesta.llm._hash import mix

#: Bytes of a pre-token that goes through the table; longer ones have a dictionary of their own.
KEY_BYTES = 16
#: Bytes of longer ones that a worker remembers.
LONG_BYTES = 4 << 20
LETTER, NUMBER, OTHER, SPACE, UNSURE = range(5)
#: Suffixes that the byte-level pattern splits off after an apostrophe (fixed values).
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")

_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Byte-level models spell bytes that print as themselves, the others from 0x100 on, in order.
_ALPHABET = {b: b for b in _PRINTED} | {b: 0x100 + i for i, b in enumerate(x for x in range(256) if x not in set(_PRINTED))}
_classes: list[np.ndarray] = []
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1] * (KEY_BYTES - 7), np.uint64)


def char_classes() -> np.ndarray:
    """Class of each code point."""
    if not _classes:
        old = unicodedata.ucd_3_2_0.category
        white = {*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
        out = np.full(0x110000, UNSURE, np.uint8)
        for i in range(0x30000):
            now = unicodedata.category(c := chr(i))
            if i in white:
                out[i] = SPACE
            elif old(c)[0] == now[0] != "Z" and now != "Cn":
                out[i] = {"L": LETTER, "N": NUMBER}.get(now[0], OTHER)
        _classes.append(out)
    return _classes[0]


def byte_classes(raw: np.ndarray) -> np.ndarray:
    """Class of the character that each byte belongs to."""
    table = char_classes()
    out = table[:256][raw]
    if len(raw) and raw.max() >= 0x80:
        for low, high, more in ((0xC0, 0xE0, 1), (0xE0, 0xF0, 2), (0xF0, 0x100, 3)):
            at = np.flatnonzero((raw >= low) & (raw < high))
            if len(at):
                code = (raw[at] & (0x3F >> more)).astype(np.int64)
                for k in range(1, more + 1):
                    code = code << 6 | (raw[np.minimum(at + k, len(raw) - 1)] & 0x3F)
                kind = table[np.minimum(code, 0x10FFFF)]
                for k in range(more + 1):
                    out[np.minimum(at + k, len(raw) - 1)] = kind
    return out


def pieces(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of each pre-token, and the rows that hold a character of no sure class."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = byte_classes(raw)
    edge = np.zeros(n, bool)
    edge[offsets[:-1][offsets[:-1] < n]] = True
    new = edge.copy()
    new[1:] |= kind[1:] != kind[:-1]
    start = np.flatnonzero(new)
    unsure = np.unique(np.searchsorted(offsets, np.flatnonzero(kind == UNSURE), "right") - 1) if (kind == UNSURE).any() else np.zeros(0, np.int64)
    end = np.append(start[1:], n)
    what = kind[start]
    # The last white-space character before a run of another class: a blank joins that run, any other stands alone.
    followed = np.zeros(len(start), bool)
    followed[:-1] = (what[:-1] == SPACE) & ~edge[start[1:]]
    last = end - 1
    wide = followed & (raw[last] >= 0x80)
    while wide.any() and (back := wide & ((raw[last] & 0xC0) == 0x80)).any():
        last = np.where(back, last - 1, last)
    joins = followed & (raw[last] == 0x20)
    alone = followed & ~joins & (last > start)
    begin, finish = start.copy(), end.copy()
    finish[joins] = last[joins]
    finish[alone] = last[alone]
    begin[1:][joins[:-1]] -= 1
    keep = finish > begin
    firsts, lasts = [begin[keep], last[alone]], [finish[keep], end[alone]]
    # 's and the like: a lone apostrophe that no blank joins, right before letters.
    lone = np.flatnonzero((what[:-1] == OTHER) & (begin[:-1] == start[:-1]) & (end[:-1] - start[:-1] == 1) & (raw[start[:-1]] == 0x27) & (what[1:] == LETTER) & ~edge[start[1:]])
    begin, finish = np.concatenate(firsts), np.concatenate(lasts)
    if len(lone):
        cut, drop, text = {}, set(), raw.tobytes()
        for i in lone.tolist():
            a, b = int(start[i]), int(end[i + 1])
            for tail in CONTRACTIONS:
                if text.startswith(tail, a + 1) and a + 1 + len(tail) <= b:
                    drop |= {a, a + 1}
                    cut[a] = a + 1 + len(tail)
                    if a + 1 + len(tail) < b:
                        cut[a + 1 + len(tail)] = b
                    break
        if cut:
            stay = ~np.isin(begin, np.fromiter(drop, np.int64))
            begin = np.concatenate([begin[stay], np.fromiter(cut.keys(), np.int64)])
            finish = np.concatenate([finish[stay], np.fromiter(cut.values(), np.int64)])
    order = np.argsort(begin, kind="stable")
    return begin[order], (finish - begin)[order], unsure


class Tokenizer:
    """A tokenizer file, its pre-token table and its cache of long pre-tokens.

    ``slots`` (a power of two) bounds the table, LONG_BYTES the cache: both are
    emptied when either is full, so memory does not grow with the corpus.
    """

    def __init__(self, path: str, slots: int = 1 << 19, ids: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec.get("model", {})
        self.plain = (
            spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
            and model.get("type") == "BPE" and not model.get("dropout") and spec.get("truncation") is None and spec.get("padding") is None
        )
        added = spec.get("added_tokens", [])
        self.special = [t["content"].encode() for t in added]
        #: Whether a text may be encoded in parts that are cut before white space.
        self.cuts = self.plain and not any(t["content"].split() != [t["content"]] or t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)
        self.slots, self.ids = slots, ids
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0
        self._empty()

    def _empty(self) -> None:
        self.k1, self.k2 = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.uint64)
        self.len = np.zeros(self.slots, np.uint8)
        self.val = np.zeros(self.slots, np.int32)
        self.used = 0
        self.long.clear()
        self.long_bytes = 0
        self.pool, self.pool_n = np.zeros(1 << 16, np.uint32), 0
        self.at, self.n, self.values = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32), 0

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def pretokens(self, texts: list[bytes]) -> list[list[int]]:
        """Ids of texts that each are one pre-token: the library's model alone, without its pipeline."""
        tokenize = self.library.model.tokenize
        return [[t.id for t in tokenize(x.decode("latin-1").translate(_ALPHABET))] for x in texts]

    def _add(self, found: list[list[int]]) -> np.ndarray:
        """Value numbers for new pre-tokens with these ids."""
        sizes = np.fromiter(map(len, found), np.int32, len(found))
        first, self.values = self.values, self.values + len(found)
        while self.values > len(self.n):
            self.at, self.n = np.concatenate([self.at, np.zeros_like(self.at)]), np.concatenate([self.n, np.zeros_like(self.n)])
        self.n[first : self.values] = sizes
        if self.ids:
            flat = np.fromiter((i for x in found for i in x), np.uint32, int(sizes.sum()))
            while self.pool_n + len(flat) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.pool[self.pool_n : self.pool_n + len(flat)] = flat
            self.at[first : self.values] = self.pool_n + np.cumsum(sizes) - sizes
            self.pool_n += len(flat)
        return np.arange(first, self.values, dtype=np.int32)

    def _find(self, h: np.ndarray, k1: np.ndarray, k2: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Value number of each key, -1 where there is none."""
        out = np.full(len(h), -1, np.int32)
        left = np.arange(len(h))
        step, top = 0, np.uint64(self.slots - 1)
        while len(left):
            at = ((h[left] + np.uint64(step)) & top).astype(np.int64)
            have = self.len[at]
            hit = (self.k1[at] == k1[left]) & (self.k2[at] == k2[left]) & (have == size[left])
            out[left[hit]] = self.val[at[hit]]
            left = left[~hit & (have > 0)]
            step += 1
        return out

    def _put(self, h: np.ndarray, k1: np.ndarray, k2: np.ndarray, size: np.ndarray, value: np.ndarray) -> None:
        """Insert distinct keys that are not there."""
        left = np.arange(len(h))
        step, top = 0, np.uint64(self.slots - 1)
        while len(left):
            at = ((h[left] + np.uint64(step)) & top).astype(np.int64)
            free = np.flatnonzero(self.len[at] == 0)
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            to, what = at[won], left[won]
            self.k1[to], self.k2[to], self.len[to], self.val[to] = k1[what], k2[what], size[what], value[what]
            left = np.delete(left, won)
            step += 1
        self.used += len(h)

    def _values(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        if self.used * 2 > self.slots or self.long_bytes > LONG_BYTES:
            self._empty()
            self.warm()
        out = np.empty(len(start), np.int32)
        small = size <= KEY_BYTES
        padded = np.concatenate([raw, np.zeros(KEY_BYTES, np.uint8)])
        view = np.ndarray(shape=(len(padded) - 7,), dtype="<u8", buffer=padded.data, strides=(1,))
        s, n = start[small], size[small]
        k1 = view[s] & _MASKS[np.minimum(n, 8)]
        k2 = view[np.minimum(s + 8, len(raw))] & np.where(n > 8, _MASKS[np.maximum(n - 8, 0)], np.uint64(0))
        n8 = n.astype(np.uint8)
        h = mix(k1 + mix(k2 + n.astype(np.uint64)))
        got = self._find(h, k1, k2, n8)
        if len(miss := np.flatnonzero(got < 0)):
            order = miss[np.lexsort((n8[miss], k2[miss], k1[miss]))]
            new = np.ones(len(order), bool)
            new[1:] = (k1[order[1:]] != k1[order[:-1]]) | (k2[order[1:]] != k2[order[:-1]]) | (n8[order[1:]] != n8[order[:-1]])
            one = order[new]
            if (self.used + len(one)) * 4 > self.slots * 3:  # more distinct pre-tokens in one slice than the table takes
                self._grow(len(one))
            text = raw.tobytes()
            value = self._add(self.pretokens([text[a : a + b] for a, b in zip(s[one].tolist(), n[one].tolist(), strict=True)]))
            self._put(h[one], k1[one], k2[one], n8[one], value)
            got[order] = value[np.cumsum(new) - 1]
        out[small] = got
        if not small.all():
            text, long = raw.tobytes(), np.flatnonzero(~small)
            keys = [text[a : a + b] for a, b in zip(start[long].tolist(), size[long].tolist(), strict=True)]
            if absent := [k for k in dict.fromkeys(keys) if k not in self.long]:
                self.long.update(zip(absent, self._add(self.pretokens(absent)).tolist(), strict=True))
                self.long_bytes += sum(len(k) + 100 for k in absent)
            out[long] = [self.long[k] for k in keys]
        return out

    def _grow(self, more: int) -> None:
        live = self.len > 0
        k1, k2, size, value = self.k1[live], self.k2[live], self.len[live], self.val[live]
        while (self.used + more) * 4 > self.slots * 3:
            self.slots *= 2
        self.k1, self.k2, self.len, self.val = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.uint8), np.zeros(self.slots, np.int32)
        self.used = 0
        self._put(mix(k1 + mix(k2 + size.astype(np.uint64))), k1, k2, size, value)

    def warm(self) -> None:
        """Fill the table after it was emptied; a subclass may have something to fill it with."""

    def run(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another (none if ``ids`` is off), and the number of ids of each row."""
        rows = len(offsets) - 1
        counts, other = np.zeros(rows, np.int64), {}
        ids = np.zeros(0, np.uint32)
        apart = set(range(rows))
        if self.plain:
            start, size, unsure = pieces(raw, offsets)
            apart, text = set(unsure.tolist()), raw.tobytes()
            for word in self.special:
                at = text.find(word) if word else -1
                while at >= 0:
                    apart.add(int(np.searchsorted(offsets, at, "right")) - 1)
                    at = text.find(word, at + 1)
            row = np.searchsorted(offsets, start, "right") - 1
            if apart:
                keep = ~np.isin(row, np.fromiter(apart, np.int64))
                start, size, row = start[keep], size[keep], row[keep]
            value = self._values(raw, start, size)
            n = self.n[value]
            counts += np.bincount(row, n, rows).astype(np.int64)
            if self.ids:
                total, ends = int(n.sum()), np.cumsum(n)
                ids = self.pool[np.repeat(self.at[value] - (ends - n), n) + np.arange(total)]
        if apart:
            which = sorted(apart)
            text = raw.tobytes()
            for r, x in zip(which, self.whole([text[offsets[r] : offsets[r + 1]].decode() for r in which]), strict=True):
                other[r] = x
            before = np.concatenate([[0], np.cumsum(counts)])
            parts, at = [], 0
            for r in which:
                parts += [ids[at : before[r]], np.array(other[r], np.uint32)]
                at = int(before[r])
                counts[r] = len(other[r])
            ids = np.concatenate([*parts, ids[at:]]) if self.ids else ids
        return ids, counts
