"""SentencePiece encoding by an agenda of adjacent pairs, and decoding.

A merge-type (BPE) vocabulary is applied as it was made: every pair of adjacent
symbols that makes a piece waits in an agenda, the one of the highest score (the
leftmost of equals) is merged, its new neighbours enter the agenda, until none
is left. Characters without a piece become their bytes.

No merge goes across two characters that stand side by side in no piece. Arrow
batches are cut at such places, by a table of all pairs of characters in pieces,
and the agenda runs once a worker for each distinct segment: those of a batch side
by side, a row of pair scores for each, long ones by a heap. What it finds for a
segment is checked against the sentencepiece library right then, batch by batch,
and what is decoded against the library's text; where they differed the
library's would be taken and counted (``n_mended``, 0 on all that was tried).

Models of another kind of normalisation, with user-defined pieces or without
bytes for unknown characters are encoded by the library whole.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm import _bpe
from attesta.llm._hash import SLICE_BYTES, slices
from attesta.session import small_batches

#: What blanks become.
BLANK = "▁"
#: Characters of a segment from which on the library takes it: an agenda of so many pairs would need gigabytes.
RUN_CHARS = 1 << 20
#: Characters of a segment whose agenda is a row among others, and such rows at once.
ROW_CHARS, ROWS = 48, 1 << 14
#: Slots of the table of pairs; two pairs that share one only mean a cut less.
PAIR_SLOTS = np.uint32(1 << 22)
_MARK = BLANK.encode()
_LAST = np.int32(1 << 30)
_loaded: dict[str, Pieces] = {}


def _slot(codes: np.ndarray) -> np.ndarray:
    """Place in the table of pairs for each two characters that follow one another."""
    return ((codes[:-1] * np.uint32(0x9E3779B1)) ^ (codes[1:] * np.uint32(0x85EBCA6B)) >> np.uint32(7)) % PAIR_SLOTS


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(raw):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            at += size
            yield key >> 3, raw[at - size : at]


class Pieces(_bpe.Tokenizer):
    """A model file, the table of its segments' ids, and what decoding needs."""

    def __init__(self, path: str, slots: int = 1 << 20):
        from sentencepiece import SentencePieceProcessor

        self.library = sp = SentencePieceProcessor(model_file=path)
        spec = dict(x for x in _fields(sp.serialized_model_proto()) if x[0] in (2, 3))
        trained, norm = dict(_fields(spec.get(2, b""))), dict(_fields(spec.get(3, b"")))
        if trained.get(3, 1) != 2:  # model_type
            raise ValueError(f"{path} is no merge-type (BPE) model")
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        made = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        #: precompiled_charsmap, add_dummy_prefix, remove_extra_whitespaces, escape_whitespaces, treat_whitespace_as_suffix; pieces all of the normal type; blanks only where pieces begin.
        self.plain = (
            not norm.get(2) and norm.get(3, 1) == 1 and norm.get(4, 1) == 0 and norm.get(5, 1) == 1 and not trained.get(24) and all(map(sp.is_byte, self.byte))
            and all(x.get(3, 1) in (1, 2, 3, 6) for x in (dict(_fields(v)) for k, v in _fields(sp.serialized_model_proto()) if k == 1))
            and not any(BLANK in names[i].lstrip(BLANK) for i in made)
        )
        self.piece = {names[i]: (i, -sp.get_score(i)) for i in made}
        self.pairs = np.zeros(PAIR_SLOTS, bool)
        flat = np.frombuffer("\n".join(self.piece).encode("utf-32-le"), np.uint32)  # no piece has a line end
        self.plain = self.plain and not any("\n" in x for x in self.piece)
        self.pairs[_slot(np.where(flat == ord(BLANK), 0x20, flat))[(flat[:-1] != 0x0A) & (flat[1:] != 0x0A)]] = True
        self._symbols(names, made)
        self.bytes_of = [b"" if sp.is_control(i) else bytes([int(x[3:5], 16)]) if sp.is_byte(i) else x.replace(BLANK, " ").encode() for i, x in enumerate(names)]
        self.odd = {i for i in range(n) if sp.is_unknown(i)}
        self.slots, self.ids = slots, True
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0
        self.mended: set[int] = set()
        self._empty()

    def _empty(self) -> None:
        super()._empty()
        self.mended = set()

    def _symbols(self, names: list[str], made: list[int]) -> None:
        """Numbers for pieces and their characters, and for each two that make a piece its number and its place by score."""
        number = {names[i]: i for i in made}
        for c in sorted({c for x in self.piece for c in x} - number.keys()):
            number[c] = len(names) + len(number)
        self.symbol = np.full(0x110000, -1, np.int32)
        for x, i in number.items():
            if len(x) == 1:
                self.symbol[ord(x)] = i
        place = {v: k for k, v in enumerate(sorted({-s for _, s in self.piece.values()}, reverse=True))}
        made_of = {number[x[:k]] << 32 | number[x[k:]]: (i, place[-s]) for x, (i, s) in self.piece.items() for k in range(1, len(x)) if x[:k] in number and x[k:] in number}
        self.two = np.array(sorted(made_of), np.int64)
        self.one, self.place = (np.array([made_of[k][j] for k in self.two.tolist()], np.int32) for j in (0, 1))
        self.pieces_n = len(names)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each two symbols the piece that they make and its place, the last place of all where they make none."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.two, key), len(self.two) - 1)
        hit = (self.two[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.one[at], -1), np.where(hit, self.place[at], _LAST)

    def side_by_side(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of many short segments one after another, and how many each has: in every round each takes the best pair of its own agenda."""
        width, rows = int(sizes.max()), np.repeat(np.arange(len(sizes)), sizes)
        symbols = np.full((len(sizes), width), -1, np.int32)
        symbols[rows, np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = self.symbol[codes]
        piece, place = (x.reshape(len(sizes), -1) for x in self._pair(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()))
        piece, place = np.pad(piece, ((0, 0), (0, 1)), constant_values=-1), np.pad(place, ((0, 0), (0, 1)), constant_values=_LAST)
        left, live = sizes.copy(), np.arange(len(sizes))
        while len(live):
            best = place[live].argmin(1)
            live, best = (x[place[live, best] < _LAST] for x in (live, best))
            if not len(live):
                break
            symbols[live, best] = piece[live, best]
            after = np.minimum(np.arange(width) + (np.arange(width) > best[:, None]), width - 1)
            for held, none in ((symbols, -1), (piece, -1), (place, _LAST)):
                held[live] = np.take_along_axis(held[live], after, 1)
                held[live, -1] = none
            left[live] -= 1
            for at in (best - 1, best):
                some = (at >= 0) & (at < width - 1)
                r, c = live[some], at[some]
                piece[r, c], place[r, c] = self._pair(symbols[r, c], symbols[r, c + 1])
        return symbols[np.arange(width) < left[:, None]], left

    def merged(self, text: str) -> array:
        """Ids of one segment, whose blanks are BLANK, by the agenda."""
        out, piece, n = array("I"), self.piece, len(text)
        if n >= RUN_CHARS:
            out.extend(self.given([text])[0])
            return out
        size, after, before = [1] * n, [*range(1, n), -1], [-1, *range(n - 1)]
        agenda = [(p[1], i, 2) for i in range(n - 1) if (p := piece.get(text[i : i + 2]))]
        heapq.heapify(agenda)

        def join(left: int, right: int) -> None:
            length = size[left] + size[right]
            if p := piece.get(text[left : left + length]):
                heapq.heappush(agenda, (p[1], left, length))

        while agenda:
            _, left, length = heapq.heappop(agenda)
            right = after[left]
            if not size[left] or right < 0 or size[left] + size[right] != length:
                continue  # one of the two went into another merge
            size[left], size[right] = length, 0
            after[left] = beyond = after[right]
            if beyond >= 0:
                before[beyond] = left
                join(left, beyond)
            if before[left] >= 0:
                join(before[left], left)
        at = 0
        while at < n:
            if found := piece.get(text[at : at + size[at]]):
                out.append(found[0])
            else:
                out.extend([self.byte[b] for b in text[at].encode()])
            at += size[at]
        return out

    def given(self, texts: list[str]) -> list[list[int]]:
        """The library's ids of segments: each is encoded behind a line end, which no piece holds, so that the blank put first stays apart."""
        return [x[2:] for x in self.library.encode(["\n" + x for x in texts], num_threads=1)]

    def pretokens(self, texts: list[bytes]) -> list[list[int]]:
        """Ids of segments, each checked against the library's."""
        names = [x.replace(b" ", _MARK).decode() for x in texts]
        chars = np.fromiter(map(len, names), np.int64, len(names))
        found: list = [None] * len(names)
        short = np.flatnonzero(chars <= ROW_CHARS)
        for first in range(0, len(short), ROWS):
            rows = short[first : first + ROWS]
            rows = rows[np.argsort(chars[rows], kind="stable")]
            for at in range(0, len(rows), ROWS // 8):  # of about the same length
                part = rows[at : at + ROWS // 8]
                codes = np.frombuffer("".join([names[i] for i in part.tolist()]).encode("utf-32-le"), np.uint32)
                ids, n = self.side_by_side(codes, chars[part])
                ends = np.cumsum(n)
                spelt = np.zeros(len(part), bool)  # a character of it has no piece
                spelt[np.repeat(np.arange(len(part)), n)[(ids < 0) | (ids >= self.pieces_n)]] = True
                flat = ids.tolist()
                for i, a, b, x in zip(part.tolist(), (ends - n).tolist(), ends.tolist(), spelt.tolist(), strict=True):
                    found[i] = None if x else flat[a:b]
        found = [self.merged(x).tolist() if f is None else f for f, x in zip(found, names, strict=True)]
        for i, (own, given) in enumerate(zip(found, self.given(names), strict=True)):
            if own != given:
                found[i] = given
                self.mended.add(self.values + i)
        return found

    def run(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all rows one after another, how many each row has, and how many segments of each the library mended. Every row begins with a blank."""
        rows = len(offsets) - 1
        start = np.flatnonzero((raw & 0xC0) != 0x80)  # of each character
        codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
        new = np.ones(len(start), bool)
        new[1:] = ~self.pairs[_slot(codes)]
        new[np.searchsorted(start, offsets[:-1][offsets[:-1] < len(raw)])] = True
        start = start[new]
        size = np.diff(np.append(start, len(raw)))
        row = np.searchsorted(offsets, start, "right") - 1
        value = self._values(raw, start, size)
        n = self.n[value]
        total, ends = int(n.sum()), np.cumsum(n)
        ids = self.pool[np.repeat(self.at[value] - (ends - n), n) + np.arange(total)]
        wrong = np.isin(value, list(self.mended)) if self.mended else np.zeros(len(value), bool)
        return ids, np.bincount(row, n, rows).astype(np.int64), np.bincount(row, wrong, rows).astype(np.int64)


def loaded(path: str) -> Pieces:
    """The worker's model, kept from task to task."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def _parts(raw: bytes) -> Iterator[bytes]:
    """A long text in parts that begin, but for the first, with a blank that follows another character."""
    at = 0
    while len(raw) - at > SLICE_BYTES:
        cut, reach = -1, at + SLICE_BYTES
        while cut < 0 and reach < len(raw):
            cut = raw.rfind(b" ", max(at + 1, reach - SLICE_BYTES), reach)
            while cut > at and raw[cut - 1] in b" \x81":  # not within blanks, nor after a BLANK
                cut = raw.rfind(b" ", at + 1, cut)
            cut = cut if cut > at else -1
            reach += SLICE_BYTES
        if cut < 0:
            break
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def _encode(batches: Iterator[pa.RecordBatch], path: str, begin: bool, end: bool) -> Iterator[pa.RecordBatch]:
    model = loaded(path)
    sp = model.library
    first, last = np.array([sp.bos_id()] * begin, np.uint32).tobytes(), np.array([sp.eos_id()] * end, np.uint32).tobytes()
    for batch in batches:
        ids, mended = [], np.zeros(len(batch), np.int64)
        for at, raw, offsets in slices(batch.column(1)):
            text = raw.tobytes()
            rows = [text[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            if not model.plain:
                ids += [first + np.array(x, np.uint32).tobytes() + last for x in sp.encode([x.decode() for x in rows], num_threads=1)]
            elif len(raw) <= SLICE_BYTES:
                rows = [b" " + x.replace(_MARK, b" ") if x else b"" for x in rows]  # the blank that the library puts first
                places = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
                found, n, wrong = model.run(np.frombuffer(b"".join(rows), np.uint8), places)
                mended[at : at + len(rows)] += wrong
                ids += [first + x.tobytes() + last for x in np.split(found, np.cumsum(n)[:-1])]
            else:
                held = [first]
                for k, part in enumerate(_parts(rows[0])):
                    part = b" " * (k == 0) + part.replace(_MARK, b" ")
                    found, _, wrong = model.run(np.frombuffer(part, np.uint8), np.array([0, len(part)]))
                    held.append(found.tobytes())
                    mended[at] += wrong[0]
                ids.append(b"".join([*held, last]))
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(sizes), pa.array(mended)], ["doc_id", "ids", "n_tokens", "n_mended"])


def _text_of(model: Pieces, ids: np.ndarray) -> str:
    """The text of these ids by the table of pieces, checked against the library in parts that begin with a blank."""
    known = len(model.bytes_of)
    if not model.plain or not model.odd.isdisjoint(ids[(ids < known)].tolist()) or (len(ids) and int(ids.max()) >= known):
        return model.library.decode(ids.tolist())
    raw = b"".join([model.bytes_of[i] for i in ids.tolist()])
    try:
        own = raw.decode()
    except UnicodeDecodeError:  # bytes that are no characters
        own = None
    own = own[1:] if own is not None and own.startswith(" ") else own
    given = model.library.decode(ids.tolist())
    return own if own == given else given


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = loaded(path)
    at = batches_at = None
    for batch in batches:
        names = batch.schema.names
        at = names.index("ids") if at is None else at
        batches_at = [i for i in range(len(names)) if i != at]
        texts = [_text_of(model, np.frombuffer(x.as_buffer(), "<u4")) if x.is_valid else None for x in batch.column(at)]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in [*batches_at, at]), pa.array(texts, pa.string())], [*(names[i] for i in [*batches_at, at]), "decoded"])


def encode_pieces(docs: DataFrame, path: str, begin: bool = True, end: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit integers), n_tokens and n_mended of every whole text, as the library has them for the model at ``path``.

    ``begin``, ``end``: with the model's begin and end ids. Null and empty texts
    have only those; a null id stays; repeated rows are encoded each; other
    columns are left out, so their names can't clash; an empty table gives an
    empty result. A very long text is encoded in parts that begin with a blank.
    A model that isn't of the merge type is an error.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return small_batches(rows).mapInArrow(partial(_encode, path=path, begin=begin, end=end), f"doc_id {kind}, ids binary, n_tokens long, n_mended long")


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """The rows with ``decoded``, the text that the library's decode gives for their ``ids`` (as encode_pieces has them; null for null, the library's replacement for bytes that are no characters)."""
    fields = [f for f in encoded.schema.fields if f.name != "ids"] + [encoded.schema["ids"]]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", decoded string"
    return small_batches(encoded).mapInArrow(partial(_decode, path=path), schema)
