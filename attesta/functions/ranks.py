"""Counting the tokens of a byte-pair encoding given by ranks, as a text grows.

Tokens add up over pre-tokens, which a pattern cuts; only the last pre-token of a
text can change when more follows. So a running count keeps the sum of all before
it and recounts the border. Within a pre-token the counts of all its prefixes come
from one pass: the tokens of a prefix end in the one token that stands next to the
last token of what is before it without merging, so each prefix has one token more
than the prefix that its last token leaves.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Mapping

#: How a rank file's encoding cuts texts before it merges bytes (a fixed value of the encodings that such files are of).
RANK_PATTERN = r"'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}++|\p{N}{1,3}+| ?[^\s\p{L}\p{N}]++[\r\n]*+|\s++$|\s*[\r\n]|\s+(?!\S)|\s"
#: Entries of a worker's caches of pre-tokens and of pairs; bytes of a pre-token from which on it is counted in one pass and not remembered.
CACHED, SHORT = 1 << 16, 48


def read_ranks(path: str) -> dict[bytes, int]:
    """Token to rank from a file of base64 tokens and ranks, line by line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Ranks:
    """Counts by a rank table that has a token for each byte.

    ``pattern``: its matches cover every text, and what follows a text may change
    the last match in it, but none before.
    """

    def __init__(self, ranks: Mapping[bytes, int], pattern: str = RANK_PATTERN):
        import regex

        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a rank table needs a token for each byte")
        self.ranks, self.cut = ranks, regex.compile(pattern).finditer
        lengths: dict[int, set[int]] = {}
        for token in ranks:
            lengths.setdefault(token[-1], set()).add(len(token))
        self.lengths = {last: sorted(n) for last, n in lengths.items()}
        self.known: dict[bytes, int] = {}
        self.apart: dict[tuple[bytes, bytes], bool] = {}

    def merged(self, piece: bytes) -> list[bytes]:
        """Tokens of a short pre-token: the pair of the lowest rank is merged, the leftmost of equals, until none has one."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts[:-1], parts[1:], strict=True)))
            if rank == 1 << 40:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stand(self, left: bytes, right: bytes) -> bool:
        """Whether two tokens stand next to each other without merging."""
        found = self.apart.get((left, right))
        if found is None:
            if len(self.apart) >= CACHED:
                self.apart.clear()
            found = self.apart[left, right] = self.merged(left + right) == [left, right]
        return found

    def prefixes(self, piece: bytes) -> Iterator[int]:
        """Number of tokens of each prefix of a pre-token, from one byte on."""
        last, counts = [b""], [0]
        for end in range(1, len(piece) + 1):
            for n in self.lengths[piece[end - 1]]:
                if n > end:
                    break
                token, before = piece[end - n : end], last[end - n]
                if token in self.ranks and (self._stand(before, token) if before else self.merged(token) == [token]):
                    last.append(token)
                    counts.append(counts[end - n] + 1)
                    break
            yield counts[end]

    def of(self, piece: bytes) -> int:
        """Number of tokens of one pre-token."""
        if piece in self.ranks:
            return 1
        if len(piece) > SHORT:
            n = 0
            for n in self.prefixes(piece):  # noqa: B007
                pass
            return n
        found = self.known.get(piece)
        if found is None:
            if len(self.known) >= CACHED:
                self.known.clear()
            found = self.known[piece] = len(self.merged(piece))
        return found

    def count(self, value: str) -> int:
        return sum(self.of(m.group().encode()) for m in self.cut(value))

    def grown(self, stable: int, border: str, more: str) -> tuple[int, int, str]:
        """Tokens in all, those before the border, and the border, of a text of ``stable`` tokens and then ``border`` when ``more`` follows."""
        total, before, last = stable, stable, ""
        for m in self.cut(border + more):
            before, last = total, m.group()
            total += self.of(last.encode())
        return total, before, last

    def pieces(self, word: str, limit: int) -> Iterator[tuple[str, int]]:
        """A word without white space cut anywhere into pieces of at most ``limit`` tokens (or one character), each as long as no prefix exceeds it."""
        begin = 0
        while begin < len(word):
            end, total = begin, 0
            for m in self.cut(word, begin):
                taken, counts = total, self.prefixes(m.group().encode())
                for c in m.group():
                    for _ in range(len(c.encode())):
                        n = next(counts)
                    if total + n > limit and end > begin:
                        break
                    end, taken = end + 1, total + n
                else:
                    total = taken
                    continue
                total = taken
                break
            yield word[begin:end], total
            begin = end
