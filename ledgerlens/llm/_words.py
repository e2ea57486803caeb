"""Word hashing shared by the free-style operators (numpy inside tasks).

A word is a maximal run of bytes outside a separator set.  Texts are taken as
UTF-8 bytes, so every separator here is an ASCII byte and no multi-byte
character is ever cut.  Word and window hashes are 64 bits: a polynomial over
per-byte random values, finished with an avalanche step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
#: Odd multipliers, 5 modulo 8, so that powers have the longest period.
BYTE_MULTIPLIER = 0x9E3779B97F4A7C15 & ~7 | 5
WORD_MULTIPLIER = 0xC2B2AE3D27D4EB4F & ~7 | 5
#: Bytes hashed at once; temporary arrays take about 40 times this.
BLOCK_BYTES = 1 << 20

#: Words are separated by space and \t \n \v \f \r; letters are kept as they are.
PLAIN = bytes(range(256))
#: The same words with A-Z lower-cased (no other letter changes).
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _mix(h: np.ndarray) -> np.ndarray:
    """Avalanche: every input bit reaches every output bit."""
    h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


class WordHasher:
    """Hashes the words of a list of texts; one per task, tables built once."""

    def __init__(self, fold: bytes = PLAIN, seed: int = 1) -> None:
        values = _mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))
        self._values = values[np.frombuffer(fold, np.uint8)]
        self._is_word = np.ones(256, bool)
        self._is_word[[9, 10, 11, 12, 13, 32]] = False
        self._power = self._inverse = np.ones(1, U64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._power) < n:
            inverse = pow(BYTE_MULTIPLIER, -1, 1 << 64)
            step = np.full(n, BYTE_MULTIPLIER, U64)
            back = np.full(n, inverse, U64)
            step[0] = back[0] = 1
            self._power, self._inverse = np.cumprod(step), np.cumprod(back)
        return self._power[:n], self._inverse

    def _block(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, starts and ends of the words of bytes that end in a separator."""
        edge = np.diff(self._is_word[raw].view(np.int8), prepend=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        power, inverse = self._powers(len(raw))
        total = np.zeros(len(raw) + 1, U64)
        np.cumsum(self._values[raw] * power, out=total[1:])
        h = (total[ends] - total[starts]) * inverse[starts]
        return _mix(h + (ends - starts).astype(U64)), starts, ends

    def words(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, and per text the index of its first word (n + 1 entries)."""
        raw = np.frombuffer(b"\n".join(t or b"" for t in texts) + b"\n", np.uint8)
        begins = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t or b"") + 1 for t in texts], out=begins[1:])
        hashes, starts, at = [], [], 0
        while at < len(raw):
            end = min(at + BLOCK_BYTES, len(raw))
            if end < len(raw):  # cut after a separator; a longer word stays whole
                back = np.flatnonzero(~self._is_word[raw[at:end]])
                if len(back):
                    end = at + int(back[-1]) + 1
                while self._is_word[raw[end - 1]]:
                    ahead = np.flatnonzero(~self._is_word[raw[end:end + BLOCK_BYTES]])
                    end = end + int(ahead[0]) + 1 if len(ahead) else min(end + BLOCK_BYTES, len(raw))
            h, s, _ = self._block(raw[at:end])
            hashes.append(h)
            starts.append(s + at)
            at = end
        starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        return np.concatenate(hashes) if hashes else np.zeros(0, U64), np.searchsorted(starts, begins)


def windows(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of the k words from each position.

    Windows may cross into the next text; :func:`whole` tells which don't.
    """
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    h = np.full(n, seed * 1024 + k, U64)
    for j in range(k):
        h = h * U64(WORD_MULTIPLIER) + words[j:j + n]
    return _mix(h)


def whole(first: np.ndarray, k: int, n: int) -> np.ndarray:
    """Mask of the n window positions whose k words lie in one text."""
    edge = np.zeros(n + 1, np.int32)
    begin = np.minimum(first[:-1], n)
    end = np.clip(first[1:] - k + 1, begin, n)
    np.add.at(edge, begin, 1)
    np.subtract.at(edge, end, 1)
    return np.cumsum(edge[:n]) > 0


def parts(texts: list[bytes | None], limit: int = 4 * BLOCK_BYTES) -> Iterator[slice]:
    """Consecutive slices of the texts of about ``limit`` bytes (one text at least)."""
    at, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text or b"") > limit:
            yield slice(at, i)
            at, size = i, 0
        size += len(text or b"") + 1
    if at < len(texts):
        yield slice(at, len(texts))
