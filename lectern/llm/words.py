"""Hashes of a text's words and shingles, for whole batches of texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
#: Bytes hashed at once.
CHUNK = 1 << 20
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(n, CHUNK).bit_length()
    if size not in _powers:
        out = []
        for base in (_BASE, _BASE_INVERSE):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        if size > 2 * CHUNK:
            return out[0], out[1]  # a giant word: not kept
        _powers[size] = (out[0], out[1])
    return _powers[size]


def _hash_chunk(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of lower-cased UTF-8: sum of (byte + 1) * base ** place in the word, mixed."""
    raw = np.frombuffer(data, dtype=np.uint8)
    edge = np.diff(np.concatenate([[True], _SPACE[raw], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, inverse = _powers_of(len(raw))
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=sums[1:])
    return starts, mixed((sums[ends] - sums[starts]) * inverse[starts])


def word_hashes(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """In batches, in order: the words' hashes of some texts together, and the number of words of each text."""
    batch, held = [], 0

    def flush() -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum([len(b) + 1 for b in batch])
        starts, hashes = _hash_chunk(b"\n".join(batch))
        return hashes, np.diff(np.concatenate([[0], np.searchsorted(starts, ends)]))

    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass").lower()  # of bytes: A-Z only
        if batch and held + len(data) > CHUNK:
            yield flush()
            batch, held = [], 0
        if len(data) > CHUNK:
            parts = [_hash_chunk(part)[1] for part in _cut(data)]
            yield np.concatenate(parts), np.array([sum(map(len, parts))])
            continue
        batch.append(data)
        held += len(data) + 1
    if batch:
        yield flush()


def _cut(data: bytes) -> Iterator[bytes]:
    """Pieces of about CHUNK bytes that end at white space."""
    at = 0
    while at < len(data):
        end = at + CHUNK
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def shingle_hashes(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of each text with repeats, and their number: runs of width words, or all words as one where there are fewer."""
    last = np.cumsum(counts)
    first = last - counts
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), runs)
    at = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs) + first[text]
    length = np.minimum(counts[text], width)
    out = length.astype(np.uint64)
    for k in range(width):
        on = length > k
        word = words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else words
        out = np.where(on, mixed(out * np.uint64(0x9FB21C651E98DF25) + word), out)
    return out, runs


def sequence_keys(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each text's sequence of words, in two parts."""
    first = np.cumsum(counts) - counts
    place = (np.arange(len(words)) - np.repeat(first, counts)).astype(np.uint64)
    parts = []
    for constant in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F):
        sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(mixed(words * np.uint64(constant) + place * np.uint64(0xE7037ED1A0B428DB)), out=sums[1:])
        parts.append((sums[first + counts] - sums[first]) ^ counts.astype(np.uint64))
    return parts[0], parts[1]
