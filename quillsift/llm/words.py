"""Words of many texts as arrays: byte positions and 64-bit hashes, without a loop over words.

A word is a run of ASCII digits, ASCII letters and non-ASCII characters; A-Z count as a-z. Texts are
handled as UTF-8 bytes. The hash of a word is a polynomial over its bytes modulo 2**64, read off a
running sum, then mixed. It depends on the word alone, so all executors agree on it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

CHUNK_BYTES = 1 << 20
SPACE = 32
BASE = 0x9E3779B97F4A7C15 | 1


def _fold() -> bytes:
    """Byte table: word bytes stay (A-Z as a-z), all others become a space."""
    table = bytearray([SPACE]) * 256
    for code in range(256):
        char = chr(code)
        if code >= 128 or "0" <= char <= "9" or "a" <= char <= "z":
            table[code] = code
        elif "A" <= char <= "Z":
            table[code] = code + 32
    return bytes(table)


FOLD = _fold()


class Words(NamedTuple):
    """``first[i]:first[i + 1]`` are the words of text i; starts and ends are byte positions in ``data``."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    offsets: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """n fixed odd multipliers."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(BASE) + np.uint64(seed)) | np.uint64(1)


def _powers(n: int, cache: dict) -> tuple[np.ndarray, np.ndarray]:
    if len(cache.get("up", ())) < n:
        size = max(n, CHUNK_BYTES * 2)
        inverse = pow(BASE, -1, 1 << 64)
        for name, base in (("up", BASE), ("down", inverse)):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            cache[name] = np.multiply.accumulate(row)
    return cache["up"], cache["down"]


def words_of(texts: list[bytes], cache: dict) -> Words:
    """``cache`` keeps the powers between calls of one task."""
    data = b" ".join(texts) + b" "
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    offsets = np.concatenate(([0], np.cumsum(lengths + 1)))
    data = data.translate(FOLD)
    codes = np.frombuffer(data, dtype=np.uint8)
    edges = np.flatnonzero(np.diff((codes != SPACE).view(np.int8), prepend=np.int8(0)))
    starts, ends = edges[0::2], edges[1::2]
    up, down = _powers(len(codes), cache)
    letters = mixed(np.arange(1, 257, dtype=np.uint64))
    running = np.cumsum(letters[codes] * up[: len(codes)], dtype=np.uint64)
    before = np.where(starts > 0, running[starts - 1], np.uint64(0))
    hashes = mixed((running[ends - 1] - before) * down[starts] + (ends - starts).astype(np.uint64))
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets), offsets)


def chunks(texts: list, cache: dict) -> Iterator[tuple[int, Words]]:
    """(index of the first text, words) for runs of about a megabyte; null counts as empty."""
    at = 0
    while at < len(texts):
        begin, size, part = at, 0, []
        while at < len(texts) and (not part or size < CHUNK_BYTES):
            part.append((texts[at] or "").encode("utf-8", "surrogatepass"))
            size += len(part[-1])
            at += 1
        yield begin, words_of(part, cache)


def windows(found: Words, width: int, seed: int) -> np.ndarray:
    """Hash of the ``width`` words from each word on; the last ``width - 1`` have none."""
    n = len(found.hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j, factor in enumerate(odd_numbers(width, seed)):
        total += found.hashes[j : j + n] * factor
    return mixed(total + np.uint64(width))


def shingles(found: Words, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): text i has the shingles ``first[i]:first[i + 1]``, repeats included.

    A text of fewer words than ``width``, but not none, has one shingle of all its words.
    """
    count = np.diff(found.first)
    have = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    first = np.concatenate(([0], np.cumsum(have)))
    out = np.zeros(first[-1], dtype=np.uint64)
    every = windows(found, width, seed)
    inside = np.arange(first[-1]) - np.repeat(first[:-1], have) + np.repeat(found.first[:-1], have)
    long = np.repeat(count >= width, have)
    out[long] = every[inside[long]]
    factors = odd_numbers(width, seed)
    for n in range(1, width):
        short = np.flatnonzero(count == n)
        total = np.zeros(len(short), dtype=np.uint64)
        for j in range(n):
            total += found.hashes[found.first[short] + j] * factors[j]
        out[first[short]] = mixed(total + np.uint64(n))
    return out, first
