"""Word shingles of whole texts: hashes for searching, tuples for exact checks.

Words are the maximal runs of letters and digits of the lower-cased text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pagelake.llm.textbits import MIX_A, bytes_of, mix

WORD = re.compile(r"[^\W_]+")

#: ASCII bytes that are no letters or digits; every byte beyond ASCII is looked at as a character.
ASCII_WORD = np.zeros(256, bool)
ASCII_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1)]] = True
ASCII_WORD[0x80:] = True


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingle_set(of: list[str], size: int) -> set[tuple[str, ...]]:
    return {tuple(of[i : i + size]) for i in range(len(of) - size + 1)}


@dataclass
class HashedWords:
    """64-bit hashes of the words of a batch, in order, and where each row's words begin."""

    hashes: np.ndarray
    firsts: np.ndarray  # one more than rows


def lowered(texts: pa.Array) -> pa.Array:
    """Lower case as Python has it, for the few characters where the two differ."""
    texts = pc.fill_null(texts, "")
    low = pc.utf8_lower(texts)
    # U+0130 is the one letter whose lower case has another length; final sigma depends on its word.
    odd = pc.match_substring_regex(texts, "[İΣ]")
    if pc.any(odd).as_py():
        fixed = [t.lower() if o else u for t, u, o in zip(texts.to_pylist(), low.to_pylist(), odd.to_pylist(), strict=True)]
        low = pa.array(fixed, pa.string())
    return low


def _non_word_masked(texts: pa.Array) -> pa.Array:
    """Non-ASCII characters that are no letters or digits become spaces."""
    if pc.any(pc.match_substring_regex(texts, r"[^\x00-\x7f\p{L}\p{N}]")).as_py():
        return pc.replace_substring_regex(texts, r"[^\x00-\x7f\p{L}\p{N}]", " ")
    return texts


def hashed_words(texts: pa.Array) -> HashedWords:
    data, offsets = bytes_of(_non_word_masked(lowered(texts)))
    rows, n = len(offsets) - 1, len(data)
    row_of_byte = np.repeat(np.arange(rows, dtype=np.int32), np.diff(offsets))
    spaced = np.full(n + rows + 1, 32, np.uint8)
    spaced[np.arange(n, dtype=np.int64) + row_of_byte + 1] = data
    inside = ASCII_WORD[spaced]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    # A polynomial of the bytes by one running sum, brought to the same power for every word.
    powers = _powers(len(spaced))
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum((spaced.astype(np.uint64) + np.uint64(1)) * powers[: len(spaced)][::-1], dtype=np.uint64)])
    raw = (run[ends] - run[starts]) * _inverse_powers(len(spaced))[len(spaced) - ends]
    hashes = mix(raw + (ends - starts).astype(np.uint64) * MIX_A)
    row_starts = offsets[:-1] + np.arange(rows) + 1
    of_row = np.searchsorted(row_starts, starts, "right") - 1
    return HashedWords(hashes, np.searchsorted(of_row, np.arange(rows + 1)))


BASE = 0x9E3779B97F4A7C15
_TABLES: dict[int, np.ndarray] = {}


def _geometric(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2 ** 64."""
    have = _TABLES.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, np.uint64)
        while len(have) < n:
            have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
        _TABLES[base] = have
    return have


def _powers(n: int) -> np.ndarray:
    return _geometric(BASE, n)


def _inverse_powers(n: int) -> np.ndarray:
    return _geometric(pow(BASE, -1, 1 << 64), n + 1)


def shingle_hashes(found: HashedWords, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words and the row of each, in order."""
    h = found.hashes
    if len(h) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = h[: len(h) - size + 1].copy()
    for k in range(1, size):
        out *= MIX_A
        out ^= out >> np.uint64(31)
        out += h[k : len(h) - size + 1 + k]
    out = mix(out)
    rows = np.repeat(np.arange(len(found.firsts) - 1), np.diff(found.firsts))
    whole = rows[: len(out)] == rows[size - 1 :]
    return out[whole], rows[: len(out)][whole]
