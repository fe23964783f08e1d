"""Hashed features of texts, computed for many texts at once in numpy.

Texts longer than a window are read in windows that end at white space, at places that depend on the text
alone, so features never depend on which texts share a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WINDOW_CHARS = 1 << 18
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

_SPACE, _WORD, _MARK, _SIGN = 0, 1, 2, 3
_BYTE_CLASS = np.full(256, _MARK, np.uint8)
_BYTE_CLASS[128:] = _WORD
for _c in b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _BYTE_CLASS[_c] = _WORD
for _c in range(33):
    _BYTE_CLASS[_c] = _SPACE


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps)
        if n <= 1 << 22:
            _powers[base] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def _windows(text: str) -> Iterator[str]:
    lo = 0
    while len(text) - lo > WINDOW_CHARS:
        cut = max(text.rfind(" ", lo, lo + WINDOW_CHARS), text.rfind("\n", lo, lo + WINDOW_CHARS))
        if cut <= lo:
            cut = min((x for x in (text.find(" ", lo + WINDOW_CHARS), text.find("\n", lo + WINDOW_CHARS)) if x >= 0), default=len(text))
        yield text[lo:cut]
        lo = cut
    yield text[lo:]


def windows(texts: list[str | None]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(number of the text, window) for all texts, gathered to about WINDOW_CHARS characters."""
    numbers: list[int] = []
    parts: list[str] = []
    size = 0
    for i, text in enumerate(texts):
        for part in _windows(text or ""):
            numbers.append(i)
            parts.append(part)
            size += len(part)
            if size >= WINDOW_CHARS:
                yield np.array(numbers), parts
                numbers, parts, size = [], [], 0
    if parts:
        yield np.array(numbers), parts


def _signs(a: np.ndarray) -> np.ndarray:
    """Where characters of scripts without spaces between words begin in UTF-8 bytes: kana and ideographs (lead bytes E3
    to E9), Thai and Lao (E0 B8 to BB), Burmese (E1 80 to 82) and Khmer (E1 9E and 9F); all have three bytes."""
    second = np.append(a[1:], np.uint8(0))
    thai, burmese = (a == 0xE0) & (second >= 0xB8) & (second <= 0xBB), (a == 0xE1) & (((second >= 0x80) & (second <= 0x82)) | (second == 0x9E) | (second == 0x9F))
    found = np.flatnonzero(((a >= 0xE3) & (a <= 0xE9)) | thai | burmese)
    return found[found + 3 <= len(a)]


def tokens(texts: list[str | None], marks: bool, signs: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, 64-bit hash) of the lower-cased tokens in order: runs of letters and digits and, with
    marks, runs of other visible characters. With signs, neighbours in a run of characters of scripts without spaces
    are a token each (after all others of a window), and a character alone is one."""
    for numbers, parts in windows(texts):
        raw = [p.lower().encode("utf-8", "surrogatepass") for p in parts]
        a = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        kind = _BYTE_CLASS[a]
        at = _signs(a) if signs else np.zeros(0, np.int64)
        if len(at):
            kind[(at[:, None] + np.arange(3)).ravel()] = _SIGN
        edges = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        starts = np.concatenate(([0], edges))
        ends = np.concatenate((edges, [len(a)]))
        kept = (kind[starts] == _WORD) | (kind[starts] == _MARK) if marks else kind[starts] == _WORD
        starts, ends = starts[kept], ends[kept]
        if len(at):
            next_to = np.append(at[1:] == at[:-1] + 3, False)
            alone = ~next_to & ~np.concatenate(([False], next_to[:-1]))
            starts, ends = np.concatenate((starts, at[next_to], at[alone])), np.concatenate((ends, at[next_to] + 6, at[alone] + 3))
        sums = np.zeros(len(a) + 1, np.uint64)
        np.cumsum((a.astype(np.uint64) + _U(1)) * _power(_BASE, len(a)), out=sums[1:])
        back = _power(_BASE_INVERSE, len(a))
        docs = numbers[np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), starts, side="right")]
        yield docs, mixed((sums[ends] - sums[starts]) * back[starts])


def word_pairs(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Single tokens and pairs of neighbours, pairs over window ends included."""
    last_doc, last_hash = np.array([-1]), np.array([0], np.uint64)
    for docs, hashes in found:
        before, after = np.concatenate((last_doc, docs)), np.concatenate((last_hash, hashes))
        same = before[1:] == before[:-1]
        pairs = mixed(after[:-1] * _U(31) + after[1:])[same]
        if len(docs):
            last_doc, last_hash = docs[-1:], hashes[-1:]
        yield np.concatenate((docs, before[1:][same])), np.concatenate((hashes, pairs))


_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def char_ngrams(texts: list[str | None], orders: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, bucket) of the n-grams of lower-cased letters; a run of other characters is one space."""
    letter = letter_table()
    for numbers, parts in windows(texts):
        low = [p.lower() for p in parts]
        codes = np.frombuffer(("\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = letter[codes]
        kept = is_letter.copy()
        kept[1:] |= is_letter[:-1]
        at = np.flatnonzero(kept)
        codes = np.where(is_letter[at], codes[at], 32).astype(np.uint64)
        part = np.searchsorted(np.cumsum([len(p) + 1 for p in low]), at, side="right")
        h = np.zeros(len(codes), np.uint64)
        for n in range(1, max(orders) + 1):
            size = len(codes) - n + 1
            if size <= 0:
                break
            h = (h[:size] + codes[n - 1 :]) * _U(_BASE)
            h ^= h >> _U(29)
            if n in orders:
                whole = part[:size] == part[n - 1 :]
                bucket = ((h + _U(n)) * _U(0xD6E8FEB86659FD93)) >> _U(64 - bits)
                yield numbers[part[:size][whole]], bucket[whole].astype(np.int64)
