"""Word and shingle hashes of Arrow string columns, computed with numpy over the raw UTF-8 bytes.

A word is a maximal run of bytes that a table does not call separators; bytes A-Z count as a-z. Its hash is a
polynomial over 64-bit values of its bytes, so all words of a batch come out of one cumulative sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
#: Bytes of text whose words are hashed at once; a longer word makes the power tables longer.
SLICE = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_FOLD = np.arange(256)
_FOLD[65:91] += 32
_VALUE = mix((np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)))[_FOLD]
#: White space: the words of the contracts.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Everything in ASCII that is neither letter nor digit: words without punctuation.
PUNCT = np.zeros(256, dtype=bool)
PUNCT[:128] = [not chr(i).isalnum() for i in range(128)]
TAIL = np.zeros(256, dtype=bool)
TAIL[[i for i in range(33, 127) if not chr(i).isalnum() and i not in b"'<|"]] = True
LETTER = np.array([i < 128 and chr(i).isalpha() for i in range(256)])
#: Second bytes of the letters from U+00C0 to U+00FF.
_LATIN = np.array([128 <= i < 192 and i not in (0x97, 0xB7) for i in range(256)])

_powers: tuple[np.ndarray, np.ndarray] | None = None


def letters(data: np.ndarray) -> np.ndarray:
    """How many bytes before each place, and in all, belong to ASCII letters or to lower-case letters from U+00DF to U+00FF."""
    second = np.zeros(len(data), bool)
    second[1:] = (data[:-1] == 0xC3) & _LATIN[data[1:]] & (data[1:] >= 0x9F)
    fit = LETTER[data] | second
    fit[:-1] |= second[1:]
    return np.concatenate(([0], np.cumsum(fit)))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None or len(_powers[0]) < n:
        n = max(n, SLICE + 1)
        one = np.full(n, _BASE, dtype=np.uint64)
        one[0] = 1
        back = np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        back[0] = 1
        _powers = np.multiply.accumulate(one), np.multiply.accumulate(back)
    return _powers


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    off = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), off


def _hash_slice(data: np.ndarray, starts_at: np.ndarray, gaps: np.ndarray, prefixes: tuple[int, ...] = (), tails: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of data; starts_at: offsets in data where another text begins.

    With prefixes, a row of hashes for the words and one for the first p bytes of each; 0 where a word is shorter. With
    tails, the punctuation (TAIL) that ends a word behind a letter up to U+00FF is a word of its own.
    """
    gap = gaps[data]
    before = np.empty(len(data) + 1, dtype=bool)
    before[0] = True
    before[1:] = gap
    before[starts_at] = True
    after = np.empty(len(data) + 1, dtype=bool)
    after[:-1] = gap
    after[-1] = True
    after[starts_at] = True
    word = ~gap
    if tails:
        # where the last letter of a word stands: nothing but TAIL lies between it and the word's end
        ends = np.flatnonzero(word & after[1:])
        body = np.where(TAIL[data], 0, np.arange(1, len(data) + 1))
        last = np.maximum.accumulate(body)[ends] if len(data) else ends
        at = last[(last > 0) & (last <= ends)]
        at = at[LETTER[data[at - 1]] | (_LATIN[data[at - 1]] & (data[np.maximum(at - 2, 0)] == 0xC3))]
        before[at] = after[at] = True
    starts = np.flatnonzero(word & before[:-1])
    ends = np.flatnonzero(word & after[1:]) + 1
    power, back = _tables(len(data) + 1)
    total = np.empty(len(data) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(_VALUE[data] * power[: len(data)], out=total[1:])
    h = mix((total[ends] - total[starts]) * back[starts])
    if not prefixes:
        return h, starts, ends
    rows = [h]
    for p in prefixes:
        to = np.minimum(starts + p, ends)
        rows.append(np.where(ends - starts >= p, mix((total[to] - total[starts]) * back[starts] + np.uint64(p * 0x51ED2701)), np.uint64(0)))
    return np.stack(rows), starts, ends


def word_hashes(texts: pa.Array, gaps: np.ndarray = SPACE, prefixes: tuple[int, ...] = ()) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first, end, hashes, counts): texts[first:end] have these word hashes, counts[i] of them in text first+i."""
    for first, end, h, counts, _, _ in word_spans(texts, gaps, prefixes):
        yield first, end, h, counts


def word_spans(texts: pa.Array, gaps: np.ndarray = SPACE, prefixes: tuple[int, ...] = (), tails: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Yield (first, end, hashes, counts, starts, ends): as word_hashes, with the words' places in the bytes of buffers(texts).

    With prefixes, hashes has a row for the words and one for their first bytes of each length. One text longer than SLICE is cut at separators, so memory follows the number of its words.
    """
    data, off = buffers(texts)
    n, i = len(off) - 1, 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + SLICE, side="right")) - 1
        if j > i:
            part = data[off[i] : off[j]]
            inner = off[i:j] - off[i]
            h, starts, ends = _hash_slice(part, inner[inner < len(part)], gaps, prefixes, tails)
            where = np.searchsorted(off[i : j + 1] - off[i], starts, side="right") - 1
            yield i, j, h, np.bincount(where, minlength=j - i), starts + off[i], ends + off[i]
            i = j
            continue
        at, end, found = int(off[i]), int(off[i + 1]), []
        while at < end:
            to = min(at + SLICE, end)
            while to < end and not gaps[data[to]]:  # never cut a word
                room = np.flatnonzero(gaps[data[at:to]])
                if len(room):
                    to = at + int(room[-1])
                    break
                more = np.flatnonzero(gaps[data[to : to + SLICE]])
                to = min(to + (int(more[0]) if len(more) else SLICE), end)
            to = max(to, at + 1)
            h, starts, ends = _hash_slice(data[at:to], np.zeros(0, np.int64), gaps, prefixes, tails)
            found.append((h, starts + at, ends + at))
            at = to
        h = np.concatenate([f[0] for f in found], -1) if found else np.zeros((1 + len(prefixes), 0) if prefixes else 0, np.uint64)
        starts, ends = (np.concatenate([f[x] for f in found]) if found else np.zeros(0, np.int64) for x in (1, 2))
        yield i, i + 1, h, np.array([h.shape[-1]]), starts, ends
        i += 1


_PLACES = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive words of one sequence; len(h) - k + 1 of them, or none."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - k + 1, np.uint64)
    for p in range(k):
        out += h[p : len(h) - k + 1 + p] * _PLACES[p]
    return mix(out)


def shingle_set(h: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; a shorter sequence counts as one shingle, none as no set."""
    if len(h) >= k:
        return np.unique(windows(h, k))
    if not len(h):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        return mix(np.array([(h * _PLACES[: len(h)]).sum() + np.uint64(len(h))], dtype=np.uint64))
