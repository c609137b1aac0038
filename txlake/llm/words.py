"""Words and shingles of many texts at once, as 64-bit numbers.

The functions run inside tasks on Arrow arrays. They are made by a factory, so that they
travel to the executors whole and need no module there but numpy and pyarrow.
"""

from __future__ import annotations

from types import SimpleNamespace

SHINGLE = 5
SLICE_BYTES = 1 << 20


def kernel(size: int = SHINGLE, slice_bytes: int = SLICE_BYTES) -> SimpleNamespace:
    """Functions over arrays of texts, all in slices of about ``slice_bytes``.

    Words are runs between ASCII blanks with A-Z lower-cased; null counts as empty. Equal
    words have equal numbers; different ones share a number with a chance of 2^-64 a pair.
    """
    import numpy as np
    import pyarrow as pa

    u = np.uint64
    odd = 0x9E3779B97F4A7C15
    back = pow(odd, -1, 1 << 64)
    powers = {}

    def mix(x):
        x = (x ^ (x >> u(30))) * u(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> u(27))) * u(0x94D049BB133111EB)
        return x ^ (x >> u(31))

    codes = mix(np.arange(1, 257, dtype=u) * u(odd))
    codes[65:91] = codes[97:123]
    blank = np.zeros(256, bool)
    blank[[32, 9, 10, 11, 12, 13]] = True

    def power(base, n):
        have = powers.get(base)
        if have is None or len(have) < n:
            steps = np.full(max(n, 2 * slice_bytes), u(base))
            steps[0] = u(1)
            powers[base] = have = np.cumprod(steps)
        return have[:n]

    def slices(texts):
        """(offsets, bytes) of some rows at a time; offsets start at 0."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        n = len(texts)
        if not n:
            return
        buffers = texts.buffers()
        offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + n + 1]
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + slice_bytes, "right")) - 1)
            to = min(to, n)
            yield offsets[at : to + 1] - offsets[at], data[offsets[at] : offsets[to]]
            at = to

    def words(offsets, data):
        """(number of each word, words of each text) for one slice."""
        n = len(data)
        if not n:
            return np.zeros(0, u), np.zeros(len(offsets) - 1, np.int64)
        space = blank[data]
        firsts = offsets[:-1]
        before = np.empty(n, bool)
        before[0] = True
        before[1:] = space[:-1]
        before[firsts[firsts < n]] = True
        after = np.empty(n, bool)
        after[-1] = True
        after[:-1] = space[1:]
        after[firsts[firsts > 0] - 1] = True
        starts = np.flatnonzero(~space & before)
        ends = np.flatnonzero(~space & after) + 1
        sums = np.empty(n + 1, u)
        sums[0] = 0
        np.cumsum(codes[data] * power(odd, n), out=sums[1:])
        numbers = mix((sums[ends] - sums[starts]) * power(back, n)[starts] + (ends - starts).astype(u))
        return numbers, np.diff(np.searchsorted(starts, offsets))

    def shingles(numbers, counts):
        """(number of each shingle, shingles of each text); shorter texts are one shingle whole."""
        made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        out = np.empty(int(made.sum()), u)
        first = np.cumsum(counts) - counts
        if len(numbers) >= size:
            n = len(numbers) - size + 1
            s = numbers[:n].copy()
            for j in range(1, size):
                s = (s ^ (s >> u(32))) * u(0xD6E8FEB86659FD93) + numbers[j : n + j]
            s = mix(s + u(size))
            inside = np.arange(len(numbers)) - np.repeat(first, counts)
            whole = inside <= np.repeat(counts, counts) - size
            out[np.repeat(counts >= size, made)] = s[whole[:n]]
        place = np.cumsum(made) - made
        for d in np.flatnonzero((counts > 0) & (counts < size)):
            s = numbers[first[d] : first[d] + 1].copy()
            for j in range(1, counts[d]):
                s = (s ^ (s >> u(32))) * u(0xD6E8FEB86659FD93) + numbers[first[d] + j]
            out[place[d]] = mix(s + u(counts[d]))[0]
        return out, made

    def sets(texts):
        """The sorted distinct shingles of each text, one after another."""
        for offsets, data in slices(texts):
            numbers, made = shingles(*words(offsets, data))
            at = 0
            for m in made:
                yield np.unique(numbers[at : at + m])
                at += m

    return SimpleNamespace(mix=mix, slices=slices, words=words, shingles=shingles, sets=sets)
