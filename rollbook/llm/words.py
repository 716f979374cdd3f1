"""Words and lines of many texts at a time, with numpy inside a task.

A word is a run of bytes other than space and 0x09 to 0x0D, a line is what stands between
line feeds. Texts come as Arrow binary arrays (UTF-8) and are handled in chunks of about one
megabyte, whole texts always; a longer text is a chunk of its own.
"""

import numpy as np

CHUNK_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_powers = np.ones(1, np.uint64)


def mixed(x):
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


def _power(n):
    global _powers
    if len(_powers) < n:
        factors = np.full(max(n, 2 * len(_powers)), _STEP, np.uint64)
        factors[0] = 1
        _powers = np.cumprod(factors, dtype=np.uint64)
    return _powers


def span_hashes(data, starts, ends):
    """64-bit hash of each span of bytes; spans are in order and don't overlap or are empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    total = int(size.sum())
    first = np.cumsum(size) - size
    place = np.arange(total) - np.repeat(first, size)
    at = place + np.repeat(starts, size)
    terms = _BYTE[data[at]] * _power(int(size.max()) + 1)[place]
    return mixed(np.add.reduceat(terms, first) + size.astype(np.uint64) * _STEP)


class Chunk:
    """Some whole texts: ``data`` (bytes, a space behind each text), ``starts`` and ``ends`` of the
    words, ``doc`` (number of the word's text in the chunk), ``first`` (number of each text's
    first word, and of the words at last)."""

    def __init__(self, texts, lower=False):
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        self.data = LOWER[data] if lower else data
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.n = len(texts)
        self.at = np.concatenate(([0], np.cumsum(sizes + 1)))
        self.space = SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], self.space)).astype(np.int8)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.starts, self.at)
        self.doc = np.repeat(np.arange(self.n), np.diff(self.first))

    def per_text(self, mask):
        """Marked bytes of each text."""
        return np.diff(np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))[self.at])

    def words_per_text(self, mask):
        """Marked words of each text."""
        return np.diff(np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))[self.first])

    def hashes(self):
        return span_hashes(self.data, self.starts, self.ends)

    def windows(self, hashes, k):
        """(number of the first word, hash) of the windows of k words that lie within a text."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        whole = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        total = hashes[:n].copy()
        for i in range(1, k):
            total = total * _STEP + hashes[i : n + i]
        return whole, mixed(total[whole])


def chunks(column, lower=False):
    """(first row, Chunk) over an Arrow binary column; NULL is the empty text."""
    texts, size, at = [], 0, 0
    for i in range(len(column)):
        text = column[i].as_py() or b""
        if texts and size + len(text) > CHUNK_BYTES:
            yield at, Chunk(texts, lower)
            texts, size, at = [], 0, i
        texts.append(text)
        size += len(text) + 1
    if texts:
        yield at, Chunk(texts, lower)
