"""Words of whole texts as numpy arrays, straight from Arrow's text buffer.

A word is a run of bytes other than ASCII white space (0x20, 0x09-0x0D). Words
never cross documents. Nothing here loops over words in Python.
"""

import hashlib

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20  # texts are handled in slices of about this size, at least one document each
_SPACE = np.zeros(256, np.bool_)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LONG = 4096  # bytes from which a word is hashed by hashlib
_C1, _C2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)  # fixed values: a public 64-bit mixer
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)  # fixed values: odd multipliers


def mixed(x):
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * _C1
    x = x ^ (x >> np.uint64(29))
    x = x * _C2
    return x ^ (x >> np.uint64(32))


def joined(a, b):
    """Hash of two consecutive pieces from the hashes of both; order matters."""
    return mixed(a * _K1 + mixed(b + _K2))


def text_slices(texts, size=SLICE_BYTES):
    """Cut an Arrow text array into (first row, slice) of about ``size`` bytes each."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(ends, ends[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, texts.slice(first, last - first)
        first = last


class Words:
    """The words of a slice of documents: byte spans and document index of each."""

    def __init__(self, texts):
        """``texts``: an Arrow string array without NULLs."""
        texts = texts.cast(pa.large_string())
        self.n_docs = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        self.data = whole[offsets[0]:offsets[-1]]
        self.offsets = offsets - offsets[0]
        inside = ~_SPACE[self.data]
        n = len(inside)
        begin, finish = inside.copy(), inside.copy()
        cuts = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        begin[1:] &= ~inside[:-1]
        finish[:-1] &= ~inside[1:]
        begin[cuts] = inside[cuts]
        finish[cuts - 1] = inside[cuts - 1]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        self.doc = np.searchsorted(self.offsets[1:], self.starts, "right")
        self.per_doc = np.bincount(self.doc, minlength=self.n_docs)
        self.first = np.concatenate([[0], np.cumsum(self.per_doc)])  # first word of each document

    def __len__(self):
        return len(self.starts)

    def bytes_of(self, i):
        return self.data[self.starts[i]:self.ends[i]].tobytes()

    def hashes(self, fold=None):
        """A 64-bit hash of each word; ``fold`` is a 256-entry byte map applied first."""
        return span_hashes(self.data if fold is None else fold[self.data], self.starts, self.ends)


def span_hashes(data, starts, ends):
    """A 64-bit hash of each byte span of ``data``."""
    size = (ends - starts).astype(np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    out = mixed(size.astype(np.uint64) + _K2)
    live = np.flatnonzero(size <= _LONG)
    at = 0
    while len(live):
        left = size[live] - at
        keep = np.where(left >= 8, np.uint64(0xFFFFFFFFFFFFFFFF),
                        (np.uint64(1) << (np.minimum(left, 7).astype(np.uint64) * np.uint64(8))) - np.uint64(1))
        out[live] = joined(out[live], eight[starts[live] + at] & keep)
        at += 8
        live = live[left > 8]
    for i in np.flatnonzero(size > _LONG):
        piece = data[starts[i]:ends[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little")
    return out


def window_hashes(word_hashes, per_doc, length):
    """Hashes of all windows of ``length`` words, by doubling, and the index of each one's first word.

    Windows lie within one document (``per_doc``: words of each).
    """
    room = np.repeat(np.cumsum(per_doc), per_doc) - np.arange(len(word_hashes))
    at = np.flatnonzero(room >= length)
    if not len(at):
        return np.zeros(0, np.uint64), at
    power, size, out, done = word_hashes, 1, None, 0
    while size <= length:
        if length & size:
            part = power[at + done]
            out = part if out is None else joined(out, part)
            done += size
        size *= 2
        if size <= length:
            half = size // 2
            power = np.concatenate([joined(power[:-half], power[half:]), np.zeros(half, np.uint64)])
    return out, at


def covered(at, length, n):
    """Which of ``n`` words lie in a window of ``length`` words that starts at one of ``at``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, np.minimum(np.asarray(at, np.int64) + length, n), -1)
    return np.cumsum(edge[:-1]) > 0
