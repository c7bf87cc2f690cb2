"""Token ids of whole texts by a given tokenizer, each distinct piece of text encoded once.

Texts are cut at ASCII white space, where the tokenizers used here always end a
token, and equal pieces share one encoding, within a slice of documents and
across slices through a bounded store. Python touches new pieces only; known
ones are found and put in place as arrays.
"""

from itertools import chain

import numpy as np
import pyarrow as pa

from creditloom.llm.words import Words, span_hashes

STORE_BYTES = 24 << 20  # of each of two generations of the store
LONGEST_STORED = 64  # bytes
# The UTF-8 endings of white space characters beyond ASCII. A run of white space with one of them
# is one piece for a tokenizer, though the cut at ASCII white space would split it.
_SPACE_2 = [b"\xc2\x85", b"\xc2\xa0"]
_SPACE_3 = [b"\xe1\x9a\x80", *(b"\xe2\x80" + bytes([x]) for x in range(0x80, 0x8B)), b"\xe2\x80\xa8", b"\xe2\x80\xa9",
            b"\xe2\x80\xaf", b"\xe2\x81\x9f", b"\xe3\x80\x80"]

_encoders = {}


def _gathered(data, starts, sizes):
    """The spans of ``data``, one after another."""
    return data[_places(starts, sizes)]


def _places(starts, sizes):
    """The places of all elements of the spans, one span after another."""
    upto = np.cumsum(sizes)
    total = int(upto[-1]) if len(upto) else 0
    return np.arange(total) + np.repeat(starts - (upto - sizes), sizes)


def _ids_of(store, at):
    size = store.ids_size[at].astype(np.int64)
    return _gathered(store.ids, store.ids_at[at], size), size


def _starts(sizes):
    return np.cumsum(sizes) - sizes


class _Store:
    """Pieces with their ids as arrays: sorted hashes, the bytes of each piece, its ids."""

    def __init__(self, id_type):
        self.hashes, self.data, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, id_type)
        self.at = self.ids_at = np.zeros(0, np.int32)
        self.size = self.ids_size = np.zeros(0, np.uint8)

    def nbytes(self):
        return sum(x.nbytes for x in vars(self).values())

    def find(self, hashes, data, starts, sizes):
        """The place of each piece, -1 for those not here. A piece is here if its bytes are, not only its hash."""
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        same = np.flatnonzero((self.hashes[at] == hashes) & (self.size[at] == sizes))
        if len(same):
            size = sizes[same]
            equal = _gathered(data, starts[same], size) == _gathered(self.data, self.at[at[same]], size)
            same = same[np.add.reduceat(equal.view(np.uint8), _starts(size), dtype=np.int64) == size]
        out = np.full(len(hashes), -1)
        out[same] = at[same]
        return out

    def add(self, hashes, data, sizes, ids, ids_sizes):
        """Pieces that are not here yet; ``data`` and ``ids`` hold theirs one after another."""
        hashes, order = np.unique(np.concatenate([self.hashes, hashes]), return_index=True)
        for name, ends, more in (("at", self.data, sizes), ("ids_at", self.ids, ids_sizes)):
            places = (len(ends) + _starts(more)).astype(np.int32)
            setattr(self, name, np.concatenate([getattr(self, name), places])[order])
        self.size = np.concatenate([self.size, sizes.astype(np.uint8)])[order]
        self.ids_size = np.concatenate([self.ids_size, ids_sizes.astype(np.uint8)])[order]
        self.hashes, self.data = hashes, np.concatenate([self.data, data])
        self.ids = np.concatenate([self.ids, ids.astype(self.ids.dtype)])


class Encoder:
    """Encodes slices of documents; one per worker and tokenizer file."""

    def __init__(self, path, with_space):
        from tokenizers import Tokenizer

        self.tokenizer, self.with_space = Tokenizer.from_file(path), with_space
        self.id_type = "<u2" if max(self.tokenizer.get_vocab().values()) < 1 << 16 else "<u4"
        self.young, self.old = _Store(self.id_type), _Store(self.id_type)

    @classmethod
    def load(cls, path, with_space):
        """``with_space``: white space makes tokens, so a piece is a word with the white space before it."""
        if (path, with_space) not in _encoders:
            _encoders[path, with_space] = cls(path, with_space)
        return _encoders[path, with_space]

    def _encode(self, data, sizes):
        """All ids of pieces given one after another, and how many each has."""
        texts = pa.LargeStringArray.from_buffers(
            len(sizes), pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)])), pa.py_buffer(np.ascontiguousarray(data))
        )
        ids, counts = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for first in range(0, len(texts), 20_000):
            part = [e.ids for e in self.tokenizer.encode_batch_fast(
                texts.slice(first, 20_000).to_pylist(), add_special_tokens=False)]
            counts.append(np.fromiter(map(len, part), np.int64, len(part)))
            ids.append(np.fromiter(chain.from_iterable(part), "<u4", int(counts[-1].sum())))
        return np.concatenate(ids), np.concatenate(counts)

    def _pieces(self, hashes, data, starts, sizes):
        """All ids of some distinct pieces of ``data``, in their order, and how many each has."""
        count = np.zeros(len(hashes), np.int64)
        young = self.young.find(hashes, data, starts, sizes)
        rest = np.flatnonzero(young < 0)
        old = self.old.find(hashes[rest], data, starts[rest], sizes[rest])
        again, new = rest[old >= 0], rest[old < 0]
        known = np.flatnonzero(young >= 0)
        found = [(known, _ids_of(self.young, young[known])), (again, _ids_of(self.old, old[old >= 0]))]
        new_data = _gathered(data, starts[new], sizes[new])
        found.append((new, self._encode(new_data, sizes[new])))
        for which, (_, n) in found:
            count[which] = n
        ids, at = np.empty(int(count.sum()), "<u4"), _starts(count)
        for which, (part, n) in found:
            ids[_places(at[which], n)] = part
        kept = np.sort(np.concatenate([again, new]))
        kept = kept[(sizes[kept] <= LONGEST_STORED) & (count[kept] < 256)]
        if self.young.nbytes() > STORE_BYTES:
            self.young, self.old = _Store(self.id_type), self.young
        self.young.add(
            hashes[kept], _gathered(data, starts[kept], sizes[kept]), sizes[kept],
            _gathered(ids, at[kept], count[kept]), count[kept],
        )
        return ids, count

    def slice_ids(self, texts):
        """All ids of a slice of documents (numpy, 32 bits) and how many each document has."""
        words = Words(texts)
        data, starts, ends, doc = words.data, words.starts, words.ends, words.doc
        if self.with_space:
            first = words.first[:-1][words.per_doc > 0]
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else starts
            starts[first] = words.offsets[:-1][words.per_doc > 0]
            # What follows the last word of a document, or a whole document without words.
            tail = words.offsets[:-1].copy()
            tail[words.per_doc > 0] = ends[words.first[1:][words.per_doc > 0] - 1]
            rest = np.flatnonzero(tail < words.offsets[1:])
            starts, ends = np.concatenate([starts, tail[rest]]), np.concatenate([ends, words.offsets[1:][rest]])
            doc = np.concatenate([doc, rest])
            order = np.argsort(starts, kind="stable")
            starts, ends, doc = starts[order], ends[order], doc[order]
            whole = self._odd_documents(words)
            if len(whole):
                plain = ~np.isin(doc, whole)
                starts = np.concatenate([starts[plain], words.offsets[whole]])
                ends = np.concatenate([ends[plain], words.offsets[whole + 1]])
                doc = np.concatenate([doc[plain], whole])
                order = np.argsort(starts, kind="stable")
                starts, ends, doc = starts[order], ends[order], doc[order]
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(words.n_docs, np.int64)
        hashes = span_hashes(data, starts, ends)
        _, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        if ((ends - starts) != (ends - starts)[at][back]).any() or (data[starts] != data[starts[at]][back]).any():
            # Two different pieces with one hash: tell them apart by their bytes.
            known, at, back = {}, [], np.empty(len(starts), np.int64)
            for i in range(len(starts)):
                piece = data[starts[i]:ends[i]].tobytes()
                if piece not in known:
                    known[piece] = len(at)
                    at.append(i)
                back[i] = known[piece]
            at = np.array(at)
        store, size = self._pieces(hashes[at], data, starts[at], (ends - starts)[at])
        each = size[back]
        per_doc = np.bincount(doc, weights=each, minlength=words.n_docs).astype(np.int64)
        return _gathered(store, _starts(size)[back], each), per_doc

    @staticmethod
    def _odd_documents(words):
        """Documents with a word that ends in white space beyond ASCII."""
        data, ends = words.data, words.ends
        suspect = ends[data[ends - 1] >= 0x80] if len(ends) else ends
        odd = [e for e in suspect[np.isin(data[suspect - 2], [0xC2, 0x9A, 0x80, 0x81])].tolist()
               if data[e - 2:e].tobytes() in _SPACE_2 or data[max(0, e - 3):e].tobytes() in _SPACE_3]
        return np.unique(np.searchsorted(words.offsets[1:], np.array(odd, np.int64), "left"))


def with_end(ids, per_doc, end_id):
    """``end_id`` after the ids of each document."""
    after = np.cumsum(per_doc)
    return np.insert(ids, after, end_id), per_doc + 1
