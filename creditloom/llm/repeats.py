"""Substring dedup by level-wise doubling of repeated word windows.

Windows repeated at one length alone are looked at again at twice that length,
down to the wanted one. Every level is an exchange by hash range: each chunk of
documents sends its distinct window hashes, packed and sorted, to the task of
their range, and gets back which of them other chunks have too. A window's
hash is sent once per chunk however often it occurs, so a passage that a third
of all documents share is no hot key.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm.scratch import Scratch, fresh_name
from creditloom.llm.words import Words, covered, mixed, text_slices, window_hashes
from creditloom.llm.workers import map_batches, map_groups, map_pairs

CHUNK_BYTES = 3 << 20  # text of one chunk, one document at least
BATCH_BYTES = 8 << 20  # of the batches in which documents reach a task before they lie in chunks
RANGE_HASHES = 500_000  # hashes that one task compares at once, about
SHORTEST_LEVEL = 8  # words; a shorter first level repeats by chance too often
LEVEL_BITS = 48  # of a hash at the levels before the last, where an equal hash alone proves nothing
_SECOND = np.uint64(0x5851F42D4C957F2D)  # fixed value: sets the second hash apart from the first
_LAST = np.iinfo(np.int64).max


def levels_of(length):
    """Window lengths from the first level to ``length``, each at most twice the one before."""
    levels = [length]
    while levels[0] > 2 * SHORTEST_LEVEL:
        levels.insert(0, (levels[0] + 1) // 2)
    return levels


def pack(values):
    """Sorted unsigned numbers as bytes: the first, then differences in 4 bytes where these suffice."""
    values = np.asarray(values, np.uint64)
    steps = np.diff(values)
    wide = len(steps) > 0 and int(steps.max()) >= 1 << 32
    return bytes([wide]) + values[:1].astype("<u8").tobytes() + steps.astype("<u8" if wide else "<u4").tobytes()


def unpack(data):
    first = np.frombuffer(data, "<u8", 1, 1)
    return np.cumsum(np.concatenate([first, np.frombuffer(data, "<u8" if data[0] else "<u4", -1, 9).astype(np.uint64)]),
                     dtype=np.uint64)


def _range_of(hashes, bits, ranges):
    """The range of each hash; growing with the hash."""
    return ((hashes >> np.uint64(bits - 32)) * np.uint64(ranges)) >> np.uint64(32)


def _cut_by_range(hashes, bits, ranges):
    """(range, first, last) for sorted hashes."""
    where = _range_of(hashes, bits, ranges)
    edges = np.flatnonzero(np.diff(where)) + 1
    for first, last in zip([0, *edges], [*edges, len(where)]):
        if last > first:
            yield int(where[first]), first, last


def _member(values, sorted_set):
    if not len(sorted_set):
        return np.zeros(len(values), np.bool_)
    at = np.searchsorted(sorted_set, values)
    at[at == len(sorted_set)] = 0
    return sorted_set[at] == values


def _listed(payloads):
    """The sorted hashes of a list of packed ones (NULL: none)."""
    parts = [unpack(p) for p in payloads or ()]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


class _Chunk:
    """The words of a chunk and their window hashes."""

    def __init__(self, texts):
        self.words = Words(pc.fill_null(texts, ""))
        self.hash = self.words.hashes()

    def windows(self, length):
        return window_hashes(self.hash, self.words.per_doc, length)

    def level(self, length):
        """Hash of each window at a level before the last, and its first word."""
        hashes, at = self.windows(length)
        return hashes >> np.uint64(64 - LEVEL_BITS), at

    def survivors(self, length, elsewhere):
        """First words of the windows of ``length`` that repeat, here or ``elsewhere``, as a mask over all words."""
        hashes, at = self.level(length)
        _, back, count = np.unique(hashes, return_inverse=True, return_counts=True)
        out = np.zeros(len(self.words), np.bool_)
        out[at] = (count[back] > 1) | _member(hashes, elsewhere)
        return out

    def candidates(self, length, shorter, alive):
        """First words of the windows of ``length`` all of whose windows of length ``shorter`` are ``alive``."""
        _, at = self.windows(length)
        dead = np.concatenate([[0], np.cumsum(~alive)])
        return at[dead[at + length - shorter + 1] == dead[at]]


def _chunks(df, text, chunk, place):
    """``df`` with the chunk of each row, a run of rows with about CHUNK_BYTES of text, and its place in there.

    The first row of a chunk has the words of all in ``n_words``, the others NULL.
    """
    fields = df.schema.fields
    at_text = df.columns.index(text)

    def numbered(batches):
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = pc.fill_null(batch.column(at_text), "")
            for first, part in text_slices(texts, CHUNK_BYTES):
                n = len(part)
                n_words = int(Words(part).per_doc.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, number)), pa.array(np.arange(n)), pa.array([n_words, *[None] * (n - 1)], pa.int64()),
                     *batch.slice(first, n).columns], names=schema.names,
                )
                number += 1

    schema = T.StructType([
        *[T.StructField(c, T.LongType()) for c in (chunk, place, fresh_name("n_words", df.columns))], *fields,
    ])
    return map_batches(df, numbered, schema)


def _runs(batches, chunk, text):
    """(chunk, texts) of runs of rows of one chunk, in the order in which they were written.

    The rows of a chunk lie together but where a file is read in two parts; then each has a run.
    """
    number, parts = None, []
    for batch in batches:
        numbers, texts = batch.column(chunk).to_numpy(), batch.column(text)
        edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1), len(numbers)]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                if parts and numbers[a] != number:
                    yield number, pa.concat_arrays(parts)
                    parts = []
                number = int(numbers[a])
                parts.append(texts.slice(a, b - a))
    if parts:
        yield number, pa.concat_arrays(parts)


def _together(table, name):
    """A column of a table as one array."""
    column = table.column(name).combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


_SENT = "range long, chunk long, hashes binary"


def _sent_rows(number, hashes, ranges):
    """The rows that a chunk sends: its distinct hashes, packed, a row per range."""
    hashes = np.unique(hashes)
    rows = [(where, pack(hashes[a:b])) for where, a, b in _cut_by_range(hashes, LEVEL_BITS, ranges)]
    return [pa.array([x[0] for x in rows], pa.int64()), pa.array([number] * len(rows), pa.int64()),
            pa.array([x[1] for x in rows], pa.binary())]


def _send_first(docs, chunk, text, ranges, length):
    """Distinct hashes of each chunk's windows of ``length``, a row per chunk and range.

    A chunk that is read in two parts sends the hashes both have twice, so they count as
    repeated; the last level finds out.
    """

    def sent(batches):
        for number, texts in _runs(batches, chunk, text):
            hashes, _ = _Chunk(texts).level(length)
            yield pa.RecordBatch.from_arrays(_sent_rows(number, hashes, ranges), names=["range", "chunk", "hashes"])

    return map_batches(docs.select(chunk, text), sent, _SENT)


def _candidates(words, table, length, shorter):
    """First words of the windows of ``length`` to look at, as a mask over all words of a chunk.

    ``table``: the hashes of windows of length ``shorter`` that other chunks have too; with 0, all windows count.
    """
    keep = np.zeros(len(words.words), np.bool_)
    if shorter:
        alive = words.survivors(shorter, _listed(table.column("hashes").to_pylist()))
        keep[words.candidates(length, shorter, alive)] = True
    else:
        keep[:] = True
    return keep


def _send_level(docs, found, chunk, text, ranges, length, shorter):
    """Distinct hashes of each chunk's candidate windows of ``length``, a row per chunk and range."""

    def sent(rows, repeated):
        words = _Chunk(_together(rows, text))
        hashes, at = words.level(length)
        hashes = hashes[_candidates(words, repeated, length, shorter)[at]]
        columns = _sent_rows(rows.column(chunk)[0].as_py(), hashes, ranges)
        return pa.Table.from_arrays(columns, names=["range", "chunk", "hashes"])

    return map_pairs(docs.select(chunk, text), chunk, found, "chunk", sent, _SENT)


def _returned(chunk_ids, keys, chunk_of, chosen):
    """A table of (chunk, hashes) with the chosen keys of each chunk; keys are sorted within a chunk."""
    keys, chunk_of = keys[chosen], chunk_of[chosen]
    order = np.argsort(chunk_of, kind="stable")
    keys, chunk_of = keys[order], chunk_of[order]
    edges = [0, *(np.flatnonzero(np.diff(chunk_of)) + 1), len(keys)] if len(keys) else [0]
    parts = list(zip(edges, edges[1:]))
    return pa.Table.from_arrays(
        [pa.array([chunk_ids[chunk_of[a]] for a, _ in parts], pa.int64()),
         pa.array([pack(keys[a:b]) for a, b in parts], pa.binary())], names=["chunk", "hashes"],
    )


def _repeated(table):
    """Of the hashes of one range: those that more than one chunk has, back to their chunks."""
    ids = table.column("chunk").to_pylist()
    parts = [unpack(p) for p in table.column("hashes").to_pylist()]
    keys, chunk_of = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, chunk_of = keys[order], chunk_of[order]
    same = keys[1:] == keys[:-1]
    shared = np.zeros(len(keys), np.bool_)
    shared[1:] |= same
    shared[:-1] |= same
    return _returned(ids, keys, chunk_of, shared)


_FINAL = "range long, chunk long, hashes binary, seconds binary, docs binary"


def _last_rows(words, ids, number, keep, ranges, length):
    """The rows that a chunk sends at the wanted length; see ``_send_last``."""
    first, at = words.windows(length)
    second, _ = window_hashes(mixed(words.hash ^ _SECOND), words.words.per_doc, length)
    chosen = keep[at]
    first, second, at = first[chosen], second[chosen], at[chosen]
    ids = _order_keys(ids)[words.words.doc[at]]
    order = np.lexsort((ids, second, first))
    first, second, ids = first[order], second[order], ids[order]
    new = np.ones(len(first), np.bool_)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    first, second, ids = first[new], second[new], ids[new]
    cuts = list(_cut_by_range(first, 64, ranges))
    return pa.Table.from_arrays(
        [pa.array([w for w, _, _ in cuts], pa.int64()), pa.array([number] * len(cuts), pa.int64()),
         *(pa.array([f(x[a:b]) for _, a, b in cuts], pa.binary())
           for x, f in ((first, lambda x: x.tobytes()), (second, lambda x: x.tobytes()), (ids, _near)))],
        names=["range", "chunk", "hashes", "seconds", "docs"],
    )


def _send_last(docs, found, chunk, text, doc, ranges, length, shorter):
    """128-bit hashes of the candidate windows of the wanted length, with the first document of each in the chunk."""

    def sent(rows, repeated):
        words = _Chunk(_together(rows, text))
        keep = _candidates(words, repeated, length, shorter)
        return _last_rows(words, _together(rows, doc), rows.column(chunk)[0].as_py(), keep, ranges, length)

    return map_pairs(docs.select(chunk, text, doc), chunk, found, "chunk", sent, _FINAL)


def _near(ids):
    """Document keys as bytes: the smallest, then distances from it in 4 bytes where these suffice."""
    low = ids.min()
    far = ids.astype(np.uint64) - low.astype(np.uint64)
    wide = int(far.max()) >= 1 << 32
    return bytes([wide]) + np.array([low], "<i8").tobytes() + far.astype("<u8" if wide else "<u4").tobytes()


def _from_near(data):
    far = np.frombuffer(data, "<u8" if data[0] else "<u4", -1, 9).astype(np.uint64)
    return (far + np.frombuffer(data, "<i8", 1, 1).astype(np.uint64)).astype(np.int64)


def _order_keys(ids):
    """Document ids as sort keys, NULL last."""
    return pc.fill_null(ids.cast(pa.int64()), _LAST).to_numpy(zero_copy_only=False)


def _later(table):
    """Of the windows of one range: those that occur earlier in another chunk, back to their chunks."""
    ids = table.column("chunk").to_pylist()
    first = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    chunk_of = np.repeat(np.arange(len(first)), [len(x) for x in first])
    first = np.concatenate(first)
    second = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("seconds").to_pylist()])
    docs = np.concatenate([_from_near(x) for x in table.column("docs").to_pylist()])
    order = np.lexsort((np.asarray(ids, np.int64)[chunk_of], docs, second, first))
    same = (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1])
    lost = np.concatenate([[False], same])
    return _returned(ids, first[order], chunk_of[order], lost)


def _kept_bytes(n, starts, ends, kept, between):
    """A mask over ``n`` bytes from spans in order: ``kept`` says which spans stay, ``between`` whether the rest does."""
    edges = np.empty(2 * len(starts) + 2, np.int64)
    edges[0], edges[1:-1:2], edges[2:-1:2], edges[-1] = 0, starts, ends, n
    flags = np.full(2 * len(starts) + 1, between)
    flags[1::2] = kept
    return np.repeat(flags, np.diff(edges))


def _cut_texts(words, removed):
    """Per document: the text without the removed words and the white space after each, bytes."""
    stop = np.append(words.starts[1:], len(words.data))
    last = words.first[1:][words.per_doc > 0] - 1
    stop[last] = words.offsets[1:][words.per_doc > 0]
    return _split(words.data, _kept_bytes(len(words.data), words.starts, stop, ~removed, True), words.offsets)


def _joined_words(words, kept):
    """Per document: the kept words joined by one space, bytes."""
    data = words.data
    keep = _kept_bytes(len(data), words.starts, words.ends, kept, False)
    which = np.flatnonzero(kept)
    if len(which) > 1:
        # A kept word that another of its document follows has white space after it.
        inner = words.ends[which[:-1]][words.doc[which[1:]] == words.doc[which[:-1]]]
        keep[inner] = True
        data = data.copy()
        data[inner] = 0x20
    return _split(data, keep, words.offsets)


def _split(data, keep, offsets):
    """The kept bytes of each document, one at a time."""
    for a, b in zip(offsets, offsets[1:]):
        yield data[a:b][keep[a:b]].tobytes()


def dedup_substrings(df, length=20, doc="doc_id", text="text", name="substrings"):
    """``df`` with every repeated passage cut from all places but its first.

    A word (``[^\\x20\\x09-\\x0D]+``) is removed if it lies in a window of ``length``
    consecutive words of one document whose word sequence also starts earlier:
    in a document with a smaller ``doc``, or earlier in the same one. Windows
    are judged on the input texts.

    The result has all columns of ``df``, with ``text`` cut (removed words and
    the white space after each; a text without removed words is unchanged), and
    n_words, n_removed (long) and kept_sha256 (of the kept words joined by one
    space). Input columns with these names are replaced. NULL texts have no words and stay NULL.
    A NULL ``doc`` comes after all others; rows with equal ``doc`` are separate
    documents in an arbitrary fixed order. No row is dropped or added.

    Windows are equal if 128 bits of hash are.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, name)
    added = ("n_words", "n_removed", "kept_sha256")
    df = df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in added])
    fields = df.schema.fields
    chunk, place, n_words = (fresh_name(c, df.columns) for c in ("chunk", "place", "n_words"))
    docs = scratch.keep(_chunks(df, text, chunk, place), "chunks", BATCH_BYTES)
    total = docs.agg(F.sum(n_words)).first()[0] or 0
    docs = docs.drop(n_words)
    ranges = max(1, -(-total // RANGE_HASHES))
    levels = levels_of(length)
    found, shorter = spark.createDataFrame([], "chunk long, hashes binary"), 0

    for level in levels[:-1]:
        sent = (_send_level(docs, found, chunk, text, ranges, level, shorter) if shorter
                else _send_first(docs, chunk, text, ranges, level))
        found = scratch.keep(map_groups(sent, "range", _repeated, "chunk long, hashes binary"), f"level{level}", BATCH_BYTES)
        shorter = level
    sent = _send_last(docs, found, chunk, text, doc, ranges, length, shorter)
    lost = scratch.keep(map_groups(sent, "range", _later, "chunk long, hashes binary"), "later")
    for level in levels[:-1]:
        scratch.drop(f"level{level}")

    schema = T.StructType([
        *fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ])

    def cut(rows, repeated):
        rows = rows.sort_by(place)  # rows of one document id keep the order they have in the chunk
        texts = _together(rows, text)
        mine = _Chunk(texts)
        words = mine.words
        hashes, at = mine.windows(length)
        second, _ = window_hashes(mixed(mine.hash ^ _SECOND), words.per_doc, length)
        # Windows in the order of their documents, so the first of equal ones is the earliest.
        ids = _order_keys(_together(rows, doc))
        rank = np.empty(len(ids), np.int64)
        rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
        order = np.lexsort((at, rank[words.doc[at]], second, hashes))
        again = np.zeros(len(at), np.bool_)
        again[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (second[order[1:]] == second[order[:-1]])
        again |= _member(hashes, _listed(repeated.column("hashes").to_pylist()))
        removed = covered(at[again], length, len(words))
        digests = [hashlib.sha256(x).hexdigest() for x in _joined_words(words, ~removed)]
        n_removed = np.bincount(words.doc[removed], minlength=words.n_docs)
        if removed.any():
            new = _cut_texts(words, removed)
            texts = pa.array([x.decode("utf-8", "replace") if there else None
                              for x, there in zip(new, texts.is_valid().to_pylist())], pa.string())
        out = [texts.cast(pa.string()) if f.name == text else rows.column(f.name) for f in fields]
        return pa.Table.from_arrays(
            [*out, pa.array(words.per_doc.astype(np.int64)), pa.array(n_removed.astype(np.int64)),
             pa.array(digests, pa.string())], names=schema.names,
        )

    return map_pairs(docs, chunk, lost, "chunk", cut, schema)
