"""Packing documents into sequences of a fixed length: best fit, then a swap-based local search.

Items are dealt at random into groups of bounded size, packed by group. Random
groups have the same mix of lengths, so what grouping costs is at most part of
one sequence per group.
"""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F

from creditloom.llm.scratch import Scratch
from creditloom.llm.tokens import Encoder, with_end
from creditloom.llm.words import text_slices
from creditloom.llm.workers import map_batches, map_groups

GROUP_ITEMS = 50_000  # items packed together, about
SEARCH_STEPS = 20_000  # items that the local search of one group tries to exchange at most; best fit has placed all before


class _Bins:
    """Bins of a fixed capacity, found by their free room."""

    def __init__(self, capacity):
        self.capacity, self.items, self.fill = capacity, [], []
        self.by_room, self.mask = [set() for _ in range(capacity + 1)], 0

    def _file(self, b):
        room = self.capacity - self.fill[b]
        self.by_room[room].add(b)
        self.mask |= 1 << room

    def _unfile(self, b):
        room = self.capacity - self.fill[b]
        self.by_room[room].discard(b)
        if not self.by_room[room]:
            self.mask &= ~(1 << room)

    def tightest(self, size):
        """Least room of at least ``size`` that a bin has; -1 if there is none."""
        found = self.mask >> size
        return size + (found & -found).bit_length() - 1 if found else -1

    def open(self):
        self.items.append({})
        self.fill.append(0)
        self._file(len(self.fill) - 1)
        return len(self.fill) - 1

    def add(self, b, size, item):
        self._unfile(b)
        self.items[b].setdefault(size, []).append(item)
        self.fill[b] += size
        self._file(b)

    def take(self, b, size):
        self._unfile(b)
        of_size = self.items[b][size]
        item = of_size.pop()
        if not of_size:
            del self.items[b][size]
        self.fill[b] -= size
        self._file(b)
        return item


def _improve(bins, steps):
    """Empty bins by exchanges that raise the sum of squared fills.

    The emptiest bin gives its items away: an item moves to the fullest bin
    with room for it; else it changes places with a smaller item of a fuller bin
    whose room takes the difference (one for one), or with two smaller ones. If
    none of its items can, two other underfull bins exchange items the same way,
    which leaves more room in one of them. A bin that has nothing left is gone.
    """
    fixed = set()
    least, used = -(-sum(bins.fill) // bins.capacity), sum(map(bool, bins.fill))
    tries = iter(range(steps))

    def gives(b):
        return any(_give(bins, b, size) for size in sorted(bins.items[b], reverse=True) if next(tries, None) is not None)

    while used > least:
        victim = min((b for b, f in enumerate(bins.fill) if f and b not in fixed), key=bins.fill.__getitem__, default=None)
        if victim is None:
            return
        while bins.fill[victim] and (gives(victim) or _exchange_others(bins, victim, gives)):
            pass
        if next(tries, None) is None:
            return
        if bins.fill[victim]:
            fixed.add(victim)
        else:
            bins._unfile(victim)  # closed
            used -= 1


def _exchange_others(bins, victim, gives, look=32):
    """One exchange between underfull bins other than ``victim``, out of one of the ``look`` emptiest."""
    bins._unfile(victim)
    try:
        seen, mask = 0, bins.mask & ~1
        while mask and seen < look:
            room = mask.bit_length() - 1
            mask &= ~(1 << room)
            for b in list(bins.by_room[room])[:look - seen]:
                seen += 1
                if gives(b):
                    return True
        return False
    finally:
        bins._file(victim)


def _give(bins, victim, size):
    """Move fill out of ``victim`` with one of its items of ``size``; False if no exchange does."""
    bins._unfile(victim)  # not a partner of itself
    try:
        room = bins.tightest(size)
        target = next(iter(bins.by_room[room])) if room >= 0 else None
        if target is not None and bins.fill[target] + size <= bins.fill[victim]:
            target = None
        partner, gives = None, ()
        if target is None:
            partner, gives = _partner(bins, victim, size)
    finally:
        bins._file(victim)
    if target is not None:
        bins.add(target, size, bins.take(victim, size))
        return True
    if partner is None:
        return False
    item = bins.take(victim, size)
    for g in gives:
        bins.add(victim, g, bins.take(partner, g))
    bins.add(partner, size, item)
    return True


def _partner(bins, victim, size, look=64):
    """A fuller bin that takes an item of ``size`` for one or two smaller ones, gaining as much as its room allows.

    Looks at ``look`` bins of the largest rooms below the size; one such bin
    gains the most.
    """
    seen, mask = 0, bins.mask & ((1 << size) - 2)
    best = (0, None, ())
    while mask and seen < look:
        room = mask.bit_length() - 1
        mask &= ~(1 << room)
        if best[0] >= room:
            break
        for b in bins.by_room[room]:
            if bins.fill[b] < bins.fill[victim]:
                continue
            seen += 1
            sizes = sorted(bins.items[b])
            for i, a in enumerate(sizes):
                if size - room <= a < size and size - a > best[0]:
                    best = (size - a, b, (a,))
                for c in sizes[i if len(bins.items[b][a]) > 1 else i + 1:]:
                    if a + c >= size:
                        break
                    if a + c >= size - room and size - a - c > best[0]:
                        best = (size - a - c, b, (a, c))
            if seen >= look or best[0] >= room:
                break
    return best[1], best[2]


def pack_group(sizes, capacity, steps=SEARCH_STEPS):
    """(bin, offset) of each item; sizes are 1 to ``capacity``. Bins are numbered from 0 without gaps."""
    bins = _Bins(capacity)
    for item in np.argsort(-np.asarray(sizes), kind="stable").tolist():
        room = bins.tightest(sizes[item])
        target = next(iter(bins.by_room[room])) if room >= 0 else bins.open()
        bins.add(target, sizes[item], item)
    _improve(bins, steps)
    where, n = [None] * len(sizes), 0
    for b, fill in enumerate(bins.fill):
        if fill:
            at = 0
            for size, items in bins.items[b].items():
                for item in items:
                    where[item] = (n, at)
                    at += size
            n += 1
    return where


_PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = f"{_PIECES}, sequence_id long, offset long"


def token_pieces(df, tokenizer, end_id, capacity, doc="doc_id", text="text"):
    """The pieces of each document: its ids and ``end_id``, cut into runs of ``capacity`` from the end."""
    source = df.select(F.col(f"`{doc}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))

    def cut(batches):
        encoder, row = Encoder.load(tokenizer, with_space=True), TaskContext.get().partitionId() << 33
        for batch in batches:
            docs = batch.column(0)
            for first, texts in text_slices(pc.fill_null(batch.column(1), "")):
                ids, sizes = with_end(*encoder.slice_ids(texts), end_id)
                names, out, at = docs.slice(first, len(texts)).to_pylist(), [], 0
                for name, size in zip(names, sizes.tolist()):
                    start, piece = 0, 0
                    end = (size - 1) % capacity + 1
                    while start < size:
                        out.append((row, name, piece, start, end - start,
                                    zlib.crc32(ids[at + start:at + end].astype("<u4").tobytes())))
                        row, start, piece, end = row + 1, end, piece + 1, end + capacity
                    at += size
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                    names=["row", "doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return map_batches(source, cut, _PIECES)


def pack_documents(df, tokenizer, end_id=0, capacity=2048, doc="doc_id", text="text", group_items=GROUP_ITEMS):
    """Pieces of all documents and their places in sequences of at most ``capacity`` tokens.

    Per piece: doc_id, piece (from 0), start (ids of its document before it),
    length, ids_crc32, sequence_id (any number), offset (place there, without
    gaps from 0). A document is its ids and then ``end_id``; only one longer
    than ``capacity`` is cut, into pieces of ``capacity`` of which the first may
    be shorter. NULL and empty texts are the end id alone. Repeated rows and
    NULL or equal doc_ids are documents of their own. Other columns are ignored.

    Full pieces are sequences of their own. The others are packed in random
    groups of about ``group_items``; a group's memory is bounded by that.
    """
    scratch = Scratch(df.sparkSession, "packing")
    pieces = scratch.keep(token_pieces(df, tokenizer, end_id, capacity, doc, text), "pieces")
    partial = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-partial.count() // group_items))

    def packed(table):
        # Rows in a fixed order, so a repeated task packs alike.
        table = table.sort_by("row")
        sizes, group = table.column("length").to_pylist(), table.column("group")[0].as_py()
        where = pack_group(sizes, capacity)
        table = table.drop_columns(["group"])
        table = table.append_column("sequence_id", pa.array([(group << 32) + b for b, _ in where], pa.int64()))
        return table.append_column("offset", pa.array([at for _, at in where], pa.int64()))

    grouped = partial.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    full = pieces.where(F.col("length") == capacity).withColumns(
        {"sequence_id": -1 - F.col("row"), "offset": F.lit(0).cast("bigint")}
    )
    return map_groups(grouped, "group", packed, _PACKED).union(full).drop("row")
