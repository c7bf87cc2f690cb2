"""Token ids in patched frame-of-reference blocks.

The ids of many documents are cut into blocks. A block stores its ids less the
block's minimum, packed at the width that a percentile of them needs; the few
that need more bits are patched from a list of exceptions. A segment is a run of
whole documents: block starts, blocks, document ids and lengths. Segments are
rows of a Spark table, so any store that Spark writes to can hold the files.
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
from creditloom.llm.workers import map_batches

BLOCK_IDS = 4096
PERCENTILE = 95  # of a block's ids that must fit the packed width
_HEAD = np.dtype([("low", "<u4"), ("n", "<u2"), ("exceptions", "<u2"), ("width", "u1"), ("unused", "u1", 3)])


def _packed(values, width):
    """The low ``width`` bits of each value, one after another."""
    if width in (8, 16, 32):
        return values.astype(f"<u{width // 8}").tobytes()
    bits = (values[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def _unpacked(data, n, width):
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", n).astype(np.uint32)
    if not width:
        return np.zeros(n, np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    return bits.astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


def encode_block(ids):
    """Bytes of a block of 1 to BLOCK_IDS ids below 2^32."""
    ids = np.asarray(ids, np.uint32)
    low = ids.min()
    values = ids - low
    rank = (len(values) * PERCENTILE + 99) // 100 - 1
    width = int(np.partition(values, rank)[rank]).bit_length()
    width = next((w for w in (8, 16, 32) if width <= w and w - width <= 1), width)
    large = np.flatnonzero(values >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    head = np.zeros(1, _HEAD)
    head["low"], head["n"], head["exceptions"], head["width"] = low, len(ids), len(large), width
    packed = _packed(values & np.uint32((1 << width) - 1) if width < 32 else values, width) if width else b""
    return head.tobytes() + packed + large.astype("<u2").tobytes() + values[large].astype("<u4").tobytes()


def decode_block(data):
    head = np.frombuffer(data, _HEAD, 1)[0]
    n, k, width = int(head["n"]), int(head["exceptions"]), int(head["width"])
    at = _HEAD.itemsize
    packed = -(-n * width // 8)
    values = _unpacked(data[at:at + packed], n, width)
    at += packed
    values[np.frombuffer(data, "<u2", k, at)] = np.frombuffer(data, "<u4", k, at + 2 * k)
    return values + np.uint32(head["low"])


def encode_ids(ids):
    """(block starts, blocks): the byte place of each block and their bytes."""
    blocks = [encode_block(ids[i:i + BLOCK_IDS]) for i in range(0, len(ids), BLOCK_IDS)]
    return np.concatenate([[0], np.cumsum([len(b) for b in blocks])[:-1]]).astype(np.int64) if blocks else np.zeros(
        0, np.int64), b"".join(blocks)


def decode_ids(starts, blocks):
    ends = [*starts[1:], len(blocks)]
    parts = [decode_block(blocks[a:b]) for a, b in zip(starts, ends)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


_SEGMENT = (
    "shard int, segment int, before long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, "
    "block_starts array<bigint>, blocks binary"
)


def write_token_files(df, scratch, tokenizer, end_id, name="tokens", with_space=False, doc="doc_id", text="text"):
    """Encode every document, append ``end_id``, and keep segments in ascending order of ``doc``.

    Shards are ranges of ``doc``; (shard, segment) is the order of the files and
    ``before`` counts the ids of the shard before a segment. NULL texts are
    empty; rows with a NULL ``doc`` come first; rows with equal ``doc`` are
    ordered by text. Other columns are ignored.
    """
    source = df.select(
        F.col(f"`{doc}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )

    def written(batches):
        encoder, shard, segment, before = Encoder.load(tokenizer, with_space), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            docs = batch.column(0)
            for first, texts in text_slices(pc.fill_null(batch.column(1), "")):
                ids, lengths = with_end(*encoder.slice_ids(texts), end_id)
                starts, blocks = encode_ids(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([before], pa.int64()),
                     pa.array([len(ids)], pa.int64()), pa.array([docs.slice(first, len(texts)).to_pylist()], pa.list_(pa.int64())),
                     pa.array([lengths], pa.list_(pa.int64())), pa.array([starts], pa.list_(pa.int64())),
                     pa.array([blocks], pa.binary())],
                    names=["shard", "segment", "before", "n_ids", "doc_ids", "lengths", "block_starts", "blocks"],
                )
                segment, before = segment + 1, before + len(ids)

    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return scratch.keep(map_batches(ordered, written, _SEGMENT), name)


def read_documents(files):
    """Per document of kept token files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    spark = files.sparkSession
    # One row per shard, as many as the write had tasks.
    sizes = sorted(files.groupBy("shard").agg(F.sum("n_ids")).collect())
    starts = np.concatenate([[0], np.cumsum([n for _, n in sizes])]).tolist()
    offsets = spark.createDataFrame([(s, int(o)) for (s, _), o in zip(sizes, starts)], "shard int, shard_start long")

    def read(batches):
        for batch in batches:
            for r in range(len(batch)):
                at, docs, lengths, block_starts, blocks = (batch.column(i)[r].as_py() for i in range(5))
                ids, crc, start, place = decode_ids(block_starts, blocks).astype("<u4"), [], [], 0
                for n in lengths:
                    crc.append(zlib.crc32(ids[place:place + n].tobytes()))
                    start.append(at + place)
                    place += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in (docs, start, lengths, crc)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    placed = files.join(F.broadcast(offsets), "shard").select(
        (F.col("shard_start") + F.col("before")).alias("at"), "doc_ids", "lengths", "block_starts", "blocks"
    )
    return map_batches(placed, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_documents(df, tokenizer, end_id, with_space=False, doc="doc_id", text="text"):
    """Write the token files of ``df`` and read back what they hold; see the two steps above."""
    scratch = Scratch(df.sparkSession, "token_files")
    return read_documents(write_token_files(df, scratch, tokenizer, end_id, "tokens", with_space, doc, text))
