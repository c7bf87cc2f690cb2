"""Phrase collocations by stripes.

A stripe belongs to a prefix of words and counts the words that follow it. The
stripe of the empty prefix counts all words, those of one word the pairs, and so
on. Tasks count the stripes of a slice of texts, send each entry to the bucket of
its phrase, and there stripes of the same prefix are added element by element;
so one frequent prefix, and one language, is spread over all buckets. From the
merged stripes come the extensions of a prefix (its entries), the totals of
prefixes (an entry of the stripe one word shorter), and for each phrase the
greatest count of a longer one (the maximum of its own stripe, and of the
stripes where it is the end).

A phrase of three words or more that is frequent has frequent parts, so later
rounds only count where both parts may be frequent, by a filter of bounded size
that never denies a frequent one.
"""

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from creditloom.llm.scratch import Scratch
from creditloom.llm.words import joined, mixed, span_hashes, text_slices
from creditloom.llm.workers import map_batches

SLICE_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20  # of the input, for each bucket of phrases
MERGE_ENTRIES = 2_000_000  # a bucket's entries are added up whenever so many wait
FILTER_BITS = 1 << 27  # at most; a filter with fewer bits per phrase lets more infrequent ones through, no less
NO_LANGUAGE = "und"
SALTS = 64

_SPLIT, _GAP = b".,;:!?\n\x0b\x0c\r", b" \t"
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(_GAP)], _CLASS[list(_SPLIT)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def words_of(texts):
    """The lower-cased words of an Arrow string array without NULLs: a dictionary, codes, pieces and documents.

    Pieces are numbered; two consecutive words with one number stand in one piece of one document.
    """
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = _LOWER[(np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8))[offsets[0]:offsets[-1]]]
    offsets = offsets - offsets[0]
    kind = _CLASS[data]
    inside = kind == 0
    begin, finish = inside.copy(), inside.copy()
    cuts = offsets[(offsets > 0) & (offsets < len(inside))]
    begin[1:] &= ~inside[:-1]
    finish[:-1] &= ~inside[1:]
    begin[cuts], finish[cuts - 1] = inside[cuts], inside[cuts - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    doc = np.searchsorted(offsets[1:], starts, "right")
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts) + doc
    bounds = np.concatenate([[0], np.cumsum(ends - starts)])
    found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data[inside])).dictionary_encode()
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False).astype(np.int64), piece, doc


def _hashes(strings):
    """A 64-bit hash of each of some strings."""
    strings = strings.cast(pa.large_string())
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    return span_hashes(np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets[:-1], offsets[1:])


def _phrase_hashes(language, word_hashes):
    """Hash of each phrase from the hashes of its language and of its words, one array per place."""
    return functools.reduce(joined, word_hashes, mixed(language))


class Filter:
    """A Bloom filter of phrases: says yes to all that were added and to few others."""

    PROBES = 4

    def __init__(self, bits):
        self.bits = bits

    @classmethod
    def of(cls, phrases):
        """Of a table (language, prefix, next); each task sets bits, the driver gets the words that have any."""
        count = phrases.count()
        size = 1 << 16
        while size < min(16 * count, FILTER_BITS):
            size *= 2

        def positions(batches):
            for batch in batches:
                spots = cls._spots(_table_hashes(*batch.columns), size)
                word, bit = spots >> np.uint64(6), np.uint64(1) << (spots & np.uint64(63))
                order = np.argsort(word, kind="stable")
                word, bit = word[order], bit[order]
                first = _groups([word])
                bits = np.bitwise_or.reduceat(bit, first) if len(first) else bit
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word[first].astype(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"]
                )

        found = map_batches(phrases, positions, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
        bits = np.zeros(size // 64, np.uint64)
        rows = found.toArrow()  # at most FILTER_BITS / 64 rows
        bits[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
        return cls(bits)

    @classmethod
    def _spots(cls, hashes, size):
        step = mixed(hashes) | np.uint64(1)
        return np.concatenate([(hashes + np.uint64(i) * step) % np.uint64(size) for i in range(cls.PROBES)])

    def has(self, hashes):
        spots = self._spots(hashes, 64 * len(self.bits)).reshape(self.PROBES, -1)
        return ((self.bits[spots >> np.uint64(6)] >> (spots & np.uint64(63))) & np.uint64(1)).all(axis=0)


def _table_hashes(languages, prefixes, nexts):
    """Hashes of the phrases in a table of entries, as ``_phrase_hashes`` gives them."""
    out = _hashes(languages)
    phrases = pc.binary_join_element_wise(prefixes, nexts, " ")
    words = pc.split_pattern(phrases, " ")
    flat = _hashes(words.flatten())
    size = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    first = np.cumsum(size) - size
    out = mixed(out)
    for k in range(int(size.max(initial=0))):
        live = np.flatnonzero(size > k)
        out[live] = joined(out[live], flat[first[live] + k])
    return out


# Counting stripes

_STRIPES = pa.schema([
    ("bucket", pa.int32()), ("lang", pa.string()), ("prefixes", pa.list_(pa.string())), ("sizes", pa.list_(pa.int32())),
    ("nexts", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
])
_STRIPES_DDL = (
    "bucket int, lang string, prefixes array<string>, sizes array<int>, nexts array<string>, counts array<bigint>"
)


def _groups(keys):
    """Starts of the runs of equal neighbours in ``keys``, arrays of one length."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.ones(len(keys[0]), bool)
    new[1:] = functools.reduce(np.logical_or, [k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _slice_stripes(texts, languages, lengths, filter_, n_buckets):
    """Rows of the stripes of one slice: phrases of each of ``lengths`` words, counted and dealt to buckets."""
    words, code, piece, doc = words_of(texts)
    if not len(code):
        return
    hashes = _hashes(words)
    coded = languages.dictionary_encode()
    names, lang = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[doc]
    lang_hashes = _hashes(names)
    for length in lengths:
        n = len(code) - length + 1
        at = np.flatnonzero(piece[:n] == piece[length - 1:]) if n > 0 else np.zeros(0, np.int64)
        if filter_ is not None:
            # Both parts that lack one word have to be frequent; equal neighbours are looked up once.
            part = _phrase_hashes(lang_hashes[lang[:n + 1]], [hashes[code[k:k + n + 1]] for k in range(length - 1)])
            once, back = np.unique(part, return_inverse=True)
            ok = filter_.has(once)[back]
            at = at[ok[at] & ok[at + 1]]
        if not len(at):
            continue
        # Codes of prefixes by one word at a time, so that they stay below the number of words of the slice.
        prefix = lang[at]
        for k in range(length - 1):
            _, prefix = np.unique(prefix * len(words) + code[at + k], return_inverse=True)
        _, first, count = np.unique(prefix * len(words) + code[at + length - 1], return_index=True, return_counts=True)
        at = at[first]
        entry = _phrase_hashes(lang_hashes[lang[at]], [hashes[code[at + k]] for k in range(length)])
        bucket = (entry % np.uint64(n_buckets)).astype(np.int64)
        order = np.lexsort((prefix[first], lang[at], bucket))
        at, count, bucket, prefix = at[order], count[order], bucket[order], prefix[first][order]
        starts = _groups([bucket, lang[at]])
        heads = _groups([bucket, lang[at], prefix])
        texts_of = [words.take(pa.array(code[at[heads] + k])) for k in range(length - 1)]
        prefixes = pc.binary_join_element_wise(*texts_of, pa.scalar(" ", pa.large_string())) if texts_of else pa.array([""] * len(heads), pa.large_string())
        sizes = np.diff(np.append(heads, len(at)))
        by_row = np.append(np.searchsorted(heads, starts), len(heads))
        rows = np.append(starts, len(at))
        yield pa.RecordBatch.from_arrays([
            pa.array(bucket[starts].astype(np.int32)), names.take(pa.array(lang[at[starts]])).cast(pa.string()),
            pa.ListArray.from_arrays(by_row.astype(np.int32), prefixes.cast(pa.string())),
            pa.ListArray.from_arrays(by_row.astype(np.int32), pa.array(sizes.astype(np.int32))),
            pa.ListArray.from_arrays(rows.astype(np.int32), words.take(pa.array(code[at + length - 1])).cast(pa.string())),
            pa.ListArray.from_arrays(rows.astype(np.int32), pa.array(count.astype(np.int64))),
        ], schema=_STRIPES)


_ENTRIES = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("next", pa.string()), ("count", pa.int64())])
_ENTRIES_DDL = "lang string, prefix string, next string, count bigint"


def _unpacked(batch):
    """The entries of some packed stripes, as a table."""
    prefixes, sizes = batch["prefixes"].combine_chunks(), batch["sizes"].combine_chunks()
    each = sizes.flatten().to_numpy()
    stripe = pa.array(np.repeat(np.arange(len(each)), each))
    row = pa.array(np.repeat(np.arange(len(batch)), pc.list_value_length(batch["nexts"]).to_numpy()))
    return pa.table([
        batch["lang"].combine_chunks().take(row), prefixes.flatten().take(stripe),
        batch["nexts"].combine_chunks().flatten(), batch["counts"].combine_chunks().flatten(),
    ], schema=_ENTRIES)


def merged(entries):
    """Stripes added element by element: one row per entry."""
    coded = [entries[c].combine_chunks().dictionary_encode() for c in ("lang", "prefix", "next")]
    codes = [c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in coded]
    order = np.lexsort(codes[::-1])
    codes = [c[order] for c in codes]
    starts = _groups(codes)
    count = entries["count"].to_numpy()[order]
    return pa.table(
        [c.dictionary.take(pa.array(code[starts])) for c, code in zip(coded, codes)]
        + [pa.array(np.add.reduceat(count, starts) if len(starts) else count)], schema=_ENTRIES,
    )


def _frequent(entries, least):
    """Entries of at least ``least``, and per language the sum of all of the empty prefix as an entry without a word."""
    entries = merged(entries)
    root = entries.filter(pc.equal(entries["prefix"], ""))
    total = root.group_by("lang").aggregate([("count", "sum")])
    totals = pa.table([
        total["lang"], pa.array([""] * len(total), pa.string()), pa.nulls(len(total), pa.string()), total["count_sum"],
    ], schema=_ENTRIES)
    return pa.concat_tables([entries.filter(pc.greater_equal(entries["count"], least)), totals]).combine_chunks()


def _merge_buckets(least):
    """Adds up the stripes of each bucket of a run of rows ordered by bucket; memory is that of a bucket's distinct phrases."""
    def run(batches):
        bucket, waiting, n, last = None, [], 0, 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            of = table["bucket"].to_numpy()
            edges = np.append(_groups([of]), len(of))
            for a, b in zip(edges[:-1], edges[1:]):
                if waiting and of[a] != bucket:
                    yield from _frequent(pa.concat_tables(waiting), least).to_batches()
                    waiting, n, last = [], 0, 0
                bucket = of[a]
                waiting.append(_unpacked(table.slice(a, b - a)))
                n += len(waiting[-1])
                if n >= last + MERGE_ENTRIES:
                    waiting = [merged(pa.concat_tables(waiting))]
                    n = last = len(waiting[0])
        if waiting:
            yield from _frequent(pa.concat_tables(waiting), least).to_batches()

    return run


def _count(docs, lengths, least, n_buckets, filter_):
    """Entries (lang, prefix, next, count) of the given numbers of words that occur ``least`` times; see ``_frequent``."""
    shared = None if filter_ is None else docs.sparkSession.sparkContext.broadcast(filter_.bits)

    def stripes(batches):
        for batch in batches:
            for first, texts in text_slices(batch.column(1), SLICE_BYTES):
                languages = batch.column(0).slice(first, len(texts))
                yield from _slice_stripes(
                    texts, languages, lengths, None if shared is None else Filter(shared.value), n_buckets
                )

    packed = map_batches(docs, stripes, _STRIPES_DDL)
    return map_batches(
        packed.repartition("bucket").sortWithinPartitions("bucket"), _merge_buckets(least), _ENTRIES_DDL
    )


def phrase_stripes(docs, text="text", lang="lang", most_words=3, least=10):
    """The merged stripes of frequent entries: (lang, prefix, next, count), a kept table.

    The prefix has 0 to ``most_words`` - 1 words, joined by spaces. Rows with prefix '' and no next word give the
    number of all words of a language; they come in parts, to be summed.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    source = docs.select(
        F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = 1 + size // BUCKET_BYTES
    stripes = scratch.keep(_count(source, range(1, min(2, most_words) + 1), least, n_buckets, None), "words_1")
    for length in range(3, most_words + 1):
        parts = F.size(F.split("prefix", " ")) == length - 2
        shorter = stripes.where((F.col("prefix") != "") & parts).select("lang", "prefix", "next")
        longer = _count(source, [length], least, n_buckets, Filter.of(shorter))
        stripes = stripes.union(scratch.keep(longer, f"words_{length}"))
    return stripes


# Scores, from the stripes alone

def collocations(
    docs, text="text", lang="lang", most_words=3, least=10, subsumed_percent=50, most=2000, scale=1_000_000,
):
    """The best phrases of every language: lang, rank (from 1), phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces, and those at spaces and tabs into
    words. ``n`` counts the words of the language and ``a`` the occurrences of the phrase (2 to ``most_words`` words,
    at least ``least`` times) within pieces, overlapping ones too. A cut after the first k words gives l and r, the
    counts of both parts, and floor(scale * a * a / (l * r)); the cut with the lowest score counts, of equal ones the
    first. Phrases inside a longer frequent phrase that has ``subsumed_percent`` of their count are left out.
    Ordered by score, then a, both descending, then phrase in the order of UTF-8 bytes; the first ``most`` are kept.

    NULL texts have no words, a NULL language counts as 'und'; repeated rows count each. Other columns are not read,
    whatever their names. Counts are exact and of whole texts: words are compared as text, no hash decides a count.
    A language holding most rows is spread over all buckets, its best phrases are first chosen in parts.
    """
    stripes = phrase_stripes(docs, text, lang, most_words, least)
    n = stripes.where("next IS NULL").groupBy("lang").agg(F.sum("count").alias("n"))
    entries = stripes.where("next IS NOT NULL")
    whole = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    counts = entries.select("lang", whole.alias("phrase"), F.col("count").alias("a"))
    words = F.split("phrase", " ")
    long = counts.withColumn("words", words).where(F.size("words") > 1)

    def part(first, last):
        return F.concat_ws(" ", F.slice("words", first, last))

    size = F.size("words")
    cuts = long.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, size).alias("right"),
    )
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    # Both parts occur at least a times, so the score is at most the scale; the products have up to 38 digits.
    a, l, r = (F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r"))
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumns(
        {"over": F.lit(scale).cast("decimal(7,0)") * a * a, "under": l * r}
    ).withColumn("score", F.expr("over div under")).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    # The maxima of the stripes: for each phrase the count of the longer ones that begin or end with it, or hold it.
    shorter = long.where(size > 2).select(
        "lang", "a", F.explode(F.flatten(F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.concat_ws(" ", F.slice("words", i, m))),
        ))).alias("phrase"),
    )
    covers = shorter.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left_out = F.coalesce(F.col("longer"), F.lit(0)) * 100 >= F.col("a") * subsumed_percent
    kept = scored.join(covers, ["lang", "phrase"], "left").where(~left_out).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score"
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = Window.partitionBy("lang", "salt").orderBy(*order)
    best = Window.partitionBy("lang").orderBy(*order)
    return (
        kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
        .withColumn("place", F.row_number().over(some)).where(F.col("place") <= most)
        .withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= most)
        .join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )

