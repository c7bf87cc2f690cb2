"""Benchmark decontamination by winnowing, in DataFrame expressions only.

A window's fingerprint is the smallest hash of the word k-grams inside it.
Equal windows have equal fingerprints, and neighbouring windows mostly share
theirs, so a text has far fewer fingerprints than windows. Fingerprints of
documents and benchmark meet in an equi-join; a hit is then extended to the
windows that have this fingerprint, and these are compared whole. Every window
both sides share is found.
"""

from pyspark.sql import functions as F

from creditloom.llm.scratch import Scratch, fresh_name, let, small

WINDOW = 13  # words
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text):
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; none for NULL."""
    return F.array_remove(
        F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()), SEPARATORS), ""
    )


def gram_size(window):
    """Words of the k-grams of a window: under half of it, so that a window has several."""
    return max(1, min(5, (window + 1) // 2))


def _sequence(last):
    return F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def window_runs(words, window):
    """Runs of neighbouring windows with one fingerprint, as an array of (print, first, wholes).

    ``words``: an array column of words. A window of ``window`` words is a
    fingerprint and a hash of its whole; ``first`` is the place of the run's
    first window, ``wholes`` has the hashes of the run's windows.
    """
    k = gram_size(window)

    def prints_of(hashes):
        grams = F.transform(_sequence(F.size(hashes) - k + 1), lambda i: F.xxhash64(F.slice(hashes, i, k)))
        return let(grams, lambda g: F.transform(
            _sequence(F.size(hashes) - window + 1), lambda i: F.array_min(F.slice(g, i, window - k + 1))
        ))

    def runs_of(hashes, prints):
        firsts = F.filter(
            F.transform(prints, lambda x, i: F.when((i == 0) | (x != F.get(prints, i - 1)), i)), lambda i: i.isNotNull()
        )

        def run(starts, a, j):
            n = F.coalesce(F.get(starts, j + 1), F.size(prints)) - a
            return F.struct(
                F.get(prints, a).alias("print"), a.alias("first"),
                F.transform(F.sequence(a, a + n - 1), lambda i: F.xxhash64(F.slice(hashes, i + 1, window))).alias("wholes"),
            )

        return let(firsts, lambda starts: F.transform(starts, lambda a, j: run(starts, a, j)))

    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda hashes: let(prints_of(hashes), lambda prints: runs_of(hashes, prints)),
    )


def _exploded(df, keys, window):
    """A row for each run: keys, length, print, first, wholes."""
    runs = df.select(*keys, F.explode(window_runs(F.col("words"), window)).alias("run"))
    return runs.select(*keys, F.lit(window).alias("length"), "run.print", "run.first", "run.wholes")


def find_overlaps(df, benchmark, doc="doc_id", text="text", item="item_id", item_text="text", window=WINDOW):
    """``df`` with n_words, n_hit, n_items (long), items_sha256 and contaminated.

    A benchmark item is all its windows of ``window`` consecutive words; an item
    of fewer words, but not none, is one window. A word of a document inside any
    occurrence of a window is hit; n_items counts the items with such windows,
    items_sha256 is over their ids, sorted as strings and joined by commas.
    contaminated: hit words are at least 5 % of all, and at least one.

    NULL and empty texts have no words; items without id or words are ignored;
    items that share an id count as one. Documents keep their rows: repeated
    ones get equal results, also with a NULL ``doc``. Input columns named like a
    result column are replaced. Windows are equal if 64 bits of fingerprint and 64 of hash are.

    The fingerprints of the benchmark are broadcast only if they are few
    (``scratch.BROADCAST_ROWS``); otherwise the joins shuffle. A window that many
    items share carries the number of its set of items, not the set.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "decontaminate")
    results = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    given = [c for c in df.columns if c.lower() not in results or c in (doc, text)]
    df = df.select(*[df[f"`{c}`"] for c in given])

    items = benchmark.select(
        F.col(f"`{item}`").cast("string").alias("item"), words_of(F.col(f"`{item_text}`")).alias("words")
    ).where("item IS NOT NULL AND size(words) > 0")
    # At most ``window`` different lengths.
    lengths = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(window))).distinct().collect())
    known = None
    for n in lengths:
        of_length = items.where(F.size("words") >= window if n == window else F.size("words") == n)
        part = _exploded(of_length, ["item"], n).select("length", "print", F.explode("wholes").alias("whole"), "item")
        known = part if known is None else known.unionByName(part)

    key = [F.xxhash64(F.col(f"`{doc}`"), F.col(f"`{text}`")).alias("key_a"),
           F.xxhash64(F.lit(1), F.col(f"`{text}`"), F.col(f"`{doc}`")).alias("key_b")]
    count = F.size(words_of(F.col(f"`{text}`"))).cast("bigint")
    n_key_a, n_key_b = fresh_name("key_a", given), fresh_name("key_b", given)
    plain = df.select(
        *[F.col(f"`{c}`") for c in given], count.alias("n_words"), key[0].alias(n_key_a), key[1].alias(n_key_b)
    )
    if known is None:
        found = spark.createDataFrame([], "key_a long, key_b long, n_hit long, n_items long, items_sha256 string")
    else:
        # Sets of items that some window belongs to, numbered by their own hash.
        sets = known.groupBy("length", "print", "whole").agg(F.array_sort(F.collect_set("item")).alias("items"))
        sets = scratch.keep(sets.withColumn("set", F.sha2(F.to_json("items"), 256)), "windows")
        windows = small(scratch.keep(sets.select("length", "print", "whole", "set"), "window_sets"))
        prints = small(scratch.keep(sets.select("length", "print").distinct(), "prints"))
        members = small(scratch.keep(sets.select("set", "items").dropDuplicates(["set"]), "sets"))

        of_docs = df.select(*key, words_of(F.col(f"`{text}`")).alias("words"))
        hits = None
        for n in lengths:
            part = (
                _exploded(of_docs, ["key_a", "key_b"], n).join(prints, ["length", "print"])
                .select("key_a", "key_b", "length", "print", "first", F.posexplode("wholes").alias("i", "whole"))
                .join(windows, ["length", "print", "whole"])
                .select("key_a", "key_b", (F.col("first") + F.col("i")).alias("at"), "length", "set")
            )
            hits = part if hits is None else hits.unionByName(part)
        # One row per document: its hit windows (no more than it has words) and sets of items.
        per_doc = hits.groupBy("key_a", "key_b").agg(
            F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.col("length")).alias("end")))).alias("spans"),
            F.collect_set("set").alias("sets"),
        )
        merged = F.aggregate(
            "spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")),
            lambda s, x: F.struct(
                F.greatest(s["end"], x["end"]).alias("end"),
                (s["total"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["end"], x["at"]))).alias("total"),
            ),
        )["total"]
        per_doc = scratch.keep(
            per_doc.select("key_a", "key_b", merged.cast("bigint").alias("n_hit"), "sets"), "hits"
        )
        listed = (
            per_doc.select("key_a", "key_b", F.explode("sets").alias("set")).join(members, "set")
            .groupBy("key_a", "key_b").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        )
        found = per_doc.drop("sets").join(listed, ["key_a", "key_b"]).select(
            "key_a", "key_b", "n_hit", F.size("items").cast("bigint").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        )
    found = found.withColumnsRenamed({"key_a": n_key_a, "key_b": n_key_b})
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0).cast("bigint"))
    return plain.join(found, [n_key_a, n_key_b], "left").select(
        *[F.col(f"`{c}`") for c in given], "n_words", n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
