"""Quality by weak supervision, in DataFrame expressions only.

Each rule looks at a few statistics of a text and votes good, bad, or abstains.
How far each rule is to be trusted is not set by hand: expectation
maximisation over the counts of vote patterns, started from a weak belief in
the rules, estimates for good and for bad texts how often each rule votes and how
often such a vote is bad. The only thing asked of a rule is that it is no worse
than chance; one that calls as many good texts bad as bad ones ends with no
weight. A text's posterior probability of being good follows from its votes,
and replaces the rule that all must pass.
"""

import math

from pyspark.sql import functions as F

from creditloom.llm.scratch import Scratch, let

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8  # words of the windows that count as repeated
GOOD, BAD = 1, 0

# What EM starts from: bad and good votes of a rule on good and on bad texts, its votes and abstentions on either, and
# bad and good texts. These beliefs weigh as much as so many texts and bound nothing.
BELIEF = {GOOD: (0.05, 4.95), BAD: (1.0, 4.0)}
ABSTAINING = (1.0, 1.0)
TEXTS = {GOOD: 4.0, BAD: 1.0}
ROUNDS = 2000
SETTLED = 1e-9


def _without(text, characters):
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _repeat_words(windows):
    """Words in windows whose hash occurs twice or more, from the hash of each window."""
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))

    def again(s):
        def same(x, k):
            return F.coalesce(F.get(s, k)["hash"] == x["hash"], F.lit(False))

        repeated = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return F.sort_array(F.transform(repeated, lambda x: x["at"]))

    def covered(places):
        steps = F.transform(places, lambda p, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW))
        ))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    # Only the few texts with a repeated window have theirs sorted and compared.
    return F.when(
        F.size(F.array_distinct(windows)) < F.size(windows), let(ordered, lambda s: let(again(s), covered))
    ).otherwise(F.lit(0))


def with_statistics(df, text="text"):
    """``df`` and the statistics that rules read, as columns ``q_*``.

    NULL counts as empty. Whole texts are read; nothing is shuffled.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    trimmed = F.btrim(body, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x09-\\x0D ]+"))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def of_words(hashes):
        windows = F.transform(
            F.when(F.size(hashes) > WINDOW, F.sequence(F.lit(1), F.size(hashes) - WINDOW + 1))
            .otherwise(F.array().cast("array<int>")),
            lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)),
        )
        return F.struct(
            F.size(hashes).alias("n"), F.size(F.array_distinct(hashes)).alias("distinct"),
            let(windows, _repeat_words).alias("again"),
        )

    df = df.withColumns({
        "q_of_words": let(F.transform(words, lambda w: F.xxhash64(w)), of_words),
        "q_of_lines": let(lines, lambda x: F.struct(
            F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("again")
        )),
        "q_chars": F.length(_without(body, SPACES)).cast("bigint"),
        "q_symbols": (F.length(body) - F.length(_without(body, SYMBOLS))).cast("bigint"),
        "q_capitals": F.length(F.regexp_replace(body, "[^A-Z]+", "")).cast("bigint"),
        "q_letters": F.length(F.regexp_replace(body, "[^A-Za-z]+", "")).cast("bigint"),
    })
    return df.withColumns({
        "q_n_words": F.col("q_of_words.n").cast("bigint"),
        "q_distinct": F.col("q_of_words.distinct").cast("bigint"),
        "q_repeat_words": F.col("q_of_words.again").cast("bigint"),
        "q_n_lines": F.col("q_of_lines.n").cast("bigint"),
        "q_dup_lines": F.col("q_of_lines.again").cast("bigint"),
    }).drop("q_of_words", "q_of_lines")


def rules():
    """(name, condition for bad, condition for good) of each rule; neither: it abstains."""
    words = F.greatest(F.col("q_n_words"), F.lit(1))
    mean, symbols = F.col("q_chars") / words, F.col("q_symbols") / words
    again, lines = F.col("q_repeat_words") / words, F.col("q_dup_lines") / F.greatest(F.col("q_n_lines"), F.lit(1))
    capitals = F.col("q_capitals") / F.greatest(F.col("q_letters"), F.lit(1))
    distinct, long = F.col("q_distinct") / words, F.col("q_n_words") >= 50
    return [
        ("length", F.col("q_n_words") < 20, F.col("q_n_words").between(50, 100_000)),
        ("word_length", (mean < 3) | (mean > 10), mean.between(4, 7)),
        ("symbols", symbols > 0.1, symbols <= 0.02),
        ("lines", (lines > 0.3) & (F.col("q_dup_lines") > 1), F.col("q_dup_lines") == 0),
        ("repeats", again > 0.2, F.col("q_repeat_words") == 0),
        ("capitals", (capitals > 0.5) & (F.col("q_letters") >= 50), capitals < 0.3),
        ("vocabulary", long & (distinct < 0.2), long & (distinct > 0.35)),
    ]


def _votes():
    return [F.when(bad, BAD).when(good, GOOD).cast("int").alias(f"v{i}") for i, (_, bad, good) in enumerate(rules())]


def _log_odds(votes, prior, weights):
    """Log odds for good of a text with these votes.

    Abstentions count only beside a bad vote: a text that no rule speaks
    against is not condemned for being of a kind that rules leave alone.
    """
    accused = BAD in votes
    return prior + sum(
        (w[vote] + (w["votes"] if accused else 0.0)) if vote is not None else (w[None] if accused else 0.0)
        for w, vote in zip(weights, votes)
    )


def _weights(good, bad):
    """Log odds for good of a rule's votes and abstentions, from its votes (bad, good, none) on good and on bad texts."""
    (gb, gg, ga), (bb, bg, ba) = good, bad
    (pb, pg), (qb, qg) = BELIEF[GOOD], BELIEF[BAD]
    false, caught = (gb + pb) / (gb + gg + pb + pg), (bb + qb) / (bb + bg + qb + qg)
    if caught < false:  # worse than chance: no better than chance
        false = caught = (gb + bb + pb + qb) / (gb + gg + bb + bg + pb + pg + qb + qg)
    votes, none = ABSTAINING
    in_good, in_bad = ((b + g + votes) / (b + g + a + votes + none) for b, g, a in (good, bad))
    return {
        BAD: math.log(false / caught), GOOD: math.log((1 - false) / (1 - caught)),
        "votes": math.log(in_good / in_bad), None: math.log((1 - in_good) / (1 - in_bad)),
    }


def estimate(patterns, n_rules):
    """(share of good texts, per rule the log odds for good of its outcomes) by expectation maximisation.

    ``patterns`` are (votes, count) with votes GOOD, BAD or None; there are at
    most three to the power of the number of rules. Outcomes are GOOD, BAD,
    None (it abstains) and "votes" (it does not); see ``_log_odds``. Without
    patterns the beliefs are returned.
    """
    weights = [_weights((0, 0, 0), (0, 0, 0))] * n_rules
    share = TEXTS[GOOD] / (TEXTS[GOOD] + TEXTS[BAD])
    total = sum(count for _, count in patterns)
    for _ in range(ROUNDS):
        old = [share, *(x for w in weights for x in w.values())]
        prior, good = math.log(share / (1 - share)), 0.0
        tally = [{GOOD: [0.0] * 3, BAD: [0.0] * 3} for _ in range(n_rules)]
        for votes, count in patterns:
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, _log_odds(votes, prior, weights)))))
            good += p * count
            for t, vote in zip(tally, votes):
                at = 2 if vote is None else vote
                t[GOOD][at] += p * count
                t[BAD][at] += (1 - p) * count
        share = (good + TEXTS[GOOD]) / (total + TEXTS[GOOD] + TEXTS[BAD])
        weights = [_weights(t[GOOD], t[BAD]) for t in tally]
        new = [share, *(x for w in weights for x in w.values())]
        if max(abs(a - b) for a, b in zip(old, new)) < SETTLED:
            break
    return share, weights


def judge_quality(df, text="text", keep_at=0.5, with_text=True):
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, good_probability, kept.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text; word_chars counts their
    code points, n_symbols the characters ``[#*$%&|<>]``, n_dup_lines the lines
    (cut at ``\\n``) with a word that equal an earlier line, n_repeat_words the
    words in 8-word windows found twice or more in the text. base_failed: fewer
    than 20 words, or over 30 % of them repeated. good_probability is the
    posterior of the rules' votes; kept: not base_failed and at least ``keep_at``.

    The texts are read once: their statistics are kept in a table, with the
    columns of ``df`` (without ``text`` if ``with_text`` is false). Then vote
    patterns are counted, of which at most 3^7 reach the driver, and the verdict
    is one projection. NULL counts as an empty text and is not kept. No row is
    dropped; repeated rows get equal verdicts. Input columns named like a result column are replaced,
    all others pass unchanged whatever their names.
    """
    results = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
               "good_probability", "kept")
    n_rules = len(rules())
    names = [f"v{i}" for i in range(n_rules)]
    given = [c for c in df.columns if c.lower() not in results or c == text]
    # Under names of their own the given columns cannot clash with the statistics.
    own = {c: f"c{i}" for i, c in enumerate(given)}
    stats = with_statistics(df.select(*[df[f"`{c}`"].alias(own[c]) for c in given]), own[text])
    if not with_text:
        given.remove(text)
        stats = stats.drop(own[text])
    stats = Scratch(df.sparkSession, "quality").keep(stats, "statistics")
    failed = (F.col("q_n_words") < 20) | (100 * F.col("q_repeat_words") > 30 * F.col("q_n_words"))
    # The base rule decides alone about what it fails; the votes are about the rest.
    counted = stats.where(~failed).select(*_votes()).groupBy(*names).count().collect()
    good_share, weights = estimate([(tuple(r[n] for n in names), r["count"]) for r in counted], n_rules)
    votes = _votes()
    odds, silence = F.lit(math.log(good_share / (1 - good_share))), F.lit(0.0)
    for vote, weight in zip(votes, weights):
        odds = odds + F.when(vote == BAD, weight[BAD]).when(vote == GOOD, weight[GOOD]).otherwise(0.0)
        silence = silence + F.when(vote.isNull(), weight[None]).otherwise(weight["votes"])
    accused = F.array_contains(F.array_compact(F.array(*votes)), BAD)
    odds = odds + F.when(accused, silence).otherwise(0.0)
    probability = 1 / (1 + F.exp(-odds))
    return stats.select(
        *[F.col(own[c]).alias(c) for c in given],
        F.col("q_n_words").alias("n_words"), F.col("q_chars").alias("word_chars"),
        F.col("q_symbols").alias("n_symbols"), F.col("q_dup_lines").alias("n_dup_lines"),
        F.col("q_repeat_words").alias("n_repeat_words"), failed.alias("base_failed"),
        probability.alias("good_probability"), (~failed & (probability >= keep_at)).alias("kept"),
    )
