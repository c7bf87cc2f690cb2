"""Every operator against plain loops, on whole small tables and odd texts."""

import itertools
import math
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from creditloom.llm import (
    chat, decontaminate, forest, packing, pages, quality, repeats, token_files, tokens, unigram, urls,
)
from creditloom.llm.components import components
from creditloom.llm.scratch import Scratch
from fixtures import DOCS, documents, odd_documents, prose

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark)


@pytest.fixture(scope="module")
def rows(docs):
    return [tuple(r) for r in docs.collect()]


def clashing(df, *names):
    """``df`` with more columns, some named like those an operator makes."""
    return df.withColumns({n: F.lit("x") for n in names})


# Quality rules

def test_statistics(docs, rows):
    got = {r.doc_id: r for r in quality.judge_quality(clashing(docs, "kept", "q_words", "other")).collect()}
    for doc, text in rows:
        r = got[doc]
        assert brute.text_statistics(text) == (
            r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed
        ), doc
        assert r.other == "x" and not (r.base_failed and r.kept)


def test_posterior_tells_junk_from_prose(spark):
    junk = [(i, " ".join(w + "%%%" for w in prose(i, 60).split())) for i in range(10)]
    clean = [(i, prose(i, 60) + ".") for i in range(10, 100)]
    kept = {r.doc_id: r.kept for r in quality.judge_quality(spark.createDataFrame(junk + clean, DOCS)).collect()}
    assert kept == {i: i >= 10 for i in range(100)}


def test_estimate_follows_expectation_maximisation():
    patterns = [((1, 1, None), 90.0), ((0, 1, 1), 6.0), ((0, 0, 1), 4.0)]
    share, weights = quality.estimate(patterns, 3)
    assert 0.5 < share < 1 and all(w[quality.BAD] < 0 < w[quality.GOOD] for w in weights)


def planted(share, false, caught, abstains):
    """Exact counts of the vote patterns of 20,000 texts, from what each rule does on good and on bad texts."""
    counts = []
    for votes in itertools.product((quality.GOOD, quality.BAD, None), repeat=len(false)):
        count = 0.0
        for part, chances in ((share, false), (1 - share, caught)):
            for vote, c in zip(votes, chances):
                part *= abstains if vote is None else (1 - abstains) * (c if vote == quality.BAD else 1 - c)
            count += part
        counts.append((votes, 20_000 * count))
    return counts


@pytest.mark.parametrize("share, false, caught", [
    (0.8, [0.02, 0.05, 0.1, 0.3], [0.8, 0.6, 0.7, 0.3]),
    (0.7, [0.15, 0.05, 0.1, 0.2], [0.8, 0.6, 0.7, 0.9]),
])
def test_planted_accuracies_are_recovered(share, false, caught):
    found, weights = quality.estimate(planted(share, false, caught, 0.1), len(false))
    assert abs(found - share) < 0.01
    for weight, f, c in zip(weights, false, caught):
        assert abs(weight[quality.BAD] - math.log(f / c)) < 0.05
        assert abs(weight[quality.GOOD] - math.log((1 - f) / (1 - c))) < 0.05


def test_a_rule_at_chance_has_no_say():
    """With two informative rules only, votes do not settle the share to the point; it must come out near it."""
    found, weights = quality.estimate(planted(0.9, [0.02, 0.02, 0.3], [0.8, 0.8, 0.3], 0.1), 3)
    assert abs(found - 0.9) < 0.06 and abs(weights[2][quality.BAD]) < 0.01 > abs(weights[2][quality.GOOD])
    assert all(w[quality.BAD] < -3 for w in weights[:2])


def test_texts_that_no_rule_speaks_against_are_good():
    patterns = [((1,) * 7, 7830), ((None, 1, 1, 1, 1, 1, None), 1630), ((1, 1, 1, None, None, 1, 1), 295),
                ((1, None, 0, 1, 1, 1, 1), 90), ((1, 1, 1, 0, 0, 1, 0), 20)]
    share, weights = quality.estimate(patterns, 7)
    good = [quality._log_odds(votes, math.log(share / (1 - share)), weights) > 0 for votes, _ in patterns]
    assert good == [True, True, True, False, False]


def test_quality_columns_of_the_input_stay(spark):
    df = spark.createDataFrame([(1, prose(1, 60), "a", 2, "b")], "doc_id bigint, text string, q_source string, v0 int, c1 string")
    out = quality.judge_quality(df)
    assert tuple(out.select("q_source", "v0", "c1", "kept").first()) == ("a", 2, "b", True)
    assert "text" not in quality.judge_quality(df, with_text=False).columns


def test_clean_texts_alone_are_kept(spark):
    out = quality.judge_quality(spark.createDataFrame([(i, prose(i, 60)) for i in range(20)], DOCS))
    assert out.where("kept").count() == 20


# Near-duplicates

@pytest.mark.parametrize("shingle", [4, 5])
def test_near_duplicates(docs, rows, shingle):
    got = {r.doc_id: r for r in forest.near_duplicates(clashing(docs, "node", "keys"), shingle).collect()}
    for doc, (size, component) in brute.near_duplicates(rows, shingle).items():
        r = got[doc]
        assert (r.n_shingles, r.component_id, r.kept) == (size, component, component == doc), doc


def test_crowded_region_of_near_copies(spark):
    """Many copies that differ in a few words, and many texts that only share half: no link lost, none invented."""
    base, half = prose(11, 200).split(), prose(12, 100)
    near = [(i, " ".join([*base[:i], f"w{i}", *base[i + 1:]])) for i in range(60)]
    shared = [(100 + i, half + " " + prose(200 + i, 100)) for i in range(60)]
    late = [(300 + i, half + " " + prose(200 + i, 100) + " end") for i in range(0, 60, 7)]
    data = near + shared + late
    got = {r.doc_id: r.component_id for r in forest.near_duplicates(spark.createDataFrame(data, DOCS), 4).collect()}
    assert got == {d: c for d, (_, c) in brute.near_duplicates(data, 4).items()}


def test_crowded_regions_are_searched_exactly(spark):
    """The exact way alone finds every link of a crowded region."""
    half = prose(12, 100)
    data = [(i, half + " " + prose(200 + i // 2, 60) + " end" * (i % 2)) for i in range(80)]
    df, scratch = spark.createDataFrame(data, DOCS), Scratch(spark, "test")
    signed = forest.signatures(df, 4, "doc_id", "text")
    nodes = signed.select(F.col("doc_id").alias("node"), "n_shingles", "keys", "sketch", F.col("doc_id").alias("component"))
    links = forest.crowded_links(scratch.keep(nodes, "nodes"), df, 4, "doc_id", "text", 80, scratch)
    assert {tuple(r) for r in links.select("a", "b").collect()} == {(i, i + 1) for i in range(0, 80, 2)}


def star_family(n, n_words, changed):
    """A text and ``n`` copies with ``changed`` scattered words replaced: each similar to the text, but not to other copies."""
    base, gap = prose(21, n_words).split(), n_words // changed
    data = [(0, " ".join(base))]
    for i in range(1, n + 1):
        r, copy = np.random.Generator(np.random.PCG64(i)), list(base)
        for k in range(changed):
            copy[k * gap + int(r.integers(4, gap - 4))] = f"w{i}x{k}"
        data.append((i, " ".join(copy)))
    return data


def test_star_of_more_copies_than_neighbours(spark):
    """Copies that are linked with their original alone all find it."""
    data = star_family(1200, 250, 6)
    got = {r.doc_id: r.component_id for r in forest.near_duplicates(spark.createDataFrame(data, DOCS), 4).collect()}
    assert got == {d: c for d, (_, c) in brute.near_duplicates(data, 4).items()} == dict.fromkeys(got, 0)


def test_candidates_of_a_crowded_region_grow_with_its_members(spark):
    """A row has one pair an order in a region that is searched exactly later; in a smaller region all pairs are there."""
    def pairs(n, name):
        df, scratch = spark.createDataFrame(star_family(n, 250, 6), DOCS), Scratch(spark, name)
        nodes = forest.signatures(df, 4, "doc_id", "text").select(
            F.col("doc_id").alias("node"), "n_shingles", "keys", "sketch", F.col("doc_id").alias("component"))
        found = forest.candidates(scratch.keep(nodes, "nodes"), forest.ORDERS, 8, 80, scratch, "trial")
        return {tuple(r) for r in found.select("a", "b").collect()}

    assert 300 <= len(pairs(300, "crowded")) <= forest.ORDERS * 301
    assert pairs(6, "small") == set(itertools.combinations(range(7), 2))


def test_near_duplicates_of_null_and_repeated_ids(spark):
    text = prose(3, 50)
    data = [(None, text), (None, text), (4, text), (4, prose(4, 50)), (9, prose(4, 50)), (7, text)]
    got = sorted(forest.near_duplicates(spark.createDataFrame(data, DOCS)).select(
        "doc_id", "component_id", "kept").collect(), key=str)
    assert [tuple(r) for r in got] == sorted(
        [(None, None, True)] * 2 + [(4, 4, True)] * 2 + [(9, 4, False), (7, 4, False)], key=lambda r: f"Row(doc_id={r[0]}")


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 400)] + [(7, j) for j in range(500, 600)] + [(1, 2), (2, 1), (3, 3)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    got = {r.node: r.component for r in components(df, Scratch(spark, "test")).collect()}
    assert got == {**{i: 100 for i in range(100, 401)}, **{j: 7 for j in [7, *range(500, 600)]}, 1: 1, 2: 1}


# Repeated passages

@pytest.mark.parametrize("length, parts", [(20, 1), (20, 5), (50, 3), (7, 2)])
def test_repeated_passages(docs, rows, length, parts):
    df = clashing(docs.repartition(parts), "n_words", "chunk", "rows")
    got = {r.doc_id: r for r in repeats.dedup_substrings(df, length).collect()}
    for doc, (n_words, n_removed, kept) in brute.repeated_passages(rows, length).items():
        r = got[doc]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n_words, n_removed, brute.sha(" ".join(kept))), doc
        assert brute.words(r.text) == kept and r.chunk == "x"
    assert got[1].text is None and got[3].text == " \n\t\x0b "


def test_passages_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 400)
    monkeypatch.setattr(repeats, "RANGE_HASHES", 50)
    data = [(i, f"{prose(i, 30)} {prose(99, 40)} {prose(500 + i // 3, 30)}") for i in range(40)]
    got = {r.doc_id: r for r in repeats.dedup_substrings(spark.createDataFrame(data, DOCS).repartition(3)).collect()}
    for doc, (_, n_removed, kept) in brute.repeated_passages(data, 20).items():
        assert (got[doc].n_removed, got[doc].kept_sha256) == (n_removed, brute.sha(" ".join(kept)))


def test_passages_with_null_and_equal_ids(spark):
    text = prose(1, 40)
    out = repeats.dedup_substrings(spark.createDataFrame([(None, text), (3, text), (3, text)], DOCS)).collect()
    assert sorted((r.doc_id is None, r.n_removed) for r in out) == [(False, 0), (False, 40), (True, 40)]


def test_passages_keep_a_row_per_document(spark, monkeypatch):
    """No row holds a whole chunk, however much text it has, and no task a batch of several chunks."""
    kept, keep = [], Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, *args: kept.append(keep(self, df, *args)) or kept[-1])
    data = [(i, prose(i // 2, 60)) for i in range(6)]
    out = repeats.dedup_substrings(spark.createDataFrame(data, DOCS).coalesce(1))
    assert kept[0].count() == len(data) and "array<" not in kept[0].schema.simpleString()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan


def test_passages_of_a_chunk_that_is_read_in_parts():
    batches = [pa.RecordBatch.from_pydict({"chunk": c, "text": t}) for c, t in (
        ([4, 4], ["a", None]), ([4, 5], ["b", "c"]), ([], []), ([5, 4], ["d", "e"]))]
    batches[2] = batches[0].slice(0, 0)
    runs = [(n, t.to_pylist()) for n, t in repeats._runs(batches, "chunk", "text")]
    assert runs == [(4, ["a", None, "b"]), (5, ["c", "d"]), (4, ["e"])]


@pytest.mark.parametrize("values", [[5], [0, 1, 2**63], list(range(0, 2**40, 2**33)), [2**64 - 1]])
def test_packed_hashes(values):
    assert repeats.unpack(repeats.pack(np.array(values, np.uint64))).tolist() == values


# Decontamination

def test_overlaps(spark, docs, rows):
    table = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    items = table + [(900, None), (901, ""), (902, "two words"), (903, prose(1, 60)), (904, prose(1, 60)),
                     (None, prose(6, 30)), (905, "Again again AGAIN again"), (906, prose(6, 12)), (903, prose(5, 20))]
    benchmark = clashing(spark.createDataFrame(items, "item_id bigint, text string"), "key_a", "print")
    got = {r.doc_id: r for r in decontaminate.find_overlaps(clashing(docs, "key_a", "n_hit", "set"), benchmark).collect()}
    for doc, (n_words, n_hit, found) in brute.overlaps(rows, items).items():
        r = got[doc]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n_words, n_hit, len(found), brute.sha(",".join(found))), doc
        assert r.contaminated == (n_hit > 0 and 20 * n_hit >= n_words) and r.key_a == "x"


def test_overlaps_by_shuffle_joins(spark, docs, rows, monkeypatch):
    import creditloom.llm.scratch as s

    monkeypatch.setattr(s, "BROADCAST_ROWS", 0)
    items = [(1, prose(1, 60))]
    out = decontaminate.find_overlaps(docs, spark.createDataFrame(items, "item_id bigint, text string"))
    assert {r.doc_id: r.n_hit for r in out.collect()} == {d: h for d, (_, h, _) in brute.overlaps(rows, items).items()}


def test_overlaps_without_items_or_with_equal_rows(spark):
    df = spark.createDataFrame([(None, "a b c"), (2, "a b c"), (2, "a b c")], DOCS)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert {r.n_hit for r in decontaminate.find_overlaps(df, none).collect()} == {0}
    out = decontaminate.find_overlaps(df, spark.createDataFrame([(1, "b c")], "item_id bigint, text string")).collect()
    assert [(r.n_hit, r.n_items) for r in out] == [(2, 1)] * 3


# Chat

def test_chat_round_trip(spark):
    hard = ["", "plain", chat.START, chat.END + "\n", "<||im_end|>", "<|" * 3 + "im_end|>", chat.ESCAPED_FLAG, "a\nb<|im_end|",
            "\\n<|im_start|>\n\\", "<|im_end||>", "é" + chat.END]
    for role in ["user", "assistant", *hard]:
        for text in hard:
            shown = chat.render_turn(role, text)
            assert [t[:2] for t in chat.parse(shown * 2)] == [(role, text)] * 2
    data = [(i, t, "assistant" if t % 2 else "user", hard[(i + t) % len(hard)]) for i in range(8) for t in range(i + 1)]
    data += [(50, None, None, None), (50, 1, "assistant", None), (None, 1, "assistant", "no id"), (51, 0, "user", "x"), (51, 0, "user", "x")]
    df = clashing(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"), "rendered", "loss")
    got = {r.conv_id: r for r in chat.digest_formatted(chat.format_turns(df.repartition(3))).collect()}
    for conv in {d[0] for d in data}:
        turns = sorted((d for d in data if d[0] == conv), key=lambda d: (d[1] is not None, d[1] or 0))
        said = "".join(d[3] or "" for d in turns if d[2] == "assistant")
        r = got[conv]
        assert r.turns_sha256 == brute.sha("".join(f"{d[2] or ''}\n{d[3] or ''}\n" for d in turns))
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns), len(said), brute.sha(said))


def test_a_broken_rendering_is_refused():
    for text in ["x", "<|im_start|>user", "<|im_start|>user\nhello", "<|im_start|>u\na<|im_start|>b<|im_end|>\n"]:
        with pytest.raises(ValueError):
            chat.parse(text)


# Pages

@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<html><body></body></html>", ""),
    ("<body><nav><a href=/>Home</a></nav><article><h1>A &amp; b</h1><p>One\n two.<br>three<p>Four, five.</article><footer>c</footer>",
     "A & b\nOne two. three\nFour, five."),
    ("<article><p>Text of the story, in full.</p><script>var a='<p>no</p>'</script><ul><li>first</li><li>second</li></ul>"
     "<aside>More stories</aside></article><div class='comment-list'><p>I think that this is a very long comment, really.</p></div>",
     "Text of the story, in full.\nfirst\nsecond"),
    ("<div class=cookie-notice><p>We use cookies on this site, as everybody does nowadays.</p></div><div id=content>"
     "<p>The first paragraph of the page has quite a number of words in it, and it ends.</p><p>Short one.</p></div>"
     "<div class='sidebar'><p>Popular: ten things that you did not know about these things.</p></div>",
     "The first paragraph of the page has quite a number of words in it, and it ends.\nShort one."),
    ("<header><h1>Site</h1></header><main><header><h1>Title</h1></header><p>Body text &lt;here&gt;.</p><form><p>Your name</p></form></main>",
     "Title\nBody text <here>."),
    ("<article><p>unclosed <b>bold", "unclosed bold"), ("<p>a < b and <3 c", ""),
])
def test_main_text(html, text):
    found = pages.main_text(html)
    assert found == text or text == "" and html and html.startswith("<p>a <")


@pytest.mark.parametrize("html, text", [
    ("<article><p>Here <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.<p>End.</article>", "Here x=2 holds.\nEnd."),
    ("<article><p>See <object data=a.pdf>the text of the plan</object> first.</article>", "See the text of the plan first."),
    ("<article><p>A <svg><path d='M0'/><text>label</text></svg> b, <video src=c>a film</video>.</article>", "A label b, a film."),
    ("<article><p>Before it.<svg viewBox='0'><p>After it.</article>", "Before it.\nAfter it."),
    ("<article><p>Before it.<iframe src=a><p>After it.</article>", "Before it.\nAfter it."),
    ("<article><p>Pick one.</p><select><option>red<option>blue</select><p>Done now.</article>", "Pick one.\nDone now."),
])
def test_only_scripts_and_controls_are_skipped(html, text):
    assert pages.main_text(html) == text


def test_minimum_cut_against_all_cuts():
    import itertools
    import random

    r = random.Random(5)
    for _ in range(60):
        n = r.randint(1, 7)
        lean = [r.choice([-2.0, -0.5, 0.0, 0.7, 1.5]) for _ in range(n)]
        edges = [(i, j, r.choice([0.3, 1.0])) for i in range(n) for j in range(i) if r.random() < 0.5]

        def cost(kept):
            return sum(x for x, k in zip(lean, kept) if x > 0 and not k) - sum(x for x, k in zip(lean, kept) if x < 0 and k) + sum(
                c for i, j, c in edges if kept[i] != kept[j])

        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert abs(cost(pages.minimum_cut(lean, edges)) - best) < 1e-6


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<a" * 500_000, "<a \"'" * 200_000, "<a '" * 200_000 + '"', "</b>" * 200_000, "<" * 1_000_000,
    "<div>" * 100_000 + "</x>" * 100_000, "<b>" * 50_000 + "<div>" * 50_000 + "</b>" * 50_000, "<li><b>x" * 20_000,
])
def test_broken_pages_take_time_in_proportion(page):
    import time
    began = time.process_time()
    pages.blocks_of(page)
    assert time.process_time() - began < 6


def test_a_sign_without_a_tag_is_text():
    assert pages.main_text("<article><p>When a < b and c <d the rest, however long it may be, stays.</article") == (
        "When a < b and c <d the rest, however long it may be, stays.</article")
    assert pages.main_text('<article><p title="a > b">One sentence of an article.</p></article>') == "One sentence of an article."


@pytest.mark.parametrize("name", ["legal-history", "related-work", "notice"])
def test_a_class_word_alone_does_not_decide_inside_an_article(name):
    text = "The law of the sea was first written down by merchants, who had to agree on what a lost cargo was worth to its owner."
    body = f"<p>{text}</p>"
    assert pages.main_text(f"<article>{body}<section class='{name}'>{body}</section></article>") == f"{text}\n{text}"
    assert pages.main_text(f"<article>{body}</article><div class='{name}'>{body}</div>") == text


def test_pages_keep_rows_and_columns(spark):
    data = [(1, "<article>a b</article>", "u"), (1, "<article>a b</article>", "u"), (None, None, None)]
    out = pages.extract_pages(clashing(spark.createDataFrame(data, "page_id long, html string, url string"), "text", "n_chars"))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == [(1, "u", "a b", 3)] * 2 + [(None, None, "", 0)]


# URLs

def test_url_rules(spark):
    data = ["http://a.com/x", "HTTP://A.B.COM:80/q?x://y", "com", None, "x://", "x://com", "x://com/", "http://net/es/", "http://q.net/es",
            "http://example.com/en/1#a", "http://www.example.com/en/", "http://m.www.example.com/en/z", "http://xexample.com/en/", "a://b.net/fr/?q"]
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
             ("net", "/fr/", "block"), ("com", "/q", "allow"), ("com", "/q", "block"), (None, "/", "block")]
    df = clashing(spark.createDataFrame([(u,) for u in data * 2], "url string"), "host", "short", "digest")
    got = [tuple(r) for r in urls.judge_urls(df, urls.rule_table(spark, rules)).select("url", "host", "path", "rule", "verdict").collect()]

    def expected(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host):])[0]
        host = host.translate(brute.LOWER)
        fit = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
               if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (url, host, path, *(max(fit)[3:] if fit else (None, "allow")))

    assert sorted(got, key=str) == sorted((expected(u) for u in data * 2), key=str)


def test_long_hosts_give_as_many_expressions_as_rules_have_shapes(spark):
    long = "https://" + "a." * 50_000 + "example.com/en/x"
    df = spark.createDataFrame([(long,), ("http://" + "b." * 50_000 + "com",)], "url string")
    table = urls.rule_table(spark, [("example.com", "/en/", "block"), ("net", "/", "block")])
    start = time.time()
    got = {r.url: (r.rule, r.verdict) for r in urls.judge_urls(df, table).collect()}
    assert got[long] == ("example.com/en/", "block") and len(got) == 2
    assert sum(rule is None for rule, _ in got.values()) == 1 and time.time() - start < 30


# Tokens

ODD_TEXTS = [t or "" for _, t in odd_documents()[:14]] + [
    "a\u00a0 b", "\u3000 x \u2028\n y ", "it's we'll 12,345<|endoftext|> foo", "\u00a0  ", "  \u00a0", "\u0928\u092e \u00e9 \u0301x", "<|startoftext|>hi"]


@pytest.mark.parametrize("path, with_space", [(BYTE, True), (WORD, False)])
def test_encoding_by_pieces_equals_encoding_whole(path, with_space):
    encoder, whole = tokens.Encoder(path, with_space), Tokenizer.from_file(path)
    for _ in range(2):
        ids, n = encoder.slice_ids(pa.array(ODD_TEXTS))
        for text, part in zip(ODD_TEXTS, np.split(ids, np.cumsum(n)[:-1])):
            assert part.tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_encoder_store_stays_small(monkeypatch):
    monkeypatch.setattr(tokens, "STORE_BYTES", 3000)
    encoder, whole = tokens.Encoder(WORD, False), Tokenizer.from_file(WORD)
    for seed in (1, 2, 3, 2, 1, 3):
        text = prose(seed, 200)
        assert encoder.slice_ids(pa.array([text]))[0].tolist() == whole.encode(text, add_special_tokens=False).ids
        # one generation may pass the bound by the pieces of one slice
        assert encoder.young.nbytes() < 3000 + 200 * 60 and encoder.old.nbytes() < 3000 + 200 * 60


def test_stored_pieces_are_not_encoded_again(monkeypatch):
    encoder = tokens.Encoder(BYTE, True)
    text = pa.array([prose(1, 500)])
    first = encoder.slice_ids(text)[0].tolist()
    encode, sizes = encoder._encode, []
    monkeypatch.setattr(encoder, "_encode", lambda data, n: sizes.append(len(n)) or encode(data, n))
    assert encoder.slice_ids(text)[0].tolist() == first and sizes == [0]


def test_pieces_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(tokens, "span_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    encoder, whole = tokens.Encoder(WORD, False), Tokenizer.from_file(WORD)
    for seed in (1, 2, 1):
        text = prose(seed, 200)
        assert encoder.slice_ids(pa.array([text]))[0].tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 5, 4096, 9000])
@pytest.mark.parametrize("top", [1, 2, 200, 60_000, 2**32 - 1])
def test_blocks_round_trip(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
    ids[rng.random(n) < 0.03] = top
    starts, blocks = token_files.encode_ids(ids)
    assert (token_files.decode_ids(starts.tolist(), blocks) == ids).all()


def test_outliers_are_patched():
    ids = np.full(4096, 1000, np.uint32)
    ids[7] = 2**31
    assert len(token_files.encode_block(ids)) < 100


def test_token_files(docs, rows):
    got = {r.doc_id: tuple(r)[1:] for r in token_files.encode_documents(clashing(docs.repartition(4), "shard"), WORD, 2).collect()}
    whole, start = Tokenizer.from_file(WORD), 0
    for doc, text in sorted(rows, key=lambda r: r[0]):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert got[doc] == (start, len(ids), zlib.crc32(ids.tobytes())), doc
        start += len(ids)


def test_token_counts(docs, rows):
    model = unigram.UnigramVocabulary.load(PIECE)

    def best(word):
        score = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            ways = [(score[i][0] + model.score[word[i:end]], -score[i][1] - 1) for i in range(end) if word[i:end] in model.score]
            if word[end - 1] not in model.score:
                n = len(word[end - 1].encode())
                ways.append((score[end - 1][0] + n * model.byte, -score[end - 1][1] - n))
            s, n = max(ways)
            score.append((s, -n))
        return score[-1][1]

    got = {r.doc_id: tuple(r)[1:] for r in unigram.count_tokens(clashing(docs, "n_tokens"), PIECE).collect()}
    for doc, text in rows:
        w = brute.words(text)
        if doc in range(-5, 1040) and doc not in (14, 15):
            assert got[doc] == (len(w), sum(best("\u2581" + x) for x in w)), doc


# Packing

def check_packing(out, texts, capacity):
    whole, places = Tokenizer.from_file(BYTE), {}
    for doc, text in texts:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for k, r in enumerate(sorted((r for r in out if r.doc_id == doc), key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == capacity)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for r in out:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), -(-sum(r.length for r in out) // capacity)


def test_packing(docs, rows):
    out = packing.pack_documents(clashing(docs, "row", "group"), BYTE).collect()
    used, least = check_packing(out, rows, 2048)
    assert used <= least + 1
    out = packing.pack_documents(docs, BYTE, group_items=40).collect()
    check_packing(out, rows, 2048)


def test_local_search_empties_bins():
    # Best fit decreasing needs 4 bins for these; three hold them exactly.
    sizes, capacity = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6], 60
    bins = {}
    for size, (b, at) in zip(sizes, packing.pack_group(sizes, capacity)):
        bins.setdefault(b, []).append((at, size))
    assert len(bins) == 3
    rng = np.random.default_rng(3)
    sizes = rng.integers(500, 1100, 3000).tolist()
    without = len({b for b, _ in packing.pack_group(sizes, 2048, steps=0)})
    with_search = len({b for b, _ in packing.pack_group(sizes, 2048)})
    assert -(-sum(sizes) // 2048) <= with_search <= without


# All

@pytest.mark.parametrize("run", [
    lambda d: quality.judge_quality(d), lambda d: forest.near_duplicates(d), lambda d: repeats.dedup_substrings(d),
    lambda d: token_files.encode_documents(d, WORD, 2), lambda d: packing.pack_documents(d, BYTE), lambda d: unigram.count_tokens(d, PIECE),
    lambda d: pages.extract_pages(d, "text"),
    lambda d: decontaminate.find_overlaps(d, d.withColumnRenamed("doc_id", "item_id")),
    lambda d: urls.judge_urls(d, urls.rule_table(d.sparkSession, [("com", "/", "block")]), "text"),
    lambda d: chat.digest_formatted(chat.format_turns(d, "doc_id", "doc_id", "text", "text")),
], ids="quality forest repeats files packing unigram pages overlaps urls chat".split())
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], DOCS)).count() == 0
