"""The operators for training data on small frames, beside brute force."""

import hashlib
import json
import os
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import regex
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from hirelens.llm import (
    common, components, guess_cost, licenses, merge_counts, page_wrappers, pairwise_quality, queries, repetition, sentence_pieces,
    simhash_gph, source_divergence, spaced_seeds, suffix_blocks, token_links, trie_bpe, word_bpe,
)
from hirelens.llm.common import table, written
from tests.compare import database, rows_of

SF = "/root/testdata/sf0.001"
PROSE = "the quick brown fox jumps over the lazy dog and then it runs far away from the big bad wolf who sleeps under a tree near"


def odd_texts():
    long = " ".join(f"word{k % 997} Élan_{k}" for k in range(30_000))
    return [None, "", " \n\t ", "a", PROSE, PROSE, PROSE + " now", "=" * 3000, "ΣΑΣ İ ½ <|endoftext|>x \x1c é", "x́ y", long, long + "!"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long, equal and repeated texts, with columns that clash with the results' names."""
    rows = [(k, t, "s", "en", "clash", "clash") for k, t in enumerate(odd_texts())] + [(None, PROSE, None, None, None, None)]
    rows.append(rows[4])
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, Kept string, spans string")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def brute_links(nodes, near):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for k, a in enumerate(nodes):
        for b in nodes[k + 1 :]:
            if near(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


# --- 1 --------------------------------------------------------------------------------------


def test_quality_ranks_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op1_pairwise_quality(spark, sf).join(table(spark, sf, "labels"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95


def test_the_training_sample_is_bounded_and_the_same_each_time(spark):
    docs = spark.createDataFrame([(k % 5, f"text {k} with words") for k in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(5)] + [(2, 1, 0)], "doc_id long, quality int, toxic int")
    x, y = pairwise_quality.training_sample(docs, labels, rows=10)
    again = pairwise_quality.training_sample(docs.repartition(7), labels.repartition(3), rows=10)
    assert len(x) == len(y) == 10 and (x == again[0]).all() and (y == again[1]).all()
    assert len(pairwise_quality.training_sample(docs, labels.where("doc_id = 2"), rows=10)[0]) == 0  # labels contradict


def test_quality_of_odd_texts_and_without_labels(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = pairwise_quality.scores(odd, none).collect()
    assert len(rows) == 14 and all(0 <= r.score <= 1 for r in rows)
    assert pairwise_quality.scores(empty, none).count() == 0
    assert np.isfinite(pairwise_quality.features(pa.array(["", "a", "\n"]))).all()


# --- 2 --------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a>Home</a></li>{more}</ul></nav>
<div class="ad">Buy &amp; go</div><article><h1>{h}</h1><p>One &lt;two&gt;&nbsp; {a}<br>three</p><p><b>open<p>next</article>
<section id="comments"><p>first!</p></section><footer>&copy;</footer></body></html>"""


def test_wrappers_find_slots_options_and_repeats():
    pages = [PAGE.format(h=h, a=a, more=m) for h, a, m in (("x", "y", ""), ("x", "z", "<li><a>B</a></li>"))]
    items = [page_wrappers.items_of(page_wrappers.parse(p)) for p in pages]
    merged = page_wrappers.align(*items)
    text = json.dumps(merged)
    assert '"li", 2' in text and '["h1", 0, [["#", 0, "x1"]]]' in text
    assert page_wrappers.align(merged, items[1]) == merged
    group = page_wrappers.items_of(page_wrappers.parse("<h2>a</h2><p>b</p><h2>c</h2>"))
    assert group == [["(", 2, [["h2", 1, [["#", 0, None]]], ["p", 1, [["#", 0, "b1"]]]]]]


def test_extraction(spark):
    rows = [(1, "http://h/1", PAGE.format(h="x", a="y", more="")), (2, "http://h/2", PAGE.format(h="q", a="w", more="<li>2</li>")),
            (3, "bad url", "<p>plain  text"), (4, None, None), (5, "http://h/3", ""), (6, "http://e/", "<div>" * 3000 + "deep"), (3, "bad url", "<p>plain  text")]
    got = page_wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == 7 and all(r.n_chars == len(r.text) for r in got)
    assert texts == {1: "x\nOne <two> y three\nopen\nnext", 2: "q\nOne <two> w three\nopen\nnext", 3: "plain text", 4: "", 5: "", 6: "deep"}
    assert page_wrappers.extract(spark.createDataFrame([], "page_id long, url string, html string, text int")).count() == 0


def test_copies_and_like_openings_are_no_constants(spark):
    long = "On this day the council met in the great hall of the town and spoke of matter "
    pages = {"copies": ["<p>one</p><div>two</div>"] * 4, "like": [f"<div>{long}{k}</div>" for k in "abc"],
             "site": [f"<p>Welcome</p><div>text {k}</div>" for k in "abc"]}
    rows = [(f"{h}{k}", f"http://{h}/{k}", t) for h, texts in pages.items() for k, t in enumerate(texts)]
    got = {r.page_id: r.text for r in page_wrappers.extract(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()}
    assert [got[f"copies{k}"] for k in range(4)] == ["one\ntwo"] * 4
    assert [got[f"like{k}"] for k in range(3)] == [long + k for k in "abc"]
    assert [got[f"site{k}"] for k in range(3)] == [f"text {k}" for k in "abc"]


def test_closed_tags_beyond_the_depth_leave_the_article_open():
    deep = "<div><article>" + "<div>" * 150 + "<p>in</p>" + "</div>" * 150 + "<p>after</p></article></div><p>rest</p>"
    assert page_wrappers.main_text(deep, json.dumps({"items": [], "pages": []})) == "in\nafter"


def plain_site(k, extra=""):
    """A page without article, main or telling names, and its main text."""
    story = [f"Report {k} of the harbour", f"The ships of day {k} came in late because of the wind. {PROSE}", "Weather as usual.", f"In all {k + 3} boats were counted &amp; listed."]
    page = (f"<html><head><title>x</title></head><body><div class=k1><ul><li><a href=/>Home</a><li><a href=/b>About us</a></ul></div>"
            f"<div class=k2><div class=k3><h1>{story[0]}</h1><p>{story[1]}</p><div class=k7>{story[2]}</div><p>{story[3]}</p>{extra}</div>"
            f"<div class=k4><ul><li><a href=/{k}>See number {k * 7} too</a><li><a href=/y>And {k * 11} there</a></ul></div></div>"
            f"<div class=k5><p>Printed by the town press.</p><p>Page made on day {k}</p></div></body></html>")  # fmt: skip
    return page, "\n".join(story).replace("&amp;", "&")


def test_the_wrapper_finds_the_main_part_without_telling_names(spark):
    for count in (2, 3, 8):
        made = [plain_site(k) for k in range(count)]
        rows = [(k, f"http://plain/{k}", page) for k, (page, _) in enumerate(made)]
        got = {r.page_id: r.text for r in page_wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        assert got == {k: text for k, (_, text) in enumerate(made)}
    empty = json.dumps({"items": [], "pages": []})
    assert all(page_wrappers.main_text(page, empty) != text for page, text in made)


def test_the_part_decides_over_names_and_keeps_headings():
    def known(pages):
        kept = {}
        for page in pages:
            tree = page_wrappers.parse(page)
            page_wrappers._combine(kept, "h", page_wrappers.items_of(tree), [page], page_wrappers.slots_of(tree))
        return page_wrappers._rows(kept).column(1)[0].as_py()

    pages = [f"<div id=story>Top story {k}</div><div id=q><p>{PROSE} {k}</p><p>{k} more of it</p></div>" for k in range(3)]
    assert page_wrappers.main_text(pages[1], known(pages)) == f"{PROSE} 1\n1 more of it"
    # A headline beside the part belongs to the text.
    pages = [f"<div id=w><h1>Head {k}</h1><div id=q><p>{PROSE} {k}</p><p>{k} more</p></div></div>" for k in range(3)]
    assert page_wrappers.main_text(pages[2], known(pages)) == f"Head 2\n{PROSE} 2\n2 more"
    # Nearly equal pages keep what they share.
    pages = [f"<div id=w><p>{PROSE}</p><p>{PROSE} {k}</p></div>" for k in range(2)]
    assert page_wrappers.main_text(pages[0], known(pages)) == f"{PROSE}\n{PROSE} 0"


def test_roles_and_blocks_hold_at_any_depth():
    empty = json.dumps({"items": [], "pages": []})
    for depth in (3, 99, 100, 101, 102, 500):
        inner = "<nav><ul><li>Home</li></ul></nav><p>one</p><p>two<div class=comments><p>first!</p></div><footer>f</footer><p>three"
        page = "<article>" + "<div>" * depth + inner + "</div>" * depth + "<p>four</article><p>rest"
        assert page_wrappers.main_text(page, empty) == "one\ntwo\nthree\nfour"
        page = "<div>" * depth + "<p>menu</p><article><p>in</p></article><p>x</p>" + "</div>" * depth
        assert page_wrappers.main_text(page, empty) == "in"


def test_extraction_equals_the_articles(spark):
    import html

    for r in queries.op2_page_wrappers(spark, SF).join(table(spark, SF, "pages").select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"<p>|</p>|</?h1>|<br>", article))
        assert r.text == "\n".join(b for b in blocks if b)


# --- 3 --------------------------------------------------------------------------------------


def test_overlaps_tolerate_substitutions(spark):
    words = [f"w{k}" for k in range(40)]
    changed = [w if k % 9 else "other" for k, w in enumerate(words)]
    tests = spark.createDataFrame([(1, " ".join(words)), (2, "short item here"), (3, None), (4, "")], "item_id long, text string")
    rows = [(1, "Before! " + ", ".join(changed).upper() + " after"), (2, "a SHORT item, here"), (3, "short item there"), (4, " ".join(words[:12])),
            (5, None), (6, ""), (7, " ".join(words[10:30])), (7, " ".join(words[10:30]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc, r.item): (r.matched, r.start) for r in spaced_seeds.overlaps(docs, tests).collect()}
    assert found == {(1, 1): (35, 2), (2, 2): (3, 1), (7, 1): (20, 0)}
    assert sorted(r.doc_id for r in spaced_seeds.decontaminate(docs, tests).collect()) == [3, 4, 5, 6]
    marked = spark.createDataFrame([(None, rows[0][1]), (9, rows[0][1]), (9, "clean text"), (None, "clean too")], docs.schema)
    assert sorted(r.text for r in spaced_seeds.decontaminate(marked, tests).collect()) == ["clean text", "clean too"]
    assert spaced_seeds.overlaps(docs, tests.where("false")).count() == 0
    assert spaced_seeds.overlaps(docs.where("false"), tests).count() == 0


def test_short_items_are_found_wherever_words_are_substituted(spark):
    """Every way to substitute as many words as allowed in items of 8 to 16 words, with other words around."""
    items = [[f"i{n}w{k}" for k in range(n)] for n in range(8, 17)]
    rows, want = [], set()
    for item in items:
        n = len(item)
        for gone in (1, n - spaced_seeds.needed(n), n - spaced_seeds.needed(n) + 1):
            for at in combinations(range(n), gone):
                text = ["before", "it", *(f"x{k}" if k in at else w for k, w in enumerate(item)), "after"]
                if n - gone >= spaced_seeds.needed(n):
                    want.add((len(rows), n))
                rows.append((len(rows), " ".join(text)))
    tests = spark.createDataFrame([(len(i), " ".join(i)) for i in items], "item_id int, text string")
    found = spaced_seeds.overlaps(spark.createDataFrame(rows, "doc_id int, text string"), tests)
    assert {(r.doc, r.item) for r in found.collect()} == want


def test_every_stretch_of_a_diagonal_is_tried():
    run, longer = [1] * 12, [1] * 7 + [0] + [1] * 7
    same = np.array([*run, *[0] * 9, *longer], bool)
    assert spaced_seeds.best_match(same, 40) == (14, 21, 36)
    rng = np.random.default_rng(0)
    for _ in range(300):
        same = rng.random(rng.integers(1, 40)) < 0.7
        score = np.where(same, 1, -2)
        sums = np.append(0, np.cumsum(score))
        best = max((sums[b] - sums[a] for a in range(len(same)) for b in range(a + 1, len(same) + 1)), default=0)
        found = spaced_seeds.stretches(same)
        assert all(a[2] <= b[1] for a, b in zip(found, found[1:])) and sum(m for m, _, _ in found) == same.sum()
        assert not same.any() or max(sums[e] - sums[s] for _, s, e in found) == best


def test_a_text_of_one_repeated_word_is_searched(spark):
    docs = spark.createDataFrame([(1, "again " * 100_000), (2, "again and " * 10)], "doc_id int, text string")
    tests = spark.createDataFrame([(1, "again " * 20), (2, "again again")], "item_id int, text string")
    found = {(r.doc, r.item): (r.matched, r.start) for r in spaced_seeds.overlaps(docs, tests).collect()}
    assert found == {(1, 1): (20, 0), (1, 2): (2, 0)}


def test_overlaps_find_every_contained_item(spark, docs):
    con = database(SF)
    exact = set(con.execute("SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)").fetchall())
    found = {(r.doc_id, r.item_id) for r in spaced_seeds.pairs(docs, table(spark, SF, "benchmark")).collect()}
    assert exact <= found


# --- 4 --------------------------------------------------------------------------------------


def test_fingerprints_equal_spark_hashes(spark, odd):
    for r in simhash_gph.fingerprints(odd.select("doc_id", "text"), keep=["doc_id", "text"]).limit(9).collect():
        words = [w for w in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")) if w]
        shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        hashes = [spark.range(1).selectExpr(f"xxhash64(cast(unhex('{s.encode().hex()}') AS string)) h").first().h % 2**64 for s in shingles[:40]]
        if len(shingles) <= 40:
            bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0
            assert r.fp % 2**64 == bits


@pytest.mark.parametrize("tau,parts", [(3, None), (3, 2), (5, 3), (8, 5), (0, 1)])
def test_clusters_equal_brute_force(spark, tau, parts):
    rng = np.random.default_rng(tau)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (300, 4)).astype(np.uint64), axis=1)
    fps = np.unique(np.concatenate([base, base[rng.integers(0, 60, 300)] ^ flips])).view(np.int64).tolist()
    near = lambda a, b: bin((a ^ b) % 2**64).count("1") <= tau
    want = {n: r for n, r in brute_links(sorted(fps), near).items()}
    links = simhash_gph.linked(spark.createDataFrame([(f,) for f in fps], "fp long"), tau, parts)
    got = {n: n for n in fps} | {r.node: r.root for r in components.components(links).collect()}
    assert got == want


def test_buckets_in_pieces_and_trees():
    rng = np.random.default_rng(1)
    fp = np.unique(np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64) | np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64))
    a, b = simhash_gph.links_in_bucket(fp, 4)
    assert len(a) >= len(fp) - 1


def test_thresholds_add_up_and_cost_least():
    rng = np.random.default_rng(0)
    cost = np.concatenate([np.zeros((3, 1, 50)), np.cumsum(rng.random((3, 4, 50)), 1)], 1)
    chosen = simhash_gph.allocate(cost, 1)
    assert (chosen.sum(0) == 1).all()
    least = min(
        (sum(cost[i, t + 1, 0] for i, t in enumerate(ts)), ts)
        for ts in ((a, b, c) for a in range(-1, 4) for b in range(-1, 4) for c in range(-1, 4) if a + b + c == 1)
    )
    assert tuple(chosen[:, 0]) == least[1]


def test_large_buckets_are_cut_without_loss(spark):
    rows = spark.range(300).selectExpr("0 AS part", "7L AS value", "id AS fp")
    cut = simhash_gph.cut_large(rows, piece=50)
    together = {(a.fp, b.fp) for v in _by(cut.collect()).values() for a in v for b in v}
    assert len(together) == 300 * 300
    assert max(len(v) for v in _by(cut.collect()).values()) < 200


def _by(rows):
    out = {}
    for r in rows:
        out.setdefault((r.one, r.two), []).append(r)
    return out


def test_near_duplicates_of_odd_rows(spark, odd, empty):
    rows = simhash_gph.fingerprint_rows(odd).collect()
    assert len(rows) == 14
    assert {r.component_id for r in rows if r.doc_id in (0, 1, 2)} == {0}
    assert {r.component_id for r in rows if r.doc_id in (None, 4, 5)} == {4}
    assert simhash_gph.fingerprint_rows(empty).count() == 0
    kept = simhash_gph.keep_one(odd, **corpus_pipeline.NEAR)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {0, 3, 4, 7, 8} <= set(ids) and not {1, 2, 5, 11, None} & set(ids)


def test_one_row_of_each_component_stays(spark):
    """Ids may be null or shared by unlike texts; rows go by component, not by id."""
    far = [" ".join(f"{a}{k}" for k in range(40)) for a in "abc"]
    rows = [(1, far[0], "x"), (1, far[1], "y"), (2, far[0], "z"), (None, far[2], "n"), (None, far[2], "m"), (3, far[1], "x"), (1, far[0], "w"), (5, None, "q")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, note string")
    kept = simhash_gph.keep_one(frame, **corpus_pipeline.NEAR)
    got = sorted(((r.doc_id or 0), r.text or "") for r in kept.collect())
    assert got == sorted([(1, far[0]), (1, far[1]), (0, far[2]), (5, "")])
    assert kept.columns == frame.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, simhash_gph.keep_one(frame.repartition(5), **corpus_pipeline.NEAR).collect()))


# --- 5 --------------------------------------------------------------------------------------


def brute_repeats(docs):
    first, out = {}, []
    for i, text in sorted(docs):
        for k in range(len(text) - 49):
            first.setdefault(text[k : k + 50], i)
    for i, text in docs:
        gone = bytearray(len(text))
        for k in range(len(text) - 49):
            if first[text[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(text, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_repeats_equal_brute_force(spark, docs, odd, empty):
    texts = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    assert sorted(tuple(r) for r in suffix_blocks.digests(docs).collect()) == brute_repeats(texts)
    texts = [(2**62 if r.doc_id is None else r.doc_id, (r.text or "").encode()[:5000]) for r in odd.collect()]
    short = odd.selectExpr("doc_id", "cast(substr(encode(text, 'UTF-8'), 1, 5000) AS string) AS text")
    got = sorted((2**62 if r[0] is None else r[0], *r[1:]) for r in suffix_blocks.digests(short).collect())
    assert got == brute_repeats(texts)
    assert suffix_blocks.digests(empty).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text("ab", min_size=0, max_size=260), min_size=2, max_size=6), st.integers(1, 4))
def test_buckets_equal_brute_force(texts, unit):
    texts = [("ab" * unit + t) * 2 for t in texts]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    found = suffix_blocks.anchors(data, offsets)
    marked = suffix_blocks.resolve(found.hash, found.text, found.low, found.high, suffix_blocks.contexts(data, offsets, found))
    row, start, end = suffix_blocks.stretches(marked, found.place)
    gone = [bytearray(len(t)) for t in texts]
    for r, s, e in zip(row, start, end):
        gone[found.text[r]][s:e] = b"\1" * (e - s)
    want = brute_repeats([(k, t.encode()) for k, t in enumerate(texts)])
    assert [sum(g) for g in gone] == [w[2] for w in want]


def test_long_texts_are_cut_into_overlapping_pieces():
    data = np.random.default_rng(0).integers(0, 3, 3 * suffix_blocks.PIECE + 77).astype(np.uint8)
    found = suffix_blocks.anchors(data, np.array([0, len(data)]))
    starts = np.concatenate([np.arange(p - h, p - l + 1) for p, l, h in zip(found.place, found.low, found.high)])
    assert (np.unique(starts) == np.arange(len(data) - 49)).all()


# --- 6 --------------------------------------------------------------------------------------


def brute_spans(text):
    out = []
    for k, pattern in enumerate((guess_cost.ASSIGN.pattern, r"AKIA[A-Z0-9]+", r"[0-9a-f]+")):
        for m in re.finditer(pattern, text, (re.I if k == 0 else 0) | re.A):
            if (len(m[2]) >= 12) if k == 0 else len(m[0]) >= (18, 16)[k - 1]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["token", "Secret", "API_KEY", " ", ":", "=", '"', "'", "AKIA", "A1B2C3D4E5F6G7", "deadbeef", "01234567", "pwd", "é", "\n", "passwd"])))
def test_base_spans_equal_the_patterns(parts):
    text = "".join(parts)
    assert [s for s in guess_cost.scan_text(text) if s[1] < 3] == brute_spans(text)


def test_guess_cost_knows_cheap_segments():
    cost = guess_cost.guess_cost
    assert cost("") == 0 and cost("password") < 1
    for cheap in ("qwertyuiop", "2024-01-31", "aaaaaaaaaaaa", "abcdefgh123", "passwordpassword2020", "abcabcabcabc"):
        assert cost(cheap) < 6, cheap
    assert cost("Xk9#fQ2!zR") > 10
    assert cost("x" * 20_000) < 10


@pytest.mark.parametrize("text,value", [
    ('password: "Xk9#(fQ2!zR9dLm"', "Xk9#(fQ2!zR9dLm"), ("pwd='Qz7;x,K(2)v{9}' # old", "Qz7;x,K(2)v{9}"), ("password" + " " * 12 + "=  Xk9#fQ2!zR9dLm;", "Xk9#fQ2!zR9dLm"),
    ("api_id=Xk9#fQ2!zR9dLm", "Xk9#fQ2!zR9dLm"), ("Private-ID -> Xk9#f,Q2!(zR9dLm).", "Xk9#f,Q2!(zR9dLm"), ('token="Xk9#fQ2!zR9dLm', "Xk9#fQ2!zR9dLm"),
])
def test_values_are_read_whole(text, value):
    start = text.index(value)
    assert guess_cost.scan_text(text) == [(start, 3, start + len(value))]


def brute_words(texts, size):
    plain = [re.sub(guess_cost.VALUE_PLACES, " ", t.lower()) for t in texts]
    counts = Counter(w for t in plain for w in set(regex.findall(guess_cost.WORD, t)))
    least = min([n for n in counts.values() if sum(m >= n for m in counts.values()) <= size], default=0)
    return sorted((w for w, n in counts.items() if n >= least > 0), key=lambda w: (-counts[w], w))


def test_prose_and_references_are_no_secrets(spark):
    plain = [
        "The secret: chocolate", "login: administrator", "Passphrase: unbelievable story", "auth: /usr/local/share",
        "token: https://example.com/docs", "secret: $SECRET_FROM_VAULT", "api key: {{ vault.api_key }}", "pwd = ${DB_PASSWORD}", "access key -> <your-access-key>",
    ]
    strong = [
        "pwd: Xk9#fQ2!zR9dLm", "auth = /uZ8k+Q2x/Lp93", "token: https://me:Xk9fQ2zR9dLm@example.com", "login: wbxqzkvjhplt",
        "secret: $Qz7;x,K(2)v", "pwd: $Xk9fQ2zR9dLm", "login: <Xk9fQ2zR9dLm>", "auth: https://example.com/Zk93LsQpX2",
    ]
    prose = ["he ate chocolate while the administrator told an unbelievable thing"] * 3 + ["pwd: wbxqzkvjhplt"] * 50
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(plain + strong + prose)], "doc_id long, text string")
    assert "chocolate" in guess_cost.corpus_words(frame) and "wbxqzkvjhplt" not in guess_cost.corpus_words(frame)
    assert guess_cost.corpus_words(frame, size=1) == []
    for size in (12, 10_000):
        assert guess_cost.corpus_words(frame, size=size) == brute_words(plain + strong + prose, size)
    found = {r.doc_id: r.spans for r in guess_cost.digests(frame).collect()}
    assert [plain[k] for k in range(len(plain)) if found[k]] == []
    assert [t for k, t in enumerate(strong, len(plain)) if "guess:" not in found[k]] == []
    clean = {r.doc_id: r.text for r in guess_cost.redact(frame).collect()}
    assert [clean[k] for k in range(len(plain))] == plain and all("[SECRET]" in clean[k] for k in range(len(plain), len(plain + strong)))


def test_secrets_of_odd_rows(spark, odd, empty):
    text = 'é pwd: "Xk9#fQ2!zR", password = changeme123; token=abcdef0123456789abcdef'
    rows = spark.createDataFrame([(1, text, 5)], "doc_id long, text string, n_chars long")
    r = guess_cost.digests(rows).first()
    assert (r.n_assign, r.n_access, r.n_hex) == (1, 0, 1)
    base = ",".join(f"{guess_cost.KINDS[k]}:{s}:{e}" for s, k, e in brute_spans(text))
    assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and r.spans.startswith("guess:8:18,assign:")
    clean = guess_cost.redact(rows).first().text
    assert "[SECRET]" in clean and "Xk9" not in clean and "abcdef0123" not in clean and "changeme123" in clean
    assert guess_cost.digests(odd).count() == 14 and guess_cost.digests(empty).count() == 0
    assert [r.text for r in guess_cost.redact(odd).collect()] == [r.text for r in odd.collect()]


# --- 7 --------------------------------------------------------------------------------------


def test_licences_are_inherited_from_the_nearest_folder(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/COPYING", "Licensed under the Apache License, Version 2.0."),
            ("a/b/c/x.py", "code"), ("a/y.py", None), ("z.py", ""), ("q/z.py", "no licence text"), ("a/h.py", "x\n" * 90 + "# Released under the MIT License.\n"), (None, "x")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "path string, text string, licence int")
    found = {r.path: (r.licence, r.origin, r.licence_folder) for r in licenses.scan(frame).collect()}
    assert found["a/b/c/x.py"] == ("Apache-2.0", "inherited", "a/b") and found["a/y.py"] == ("MIT", "inherited", "a")
    assert found["a/h.py"] == ("MIT", "header", None) and found["z.py"] == found["q/z.py"] == (None, "none", None)
    assert licenses.scan(frame.where("false")).count() == 0
    assert not re.search("Python|Arrow|Pandas", licenses.scan(frame)._jdf.queryExecution().executedPlan().toString())


def test_pieces_are_matched_once(spark):
    """What paths and folders take from the matches is read, not matched again for each use."""
    frame = spark.createDataFrame([("a/LICENSE", "Released under the MIT License."), ("a/b/x.py", "code")], "path string, text string")
    found = licenses.scan(frame)
    assert "regexp_extract_all" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.path, r.licence, r.origin) for r in found.collect()} == {("a/LICENSE", "MIT", "header"), ("a/b/x.py", "MIT", "inherited")}


def test_each_row_of_odd_documents_gets_a_licence(spark, odd, empty):
    mit = "# Released under the MIT License."
    rows = [(None, mit, "s", "en"), (None, "code", "s", "en"), (None, None, None, None), (7, mit, "s", "en"), (7, mit, "s", "en"), (7, "code", "t", "en"), (250, "", "s", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = sorted(((r.doc_id, r.licence, r.origin) for r in licenses.documents_licences(frame).collect()), key=str)
    want = [(7, "MIT", "header"), (7, "MIT", "header"), (7, None, "none"), (250, None, "none"), (None, "MIT", "header"), (None, None, "none"), (None, "MIT", "inherited")]
    assert got == sorted(want, key=str)
    assert licenses.documents_licences(odd).count() == 14 and licenses.documents_licences(empty).count() == 0


COMMON = "/usr/share/common-licenses"  # whole texts of licences, on systems that have them


def _tree(pairs):
    return [(f"{folder}/{name}", text) for folder, files in pairs.items() for name, text in files.items()]


def test_whole_licence_texts_are_found_and_inherited(spark):
    text = {(n, k): t for n, k, t in licenses.TEMPLATES if k == "text"}
    wrap = lambda t, mark="": "\n".join(mark + line for line in re.findall(r".{1,70}(?:\s|$)", t))
    apache = next(t for n, k, t in licenses.TEMPLATES if n == "Apache-2.0" and "compliance" in t)
    code = "".join(f"def f{k}(x):\n    return x + {k} * other_{k}\n\n" for k in range(40))
    rows = _tree({
        "mit": {"LICENSE": "The MIT License\n\nCopyright (c) 2019 Some Holder\n\n" + wrap(text["MIT", "text"]), "src/a.py": code},
        "bsd": {"legal.txt": "Copyright 2020 The Authors. All rights reserved.\n\n" + wrap(text["BSD-3-Clause", "text"]), "x/y/b.py": code},
        "two": {"COPYING": "Copyright 2020 B\n" + wrap(text["BSD-2-Clause", "text"]), "c.py": code},
        "isc": {"LICENSE.md": wrap(text["ISC", "text"]) + "\n", "d.py": code},
        "plain": {"h.py": wrap("Copyright 2011 The Team.\n#\n" + apache, "# ") + "\n\n" + code, "i.py": code},
        "prose": {"LICENSE_plates.txt": "The mayor renewed the licence of the ferry and nobody asked about copyright that day.", "j.py": code},
    })
    found = {r.path: (r.licence, r.origin) for r in licenses.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert found["mit/LICENSE"] == ("MIT", "header") and found["mit/src/a.py"] == ("MIT", "inherited")
    assert found["bsd/legal.txt"] == ("BSD-3-Clause", "header") and found["bsd/x/y/b.py"] == ("BSD-3-Clause", "inherited")
    assert found["two/COPYING"][0] == "BSD-2-Clause" and found["two/c.py"] == ("BSD-2-Clause", "inherited")
    assert found["isc/d.py"] == ("ISC", "inherited")
    # A header wrapped over lines is one piece; a file with a header is no licence file.
    assert found["plain/h.py"] == ("Apache-2.0", "header") and found["plain/i.py"] == (None, "none")
    assert found["prose/LICENSE_plates.txt"] == (None, "none") and found["prose/j.py"] == (None, "none")


@pytest.mark.skipif(not os.path.isdir(COMMON), reason="no whole licence texts here")
def test_long_licence_texts_are_known_by_title_or_as_templates(spark):
    wanted = {"Apache-2.0": "Apache-2.0", "GPL-3": "GPL-3.0", "GPL-2": "GPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    rows = [(f"{n}/notes", open(f"{COMMON}/{n}").read()) for n in wanted] + [(f"{n}/deep/er/code.c", "int x;") for n in wanted]
    rows.append(("gfdl/notes", open(f"{COMMON}/GFDL-1.3").read().replace("published", "printed")))
    rows.append(("gfdl/code.c", "int x;"))
    files = spark.createDataFrame(rows, "path string, text string")
    found = {r.path: (r.licence, r.origin) for r in licenses.scan(files).collect()}
    for n, licence in wanted.items():
        assert found[f"{n}/notes"] == (licence, "header") and found[f"{n}/deep/er/code.c"] == (licence, "inherited")
    assert found["gfdl/code.c"] == (None, "none")
    more = {r.path: (r.licence, r.origin) for r in licenses.scan(files, extra=licenses.texts_below(spark, f"{COMMON}/GFDL-1.3")).collect()}
    assert more["gfdl/notes"] == ("GFDL-1.3", "header") and more["gfdl/code.c"] == ("GFDL-1.3", "inherited")


def test_prose_with_a_cue_word_has_no_licence(spark):
    said = [
        "Her driving licence had expired in March.", "The warranty covers the engine for three years.", "He spoke of artistic license.",
        "They hold the copyright to the song until 2040.", "Every restaurant needs a license to serve wine.", "The book is long in the public domain now.",
        "A licence fee is paid by each household.", "No warranty was given for the old boat.", "Redistribution of land began in spring.",
    ]
    rows = [(f"p/{k}", PROSE + "\n" + s + "\n" + PROSE) for k, s in enumerate(said)] + [("p/long", "\n".join(said * 500)), ("p/blank", "license" + "\n" * 200_000)]
    got = licenses.scan(spark.createDataFrame(rows, "path string, text string")).collect()
    assert {r.path for r in got if r.licence} == set() and len(got) == len(rows)


def test_licences_equal_sql(spark):
    con = database(SF)
    theirs = con.sql(licenses.ORACLE).to_arrow_table()
    mine = queries.op7_licence_cosine(spark, SF).toArrow()
    names = sorted(mine.column_names)
    assert rows_of(mine, names) == rows_of(theirs, names)


# --- 8 and 10 -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(trie_bpe.VOCABULARY)


def test_tokens_equal_the_library(spark, odd, empty, docs, library):
    for frame in (odd, docs):
        texts = Counter((r.doc_id, r.text or "") for r in frame.collect())
        want = Counter()
        for (i, t), n in texts.items():
            ids = library.encode(t, add_special_tokens=False).ids
            text = library.decode(ids, skip_special_tokens=False)
            want[i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text))] += n
        assert Counter(tuple(r) for r in trie_bpe.digests(frame).collect()) == want
        counted = merge_counts.count_tokens(frame.select("doc_id", "text"), keep=["doc_id"]).collect()
        assert Counter((r.doc_id, r.n_tokens) for r in counted) == Counter({k: 0 for k in ()}) + _fold(want)
        assert all(r.over_limit == (r.n_tokens > 2048) for r in counted)
    assert trie_bpe.digests(empty).count() == merge_counts.count_tokens(empty).count() == 0
    assert merge_counts.count_tokens(odd).columns == [*odd.columns, "n_bytes", "n_tokens", "over_limit"]


def _fold(want):
    out = Counter()
    for (i, n, *_), times in want.items():
        out[i, n] += times
    return out


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("abthe' ins.=\n😀ßé中0ΣİÁ\x1c "), max_size=60))
def test_words_equal_the_library(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    coder = trie_bpe.encoder(trie_bpe.VOCABULARY)
    assert coder.encode([text]) == [ids]
    assert merge_counts.counter(trie_bpe.VOCABULARY).count([text]) == [len(ids)]
    assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_memory_that_starts_anew_changes_nothing(library):
    from hirelens.llm.word_bpe import vocabulary

    texts = [PROSE, "other words here", PROSE.upper()]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    small = trie_bpe.TrieEncoder(vocabulary(trie_bpe.VOCABULARY), remembered=5)
    assert [small.encode([t])[0] for t in texts] == want
    counts = merge_counts.MergeCounter(vocabulary(trie_bpe.VOCABULARY), remembered=5)
    assert [counts.count([t])[0] for t in texts] == [len(w) for w in want]


# --- 9 --------------------------------------------------------------------------------------


def brute_measures(text):
    words = [w for w in re.split(r"[ \t-\r]+", text) if w]
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    times, inside, seen, lines = Counter(windows), set(), set(), 0
    for k, w in enumerate(windows):
        if times[w] > 1:
            inside.update(range(k, k + 5))
    for line in text.split("\n"):
        if re.search(r"[^ \t-\r]", line):
            lines += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), lines, len(inside)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab #é\n\t\x1c"), max_size=80), max_size=4))
def test_measures_equal_brute_force(texts):
    got = [x.to_pylist() for x in repetition.measure_texts(pa.array(texts, pa.string()))[:5]]
    assert list(zip(*got)) == [brute_measures(t) for t in texts]


def thue_morse(size):
    return "".join("ab"[bin(k).count("1") % 2] for k in range(size))


@pytest.mark.parametrize("size", [512, 1024, 4096])
def test_unlike_lines_and_words_of_equal_sums_are_unlike(size):
    one = thue_morse(size)
    two = one.translate({97: "b", 98: "a"})
    rest = [f"w{k}" for k in range(4)]
    for text in (f"{one}\n{two}\n{one}", " ".join([one, *rest, two, *rest])):
        got = [x.to_pylist()[0] for x in repetition.measure_texts(pa.array([text]))[:5]]
        assert tuple(got) == brute_measures(text)
    table = pa.array([one, two])
    hashes, _ = spaced_seeds.words_of(table)
    assert hashes[0] != hashes[1]


def brute_repeated_chars(text):
    """Characters of words in lines, and in windows of each length, that stood in the text before."""
    in_lines, seen = 0, set()
    for line in text.split("\n"):
        words = [w for w in re.split(r"[ \t-\r]+", line) if w]
        in_lines += sum(map(len, words)) * (line in seen)
        if words:
            seen.add(line)
    words = [w for w in re.split(r"[ \t-\r]+", text) if w]
    out = []
    for size in repetition.LENGTHS:
        seen, inside = set(), set()
        for k in range(len(words) - size + 1):
            window = tuple(words[k : k + size])
            if window in seen:
                inside.update(range(k, k + size))
            seen.add(window)
        out.append(sum(len(words[k]) for k in inside))
    return in_lines, out


def brute_kept(text):
    n_words, chars, _, _, repeated = brute_measures(text)
    in_lines, in_ngrams = brute_repeated_chars(text)
    if n_words < 10 or 100 * repeated > 20 * n_words or in_lines > repetition.MOST_IN_LINES * chars:
        return False
    return all(n <= repetition.MOST_IN_NGRAMS[size] * chars for size, n in zip(repetition.LENGTHS, in_ngrams))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "bé", "c#", "\n", " ", "long word here", "one two three four five six seven"]), max_size=60).map(" ".join), max_size=3))
def test_repeated_characters_equal_brute_force(texts):
    lines, ngrams = (x.to_pylist() for x in repetition.measure_texts(pa.array(texts, pa.string()))[5:])
    assert list(zip(lines, ngrams)) == [brute_repeated_chars(t) for t in texts]


def test_verdicts_equal_brute_force(docs):
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert all(r.kept == brute_kept(texts[r.doc_id]) for r in repetition.verdicts(docs).collect())


def test_rules(spark, odd, empty):
    rows = {r.doc_id: r for r in repetition.verdicts(odd).collect()}
    assert all(tuple(rows[k])[1:6] == brute_measures(t or "") for k, t in enumerate(odd_texts()))
    assert rows[4].kept and not rows[0].kept and not rows[3].kept
    kept = repetition.apply_rules(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} >= {4, 5, 6, None}
    assert repetition.verdicts(empty).count() == 0 and repetition.apply_rules(empty).count() == 0


# --- pipeline -------------------------------------------------------------------------------


def test_pipeline_stages(spark, odd, empty, docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontaminate", "redact_secrets", "encode"]
    for start in (docs.where("false"), odd.selectExpr("doc_id", "text", "lang", "source", "cast(length(text) AS long) n_chars")):
        rows = start
        for name, stage in corpus_pipeline.STAGES:
            after = written(stage(spark, rows, SF), "test_stage")
            if name != "encode":
                assert after.columns == rows.columns
                assert after.count() <= rows.count()
            rows = after
        assert rows.columns == ["doc_id", "n_tokens", "ids", "decoded"]


def brute_fingerprint(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text).encode()
    words = [w for w in re.split(rb"[ \t-\r]+", words) if w]
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def cut_words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def brute_contaminated(text, items):
    """Whether a stretch of the text matches an item in as many words as needed, on any diagonal with that many matches."""
    words, places = cut_words(text), {}
    for k, w in enumerate(words):
        places.setdefault(w, []).append(k)
    for item in items:
        need = spaced_seeds.needed(len(item))
        for shift, n in Counter(p - k for k, w in enumerate(item) for p in places.get(w, ())).items():
            a, b = max(0, -shift), min(len(item), len(words) - shift)
            if n >= need and spaced_seeds.best_match(np.array([item[k] == words[k + shift] for k in range(a, b)]), len(item)):
                return True
    return False


def test_pipeline_equals_brute_force(spark, docs, library):
    rows = {r.doc_id: r.text for r in docs.collect()}
    good = {i: t for i, t in rows.items() if brute_kept(t or "")}
    prints = {i: brute_fingerprint(t) for i, t in good.items()}
    roots = brute_links(sorted(good), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    tests = [cut_words(r.text) for r in table(spark, SF, "benchmark").collect()]
    want = {}
    for i in good:
        if roots[i] == i and not brute_contaminated(good[i], tests):
            text = guess_cost.redact_text(good[i], guess_cost.scan_text(good[i]), "[SECRET]")
            ids = library.encode(text, add_special_tokens=False).ids
            want[i] = (len(ids), ids, library.decode(ids, skip_special_tokens=False))
    assert {r.doc_id: (r.n_tokens, r.ids, r.decoded) for r in corpus_pipeline.run(spark, SF).collect()} == want


def test_stages_need_no_further_columns(spark, odd):
    rows = odd.select("doc_id", "text")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = written(stage(spark, rows, SF), "bare")
        assert rows.columns == ["doc_id", "text"]
    assert {r.doc_id for r in rows.collect()} == {4, 6, 10}


# --- 11 -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def both_libraries():
    a = Tokenizer.from_file(token_links.BYTE_LEVEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)


def brute_alignment(texts, libraries):
    a, b = libraries
    byte_of = {c: n for n, c in word_bpe.byte_characters().items()}
    bytes_a = {i: bytes(byte_of.get(c, 0) for c in t) for t, i in a.get_vocab().items()}
    counts, found = Counter(), []
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        parts_a = [bytes_a[i] for i in ids_a]
        parts_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode() for i in ids_b]
        if not text or not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
            found.append(None)
            continue
        ends_a, ends_b = (np.cumsum(list(map(len, p))).tolist() for p in (parts_a, parts_b))
        groups, at_a, at_b = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(end, at_a) + 1, ends_b.index(end, at_b) + 1
            groups.append((ids_a[at_a:to_a], ids_b[at_b:to_b]))
            at_a, at_b = to_a, to_b
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        counts.update(links.keys())
        shown = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        found.append((len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(shown.encode()).hexdigest()))
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if f is None else
        (*f[:3], f[3].total(), sum(n for p, n in f[3].items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in f[3].items()), f[4])
        for f in found
    ]


LINKS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_equals_brute_force(spark, odd, empty, docs, both_libraries, monkeypatch):
    monkeypatch.setattr(token_links, "BLOCK_PAIRS", 5000)  # several blocks
    rng = np.random.default_rng(3)
    signs = list("ab'1é. \r\n\t  \xa0\x1c\x85=日😀▁")
    made = ["".join(rng.choice(signs, rng.integers(1, 25))) for _ in range(1500)]
    made += ["▁x", "a\r\r  b", "<|endoftext|> x's 'll", "='='" * 300, "x" * 3000, "é" * 50 + "😀" * 40]
    frames = [odd, docs, spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")]
    for frame in frames:
        rows = frame.select("doc_id", "text").collect()
        want = Counter((r.doc_id, *w) for r, w in zip(rows, brute_alignment([r.text for r in rows], both_libraries)))
        assert Counter(tuple(r[c] for c in LINKS) for r in token_links.digests(frame).collect()) == want
    assert token_links.digests(empty).count() == 0


def test_long_groups_count_equal_ids_once(both_libraries):
    aligner = token_links.Aligner(token_links.BYTE_LEVEL, sentence_pieces.MODEL)
    a, b = both_libraries
    text = " " + "\u0e01\u0301" * 40
    found = aligner.align(text, a.encode(text, add_special_tokens=False).ids, b.encode(text[1:]))
    assert found[3] == sum(np.frombuffer(found[6], np.int64)) if found[6] else found[3] == len(found[5]) // 8


# --- 12 -------------------------------------------------------------------------------------


def brute_divergences(rows, least=10, top=10):
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, documents, groups = {}, {}, {}
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [t.translate(small) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups.setdefault(lang, {}).setdefault(source, Counter()).update(terms)
        documents.setdefault(lang, Counter()).update(set(terms))
    out = []
    far = lambda p, q: (p - q) ** 2 // (p + q)
    rank = lambda items: enumerate(sorted(items, key=lambda i: (-i[1], i[0].encode())), 1)
    for lang, sources in groups.items():
        kept = [t for t, n in documents[lang].items() if n >= least]
        total = lambda c: sum(c[t] for t in kept) + 2 * len(kept)
        share = lambda c: (lambda n: {t: 1 + 10**9 * (c[t] + 2) // n for t in kept})(total(c))
        whole, shares = share(sum(sources.values(), Counter())), {s: share(c) for s, c in sources.items()}
        for s, p in shares.items():
            pairs = [(o, sum(far(p[t], q[t]) for t in kept)) for o, q in shares.items() if o != s]
            out += [(lang, s, "pair", item, value, k) for k, (item, value) in rank(pairs)]
            terms = [(t, far(p[t], whole[t])) for t in kept if sources[s][t] and p[t] > whole[t]]
            out += [(lang, s, "term", item, value, k) for k, (item, value) in rank(terms) if k <= top]
    return sorted(out)


def test_divergences_equal_brute_force_and_sql(spark, docs, odd, empty):
    names = ["lang", "source", "part", "item", "value", "rank"]
    # An odd row may have null or empty lang and source; copies of it stand beside rows of one source without any term.
    more = odd.select("text", "lang", "source").unionAll(odd.selectExpr("text", "source", "lang")).unionAll(docs.selectExpr("'1 2'", "lang", "'bare'"))
    for frame, least in ((docs, 10), (docs.select("text", "lang", "source").unionAll(more), 2), (odd, 2), (odd, 10)):
        rows = [(r.text, r.lang, r.source) for r in frame.collect()]
        got = source_divergence.divergences(frame, least).collect()
        assert sorted(tuple(r[c] for c in names) for r in got) == brute_divergences(rows, least)
    assert source_divergence.divergences(empty).count() == 0
    mine = source_divergence.divergences(docs).toArrow()
    assert rows_of(mine, names) == rows_of(database(SF).sql(source_divergence.ORACLE).to_arrow_table(), names)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aaabB1 é日", max_size=60), max_size=8), st.sampled_from([2, 3, 50]), st.booleans())
def test_pointers_equal_counted_terms(texts, slice_size, long):
    texts = texts + ["a" * 3000, "a" * 3000 + " " + "A" * 2999] * long
    group = np.arange(len(texts)) % 3
    n, documents = Counter(), Counter()
    for text, g in zip(texts, group.tolist()):
        terms = [t.lower().encode() for t in re.findall("[aAbBé日]+", text)]
        n.update((t, g) for t in terms)
        documents.update((t, g) for t in set(terms))
    before, source_divergence.SMALL_SLICE = source_divergence.SMALL_SLICE, slice_size
    try:
        found = source_divergence.shard_counts(pa.array(texts, pa.string()), group)
    finally:
        source_divergence.SMALL_SLICE = before
    assert [(t, int(g)) for t, g in zip(*found[:2])] == sorted(n)
    assert {(t, int(g)): (a, b) for t, g, a, b in zip(*found)} == {k: (n[k], documents[k]) for k in n}


def test_shares_of_large_counts_are_exact(spark):
    cases = [(0, 0, 1), (10**14, 10**14, 10**6), (123_456_789_012, 999_999_999_999, 77), (5, 7, 3)]
    rows = spark.createDataFrame(cases, "c long, n long, v long").select("c", "n", "v", source_divergence.share("c", "n", "v").alias("p"))
    assert all(r.p == 1 + 10**9 * (r.c + 2) // (r.n + 2 * r.v) for r in rows.collect())


# --- 13 -------------------------------------------------------------------------------------


def test_pieces_equal_the_library(spark, odd, empty, docs, both_libraries):
    library = both_libraries[1]
    for frame in (odd, docs):
        want = Counter()
        for r in frame.select("doc_id", "text").collect():
            ids = library.encode(r.text or "")
            want[r.doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids)))] += 1
        assert Counter(tuple(r) for r in sentence_pieces.digests(frame).collect()) == want
    assert sentence_pieces.digests(empty).count() == 0
    named = odd.withColumn("IDS", F.lit(1))
    assert sentence_pieces.encode(named).columns == [*odd.columns, "ids", "decoded"]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(st.sampled_from("abthe  ins.=\n\r😀ßé中0▁\x1c\x00\xa0"), max_size=60), st.text(max_size=30)))
def test_parts_equal_the_library(both_libraries, text):
    library, coder = both_libraries[1], sentence_pieces.encoder(sentence_pieces.MODEL)
    ids = [i for part in coder.cut(text) for i in coder.encode_part(part)]
    assert ids == library.encode(text) and coder.model.decode(ids) == library.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(3, 258), st.integers(259, 31999)), max_size=9))
def test_any_ids_are_decoded_like_the_library(both_libraries, ids):
    assert sentence_pieces.encoder(sentence_pieces.MODEL).model.decode(ids) == both_libraries[1].decode(ids)


def test_a_text_without_blanks_is_encoded_in_linear_time(both_libraries):
    coder = sentence_pieces.encoder(sentence_pieces.MODEL)
    for unit in ("ab", "=", "the", "日😀"):
        text = unit * 20_000
        assert [i for part in coder.cut(text) for i in coder.encode_part(part)] == both_libraries[1].encode(text)


def test_remembered_results_come_back_or_are_made_anew():
    known = common.Remembered(4000)
    for k in range(200):
        keys = [f"k{k % 7}", f"n{k}"]
        for key in known.missing(keys):
            known.put(key, key.upper())
        assert all(known.young[key] == key.upper() for key in keys)
        assert len(known.young) + len(known.old) < 40
