"""Ranked search, main text and alignment against plain versions of the same definitions, and their edge cases."""

import collections
import hashlib
import html
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tokenizers import Tokenizer

from tidemark.llm import alignment, extract, search

# --- ranked search ----------------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(items, docs, depth):
    """(item position, rank, doc_id, score) by the formula, document by document."""
    counts = [(i, terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in counts), sum(len(w) for _, w in counts)
    df = collections.Counter(t for _, w in counts for t in set(w))
    out = []
    for k, (_, text) in enumerate(items):
        scored = []
        for i, w in counts:
            tf = collections.Counter(w)
            m = 25 + 75 * len(w) * n_docs // n_terms if n_terms else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in terms(text) if tf[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(k, r, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:depth], 1)]
    return out


def some_text(r, n):
    return " ".join(r.choice(["the", "The", "of", "a1", "Ärger", "x-y", "w%d" % r.randrange(40), "\x00", "née"]) for _ in range(n))


@pytest.mark.parametrize("block", [{}, {"block_items": 3}, {"block_bytes": 40}])
def test_search_is_the_formula_for_blocks_of_any_size(spark, block):
    r = random.Random(5)
    items = [(i, some_text(r, r.randrange(1, 15))) for i in range(12)]
    docs = [(i - 20, some_text(r, r.choice([0, 1, 5, 40, 900]))) for i in range(90)]
    docs += [(500 + i, docs[3][1]) for i in range(15)]  # copies tie
    got = search.search(spark.createDataFrame(items, "item_id int, text string"), spark.createDataFrame(docs, "doc_id int, text string").repartition(5), 7, **block)
    assert sorted(map(tuple, got.collect())) == sorted(ranked(items, docs, 7))


def test_search_of_nulls_repeated_rows_ties_and_clashing_columns(spark):
    items = [(1, "the cat", "x"), (1, "the cat", "x"), (None, "cat", "x"), (2, None, "x"), (3, "", "x"), (4, "!!", "x"), (5, "unseen", "x")]
    docs = [(7, "cat sat"), (7, "cat sat"), (None, "cat sat"), (3, "cat sat"), (9, None), (None, ""), (8, "dog"), (2**63 - 1, "cat sat"), (-(2**63), "cat sat")]
    got = search.search(
        spark.createDataFrame(items, "item_id int, text string, score string"),
        spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id bigint, text string, rank int, item_no int"),
        6,
    )
    want = [(items[k][0], r, d, s) for k, r, d, s in ranked([i[:2] for i in items], docs, 6)]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert [d for i, r, d, _ in sorted(want, key=key) if i is None] == [-(2**63), 3, 7, 7, 2**63 - 1, None]


def test_search_of_empty_tables(spark):
    items, docs = spark.createDataFrame([(1, "a")], "item_id int, text string"), spark.createDataFrame([(1, "a")], "doc_id int, text string")
    for found in (search.search(items.limit(0), docs), search.search(items, docs.limit(0))):
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.collect() == []


def test_a_very_long_document_and_many_postings(spark, monkeypatch):
    monkeypatch.setattr(search, "CELLS", 50)
    r = random.Random(2)
    items = [(i, some_text(r, 30)) for i in range(9)]
    docs = [(1, some_text(r, 60_000))] + [(i + 2, some_text(r, 20)) for i in range(30)]
    got = list(search._slice_scores([t.encode() for _, t in docs], index := search.build_index(list(range(9)), [t.encode() for _, t in items]), np.ones(len(index.terms), np.int64), 31, 70_000))
    whole = np.concatenate([s for _, s in got])
    monkeypatch.undo()
    ((_, once),) = search._slice_scores([t.encode() for _, t in docs], index, np.ones(len(index.terms), np.int64), 31, 70_000)
    assert len(got) > 1 and (whole == once).all()


# --- main text --------------------------------------------------------------------------------------------------------

LONG = "A long run of words about nothing in particular, which goes on, and on, with <a href='/x'>one link</a> in the middle. " * 3
PLAIN = " ".join(html.unescape(re.sub("<[^>]*>", "", LONG)).split())

PAGES = {
    "article": (f"<body><nav><a href=a>Menu</a></nav><article><h1>Head</h1><p><b>One.<br><p>{LONG}</p></article><footer>&copy; me</footer>", f"Head\nOne.\n{PLAIN}"),
    "short article": ("<nav>x</nav><div class=ad>Buy this long advert text now.</div><article><h1>Be.</h1><p>Be.</article><div>Some other text, longer than all of it.</div>", "Be.\nBe."),
    "side parts": (
        f"<main><header><h1>T</h1></header><p>a&nbsp;b\n c</p><aside>s</aside><form><p>f</p><input></form><div id='comments'><p>{LONG}</p></div>"
        f"<section class='related-posts'>r</section><article class='comment'>{LONG}</article><div class='cookieNotice'>{LONG}</div><p>z</p></main>",
        "T\na b c\nz",
    ),
    "wrapper named after its sidebar": (f"<div class='with-sidebar'><p>{LONG}</p><div class=sidebar>{LONG}</div></div>", PLAIN),
    "wrapper of an article": ("<div id=banner-page><article><p>x</p></article></div>", "x"),
    "density alone": (
        f"<div id=top>Site <a href=/>Home</a> <a href=/b>About</a></div><div><h2>Title</h2><p>{LONG}<p>{LONG}<p>End.</div><div>Made by me</div>",
        f"Title\n{PLAIN}\n{PLAIN}\nEnd.",
    ),
    "raw text": ("<article><script>if (a</b) '</p>'</script>x<style>p{}</style><!-- <p>no --> y<!-->z<template><p>t</p></template></article>", "x yz"),
    "references": ("<article>&lt;b&gt; &#65;&#x42; &amp;amp; &eacute &nosuch; 1 < 2 <3</article>", "<b> AB &amp; é &nosuch; 1 < 2 <3"),
    "hidden": ("<article><p hidden>a<p>b<div style='display:none'>c</div><span aria-hidden=true>d<span>e</span></span>f</article>", "b\nf"),
    "cells and items": ("<article><table><tr><td>1<td>2<tr><td>3</table><ul><li>i<li>j</ul>k</article>", "1\n2\n3\ni\nj\nk"),
    "attributes": ("<article data-x='a>b' class=\"q\"><p title=\"</p>\">t</p></article>", "t"),
    "stray ends": ("<article><p>1 </div>2</p></span>3<b>4</article>", "1\n2\n34"),
    "unfinished": ("<article><p>hello <a href='x", "hello"),
    "no marks": ("just <i>te</i>xt", "just text"),
    "nothing": ("<html><head><title>t</title></head><body></body></html>", ""),
    "empty": ("", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, text = PAGES[name]
    assert extract.main_text(page) == text


def test_densities_follow_the_formula():
    """Two paragraphs, one of them half a link, in a body: characters over tags, scaled by how little is link."""
    page = extract._Page("<p>abcdefgh</p><p>abcd<a>efgh</a></p>")
    own, plain, total, end = extract._densities(page)
    base = lambda c, lc: math.log(c / max(c - lc, 1) * lc + 4 / 16 * c + math.e)
    first = 8 / 1 * math.log(8 / 1 * 1 / 1) / math.log(base(8, 0))
    second = 8 / 2 * math.log(8 / 4 * 2 / 1) / math.log(base(8, 4))
    assert plain[1:] == [8.0, 4.0] and np.allclose(own[1:], [first, second]) and np.isclose(total[0], first + second) and end == [3, 2, 3]


def test_odd_and_long_pages_take_time_in_proportion():
    assert extract.main_text("<article>" + "<div>" * 50_000 + "x" + "</div>" * 9) == "x"
    assert extract.main_text("<" * 100_000 + "x") == "<" * 99_999
    assert extract.main_text('<p a="' * 50_000) == "" and extract.main_text("<article>" + "<p>w" * 50_000).count("\n") == 49_999


def test_extract_keeps_rows_and_clashing_columns(spark):
    rows = [(1, "u", "<article>a</article>", "t", 5), (1, "u", "<article>a</article>", "t", 5), (None, None, None, None, None), (2, "v", "", "x", 0)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, text string, n_chars int")
    got = [(r.row.page_id, r.row.text, r.text, r.n_chars) for r in extract.extract(pages).collect()]
    assert sorted(got, key=str) == sorted([(1, "t", "a", 1)] * 2 + [(None, None, "", 0), (2, "x", "", 0)], key=str)
    assert extract.extract(pages.limit(0)).collect() == []


# --- alignment --------------------------------------------------------------------------------------------------------

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH), {i: t for t, i in a.get_vocab().items()}


def aligned(text, libraries):
    """(n_a, n_b, groups, links) of one text by comparing every byte range with those beside it."""
    a, b, token = libraries
    if not text:
        return 0, 0, [], []
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    letters = alignment.byte_level_bytes()
    spelled = [bytes(letters[c] for c in token[i]) for i in ids[0]], [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]
    if any(b"".join(x) != (" " + text).encode() for x in spelled):
        return 0, 0, [], []
    ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelled]
    groups, links, i, j = [], [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        i2, j2 = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
        groups.append(",".join(map(str, ids[0][i:i2])) + "|" + ",".join(map(str, ids[1][j:j2])))
        for x in range(i, i2):
            for y in range(j, j2):
                if max(ends[0][x - 1] if x else 0, ends[1][y - 1] if y else 0) < min(ends[0][x], ends[1][y]):
                    links.append((ids[0][x], ids[1][y]))
        i, j = i2, j2
    return len(ids[0]), len(ids[1]), groups, links


ODD = ["", " ", "  ", "a ", "a  ", " a", "\n", "a\n b", "a \n\n b", "\t x", " \xa0 b", "a　 b", "▁", "a▁b c", "<|endoftext|> <s> <0x41>", "é 中文 🎉 x", "\x00 a", "a\x85 b", "it's  'ok'", "x" * 300, " " * 40 + "y" + " " * 17, "​ z", "\x1c \x1d"]


def expected(rows, libraries):
    facts = [(i, aligned(t, libraries)) for i, t in rows]
    held = collections.Counter(link for _, f in facts for link in set(f[3]))
    top = {}
    for (a, _), n in held.items():
        top[a] = max(top.get(a, 0), n)
    return [
        (i, na, nb, len(g), len(l), sum(held[x] == top[x[0]] for x in l), sum(held[x] for x in l), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for i, (na, nb, g, l) in facts
    ]


@pytest.mark.parametrize("bounds", [{}, {"slice_bytes": 30, "part_links": 20}])
def test_alignment_is_that_of_whole_texts(spark, libraries, bounds):
    r = random.Random(3)
    rows = list(enumerate(ODD + ["".join(r.choice("ab \n\t.,'1é▁中 \xa0") for _ in range(r.randrange(1, 60))) for _ in range(150)] + ["ab ab, the end"] * 9))
    rows += [(None, None), (None, "the end"), (3, "the end"), (3, "the end")]
    docs = spark.createDataFrame([(*x, 1, "p") for x in rows], "doc_id int, text string, n_a int, part string").repartition(3)
    got = alignment.align(docs, A_PATH, B_PATH, **bounds).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected(rows, libraries), key=str)


def test_alignment_of_a_long_text_without_a_break_and_of_nothing(spark, libraries):
    r = random.Random(8)
    long = [(1, "".join(r.choice("abcdefé") for _ in range(3000))), (2, " ".join(r.choice(["ab", "cd.", "ef\n"]) for _ in range(20_000)))]
    docs = spark.createDataFrame(long, "doc_id int, text string")
    got = {x.id: (x.n_a, x.n_b, x.groups_sha256) for x in alignment.align(docs, A_PATH, B_PATH).collect()}
    for i, t in long:
        a, b = libraries[0].encode(" " + t, add_special_tokens=False).ids, libraries[1].encode(t)
        assert got[i][:2] == (len(a), len(b)) and len(got[i][2]) == 64
    assert got[1][2] == expected(long[:1], libraries)[0][-1]
    assert alignment.align(docs.limit(0), A_PATH, B_PATH).collect() == []


def test_forgetting_runs_changes_nothing(libraries, monkeypatch):
    words = alignment._Dictionary(A_PATH, B_PATH)
    texts = ["ab cd ef", "gh ab", "cd ▁x", "", "ij kl ij "]
    want = [x.tolist() if hasattr(x, "tolist") else x for x in alignment.align_slice(words, texts)[0]]
    monkeypatch.setattr(alignment, "KNOWN_RUNS", 3)
    for _ in range(2):
        assert [x.tolist() if hasattr(x, "tolist") else x for x in alignment.align_slice(words, texts)[0]] == want
    assert words.cuts
