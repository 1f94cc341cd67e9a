"""Operators that work row by row or learn: tokens, packing, pages, licences, quality, toxicity."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import boosted, bpe, labels, licences, packing, quality, toxicity, wrapper
from helpers import WORD, frame, odd_texts, prose

LABELS = "doc_id long, quality int, toxic int"


# ---------------------------------------------------------------- byte BPE


def test_bpe_equals_tiktoken(spark):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.RANKS, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    letters = "ab \n\t\r\x1c\x85　é漢🙂'stll12٣½_-́‍\x00▁"
    texts = odd_texts() + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(500)]
    docs = frame(spark, texts, clashing=True)
    got = {r[0]: tuple(r[1:]) for r in bpe.round_trip(docs).collect()}
    ids = {r.doc_id: r.ids for r in bpe.encode(docs).collect()}
    raw = {r.doc_id: bytes(r.bytes) for r in bpe.decode(bpe.encode(docs)).collect()}
    for k, t in enumerate(texts):
        want = plain.encode_ordinary(t or "")
        assert ids[k] == want and raw[k] == (t or "").encode()
        assert got[k] == (len(want), hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert bpe.round_trip(frame(spark, [])).count() == 0


# ---------------------------------------------------------------- packing


def plain_pieces(texts, size):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    out = {}
    for k, text in enumerate(texts):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        for p, at in enumerate(range(0, len(ids), size)):
            part = ids[at : at + size]
            out[k, p] = (at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()))
    return out


@pytest.mark.parametrize("size", [2048, 64])
def test_packing(spark, size):
    texts = odd_texts() + [prose(k, 5 + 7 * k) for k in range(60)] + ["Don't stop, it's été. «Fin», (ok)...", "a.b, c,\nd."]
    rows = packing.pack(frame(spark, texts, clashing=True), size).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == plain_pieces(texts, size)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    total = sum(r.length for r in rows)
    assert len(sequences) <= -(-total // size) * 1.1 + 1
    assert packing.pack(frame(spark, [])).count() == 0


def test_packing_of_letters_that_the_normalizer_splits(spark):
    texts = ["alpha İstanbul beta gamma", "x হয় y z", "क़लम one two", "שּׁ שׁלום three", "four \uac00\u0301 five ǰ ΐ ẞ six", prose(4, 200) + " İ য় " + prose(5, 200)]
    rows = packing.pack(frame(spark, texts)).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == plain_pieces(texts, 2048)


def test_words_are_encoded_as_alone():
    """Every letter that Unicode's normal forms or lower case take apart, in one call with ordinary words."""
    import unicodedata

    tokenizer, _ = packing._tokenizer(packing.TOKENIZER)
    changed = [c for c in map(chr, range(0x80, 0x30000)) if c.isalpha() and len(unicodedata.normalize("NFC", c).lower()) > 1]
    assert "İ" in changed and "\u09df" in changed
    words = [w.encode() for c in changed for w in ("alpha", "a" + c + "b", "beta")]
    alone = [np.array(e.ids, dtype="<u4").tobytes() for e in tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
    assert packing._encode_words(tokenizer, words) == alone
    joined = tokenizer.encode(" ".join(w.decode() for w in words), add_special_tokens=False).ids
    assert b"".join(alone) == np.array(joined, dtype="<u4").tobytes()


def test_ids_of_whole_texts_equal_the_tokenizer():
    """Capitals before combining marks, and random texts of many scripts, marks, spaces and punctuation."""
    tokenizer, _ = packing._tokenizer(packing.TOKENIZER)
    rng = random.Random(12)
    pool = [*"abcJHTWYΣİIıßĲǅ", *"\u030c\u0331\u0308\u030a\u0301\u0327\u0345", *" \n\t\x0b\x1c\x85\xa0\u2003", *".,'’!12½٣", "가", "ᄀ", "ᅡ", "ᆨ", "হ", "য়", "\u09bc", "क\u093c", "Å", "ﬁ", "🙂", "'s", "'RE", "<|endoftext|>", "Word", "THE. "]
    texts = ["J̌a", "H̱a", "T̈a", "W̊a", "Y̊a", "A J̌a. J", "ΑΣ Σ."] + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 24))) for _ in range(20_000)]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    got = packing.token_buffers([t.encode() for t in texts], packing.TOKENIZER)
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []


def test_plan_uses_every_length():
    rng = np.random.default_rng(3)
    for scale in (1, 40):
        counts = np.bincount(np.minimum(rng.lognormal(6, 1, 3000).astype(int) + 1, 2048), minlength=2049) * scale
        made = packing.plan(counts)
        used = np.zeros_like(counts)
        for times, lengths in made:
            assert sum(lengths) <= 2048 and times > 0
            np.add.at(used, lengths, times)
        assert (used == counts).all()
        assert sum(t for t, _ in made) <= -(-(counts * np.arange(2049)).sum() // 2048) * 1.01 + 1
    assert packing.plan(np.zeros(2049, dtype=np.int64)) == []


# ---------------------------------------------------------------- quality rules


def plain_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else {w for w in set(windows) if sum(x == w for x in windows) > 1}
    covered = {k + j for k, w in enumerate(windows) if w in often for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark):
    texts = [t for t in odd_texts() if t is None or len(t) < 100_000] + ["a b c a b c a b c", "x y z # x y z\n x y z # x y z\n\n x y z # x y z", "l\nl\nl \n", "A b A b A b A", prose(8, 900, 12)]
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.judge(frame(spark, texts, clashing=True)).collect()}
    for k, t in enumerate(texts):
        want = plain_counts(t)
        assert got[k] == (*want, want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_quality_keeps_clean_and_drops_junk(spark):
    clean = [prose(k, 150, 2000) for k in range(300)]
    junk = [" ".join(w + random.Random(k).choice(["***", "$$$", "###"]) for w in prose(900 + k, 100, 2000).split()) for k in range(20)]
    junk += [prose(950 + k, 100, 2000).upper().replace(" ", "!! ") for k in range(20)]
    docs = frame(spark, clean + junk, clashing=True)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(300))
    assert quality.judge(docs.limit(0)).count() == 0 and quality.keep_good(docs.limit(0)).count() == 0


def test_quality_judges_rows_that_share_an_id(spark):
    clean = [prose(k, 150, 2000) for k in range(60)]
    junk = [prose(950 + k, 100, 2000).upper().replace(" ", "!! ") for k in range(2)]
    rows = [*enumerate(clean), (None, clean[0]), (None, junk[0]), (5, junk[1]), (None, None)]
    got = quality.keep_good(frame(spark, rows, clashing=True)).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted([*((str(k), t) for k, t in enumerate(clean)), ("None", clean[0])])


def test_quality_estimate_keeps_all_of_a_clean_corpus():
    model = quality.estimate([([1, 1, 0, 1], 5000), ([1, 0, 0, 1], 40), ([0, 1, 1, 1], 10), ([-1, 1, 1, 1], 10)], 4)
    for pattern in ([1, 1, 0, 1], [1, 0, 0, 1], [0, 1, 1, 1], [0, 0, 0, 0]):
        assert quality.responsibilities(pattern, model)[0] > 0.5
    assert quality.responsibilities([-1, 1, 1, 1], model)[0] < 0.5


# ---------------------------------------------------------------- boosted trees


def test_boosted_learns_and_flattens(spark):
    rng = random.Random(4)
    texts, rows = [], []
    for k in range(400):
        bad = k % 4 == 0
        t = prose(k, rng.randint(30, 80), 3000)
        texts.append(" ".join(w + "$$" for w in t.split()) if bad else t)
        rows.append((k, 0 if bad else 1, 0))
    docs = frame(spark, texts + odd_texts(), clashing=True)
    known = spark.createDataFrame(rows + [(None, 1, 0), (7, None, None), (10**6, 1, 0)], LABELS)
    training = lambda c: labels.remainder(c, 4) != 2
    got = {r.doc_id: r.score for r in boosted.score(docs, known, training).collect()}
    assert len(got) == len(texts) + len(odd_texts()) and all(0 <= s <= 1 for s in got.values())
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 4 == 2]
    assert len(held) > 50 and all((got[k] >= 0.7) == (k % 4 != 0) for k in held)
    assert boosted.score(docs.limit(0), known).count() == 0
    alone = {r.score for r in boosted.score(docs, known.where("quality = 1")).collect()}
    assert len(alone) == 1 and boosted.score(docs, known.limit(0)).count() == docs.count()


def test_forest_walk_equals_plain_walk():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, len(boosted.NAMES)))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float)
    forest = boosted.grow(x, y, np.ones(500), trees=10)

    def walk(row):
        total = forest.start
        for feature, bound, leaf in zip(forest.feature, forest.bound, forest.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > bound[node] else 1)
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(forest.score(x[:50]), [walk(r) for r in x[:50]])
    assert ((forest.score(x) > 0.5) == (y == 1)).mean() > 0.85


# ---------------------------------------------------------------- toxicity


def test_toxicity_learns_unseen_words(spark):
    rng = random.Random(6)
    texts, rows = [], []
    for k in range(400):
        words = prose(k, 60, 3000).split()
        toxic = k % 5 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = "zorvak" + rng.choice(["en", "or", "li", "um"])
        texts.append(" ".join(words))
        rows.append((k, 1, int(toxic)))
    docs = frame(spark, texts + odd_texts(), clashing=True)
    known = spark.createDataFrame(rows + [(None, 1, 1), (3, None, None)], LABELS)
    training = lambda c: labels.remainder(c, 5) != 0
    got = {r.doc_id: r.score for r in toxicity.score(docs, known, training).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == len(texts) + len(odd_texts())
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert len(held) > 40 and all((got[k] >= 0.5) == (k % 5 == 0) for k in held)
    assert toxicity.score(docs.limit(0), known).count() == 0 and toxicity.score(docs, known.limit(0)).count() == docs.count()


def test_clause_grammar():
    entries = tuple(toxicity.fixed_entries())

    def total(text):
        return sum(toxicity.matched_clauses(text, entries))

    assert total("A pleasant day.") == 0 and total("") == 0 and total("idiotic stupidity") == 0
    assert total("You are an idiot.") > total("An idiot walked by.") > 0
    assert total("You are not an idiot.") < total("You are an idiot.")
    assert total("He said: you are an idiot.") < total("You are an idiot.")
    assert total("I will kill you.") > total("They kill weeds.")
    assert len(toxicity.matched_clauses("Idiot! Clean here. What scum, what trash.", entries)) == 2


def test_composition_runs_parts_side_by_side():
    table, start = toxicity.compose(toxicity.NEGATION, toxicity.REPORT)
    assert len(table) == 4
    state, factor = table[start]["negation"]
    state, factor = table[state]["report"]
    assert table[state]["insult"][1] == pytest.approx(0.6 * 0.7)


# ---------------------------------------------------------------- licences


def test_licences(spark):
    texts = odd_texts() + [prose(k, 300, 2000).replace(". ", ".\n") for k in range(60)]
    notices = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "All rights reserved.", "This work is licensed under the GNU General Public License, version 3."]
    want = {}
    for k, notice in enumerate(notices * 2):
        texts.append(prose(500 + k, 40, 2000) + "\n" + notice + "\n" + prose(600 + k, 200, 2000))
        want[len(texts) - 1, 1] = {"Ap": "Apache-2.0", "MI": "MIT", "CC": "CC-BY-NC", "Al": "Proprietary", "Ge": "GPL"}[re.search("Ap|MI|CC|Al|Ge", notice).group()]
    texts.append(prose(700, 50, 2000) + " Released under the MIT License. " + prose(701, 50, 2000))
    want[len(texts) - 1, 0] = "MIT"
    rows = licences.scan(frame(spark, texts, clashing=True)).collect()
    assert {(r.doc_id, r.line): r.family for r in rows if r.confirmed} == want
    assert licences.scan(frame(spark, [])).count() == 0


def test_licences_wrapped_and_several(spark):
    import textwrap

    long = ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."]
    texts = [prose(k, 300, 2000).replace(". ", ".\n") for k in range(40)]
    want = set()
    for notice, family in zip(long, ["MIT", "GPL", "BSD"]):
        for width, mark in [(40, ""), (72, " * "), (60, "// ")]:
            texts.append("/*\n" + "\n".join(mark + x for x in textwrap.wrap(notice, width)) + "\n */\n\n" + prose(len(texts), 80, 2000))
            want.add((len(texts) - 1, 1, family))
    texts.append(prose(91, 60, 2000) + " Released under the MIT License. " + prose(92, 90, 2000) + " Licensed under the Apache License, Version 2.0. " + prose(93, 40, 2000))
    texts.append("Released under the MIT License. Licensed under the Apache License, Version 2.0.")
    for k in (1, 2):
        want |= {(len(texts) - k, 0, "MIT"), (len(texts) - k, 0, "Apache-2.0")}
    rows = licences.scan(frame(spark, texts, clashing=True)).collect()
    assert {(r.doc_id, r.line, r.family) for r in rows if r.confirmed} == want


def test_licence_bound_misses_no_notice():
    model = licences.train([prose(k, 30, 500) for k in range(200)])
    _, words = licences._words([(prose(1, 400, 500) + " released under the mit license " + prose(2, 400, 500)).encode()])
    assert len(model.hopeful(words, np.array([400]), np.array([405]))) == 1
    line, start, end = licences._windows(np.array([0, len(words)]))
    logits = model.logits([words[a:b] for a, b in zip(start, end)])
    notices = set(np.flatnonzero(logits[:, 0] < logits[:, 1:].max(axis=1)))
    assert notices <= set(model.hopeful(words, start, end))


# ---------------------------------------------------------------- pages

PAGES = "page_id long, url string, html string"


def page(title, paragraphs, shell=True):
    body = f"<article><h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "<p>Thanks for reading our site!</p><div class='share-buttons'>Tweet</div></article>"
    if not shell:
        return body
    return f"<html><head><title>x</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><div id='cookie-notice'>We use cookies</div>{body}<aside>Other</aside><section class='comments'><p>First comment!</p></section><form>Name <input></form><footer>&copy; site</footer></body></html>"


def test_main_text(spark):
    rows = [(k, "https://News.example.com/a/%d?x" % k, page(f"Title {k}", [f"Body &amp; text\n {k} a<b>b</b>c", f"More {prose(k, 20)}"])) for k in range(8)]
    rows += [(100, "https://lone.example.com/", page("One", ["Only page"])), (101, None, page("T", ["P"], shell=False)), (102, "x", None), (103, "http://news.example.com/", ""), (0, rows[0][1], rows[0][2])]
    got = {r.page_id: r for r in wrapper.main_text(spark.createDataFrame(rows, PAGES).withColumn("text", F.lit("clash")).withColumn("host", F.lit(1))).collect()}
    for k in range(8):
        assert got[k].text == f"Title {k}\n\nBody & text {k} abc\n\nMore {prose(k, 20)}"
        assert got[k].n_chars == len(got[k].text)
    assert got[100].text == "One\n\nOnly page\n\nThanks for reading our site!"
    assert got[101].text == "T\n\nP\n\nThanks for reading our site!"
    assert got[102].text == got[103].text == ""
    assert wrapper.main_text(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("html,want", [
    ("<div class=header>Top</div><div id=content><p>One<p>Two &lt;3<br>three</div><div class='footer-links'>x</div>", ["One", "Two <3 three"]),
    ("<body><main><h2>H</h2><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><pre>e  f</pre></main><p>out</p></body>", ["H", "a", "b", "c", "d", "e f"]),
    ("<article><header><h1>T</h1></header><p>x <a href=1>link</a> y</p><ul><li><a>only link</a></li></ul><blockquote>q</blockquote></article>", ["T", "x link y", "q"]),
    ("<p>a<!-- hidden --> b<script>if(a<b)</script></p><noscript>no</noscript>", ["a b"]),
    ("no markup at all", ["no markup at all"]),
    ("<article><p>open <b>bold<p>next</article", ["open bold", "next"]),
])
def test_blocks_of_odd_pages(html, want):
    assert wrapper.read_page(html)[0] == want


@pytest.mark.parametrize("html,want", [
    ("<article><section id='search-algorithms'><p>a</p></section><h2 id='related-work'>b</h2><p class='notice-of-terms'>c</p><h3 id='sharing-data'>d</h3><p data-id='login'>e</p></article>", list("abcde")),
    ("<article><ol><li><a href='#1'>Smith 2001</a></li></ol><table><tr><td><a href='x'>cell</a></td></tr></table></article>", ["Smith 2001", "cell"]),
    ("<article><p>a <button>Go</button> b</p><select><option>One</option><option>Two</option></select><textarea>t</textarea><label>L</label><dialog><p>D</p></dialog><fieldset><p>F</p></fieldset></article>", ["a b"]),
    ("<article><p>a</p><div class='ad-box'>x</div><div id='comments'><p>c</p></div><section class='newsletter signup'>n</section><nav>m</nav><aside>s</aside><p>z</p></article>", ["a", "z"]),
    ("<p>unclosed <label>rest</p><p>more</p>", ["unclosed rest", "more"]),
])
def test_content_and_furniture_inside_an_article(html, want):
    assert wrapper.read_page(html)[0] == want


def test_templates_of_short_pages_and_of_two_layouts(spark):
    """Constant blocks go however much of a page they are, in every layout of a host; rows that share an id, or have none, keep
    what is theirs."""
    notice = "This long notice stands on every page of the host, word for word, and is much longer than the articles are."
    rows = [(k, "https://short.example.com/%d" % k, f"<article><p>Text {k}</p><div><p>{notice}</p></div></article>") for k in range(6)]
    for k in range(6):
        rows.append((10 + k, "https://two.example.com/%d" % k, f"<article><h1>A {k}</h1><p>Said here {k}</p><p>Closing line.</p></article>"))
        rows.append((20 + k, "https://two.example.com/b%d" % k, f"<main><section><div><p>B text {k}</p></div><footer>f</footer></section><p>Closing line.</p></main>"))
    rows += [(3, "https://short.example.com/x", f"<article><p>p3 differs</p><div><p>{notice}</p></div></article>"), (None, "https://short.example.com/y", f"<article><p>no id</p><div><p>{notice}</p></div></article>")]
    got = sorted((str(r.page_id), r.url[-2:], r.text) for r in wrapper.main_text(spark.createDataFrame(rows, PAGES)).collect())
    want = [(str(k), f"/{k}", f"Text {k}") for k in range(6)] + [(str(10 + k), f"/{k}", f"A {k}\n\nSaid here {k}") for k in range(6)] + [(str(20 + k), f"b{k}", f"B text {k}") for k in range(6)]
    assert got == sorted(want + [("3", "/x", "p3 differs"), ("None", "/y", "no id")])


@pytest.mark.parametrize("page_text", ["<b" * 500_000, "<!" * 500_000, "<svg>" * 200_000, '<b "' * 250_000, "<div>" * 60_000 + "</p>" * 60_000, "<article>" + "<div>x" * 30_000])
def test_odd_pages_take_time_by_their_length(page_text):
    import time

    started = time.process_time()
    wrapper.read_page(page_text)
    assert time.process_time() - started < 5


def test_wide_pages_are_aligned_by_equal_children():
    import json

    a, b = (json.dumps(["body", [[f"p.{i + shift}", []] for i in range(3000)]]) for shift in (0, 7))
    assert wrapper.align(a, b) == (0, *[-1] * 7, *range(1, 2994))


@pytest.mark.parametrize("n", [40, 1200, 3000])
def test_alignment_does_not_depend_on_how_wide_pages_are(n):
    """Children that differ in one element each are matched at every width, with what else they hold."""
    import json

    wide = lambda s: json.dumps(["body", [["li", [["p", []], [f"x{s}.{i}", []]]] for i in range(n)]])
    assert wrapper.align(wide(0), wide(1)) == (0, *[k for i in range(n) for k in (3 * i + 1, 3 * i + 2, -1)])


def test_alignment():
    import json

    a = json.dumps(["body", [["nav", []], ["div", [["p", []]]], ["footer", []]]])
    b = json.dumps(["body", [["div", [["h1", []], ["p", []]]], ["aside", []], ["footer", []]]])
    assert wrapper.align(a, b) == (0, -1, 1, 3, 5)
    assert wrapper.align(a, json.dumps(["html", []])) == (-1,) * 5
    deep = "<div>" * 5000 + "x"
    assert wrapper.read_page(deep)[0] == ["x"]
