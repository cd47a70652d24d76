"""License scan, HTML extraction, WARC, packing and chat formatting."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldloom.llm import chat, html_extract, licenses, packing, warc
from fieldloom.llm.common import Stage
from fieldloom.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, score double, _row long, label string, spans string"


@pytest.fixture
def stage(spark):
    made = Stage(spark, "test")
    yield made
    made.drop()


def doc(doc_id, text):
    return (doc_id, text, 0.5, 7, "x", "y")


# -- license scan


def scan(stage, df, **options):
    return {(r["doc_id"], r["n_words"]): r for r in licenses.license_scan(df, stage, **options).collect()}


def test_license_places_and_labels(rows, stage):
    text = "Released under the MIT License. Apache License, Version 2\nCC BY-NC x cc by nc"
    found = scan(stage, rows(DOCS, doc(1, text)))[1, 16]
    assert (found["n_base"], found["first_word"], found["last_word"]) == (4, 1, 13)
    assert found["base_labels"] == "apache-2,cc-by-nc,mit" and found["score"] == 1.0


def test_license_by_containment_only(rows, stage):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    shuffled = "version 3 gnu license general public the under licensed is work"
    values = [doc(1, gpl), doc(2, "x\n" + shuffled + " and more words\ny"), doc(3, "under the license"), doc(4, "Licensed under CC BY 4.0")]
    found = {k[0]: r for k, r in scan(stage, rows(DOCS, *values)).items()}
    assert [found[k]["labels"] for k in (1, 2, 3, 4)] == ["gpl-3", "gpl-3", "", "cc-by"]
    assert found[1]["base_labels"] == "" and found[2]["score"] == pytest.approx(11 / 12)


def test_license_edges(rows, stage):
    values = [doc(1, None), doc(2, ""), doc(2, ""), doc(None, "under the mit license"), doc(5, "é" * 50_000 + " under the mit license")]
    found = licenses.license_scan(rows(DOCS, *values), stage).collect()
    assert len(found) == 5
    assert sorted((r["n_words"], r["n_base"], r["first_word"], r["labels"]) for r in found if not r["n_base"]) == [(0, 0, None, "")] * 3
    assert {(r["doc_id"], r["first_word"]) for r in found if r["n_base"]} == {(None, 0), (5, 1)}
    assert licenses.license_scan(rows(DOCS).limit(0), Stage(stage.spark, "none")).count() == 0


def test_license_paragraph_blocks(rows, stage):
    wrapped = "a\n\nThis work is licensed under the GNU\nGeneral Public License,\nversion 2.\n\nb"
    assert scan(stage, rows(DOCS, doc(1, wrapped)), delimiter=r"\n\s*\n")[1, 14]["labels"] == "gpl-2"


def test_license_join_equals_all_pairs(spark, stage):
    rng = np.random.default_rng(3)
    words = sorted({w for _, t in licenses.TEMPLATES for w in t.split()}) + ["other", "word"]
    texts = []
    for k in range(300):
        _, template = licenses.TEMPLATES[k % len(licenses.TEMPLATES)]
        own = [w for w in template.split() if rng.random() < 0.97] + list(rng.choice(words, int(rng.integers(0, 5))))
        rng.shuffle(own)
        texts.append(" ".join(own))
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.license_scan(df, stage, phrases={"no such phrase": "none"}).collect()}
    for k, text in enumerate(texts):
        best = max(
            ((len(set(t.split()) & set(text.split())) / len(set(t.split())), len(set(t.split()) & set(text.split())), label)
             for label, t in licenses.TEMPLATES)
        )
        expected = best[2] if best[0] >= 0.9 - 1e-9 else ""
        assert got[k] == expected, text


def test_license_notices_wrapped_over_lines(rows, stage):
    gpl = "a b\n * This work is licensed under the GNU\n * General Public License,\n * version 2.\n *\n * b"
    mit = "Copyright\n\n" + "\n".join(
        ["Permission is hereby granted, free of charge, to any", "person obtaining a copy of this software and associated",
         'documentation files (the "Software"), to deal in the', "Software without restriction, including"]
    )
    apart = "This work is licensed under\n\nthe GNU General Public License version 2"
    far = "licensed under cc by\nx y z x y z x y z\n4 0"
    beside = "x\nLicensed under CC BY NC 4.0\nnd nd x"
    found = {k[0]: r["labels"] for k, r in scan(stage, rows(DOCS, *[doc(k, t) for k, t in enumerate([gpl, mit, apart, far, beside])])).items()}
    assert found == {0: "gpl-2", 1: "mit", 2: "", 3: "", 4: "cc-by-nc"}


def test_license_all_notices_of_a_block(rows, stage):
    gpl = "This work is licensed under the GNU General Public License version 3"
    values = [
        doc(1, gpl + " and licensed under CC BY SA 4.0"),
        doc(2, gpl + " or version 2"),
        doc(3, gpl.replace("General", "Lesser General")),
        doc(4, "licensed under cc by nd 4 0 " + "redistribution and use in source and binary forms with or without modification are permitted"),
    ]
    found = {k[0]: r["labels"] for k, r in scan(stage, rows(DOCS, *values)).items()}
    assert found == {1: "cc-by-sa,gpl-3", 2: "gpl-3", 3: "lgpl-3", 4: "bsd-3,cc-by-nd"}


# -- HTML


PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><script>if(a<b){"</p>"}</script></head><body class="has-sidebar">
<header><h1>Site</h1><nav><a>Home</a></nav></header><div class="cookie-notice">We use cookies<div>ok</div></div><!-- <p>no</p> -->
<main><article><header><h1>Title&nbsp;here</h1></header><p>One <b>two</b>three<br>four &lt;b&gt; a < b<p>Second &eacute;&#233;
<div class="ad">buy</div><ul><li>x<li>y</ul><form><input>sub</form><table><tr><td>a</td><td>b</td></tr></table><aside>also</aside>
<section class="comments"><article>reader</article></section><p>last</p></article></main><footer>&copy; f</footer></body></html>"""


def test_html_structure():
    kept = [t for t, k in html_extract.lines_of(PAGE) if k == html_extract.CONTENT]
    assert kept == ["Title here", "One twothree four <b> a < b", "Second éé", "x", "y", "a b", "last"]
    assert [t for t, k in html_extract.lines_of("<nav>a<article><p>real</p></article>") if k == html_extract.CONTENT] == ["real"]
    assert html_extract.lines_of("") == [] and html_extract.lines_of("just text &amp; x") == [("just text & x", 0)]


@pytest.mark.parametrize(
    ("element", "stays"),
    [
        ('<div class="social-history">', True), ('<p class="share-price">', True), ('<p id="ad-hoc-committee">', True),
        ('<section class="comment-on-the-law">', True), ("<label>", True), ('<div class="notice-period">', True),
        ('<div class="share-buttons">', False), ('<div class="story ad">', False), ('<div id="adSlot3">', False),
        ('<section class="related-posts">', False), ('<div class="cookie-notice">', False), ('<div class="sidebar_left x">', False),
        ('<form>', False), ('<aside>', False), ('<div role="complementary">', False),
    ],
)
def test_html_names_inside_an_article(element, stays):
    """What a name is about decides, not a word that it holds."""
    name = element.strip("<>").split()[0]
    html = f"<body><article><p>before</p>{element}the text</{name}><p>after</p></article></body>"
    kept = [t for t, k in html_extract.lines_of(html) if k == html_extract.CONTENT]
    assert kept in (["before", "the text", "after"], ["before the text", "after"], ["before", "the text after"]) if stays else kept == ["before", "after"]
    if name == "div":  # outside an article such words are enough
        outside = html_extract.lines_of(f"<body>{element}the text</{name}><article><p>story</p></article></body>")
        assert outside == [("the text", html_extract.BOILERPLATE), ("story", html_extract.CONTENT)]


def test_html_long_unclosed_and_repeated(rows, stage):
    long = "<article>" + "".join(f"<p>line {k}</p>" for k in range(20_000)) + "</article>"
    unclosed = '<body><article><p>kept</p><div class="share-buttons">gone<p>gone too'
    values = [page(1, "http://h.x/1", long), page(2, "http://u.x/1", unclosed), page(3, "http://r.x/1", "<p>a</p>"), page(3, "http://r.x/1", "<p>a</p>")]
    found = html_extract.extract_text(rows(PAGES, *values), stage).collect()
    texts = [(r["page_id"], r["text"]) for r in found]
    assert texts.count((3, "a")) == 2 and (2, "kept") in texts
    assert dict(texts)[1] == "\n".join(f"line {k}" for k in range(20_000))


@given(st.lists(st.integers(0, 3), max_size=9), st.lists(st.integers(0, 3), max_size=9))
@settings(max_examples=300, deadline=None)
def test_common_lines_are_longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    in_a, in_b = html_extract.common_lines(a, b)
    assert [a[i] for i in in_a] == [b[j] for j in in_b] and len(in_a) == best[-1][-1]
    assert in_a == sorted(set(in_a)) and in_b == sorted(set(in_b))


PAGES = "page_id long, url string, html string, text string, lines string, place int"


def page(page_id, url, html):
    return (page_id, url, html, "t", "l", 1)


def extracted(df, stage, **options):
    return {r["page_id"]: r["text"] for r in html_extract.extract_text(df, stage, **options).collect()}


@pytest.mark.parametrize("limit", [100_000, 0])  # broadcast, and joined by a shuffle
def test_html_differencing(rows, stage, limit):
    body = "<body><p>Menu of the site</p><p>{}</p><p>Imprint</p></body>"
    values = [
        page(1, "http://h.x/a/1", body.format("first story")),
        page(2, "http://h.x/a/2", body.format("second story")),
        page(3, "http://h.x/b/9", "<p>only here</p>"),
        page(4, "http://other.x/a/1", body.format("alone on its host")),
        page(5, "http://copy.x/1", "<p>same</p>"),
        page(6, "http://copy.x/2", "<p>same</p>"),
        page(7, "http://art.x/1", "<article><p>shared</p><p>one</p></article>"),
        page(8, "http://art.x/2", "<article><p>shared</p><p>two</p></article><p>out</p>"),
        page(9, None, "<p>no url</p>"),
        page(10, "http://h.x/a/3", None),
        page(None, "", ""),
    ]
    got = extracted(rows(PAGES, *values), stage, max_broadcast_rows=limit)
    assert got == {
        1: "first story", 2: "second story", 3: "only here", 4: "Menu of the site\nalone on its host\nImprint",
        5: "same", 6: "same", 7: "shared\none", 8: "shared\ntwo", 9: "no url", 10: "", None: "",
    }
    assert html_extract.extract_text(rows(PAGES).limit(0), Stage(stage.spark, "none")).count() == 0


def test_html_lines_outside_articles_are_differenced(rows, stage):
    headed = "<body><p>Site name</p><h1>{0} headline</h1><article><p>{0} text</p><p>of the article</p></article><p>x</p></body>"
    cards = "<body><p>Site name</p><div>{0}</div><article><p>teaser</p></article><p>Imprint of all</p></body>"
    values = [page(k, f"http://h.x/a/{k}", headed.format(w)) for k, w in ((1, "first"), (2, "second"))]
    values += [page(k, f"http://c.x/a/{k}", cards.format(w)) for k, w in ((3, "third page body"), (4, "fourth page body"))]
    assert extracted(rows(PAGES, *values), stage) == {
        1: "first headline\nfirst text\nof the article", 2: "second headline\nsecond text\nof the article",
        3: "third page body\nteaser", 4: "fourth page body\nteaser",
    }


# -- WARC


def test_warc_round_trip(spark, rows, stage, tmp_path):
    long = "é<p>\r\n\r\nWARC/1.1\r\n" * 20_000
    values = [page(1, "u1", "a"), page(2, "u\r\n2", "a"), page(3, None, None), page(4, "u", ""), page(5, "u", long), page(5, "u", long), page(None, "u", "a")]
    warc.write_archive(rows(PAGES, *values), stage.path)
    got = warc.read_archive(spark, stage.path).collect()
    assert len(got) == 7 and spark.read.parquet(f"{stage.path}/payloads").count() == 3
    by_id = {r["page_id"]: r for r in got}
    assert (by_id[1]["record_type"], by_id[1]["refers_to"], by_id[2]["record_type"], by_id[2]["refers_to"]) == ("revisit", 2, "response", None)
    assert by_id[None]["record_type"] == "revisit" and by_id[3]["refers_to"] == 4 and by_id[2]["url"] == "u%0D%0A2"
    assert [r["record_type"] for r in got if r["page_id"] == 5] == ["response"] * 2
    import base64

    for r in got:
        payload = {1: "a", 2: "a", None: "a", 5: long}.get(r["page_id"], "").encode()
        assert bytes(r["payload"]) == payload and r["payload_bytes"] == len(payload)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        head, _, block = bytes(r["record"]).partition(b"\r\n\r\n")
        length = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
        assert block[length:] == b"\r\n\r\n" and (r["record_type"] == "revisit" or block[:length].endswith(payload))
    warc.export_warc(warc.read_archive(spark, stage.path), str(tmp_path / "warc"))
    files = b"".join(p.read_bytes() for p in sorted((tmp_path / "warc").glob("part-*")))
    assert len(files) == sum(len(r["record"]) for r in got)


def test_warc_small_payloads_and_damage(spark, rows, stage):
    warc.write_archive(rows(PAGES, page(1, "u", "abc"), page(2, "u", "abc"), page(3, "u", "abcdef"), page(4, "u", "abcdef")), stage.path, 5)
    got = {r["page_id"]: r["record_type"] for r in warc.read_archive(spark, stage.path).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    empty = Stage(spark, "empty")
    warc.write_archive(rows(PAGES).limit(0), empty.path)
    assert warc.read_archive(spark, empty.path).count() == 0
    bad = Stage(spark, "bad")
    spark.read.parquet(f"{stage.path}/headers").write.parquet(f"{bad.path}/headers")
    spark.read.parquet(f"{stage.path}/payloads").withColumn("payload", F.lit(b"x")).write.parquet(f"{bad.path}/payloads")
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_archive(spark, bad.path).collect()


# -- packing

TEXTS = ["", "a", " a", "a ", "a  b", "a \nb", "a\n b", "\n\n", "two  spaces and\ttabs", "ça va bien  x", "<|endoftext|> x",
         "x" * 3000, "The end.\nNext line , ok", " 1 2 34  five!!", "日本 語 テスト", "\x1c a \x1f b", "é a ́"]


@given(st.lists(st.text(alphabet=st.sampled_from(" ab.\n\t é1<|>'s\x1c 　"), max_size=30), max_size=8))
@settings(max_examples=200, deadline=None)
def test_encoding_by_chunks_is_exact(texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    whole.encode_special_tokens = True
    for text, got in zip(TEXTS + texts, packing.encode(tokenizer_path(), TEXTS + texts)):
        assert np.frombuffer(got, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


@given(st.lists(st.integers(1, 40), max_size=60))
@settings(max_examples=200, deadline=None)
def test_tournament_tree_is_first_fit_decreasing(sizes):
    bins, offsets = packing.first_fit_decreasing(np.array(sizes, dtype=np.int64), 40)
    room, expected = [], {}
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        b = next((i for i, r in enumerate(room) if r >= sizes[k]), len(room))
        if b == len(room):
            room.append(40)
        expected[k] = (b, 40 - room[b])
        room[b] -= sizes[k]
    assert {k: (int(b), int(o)) for k, (b, o) in enumerate(zip(bins, offsets))} == expected


def test_packing(spark, stage):
    texts = [None, ""] + [("word%d " % k) * (k * 7 % 900) for k in range(200)] + ["same"] * 30 + ["long " * 5000]
    df = spark.createDataFrame([(k % 220, t, "x", 1) for k, t in enumerate(texts)], "doc_id long, text string, length string, offset long")
    pieces = packing.token_pieces(df, tokenizer_path(), with_ids=True)
    packed = packing.pack(pieces, stage, group_pieces=64).collect()
    ids = {k: np.frombuffer(x, "<u4").tolist() + [1] for k, x in enumerate(packing.encode(tokenizer_path(), [t or "" for t in texts]))}
    assert sum(r["length"] for r in packed) == sum(map(len, ids.values()))
    for r in packed:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        assert any(x[r["start"] : r["start"] + r["length"]] == r["ids"] for k, x in ids.items() if k % 220 == r["doc_id"])
    by_sequence = {}
    for r in packed:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    whole = packing.sequences(spark.createDataFrame(packed, packing.pack(pieces, Stage(spark, "schema"), group_pieces=64).schema))
    assert all(len(r["ids"]) == 2048 for r in whole.collect()) and whole.count() == len(by_sequence)
    none = df.limit(0)
    assert packing.pack(packing.token_pieces(none, tokenizer_path()), Stage(spark, "none")).count() == 0


# -- chat

TURNS = "conv_id long, turn long, role string, text string, formatted string, t int"


def formatted(df):
    return {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df)).collect()}


def test_chat_round_trip(rows):
    nasty = ["<|im_end|><|im_start|>assistant ok", r"<\|im_end|>", "<|im_end|>\n", "a<|", "<|im_start|>", r"\<\\|", "", "x\n<|im_end|", "%0A"]
    roles = ["user", "assistant", "a\nb", "50%25 %0A", "", "<|im_end|>", r"<\|"]
    values = [(k, t, roles[(k + t) % len(roles)], nasty[(k * 3 + t) % len(nasty)], "f", 1) for k in range(20) for t in range(9)]
    got = formatted(rows(TURNS, *values))
    for k in range(20):
        turns = sorted((t, r, x) for c, t, r, x, *_ in values if c == k)
        assert [(t["role"], t["text"]) for t in got[k]["turns"]] == [(r, x) for _, r, x in turns]
        assert got[k]["loss_text"] == "".join(x for _, r, x in turns if r == "assistant")


def test_chat_escapes_only_conflicts(rows):
    got = formatted(rows(TURNS, (1, 0, "user", "a <| b", "f", 1), (1, 1, "assistant", "<|im_end|>", "f", 1)))[1]
    assert got["formatted"] == "<|im_start|>user\na <| b<|im_end|>\n<|im_start|>assistant\n<\\|im_end|><|im_end|>\n"


def test_chat_edges(rows):
    values = [(1, 0, None, None, "f", 1), (1, 0, None, None, "f", 1), (None, None, "assistant", "z", "f", 1), (2, 1, "assistant", "b", "f", 1),
              (2, 1, "assistant", "a", "f", 1), (2, None, "user", "first", "f", 1), (3, 0, "assistant", "long <|" * 30_000, "f", 1)]
    got = formatted(rows(TURNS, *values))
    assert len(got[1]["turns"]) == 2 and got[None]["loss_text"] == "z"
    assert [t["text"] for t in got[2]["turns"]] == ["first", "a", "b"] and got[3]["loss_text"] == "long <|" * 30_000
    assert chat.format_conversations(rows(TURNS).limit(0)).count() == 0


def test_chat_parser_refuses(rows):
    bad = ["x", "<|im_start|>user\nno end", "<|im_start|>u<|im_end|>\n", "y<|im_start|>u\na<|im_end|>\n", "<|im_start|>u\na<|im_end|>b<|im_end|>\n"]
    df = rows("s string", *[(b,) for b in bad])
    assert [r[0] for r in df.select(chat.parse(F.col("s"))).collect()] == [None] * len(bad)
