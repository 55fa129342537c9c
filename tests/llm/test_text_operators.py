"""Encoding, extraction, line dedup, quality and chat against brute force; edge cases."""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlab.llm import bpe, chat, html_extract, line_dedup, quality

tokenizers = pytest.importorskip("public_tokenizers")
RANKS = tokenizers.path("byte_bpe_50k.tiktoken")
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "word " * 30_000), (6, "same text"), (7, "same text"), (7, "same text"), (None, "no id")]


def reference_encoding():
    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


# ------------------------------------------------------------ encoding
ENC, TABLE = reference_encoding()
UNITS, TOKENS = bpe.cutter(tokenizers.PATTERN)


def encode_alone(text: str) -> list[int]:
    return [i for u in UNITS(text.encode()) for t in TOKENS(u) for i in bpe.merge_bytes(t, TABLE)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab cD1'.,;\n\t\r\x0b\x1c\x85\xa0 　éß中\U0001F600́'sll~#", max_size=40))
def test_cutting_and_merging_equal_the_library(text):
    assert encode_alone(text) == ENC.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 700, "ab" * 300, "é" * 400, " " * 300, "xyz1" * 200, "\n\n\n x"])
def test_long_runs_equal_the_library(text):
    assert encode_alone(text) == ENC.encode_ordinary(text)


def test_encode_and_decode_whole_documents(spark, docs_of, corpus):
    rows = EDGES + [(i + 100, t) for i, t in corpus]
    coded = bpe.encode(docs_of(rows), RANKS, tokenizers.PATTERN, block_bytes=60_000)
    got = bpe.decode(coded, RANKS).collect()
    seen = Counter((r.id, tuple(np.frombuffer(r.ids, "<u4").tolist()), bytes(r.decoded), r.n_tokens) for r in got)
    want = Counter()
    for i, t in rows:
        ids = ENC.encode_ordinary(t or "")
        want[i, tuple(ids), (t or "").encode(), len(ids)] += 1
    assert seen == want


def test_encoding_an_empty_table(docs_of):
    assert bpe.digests(docs_of([]), RANKS, tokenizers.PATTERN).count() == 0


def test_unknown_ids_are_an_error(spark):
    bad = spark.createDataFrame([(bytearray(np.array([60_000], "<u4").tobytes()),)], "ids binary")
    with pytest.raises(Exception, match="60000"):
        bpe.decode(bad, RANKS).collect()


# ------------------------------------------------------------ extraction
PAGE = ("<html><head><title>t</title><script>var a='<p>no</p>'</script></head><body><header><h1>Site</h1></header>"
        "<nav><a href=/>menu</a></nav><div id='cookie-notice'>We use cookies, ok, yes</div><div class=main><article>"
        "<header><h1>Title</h1></header><p>One, two, and text long enough to score &amp;amp; more.</p>"
        "<p>Unclosed <b>bold<br>line<p>Next  \n para</p><ul><li>item</li></ul><div class='ad'>Buy, buy</div>"
        "<form><p>form, text</p></form><section class=comments><p>reader, says, so</p></section></article>"
        "<aside>side, bar</aside></div><footer>f</footer></body></html>")


def test_article_parts_are_kept_and_others_cut():
    assert html_extract.main_blocks(PAGE) == [
        "Title", "One, two, and text long enough to score &amp; more.", "Unclosed bold line", "Next para", "item"]


def test_pages_without_an_article_element():
    page = ("<body><div class=menu><ul><li><a href=1>a</a></ul></div><div id=content><h2>Head</h2><p>One, two, three and "
            "some more words.<p>Second &lt;b&gt; paragraph.</div><div class=sidebar><p>Side, bar, with, commas</p></div>")
    assert html_extract.main_blocks(page) == ["Head", "One, two, three and some more words.", "Second <b> paragraph."]


LONG = "The article, which has several clauses, goes on for a while, as articles do, and on."


@pytest.mark.parametrize("name", ["post-comments", "article-comments", "entry-share", "main-sidebar", "related-content",
                                  "sponsored-content", "story-newsletter", "content-nav"])
def test_parts_beside_the_article_named_after_it(name):
    page = (f"<body><div class=post><h1>Head</h1><p>{LONG}</p><p>{LONG}</p><div class='{name}'><p>Not this, surely, no.</p></div></div>"
            f"<section id={name}><p>Nor this, or that.</p></section></body>")
    assert html_extract.main_blocks(page) == ["Head", LONG, LONG]


def test_long_reader_comments_go_and_mixed_layout_names_stay():
    many = "".join(f"<p>A reader says, at length, {LONG}</p>" for _ in range(9))
    page = f"<div class='content with-sidebar'><p>{LONG}</p><p>{LONG}</p></div><div class='post-comments'>{many}</div>"
    assert html_extract.main_blocks(page) == [LONG, LONG]
    assert html_extract.main_blocks(f"<div class='has-sidebar'><p>{LONG}</p></div>") == [LONG]


@pytest.mark.parametrize("page", [
    f"<!DOCTYPE html><html><head><title>T</title><meta charset=utf-8><p>{LONG}</p></html>",
    f"<title>T</title><link rel=x><h1>Head</h1><p>{LONG}",
    f"<head><script>x</script><div class=post><p>{LONG}</p></div>"])
def test_pages_without_end_of_head_and_body(page):
    assert html_extract.main_blocks(page)[-1] == LONG and "T" not in html_extract.main_blocks(page)


def test_a_form_around_the_page_and_one_in_it():
    inner = f"<article><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></article><form><label>Mail</label><p>Join us, now.</p><input></form>"
    page = f"<body><form id=aspnet method=post><input type=hidden><nav><p>Menu, menu, menu</p></nav>{inner}<select><option>x</select></form></body>"
    assert html_extract.main_blocks(page) == ["Head", LONG, LONG]
    assert html_extract.main_blocks(f"<body>{inner}</body>") == ["Head", LONG, LONG]


@pytest.mark.parametrize("piece", ["<div>a,", "<div><p>a, b", "<i><div>a</b>", "<span>a,", "<li>a<ul>", "<div></section>", "<i><div><b>x</i>",
                                   "<td>a<table>", "<div>a<span>"])
def test_time_is_proportional_to_length(piece):
    import time

    def seconds(n):
        start = time.process_time()
        html_extract.main_blocks(piece * n)
        return time.process_time() - start

    seconds(1000)
    assert seconds(40_000) < 9 * seconds(10_000) + 0.5


def test_extraction_over_the_table(spark, sf_dir):
    import html

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[a-zA-Z/][^>]*>", "", b.replace("<br>", " "))).split())
                  for b in re.split(r"</?(?:p|h1)\b[^>]*>", article)]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


def test_extraction_edges(spark):
    deep = "<div>" * 3000 + "<p>down, here</p>"
    rows = [(1, None), (2, ""), (3, "  "), (4, "plain text &eacute;"), (5, "<p>a < b & c</p>"), (6, "<p>" + "long, " * 50_000), (7, deep)]
    df = spark.createDataFrame([(i, h, "old") for i, h in rows], "page_id long, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(df).collect()}
    assert [got[i] for i in range(1, 6)] == [("", 0)] * 3 + [("plain text é", 12), ("a < b & c", 9)]
    assert got[6][1] == len("long, " * 50_000) - 1 and got[7][0] == "down, here"
    assert html_extract.extract(df.limit(0)).count() == 0


# ------------------------------------------------------------ line dedup
def lines_by_hand(rows, min_chars=40, min_docs=5):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                held[key(x)].add(i)
    keep = {k: max((i for i in v if i is not None), default=None) for k, v in held.items() if len(v) >= min_docs}
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if key(x) not in keep or keep[key(x)] == i]
        out[i, "\n".join(stay), len(lines), len(lines) - len(stay)] += 1
    return out


@pytest.mark.parametrize("bits", [1 << 20, 1 << 24])
def test_lines_against_brute_force(docs_of, corpus, bits):
    shared = "A line that Many documents share, long enough ééé"
    rows = EDGES + [(i + 100, t) for i, t in corpus]
    rows += [(1000 + i, f"own {i}\n  {shared.upper() if i % 2 else shared}\t\n{shared}\nshort") for i in range(9)]
    rows += [(2000 + i, shared + " four") for i in range(4)] + [(None, shared)]
    got = line_dedup.dedup_lines(docs_of(rows), filter_bits=bits).collect()
    assert Counter((r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in got) == lines_by_hand(rows)
    assert got[0]["keys"] == "x"  # a column of the input by the operator's inner name


def test_lines_of_an_empty_table(docs_of):
    assert line_dedup.dedup_lines(docs_of([])).count() == 0


# ------------------------------------------------------------ quality
def features_by_hand(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if runs[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def test_features_against_brute_force(corpus):
    texts = [t for _, t in EDGES + corpus] + ["a b c d e a b c d e", "x y\nx y\n \nx y", "é# 中中\né#", "q " * 40]
    got = quality.count_features([(t or "").encode() for t in texts])
    for i, t in enumerate(texts):
        want = features_by_hand(t)
        assert {k: int(got[k][i]) for k in want} == want


def test_upper_bound_is_the_exact_binomial_bound():
    assert quality.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** (1 / 100), abs=1e-6)
    assert quality.upper_bound(5, 100, 0.05) == pytest.approx(0.10225, abs=1e-4)
    assert quality.upper_bound(7, 7, 0.05) == 1.0


def test_cutoffs_control_false_rejection():
    few = [("en", r, 0, 40) for r in quality.RULES]
    assert quality.choose_cutoffs(few, 0.02, 0.05) == {}  # nothing can be certified
    many = [("en", r, b, n) for r in quality.RULES for b, n in ((0, 20_000), (10, 500), (60, 1))]
    cuts = quality.choose_cutoffs(many, 0.02, 0.05)
    assert {cuts["en", r] for r in quality.RULES} == {10}  # bin 10 holds too many good documents to go


def test_joint_cutoffs_need_few_labels():
    # four languages with 217 clean documents each; a fifth has too few to be tested and costs no level
    clean = [(s, r, 0, 217) for s in ("en", "fr", "de", "es") for r in quality.RULES] + [("xx", r, 0, 40) for r in quality.RULES]
    assert quality.least_good(0.02, 0.05 / 4) == 217
    assert quality.choose_cutoffs(clean, 0.02, 0.05) == {(s, r): 0 for s in ("en", "fr", "de", "es") for r in quality.RULES}
    assert quality.choose_cutoffs([("en", r, 0, 148) for r in quality.RULES], 0.02, 0.05) == {}


def test_most_rejected_follows_the_bound_and_tests_stay_within_the_level():
    for n in (100, 217, 1000, 5000):
        k = quality.most_rejected(n, 0.02, 0.0125)
        assert k < 0 or quality.upper_bound(k, n, 0.0125) <= 0.02
        assert quality.upper_bound(k + 1, n, 0.0125) > 0.02
    # at 200 documents each, four strata cannot be tested at delta / 4; two of them can at delta / 2
    cuts = quality.choose_cutoffs([(s, r, 0, 200) for s in "abcd" for r in quality.RULES], 0.02, 0.05)
    assert {s for s, _ in cuts} == {"a", "b"}


def test_joint_rejection_stays_under_alpha():
    # each rule alone would lose 1.2 % of the good documents, all together 6 %
    some = [("en", r, b, n) for r in quality.RULES for b, n in ((0, 9_880), (30, 120))]
    cuts = quality.choose_cutoffs(some, 0.02, 0.05)
    assert sum(120 for r in quality.RULES if cuts["en", r] < 30) <= 200


def test_sequence_starts_with_what_marks_bad_documents():
    bad = {r: np.bincount([0] * 40, minlength=quality.BINS + 1) for r in quality.RULES}
    rest = {r: np.bincount([0] * 900 + [20] * 100, minlength=quality.BINS + 1) for r in quality.RULES}
    bad["symbols"] = np.bincount([100] * 40, minlength=quality.BINS + 1)
    rest["symbols"] = np.bincount([0] * 900 + [100] * 100, minlength=quality.BINS + 1)
    steps = quality.sequence(bad, rest)
    assert steps[:100] == [("symbols", c) for c in range(99, -1, -1)]
    assert sorted(steps) == sorted((r, c) for r in quality.RULES for c in range(100))
    for r in quality.RULES:
        assert [c for x, c in steps if x == r] == list(range(99, -1, -1))


def test_small_languages_get_cutoffs(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(2000):
        bad = i % 8 == 0
        text = " ".join(f"w{rng.randrange(10_000)}" + ("#" if bad else "") for _ in range(20))
        rows.append((i, text, "en" if i % 2 else "fr"))
        if i % 3:
            labels.append((i, 0 if bad else 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.id: r.kept for r in quality.judged(docs, marks).collect()}
    assert all(got[i] == (i % 8 != 0) for i in got)


def test_quality_over_a_fixture(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]
    rows, labels = [], []
    for i in range(4000):
        bad = i % 10 == 0
        text = " ".join(rng.choice(words) + str(rng.randrange(10_000)) + ("***" if bad else "") for _ in range(20))
        rows.append((i, text, "en" if i % 4 else None))
        if i % 2 == 0 or not bad:
            labels.append((i, 0 if bad else 1))
    rows += [(9001, None, "en"), (9002, "", "xx"), (None, "too short", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels + [(123_456, 1), (0, 1)], "doc_id long, quality int")
    got = {r.id: r.kept for r in quality.judged(docs, marks, alpha=0.05).collect()}
    assert all(got[i] == (i % 10 != 0) for i in range(4000) if i % 4)
    assert not got[9001] and not got[9002] and not got[None]
    kept = quality.quality_filter(docs, marks, alpha=0.05)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, k in got.items() if k}
    assert quality.judged(docs.limit(0), marks).count() == 0
    no_labels = quality.judged(docs, marks.limit(0)).where("kept").count()
    assert no_labels == 4000  # only the base rules hold


# ------------------------------------------------------------ chat
@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab\\<[ls|>/\n", max_size=20))
def test_escapes_are_reversible(text):
    out = text.replace("\\", "\\b").replace("<", "\\l").replace("[", "\\s")
    assert "<" not in out and "[" not in out
    assert out.replace("\\s", "[").replace("\\l", "<").replace("\\b", "\\") == text


def turns_fixture(spark):
    rng = random.Random(5)
    rows = []
    for c in range(12):
        if c % 3 == 0:
            rows.append((c, 0, "system", "be brief <|im_end|>"))
        for t in range(1, rng.randrange(2, 60)):
            rows.append((c, t, "user" if t % 2 else "assistant", " ".join(["w\\l<|im_start|>[x]"] * rng.randrange(0, 40))))
    rows += [(50, None, None, None), (50, 3, "assistant", ""), (50, 3, "assistant", ""), (None, 0, "user", "a"), (None, 1, "assistant", "b"),
             (51, 0, "user", "long " * 20_000), (51, 1, "assistant", "ok")]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_windows_read_back_and_budget(spark):
    rows, df = turns_fixture(spark)
    windows = chat.format_windows(df, budget=256, history_turns=2)
    back = defaultdict(list)
    for r in chat.read_back(windows).collect():
        back[r.conv_id].append((r.pos, r.role, r.text, r.loss))
    want = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        want[c].append((len(want[c]), role or "", text or "", role == "assistant"))
    assert {c: sorted(v) for c, v in back.items()} == dict(want)
    for w in windows.collect():
        own = [s for s in w.segments if not s.repeated]
        past = [s for s in w.segments if s.repeated]
        tokens = [len(w.formatted[s.text_at:s.text_at + s.text_len].split()) + 4 for s in own]
        assert sum(tokens) <= 256 or max(tokens) > 128
        assert not any(s.loss for s in past) and len(past) <= 3
        if own[0].pos > 0 and any(s.pos == 0 and w.formatted[s.role_at:].startswith("system") for s in past):
            assert w.formatted.startswith(chat.START + "system")
        assert w.formatted.count(chat.START) == len(w.segments)


def test_no_conversations(spark):
    assert chat.format_windows(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_chat_query_digest(spark, sf_dir):
    got = {r.conv_id: r for r in chat.op8_chat_formatting(spark, sf_dir).collect()}
    assert got[-1].n_turns == 2 and got[-1].loss_sha256 == hashlib.sha256(chat.SPECIAL.encode()).hexdigest()
