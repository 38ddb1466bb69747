"""HTML extraction, token counts, language ID, fingerprints, chat formatting and quality scores."""

import collections
import hashlib
import html
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from pulselens.llm import chat, cws, htmltext, langid, quality, queries, stages, textkit, tokencount
from tests.conftest import SF001
from tests.llm.conftest import make_docs, sentence

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ---------------------------------------------------------------- token counts

@pytest.fixture(scope="module")
def counter():
    with open(BPE, "rb") as f:
        return tokencount.Counter(f.read(), room=1000)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BPE)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="ab 's't\n\t\x0b\x1c\x85　é日1<|endoftext|>", max_size=40))
def test_counts_equal_the_library(counter, library, text):
    assert counter.tokens(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_special_strings_and_long_pieces(counter, library):
    for text in ("a<|endoftext|>b<|endoftext|>", "<|endoftext|>", "x" * 30_000, "ab" * 10_000 + " " * 5000, "<|endoftext|" * 9):
        assert counter.tokens(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_merging_by_hand():
    v = object.__new__(tokencount.Vocabulary)
    v.symbol = list(range(256))
    v.merge = {(97, 98): (1, 300), (300, 97): (0, 301), (98, 97): (2, 302)}
    # aba ba: "ab" has the lower rank of the first pairs, then "ab"+"a" merges at once
    assert tokencount.merged_length(b"aba", v) == 1
    assert tokencount.merged_length(b"baba", v) == 2
    assert tokencount.merged_length(b"", v) == 0 and tokencount.merged_length(b"a", v) == 1


def test_token_table(messy, none, messy_rows, library):
    got = sorted((tuple(r) for r in tokencount.count_tokens(messy, BPE, limit=50).collect()), key=str)
    want = []
    for i, t, _, _ in messy_rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 50))
    assert got == sorted(want, key=str)
    assert tokencount.count_tokens(none, BPE).collect() == []


# ---------------------------------------------------------------- language ID

def test_parts_of_long_words():
    texts = ["a" * 64, "b" * 65 + " c", "\u00e9" * 100, "\u65e5" * 50 + "x", "short"]
    data, at = textkit.utf8(pa.array(texts))
    s, e, _ = textkit.words(data, at, textkit.NON_LETTERS)
    x, y, word = langid.parts(data, s, e)
    assert (y - x <= langid.PART + 3).all() and (y > x).all() and len(set(word.tolist())) == len(s)
    got = [data[a:b].tobytes().decode() for a, b in zip(x, y)]
    assert ["".join(g for g, w in zip(got, word) if w == i) for i in range(len(s))] == [t for t in " ".join(texts).split()]


def test_unbroken_texts_take_linear_time():
    pieces = [b" ", *(bytes([c]) for c in range(97, 123)), b"ab", b" ab", b"\xe6\x97\xa5"]
    scorer = langid._Scorer((pieces, ["x", "y"], np.full((len(pieces), 2), 1 / len(pieces))))
    r = random.Random(4)
    text = "".join(r.choice("ab\u65e5") for _ in range(500_000))
    t0 = time.perf_counter()
    best, post = scorer.texts(pa.array([text, "ab"]))
    assert time.perf_counter() - t0 < 20 and best.tolist() == [0, 0] and post == pytest.approx([0.5, 0.5])


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(0)
    pieces = [b" ", b" a", b"a", b"ab", b"aba", b"b", b"ba"]
    prob = rng.random((len(pieces), 2))
    prob /= prob.sum(axis=0)
    trie = langid.Trie(pieces)
    r = random.Random(2)
    texts = [b" " + bytes(r.choice(b"abc") for _ in range(r.randint(0, 70))) for _ in range(60)]

    def plain(text, k):
        p = {x: prob[i, k] for i, x in enumerate(pieces)}
        f = [1.0] + [0.0] * len(text)
        for i in range(len(text)):
            f[i + 1] += f[i] * langid.BYTE_FLOOR
            for j in range(i + 1, len(text) + 1):
                f[j] += f[i] * p.get(text[i:j], 0)
        return np.log(f[-1])
    got = langid.forward(trie, prob, texts)
    for x, row in zip(texts, got):
        assert row == pytest.approx([plain(x, 0), plain(x, 1)])


def test_em_raises_the_likelihood():
    r = random.Random(1)
    words = collections.Counter(bytes(r.choice(b"aabbc") for _ in range(r.randint(1, 6))) for _ in range(300))
    pieces = [b" ", b"a", b"b", b"c", b"ab", b" a", b"bc", b"aab"]
    total = []
    for rounds in (1, 2, 4):
        _, prob = langid.fit({"x": dict(words)}, pieces, rounds)
        f = langid.forward(langid.Trie(pieces), prob, [b" " + w for w in words])
        total.append(float((f[:, 0] * np.array(list(words.values()))).sum()))
    assert total[0] < total[1] < total[2]


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op3_language_id(spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    assert len(got) == len(docs)
    assert all(got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2) for d in docs)
    out = [d for d in docs if got[d.doc_id].held_out]
    assert sum(got[d.doc_id].lang_pred == d.lang for d in out) >= 0.95 * len(out)
    assert all(0 <= got[d.doc_id].score <= 1 for d in docs)


def test_language_of_odd_texts(spark, messy, none, messy_rows):
    pieces = langid.vocabulary(PIECES)
    model = (pieces, *langid.learn(messy, pieces))
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in langid.identify(messy, model).collect()), key=str)
    want = sorted(((i, any(c.isalpha() for c in t or "")) for i, t, _, _ in messy_rows), key=str)
    assert sorted(((i, p != "und") for i, p, _ in got), key=str) == want
    assert all(p in ("de", "en", "und") and 0 <= s <= 1 for _, p, s in got)
    assert langid.identify(none, model).collect() == []
    untaught = (pieces, *langid.learn(none, pieces))
    assert {r.lang_pred for r in langid.identify(messy, untaught).collect()} == {"und"}
    # equally likely languages: the first; two languages of the same texts
    twin = make_docs(spark, [(i, "alpha beta gamma", x, "s") for i, x in enumerate(["zz", "aa"])])
    model = (pieces, *langid.learn(twin, pieces))
    assert {(r.lang_pred, r.score) for r in langid.identify(twin, model).collect()} == {("aa", 0.5)}


def test_language_stage(spark, messy, none, messy_rows):
    got = stages.language_id(spark, messy, "")
    assert got.schema.names == messy.schema.names
    assert {r.doc_id for r in got.collect()} <= {i for i, t, _, _ in messy_rows if any(c.isalpha() for c in t or "")}
    assert stages.language_id(spark, none, "").collect() == []


# ---------------------------------------------------------------- fingerprints

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def jaccard(a, b):
    x, y = collections.Counter(WORDS.findall(a)), collections.Counter(WORDS.findall(b))
    whole = sum((x | y).values())
    return sum((x & y).values()) / whole if whole else 1.0


def test_collision_rate_is_generalised_jaccard():
    r = random.Random(9)
    for share in (0, 3, 7, 10):
        a = [sentence(r, 60, "abc") for _ in range(8)]
        b = [" ".join(x.split()[:6 * share] + sentence(r, 60 - 6 * share, "abc").split()) for x in a]
        near = cws.likeness(cws.signatures(pa.array(a), 2048), cws.signatures(pa.array(b), 2048))
        assert near == pytest.approx([jaccard(x, y) for x, y in zip(a, b)], abs=0.06)


def test_signatures_do_not_depend_on_the_batch():
    r = random.Random(10)
    texts = [sentence(r, n, "ab") for n in (1, 5, 3000, 40, 7000)]
    whole = cws.signatures(pa.array(texts), 64)
    for i, t in enumerate(texts):
        assert (cws.signatures(pa.array([t]), 64)[0] == whole[i]).all()


@pytest.mark.parametrize("chunk", [1 << 21, 50])
def test_edited_texts(messy, none, messy_rows, monkeypatch, chunk):
    monkeypatch.setattr(cws, "_CHUNK_BYTES", chunk)
    got = cws.fingerprints(messy, samples=128).collect()
    assert len(got) == len(messy_rows)
    known = sorted(((i, t or "") for i, t, _, _ in messy_rows if i is not None))
    unknown = [t or "" for i, t, _, _ in messy_rows if i is None]
    by_id = collections.defaultdict(list)
    for x in got:
        by_id[x.doc_id].append(x)
    prints = collections.defaultdict(set)
    for k, (i, t) in enumerate(known):
        follow = known[k + 1][1] if k + 1 < len(known) else None
        x = by_id[i][0] if len(by_id[i]) == 1 else next(y for y in by_id[i] if y.n_chars == len(t))
        prints[t].add(x.fingerprint)
        assert x.n_chars == len(t)
        if follow is not None and len(by_id[i]) == 1:
            new = t[:len(t) - len(t) // 2] + follow[:len(t) // 2]
            assert x.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
            assert x.near_edited == pytest.approx(jaccard(t, new), abs=0.2)
            assert x.near_next == pytest.approx(jaccard(t, follow), abs=0.2)
    assert all(len(v) == 1 for v in prints.values())
    assert sorted(x.n_chars for x in by_id[None]) == sorted(map(len, unknown))
    # the row after the last is the first: one of those without id
    last = by_id[known[-1][0]][0]
    t = known[-1][1]
    assert last.edited_sha256 in {hashlib.sha256((t[:len(t) - len(t) // 2] + u[:len(t) // 2]).encode()).hexdigest() for u in unknown}
    assert cws.fingerprints(none).collect() == []


def test_one_document_follows_itself(spark):
    x, = cws.fingerprints(make_docs(spark, [(7, "a b c d", "en", "s")])).collect()
    assert x.near_next == 1.0 and x.edited_sha256 == hashlib.sha256(b"a b a b").hexdigest()


# ---------------------------------------------------------------- chat

TALK = "conv_id long, turn long, role string, text string, part string, loss string, allowed string"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[INST]", "<s>"]),
                          st.lists(st.sampled_from(["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "⁠", "<", "[", "/INST]", "a",
                                                    "<<TEXT>>", "\n", "<<", "S>>", "é"]), max_size=8).map("".join)), max_size=6),
       st.integers(1, 9))
def test_formatted_text_is_read_back(turns, step):
    f = chat.Formatter(chat.Template())
    parts = [p for role, text in turns for p, _ in f.segments(role, text)]
    whole = "".join(parts)
    assert list(f.read(iter(parts))) == turns
    assert list(f.read(iter([whole]))) == turns
    assert list(f.read(whole[i:i + step] for i in range(0, len(whole), step))) == turns
    for role, text in turns:
        assert f.unescape(f.escape(text)) == text
        assert not any(c in f.escape(text) for c in chat.Template().controls())


def test_role_machine(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "assistant", "a"), (3, 0, "user", "u"),
            (4, 0, "user", "u"), (4, 1, "user", "v"), (4, 2, "assistant", "a"), (5, 0, "user", "u"), (5, 1, "tool", "t"),
            (None, 0, None, None), (6, 1, "assistant", "late"), (6, 0, "user", "early"), (7, None, "user", "n"), (7, 0, "assistant", "a")]
    data = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], TALK)
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(data)).collect()}
    assert {c for c, r in got.items() if r.valid_order} == {1, 6, 7}
    assert got[6].turns_sha256 == hashlib.sha256(b"user\nearly\nassistant\nlate\n").hexdigest()
    assert got[None].turns_sha256 == hashlib.sha256(b"\n\n").hexdigest()
    assert got[4].loss_chars == 1 and got[5].loss_chars == 0 and got[5].n_turns == 2
    segments = chat.format_conversations(data).where("conv_id = 1").orderBy("turn_no", "part").collect()
    assert "".join(s.text for s in segments) == "<<SYS>>s<</SYS>>[INST]u[/INST]<s>a</s>"
    assert [s.text for s in segments if s.loss] == ["a"]
    empty = spark.createDataFrame([], TALK)
    assert chat.read_back(chat.format_conversations(empty)).collect() == []


def test_other_template(spark):
    with pytest.raises(ValueError):
        chat.Formatter(chat.Template(turns={"q": ("Q:", "\n", False)}))
    t = chat.Template(turns={"q": ("Q:", "\n\n", False), "r": ("R:", "\n\n", True)}, other=("{{", "||", "}}"),
                      follow={"": ("q",), "q": ("r",), "r": ("q",)}, final=("r",))
    data = spark.createDataFrame([(1, 0, "q", "a\n\nR:b"), (1, 1, "r", "c{d}|"), (1, 1, "r", "c{d}|")], "conv_id long, turn long, role string, text string")
    got, = chat.read_back(chat.format_conversations(data, t), t).collect()
    assert got.turns_sha256 == hashlib.sha256(b"q\na\n\nR:b\nr\nc{d}|\nr\nc{d}|\n").hexdigest()
    assert got.loss_chars == 10 and not got.valid_order


# ---------------------------------------------------------------- quality

def plain_statistics(text):
    raw, w = text.encode(), WORDS.findall(text)
    odds = lambda x, n: np.log((x / max(n, 1) + .01) / (1 - x / max(n, 1) + .01))
    sym = [c for c in text if 33 <= ord(c) < 127 and not c.isalnum() and c not in ".,;:'\"()-"]
    return [np.log1p(len(raw)), odds(len(sym), len(raw)), odds(len(re.findall("[A-Z]", text)), len(raw)),
            odds(len(re.findall("[0-9]", text)), len(raw)), odds(sum(a == b for a, b in zip(w, w[1:])), len(w)),
            odds(len(set(w)), len(w)), odds(sum(all(c in sym for c in x) for x in w), len(w)),
            np.log1p(len(raw) / max(len(w), 1)), odds(text.count("."), len(raw)), odds(text.count("\n"), len(raw)),
            odds(max(collections.Counter(w).values(), default=0), len(w))]


def test_statistics(messy_rows):
    texts = [t for _, t, _, _ in messy_rows] + ["a a a b!! ||| 12\nX.", "$$$ $$$"]
    got = quality.statistics(pa.array(texts))
    for t, row in zip(texts, got):
        assert row == pytest.approx(plain_statistics(t or "")), t


DOTTED = [".....", "a...... b", "1.2.3.4.5.6.7.8 ...", "\n\n\n\n\n", "...\n...\n", "3.14", "."]


@given(st.text(alphabet=".\n a1$A\u00e9", max_size=30))
@settings(max_examples=200, deadline=None)
def test_statistics_are_finite(text):
    assert np.isfinite(quality.statistics(pa.array([text, None]))).all()


def test_texts_of_dots_change_no_other_score(spark, messy, messy_rows):
    rows = [(i, t, None, None) for i, t, _, _ in messy_rows if i is not None and i < 50]
    labels = [(i, i % 2) for i in range(40)]
    more = rows + [(900 + i, t, None, None) for i, t in enumerate(DOTTED)]
    score = lambda docs, marks: {r.doc_id: r.score for r in quality.score_quality(
        make_docs(spark, docs), spark.createDataFrame(marks, "doc_id long, quality int"), stages.held_out(0, 5)).collect()}
    before, after = score(rows, labels), score(more, labels + [(904, 1)])
    assert all(0 <= x <= 1 for x in after.values()) and len(after) == len(more)
    held = score(more, labels)
    assert max(abs(held[i] - before[i]) for i in before) < 1e-9


def test_discriminant_against_plain_formulas(spark):
    rng = np.random.default_rng(3)
    d = len(quality.STATISTICS)
    x = np.concatenate([rng.normal(0, 1, (80, d)), rng.normal(1, 2, (120, d))])
    y = [0] * 80 + [1] * 120
    df = spark.createDataFrame([(k, *map(float, r)) for k, r in zip(y, x)], ", ".join(["label int", *(f"f{i} double" for i in range(d))]))
    got = quality.fit(df).score(x)
    cov = [np.cov(x[:80].T, bias=True), np.cov(x[80:].T, bias=True)]
    pooled = 0.4 * cov[0] + 0.6 * cov[1]
    pooled = (1 - quality.DIAGONAL) * pooled + quality.DIAGONAL * np.diag(np.diag(pooled)) + 1e-6 * np.eye(d)
    cov = [(1 - quality.POOLED) * c + quality.POOLED * pooled for c in cov]
    log = [-0.5 * (np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m) + np.linalg.slogdet(c)[1]) + np.log(p)
           for m, c, p in zip((x[:80].mean(0), x[80:].mean(0)), cov, (0.4, 0.6))]
    assert got == pytest.approx(1 / (1 + np.exp(log[0] - log[1])), abs=1e-6)


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op8_quality_qda(spark, d).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    out = [(labels[i], r) for i, r in got.items() if r.held_out and i in labels]
    clean, junk = [r for q, r in out if q == 1], [r for q, r in out if q == 0]
    assert sum(r.predicted == 1 for r in clean) >= 0.98 * len(clean)
    assert sum(r.predicted == 0 for r in junk) >= 0.9 * len(junk)


def test_quality_of_odd_tables(spark, messy, none, messy_rows):
    marks = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, score string, f0 string")
    for labels in ([], [(1, 1, "x", "x")], [(i, i % 2, "x", "x") for i in range(30)] + [(None, 1, "x", "x"), (5, None, "x", "x"), (6, 7, "x", "x")]):
        got = quality.score_quality(messy, marks(labels), stages.held_out(0, 5)).collect()
        assert len(got) == len(messy_rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert quality.score_quality(none, marks([]), stages.held_out(0, 5)).collect() == []


# ---------------------------------------------------------------- pages

@pytest.fixture(scope="module")
def trees(spark):
    return htmltext.learn(spark.read.parquet(f"{SF001}/pages.parquet"))


def test_article_of_given_pages(spark, trees):
    pages = spark.read.parquet(f"{SF001}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op1_html_extract(spark, SF001).collect()}
    same = 0
    for p in pages:
        a = re.search(r"<article>(.*?)(</article>|$)", p.html, re.S)[1]
        a = html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br>|</?(?:p|h1)>", "\x00", a)))
        want = "\n".join(x for x in (" ".join(y.split()) for y in a.split("\x00")) if x)
        same += got[p.page_id].text == want
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url
    assert same >= 0.98 * len(pages)


def test_held_out_layouts(spark, trees):
    blocks = [s for r in spark.read.parquet(f"{SF001}/pages.parquet").collect() for s in htmltext.parse(r.html).text if s]
    make = htmltext.Layouts(blocks, seed=555)
    right = total = 0
    for _ in range(150):
        t = htmltext.parse(make.page())
        main = [s.startswith(htmltext._MARK) for s in t.text]
        t.text = [s.lstrip(htmltext._MARK) for s in t.text]
        keep = htmltext.decode(t.parent, trees.log_odds(htmltext.features([t])[0]).tolist())
        right += sum(k == m for s, k, m in zip(t.text, keep, main) if s)
        total += sum(bool(s) for s in t.text)
    assert right >= 0.97 * total


def test_hand_written_pages(trees):
    """Layouts that were not generated; every block of the article says MAIN."""
    p = "Thheouble heenwh on reti ingeser erster that anha the of are haedre anti the a theaatnd or it ing thshst."
    pages = [
        f"<body><header><h1>Site</h1><nav><a href=/>Home</a> <a href=/a>About</a></nav></header><main><article><h1>MAIN0</h1>"
        f"<p>MAIN1 {p}</p><p>MAIN2</p><aside class='related'><p>Related: {p}</p></aside><p>MAIN3 {p}</p></article></main>"
        f"<section class='comments'><h2>Comments</h2><div class='comment'><p>I agree {p}</p></div></section><footer>2024</footer>",
        f"<body><div id='cookie-banner'><p>We use cookies. {p}</p><button>OK</button></div><div class='content'><h2>MAIN0</h2>"
        f"<p>MAIN1 {p}</p><ul><li>MAIN2 one</li><li>MAIN3 two</li></ul><form action=/s><label>Mail</label><input></form>"
        f"<p>MAIN4 {p}</p></div><div class='sidebar'><ul><li><a href=1>x</a></li><li><a href=2>y</a></li></ul><p>{p}</p></div>",
        f"<table><tr><td class=menu><a href=1>a</a><br><a href=2>b</a></td><td class=main><p>MAIN0 {p}</p><p>MAIN1 {p}</p>"
        f"<blockquote>MAIN2 {p}</blockquote></td></tr></table>",
        f"<body><div><div><div class='notice'>Notice: {p}</div><p>MAIN0 {p}</p><div class='advert'><p>Buy {p}</p></div>"
        f"<p>MAIN1 {p}</p></div></div><div id='disqus_thread'><p>reader {p}</p></div></body>",
    ]
    for html_, n in zip(pages, (4, 5, 3, 2)):
        got = htmltext.main_texts([html_], trees)[0].split("\n")
        assert [x.split()[0] for x in got] == [f"MAIN{i}" for i in range(n)]


def test_wrappers_named_after_other_blocks(trees):
    """Every block of the article says MAIN; the wrappers' class names speak of side bars, adverts and comments."""
    p = "Thheouble heenwh on reti ingeser erster that anha the of are haedre anti the a theaatnd or it ing thshst."
    main = f"<h1>MAIN0</h1><p>MAIN1 {p}</p><p>MAIN2 {p}</p>"
    pages = [
        f'<body class="single has-sidebar ad-free"><div class="content-with-sidebar"><article class="post comments-open">{main}</article></div>',
        f'<main><div class="post-header"><h1>MAIN0</h1></div><p>MAIN1 {p}</p><p>MAIN2 {p}</p></main><footer>2024</footer>',
        f'<main>{main}</main><div class="responses"><div><b>Ann</b><p>I think {p}</p></div><div><b>Bob</b><p>No {p}</p></div></div>',
        f'<main>{main}</main><div class="responses"><p>I think {p}</p><p>No {p}</p></div>',
    ]
    for html_ in pages:
        assert [x.split()[0] for x in htmltext.main_texts([html_], trees)[0].split("\n")] == ["MAIN0", "MAIN1", "MAIN2"]


@pytest.mark.xfail(strict=False, reason="known weakness (README): the title is lost under some samples of training pages")
def test_title_in_a_header_of_its_own_in_a_plain_wrapper(trees):
    p = "Thheouble heenwh on reti ingeser erster that anha the of are haedre anti the a theaatnd or it ing thshst."
    page = (f'<body class="no-sidebar"><div class="layout with-menu"><div class="menu"><a href=/>a</a> <a href=/b>b</a></div>'
            f'<div class="content"><header class="entry-header"><h1>MAIN0</h1></header><p>MAIN1 {p}</p><p>MAIN2 {p}</p></div>'
            f'<div class="sidebar"><p>Side {p}</p></div></div>')
    assert [x.split()[0] for x in htmltext.main_texts([page], trees)[0].split("\n")] == ["MAIN0", "MAIN1", "MAIN2"]


def foreign_pages(blocks, n):
    """Pages of three template families that training does not lay out like this; the article's blocks start with the mark."""
    r = random.Random(77)
    prose, few = lambda: html.escape(r.choice(blocks)), lambda: html.escape(" ".join(r.choice(blocks).split()[:4]))
    mark = htmltext._MARK
    for i in range(n):
        body = f"<h1>{mark}{few()}</h1>" + "".join(
            r.choice([f"<p>{mark}{prose()}</p>"] * 6 + [f"<h2>{mark}{few()}</h2>", f"<ul><li>{mark}{prose()}</li><li>{mark}{prose()}</li></ul>"])
            for _ in range(r.randint(3, 9)))
        menu = "".join(f"<a href=/{k}>{few()}</a> | " for k in range(r.randint(4, 8)))
        talk = "".join(f"<div class=msg><i>{few()}</i><p>{prose()}</p></div>" for _ in range(r.randint(1, 5)))
        if i % 3 == 0:  # a table for a layout
            page = (f"<table width=100%><tr><td colspan=2>{few()}</td></tr><tr><td width=150 class=leftnav>{menu}</td><td>{body}</td></tr>"
                    f"<tr><td colspan=2 class=foot>&copy; {few()}</td></tr></table>")
        elif i % 3 == 1:  # generated class names, side bar before the article
            page = (f"<div id=__next><div class=css-1a2b><header>{menu}</header></div><div class=css-9x><aside class=css-77><p>{prose()}</p></aside>"
                    f"<main class=css-3c>{body}</main></div><footer class=css-zz><p>{few()}</p></footer></div>")
        else:  # everything beside the article in sections of one wrapper
            page = (f"<body class='page has-nav with-comments'><div class='nav-top'>{menu}</div><div class='wrap sidebar-right'>"
                    f"<article class=hentry>{body}</article><section class=talkback><h4>{few()}</h4>{talk}</section></div>"
                    f"<div class=sidebar><h4>{few()}</h4><p>{prose()}</p></div><div class=footer>{few()}</div>")
        yield i % 3, page


def test_held_out_template_families(spark, trees):
    blocks = [s for r in spark.read.parquet(f"{SF001}/pages.parquet").collect() for s in htmltext.parse(r.html).text if s]
    counts = {f: [0, 0, 0] for f in range(3)}  # kept and main, kept, main
    for family, page in foreign_pages(blocks, 240):
        t = htmltext.parse(page)
        main = [s.startswith(htmltext._MARK) for s in t.text]
        t.text = [s.lstrip(htmltext._MARK) for s in t.text]
        keep = htmltext.decode(t.parent, trees.log_odds(htmltext.features([t])[0]).tolist())
        for s, k, m in zip(t.text, keep, main):
            if s:
                c = counts[family]
                c[0], c[1], c[2] = c[0] + (k and m), c[1] + k, c[2] + m
    # precision and recall of blocks: 1.0 and 1.0 in the last two, 0.85 and 0.63 where a table is the layout (README)
    for (both, kept, main), least in zip(counts.values(), ((0.75, 0.5), (0.95, 0.95), (0.95, 0.95))):
        assert both >= least[0] * kept and both >= least[1] * main


@pytest.mark.parametrize("page, texts", [
    ("<form><button>Go</form><article><p>First.</p><p>Second.</p></article>", ["First.", "Second."]),
    ("<p title=it's>First.</p><p>Don't drop.</p>", ["First.", "Don't drop."]),
    ("<p title='a > b' data-x=\"c > d\">First.</p><p class = 'x'>Second.</p>", ["First.", "Second."]),
    ("<a href=/q?a='b>link</a><p>It's here.</p>", ["link", "It's here."]),
    ("<span><button>Go</span><p>First.</p>", ["First."]),
    ("<div><button>Go<button>Stop</button><p>First.</p></div>", ["First."]),
    ("<table><tr><td><button>Go<td>First.</table>", ["First."]),
    ("<div>a <svg><title>icon<g><path/></g></svg> b<select><option>x<option>y</div><p>First.</p>", ["a b", "First."]),
    ("<div><object><div>in</div>still in</object>out</div><script>if (a</b/.x) '<p>no'</script><p>First.</p>", ["out", "First."]),
    ("<p>First.</p><script>never closed <p>no</p>", ["First."]),
] + [(f"<div><{tag}>Go</div><p>First.</p><{tag}>x</{tag}><p>Second.</p>", ["First.", "Second."]) for tag in (
    "button", "select", "object", "svg", "canvas", "audio", "video", "math", "datalist", "template")])
def test_broken_markup_loses_no_other_text(page, texts):
    assert [s for s in htmltext.parse(page).text if s] == texts


def test_decoding_is_the_best_consistent_labelling():
    r = random.Random(0)
    for _ in range(200):
        n = r.randint(1, 9)
        parent = [-1] + [r.randrange(i) for i in range(1, n)]
        odds = [r.uniform(-2, 2) for _ in range(n)]
        keep = htmltext.decode(parent, odds)
        assert all(not keep[i] or parent[i] < 0 or keep[parent[i]] for i in range(n))
        best = max(sum(o for i, o in enumerate(odds) if m >> i & 1) for m in range(1 << n)
                   if all(not m >> i & 1 or parent[i] < 0 or m >> parent[i] & 1 for i in range(n)))
        assert sum(o for o, k in zip(odds, keep) if k) == pytest.approx(best)


def test_parser_repairs():
    t = htmltext.parse("<body><p>a<b>b <p>c &amp; d&nbsp;e<ul><li>x<li>y</ul>tail<br>end<script>no<p></script><!-- no --><td>z")
    assert [s for s in t.text if s] == ["ab", "c & d e", "x", "y", "tail", "end", "z"]
    for broken in ("", "<", "<p", "</div></div>", "<a href='x>y</a>", "<script>", "&#xZZ;&lt", "<div " + "x" * 1000, "<p>" * 3000):
        htmltext.parse(broken)


@pytest.mark.parametrize("junk", ["<a ", "<! ", "</b", "<a x='", '<a b="', "<div>", "<div><li>", "<form>", "</p>", "<td>", "<!-"])
def test_long_broken_pages_take_linear_time(junk):
    page = "<p>first</p>" + junk * (1_000_000 // len(junk))
    start = time.perf_counter()
    texts = htmltext.parse(page).text
    assert time.perf_counter() - start < 10 and any(x.startswith("first") for x in texts)


def test_tags_after_one_that_nothing_closes_are_still_tags():
    # a quoted value may hold tags; here it is closed, and the tag too
    assert [x for x in htmltext.parse('<p>one<p>two<a x=">three<p>four" <p>five').text if x] == ["one", "twofive"]
    texts = [x for x in htmltext.parse("<p>one</p><a b <i <div class=x>two</div><p>three</p>").text if x]
    assert texts[0] == "one" and texts[-1] == "three"


def test_deep_pages_keep_their_nesting(trees):
    page = "<main>" + "<div>" * 5000 + "<p>deep</p>" + "</div>" * 5000 + "<p>after</p></main>"
    t = htmltext.parse(page)
    deep, after = t.text.index("deep"), t.text.index("after")
    assert t.depth[deep] > 5000 and t.depth[after] < 10 and t.parent[after] != t.parent[deep]
    assert isinstance(htmltext.main_texts([page], trees)[0], str)


def test_odd_pages(spark, trees):
    kind = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", None, "x", "x"), (1, "u", None, "x", "x"), (2, None, "", "x", "x"), (None, "u", "<p>" + "word " * 60_000, "x", "x"),
            (3, "u", "just text", "x", "x"), (4, "u", "<nav><a href=x>a</a></nav>", "x", "x")]
    got = htmltext.extract(spark.createDataFrame(rows, kind), trees).collect()
    assert sorted(map(str, ((r.page_id, r.url) for r in got))) == sorted(map(str, (r[:2] for r in rows)))
    assert all(r.text == "" and r.n_chars == 0 for r in got if r.page_id in (1, 2))
    assert htmltext.extract(spark.createDataFrame([], kind), trees).collect() == []
    assert htmltext.learn(spark.createDataFrame([], kind)) is not None
