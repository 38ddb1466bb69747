"""SimHash near-dedup, substring dedup and decontamination against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from pulselens.llm import components, decontaminate, simhash, stages, substring, textkit
from tests.llm.conftest import make_docs, sentence

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# ---------------------------------------------------------------- words

def test_words_and_hashes_match_plain_python(messy_rows):
    import pyarrow as pa
    texts = [t or "" for _, t, _, _ in messy_rows]
    data, at = textkit.utf8(pa.array([t for _, t, _, _ in messy_rows]))
    s, e, first = textkit.words(data, at)
    got = [data[a:b].tobytes().decode() for a, b in zip(s, e)]
    want = [WORDS.findall(t) for t in texts]
    assert got == [w for ws in want for w in ws]
    assert np.diff(first).tolist() == [len(w) for w in want]
    h = textkit.word_hashes(data, s, e)
    by = {}
    for w, x in zip(got, h.tolist()):
        assert by.setdefault(w, x) == x
    assert len(set(by.values())) == len(by)
    runs = textkit.run_hashes(h, 3)
    seen = {}
    for i in np.flatnonzero(textkit.run_starts(first, 3)):
        assert seen.setdefault(tuple(got[i:i + 3]), int(runs[i])) == int(runs[i])
    assert len(set(seen.values())) == len(seen)


def test_word_hashes_do_not_depend_on_place():
    import pyarrow as pa
    big = "x" * (textkit._RANGE + 50)
    texts = [f"{'pad ' * i}needle {big} needle" for i in range(5)]
    data, at = textkit.utf8(pa.array(texts))
    s, e, _ = textkit.words(data, at)
    h = textkit.word_hashes(data, s, e)
    names = [data[a:b].tobytes() for a, b in zip(s, e)]
    assert len({int(x) for x, n in zip(h, names) if n == b"needle"}) == 1
    assert len({int(x) for x, n in zip(h, names) if n == big.encode()}) == 1


def test_patterned_words_keep_apart(spark):
    """Thue-Morse words and their mirrors cancel out in hashes that are sums of powers."""
    import pyarrow as pa
    bits = [i.bit_count() % 2 for i in range(4096)]
    for n in (64, 256, 512, 1024, 4096):
        one, two = "".join("ab"[b] for b in bits[:n]), "".join("ba"[b] for b in bits[:n])
        data, at = textkit.utf8(pa.array([one, two]))
        s, e, _ = textkit.words(data, at)
        assert len(set(textkit.word_hashes(data, s, e).tolist())) == 2
        docs = make_docs(spark, [(1, "w " * 12 + one, None, None), (2, "w " * 12 + two, None, None)])
        assert [r.n_removed for r in substring.factors(docs).orderBy("doc_id").collect()] == [0, 0]


# ---------------------------------------------------------------- SimHash

def plain_fingerprint(text, k=4):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, bits):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(range(len(fps)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= bits:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def test_fingerprints_and_groups(spark, messy, messy_rows):
    got = simhash.near_duplicates(messy).collect()
    assert len(got) == len(messy_rows)
    fps = [plain_fingerprint(t) for _, t, _, _ in messy_rows]
    roots = plain_components(fps, 4)
    names = {}
    for (i, _, _, _), g in zip(messy_rows, roots):
        if i is not None:
            names[g] = min(names.get(g, i), i)
    want = sorted(((i, f, names.get(g)) for (i, _, _, _), f, g in zip(messy_rows, fps, roots)), key=str)
    assert sorted(((r.doc_id, r.fp & (2 ** 64 - 1), r.component_id) for r in got), key=str) == want


def test_simhash_empty_table(none):
    assert simhash.near_duplicates(none).collect() == []


def test_golay_code_is_perfect():
    rem, errors, count = simhash._tables()
    assert sorted(set(count.tolist())) == [1, 6]
    word = np.random.default_rng(0).integers(0, 1 << 23, 500)
    index, used = simhash.golay_keys(word)
    for w, ks, ms in zip(word.tolist(), index, used):
        near = set()
        for e in [0, *(1 << i for i in range(23))]:
            z = w ^ e
            s = (z & 0x7FF) ^ int(rem[z >> 11])
            codes = {(z ^ int(x)) for x in errors[s][:count[s]] if int(x).bit_count() <= 3}
            assert len(codes) == 1  # one codeword within three bits of any word
            near.add(codes.pop() >> 11)
        assert near == set(ks[ms].tolist())


def test_every_pair_within_four_bits_shares_a_key():
    r = random.Random(5)
    for bits in (0, 1, 2, 3, 4):
        for _ in range(400):
            x = r.getrandbits(64)
            y = x
            for b in r.sample(range(64), bits):
                y ^= 1 << b
            k, at = simhash.keys(np.array([x, y], np.uint64))
            assert set(k[at == 0].tolist()) & set(k[at == 1].tolist()), (x, y)
    # and the hard patterns: all errors in one segment, and two in each of two
    for segs in ((23, 0), (23, 23), (18, 46)):
        width, shift = segs
        for bad in combinations(range(min(width, 8)), 4):
            y = sum(1 << (b + shift) for b in bad)
            k, at = simhash.keys(np.array([0, y], np.uint64))
            assert set(k[at == 0].tolist()) & set(k[at == 1].tolist())


def clustered(r, centres=12, members=40):
    out = set()
    for _ in range(centres):
        x = r.getrandbits(64)
        for _ in range(members):
            y = x
            for b in r.sample(range(64), r.randint(0, 3)):
                y ^= 1 << b
            out.add(y)
    return sorted(out)


@pytest.mark.parametrize("max_run", [200_000, 3])
def test_links_connect_what_all_pairs_connect(spark, max_run):
    """Also where every larger key goes through half-way words."""
    fps = clustered(random.Random(11), 6, 15)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    classes = spark.createDataFrame([(x,) for x in signed], "fp long")
    pairs = [(r.a & (2 ** 64 - 1), r.b & (2 ** 64 - 1)) for r in simhash.links(classes, 4, max_run).collect()]
    at = {f: i for i, f in enumerate(fps)}
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        assert (a ^ b).bit_count() <= 4
        x, y = find(at[a]), find(at[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(fps))] == plain_components(fps, 4)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 299), (300, 299)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 160))
    assert got[300] == got[299] == 299 and 7 in got
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---------------------------------------------------------------- substrings

def plain_cut(rows, n):
    docs = [(i, WORDS.findall(t or "")) for i, t, _, _ in rows]
    low = {}
    for i, w in docs:
        if i is not None:
            for j in range(len(w) - n + 1):
                k = tuple(w[j:j + n])
                low[k] = min(low.get(k, i), i)
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        if i is not None:
            for j in range(len(w) - n + 1):
                if low[tuple(w[j:j + n])] < i:
                    gone[j:j + n] = [True] * n
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [13, 4])
def test_substrings(messy, messy_rows, window):
    got = sorted(((r.doc_id, r.n_words, r.n_removed, " ".join(WORDS.findall(r.kept or "")))
                  for r in substring.factors(messy, window).collect()), key=str)
    assert got == plain_cut(messy_rows, window)


def test_substrings_of_random_small_words(spark):
    """Few words, so that phrases repeat within and across documents and factors touch and overlap."""
    r = random.Random(8)
    rows = [(r.randint(0, 60), " ".join(r.choice("abc") for _ in range(r.randint(0, 30))), "en", "a") for _ in range(80)]
    got = sorted(((x.doc_id, x.n_words, x.n_removed, " ".join(WORDS.findall(x.kept or "")))
                  for x in substring.factors(make_docs(spark, rows), 6).collect()), key=str)
    assert got == plain_cut(rows, 6)


def test_factors_name_their_reference(spark):
    r = random.Random(1)
    a, b = sentence(r, 30), sentence(r, 30)
    rows = [(1, a, "en", "s"), (2, b, "en", "s"), (3, f"x {a} y {b}", "en", "s")]
    got = {x.doc_id: [(f.start, f.n_words, f.ref_doc) for f in x.factors]
           for x in substring.factors(make_docs(spark, rows), 13).collect()}
    assert got == {1: [], 2: [], 3: [(1, 30, 1), (32, 30, 2)]}


def test_factors_are_held_by_their_reference(spark):
    """Few words, so that phrases repeat at several places; each factor stands in the named document at the named word."""
    r = random.Random(21)
    rows = [(3, "v0 v1 v2 v3 gap v1 v2 v3 v4", "en", "a"), (4, "v0 v1 v2 v3 v4", "en", "a")]
    rows += [(i, " ".join(r.choice("ab") for _ in range(r.randint(0, 60))), "en", "a") for i in range(10, 80)]
    rows += [(i, " ".join(f"w{i}x{k}" for k in range(400)) if i == 80 else " ".join(f"w80x{k}" for k in range(9, 390)), "en", "a")
             for i in (80, 81)]
    texts = {i: t.split() for i, t, _, _ in rows}
    got = {x.doc_id: x.factors for x in substring.factors(make_docs(spark, rows), 4).collect()}
    for i, found in got.items():
        for f in found:
            assert f.ref_doc < i and f.n_words >= 4
            assert texts[i][f.start:f.start + f.n_words] == texts[f.ref_doc][f.ref_start:f.ref_start + f.n_words]
    assert [(f.start, f.n_words, f.ref_start) for f in got[4]] == [(0, 4, 0), (1, 4, 5)]
    assert [(f.start, f.n_words, f.ref_doc, f.ref_start) for f in got[81]] == [(0, 381, 80, 9)]


def test_blocks_follow_the_bytes_of_the_text(spark, messy, messy_rows, monkeypatch):
    monkeypatch.setattr(substring, "BLOCK_BYTES", 50)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, " ".join(WORDS.findall(r.kept or "")))
                  for r in substring.factors(messy, 4).collect()), key=str)
    assert got == plain_cut(messy_rows, 4)


def test_substrings_empty_table(none):
    assert substring.factors(none).collect() == []


# ---------------------------------------------------------------- decontamination

def bench_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, h string, content string")


def plain_leaks(text, items, least=13, given=0.8):
    words = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower())
    w, out = words(text), set()
    for i, t in items:
        v = words(t)
        need, share = min(least, len(v)), given if len(v) >= 5 else 1.0
        for shift in range(-len(v), len(w)):
            low, high = max(0, -shift), min(len(v), len(w) - shift)
            eq = [v[k] == w[k + shift] for k in range(low, high)]
            c = np.concatenate([[0], np.cumsum(eq)]) if eq else np.zeros(1)
            if any(c[b] - c[a] >= share * (b - a) - 1e-6 for a in range(len(eq)) for b in range(a + need, len(eq) + 1)):
                out.add(i)
    return out


def substituted(r, text, n):
    w = text.split()
    for k in r.sample(range(len(w)), n):
        w[k] = "zzz" + str(k)
    return " ".join(w)


def test_masks_hit_every_overlap_of_the_bound():
    for n, s in ((13, 2), (15, 3), (20, 4)):
        for gone in combinations(range(n), s):
            assert any(all(i + o not in gone for o in m) for m in decontaminate.MASKS for i in range(n - m[-1]))


def test_leaks(spark, messy, messy_rows):
    r = random.Random(4)
    items = [(i, sentence(r, n)) for i, n in enumerate((15, 20, 30, 13, 8, 6, 3))] + [(90, None), (None, "x y z w v u")]
    planted = []
    for k in range(60):
        i, t = items[k % 6]
        n = len(t.split())
        planted.append((1000 + k, f"{sentence(r, 9)} {substituted(r, t, r.randint(0, n // 3)).upper()}, {sentence(r, 5)}", "en", "a"))
    rows = messy_rows + planted
    docs = make_docs(spark, rows)
    bench = bench_of(spark, [(i, t, "x", "y") for i, t in items] + [(0, items[0][1], "x", "y")])
    known = [(i, t) for i, t in items if i is not None and t is not None]
    want = sorted(((i, sorted(plain_leaks(t, known) if t is None or len(t) < 5000 else set())) for i, t, _, _ in rows), key=str)
    assert sum(bool(x) for _, x in want) > 20
    for block in (1 << 20, 200):  # one block, and several that meet again
        got = sorted(((x.doc_id, sorted({m.item_id for m in x.matches}))
                      for x in decontaminate.find_leaks(docs, bench, block_bytes=block).collect()), key=str)
        assert got == want


def test_short_items(spark):
    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(12)]
    words = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(n * 10 + k, words(n)) for n in range(1, 8) for k in range(3)] + [(100, ""), (101, "...")]
    texts = [words(r.choice([0, 1, 2, 3, 4, 5, 6, 9, 14])) for _ in range(300)] + [t for _, t in items]
    for i, t in items:
        w = t.split()
        for k in range(len(w)):                     # each word substituted, at the start, within and at the end of a text
            one = " ".join([*w[:k], "other", *w[k + 1:]])
            texts += [one, f"a b {one} c", f"a b {one}"]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    want = {i: sorted(plain_leaks(t, items)) for i, t, _, _ in rows}
    found = decontaminate.find_leaks(make_docs(spark, rows), bench_of(spark, [(i, t, "x", "y") for i, t in items]))
    got = {x.doc_id: sorted({m.item_id for m in x.matches}) for x in found.collect()}
    assert got == want
    assert {i // 10 for x in want.values() for i in x} >= {1, 2, 3, 4, 5, 6, 7}
    five = next(t for i, t in items if i == 50).split()
    assert all(50 in plain_leaks(" ".join([*five[:k], "other", *five[k + 1:]]), items) for k in range(5))


def test_leaks_of_empty_tables(spark, messy, messy_rows, none):
    empty = bench_of(spark, [])
    assert decontaminate.find_leaks(none, empty).collect() == []
    assert [r.matches for r in decontaminate.find_leaks(messy, empty).collect()] == [[]] * len(messy_rows)


# ---------------------------------------------------------------- stages

def test_stages_keep_the_columns(spark, messy, none, tmp_path):
    bench_of(spark, [(1, sentence(random.Random(0), 20), "x", "y")]).write.parquet(f"{tmp_path}/benchmark.parquet")
    for stage in (stages.simhash_near_dedup, stages.substring_dedup, stages.benchmark_decontamination):
        assert stage(spark, messy, str(tmp_path)).schema.names == messy.schema.names
        assert stage(spark, none, str(tmp_path)).collect() == []


def test_near_dedup_stage_keeps_one_of_each_group(spark, messy, messy_rows):
    got = [r.doc_id for r in stages.simhash_near_dedup(spark, messy, "").collect()]
    fps = [plain_fingerprint(t) for _, t, _, _ in messy_rows]
    roots = plain_components(fps, 4)
    want = {min(i for (i, _, _, _), g in zip(messy_rows, roots) if g == x and i is not None)
            for x in set(roots) if any(i is not None for (i, _, _, _), g in zip(messy_rows, roots) if g == x)}
    assert sorted(x for x in got if x is not None) == sorted(want)
    assert got.count(None) == sum(i is None for i, _, _, _ in messy_rows)


def test_near_dedup_stage_with_one_id_for_several_texts(spark):
    r = random.Random(11)
    a, b, c = (sentence(r, 60) for _ in range(3))
    # 7 names two clean texts; 8 a copy of 1 and a clean text; 9 a clean text twice, with other columns
    rows = [(1, a, "en", "x"), (7, b, "en", "x"), (7, c, "en", "x"), (8, a, "en", "x"), (8, d := sentence(r, 60), "en", "x"),
            (9, e := sentence(r, 60), "en", "y"), (9, e, "en", "x")]
    got = sorted((x.doc_id, x.text, x.source) for x in stages.simhash_near_dedup(spark, make_docs(spark, rows), "").collect())
    assert got == sorted([(1, a, "x"), (7, b, "x"), (7, c, "x"), (8, d, "x"), (9, e, "x")])


def test_substring_stage_changes_only_texts_with_repeats(spark, messy, messy_rows):
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in stages.substring_dedup(spark, messy, "").collect()), key=str)
    want = {i: (n, k) for i, _, n, k in plain_cut(messy_rows, 13)}
    out = []
    for i, t, _, _ in messy_rows:
        new = want[i][1] if i is not None and want[i][0] else t
        out.append((i, new, None if new is None else len(new)))
    assert got == sorted(out, key=str)


def test_decontamination_stage_drops_only_leaks(spark, tmp_path):
    r = random.Random(6)
    item = sentence(r, 25)
    rows = [(1, sentence(r, 40), "en", "a"), (2, f"{sentence(r, 5)} {item}", "en", "a"), (None, item, "en", "a"),
            (3, None, "en", "a"), (4, " ".join(item.split()[:9]), "en", "a")]
    bench_of(spark, [(1, item, "x", "y")]).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = stages.benchmark_decontamination(spark, make_docs(spark, rows), str(tmp_path)).collect()
    assert sorted(x.doc_id for x in got) == [1, 3, 4]
