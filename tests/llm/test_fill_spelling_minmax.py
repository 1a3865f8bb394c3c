"""Fill-in-the-middle, spelling variants and min-max near duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from metaweave.llm import minmax_dedup as mm
from metaweave.llm import spelling
from metaweave.llm.boundary_set import BoundarySet, _Array, _Bitmap, _Runs
from metaweave.llm.fill_middle import boundaries, cut, fill_in_middle, restored
from metaweave.llm.minmax_dedup import near_duplicates
from metaweave.llm.spelling import spelling_variants

from .conftest import LONG, SENTENCE, document_rows

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def test_boundary_set_selects_and_ranks_in_every_container():
    rng = np.random.default_rng(5)
    sparse = np.sort(rng.choice(65536, 900, replace=False))
    dense = 65536 + np.sort(rng.choice(65536, 30_000, replace=False))
    runs = 3 * 65536 + np.concatenate([np.arange(10, 9000), np.arange(9500, 65536)])
    members = np.concatenate([sparse, dense, runs])
    s = BoundarySet(members)
    assert [type(c) for c in s.containers] == [_Array, _Bitmap, _Runs]
    assert len(s) == len(members) and s.nbytes() < 4 * len(members)
    for k in [0, 1, 899, 900, 901, 30_899, 30_900, 39_889, 39_890, len(members) - 1, *rng.integers(0, len(members), 300).tolist()]:
        assert s.select(k) == members[k] and s.rank(int(members[k])) == k
    for x in rng.integers(0, 5 * 65536, 300).tolist():
        assert s.rank(x) == np.searchsorted(members, x)
    for k in (-1, len(members)):
        with pytest.raises(IndexError):
            s.select(k)
    assert len(BoundarySet(np.zeros(0, np.int64))) == 0


@pytest.mark.parametrize("text", ["", "a", "ab1cd", "  ", "é🙂éab", "<P>", LONG[:200_000], "x" * 200_000, "- " * 100_000])
def test_boundaries_are_the_ends_of_units(text):
    ends = [0]
    for u in UNIT.findall(text):
        ends.append(ends[-1] + len(u))
    s = boundaries(text)
    assert len(s) == len(ends)
    assert all(s.select(k) == ends[k] for k in range(0, len(ends), max(1, len(ends) // 500)))


def expected_fill(doc_id, text):
    text, units = text or "", UNIT.findall(text or "")
    n = len(units)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    if h4 % 100 < 20:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle_equals_brute_force_and_goes_back(spark, docs, no_docs):
    made = fill_in_middle(docs).withColumn("back", restored(F.col("output"), F.col("form")))
    rows = document_rows()
    assert sorted([tuple(r)[:6] for r in made.collect()], key=str) == sorted([expected_fill(r[0], r[1]) for r in rows], key=str)
    assert sorted(r["back"] for r in made.collect()) == sorted(r[1] or "" for r in rows)
    assert {r["form"] for r in made.collect()} >= {"plain", "psm", "spm"}
    assert fill_in_middle(no_docs).collect() == []


def test_markers_and_their_pieces(spark):
    texts = ["a <P> b", "<", "<S", "a<S<P><M", "ends in <S", "S> starts <M", "x<P", "<<<>>>", "P>S>M>"]
    rows = [(k * 100 + j, t) for k, t in enumerate(texts) for j in range(40)]
    made = fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"))
    back = made.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert {r["doc_id"]: r["back"] for r in back} == dict(rows)
    assert all(r["form"] == "plain" for r in back if "<P>" in texts[r["doc_id"] // 100])
    assert cut("", "3")[1] == "plain"


def expected_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(UPPER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected_variants(rows):
    n = expected_words(rows)
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def variant_rows():
    rng = random.Random(3)
    base = ["garden", "gardens", "harden", "hardens", "pardon", "élégant", "élegant", "Übermut", "übermut", "stone", "stones", "store", "anagram", "margana"]
    base += ["".join(rng.choice("abcdeé") for _ in range(rng.randint(4, 7))) for _ in range(150)]
    base += ["q" * 3000, "q" * 2999 + "r", "q" * 3001, "q" * 2998 + "rr"]
    rows = []
    for i in range(300):
        rows.append((None if i % 50 == 0 else i // 2, " ".join(rng.choices(base, weights=[1 + 40 // (1 + k) for k in range(len(base))], k=40)) + ("." if i % 3 else " ×÷ 東京 x1y")))
    return rows + [(7, None), (8, ""), (9, " \n"), (9, " \n")] + [(400 + k, "many " * 5 + base[-4 + k] + " " + base[-4 + k] + " " + base[-4 + k]) for k in range(4)]


@pytest.mark.parametrize("groups,tile", [(3, 4096), (4, 4096), (4, 7), (5, 4096)])
def test_variants_equal_brute_force(spark, groups, tile):
    """Any number of letter groups and any tiling finds each pair once."""
    rows = variant_rows()
    df = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], "doc_id long, text string, word string, form string, n long")
    got = spelling_variants(df, groups=groups, tile=tile)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = expected_variants(rows)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert len({w[2] for w in want}) < len(want) and any(w[1] and w[1] != w[2] for w in want)


def test_variants_of_nothing_and_odd_rows(docs, no_docs):
    assert spelling_variants(no_docs).collect() == []
    rows = [(r[0], r[1]) for r in document_rows()]
    assert sorted(map(tuple, spelling_variants(docs).collect()), key=str) == expected_variants(rows)


def test_counts_are_whole_when_a_task_flushes(spark, monkeypatch):
    rows = variant_rows()
    monkeypatch.setattr(spelling, "_FLUSH", 20)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["word"]: r["n"] for r in spelling.count_words(df, "doc_id", "text").collect()} == expected_words(rows)


def shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UPPER))
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(w)


def expected_near(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids, default=None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(out, key=str)


def near_rows():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(400)]
    rows = [(1000 - i, t) for i, t in enumerate([None, "", " \t", "one", "ONE", "one two", "two one", SENTENCE, SENTENCE.upper(), LONG, LONG + " end"])]
    for g in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([6, 12, 60, 200]))]
        for k in range(rng.choice([1, 3, 12])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 8))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((5000 - 20 * g - k, " ".join(w)))
    # a chain: each is near the next, the ends are not
    chain = [f"c{i}" for i in range(101)]
    for k in range(8):
        rows.append((9000 - k, " ".join(chain)))
        chain = chain[4:] + [f"d{k}{i}" for i in range(4)]
    return rows + [(None, "a row without identifier"), (None, "a row without identifier"), (77, rows[-1][1]), (77, rows[-1][1]), (78, "one two")]


def test_near_duplicates_equal_brute_force(spark):
    rows = near_rows()
    df = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], "doc_id long, text string, digest string, key string, n long")
    got = near_duplicates(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == expected_near(rows)


def test_near_duplicates_of_odd_rows(docs, docs_file, no_docs):
    want = expected_near([(r[0], r[1]) for r in document_rows()])
    assert sorted(map(tuple, near_duplicates(docs).collect()), key=str) == want
    assert sorted(map(tuple, near_duplicates(docs_file).collect()), key=str) == want
    assert near_duplicates(no_docs).collect() == []


def test_parity_sketches_never_rule_out_too_much():
    rng = np.random.default_rng(2)
    for n in (3, 50, 3000):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[n // 4 :], rng.integers(0, 1 << 63, n // 5).astype(np.uint64)]))
        x, y = mm.parity_sketch(a).view(np.uint64), mm.parity_sketch(b).view(np.uint64)
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_both_ends_of_a_permutation_estimate_the_similarity():
    rng = np.random.default_rng(4)
    p = mm.Permutations(400, 1)
    a = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 1 << 63, 200).astype(np.uint64)])
    same = p.signature(np.sort(a)) == p.signature(np.sort(b))
    for half in (same[:400], same[400:]):
        assert abs(half.mean() - 800 / 1200) < 0.08
