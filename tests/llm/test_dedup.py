"""Exact and near duplicates against brute force."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from metaweave.llm import stream_dedup
from metaweave.llm.components import components
from metaweave.llm.simhash import _layout, simhash, simhash_groups
from metaweave.llm.stream_dedup import exact_dedup

from .conftest import document_rows

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected_exact():
    groups = defaultdict(list)
    for r in document_rows():
        groups[(r[1] or "").translate(UPPER)].append(r[0])
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        rest = [keep, *ids]
        rest.remove(keep)
        digest = hashlib.sha256(text.encode()).hexdigest()
        left = list(ids)
        left.remove(keep)
        out += [(keep, keep, len(ids), True, digest)] + [(i, keep, len(ids), False, digest) for i in left]
    return sorted(out, key=str)


def exact(df):
    return sorted(map(tuple, exact_dedup(df).drop("file", "pos").collect()), key=str)


def test_exact_groups(docs, docs_file):
    assert exact(docs) == expected_exact()
    assert exact(docs_file) == expected_exact()


def test_exact_empty(no_docs):
    assert exact(no_docs) == []


def test_rows_that_share_a_digest_are_compared_on_their_bytes(docs_file, monkeypatch):
    """With a digest of two bits, different texts meet; the byte check takes them apart again."""
    monkeypatch.setattr(stream_dedup, "digest", lambda text: F.unhex(F.lpad(F.hex(F.crc32(text.cast("binary")) % 4), 2, "0")))
    got = exact_dedup(docs_file)
    plain = sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got.collect()], key=str)
    assert plain == sorted([r[:4] for r in expected_exact()], key=str)


def test_state_continues_over_landings(spark, docs_file, tmp_path):
    folder, state = str(tmp_path / "landed"), str(tmp_path / "state")
    rows = stream_dedup.located(docs_file)
    stream_dedup.land(rows.where("doc_id <= 3"), folder)
    first = stream_dedup.run_stream(spark, folder, state)
    assert first.agg(F.sum("group_size")).first()[0] == 3
    stream_dedup.land(rows.where("doc_id > 3"), folder)
    second = stream_dedup.run_stream(spark, folder, state)
    assert second.agg(F.sum("group_size"), F.max("group_size")).first()[:] == (len(document_rows()) - 1, 4)  # all but the NULL identifier


def expected_near(rows, k=4):
    prints = [simhash(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= k:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[find(i)].append(r[0])
    name = {c: min((i for i in ids if i is not None), default=None) for c, ids in least.items()}
    return sorted([(r[0], f"{prints[i]:016x}", name[find(i)]) for i, r in enumerate(rows)], key=str)


def test_near_groups(docs):
    got = sorted(map(tuple, simhash_groups(docs).collect()), key=str)
    assert got == expected_near(document_rows())


def test_near_groups_of_random_fingerprints(spark, monkeypatch):
    """Chains of fingerprints a few bits apart: the components are those of all pairs."""
    import random

    import metaweave.llm.simhash as module

    random.seed(5)
    prints = []
    for _ in range(40):
        x = random.getrandbits(64)
        for _ in range(random.randint(1, 12)):
            prints.append(x)
            for _ in range(random.randint(0, 5)):
                x ^= 1 << random.randrange(64)
    rows = [(i, str(p)) for i, p in enumerate(prints)]
    df = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)], "doc_id long, text long")
    monkeypatch.setattr(module, "fingerprint", lambda text, shingle: text)
    for segments in (2, 3, 4, 5):
        got = dict(module.simhash_groups(df, segments=segments).select("doc_id", "component_id").collect())
        monkeypatch.setattr("tests.llm.test_dedup.simhash", int)
        assert got == {i: c for i, _, c in expected_near(rows)}, segments
        monkeypatch.undo()
        monkeypatch.setattr(module, "fingerprint", lambda text, shingle: text)


def test_layout_covers_every_split_of_the_bits():
    """However k differing bits fall into the segments, one segment differs within its radius."""
    from itertools import product

    for segments in (2, 3, 4, 5):
        radii = [r for _, _, r in _layout(segments, 4)]
        assert sum(w for _, w, _ in _layout(segments, 4)) == 64
        for split in product(range(5), repeat=segments):
            if sum(split) <= 4:
                assert any(d <= r for d, r in zip(split, radii))


def test_near_empty(no_docs):
    assert simhash_groups(no_docs).collect() == []


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = dict(components(links, "a", "b").collect())
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_shingle_hash_is_xxh64_with_seed_42(spark):
    """One short text is one shingle, so its fingerprint is its hash."""
    df = spark.createDataFrame([("one two",)], "t string")
    assert df.select(F.xxhash64("t")).first()[0] % (1 << 64) == simhash("One  TWO")
