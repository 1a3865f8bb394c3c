"""Language model, packing, tokens and line rules against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from metaweave.llm import byte_bpe, line_frequency, maxent_lm, packing
from metaweave.llm.common import split_pattern, tokenizer_path
from metaweave.llm.plain_words import split_tail

from .conftest import document_rows


# --- language model -----------------------------------------------------------------------------


def lm_rows(df, **options):
    found = maxent_lm.lm_scores(df, ~maxent_lm.held_out_fold(), carry={"held_out": maxent_lm.held_out_fold()}, **options)
    return sorted((r.asDict() for r in found.collect()), key=lambda r: str(r["doc_id"]) + str(r["n_tokens"]))


@pytest.mark.parametrize("table_words", [250_000, 30, 0])
def test_lm_counts_and_base(docs, table_words):
    """Base scores are exact, whether a word's count is in the broadcast table or joined."""
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    rows = [(r[0], maxent_lm.tokens(r[1]) + [b""]) for r in document_rows()]
    c = Counter(w for i, t in rows if not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted(((i, held(i), len(t), sum(w in c for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) for i, t in rows), key=lambda r: str(r[0]) + str(r[2]))
    got = lm_rows(docs, table_words=table_words)
    assert [(g["doc_id"], g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) for g in got] == [w[:5] for w in want]
    assert np.allclose([g["base_score"] for g in got], [w[5] for w in want])
    assert all(g["score"] < 0 for g in got)


def test_lm_probabilities_sum_to_one(docs):
    """Over all known words, one unknown word of each class, and the end, after some history."""
    train = docs.where(~maxent_lm.held_out_fold()).select("text", F.lit(0).alias("part"))
    counts = maxent_lm.count_words(train, "text")
    v = maxent_lm.vocabulary(counts)
    vocab = docs.sparkSession.sparkContext.broadcast(v)
    w = maxent_lm.train_weights(train, "text", vocab, v.priors(), rounds=1)
    index = maxent_lm.Index(v)
    index.numbers([[b"the", b"quick"]])
    history = [index.number[b"the"], index.number[b"quick"]]
    number = np.arange(len(v.words) + 1)  # all words of the table, and the end
    flat = np.concatenate([[*history, x] for x in number])
    _, rows, cls = index.examples(flat)
    z = maxent_lm.log_softmax(w, rows[2::3])
    said = z[np.arange(len(number)), cls[2::3]] / np.log(10) + index.inside[number]
    unseen = sum(10 ** (z[0, c] / np.log(10)) / (v.class_totals[c] + v.class_words[c] + 1) for c in range(maxent_lm.OWN_CLASSES + 1, maxent_lm.CLASSES))
    # a shared class gives (c + 1) / (N + V + 1) to each of its words and 1 / (N + V + 1) to all unseen ones
    assert np.isclose((10.0**said).sum() + unseen, 1, atol=1e-4)


def test_lm_numbers_after_the_memo_is_emptied(monkeypatch):
    v = maxent_lm.Vocabulary([b"the", b"a"], np.array([5, 3]), 20, 9, np.full(maxent_lm.CLASSES, 2.0), np.ones(maxent_lm.CLASSES))
    texts = [[f"w{i % 90}".encode(), b"the", f"x{i}".encode()] for i in range(200)]

    def seen(index):
        out = []
        for t in texts:
            flat = index.numbers([t, [b"a"]])
            place, rows, cls = index.examples(flat)
            words = [index.extra[x - index.in_table] if x >= index.in_table else x for x in flat[place].tolist()]
            out.append((words, rows.tolist(), cls.tolist(), index.inside[flat[place]].tolist(), index.known[flat[place]].tolist()))
        return out

    want = seen(maxent_lm.Index(v))
    monkeypatch.setattr(maxent_lm, "_MEMO", 20)
    assert seen(maxent_lm.Index(v)) == want


def test_lm_index_is_kept_by_the_worker_and_a_reset_keeps_the_vocabulary(monkeypatch):
    """All tasks of a worker share one index; a full one forgets other words without describing the vocabulary again."""
    import pickle

    v = maxent_lm.Vocabulary([b"the", b"a"], np.array([5, 3]), 20, 9, np.full(maxent_lm.CLASSES, 2.0), np.ones(maxent_lm.CLASSES))
    sent = pickle.loads(pickle.dumps(v))
    assert sent.index is sent.index
    described = []
    real = maxent_lm.Index._describe
    monkeypatch.setattr(maxent_lm.Index, "_describe", lambda self, words, first: (described.extend(words), real(self, words, first))[1])
    monkeypatch.setattr(maxent_lm, "_MEMO", 10)
    for i in range(40):
        flat = sent.index.numbers([[b"the", f"x{i}".encode()], [b"a"]])
        assert flat.tolist()[2] == 0 and flat.tolist()[4] == sent.index.end and sent.index.filled < 20
    assert len(described) == 40 and b"the" not in described


def test_lm_counts_words_as_tokens_do(spark, monkeypatch):
    """Upper and lower case, all white space, signs, null and empty texts; parts that are flushed add up."""
    texts = [" The the\tTHE\x0b\x0cÀ à\r\nend ", None, "", " \n ", "a\x1cb\x85c\u00a0d nul\x00l", "ÉÉ éé İ 日本 🙂 🙂"] + [f"w{i % 40} W{i}" for i in range(50)]
    want = Counter(w.decode() for t in texts for w in [*maxent_lm.tokens(t), b""])
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    for flush, at_once in ((maxent_lm._FLUSH, 1024), (10, 3), (1, 1)):
        monkeypatch.setattr(maxent_lm, "_FLUSH", flush)
        monkeypatch.setattr(maxent_lm, "_COUNTED", at_once)
        rows = maxent_lm.count_words(df, "text").collect()
        assert len(rows) == len(want) and {r["word"]: r["n"] for r in rows} == want
    assert maxent_lm.count_words(df.limit(0), "text").isEmpty()


def test_lm_gradient_sums_of_rows_that_occur_once_and_often():
    """Each feature row once, its sum over its tokens added in double precision and in their order."""
    rng = np.random.default_rng(3)
    for tokens, most in ((1, 1), (300, 40), (300, 10**4), (64, 1)):
        g = rng.normal(size=(tokens, 8)).astype(np.float32)
        rows = np.stack([rng.integers(0, most, tokens), 20_000 + rng.integers(0, most, tokens), 40_000 + np.arange(tokens)], 1)
        used, part = maxent_lm.row_sums(g, rows)
        want = defaultdict(lambda: np.zeros(8))
        for i, k in enumerate(rows.tolist()):
            for x in k:
                want[x] = want[x] + g[i].astype(np.float64)
        assert sorted(used.tolist()) == sorted(want) and part.dtype == np.float32
        assert all(np.array_equal(p, want[k].astype(np.float32)) for k, p in zip(used.tolist(), part))


def test_lm_beats_its_base_on_held_out_text(spark):
    rng = random.Random(3)
    a, b = [f"al{i}" for i in range(40)], [f"{i}be" for i in range(40)]
    rows = [(i, " ".join(rng.choice(a if i % 2 else b) for _ in range(80))) for i in range(300)]
    got = lm_rows(spark.createDataFrame(rows, "doc_id long, text string"))
    held = [g for g in got if g["held_out"]]
    assert sum(g["score"] for g in held) > sum(g["base_score"] for g in held) + 0.05 * sum(g["n_tokens"] for g in held)


def test_lm_empty(no_docs):
    assert lm_rows(no_docs) == []


# --- packing -------------------------------------------------------------------------------------


def test_packing_places_every_id_once(docs):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    plain.encode_special_tokens = True
    rows = packing.pack_documents(docs.where("doc_id <> 4"), tokenizer_path("word_bpe_49k.json"), block_tokens=3000, with_ids=True).collect()
    texts = {r[0]: r[1] or "" for r in document_rows() if r[0] is not None}
    pieces = {}
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["ids"], r["doc_tokens"]))
    for i, found in pieces.items():
        want = plain.encode(texts[i], add_special_tokens=False).ids + [2]
        found.sort()
        assert [x for _, ids, _ in found for x in ids] == want and found[0][2] == len(want)
        assert [s for s, _, _ in found] == [sum(len(x) for _, x, _ in found[:k]) for k in range(len(found))]
    assert set(pieces) == set(texts) - {4}
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in sequences.values():
        found.sort()
        total = 0
        for offset, n in found:
            assert offset == total
            total += n
        assert total == 4096 or total & (total - 1) == 0


def test_packing_prefers_the_cheapest_sequence():
    pieces = packing.pack([10, 10, 6, 6, 4, 4, 12, 12], capacity=32)
    cost = Counter()
    for _, _, n, s, _ in pieces:
        cost[s] += packing.piece_cost(n)
    assert len(cost) == 2 and max(cost.values()) / min(cost.values()) < 1.01
    assert packing.pack([0, 70], 32)[0] == (1, 0, 32, 0, 0) and packing.pack([], 32) == []


def test_packing_null_ids_repeats_and_empty(docs, no_docs):
    path = tokenizer_path("word_bpe_49k.json")
    rows = packing.pack_documents(docs.where("doc_id is null or doc_id in (4, 5, 6)"), path).collect()
    assert Counter((r["doc_id"], r["doc_tokens"]) for r in rows if r["start"] == 0) == Counter({(None, 7): 1, (4, 24): 2, (5, 1): 1, (6, 1): 1})
    assert packing.pack_documents(no_docs, path).collect() == []


PARTS = [" ", "  ", "\n", "\t", "a", "B", "aa", "the", "1", "22", "é", "É", "ü", "漢", "🙂", "'s", "'", "!", "...", " ", "x́", "J̌", "_", "-", "ing", "\r\n", "\x1c", "\x85", "İ", "½", "‍", "<|endoftext|>", "Å", "ß", "Σ", ".", ","]


def odd_texts(n):
    rng = random.Random(9)
    return ["".join(rng.choice(PARTS) * rng.choice([1, 1, 1, 2, 7]) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_word_ids_equal_the_tokenizers():
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    texts = odd_texts(3000)
    got = packing.WordCoder(path).ids(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


# --- byte-level BPE --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.Coder(tokenizer_path("byte_bpe_multi_50k.tiktoken"), split_pattern())


def test_byte_ids_equal_tiktokens(coder):
    import tiktoken

    ranks = byte_bpe.read_ranks(tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=split_pattern(), mergeable_ranks=ranks, special_tokens={})
    texts = odd_texts(5000) + [r[1] or "" for r in document_rows()]
    for t, g in zip(texts, coder.encode_batch(texts)):
        assert np.frombuffer(g, "<u4").tolist() == plain.encode_ordinary(t), t
        assert coder.decode(g) == t.encode()


def test_offsets_and_split_characters(coder):
    text = "漢字 🙂 x"
    found = coder.offsets(text)
    assert [a for _, a, _ in found[1:]] == [b for _, _, b in found[:-1]] and found[-1][2] == len(text.encode())
    assert any(not 0x80 <= b < 0xC0 for b in text.encode()) and len(found) > 3


def test_byte_columns(docs):
    path, pattern = tokenizer_path("byte_bpe_multi_50k.tiktoken"), split_pattern()
    ids = docs.select("text", byte_bpe.encode(F.col("text"), path, pattern).alias("ids"))
    back = ids.select("text", byte_bpe.decode(F.col("ids"), path, pattern).alias("b")).collect()
    assert all((r["text"] or "").encode() == bytes(r["b"]) for r in back)


def test_split_tail():
    assert split_tail("word...") == ("word", "...") and split_tail("...") == ("...", "") and split_tail("") == ("", "")
    assert split_tail("a'") == ("a", "'") and split_tail("x́!") == ("x́!", "")


# --- line rules --------------------------------------------------------------------------------------


def line_rows():
    rows = document_rows()
    blanks = re.compile(r"[\x20\x09-\x0D]+")
    normal = lambda x: " ".join(w for w in blanks.split(re.sub(r"[1-9]", "0", x.lower())) if w)
    lines = [[x for x in (r[1] or "").split("\n") if blanks.sub("", x)] for r in rows]
    holders = defaultdict(set)
    texts = defaultdict(set)
    for r, ls in zip(rows, lines):
        texts[r[3]].add(r[1] or "")
        for y in ls:
            holders[r[3], normal(y)].add(r[1])
    out = []
    for r, ls in zip(rows, lines):
        t = r[1] or ""
        w = [x for x in blanks.split(t) if x]
        windows = Counter(zip(w, w[1:], w[2:]))
        spots = {p + k for p, g in enumerate(zip(w, w[1:], w[2:])) if windows[g] > 1 for k in range(3)}
        lost = sum(len(normal(x).split(" ")) for x in ls if len(holders[r[3], normal(x)]) > max(5, 0.05 * len(texts[r[3]])))
        base = len(w) < 50 or 2 * len(spots) > len(w)
        out.append((r[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(ls) - len(set(ls)), len(spots), lost, base, not base and not 10 * lost > 7 * len(w)))
    return sorted(out, key=str)


def test_line_rules(docs, docs_file):
    for df in (docs, docs_file):
        assert sorted(map(tuple, line_frequency.line_frequency(df).collect()), key=str) == line_rows()


def test_depleted_documents_are_rejected(docs):
    got = line_frequency.line_frequency(docs, max_removed=0.05).where("n_removed_words > 0 and n_words >= 50")
    assert got.count() > 20 and not got.where("kept").count()


def test_copies_of_a_clean_text_count_once(spark):
    """25 copies of one text keep their lines; a line that many different texts share goes, at any size of the host."""
    clean = "\n".join(" ".join(f"w{chr(97 + i)}{chr(97 + j)}" for j in range(12)) for i in range(8))
    other = ["a line that most texts hold\n" + " ".join(f"{chr(97 + i)}{chr(97 + j)}" for j in range(20)) for i in range(12)]
    for scale in (1, 10):
        rows = [(k, clean, "s") for k in range(25 * scale)] + [(1000 + k, t, "s") for k, t in enumerate(other)]
        got = {r["doc_id"]: r for r in line_frequency.line_frequency(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
        assert all(got[k]["kept"] and not got[k]["n_removed_words"] for k in range(25 * scale))
        assert all(got[1000 + k]["n_removed_words"] == 6 for k in range(len(other)))


def test_the_registered_query_removes_lines(spark):
    from metaweave.llm.queries import QUERIES

    assert QUERIES["op10_line_frequency"](spark, "/root/testdata/sf0.01").where("n_removed_words > 0").count() > 20


def test_line_rules_empty(no_docs):
    assert line_frequency.line_frequency(no_docs).collect() == []


def test_line_rules_run_without_python(docs):
    plan = line_frequency.line_frequency(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_word_coder_learns_frequent_words_once_and_forgets_the_last(monkeypatch):
    """A full memo keeps the words that came first; whatever it holds, ids are those of the library."""
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    common = "The house, the HOUSE! Déjà-vu ŉa ſs Ⱥb ǅx İstanbul a1, ,, x́y Ωσς, ÿŸ... 日本語。 <|endoftext|> don't"
    texts = [f"{common} rare{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{i}, Zß{i}" for i in range(2000)] + [None, "", " \n"]
    monkeypatch.setattr(packing, "MEMO_ENTRIES", 600)
    monkeypatch.setattr(packing, "MEMO_KEPT", 100)
    coder = packing.WordCoder(path)
    learnt = []
    real = coder._learn
    monkeypatch.setattr(coder, "_learn", lambda new: (learnt.extend(new), real(new)))
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.ids(texts)]
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert learnt.count(b"HOUSE!") == 1 and len(coder.number) < 600 + 2 * 256 + 20
