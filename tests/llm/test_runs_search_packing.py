"""Periodic runs, ranked search and packing against brute force."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evenground.llm import packing, queries, ranked, runs, tokenfile
from evenground.llm.common import tokenizer_file

TOKENIZER = tokenizer_file("byte_bpe_50k.json")
# columns with the names that the operators use themselves
SCHEMA = "doc_id bigint, text string, key_ string, row_ bigint, part int, n bigint, score string, runs string"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def texts():
    rnd = random.Random(7)
    out = [None, "", " \n\t ", "one", "a " * 400, "a b\n" * 300, "Ä ö\x0bß 🙂 " * 9, "x-Y_z 12.5 ÀB", "<|endoftext|> end", "w" * 3000, "ab" * 4000]
    for i in range(60):
        k = rnd.choice([2, 3, 8, 40])
        words = [f"w{rnd.randrange(k)}" for _ in range(rnd.randint(1, 60))]
        if i % 3 == 0:
            unit = words[: rnd.randint(1, 9)]
            words[5:5] = (unit * 8)[: len(unit) * rnd.randint(2, 7) + rnd.randint(0, len(unit))]
        out.append(rnd.choice([" ", "\n", "  "]).join(words))
    out += [out[20]] * 5 + [" ".join(f"t{rnd.randrange(5000)}" for _ in range(4000))]
    return out


@pytest.fixture(scope="module")
def rows():
    all_ = [(i, t, "k", i, 1, 2, "s", "r") for i, t in enumerate(texts())]
    return all_ + [all_[15], (None, texts()[16], None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def all_runs(words, least=6, times=4):
    """Runs by comparing all words of all lags."""
    out, n = [], len(words)
    for q in range(1, n // times + 1):
        i = q
        while i < n:
            first = i
            while i < n and words[i] == words[i - q]:
                i += 1
            start, length = first - q, i - first + q
            part = words[start : start + length]
            if length >= max(least, times * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((start, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_small_alphabets():
    rnd = random.Random(3)
    for _ in range(300):
        lists = []
        for _ in range(rnd.randint(0, 4)):
            k, words = rnd.choice([1, 2, 3]), []
            while len(words) < 80 and rnd.random() < 0.9:
                unit = [b"%d" % rnd.randrange(k) for _ in range(rnd.randint(1, 7))]
                words += unit * rnd.randint(1, 6) + unit[: rnd.randint(0, len(unit))]
                words *= rnd.choice([1, 1, 1, 4])
            lists.append(words)
        assert runs.runs_of(lists) == [all_runs(w) for w in lists]


def test_runs_of_very_long_texts():
    rnd = random.Random(4)
    began = time.time()
    for words in ([b"a"] * 400_000, [b"a", b"b"] * 200_000, [b"%d" % rnd.randrange(9) for _ in range(400_000)], [b"the", b"%d" % 5] * 3 + [b"the"] * 300_000):
        found = runs.runs_of([words])[0]
        for start, length, q in found[:50]:
            assert words[start + q : start + length] == words[start : start + length - q]
    assert runs.runs_of([[b"a"] * 400_000])[0] == [(0, 400_000, 1)]
    assert time.time() - began < 120


def planted(key, words):
    if key is None:
        return words
    h = zlib.crc32(str(key).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_op11(spark, docs, empty, rows, tmp_path):
    want = []
    for row in rows:
        words = planted(row[0], SPACE.findall(row[1] or ""))
        found = all_runs(words)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        want.append((row[0], len(found), *top, digest, hashlib.sha256(kept.encode()).hexdigest(), len(words)))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op11_periodic_run_detection(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(1 for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0) > 3
    assert runs.periodic_runs(empty).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, times=3)


def lowered(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def best_documents(rows, items, k):
    bags = [(r[0], collections.Counter(lowered(r[1]))) for r in rows]
    bags = [(key, b) for key, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for key, bag in bags:
            m = 50 + 50 * sum(bag.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 20 * m)) for t in set(lowered(text)) if bag[t])
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


ITEMS = [(0, "w1 w2 w3 W4 w7"), (1, "t1 t17 w0 the nothing"), (2, None), (3, "..."), (0, "w1 w2 w3 W4 w7"), (None, "À ÀB 12 x"), (5, "zzz"), (6, " ".join(f"w{i}" for i in range(40)))]


@pytest.mark.parametrize("k,blocks", [(50, 200_000), (3, 200_000), (1, 5)])
def test_op12(spark, docs, rows, monkeypatch, k, blocks):
    monkeypatch.setattr(ranked, "SLICE", 20)
    items = spark.createDataFrame([(i, t, 1, 2) for i, t in ITEMS], "item_id bigint, text string, row_ int, rank int")
    out = ranked.search(docs, items, k=k, block_terms=blocks)
    got = [tuple(r) for r in out.select("query.item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=repr) == best_documents(rows, ITEMS, k)


def test_op12_empty(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert ranked.search(empty, items).count() == 0
    assert ranked.search(docs, items.limit(0)).count() == 0


def test_new_accumulators_end():
    """A frequent term creates no accumulators once the best are out of reach,
    and the survivors are still exact."""
    n = 1000
    terms = np.concatenate((np.zeros(5, np.int64), np.ones(n, np.int64)))
    part = ranked.Slice(np.full(n, 10), terms, np.concatenate((np.arange(5), np.arange(n))), np.ones(n + 5, np.int64), np.array([9000, 2]), n, 10 * n)
    made = []
    real = np.partition
    try:
        np.partition = lambda a, *x: made.append(len(a)) or real(a, *x)
        found, scores = part.best([0, 1], 5, np.arange(n))
    finally:
        np.partition = real
    assert found.tolist() == [0, 1, 2, 3, 4] and made == [5]
    assert len(set(scores.tolist())) == 1 and scores[0] == part.of(0)[1][0] + part.of(1)[1][0]


def check_packing(got, size, want):
    """``got``: doc_id, piece, start, length, crc, sequence, offset."""
    assert sorted((g[:5] for g in got), key=repr) == sorted(want, key=repr)
    at = collections.defaultdict(list)
    for g in got:
        at[g[5]].append((g[6], g[3]))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    return len(at)


def wanted(rows, size):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(TOKENIZER)
    out = []
    for row in rows:
        ids = library.encode(row[1] or "", add_special_tokens=False).ids + [2]
        cuts = [0, *range(len(ids) % size or size, len(ids) + 1, size)] if len(ids) > size else [0, len(ids)]
        for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            out.append((row[0], piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


@pytest.mark.parametrize("size,documents", [(1024, 3), (64, 2), (7, 1)])
def test_op13(docs, rows, size, documents):
    out = packing.packed(docs, TOKENIZER, end=2, size=size, documents=documents)
    got = [tuple(r) for r in out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids").collect()]
    used = check_packing([g[:7] for g in got], size, wanted(rows, size))
    least = max(-(-sum(g[3] for g in got) // size), sum(2 * g[3] > size for g in got))
    assert used <= 1.05 * least + 1
    whole = {r[0]: (r[1], bytes(r[2])) for r in packing.sequences(out).collect()}
    assert len(whole) == used and all(zlib.crc32(bytes(g[7])) == g[4] for g in got)
    for g in got:
        n, ids = whole[g[5]]
        assert len(ids) == 4 * n and ids[4 * g[6] : 4 * (g[6] + g[3])] == bytes(g[7])


def test_op13_edges(spark, docs, empty):
    assert packing.packed(empty, TOKENIZER, end=2).count() == 0
    one = packing.packed(spark.createDataFrame([(1, None), (2, "a")], "doc_id bigint, text string"), TOKENIZER, end=None, ids=False)
    assert sorted(tuple(r)[:4] + tuple(r)[5:] for r in one.collect()) == [(1, 0, 0, 0, None, None), (2, 0, 0, 1, 0, 0)]
    with pytest.raises(ValueError):
        packing.packed(docs, TOKENIZER, documents=4)


@pytest.mark.parametrize("kind", ["even", "small", "skewed", "hot", "one"])
def test_plan(kind):
    rng = np.random.default_rng(2)
    lengths = {
        "even": rng.integers(1, 257, 20_000), "small": rng.integers(1, 20, 20_000), "skewed": np.clip(np.exp(rng.normal(4, 1, 20_000)).astype(int), 1, 256),
        "hot": np.concatenate((np.full(9_000, 150), rng.integers(1, 257, 20_000))), "one": np.array([256])}[kind]
    histogram = np.bincount(lengths, minlength=257)
    plan = packing.plan_of(histogram)
    least = max(-(-int(lengths.sum()) // 256), int((2 * lengths > 256).sum()))
    assert plan.sequences <= 1.01 * least
    order = np.argsort(lengths, kind="stable")
    number = np.empty(len(lengths), np.int64)
    number[order] = np.arange(len(lengths)) - np.searchsorted(lengths[order], lengths[order])
    sequence, offset = plan.places(lengths, number)
    check_packing([(i, 0, 0, int(n), 0, s, o) for i, (n, s, o) in enumerate(zip(lengths, sequence.tolist(), offset.tolist()))], 256,
                  [(i, 0, 0, int(n), 0) for i, n in enumerate(lengths)])


def test_texts_of_a_chunk_are_encoded_as_the_library_does():
    encoder = tokenfile.Encoder(TOKENIZER)
    rnd = random.Random(8)
    parts = ["a", "don't", "the,", " ", "  ", "\n", "\n\n", "\t", "12", "x_1", "é", "ß.", "日本", "\u00a0", "\x1c", "\x85", "'s", "!?", "🙂", "\r\n", "", "<|endoftext|>", "Ċ", "Ġ"]
    some = ["".join(rnd.choice(parts) + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    got = encoder.encode_all(pa.array(some))
    assert [g.tolist() for g in got] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in some]
    assert encoder.encode_all(pa.array([], pa.string())) == []


def test_counts_of_exact_patterns():
    """A histogram made of patterns is used up by the fit."""
    histogram = np.zeros(101, np.int64)
    for lengths, n in (((100,), 7), ((30, 70), 50), ((20, 35, 45), 80), ((10, 10, 80), 40)):
        for x in lengths:
            histogram[x] += n
    rest = histogram.copy()
    groups = packing.fitted(rest)
    assert sum(g.repeat for g in groups) >= 170 and rest.sum() <= 20
    assert packing.plan_of(histogram).sequences == 177
