"""Operators against brute force on small tables, and their edge cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from evenground.llm import backoff, html, lines, pieces, quality, secrets, simhash, suffixes, tiling, tokenfile
from evenground.llm.common import components, tokenizer_file

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row_ string, id_ int, fp string"
WORDS = "der die und ist the of and from river stone house tree under light green water".split()


def sample(n=40, seed=5):
    """Texts with copies, near copies, shared passages, secrets, odd spaces,
    NULLs in every column, ties and repeated rows; columns with names that the
    operators use themselves."""
    rnd = random.Random(seed)
    passage = " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 99)) for _ in range(90))
    texts = [None, "", " \n\t", "one", "ÄÖ ü\n\nß 🙂 ▁x  y", "a" * 900, "ab " * 500, "<|endoftext|> and <s>"]
    for i in range(n):
        lines_ = [" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 30))) for _ in range(rnd.randint(1, 6))]
        if i % 4 == 0:
            lines_.insert(rnd.randint(0, len(lines_)), passage)
        if i % 5 == 0:
            lines_ += [f'token = "{hashlib.sha1(str(i % 10).encode()).hexdigest()}"', "AKIA" + "ABCDEFGH12345678"[: 12 + i % 5], f"Password: x{i}", "secret=ab secret=abcdef99"]
        texts.append("\n".join(lines_))
    texts += [texts[12], texts[12] + " end", texts[20], texts[20].upper(), texts[9], texts[9]]
    rows = [(i, t, rnd.choice(["en", "de", None]), rnd.choice(["a", "b", None]), len(t or ""), "r", i, "f") for i, t in enumerate(texts)]
    return rows + [(None, texts[12], None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(sample(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *names):
    return sorted(map(tuple, df.select(*names).collect() if names else df.collect()), key=repr)


def test_suffix_arrays():
    rnd = random.Random(1)
    for _ in range(60):
        k = rnd.choice([1, 2, 3, 20])
        t = np.array([rnd.randint(1, k) for _ in range(rnd.randint(1, 50))] + [0])
        want = sorted(range(len(t)), key=lambda i: t[i:].tolist())
        assert suffixes.suffix_array(t.astype(np.uint16), k + 1).tolist() == want
        assert suffixes.suffix_array(t).tolist() == want


@pytest.mark.parametrize("hot", [4000, 0])
def test_op1(docs, empty, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "SEED_PIECES", hot)
    texts = [(r[0], (r[1] or "").encode()) for r in sample()]
    size = 100
    often = collections.Counter(t[i : i + size] for _, t in texts for i in range(len(t) - size + 1))
    want = []
    for key, t in texts:
        mark = np.zeros(len(t), bool)
        for i in range(len(t) - size + 1):
            if often[t[i : i + size]] > 1:
                mark[i : i + size] = True
        kept = bytes(b for b, m in zip(t, mark) if not m)
        spans = sum(1 for i, m in enumerate(mark) if m and (i == 0 or not mark[i - 1]))
        want.append((key, len(t), int(mark.sum()), spans, hashlib.sha256(kept).hexdigest()))
    assert rows(suffixes.remove_repeats(docs, size=size)) == sorted(want, key=repr)
    assert suffixes.remove_repeats(empty).count() == 0


def test_op2(spark, docs, empty):
    rnd = random.Random(2)
    item = [f"q{i}" for i in range(40)]
    moved = item[20:] + item[:20]
    texts = {1: "x y " + " ".join(item) + " z", 2: " ".join(moved), 3: " ".join(item[:12]), 4: " ".join(rnd.sample(item, 40)), 5: None, 6: ""}
    table = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    bench = spark.createDataFrame([(7, " ".join(item), 1), (8, None, 1), (9, "too short", 1), (None, " ".join(item), 2)], "item_id int, text string, extra int")
    out = {r[0]: (r[1], r[2]) for r in tiling.decontaminate(table, bench).select("row_.doc_id", "n_items", "max_coverage").collect()}
    assert out[1] == (2, 1.0) and out[2] == (2, 1.0)
    assert all(out[k] == (0, 0.0) for k in (3, 4, 5, 6))
    assert tiling.decontaminate(empty, bench).count() == 0
    assert tiling.decontaminate(docs, bench.limit(0)).where("n_items > 0").count() == 0
    assert tiling.decontaminate(docs, bench).count() == docs.count()


def test_greedy_tiles_are_the_longest_runs_left():
    rnd = random.Random(3)
    for _ in range(100):
        a, b = ([rnd.randint(1, 3) for _ in range(rnd.randint(0, 25))] for _ in range(2))
        want = 0
        used_a, used_b = [False] * len(a), [False] * len(b)
        while True:
            best = []
            size = 2
            for i in range(len(a)):
                for j in range(len(b)):
                    n = 0
                    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not used_a[i + n] and not used_b[j + n]:
                        n += 1
                    if n > size:
                        best, size = [(i, j)], n
                    elif n == size:
                        best.append((i, j))
            if not best:
                break
            for i, j in best:
                if not any(used_a[i : i + size]) and not any(used_b[j : j + size]):
                    used_a[i : i + size] = used_b[j : j + size] = [True] * size
                    want += size
        assert sum(t[2] for t in tiling.tiles(a, b, 2)) == want


def test_op3(spark, docs, empty):
    table = [(r[0], r[1] or "") for r in sample()]

    def finger(text):
        w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if x]
        sh = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0

    fps = [finger(t) for _, t in table]
    root = list(range(len(fps)))
    for _ in fps:
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= 2:
                    root[i] = root[j] = min(root[i], root[j])
    least = {r: min((k for (k, _), q in zip(table, root) if q == r and k is not None), default=None) for r in root}
    want = sorted(((k, f"{f:016x}", least[r]) for (k, _), f, r in zip(table, fps, root)), key=repr)
    assert rows(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == want
    assert simhash.near_duplicates(empty).count() == 0


def test_links_of_several_fingerprints(docs):
    table = [(r[6], (r[1] or "").encode()) for r in sample() if r[6] is not None]
    fps = []
    for _, t in table:
        h = simhash.shingle_hashes(t, 5)
        fps.append([simhash.voted(h), *(simhash.voted(pieces.mix(h + np.uint64(int(pieces.FACTOR) * k % 2**64))) for k in range(1, 4))])
    root = list(range(len(fps)))
    for _ in fps:
        for i in range(len(fps)):
            for j in range(len(fps)):
                if any((a ^ b).bit_count() <= 2 for a, b in zip(fps[i], fps[j])):
                    root[i] = root[j] = min(root[i], root[j])
    want = sorted((table[i][0], table[r][0]) for i, r in enumerate(root))
    assert rows(simhash.near_duplicates(docs.where("id_ IS NOT NULL"), "id_", size=5, times=4), "id_", "component_id") == sorted(want, key=repr)


def test_covering_tables_miss_no_pair(spark):
    rnd = random.Random(4)
    for radius in (2, 4):
        masks = simhash.masks(radius)
        for _ in range(500):
            changed = sum(1 << b for b in rnd.sample(range(64), radius))
            assert any(not changed & m for m in masks)
    base = [rnd.getrandbits(63) for _ in range(20)]
    # one bucket of many members, linked in a chain and as a ball
    values = list({b ^ (1 << i) ^ (1 << j) for b in base[:3] for i in range(12) for j in range(12)} | set(base))
    edges = simhash.links(spark.createDataFrame([(v,) for v in values], "fp bigint"))
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    root = {v: v for v in values}
    for _ in range(4):
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= 2:
                    root[a] = root[b] = min(root[a], root[b])
    assert {v: found.get(v, v) for v in values} == root


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + star + [(7, 7)], "a bigint, b bigint")).collect()}
    assert set(out.values()) == {0, 100} and len(out) == 41 + 60 and out[40] == 0
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_op4(docs, empty):
    order = sorted(sample(), key=lambda r: (r[0] is None, r[0] or 0))
    seqs = [[(o, x.strip(lines.SPACE)) for o, x in enumerate((r[1] or "").split("\n"))] for r in order]
    seqs = [[(o, x, len(x.split())) for o, x in s if x] for s in seqs]
    want = []
    for a, (r, s) in enumerate(zip(order, seqs)):
        gone = set()
        for k in range(len(s)):
            for b in range(a + 1):
                for j in range(len(seqs[b]) if b < a else k):
                    n = words = 0
                    while k + n < len(s) and j + n < len(seqs[b]) and s[k + n][1] == seqs[b][j + n][1]:
                        words += s[k + n][2]
                        n += 1
                    if words >= 50:
                        gone |= {s[k + m][0] for m in range(n)}
        text = r[1] if not gone else "\n".join(x for o, x in enumerate(r[1].split("\n")) if o not in gone)
        want.append((r[0], len(gone), text))
    assert sum(w[1] for w in want) > 5
    assert rows(lines.line_dedup(docs), "row_.doc_id", "n_removed", "kept") == sorted(want, key=repr)
    assert lines.line_dedup(empty).count() == 0


def test_op5(spark, docs, empty, tmp_path):
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    want, start = [], 0
    table = sorted(sample(), key=lambda r: (r[0] is not None, r[0] or 0))
    for r in table:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    tokenfile.write(docs, f"file://{tmp_path}/t", path, end=2, block_ids=500)
    assert rows(tokenfile.read(spark, f"file://{tmp_path}/t")) == sorted(want, key=repr)
    tokenfile.write(empty, f"file://{tmp_path}/e", path, end=2)
    assert tokenfile.read(spark, f"file://{tmp_path}/e").count() == 0


def test_stretches_are_encoded_as_the_library_does():
    encoder = tokenfile.Encoder(tokenizer_file("byte_bpe_50k.json"))
    rnd = random.Random(7)
    parts = ["a", "don't", "the,", " ", "  ", "\n", "\n\n", "\t", "12", "x_1", "é", "ß.", "日本", "\u00a0", "\u2003", "'s", "!?", "🙂", "\r\n", ""]
    for _ in range(1500):
        text = "".join(rnd.choice(parts) + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 12)))
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == want, text


def test_packed_numbers():
    rnd = np.random.default_rng(6)
    for n in (0, 1, 3, 4, 5, 1000):
        ids = (rnd.integers(0, 2**32, n, dtype=np.uint64) >> rnd.integers(0, 32, n, dtype=np.uint64)).astype(np.uint32)
        lengths, back = tokenfile.unpack(tokenfile.pack(np.array([n], np.uint32), ids))
        assert lengths.tolist() == [n] and back.tolist() == ids.tolist()


def test_op6(docs, empty):
    out = {r["doc_id"]: r["m"] for r in quality.quality(docs).collect()}
    for key, text, *_ in sample():
        text = text or ""
        w = [x for x in re.split("[\x20\x09-\x0d]+", text) if x]
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        count, cover = collections.Counter(grams), set()
        for i, g in enumerate(grams):
            if count[g] > 1:
                cover |= set(range(i, i + 5))
        full = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        m = out[key]
        assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(full) - len(set(full)), len(cover))
        assert m["base_failed"] == (len(w) < 10 or 100 * len(cover) > 20 * len(w))
        assert not (m["kept"] and m["base_failed"])
    assert quality.quality(empty).count() == 0
    assert quality.quality(docs, all_columns=True).select(*docs.columns).count() == docs.count()


def test_op6_rejects_what_is_unlike_its_language(spark):
    rnd = random.Random(8)
    plain = [(i, " ".join(rnd.choice(WORDS[:8] * 3 + WORDS) + rnd.choice(["", "", "ly", "ing"]) for _ in range(120)), "en") for i in range(300)]
    odd = [(1000 + i, " ".join("".join(rnd.choice("QXZ#$%019") for _ in range(6)) for _ in range(120)), "en") for i in range(3)]
    out = {r["doc_id"]: r["m"]["kept"] for r in quality.quality(spark.createDataFrame(plain + odd, "doc_id int, text string, lang string")).collect()}
    assert all(out[i] for i in range(300)) and not any(out[1000 + i] for i in range(3))


def test_op6_small_languages_have_their_own_reference(spark):
    rnd = random.Random(3)
    vocabularies = {k: [f"{k}{rnd.choice('aeiou')}{i}" for i in range(30)] for k in ("en", "de", "fr")}
    text = lambda k: " ".join(rnd.choice(vocabularies[k][:6] * 4 + vocabularies[k]) for _ in range(120))
    good = [(i, text(k), k) for i, k in enumerate(["en"] * 300 + ["de"] * 12 + ["fr"] * 12)]
    nulls = [(1000 + i, text(k), None) for i, k in enumerate(["en", "de", "fr"])]
    junk = lambda: " ".join("".join(rnd.choice("QXZ#$%019") for _ in range(6)) for _ in range(120))
    odd = [(2000, junk(), "de"), (2001, junk(), None)]
    for n in (300, 15):  # the second table is under 20,000 words in all
        table = good[:n] + good[300:] + nulls + odd
        out = {r["doc_id"]: r["m"] for r in quality.quality(spark.createDataFrame(table, "doc_id int, text string, lang string")).collect()}
        assert {i for i, m in out.items() if not m["kept"]} == {2000, 2001}
        assert all(m["word_js"] is not None and m["class_js"] is not None for m in out.values())
    none = quality.quality(spark.createDataFrame([(1, text("en"), None)], "doc_id int, text string, lang string")).first()["m"]
    assert none["kept"] and none["word_js"] is None and none["class_js"] is None


def test_op7(spark, docs, empty):
    assign = re.compile(r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    out = collections.defaultdict(list)
    for r in secrets.secret_spans(docs).collect():
        out[r["doc_id"]].append([(s["start"], s["rank"], s["stop"]) for s in r["spans"] if s["rank"] < 3])
    for key, text, *_ in sample():
        text = text or ""
        want = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[1]) >= 6]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert out[key] == [sorted(want)]
    assert secrets.secret_spans(empty).count() == 0
    own, copied = "Zk3xQ9vLw2Rt8Yp5Nb7c", "Hj4kLm8nBv2cXz6aSd9f"
    table = [(1, f"see 🙂 {own} {copied}", "a"), (2, f"{copied} x", "b"), (3, None, None)]
    found = {r["doc_id"]: [(s["start"], s["value"], s["owners"]) for s in r["spans"]] for r in secrets.secret_spans(
        spark.createDataFrame(table, "doc_id int, text string, source string")).collect()}
    assert found == {1: [(6, own, 1)], 2: [], 3: []}


def test_op8(docs, empty):
    path = tokenizer_file("piece_bpe_32k.model")
    out = pieces.sampled_pieces(docs, path)
    assert rows(out, "doc_id", "decoded") == sorted(((r[0], r[1] or "") for r in sample()), key=repr)
    assert out.where("NOT lossless").count() == 0
    again = pieces.sampled_pieces(docs.repartition(5), path)
    assert rows(out, "doc_id", "ids_crc32", "n_pieces") == rows(again, "doc_id", "ids_crc32", "n_pieces")
    assert rows(out, "ids_crc32") != rows(pieces.sampled_pieces(docs, path, seed=8), "ids_crc32")
    assert pieces.sampled_pieces(empty, path).count() == 0


def test_sampled_paths_have_their_probabilities():
    lattice = pieces.Lattice(tokenizer_file("piece_bpe_32k.model"), 1.0)
    text, n = "then", 6000
    drawn = collections.Counter(tuple(x.tolist()) for x in lattice.sample([text] * n, np.arange(n, dtype=np.uint64) * np.uint64(7919)))
    ids, weights = {t: i for i, t in lattice.text.items()}, {}

    def walk(rest, path, weight):
        if not rest:
            weights[tuple(path)] = weight
        for k in range(1, len(rest) + 1):
            if rest[:k] in ids:
                walk(rest[k:], [*path, ids[rest[:k]]], weight * math.exp(lattice.weight[ids[rest[:k]]]))

    walk(" " + text, [], 1.0)
    total = sum(weights.values())
    assert set(drawn) <= set(weights)
    for path, weight in weights.items():
        share = weight / total
        assert abs(drawn[path] / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-3


PAGE = """<html><head><title>t</title><script>var a="</p>";</script></head><body><header class="top">Site</header>
<nav><ul><li><a href="/">Home</a></ul></nav><div class="ad">Buy <b>now</b></div><div id="cookie-notice">We use cookies</div>
<div class="page"><div class="story-{n}"><h1>Head &amp; line</h1><p>First {n} para with <a href="x">a link</a>,
and enough words to count as the text of a page.<p>Second &eacute; para, also long enough to be counted as text here.</p><form><input>Mail</form>
<aside>Aside</aside></div><div class="sidebar"><p>Related</p></div><section class="comments"><p>{long}</p></section></div><footer>&copy; me</footer></body></html>"""


def test_op9(spark):
    want = "Head & line First {n} para with a link, and enough words to count as the text of a page. Second é para, also long enough to be counted as text here."
    table = [(i, f"http://www.A.example/{i}", PAGE.replace("{n}", str(i)).replace("{long}", "A comment of a reader. " * 40)) for i in range(6)]
    table += [(90, None, None), (91, "odd", ""), (92, "http://b.example/x", "plain text &lt; no tags"), (93, "http://c.example", "<p>un<b>closed"), (94, "http://c.example", "<div><span")]
    out = {r["page_id"]: (r["text"], r["n_chars"]) for r in html.extract(spark.createDataFrame(table, "page_id int, url string, html string")).collect()}
    for i in range(6):
        assert out[i][0] == want.replace("{n}", str(i)) and out[i][1] == len(out[i][0])
    assert out[90] == out[91] == ("", 0)
    assert out[92][0] == "plain text < no tags" and out[93][0] == "unclosed"
    assert html.extract(spark.createDataFrame([], "page_id int, url string, html string")).count() == 0


def test_op9_keeps_all_text_that_is_not_noise(spark):
    a, b, c = "lead " * 20, "first part " * 55, "second part " * 50
    pages = [
        f"<body><nav>menu</nav><article><h1>A long head line</h1><p>{a}</p><section><p>{b}</p><p>{c}</p></section></article><div><a href='x'>more</a></div></body>",
        f"<body><main><h1>A long head line</h1><div class='lead'>{a}</div><div class='story'><p>{b}</p><p>{c}</p></div></main></body>",
        f"<h1>A long head line</h1><p>{a}</p><div><p>{b}</p><p>{c}</p></div>"]
    table = [(10 * k + i, f"http://{k}.example/{i}", page) for k, page in enumerate(pages) for i in range(3)]
    want = " ".join(f"A long head line {a}{b}{c}".split())
    assert {r["text"] for r in html.extract(spark.createDataFrame(table, "page_id int, url string, html string")).collect()} == {want}


@pytest.mark.parametrize("unit", [1, 12_000_000])
def test_op10(docs, empty, unit, monkeypatch):
    monkeypatch.setattr(backoff, "UNIT_BYTES", unit)
    monkeypatch.setattr(backoff, "BUCKET_TOKENS", 200)
    table = [(r[0], (r[1] or "").encode().lower().split() + [None], zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 7 == 2) for r in sample()]
    c, pairs = collections.Counter(), collections.Counter()
    for _, w, held in table:
        if not held:
            c.update(w)
            pairs.update(zip([None, *w[:-1]], w))
    n, v, prior = sum(c.values()), len(c), 100.0
    want = {}
    for key, w, held in table:
        root = [(c[x] + 1) / (n + v + 1) for x in w]
        score = sum(math.log10((pairs[h, x] + prior * p) / (c[h] + prior) if c[h] else p) for h, x, p in zip([None, *w[:-1]], w, root))
        want[key] = (held, len(w), sum(c[x] > 0 for x in w), n, sum(map(math.log10, root)), score)
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    out = {r["doc_id"]: tuple(r)[1:] for r in backoff.score_texts(docs, held_out=held_out).collect()}
    assert out.keys() == want.keys()
    for key, w in want.items():
        assert out[key][:4] == w[:4] and out[key][4:] == pytest.approx(w[4:], abs=1e-9)
    assert backoff.score_texts(empty).count() == 0


def test_model_weights_sum_to_one():
    counts, pairs = np.array([5.0, 3.0, 2.0, 0.0]), np.array([2.0, 1.0, 0.0, 0.0])
    weights = 10 ** backoff.walk(counts, np.full(4, 3.0), pairs, 10, 3, 100.0)
    # three words seen, and one place for all others
    assert weights.sum() == pytest.approx(1.0)


def test_a_worker_keeps_few_enough_pre_tokens():
    # several workers share an executor of 3,000 MB with its heap
    from evenground.llm import tokenfile

    assert tokenfile.CACHE <= 750_000 and tokenfile.CHUNK_BYTES <= 8_000_000


def test_kept_pre_tokens_take_few_bytes():
    import tracemalloc

    import pyarrow as pa

    encoder = tokenfile.Encoder(tokenizer_file("byte_bpe_50k.json"))
    encoder.encode("a first call loads what the library needs, too.")
    rnd = random.Random(3)
    text = " ".join({"".join(rnd.choices("aeiounrst", k=8)) for _ in range(60_000)})
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes()
    encoder.encode(text)
    kept = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    # some 35 bytes each; Python strings and a dict took about 175
    assert kept < 60 * 60_000


def test_pre_tokens_beyond_the_bounds_are_encoded_alike(monkeypatch):
    import pyarrow as pa

    for name, value in (("CACHE", 50), ("LONGEST", 4), ("LEARNED", 7), ("TOGETHER", 5)):
        monkeypatch.setattr(tokenfile, name, value)
    encoder = tokenfile.Encoder(tokenizer_file("byte_bpe_50k.json"))
    rnd = random.Random(5)
    parts = [*WORDS, "don't", "the,", " ", "  ", "\n", "\n\n", "12", "é.", "日本", "\u00a0", "word.\nWord", "<|endoftext|>"]
    for k in range(60):
        some = [" ".join(rnd.choice(parts) + str(k) * rnd.randint(0, 1) for _ in range(rnd.randint(0, 40))) for _ in range(rnd.randint(1, 20))]
        got = encoder.encode_all(pa.array(some))
        assert [g.tolist() for g in got] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in some]
        assert len(encoder.known) == len(encoder.sizes) <= 50 and int(encoder.sizes.sum()) == len(encoder.flat)


def test_lattices_are_held_in_slices(monkeypatch):
    import tracemalloc

    lattice = pieces.Lattice(tokenizer_file("piece_bpe_32k.model"), 1.0)
    rnd = random.Random(6)
    texts = [" ".join(rnd.choices(WORDS, k=20) + ["".join(rnd.choices("aeiounrst日本", k=9)) for _ in range(400)]) + "\n" for _ in range(200)]
    seeds = np.arange(200, dtype=np.uint64)
    tracemalloc.start()
    found = lattice.sample(texts, seeds)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 800,000 characters; 128 bytes of each were held at once
    assert peak < 800_000 * 128
    for size in (1, 1000, 10**9):
        monkeypatch.setattr(pieces, "LATTICE", size)
        again = lattice.sample(texts[:20], seeds[:20])
        assert all(np.array_equal(a, b) for a, b in zip(found, again))
        assert [lattice.decode(a) for a in again] == texts[:20]
