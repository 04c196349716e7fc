"""The corpus pipeline, stage by stage, on small and empty tables."""

import random

import corpus_pipeline
from evenground.llm.queries import ORACLES, QUERIES
from evenground.llm.simhash import similar
from tests.llm.test_operators import SCHEMA, WORDS, sample


def _folder(spark, tmp_path, rows):
    folder = f"file://{tmp_path}"
    spark.createDataFrame(rows, SCHEMA).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, " ".join(f"q{i}" for i in range(30)))], "item_id int, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, tmp_path):
    leak = " ".join(f"q{i}" for i in range(30))
    rnd = random.Random(9)
    one, two = (" ".join(rnd.choice(WORDS) for _ in range(200)) for _ in range(2))
    rows = [*sample(), (500, f"{one} {leak}", "en", "a", 1, None, None, None), (501, two, "en", "a", 1, None, None, None)]
    folder = _folder(spark, tmp_path, rows)
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = f"file://{tmp_path}/{name}"
        out = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(path)
        before, docs = {r[0] for r in docs.select("doc_id").collect()}, spark.read.parquet(path)
        after = {r[0] for r in docs.select("doc_id").collect()}
        assert after <= before
        seen.append((name, before, after))
    stages = {name: (before, after) for name, before, after in seen}
    assert stages["line_dedup"][0] == stages["line_dedup"][1]
    assert 500 in stages["benchmark_decontamination"][0] and 500 not in stages["benchmark_decontamination"][1]
    assert 501 in stages["benchmark_decontamination"][1]
    assert docs.where("NOT lossless").count() == 0


def test_near_copies_of_a_similarity_of_four_fifths(spark):
    rnd = random.Random(4)
    grams = lambda t: {tuple(t[i : i + 5]) for i in range(len(t) - 4)}
    table, gone = [], set()
    for g in range(60):
        plain = [f"w{rnd.randint(0, 5000)}" for _ in range(200)]
        near = list(plain)
        for k in rnd.sample(range(10, 190), 4 if g % 2 else 9):
            near[k] = "x"
        same = len(grams(plain) & grams(near)) / len(grams(plain) | grams(near))
        table += [(2 * g, " ".join(plain)), (2 * g + 1, " ".join(near))]
        gone |= {2 * g + 1} if same >= 0.8 else set()
    assert 25 <= len(gone) <= 45
    docs = spark.createDataFrame(table, "doc_id bigint, text string")
    left = {r[0] for r in corpus_pipeline.dedup_documents(spark, docs, "").select("doc_id").collect()}
    assert left == {i for i, _ in table} - gone


def test_fingerprints_within_two_bits_are_linked(spark):
    from evenground.llm.simhash import fingerprint, shingle_hashes

    # a phrase that a text repeats decides its fingerprint, not its set of shingles
    phrase = " ".join(f"p{i}" for i in range(40))
    own = lambda n: " ".join(f"{n}{i}" for i in range(30))
    one, two, three = f"{phrase} " * 60 + own("a"), f"{phrase} " * 60 + own("b"), own("c")
    a, b, c = (fingerprint(t.encode(), 5) for t in (one, two, three))
    x, y = (set(shingle_hashes(t.encode(), 5).tolist()) for t in (one, two))
    assert (a ^ b).bit_count() <= 2 < (a ^ c).bit_count() and len(x & y) < 0.8 * len(x | y)
    docs = spark.createDataFrame([(3, one), (1, two), (2, three)], "doc_id bigint, text string")
    left = {r[0] for r in corpus_pipeline.dedup_documents(spark, docs, "").select("doc_id").collect()}
    assert left == {1, 2}


def test_all_fingerprints_of_a_set_are_linked(spark):
    from evenground.llm.simhash import fingerprint, shingle_hashes

    # the first two texts have one set of shingles, but repeat other phrases of it
    phrase, tail, other = (" ".join(f"{n}{i}" for i in range(k)) + " " for n, k in (("p", 41), ("a", 30), ("b", 30)))
    texts = [phrase * 2 + tail * 60, phrase * 300 + tail * 2, phrase * 300 + other * 2]
    a, b, c = (fingerprint(t.encode(), 5) for t in texts)
    x, y, z = (set(shingle_hashes(t.encode(), 5).tolist()) for t in texts)
    assert x == y and len(y & z) < 0.8 * len(y | z) and (b ^ c).bit_count() <= 2 < (a ^ c).bit_count()
    docs = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id bigint, text string").coalesce(1)
    assert [r[0] for r in corpus_pipeline.dedup_documents(spark, docs, "").select("doc_id").collect()] == [1]


def test_every_pair_of_a_bucket_counts(spark):
    from evenground.llm.simhash import shingle_hashes

    # copies of one text with words of their own: most are unlike each other
    rnd = random.Random(5)
    plain, table = [f"w{i}" for i in range(150)], []
    for g in range(300):
        own = list(plain)
        for k in rnd.sample(range(150), rnd.randint(2, 7)):
            own[k] = f"o{rnd.randint(0, 10**9)}"
        table.append((g, " ".join(own)))
    sets = [set(shingle_hashes(t.encode(), 5).tolist()) for _, t in table]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if root[i] != root[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    assert 100 < len(set(root)) < 290
    docs = spark.createDataFrame(table, "doc_id bigint, text string")
    found = {r["doc_id"]: r["component_id"] for r in similar(docs, "doc_id", bands=60, rows=3).collect()}
    assert found == dict(enumerate(root))


def test_buckets_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr("evenground.llm.simhash.BLOCK_SETS", 16)
    test_every_pair_of_a_bucket_counts(spark)


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, _folder(spark, tmp_path, [])).count() == 0


def test_every_operator_is_registered():
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in QUERIES) == 1
    assert "pipeline" in QUERIES and set(ORACLES) <= set(QUERIES)
