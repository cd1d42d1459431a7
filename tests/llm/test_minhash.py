"""The pipeline's near-duplicates against the plain definition: five-word shingles, Jaccard of at least 0.8."""

import random
import re

import pytest

import corpus_pipeline
from barpath.llm import minhash
from tests.llm import plain


def jaccard_sets(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", plain.lowered(t))
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def linked(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def expected(keys, texts):
    sets = [jaccard_sets(t) for t in texts]
    return plain.classes(keys, lambda i, j: linked(sets[i], sets[j]))


@pytest.mark.parametrize(("part_shingles", "broadcast_rows"), [(1 << 21, 1000), (300, 0)])
def test_near_duplicates(spark, part_shingles, broadcast_rows):
    rng = random.Random(6)
    base = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) for n in (3, 30, 100, 100, 300)]
    texts = [None, "", " \t", "One two", "one  TWO", *base]
    for b in base[1:]:
        for n in (0, 1, 2, 3, 4, 6, 8):  # edits apart, on both sides of 0.8 and beyond a few bits of a fingerprint
            w = b.split()
            for i in rng.sample(range(len(w)), n):
                w[i] = "new" + str(rng.randrange(10**6))
            texts.append(" ".join(w))
    chain = base[2].split()
    for i in range(8):  # each step near, the ends far apart
        chain = [*chain[6:], *(f"c{i}{j}" for j in range(6))]
        texts.append(" ".join(chain))
    keys = list(range(len(texts)))
    df = spark.createDataFrame(list(zip(keys, texts, strict=True)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, part_shingles=part_shingles, broadcast_rows=broadcast_rows).collect()}
    assert [got[k] for k in keys] == expected(keys, texts)
    assert minhash.keep_one(df.limit(0)).count() == 0


def test_set_links_have_the_components_of_all_pairs():
    rng = random.Random(7)
    for _ in range(30):
        sets = [sorted(rng.sample(range(14), rng.randint(1, 12))) for _ in range(25)]
        keys = list(range(len(sets)))
        got = set(minhash.set_links([minhash.np.array(s, dtype=minhash.np.uint64) for s in sets]))
        near = lambda i, j: linked(set(sets[i]), set(sets[j]))
        assert all(near(i, j) for i, j in got)
        assert plain.classes(keys, lambda i, j: (i, j) in got or (j, i) in got) == plain.classes(keys, near)


def test_keep_one_of_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a b c d", "x"), (1, "a b c d", "x"), (1, "q w e r t", "y"), (None, "a b c d", "z"), (2, "a b c d", "x")], "doc_id long, text string, lang string")
    for limit in (0, 100):
        assert sorted((r.doc_id is None, r.doc_id) for r in minhash.keep_one(df, broadcast_rows=limit).collect()) == [(False, 1), (True, None)]


def test_pipeline_drops_every_near_copy(spark, sf):
    docs = corpus_pipeline.table(spark, sf, "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, sf)
    assert {r.doc_id for r in got.collect()} == set(expected(*map(list, zip(*rows, strict=True)))) and got.columns == docs.columns


def test_simhash_proposes_where_no_band_does(spark, monkeypatch):
    """Links within three bits of the SimHash of the five-word shingles are proposed by fingerprints alone, and only alike sets are linked."""
    rng = random.Random(9)
    texts = [None, ""]
    for n in (40, 200, 400, 400):
        b = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        texts += [" ".join([*b[: n - k], *(f"x{rng.randrange(10**6)}" for _ in range(k))]) for k in (0, 1, 1, 2, 12, n // 4)]
    keys = list(range(len(texts)))
    df = spark.createDataFrame(list(zip(keys, texts, strict=True)), "doc_id long, text string")
    signed = minhash.signatures(df)
    of = {r.doc_id: r.fingerprint for r in signed.withColumnRenamed("key", "doc_id").collect()}
    for k, t in enumerate(texts):
        h = [int(x) for x in minhash.shingles(t)]
        assert of[k] % 2**64 == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    monkeypatch.setattr(minhash, "band_proposals", lambda signed: signed.selectExpr("set", "set as least").limit(0))
    sets = [jaccard_sets(t) for t in texts]
    near = lambda i, j: sets[i] == sets[j] or (bin((of[i] ^ of[j]) % 2**64).count("1") <= 3 and linked(sets[i], sets[j]))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()}
    want = plain.classes(keys, near)
    assert [got[k] for k in keys] == want and len(set(want)) < len(set(plain.classes(keys, lambda i, j: sets[i] == sets[j])))
