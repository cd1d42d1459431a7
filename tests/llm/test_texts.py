"""PII, SimHash, decontamination, tokens and language model against plain versions, on rows that are hard."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barpath.llm import decontaminate, katz, pii, simhash, tokens
from tests.llm import plain

SCHEMA = "doc_id long, text string, lang string, component_id string, matches string, pii_spans int, n_tokens string"


def rows(texts, keys=None):
    return [(i if keys is None else keys[i], t, None, "clash", None, 1, "x") for i, t in enumerate(texts)]


def words(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    v = [a + b for a in ("Th", "on", "É", "er") for b in ("e", "ing", "x", "ß")]
    base = [words(rng, n, v) for n in (1, 2, 3, 5, 40, 200, 400)]
    near = [base[-1] + " extra", base[-1].upper()]
    return [None, "", "  \t\n", *base, *near, base[4], base[4], "a" * 5000, "same " * 4000]


def test_pii_spans(spark):
    cases = [
        None, "", "mail a.b+c@x-y.co.uk, x@y, @z.com a@b.c@d.e", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 01.002.3.4", "4111 1111 1111 1111 and 4111-1111-1111-1112 12345",
        "+1 (988) 555-2485 +12 +1234567890123456789", "1" * 3000, "+1" + " " * 3000, "a" * 3000 + "@", "é@x.de 4111111111111111", "card 4040 4189 4974 608795.5.6.7",
        "my iban is DE89 3704 0044 0532 0130 00 ok", "GB82 WEST 1234 5698 7654 33", "social security 123-45-6789", "order 123-45-6789",
    ]
    rng = random.Random(2)
    cases += ["".join(rng.choice("0123456789 .-+()@ab") for _ in range(80)) for _ in range(150)]
    df = spark.createDataFrame(rows(cases), SCHEMA)
    got = {r.doc_id: r for r in pii.find_pii(df).collect()}
    assert len(got) == len(cases) and got[0].lang is None and got[0].component_id == "clash"
    for i, t in enumerate(cases):
        found = [(s.kind, s.start, s.end) for s in got[i].pii_spans]
        assert [s for s in found if s[0] in pii.BASE] == plain.base_spans(t), t
        assert found == sorted(found, key=lambda s: (pii.KINDS.index(s[0]), s[1]))
    kinds = lambda i: {s.kind for s in got[i].pii_spans}
    assert "iban" in kinds(11) and "iban" not in kinds(12) and "ssn" in kinds(13) and "ssn" not in kinds(14)
    score = lambda t: pii.spans(t)[0][3]
    assert score("phone +1 988 555 2485") > score("x +1 988 555 2485")
    redacted = {r.doc_id: r.text for r in pii.find_pii(df, redact=True).collect()}
    assert redacted[0] is None and redacted[2].startswith("mail <EMAIL>, x@y") and "+1" not in redacted[5].split(" +12")[0]
    assert pii.find_pii(df.limit(0)).count() == 0


def test_simhash_components(spark, texts):
    keys = [3 - i if i < 4 else i * 2 for i in range(len(texts))]
    df = spark.createDataFrame(rows(texts, keys), SCHEMA)
    got = {r.doc_id: r for r in simhash.near_duplicates(df).collect()}
    prints = [plain.fingerprint(t) for t in texts]
    assert [got[k].fingerprint & (1 << 64) - 1 for k in keys] == prints
    expected = plain.classes(keys, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    assert [got[k].component_id for k in keys] == expected
    kept = simhash.keep_one(df)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected)) and kept.columns == df.columns
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [3, 4000])
@pytest.mark.parametrize("way", ["fingerprint_links", "shuffled_links"])
def test_simhash_links_of_dense_shards(spark, way, size):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(30 if size > 3 or way == "shuffled_links" else 4)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(signed)], "doc_id long, fingerprint long")
    links = {(r.a, r.b) for r in getattr(simhash, way)(df, 3, size).collect()}
    # a forest joins by the least of a component, which need not be within the radius itself
    name = lambda pairs: plain.classes(signed, lambda i, j: (signed[i], signed[j]) in pairs or (signed[j], signed[i]) in pairs)
    true = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert name(links) == name(true)


def test_keep_one_of_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a b c d", "x"), (1, "a b c d", "x"), (1, "q w e r t", "y"), (None, "a b c d", "z"), (2, "a b c d", "x")], "doc_id long, text string, lang string")
    for limit in (0, 100):
        kept = sorted((r.doc_id is None, r.doc_id) for r in simhash.keep_one(df, broadcast_rows=limit).collect())
        assert kept == [(False, 1), (True, None)]


def test_decontamination(spark, texts):
    rng = random.Random(4)
    v = [f"w{i}" for i in range(12)]
    items = [(i, words(rng, n, v)) for i, n in enumerate((10, 11, 30, 60))] + [(9, "short item"), (9, None), (None, "one"), (5, "!!"), (6, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1"), (7, items_text := "é ß x1 y2 z3 q4 r5 s6 t7 u8")]
    docs = [*texts, items[2][1], "x " + items[3][1].upper().replace(" ", ", ") + " y", "w1 " * 50, "a short  item, one", items_text, words(rng, 300, v), items[0][1][:-1]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(rows(docs), SCHEMA)
    expected = plain.contamination(docs, items)
    for slice_chars in (10**6, 150):  # one pass, and several
        got = {r.doc_id: r for r in decontaminate.find_matches(df, bench, slice_chars=slice_chars).collect()}
        assert [(got[i].n_words, got[i].n_hit, got[i].bench_items) for i in range(len(docs))] == expected
    longest = max(got[len(texts) + 1].matches, key=lambda m: m.words)
    assert (longest.item_id, longest.item_word, longest.doc_word, longest.words) == ("3", 0, 1, 60)
    clean = decontaminate.decontaminate(df, bench)
    assert sorted(r.doc_id for r in clean.collect()) == [i for i, e in enumerate(expected) if not e[1]] and clean.columns == df.columns
    assert decontaminate.find_matches(df, bench.limit(0)).where("n_hit > 0").count() == 0 and decontaminate.find_matches(df.limit(0), bench).count() == 0


def test_matches_of_one_word_repeated_are_found_in_little_time():
    import time

    for n in (500, 4000):
        began = time.process_time()
        test = decontaminate.Benchmark([("a", "w " * n), ("b", "x y " * 6)])
        ids = test.numbers("w " * n + "z " + "w " * 15 + "x y " * 6)
        found, items = test.matches(np.append(ids, 0), np.zeros(len(ids) + 1, np.int64), np.zeros(2, np.int64))
        assert decontaminate.covered(found[0]) == n + 15 + 12 and items[0] == {"a", "b"}
        assert time.process_time() - began < 3 and len(found[0]) < 10


def test_token_counts_of_chunks(spark, texts):
    counter = tokens.Counter(tokens.default_model())
    rng = random.Random(5)
    hard = ["".join(rng.choice(s) for _ in range(rng.randint(1, 500))) for s in ("ab  c", "a", "  ", "aé▁ \n\tb", "the quick 12 fox. 😀é", "한국 어", "</s> <unk> x") for _ in range(12)]
    docs = [*texts, *hard]
    df = spark.createDataFrame(rows(docs), SCHEMA)
    expected = dict(enumerate(counter.count([t or "" for t in docs])))
    for huge, chunk, overlap in ((1 << 16, 1 << 15, 256), (100, 40, 3)):
        got = tokens.count_tokens(df, huge=huge, chunk=chunk, overlap=overlap).collect()
        assert {r.doc_id: r.n_tokens for r in got} == expected and all(r.n_bytes == len((docs[r.doc_id] or "").encode()) for r in got)
    assert tokens.count_tokens(df.limit(0)).count() == 0


def test_chunks_that_do_not_align_are_counted_again(spark, monkeypatch):
    texts = ["ab cd " * 60, "xyz" * 100, "one two three " * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counter = tokens.Counter(tokens.default_model())
    expected = dict(enumerate(counter.count(texts)))
    made = tokens.spliced
    for fails in (lambda part: "ab" in part and len(part) < 50, lambda part: "ab" in part):  # the first overlap, or any
        monkeypatch.setattr(tokens, "spliced", lambda c, part, left, right, fails=fails: None if fails(part) else made(c, part, left, right))
        got = tokens.count_tokens(df, huge=50, chunk=30, overlap=4).collect()
        assert {r.doc_id: r.n_tokens for r in got} == expected and len(got) == 3


def test_token_counts_stay_with_their_rows_after_a_shuffle(spark):
    counter = tokens.Counter(tokens.default_model())
    texts = [f"row {i} " + "word and " * (i % 37) + "x" * (i % 11) for i in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = dict(enumerate(counter.count(texts)))
    for docs in (df.repartition(7), df.orderBy(F.rand()), df.groupBy("doc_id").agg(F.max("text").alias("text"))):
        got = tokens.count_tokens(docs, huge=100, chunk=60, overlap=8).collect()
        assert {r.doc_id: r.n_tokens for r in got} == expected and len(got) == 600


@pytest.mark.parametrize(("order", "hot", "tokens"), [(2, 1 << 19, 1 << 20), (3, 20, 10), (4, 5, 10)])
def test_katz_against_plain(spark, texts, order, hot, tokens):
    rng = random.Random(6)
    v = [f"v{int(rng.paretovariate(0.7)) % 60}" for _ in range(400)]
    docs = [*texts, *[words(rng, rng.randint(1, 60), v) for _ in range(120)], "never seen words", *["the pair " * 3] * 40]
    df = spark.createDataFrame(rows(docs), SCHEMA).repartition(5)
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(docs))]
    expected = plain.katz(docs, [not h for h in held], katz.discounts, katz.K, katz.TAIL, order)
    scores, model = katz.score(df, order=order, hot=hot, group_tokens=tokens)
    got = {int(r.key): r for r in scores.collect()}
    assert len(got) == len(docs)
    for i, (n, known, train, base, score) in enumerate(expected):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], n, known, train)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)
    train = expected[0][2]
    assert model.unigrams().agg(F.sum("count")).first()[0] == train
    for k in range(2, order + 1):
        assert model.grams(k).agg(F.sum("count")).first()[0] == train and model.contexts(k).agg(F.sum("count")).first()[0] == train
        assert model.contexts(k).where("alpha <= 0 or alpha is null").count() == 0
    # the stored model gives other texts, and the same ones, the scores of the recursion
    again = katz.score_with(model, df.where("doc_id % 3 = 0"), group_tokens=tokens).collect()
    assert len(again) == len(docs[::3]) and all(r.held_out and r.score == pytest.approx(expected[int(r.key)][4], rel=1e-9) for r in again)


def test_katz_of_few_rows(spark, texts):
    df = spark.createDataFrame(rows(texts), SCHEMA)
    assert katz.score(df.limit(0))[0].count() == 0
    untrained = katz.score(df, held_out=F.lit(True))[0].collect()
    assert len(untrained) == len(texts) and all(r.score == 0 for r in untrained)
    assert len(katz.score(spark.createDataFrame([(None, "a"), (1, "a"), (1, "a")], "doc_id long, text string"))[0].collect()) == 3


def test_discounts_lie_between_nothing_and_all():
    for of in ([], [5], [0, 0, 3], [10, 10, 10, 10, 10, 10], [1, 2, 3, 4, 5, 6], [1000, 300, 120, 70, 40, 30]):
        d = katz.discounts(of)
        assert d[0] == 0 and all(0 < x < 1 for x in d[1:]) and list(d) == sorted(d)


def test_rows_of_a_frequent_pair_are_bounded_by_groups(spark):
    """A pair in every document has one entry for each group, not for each document."""
    df = spark.createDataFrame([(i, "hot pair " + str(i)) for i in range(2000)], "doc_id long, text string").repartition(4)
    _, model = katz.score(df, group_tokens=1000)
    assert model.grams(2).where("count >= 1500").count() >= 1
    assert model.read("level2").where("kind = 'answer'").select("grp").distinct().count() <= 12


def test_rounds_read_each_row_once():
    rng = random.Random(9)
    counts = {b: rng.choice([1, 5, 40, 90, 250]) for b in rng.sample(range(1000), 300)}
    runs = simhash.rounds_of(counts, 100)
    assert all(a[1] < b[0] for a, b in zip(runs, runs[1:], strict=False))
    held = [sum(n for b, n in counts.items() if lo <= b <= hi) for lo, hi, _ in runs]
    assert sum(held) == sum(counts.values())  # every row in one round, whatever the number of rounds
    assert all(n <= 100 * parts for n, (_, _, parts) in zip(held, runs, strict=True)) and {p for *_, p in runs} == {1, 3}
    assert simhash.rounds_of({}, 100) == []
