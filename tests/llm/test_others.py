"""Packing, extraction, vectors, sharding, quality and the pipeline against plain versions and planted cases."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from barpath.llm import embeddings, extract, packing, pii, quality, registry, sharding
from barpath.llm.common import forest
from tests.llm import plain


def sequences(histogram, steps, capacity):
    """Sequences of a plan, checked: every piece placed, no gap, no overflow."""
    placed, out = Counter(), defaultdict(list)
    for length, first, n, sequence, each, offset in steps:
        assert first == placed[length] and n % each == 0
        placed[length] += n
        for r in range(n):
            out[sequence + r // each].append((offset + r % each * length, length))
    assert placed == Counter({k: n for k, n in histogram.items() if n})
    for s in out.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(out)


def best_fit(histogram, capacity):
    rooms = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fit = min((r for r in rooms if r >= length), default=None)
            if fit is not None:
                rooms.remove(fit)
            rooms.append((fit or capacity) - length)
    return len(rooms)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 40), max_size=20))
def test_plan_is_whole_and_near_best_fit(histogram):
    """Where lengths are rounded, a group of pieces may need sequences of its own; where they are few, no worse than best fit."""
    large = sum(n for k, n in histogram.items() if 64 * packing.LARGE < k < 64)
    for groups, more in ((8, -(-large // 8)), (24, 0)):
        n = sequences(histogram, packing.plan(histogram, 64, groups), 64)
        assert math.ceil(sum(k * v for k, v in histogram.items()) / 64) <= n <= best_fit(histogram, 64) * 1.06 + 1 + more


def test_grouping_beats_best_fit_where_it_can():
    h = {700: 1000, 690: 1000, 655: 2000, 650: 1500}
    assert sequences(h, packing.plan(h), 2048) <= best_fit(h, 2048)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_configurations_place_the_large_pieces_and_fill_the_sequences(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    histogram = {r["length"]: r["count"] for r in packing.tokenised(docs).groupBy("length").count().collect()}
    large = {k: n for k, n in histogram.items() if 2048 * packing.LARGE < k < 2048}
    left = packing.configured(histogram).left
    assert sum(left[k] for k in large) <= 0.1 * sum(large.values())
    least = math.ceil(sum(k * n for k, n in histogram.items()) / 2048)
    assert sequences(histogram, packing.plan(histogram), 2048) <= least * 1.005


def test_pack_of_a_long_run_of_blanks_and_of_one_document_many_times(spark):
    df = spark.createDataFrame([(1, " " * 1_000_000 + "a"), (2, "b" * 100_000)] + [(3, "the same row")] * 500, "doc_id long, text string")
    got = packing.pack(df).collect()
    assert sum(r.length for r in got if r.doc_id == 1) == 1_000_001
    full = defaultdict(list)
    for r in got:
        full[r.sequence_id].append((r.offset, r.length))
    for s in full.values():
        s.sort()
        assert [o for o, _ in s] == [sum(k for _, k in s[:i]) for i in range(len(s))] and sum(k for _, k in s) <= 2048
    assert sum(r.doc_id == 3 for r in got) == 500


def test_pack(spark):
    from tokenizers import Tokenizer

    texts = [None, "", "a b", "a b", "word " * 5000, "x<|endoftext|>y", "é ß 😀 漢字    x's 12345", "tie", "tie"] + ["some words " * k for k in range(40)]
    rows = [(i if i else None, t, "clash") for i, t in enumerate(texts)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, length string")).collect()
    whole = Tokenizer.from_file(packing.default_tokenizer()[0])
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for key, text, _ in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        pieces = sorted(by[key], key=lambda r: r.piece)
        assert sum(r.length for r in pieces) == len(ids) and all(r.length == 2048 for r in pieces[1:])
        for n, r in enumerate(pieces):
            assert r.piece == n and zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    full = defaultdict(list)
    for r in got:
        full[r.sequence_id].append((r.offset, r.length))
    for s in full.values():
        s.sort()
        assert [o for o, _ in s] == [sum(k for _, k in s[:i]) for i in range(len(s))] and sum(k for _, k in s) <= 2048
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


PAGES = {
    "<article><p>a<b>b</b>c &lt;x&gt; &eacute;&am": "abc <x> é&am",
    '<nav><a href="/">Home</a></nav><div class="comments"><p>bad</p></div><article><div><p>ok  one</p><aside>no</aside><section id="comments"><p>c</p></section>two<script>if(a<b)"</p>"</script></article><footer>f</footer>': "ok one two",
    '<article><p>x <a href="q>z">y</a><p>open "quote <': 'x y open "quote <',
    "<!-- <article>x</article> -->": "",
    '<main><header>top</header><form><p>f</p></form><div class="cookie-notice">c</div><h2>T</h2><table><tr><td>1<td>2</table></main>': "T 1 2",
    '<article><h1>Title</h1><div class="ad">Buy now</div><p>Short.</p><p hidden>no</p><p>Bread and fore, madder adverb.</p></article>': "Title Short. Bread and fore, madder adverb.",
    "<style>p{}</style><script>x": "",
    "": "",
}


def test_extract(spark):
    pages = [None, *PAGES, "<p>" * 3000 + "deep", "<" * 3000]
    df = spark.createDataFrame([(i, "u", p, 7) for i, p in enumerate(pages)], "page_id long, url string, html string, n_chars int")
    got = {r.page_id: r for r in extract.extract(df).collect()}
    assert got[0].text == "" and [got[i + 1].text for i in range(len(PAGES))] == list(PAGES.values())
    assert all(r.n_chars == len(r.text) for r in got.values()) and len(got) == len(pages)
    assert extract.extract(df.limit(0)).count() == 0


_P = "<p>Some words of the text stand here, enough of them to make a paragraph.</p>"
KEPT = (
    f'<div class="layout has-sidebar"><nav><a href=1>x</a></nav><article>{_P}</article></div>',
    f'<article class="post category-privacy">{_P}</article>',
    f'<main class="content with-sidebar">{_P}</main>',
    f'<article data-state="not hidden">{_P}</article>',
    f'<article data-id="search">{_P}</article>',
    f'<article>{_P}<ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a><li><a href=4>four</a></ul></article>',
    f'<article>{_P}</article><section id="comments"><article>{_P}</article></section><div class="sidebar">{_P}</div>',
    f'<a href=1><div>Menu</div><div>Other</div></a><article>{_P}</article>',
)


@pytest.mark.parametrize("page", KEPT)
def test_extraction_of_marked_pages(page):
    assert extract.main_text(page, extract.train()) == _P[3:-4]


def test_extraction_is_linear_in_depth():
    import time

    began = time.process_time()
    extract.main_text("<div>" * 16_000 + "<p>x y</p>" * 2000 + "</div>" * 16_000 + "</section>" * 16_000, extract.train())
    assert time.process_time() - began < 2


def test_registered_extraction_against_a_plain_version(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = registry.QUERIES["op3_extract"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, plain.article(pages[r.page_id].html), len(r.text))


def test_extraction_tree_fits_its_table_and_plain_pages():
    tree = extract.train()
    text = "<ul><li><a href=1>One</a><li><a href=2>Two words</a></ul><div>" + "Plain words of a page with no article element. " * 5 + "</div><p>" + "More of the same text follows here. " * 6 + "</p><ul><li><a href=3>Next page</a></ul>"
    got = extract.main_text(text, tree)
    assert got.startswith("Plain words") and got.endswith("follows here.") and "Two words" not in got


@pytest.mark.parametrize("cell_rows", [5, 32_768])
def test_vectors(spark, cell_rows):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((60, 24))
    x = np.concatenate([base, base[:20] + rng.standard_normal((20, 24)) * 0.18, base[:5] * 3, base[:10], np.repeat(base[:1], 30, 0) + rng.standard_normal((30, 24)) * 0.15])
    rows = [(i, v.tolist(), "clash") for i, v in enumerate(x)] + [(900, None, "a"), (901, [0.0] * 24, "a"), (902, [float("nan")] + [1.0] * 23, "a"), (903, [1.0, None], "a"), (904, [], "a"), (905, x[0].tolist()[:3], "a"), (906, [3.0], "a"), (907, [5.0], "a"), (None, [3.0], "a"), (908, [2.0, 1.0], "a"), (908, [2.0, 1.0], "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links string")
    got = {r.vec_id: r for r in embeddings.near_vectors(df, cell_rows=cell_rows).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    linked = u @ u.T >= 0.95
    expected = plain.classes(list(range(len(x))), lambda i, j: linked[i, j])
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (linked[i].sum() - 1, expected[i], expected[i] == i)
    assert all((got[i].n_links, got[i].component_id) == (0, i) for i in range(900, 906)) and (got[907].n_links, got[907].component_id) == (1, 906)
    # a null key links with nothing; rows that repeat a key count as rows
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False) and (got[908].n_links, got[908].component_id) == (1, 908)
    assert embeddings.near_vectors(df.limit(0)).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=30))
def test_forest_keeps_components(pairs):
    a, b = (np.array([p[i] for p in pairs], dtype=np.int64) for i in (0, 1))
    child, root = forest(a, b)
    name = lambda links: plain.classes(list(range(13)), lambda i, j: (i, j) in links or (j, i) in links)
    assert name(set(zip(child.tolist(), root.tolist(), strict=True))) == name(set(pairs)) and (child > root).all()


def test_sharding(spark):
    shards = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(shards, 1009)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1
    moved = sum(a != b for a, b in zip(table, sharding.lookup_table(shards[:-1], 1009), strict=True)) / 1009
    assert moved < 2.5 / 7
    weighted = Counter(sharding.lookup_table(shards, 1009, [2, 1, 1, 1, 1, 1, 1]))
    assert 1.8 < weighted["s0"] / weighted["s1"] < 2.2
    df = spark.createDataFrame([(None, "a"), (1, "b"), (1, "c"), (2, None)], "doc_id long, shard string")
    got = sharding.place(df, "doc_id", shards, 1009).collect()
    assert len(got) == 4 and len({r.shard for r in got if r.doc_id == 1}) == 1 and all(r.shard == table[r.slot] for r in got)
    assert sharding.place(df.limit(0), "doc_id").count() == 0
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, 1000)


def test_quality(spark):
    rng = random.Random(1)
    v = [a + b for a in ("th", "on", "er", "an") for b in ("e", "ing", "is", "ou", "at")]
    good = lambda: ". ".join(" ".join(rng.choice(v) for _ in range(9)).capitalize() for _ in range(rng.randint(2, 12))) + "."
    bad = lambda: rng.choice([" ".join([rng.choice(v)] * 80), " | ".join(rng.choice(v) for _ in range(60)), good().upper().replace(" ", "!! "), good().replace(" ", "%%% ")])
    truth = [int(rng.random() < 0.8) for _ in range(600)]
    docs = [(i, good() if t else bad(), "x", 7) for i, t in enumerate(truth)] + [(None, None, "x", 7), (5, "", "x", 7), (700, "word " * 20000, "x", 7)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score string, x int")
    labels = spark.createDataFrame([(i, t, 0) for i, t in enumerate(truth) if i % 2 == 0] + [(None, 1, 0), (4, truth[4], 0), (6, None, 0), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality.classify(df, labels).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.x == 7 for r in got)
    out = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600 and r.doc_id != 5]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in out) / len(out) > 0.95
    kept = quality.keep_good(df, labels)
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(r.doc_id or -1 for r in got if r.predicted) and kept.columns == df.columns
    unlabelled = quality.classify(df, labels.limit(0)).collect()
    assert len(unlabelled) == len(docs) and all(r.predicted == 1 for r in unlabelled)
    assert quality.classify(df.limit(0), labels).count() == 0


def test_pipeline(spark, sf):
    """Each stage on the raw documents, and the chain of plain stages after the classifier, against a plain version."""
    from tokenizers import Tokenizer

    docs = corpus_pipeline.table(spark, sf, "documents")
    names = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    bench = [(r.item_id, r.text) for r in corpus_pipeline.table(spark, sf, "benchmark").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "pii", "best_fit_packing"]

    def one_of_each(keys):
        sets = [plain.shingle_set(texts[k]) for k in keys]
        return sorted(set(plain.classes(keys, lambda i, j: plain.alike(sets[i], sets[j]))))

    def clean(keys):
        return [k for k, (_, hit, _) in zip(keys, plain.contamination([texts[k] for k in keys], bench), strict=True) if not hit]

    keys = sorted(texts)
    deduped = stages["simhash_near_dedup"](spark, docs, sf)
    assert sorted(r.doc_id for r in deduped.collect()) == one_of_each(keys) and deduped.columns == names
    kept = stages["benchmark_decontamination"](spark, docs, sf)
    assert sorted(r.doc_id for r in kept.collect()) == clean(keys) and kept.columns == names
    redacted = stages["pii"](spark, docs, sf)
    assert redacted.columns == names and all(not plain.base_spans(r.text) and r.n_chars == len(r.text) for r in redacted.collect())
    good = stages["quality_classifier"](spark, docs, sf)
    predicted = quality.classify(docs.select("doc_id", "text"), corpus_pipeline.table(spark, sf, "labels")).where("predicted = 1")
    keys = sorted(r.doc_id for r in good.select("doc_id").collect())
    assert good.columns == names and keys == sorted(r.doc_id for r in predicted.collect()) and 0 < len(keys) < len(texts)

    expected = clean(one_of_each(keys))
    whole = Tokenizer.from_file(packing.default_tokenizer()[0])
    pieces = Counter()
    for k in expected:
        ids = np.array([*whole.encode(pii.redacted(texts[k], pii.spans(texts[k])), add_special_tokens=False).ids, 0], dtype="<u4")
        first = (len(ids) - 1) % 2048 + 1
        for a, b in zip([0, *range(first, len(ids), 2048)], range(first, len(ids) + 1, 2048), strict=True):
            pieces[k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    final = corpus_pipeline.run(spark, sf).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in final) == pieces
    full = defaultdict(list)
    for r in final:
        full[r.sequence_id].append((r.offset, r.length))
    for s in full.values():
        s.sort()
        assert [o for o, _ in s] == [sum(k for _, k in s[:i]) for i in range(len(s))] and sum(k for _, k in s) <= 2048
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_registered_queries_run(spark, sf, name):
    out = registry.QUERIES[name](spark, sf)
    assert out.count() >= 1 and len(set(out.columns)) == len(out.columns)
