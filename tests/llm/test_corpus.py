"""Operators that compare documents with each other, against plain Python."""

import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bedfeed.llm import common, decontaminate, near_dedup, packing, repeats, sharding
from bedfeed.llm.components import components


@pytest.fixture
def items(spark):
    rows = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    return rows + [(5000, "one two three"), (5001, "Word"), (5002, ""), (5003, None), (5004, rows[0][1]), (5005, "dolor SIT amet consectetur")]


def test_contamination(spark, docs, texts, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in decontaminate.contamination(docs, bench).collect()}
    assert out == dict(zip([i for i, _ in texts], brute.contamination([t for _, t in texts], items), strict=True))


def test_contamination_with_long_items_only(spark, docs, texts, items, monkeypatch):
    bench = spark.createDataFrame(items[:40], "item_id long, text string")
    expected = dict(zip([i for i, _ in texts], brute.contamination([t for _, t in texts], items[:40]), strict=True))
    for limit in (decontaminate.BROADCAST_WINDOWS, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
        rows = decontaminate.contamination(docs, bench).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in rows} == expected
        assert all(r.n_hit == sum(s.end - s.start for s in r.spans) for r in rows)


def test_contamination_without_items(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate.contamination(docs, none).collect()} == {0}
    assert decontaminate.contamination(empty, none).collect() == []
    assert decontaminate.clean_of(docs, none).count() == docs.count()


def test_rows_without_a_doc_id_are_judged_by_their_text(spark):
    bad, good = " ".join(f"item{i}" for i in range(30)), " ".join(f"word{i}" for i in range(30))
    rows = [(None, bad), (None, bad), (None, good), (None, None), (None, ""), (1, bad), (1, good), (2, good)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([(1, bad)], "item_id long, text string")
    kept = decontaminate.clean_of(docs, none)
    assert kept.columns == docs.columns
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, [(None, good), (None, None), (None, ""), (2, good)]))


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(spark, docs, texts, k):
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs, k).collect()}
    assert out == brute.near(texts, k)


def near_copies(n, seed):
    """A large group of near copies of one text, some further apart than the threshold, and chains of them."""
    random.seed(seed)
    base = [f"w{random.randrange(4000)}" for _ in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(random.choice((0, 1, 1, 2, 3, 5, 8))):
            words[random.randrange(len(words))] = f"x{random.randrange(40)}"
        rows.append((i * 7 % n, " ".join(words)))
    chain = list(base)
    for i in range(30):
        chain[4 * i % 120] = f"c{i}"
        rows.append((n + i, " ".join(chain)))
    return rows


@pytest.mark.parametrize("piece", [1000, 20])
def test_a_large_group_of_near_copies(spark, monkeypatch, piece):
    monkeypatch.setattr(near_dedup, "PIECE", piece)
    rows = near_copies(220, 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs, 4).collect()}
    assert out == brute.near(rows, 4)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        both, n = int(2000 * share), 2000
        pool = rng.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        sets = [np.unique(pool[:n]), np.unique(pool[n - both :])]
        sketch = [near_dedup.registers(s, np.array([0, len(s)])) for s in sets]
        about, used = near_dedup.estimate(sketch[0][0], sketch[1])
        assert used[0] == 256 and abs(about[0] - both / (2 * n - both)) < 0.12


def test_one_of_each_group_stays(docs, texts, repeated):
    groups = brute.near(texts, 5)
    kept = near_dedup.first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(i for i, (_, c) in groups.items() if c == i)
    rows = near_dedup.first_of_each(repeated).collect()
    assert Counter(r.doc_id for r in rows) == {1: 1, 3: 1, None: 2}


def test_components(spark):
    random.seed(2)
    edges = [(random.randrange(400), random.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1040)] + [(7, 2000 + i) for i in range(50)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    joined = {x for a, b in edges if a != b for x in (a, b)}
    assert sorted((r.node, r.component) for r in found) == sorted((x, root(x)) for x in joined)


@pytest.mark.parametrize(("length", "frequent"), [(100, 20_000), (100, 1), (40, 3)])
def test_repeats(spark, texts, monkeypatch, length, frequent):
    monkeypatch.setattr(repeats, "FREQUENT", frequent)
    monkeypatch.setattr(repeats, "HELD_CELLS", 2000)
    pairs = [(i, t) for i, t in texts if len(t or "") < 40_000] + [(20_000, "ab" * 400), (20_001, "b" + "ab" * 200), (20_002, "z" * 500 + texts[3][1])]
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4, "doc_id")
    out = {r.doc_id: ([(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in repeats.without_repeats(docs, length).collect()}
    assert out == brute.repeats([(i, (t or "").encode()) for i, t in pairs], length)


def test_longest_previous_factors():
    random.seed(4)
    for _ in range(200):
        text = "".join(random.choice("ab") for _ in range(random.randint(1, 30)))
        n = len(text)
        order = sorted(range(n), key=lambda i: text[i:])

        def common(a, b, text=text):
            n = 0
            while a + n < len(text) and b + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            return n

        shared = np.array([0] + [common(a, b) for a, b in zip(order, order[1:], strict=False)])
        expected = [max((common(j, i) for j in range(i)), default=0) for i in range(n)]
        assert repeats.longest_previous_factors(np.array(order), shared).tolist() == expected


def test_repeats_of_repeated_rows(repeated, empty):
    rows = repeats.without_repeats(repeated).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, len(r.kept)) for r in rows) == sorted(
        [(0, 0, 0), (0, 549, 549), (1, 549, 0), (2, 549, 0), (3, 0, 0), (4, 555, 6), (4, 36, 36)]
    )
    assert repeats.without_repeats(empty).collect() == []


def bins_of(rows):
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    return bins


def test_packing(docs, texts):
    rows = packing.best_fit(docs).collect()
    sizes = Counter()
    for i, t in texts:
        n = len((t or "").encode().split()) + 1
        for piece in range(0, n, 8192):
            sizes[i, piece // 8192, piece, min(8192, n - piece)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.n_tokens) for r in rows) == sizes
    for own in bins_of(rows).values():
        own.sort(key=lambda r: r.position)
        assert [r.position for r in own] == [sum(r.n_tokens for r in own[:i]) for i in range(len(own))]
        used = sum(r.n_tokens for r in own)
        assert {r.capacity for r in own} == {min(c for c in packing.CAPACITIES if c >= used)}


def test_plans_place_like_one_by_one():
    random.seed(6)
    for _ in range(150):
        capacities = tuple(sorted(random.sample((8, 12, 16, 24, 32, 64), random.randint(1, 4))))
        sizes = [random.randint(1, capacities[-1]) for _ in range(random.randint(0, 80))]
        plan = packing.planned(Counter(sizes), capacities)
        bins = defaultdict(list)
        for size, count in Counter(sizes).items():
            segments = sorted(s for s in plan.segments if s[0] == size)
            for rank in range(count):
                _, first, at, each, used = [s for s in segments if s[1] <= rank][-1]
                bins[at + (rank - first) // each].append((used + (rank - first) % each * size, size))
        final = {}
        for b, found in bins.items():
            final[b] = [c for first, c in plan.bins if first <= b][-1]
            found.sort()
            assert [p for p, _ in found] == [sum(s for _, s in found[:i]) for i in range(len(found))]
        assert sorted((final[b], tuple(s for _, s in f)) for b, f in bins.items()) == brute.best_fit(sizes, capacities, packing.opened)


def test_packing_of_odd_tables(repeated, empty):
    assert packing.best_fit(empty).collect() == []
    rows = packing.best_fit(repeated).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == {(1, 81): 2, (2, 81): 1, (3, 1): 2, (4, 82): 1, (4, 7): 1, (None, 81): 1, (None, 1): 1}


def test_shards(docs, texts, repeated, empty):
    rows = sharding.histogram_sort(docs, 6, ("lang",)).collect()
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((i, len((t or "").encode()) + 8) for i, t in texts)
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r)
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in shards.values())
    total, most = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    assert all(abs(sum(r["size"] for r in own) - total / 6) <= most for own in shards.values())
    assert sharding.histogram_sort(empty).collect() == []
    assert sharding.histogram_sort(repeated, 2).count() == 9


def test_a_large_group_of_copies_is_split(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 < 2, "the same").otherwise(F.col("id").cast("string")).alias("text"))
    sizes = sharding.histogram_sort(docs, 5).groupBy("shard").agg(F.sum("size").alias("size")).collect()
    assert len(sizes) == 5 and max(r["size"] for r in sizes) - min(r["size"] for r in sizes) <= 120


def test_pipeline(spark, texts, items, tmp_path):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(i, t, "en", "odd", 0) for i, t in texts if i >= 10_000], documents.schema)
    documents.unionByName(odd).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items[:40], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, left = common.table(spark, str(tmp_path), "documents"), dict(texts)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        out = common.stored(stage(spark, docs, str(tmp_path)))
        assert out.columns == docs.columns
        rows = {r.doc_id: r.text for r in out.collect()}
        if n == 0:
            left = {i: t for i, t in left.items() if not brute.figures(t or "")[-1]}
        elif n == 1:
            left = _firsts(left)
        elif n == 2:
            judged = brute.contamination(left.values(), items[:40])
            left = {i: t for (i, t), (words, hit, _) in zip(left.items(), judged, strict=True) if not (hit and 20 * hit >= words)}
        else:
            assert rows.keys() == left.keys()
            for i, t in left.items():
                if not brute.personal(t):
                    assert rows[i] == t
                else:
                    assert rows[i] != t
            left = rows
        assert rows == left
        docs = out
    packed = corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(left)
    again = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.n_tokens, r.capacity) for r in again) == Counter((r.doc_id, r.piece, r.n_tokens, r.capacity) for r in packed)


def _firsts(left):
    groups = brute.near(list(left.items()), 5)
    return {i: t for i, t in left.items() if groups[i][1] == i}
