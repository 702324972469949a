"""Filter audits, ranked search and fingerprints, against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from bedfeed.llm import banding, filter_audit, fingerprints, lexical, near_dedup

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def failing(rows):
    """For (doc_id, text, lang): the part and the set of filters A to E that fail."""
    out = []
    for i, text, lang in rows:
        text = text or ""
        words = brute.SPACE.findall(text)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and any((t or "") == text and j is not None and j < i for j, t, _ in rows),
        }
        out.append((lang or "", {f for f in fails if fails[f]}))
    return out


def audit(rows, labels):
    marks = {}
    for i, quality, toxic in labels:
        if i is not None:
            a, b = marks.get(i, (False, False))
            marks[i] = (a or quality == 1, b or toxic == 1)
    fails = failing(rows)
    out = {}
    for part in {p for p, _ in fails}:
        own = [(f, *marks.get(i, (False, False))) for (p, f), (i, _, _) in zip(fails, rows, strict=True) if p == part]
        taken = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                taken[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(1 for r in own if f in r[0]) - len(gone), sum(1 for r in own if r[0] == {f}),
                    sum(r[1] for r in gone), sum(r[2] for r in gone), f,
                ]
        for key, row in out.items():
            if key[0] == part:
                row[6] = taken[row[6]] if isinstance(row[6], str) else row[6]
    return {k: tuple(v) for k, v in out.items()}


def audited(docs, labels):
    return {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in filter_audit.filter_audit(docs, labels).collect()}


LABELS = "doc_id long, quality int, toxic int"


def test_filter_audit(spark, docs, texts):
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    labels = [(i, k % 2, int(k % 3 == 0)) for k, (i, _) in enumerate(texts)] + [(texts[0][0], 1, 1), (None, 1, 1), (texts[1][0], None, None)]
    assert audited(docs, spark.createDataFrame(labels, LABELS)) == audit(rows, labels)


def test_filter_audit_of_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(120))
    rows = [
        (1, text, "en"), (1, text, "en"), (1, text, "fr"), (2, text, "fr"), (3, text + " #", None), (4, text + " #", ""), (None, text, "en"), (None, None, "en"),
        (5, None, "en"), (6, "", "en"), (7, "ABC " * 120, "en"), (1, "other", "en"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("mask", F.lit(1)).withColumn("part", F.lit("x")).withColumn("first", F.lit(2))
    labels = [(1, 1, 0), (1, 0, 1), (6, 1, 1), (None, 1, 1)]
    out = audited(docs, spark.createDataFrame(labels, LABELS))
    assert out == audit(rows, labels) and {k[0] for k in out} == {"en", "fr", ""}
    assert audited(docs, spark.createDataFrame([], LABELS)) == audit(rows, [])
    assert audited(docs.limit(0), spark.createDataFrame(labels, LABELS)) == {}


def test_contraction_selects_cells():
    orders, chosen = filter_audit.selectors(3)
    counts = np.arange(16).reshape(1, 2, 2, 2, 2)
    assert len(orders) == 6
    assert (filter_audit.contracted(counts, chosen["failing"])[0, 0] == counts[0, 1].sum((0, 1))).all()
    assert (filter_audit.contracted(counts, chosen["removed"])[0, 2] == counts[0, 0, 0, 1]).all()


def search(docs, items, top):
    """(item_id, rank, doc_id, score) in any order; docs and items are pairs."""
    found = [(i, Counter(TERM.findall(brute.lower(t or "")))) for i, t in docs]
    count = sum(1 for _, c in found if c)
    terms = sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        own = Counter(TERM.findall(brute.lower(text or "")))
        for i, c in found:
            if c:
                m = 75 + 25 * sum(c.values()) * count // terms
                score = sum(
                    k * math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                    for t, k in own.items() if c[t]
                )
                if score > 0:
                    scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("head, bucket, block", [(8192, 2048, 200_000), (20, 16, 200_000), (50, 7, 60)])
def test_ranked_search(spark, docs, texts, monkeypatch, head, bucket, block):
    for name, value in (("HEAD", head), ("BUCKET", bucket), ("BLOCK_TERMS", block)):
        monkeypatch.setattr(lexical, name, value)
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    items += [(7000, "lorem LOREM ipsum"), (7001, ""), (7002, None), (7000, "dolor"), (None, "word"), (7003, "nowhere_to_be zzzz"), (7004, "é " * 5 + "one two")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit(1)).withColumn("term", F.lit("x"))
    for top in (20, 3):
        rows = sorted((tuple(r) for r in lexical.ranked(docs, bench, top).collect()), key=str)
        assert rows == search(texts, items, top)


def test_ranked_search_of_random_tables(spark, monkeypatch):
    random.seed(8)
    monkeypatch.setattr(lexical, "HEAD", 40)
    monkeypatch.setattr(lexical, "BUCKET", 10)
    words = [f"w{int(random.paretovariate(0.6)) % 300}" for _ in range(4000)]
    rows = [(i if i % 9 else None, " ".join(random.choices(words, k=random.choice([0, 1, 3, 20, 90])))) for i in range(400)]
    rows += [(1000 + i, rows[5][1]) for i in range(30)] + [(7, rows[5][1])] * 3
    items = [(str(i), " ".join(random.choices(words, k=random.choice([1, 5, 40])))) for i in range(30)]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id string, text string")
    assert sorted((tuple(r) for r in lexical.ranked(docs, bench, 20).collect()), key=str) == search(rows, items, 20)


def test_ranked_search_of_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "lorem")], "item_id long, text string")
    for d, i in ((docs, none), (empty, some), (empty, none)):
        out = lexical.ranked(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.collect() == []


def test_vocabulary_compares_bytes(monkeypatch):
    monkeypatch.setattr(lexical, "hashes_of", lambda data, first, last: np.full(len(first), 5, np.uint64))
    data = np.frombuffer(b"ab cd abc zz cd", np.uint8)
    first, last, _ = lexical.terms_of(data, np.array([0, len(data)]))
    assert lexical.Vocabulary([b"ab", b"abc", b"cd"]).find(data, first, last).tolist() == [0, 2, 1, -1, 2]


def slots_of(text, k=5):
    """The fingerprint by single steps in Python integers, from the library's shingle hashes."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    _, hashes = fingerprints.shingle_hashes(data, np.array([0, len(data)]), k)
    if not len(hashes):
        return "ffff" * fingerprints.SLOTS
    full = (1 << 64) - 1
    least = [min((int(h) * int(a) + int(b)) & full for h in hashes) for a, b in zip(fingerprints.FACTORS, fingerprints.TERMS, strict=True)]
    return "".join(f"{((m * 0x9E3779B97F4A7C15) & full) >> 48:04x}" for m in least)


def likeness_rows(docs):
    return sorted((tuple(x.hex() if isinstance(x, (bytes, bytearray)) else x for x in r) for r in fingerprints.edit_likeness(docs).collect()), key=str)


def fingerprinted(pairs):
    order = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0))
    out = []
    for n, (i, text) in enumerate(order):
        text, after = text or "", order[(n + 1) % len(order)][1] or ""
        cut = len(text) // 4
        changed = text[: len(text) - cut] + after[:cut]
        own, new, other = slots_of(text), slots_of(changed), slots_of(after)

        def like(a, b):
            if ("ffff" * 64 == a) != ("ffff" * 64 == b):
                return 0.0
            return sum(a[j : j + 4] == b[j : j + 4] for j in range(0, len(a), 4)) / 64

        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, new, like(own, new), like(own, other)))
    return sorted(out, key=str)


@pytest.mark.parametrize("part_bytes", [16 << 20, 5000])
def test_edited_fingerprints(spark, docs, texts, monkeypatch, part_bytes):
    monkeypatch.setattr(fingerprints, "PART_BYTES", part_bytes)
    monkeypatch.setattr(fingerprints, "AT_ONCE", 30_000)
    short = [(i, t if len(t or "") < 4_000 else t[:4_000]) for i, t in texts]
    table = docs.withColumn("text", F.when(F.length("text") < 4_000, F.col("text")).otherwise(F.substring("text", 1, 4_000)))
    assert likeness_rows(table) == fingerprinted(short)


def test_fingerprints_of_odd_tables(spark, empty, repeated):
    schema = "doc_id long, text string"
    assert fingerprints.edit_likeness(empty).collect() == [] and fingerprints.fingerprints(empty).collect() == []
    for rows in ([(None, "a b c d e f g h")], [(1, None), (2, "")], [(3, "é" * 9), (-5, "x y"), (None, "zz " * 40), (9, "q")]):
        assert likeness_rows(spark.createDataFrame(rows, schema)) == fingerprinted(rows)
    assert fingerprints.edit_likeness(repeated).count() == repeated.count()
    by_text = {}
    for r in fingerprints.fingerprints(repeated.withColumn("doc_id", F.coalesce("text", F.lit("")))).collect():
        by_text.setdefault(r.doc_id, set()).add(bytes(r.fingerprint))
    assert all(len(x) == 1 for x in by_text.values())


def test_likeness_estimates_jaccard():
    random.seed(4)
    words = [f"w{i}" for i in range(3000)]
    a, b = words[:2000], words[400:2400]
    sets = [{tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (a, b)]
    texts = [" ".join(x).encode() for x in (a, b)]
    slots, counts = fingerprints.text_slots(*fingerprints._block(texts), 5)
    true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    assert abs(fingerprints.likeness(slots[:1], slots[1:], counts[:1], counts[1:])[0] - true) < 0.2


@pytest.mark.parametrize("k", [4, 5])
def test_alike(spark, docs, texts, k):
    out = {r.doc_id: (r.n_shingles, r.group_id) for r in fingerprints.alike(docs, k).collect()}
    assert out == brute.near(texts, k)


def pairs_at_the_limit(n):
    """Pairs of texts whose sets of 5-word shingles have a similarity of 0.80 to 0.82, of many sizes."""
    random.seed(12)
    rows = []
    for i in range(n):
        size = random.choice([9, 20, 45, 130, 400, 1000])
        words = [f"a{i}x{j}" for j in range(size + 4)]
        cut = math.floor(size / 9)  # (size - cut) / (size + cut) is 0.8 and little more
        other = words[:-cut] + [f"b{i}x{j}" for j in range(cut)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    return rows


def test_no_link_at_the_limit_is_lost(spark):
    rows = pairs_at_the_limit(1500)
    sets = [brute.shingles(t, 5) for _, t in rows]
    both = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2], strict=True)]
    assert min(both) >= 0.8 and sum(x <= 0.82 for x in both) > 1000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for out in (near_dedup.near_duplicates(docs, 5).withColumnRenamed("component_id", "group_id"), fingerprints.alike(docs, 5)):
        assert all(r.group_id == r.doc_id - r.doc_id % 2 for r in out.collect())


def test_large_bands_are_cut(spark, monkeypatch):
    monkeypatch.setattr(banding, "PIECE", 7)
    random.seed(2)
    base = [f"w{j}" for j in range(60)]
    rows = [(i, " ".join(base[:n] + [f"x{i}"] + base[n:])) for i, n in enumerate(random.choices(range(1, 60), k=40))]
    rows += [(100 + i, " ".join(f"y{i // 3}x{j}" for j in range(i % 3, 30))) for i in range(30)] + [(200, None), (201, ""), (200, rows[0][1]), (7, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = brute.near([r for r in rows if r[0] != 200], 5)
    out = {r.doc_id: r.group_id for r in fingerprints.alike(docs, 5).where("doc_id <> 200").collect()}
    assert out == {i: g for i, (_, g) in expected.items()}


def test_groups_of_odd_rows(spark, empty, repeated):
    assert fingerprints.alike(empty).collect() == []
    text = " ".join(f"word{i}" for i in range(80))
    rows = fingerprints.alike(repeated).collect()
    assert len(rows) == repeated.count()
    assert {r.group_id for r in rows if r.doc_id is None} == {1, None} and {r.group_id for r in rows if r.doc_id in (1, 2)} == {1}
    alone = spark.createDataFrame([(None, text), (5, "q")], "doc_id long, text string")
    assert {(r.doc_id, r.group_id) for r in fingerprints.alike(alone).collect()} == {(None, None), (5, 5)}
