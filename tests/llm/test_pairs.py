"""Decontamination, near-duplicates and components against all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from llm_fixtures import docs, no_docs  # noqa: F401
from sessionloom.llm import components, simhash, winnowing

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def brute_hits(text, items):
    words = PLAIN.findall(lower(text))
    hit, found = set(), set()
    for item, other in items:
        b = PLAIN.findall(lower(other))
        k = min(10, len(b))
        spans = {tuple(b[i:i + k]) for i in range(len(b) - k + 1)} if k else set()
        for i in range(len(words) - k + 1 if k else 0):
            if tuple(words[i:i + k]) in spans:
                hit.update(range(i, i + k))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


def test_contamination_equals_brute_force(spark, docs):
    texts = [r.text for r in docs.collect() if r.text and len(r.text) < 10000]
    rng = random.Random(3)
    items = []
    for k in range(25):
        words = rng.choice(texts).split()
        at = rng.randrange(max(1, len(words) - 12))
        items.append((k, ("X " if k % 2 else "") + " ".join(words[at:at + rng.choice([2, 4, 9, 10, 11, 30])]).upper()))
    items += [(100, None), (101, ""), (102, "!!"), (7, "one"), (103, "same words again here now " * 5), (104, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = winnowing.contamination(docs, bench)
    expected = [(r.doc_id, *brute_hits(r.text, items)) for r in docs.collect()]
    assert rows(found, "doc_id", "n_words", "n_hit", "items") == sorted(expected, key=repr)
    assert any(x[2] for x in expected) and not all(x[2] for x in expected)
    left = winnowing.uncontaminated(docs, bench)
    assert rows(left, "doc_id") == sorted(((x[0],) for x in expected if not x[2]), key=repr) and left.columns == docs.columns


def test_every_span_shift_is_found(spark):
    rng = random.Random(5)
    item = [f"w{rng.randrange(40)}" for _ in range(30)]
    docs = [(k, " ".join([f"z{j}" for j in range(k % 7)] + item[k:k + 10] + ["q"] * (k % 3))) for k in range(21)]
    docs += [(100 + k, " ".join(item[k:k + 9])) for k in range(22)]
    found = winnowing.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    assert {r.doc_id for r in found.filter("contaminated").collect()} == set(range(21))


def test_no_benchmark_and_no_documents(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert winnowing.contamination(docs, none).filter("contaminated").count() == 0
    assert winnowing.contamination(docs, none).count() == docs.count()
    assert winnowing.contamination(no_docs, none).count() == 0


def brute_mark(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    total = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            total[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * total[bit] > len(shingles))


def brute_classes(marked):
    parent = list(range(len(marked)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(marked):
        for j in range(i):
            if bin(a ^ marked[j][1]).count("1") <= 4:
                parent[find(i)] = find(j)
    best = {}
    for i, (key, _) in enumerate(marked):
        if key is not None:
            best[find(i)] = min(best.get(find(i), key), key)
    return [best.get(find(i)) for i in range(len(marked))]


def test_fingerprints_and_classes(docs):
    marked = [(r.doc_id, brute_mark(r.text)) for r in docs.select("doc_id", "text").collect()]
    expected = sorted(((k, format(m, "016x"), c) for (k, m), c in zip(marked, brute_classes(marked))), key=repr)
    found = simhash.clustered(docs).select("key", simhash.hex_mark(F.col("mark")).alias("mark"), "component")
    assert rows(found) == expected


def test_marks_spark_and_python_agree(spark):
    shingle = spark.createDataFrame([("Ünï cödé 4 words",)], "s string").select(F.xxhash64("s")).first()[0]
    import xxhash

    assert shingle % (1 << 64) == xxhash.xxh64_intdigest("Ünï cödé 4 words".encode(), 42)


@pytest.fixture(scope="module")
def marks():
    """A dense group, a chain whose ends are far apart, and points of no group."""
    rng = random.Random(11)
    found = {rng.getrandbits(64) for _ in range(400)}
    centre = rng.getrandbits(64)
    for _ in range(1500):
        found.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    chain = rng.getrandbits(64)
    for _ in range(10):
        found.add(chain)
        chain ^= sum(1 << b for b in rng.sample(range(64), 4))
    for far in (5, 6):
        found.add(centre ^ sum(1 << b for b in rng.sample(range(64), far)) ^ (1 << 63))
    return sorted(found)


def test_links_lose_no_class(spark, marks):
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    table = spark.createDataFrame([(m,) for m in signed], "mark long")
    links = simhash.link_fingerprints(table)
    for r in links.limit(3000).collect():
        assert bin((r.a ^ r.b) % (1 << 64)).count("1") <= 4
    roots = {r.node: r.root for r in components.components(links).collect()}
    a = np.array(marks, np.uint64)
    parent = list(range(len(a)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[:i]) <= 4):
            parent[find(i)] = find(int(j))
    classes = {}
    for i in range(len(a)):
        classes.setdefault(find(i), []).append(signed[i])
    for members in classes.values():
        assert {roots.get(m, m) for m in members} == {min(members)}
    # a forest for each tree at most, not all pairs of the dense group
    assert links.count() < 40 * len(marks)


def test_every_bit_position_is_covered(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << x for x in rng.sample(range(64), 4)) for b in base]
    signed = [m - (1 << 64) if m >> 63 else m for m in base + near]
    links = simhash.link_fingerprints(spark.createDataFrame([(m,) for m in signed], "mark long"))
    roots = {r.node: r.root for r in components.components(links).collect()}
    assert all(roots[signed[k]] == roots[signed[k + 40]] for k in range(40))


def test_one_of_each_keeps_columns(docs, no_docs):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    classes = simhash.clustered(docs).collect()
    assert {r.doc_id for r in kept.collect()} == {r.component for r in classes}
    assert kept.count() == len({r.component for r in classes})
    assert simhash.one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("key_type", ["long", "string"])
def test_one_of_each_tells_rows_of_one_key_apart(spark, key_type):
    """Null and repeated keys with different texts, copies among them, and rows repeated as they are."""
    rng = random.Random(5)
    text = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(12)]
    data = [(1, text[0]), (None, text[0]), (None, text[1]), (None, text[2]), (None, text[2]), (7, text[3]), (7, text[4]),
            (7, text[5]), (3, text[5]), (8, text[6]), (8, text[6]), (None, text[7].upper()), (None, text[7]), (9, text[8]),
            (2, None), (None, ""), (7, text[0])]
    data = [(k if k is None or key_type == "long" else str(k), t) for k, t in data]
    docs = spark.createDataFrame(data, f"doc_id {key_type}, text string").repartition(3)
    classes = {}
    for k, t in data:
        classes.setdefault(simhash.fingerprint(t), []).append((k is None, k or 0, t))
    kept = simhash.one_of_each(docs)
    found = [(r.doc_id is None, r.doc_id or 0, r.text) for r in kept.collect()]
    assert kept.columns == docs.columns and len(found) == len(classes) == 10
    for mark, members in classes.items():
        mine = [f for f in found if simhash.fingerprint(f[2]) == mark]
        assert len(mine) == 1 and mine[0] in members and mine[0][:2] == min(m[:2] for m in members)


def test_components_of_chains_and_cycles(spark):
    chain = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    random.Random(1).shuffle(chain)
    found = components.components(spark.createDataFrame(chain, "a long, b long"))
    assert rows(found) == sorted([(k, 0) for k in range(61)] + [(k, 100) for k in (100, 101, 102)], key=repr)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
