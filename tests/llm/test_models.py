"""Language model, toxicity and quality: exact parts against plain Python, learnt parts by held-out results."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from conftest import rows
from llm_fixtures import docs, no_docs  # noqa: F401
from sessionloom.llm import knn_quality, maxent, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def fold(key, n):
    return zlib.crc32(("" if key is None else str(key)).encode()) % n


def tokens(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")] + [None]


@pytest.fixture(scope="module")
def small_known(monkeypatch_module):
    monkeypatch_module.setattr(maxent, "KNOWN", 40)


@pytest.fixture(scope="module")
def monkeypatch_module():
    with pytest.MonkeyPatch.context() as patch:
        yield patch


def test_base_scores_are_exact(docs, small_known):
    """With a frequent list too small for the words, so that the join of counts takes part."""
    data = docs.select("doc_id", "text").collect()
    train = Counter(t for r in data if fold(r.doc_id, 7) != 2 for t in tokens(r.text))
    total, distinct = sum(train.values()), len(train)
    expected = sorted((str(r.doc_id), fold(r.doc_id, 7) == 2, len(t := tokens(r.text)), sum(train[x] > 0 for x in t), total,
                       sum(math.log10((train[x] + 1) / (total + distinct + 1)) for x in t)) for r in data)
    found = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score)
                   for r in maxent.scored(docs).collect())
    assert [x[:5] for x in found] == [x[:5] for x in expected]
    assert [x[5] for x in found] == pytest.approx([x[5] for x in expected])


def test_model_is_a_distribution():
    words = {f"w{k}": 100 - k for k in range(90)} | {maxent.END: 50}
    model = maxent.Model(maxent.Vocabulary(words, sum(words.values()) + 30, len(words) + 20))
    rng = np.random.default_rng(1)
    model.class_rows += rng.normal(size=model.class_rows.shape).astype(np.float32)
    model.word_rows += rng.normal(size=model.word_rows.shape).astype(np.float32)
    _, features, _, _ = model.encode(["w1 w2 zz w3"])
    shared = np.full(1, -1)
    for k in range(len(features)):
        mass = sum(math.exp(model.log_probabilities(np.array([i]), features[k:k + 1])[0]) for i in range(model.v.classed))
        mass += math.exp(model.log_probabilities(shared, features[k:k + 1])[0])
        assert mass == pytest.approx(1, abs=1e-3)


def few_classes(monkeypatch, count=4):
    monkeypatch.setattr(maxent, "CLASSES", 1)
    monkeypatch.setattr(maxent, "PER_CLASS", count)


def test_all_tokens_together_have_probability_one(monkeypatch):
    """Tokens with a class, single leaves of a tree of several levels, and buckets."""
    few_classes(monkeypatch)
    monkeypatch.setattr(maxent, "FAN", 8)
    words = {f"w{k}": 400 - k for k in range(300)} | {maxent.END: 50}
    vocabulary = maxent.Vocabulary(words, sum(words.values()) + 90, len(words) + 60, np.array([50.0, 1.0, 70.0, 33.0]))
    assert len(vocabulary.levels) == 3 and vocabulary.single == 297
    model, rng = maxent.Model(vocabulary), np.random.default_rng(2)
    for rows in model.rows:
        rows += rng.normal(size=rows.shape).astype(np.float32)
    ids, features, _, _ = model.encode(["w1 zz w299 yy"])
    assert ids[[0, 2]].tolist() == [1, 299] and (ids[[1, 3]] < 0).all()
    every = np.arange(-4, len(words))
    for k in range(len(features)):
        logs = model.log_probabilities(every, np.repeat(features[k:k + 1], len(every), axis=0))
        assert np.exp(logs).sum() == pytest.approx(1, abs=1e-3)


def test_tokens_beyond_the_classes_are_told_apart_by_what_stands_before(monkeypatch):
    few_classes(monkeypatch)
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["the of and", f"a{k} b{k}"]) for k in rng.choices(range(30), k=40)) for _ in range(300)]
    counts = Counter(t for x in texts for t in maxent.tokens_of(x))
    known = {t.decode(): n for t, n in counts.items() if t != b"b7"}
    model = maxent.Model(maxent.Vocabulary(known, sum(counts.values()), len(counts)))
    trainer = maxent.Trainer(model)
    for k in [*range(0, 300, 20)] * 4:
        ids, features, _, _ = model.encode(texts[k:k + 20])
        trainer.learn(ids, features)

    def after(first, second):
        ids, features, _, _ = model.encode([f"{first} {second}"])
        return model.log_probabilities(ids, features)[1]

    for k in (3, 11, 25):
        assert after(f"a{k}", f"b{k}") > after(f"a{k}", f"b{k + 1}") + 2
    assert after("a7", "b7") > after("a3", "b7") + 2, "a token that no task knows, by its bucket"


def test_buckets_and_weight_rows_follow_the_training_tokens(spark, monkeypatch):
    monkeypatch.setattr(maxent, "KNOWN", 40)
    monkeypatch.setattr(maxent, "BUCKET", 8)
    counts = [(f"wörd{k}", 1 + 300 // (k + 1)) for k in range(400)]
    found, least = maxent.vocabulary(spark.createDataFrame(counts, "token string, c long"))
    rare = [(t, c) for t, c in counts if c < least]
    assert len(rare) >= 360 and len(found.buckets) == 64 and found.single == 0
    want = np.ones(64)
    for token, c in rare:
        want[xxhash.xxh64_intdigest(token.encode(), 42) >> 58] += c + 1
    assert found.buckets.tolist() == want.tolist()
    sizes = [len(maxent.Model(maxent.Vocabulary({}, maxent.GROWTH * n, 5)).word_rows) // maxent.WORD_ROWS for n in (0, 1, 4, 16)]
    assert sizes == [1, 2, 4, 8]


def test_model_beats_unigrams_on_held_out_text(spark):
    rng = random.Random(4)
    lines = ["the cat sat on the mat", "a dog ran over the hill", "we read old books at night"]
    data = [(k, " ".join(rng.choice(lines) for _ in range(20))) for k in range(200)]
    found = maxent.scored(spark.createDataFrame(data, "doc_id long, text string").repartition(2))
    held = found.filter("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert held[0] > 0.8 * held[1]


def test_texts_are_encoded_as_arrow_and_each_unknown_token_is_hashed_once(monkeypatch):
    known = {"the": 9, "cat": 5, maxent.END: 4}
    model = maxent.Model(maxent.Vocabulary(known, 40, 20, np.array([3.0, 1.0, 7.0, 2.0])))
    order, hashed, plain = ["the", "cat", maxent.END], [], xxhash.xxh64_intdigest
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda *a: hashed.append(a[0]) or plain(*a))
    texts = [None, "", " \t\n", "The\x0bCAT zz\x1czz zz  ZZ\n", "É the\xa0cat zz", "cat\x00 the"]
    ids, features, rare, sizes = model.encode(pa.array(texts))
    assert sorted(hashed) == sorted({"zz\x1czz".encode(), b"zz", "É".encode(), "the\xa0cat".encode(), b"cat\x00"})
    words = [w.decode() for t in texts for w in maxent.tokens_of(t)]
    assert words == [t or maxent.END for x in texts for t in tokens(x)]
    assert sizes.tolist() == [len(tokens(t)) for t in texts]
    assert ids.tolist() == [order.index(w) if w in known else -1 - (plain(w.encode(), 42) >> 62) for w in words]
    assert rare.to_pylist() == [w for w in words if w not in known]
    apart = [model.encode([t]) for t in texts]
    assert np.array_equal(features, np.concatenate([x[1] for x in apart])), "texts do not reach into each other"


def test_training_steps_add_up_the_gradient_of_every_row(monkeypatch):
    """Against sums in the plainest way, with rows met once, often, and more often than ``SHORT``; memory is used again."""
    rng = random.Random(8)
    words = {f"w{k}": 400 // (k + 1) + 1 for k in range(300)} | {maxent.END: 50}
    few_classes(monkeypatch, 8)
    monkeypatch.setattr(maxent, "BATCH", 500)
    model, want = (maxent.Model(maxent.Vocabulary(words, sum(words.values()) + 9, 310)) for _ in range(2))
    trainer, squares = maxent.Trainer(model), [np.zeros(len(rows)) for rows in want.rows]
    names, weights = [*words, "zz"], [*words.values(), 20]
    for _ in range(3):
        ids, features, _, _ = model.encode([" ".join(rng.choices(names, weights, k=200)) for _ in range(6)])
        trainer.learn(ids, features)
        for at in range(0, len(ids), maxent.BATCH):
            for layer, _, rows, logits, outcomes in want.layers(ids[at:at + maxent.BATCH], features[at:at + maxent.BATCH]):
                shares = np.exp(logits.astype(float))
                shares /= shares.sum(1, keepdims=True)
                shares[np.arange(len(outcomes)), outcomes] -= 1
                sums = np.zeros(want.rows[layer].shape)
                for line in rows:
                    np.add.at(sums, line, shares)
                squares[layer] += (sums * sums).sum(1)
                want.rows[layer][:] -= sums * (maxent.RATE / np.sqrt(squares[layer] + 1))[:, None]
    assert max(met.max() for _, _, met in trainer.state) > maxent.SHORT
    for found, expected in zip(model.rows, want.rows):
        assert np.abs(expected).max() > 0.1
        assert found == pytest.approx(expected, abs=1e-4)


def test_portions_hold_whole_stretches_and_few_bytes(monkeypatch):
    monkeypatch.setattr(maxent, "LEARNT", 2)
    monkeypatch.setattr(maxent, "TEXTS", 6)
    monkeypatch.setattr(maxent, "PORTION", 20)
    texts = ["a"] * 9 + ["b" * 90, None, "c" * 8, "d" * 8, "e" * 7, "", "f"]
    found = [(at, part.to_pylist()) for at, part in maxent.portions(pa.array(texts))]
    assert [at for at, _ in found] == [0, 6, 8, 10, 12] and [t for _, part in found for t in part] == texts
    assert [*maxent.portions(pa.array([], pa.string()))] == []


def test_row_numbers_are_sorted_stably_at_any_size():
    rng = np.random.default_rng(3)
    for below in (1, 2, 1 << 16, (1 << 16) + 1, 1 << 20, 1 << 33):
        for numbers in rng.integers(0, below, 3000), rng.integers(max(below - 5, 0), below, 3000):
            assert np.array_equal(maxent._order(numbers, below), np.argsort(numbers, kind="stable"))


def test_token_counts_are_added_up_whenever_a_task_holds_many(spark, monkeypatch):
    monkeypatch.setattr(maxent, "HELD", 3)
    monkeypatch.setattr(maxent, "LEARNT", 2)
    monkeypatch.setattr(maxent, "TEXTS", 4)
    texts = [None, "", "a b c d e f g", "B\x1c b  a", "\n", "x y z a A", "é É", "a", "b q r s t"] * 3
    data = [(k, t) for k, t in zip([k for k in range(200) if fold(k, 7) != 2], texts)]
    found = maxent.token_counts(spark.createDataFrame(data, "doc_id long, text string").coalesce(1), "doc_id", "text")
    assert {r.token: r.c for r in found.collect()} == Counter(t or maxent.END for _, x in data for t in tokens(x))


def test_language_model_without_training_rows(spark, no_docs):
    assert maxent.scored(no_docs).count() == 0
    held = next(k for k in range(100) if fold(k, 7) == 2)
    row = maxent.scored(spark.createDataFrame([(held, "a b"), (held, None)], "doc_id long, text string")).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in row] == [(0, 0, 0.0)] * 2


INSULTS = ["grobian", "schurke", "lumpen"]


def spoilt(word, rng):
    at = rng.randrange(2, len(word) - 1)
    return word[:at] + rng.choice("xz") + word[at:]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(9)
    syllables = ["ta", "ro", "mi", "ku", "le", "ve", "so", "na", "rel", "tok", "um", "da", "pil", "wen"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    data, labels = [], []
    for k in range(600):
        lines = [" ".join(word() for _ in range(9)) + "." for _ in range(rng.randint(1, 6))]
        toxic, poor = int(k % 3 == 0), int(k % 4 == 1)
        if toxic:
            at = rng.randrange(len(lines))
            insult = rng.choice(INSULTS)
            lines[at] = f"{word()} {insult if k % 2 else insult + rng.choice(['x', 'ta', 'um'])} {lines[at]}"
        text = "\n".join(lines)
        if poor:
            text = " ".join(w + "***" for w in text.split())
        data.append((k, text))
        labels.append((k, 1 - poor, toxic))
    data += [(1000 + k, w) for k, w in enumerate([None, "", "such a g.r.o.b.i.a.n here", "you s c h u r k e !",
                                                  "a " + spoilt("grobian", rng), "tarona miku leve."])]
    data += [(1003, "you s c h u r k e !")]
    return (spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(labels, LABELS))


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    found = toxicity.scored(docs, labels)
    held = found.join(labels, "doc_id").filter("held_out").collect()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) for r in found.collect())
    assert sum(r.predicted == r.toxic for r in held) >= 0.95 * len(held)
    by_id = {r.doc_id: r for r in found.collect()}
    # missing and empty texts, marks within a word, words spelt by letters, and a clean sentence
    assert [by_id[k].predicted for k in (1000, 1001, 1002, 1003, 1005)] == [0, 0, 1, 1, 0]
    # an inserted letter leaves it nearer to the insult than a clean sentence is
    assert by_id[1004].score > 2 * by_id[1005].score
    assert found.count() == docs.count() and all(0 <= r.score <= 1 for r in found.collect())
    kept = toxicity.kept(docs, labels)
    assert rows(kept, "doc_id") == rows(found.filter("predicted = 0"), "doc_id") and kept.columns == docs.columns


def test_kernel_equals_its_definition():
    def kernel(s, t):
        from itertools import combinations as c
        total = 0
        for a in c(range(len(s)), 3):
            for b in c(range(len(t)), 3):
                if all(s[i] == t[j] for i, j in zip(a, b)):
                    total += toxicity.DECAY ** (a[2] - a[0] + 1 + b[2] - b[0] + 1)
        return total

    names = ["idiot", "abcabc", "^trash"]
    strings = ["idiot", "idxiot", "abcabcab", "zz", "^trasxh", "toidi", "ünüabc"]
    found = toxicity.Landmarks(names).likeness(strings)
    for i, s in enumerate(strings):
        for j, t in enumerate(names):
            own = math.sqrt(kernel(s, s) * kernel(t, t))
            exact = kernel(s, t) / own if own else 0
            if exact >= toxicity.FAR:
                assert found[i, j] == pytest.approx(exact ** toxicity.POWER, rel=1e-4)
            else:
                assert found[i, j] <= toxicity.FAR ** toxicity.POWER + 1e-5


@pytest.mark.parametrize("text", [
    "you i d i o t. A man went", "we have plan b. i d i o t here", "a man\nI d i o t\nb c d", "you i- d- i- o- t- there",
    "you i, d, i, o, t, there", "you are an idiot. Bye now", "such an idiot!", "an idiot?! Go"])
def test_every_sentence_is_looked_up_as_learnt(text):
    """By a new reader, which has met nothing before, as by one that knows the bare word."""
    names = [toxicity.BEGIN + "idiot"]
    new, old = toxicity.Reader(names), toxicity.Reader(names)
    list(old.texts(["idiot"]))
    found = [list(r.texts([text, "a clean text"])) for r in (new, old)]
    for lines, none in found:
        assert [v.tolist() for v in lines] == [pytest.approx([1.0])] and none == []


def test_joins_of_a_sentence_follow_their_definition():
    rng = random.Random(4)
    names = ["^idiot", "^trash"]
    parts = ["i", "d-", "o,", "t", "T.", "I!", "idiot", "trash.", "x", "...", "\n", "plan", "(s)", "h", "a", "r"]
    landmarks, reader = toxicity.Landmarks(names), toxicity.Reader(names)
    for _ in range(300):
        text = " ".join(rng.choice(parts) for _ in range(12))
        expected = []
        for s in toxicity.sentences(text):
            values = [landmarks.likeness(toxicity.windows(u)) for u in toxicity.units(s)]
            near = [w.max(0) for v in values if len(w := v[v.max(1) >= toxicity.FAR ** toxicity.POWER])]
            expected += [np.max(near, axis=0)] if near else []
        found = next(iter(reader.texts([text])))
        assert len(found) == len(expected) and all(np.allclose(x, y) for x, y in zip(found, expected))


def test_late_sentences_are_learnt_from(spark):
    """Spoilt insults after many clean sentences, and margins that are those of scoring."""
    rng = random.Random(6)
    usual = ["table", "window", "garden", "letter", "morning", "market", "bridge", "teacher"]
    clean = lambda n: [" ".join(rng.choice(usual) for _ in range(6)) + "." for _ in range(n)]
    data = [(clean(12) + [f"you {spoilt(rng.choice(INSULTS), rng) if k % 4 else rng.choice(INSULTS)} there."], 1) if k % 2
            else (clean(rng.choice([2, 40])), 0) for k in range(240)]
    texts = [(" ".join(lines), label) for lines, label in data]
    model = toxicity.fit(spark.createDataFrame(texts, "text string, label int"))
    found = [model.score(f) for f in toxicity.Reader(model.names).texts([t for t, _ in texts])]
    assert sum((s >= 0.5) == y for s, (_, y) in zip(found, texts)) >= 0.95 * len(texts)
    kept = toxicity.distinct_sentences(list(toxicity.Reader(model.names).texts([texts[0][0]]))[0], len(model.names))
    assert kept[:, -1].sum() == len(data[0][0])
    # a spoilt insult alone is told from clean sentences
    assert min(model.score(f) for f in toxicity.Reader(model.names).texts(["you grxobian there", "you schuxrke there"])) > 0.5


def test_quality_on_held_out_rows(labelled):
    docs, labels = labelled
    found = knn_quality.scored(docs, labels)
    held = found.join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    assert found.count() == docs.count() and all(0 <= r.score <= 1 for r in found.collect())


def test_votes_equal_brute_force():
    rng = np.random.default_rng(3)
    counts = rng.poisson(0.05, (40, knn_quality.TERMS)).astype(np.float32)
    labels = rng.integers(0, 2, 30).astype(np.float32)
    idf, axes = np.ones(knn_quality.TERMS, np.float32), rng.normal(size=(knn_quality.TERMS, 8)).astype(np.float32)
    model = knn_quality.Model(idf, axes, np.zeros((0, 1)), labels, 0.5)
    model.vectors = model.project(counts[:30])
    for vote, c in zip(model.votes(counts[30:]), counts[30:]):
        z = model.project(c[None])[0]
        near = sorted(((float(z @ v), y) for v, y in zip(model.vectors, labels)), reverse=True)[:knn_quality.NEIGHBOURS]
        weights = [max(s, 0) ** 4 for s, _ in near]
        assert vote == pytest.approx(sum(w * y for w, (_, y) in zip(weights, near)) / sum(weights), rel=1e-3)


@pytest.mark.parametrize("module", [toxicity, knn_quality])
def test_without_labels_or_documents(spark, docs, no_docs, module):
    none = spark.createDataFrame([], LABELS)
    assert module.scored(no_docs, none).count() == 0
    found = module.scored(docs, none).collect()
    assert len(found) == docs.count() and len({r.score for r in found}) == 1
