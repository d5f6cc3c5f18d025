"""Quality rules, licences, token counts and mixing against plain Python."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import rows
from llm_fixtures import docs, no_docs  # noqa: F401
from sessionloom.llm import licenses, mixing, quality_rules, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
public_tokenizers = pytest.importorskip("public_tokenizers")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            hit.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def test_counts_of_whole_texts(docs):
    found = quality_rules.judged(docs, "doc_id").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    expected = []
    for r in docs.collect():
        n = counts(r.text)
        expected.append((r.doc_id, *n, n[0] < 10 or 100 * n[4] > 20 * n[0]))
    assert rows(found) == sorted(expected, key=repr)


@pytest.mark.parametrize("line, fails", [
    ("A plain sentence with words, and a stop.", False), ("", False), ("   ", False),
    ("Home | About | Contact | Help", True), ("word*** other%%% third###", True), ("READ!! THIS!! NOW!!", True),
    ("so so so that that", True), ("that that may be so in a long and quiet sentence", False),
    ("This site uses cookies.", True), ("All rights reserved", True),
    ("We sell a cookie " + "with many words around it, " * 8, False)])
def test_lines(spark, line, fails):
    found = spark.createDataFrame([(line,)], "line string").select(quality_rules.line_fails(F.col("line"))).first()[0]
    assert found is fails


def test_losing_too_much_text_rejects(spark):
    good = "These are ten words that stand in a plain line here."
    text = good + "\nHome | About | Contact"
    found = {r.doc_id: r for r in quality_rules.judged(spark.createDataFrame([
        (1, text), (2, text + "\n" + "a | b | c | d | e | f | g | h | i | j | k | l | m | n")], "doc_id long, text string"), "doc_id").collect()}
    assert found[1].clean_text == good and not found[2].kept


def test_empty_tables_give_empty_results(no_docs):
    assert quality_rules.judged(no_docs, "doc_id").count() == 0
    assert licenses.scanned(no_docs, "doc_id").count() == 0
    assert mixing.mixed(no_docs).count() == 0


def test_verdict_as_filter_keeps_the_counts_single(docs):
    kept = quality_rules.judged(docs, "doc_id").filter("kept")
    assert kept.count() == quality_rules.judged(docs, "doc_id").select(F.sum(F.col("kept").cast("int"))).first()[0]


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0


def test_licenses_against_all_notices(spark, docs):
    more = spark.createDataFrame([
        (900, "Text.\nReleased under the MIT License."), (901, "Licensed  under the APACHE license; version 2.0"),
        (902, "This work is licensed under the GNU\nGeneral Public License,\nversion 3."),
        (903, "This work is licensed under the GNU General Public License, version 4."), (904, "License")],
        "doc_id long, text string")
    found = licenses.scanned(docs.select("doc_id", "text").union(more), "doc_id")
    known = sorted((n, set(licenses.notice_bigrams(t))) for n, ts in licenses.NOTICES.items() for t in ts)
    expected = []
    for r in docs.select("doc_id", "text").union(more).collect():
        lines = (r.text or "").split("\n")
        best = []
        for unit in lines + ([r.text] if len(lines) > 1 else []):
            found_here = [(dice(set(licenses.notice_bigrams(unit or "")), b), n) for n, b in known]
            top = max(found_here, key=lambda x: x[0])
            if top[0] >= licenses.THRESHOLD:
                best.append(min(n for d, n in found_here if d == top[0]))
        expected.append((r.doc_id, len(best), ",".join(sorted(set(best)))))
    assert rows(found, "doc_id", "n_matches", "licenses") == sorted(expected, key=repr)
    assert {r.doc_id for r in found.filter("n_matches > 0").collect()} == {900, 901, 902, 903}


def test_token_counts_equal_the_library(spark, docs):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = [(500, "a  b"), (501, "  a b  "), (502, "a▁b ▁ c▁ d"), (503, "<s> </s> <unk>"), (504, "\n\n x\ty"), (505, "   "),
           (506, "日本語 テキスト 😀"), (507, "word " * 200000)]
    texts = docs.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    found = texts.select("doc_id", token_counts.piece_count(spark, path, F.col("text")).alias("n"))
    expected = [(r.doc_id, len(model.encode(r.text or ""))) for r in texts.collect()]
    assert rows(found) == sorted(expected, key=repr)


def test_pieces_join_to_the_text():
    text = "ab  cd▁ e" * 50 + "x" * 500 + " end "
    for most in (1, 7, 100):
        assert "".join(token_counts.pieces_of(text, most)) == text


def water(sizes, share, weights):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            target.update({s: level * weight[s] for s in free})
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_mix_meets_targets(docs):
    sized = mixing.sized_rows(docs)
    plan = mixing.mix_plan(sized)
    found = mixing.with_taken(sized, plan).collect()
    sizes, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    assert len(found) == docs.count()
    target = water(sizes, 1.5, (5, 2, 1))
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
    for s in sizes:
        # within the rows at one place of the hash line
        assert abs(taken[s] - target[s]) <= 3 * most[s]
    again = mixing.with_taken(mixing.sized_rows(docs), mixing.mix_plan(mixing.sized_rows(docs))).collect()
    key = lambda r: (str(r.key), r.size, r.copies)
    assert sorted(map(key, found)) == sorted(map(key, again))


def test_thresholds_are_nested(docs):
    sized = mixing.sized_rows(docs)
    small, large = ({str(r.key): r.copies for r in mixing.with_taken(sized, mixing.mix_plan(sized, share=s)).collect()}
                    for s in (0.3, 0.9))
    assert all(small[k] <= large[k] for k in small)


def test_mixed_rows_repeat_with_their_columns(docs):
    out = mixing.mixed(docs)
    assert out.columns == [*docs.columns, "epoch"]
    sized = mixing.sized_rows(docs)
    expected = mixing.with_taken(sized, mixing.mix_plan(sized)).agg(F.sum("copies")).first()[0]
    assert out.count() == expected


def test_salted_lookup_equals_broadcast(spark, docs, monkeypatch):
    from sessionloom.llm import common

    plan = mixing.mix_plan(mixing.sized_rows(docs))
    one = rows(mixing.with_taken(mixing.sized_rows(docs), plan).drop("source"))
    monkeypatch.setattr(common, "BROADCAST_BYTES", 1)
    assert rows(mixing.with_taken(mixing.sized_rows(docs), plan).drop("source")) == one


def test_rows_repeated_in_steps(spark, monkeypatch):
    from sessionloom.llm import common

    monkeypatch.setattr(common, "_FAN", 4)
    frame = spark.createDataFrame([(k, n) for k, n in enumerate([1, 0, 4, 5, 8, 23, 1])], "k long, n long")
    found = common.repeated(frame, "n")
    assert found.columns == ["k"]
    assert {r.k: r["count"] for r in found.groupBy("k").count().collect()} == {0: 1, 2: 4, 3: 5, 4: 8, 5: 23, 6: 1}
