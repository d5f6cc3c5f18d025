"""Benchmark decontamination by winnowing.

Every span of ``WINDOW`` words holds ``WINDOW - GRAM + 1`` word ``GRAM``-grams; the smallest of their hashes is the
span's fingerprint. Consecutive spans mostly share it, so a document keeps one fingerprint per run of spans,
about two for seven words. Equal spans have equal fingerprints: whatever passage of ``WINDOW`` words a document
shares with a benchmark item, its run survives the join of fingerprints, and then every span of the run is
compared with the item's spans. Nothing that is long enough can be missed, and no pair of texts is formed.

A benchmark item with fewer words is found as a whole, by the same steps with its length as window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written_once
from .common import hashes_of, let, lookup_join, lower_ascii, repeated, window_hashes

WINDOW, GRAM = 10, 5
# ASCII characters that are no part of a word
_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SEPARATORS = "".join(c for c in map(chr, range(128)) if not c.isalnum())


def plain_words(text: Column) -> Column:
    """Runs of ASCII letters, digits and all other Unicode characters, A to Z as small letters."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SEPARATORS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SEPARATOR))
    return F.transform(words, lambda w: F.when(F.lower(w) == w, w).otherwise(lower_ascii(w)))


def _gram(window: int) -> int:
    return min(GRAM, window)


def _fingerprints(grams: Column, window: int) -> Column:
    """The smallest gram hash in every span of ``window`` words, as array."""
    others = window - _gram(window)
    spans = F.slice(grams, 1, F.greatest(F.size(grams) - others, F.lit(0)))
    return F.transform(spans, lambda x, i: F.least(x, *[F.get(grams, i + d) for d in range(1, others + 1)])
                       if others else x)


def _runs(grams: Column, window: int) -> Column:
    """Runs of spans with one fingerprint: fingerprint, first span, window, and the gram hashes they cover."""
    others = window - _gram(window)

    def cut(mins: Column) -> Column:
        marked = F.transform(mins, lambda x, i: F.when(
            (i == 0) | (x != F.get(mins, i - 1)), F.struct(x.alias("mark"), i.alias("begin"))))
        return let(F.filter(marked, lambda r: r.isNotNull()), lambda starts: F.transform(starts, lambda r, j: F.struct(
            r["mark"].alias("mark"), r["begin"].alias("begin"), F.lit(window).alias("width"),
            F.slice(grams, r["begin"] + 1,
                    F.coalesce(F.get(starts, j + 1)["begin"], F.size(mins)) - r["begin"] + others).alias("grams"))))

    return let(_fingerprints(grams, window), cut)


def _spans(begin: Column, grams: Column, window: Column) -> Column:
    """Spans of one run: first word, and the hashes of the first and the last gram, which cover the span."""
    others = F.greatest(window - GRAM, F.lit(0))
    return F.transform(F.slice(grams, 1, F.size(grams) - others), lambda a, d: F.struct(
        (begin + d).alias("start"), a.alias("first"), F.get(grams, d + others).alias("last")))


def benchmark_spans(benchmark: DataFrame, item: str = "item_id", text: str = "text",
                    window: int = WINDOW) -> DataFrame:
    """Distinct spans of all items, stored: width, mark (fingerprint), first, last (hashes), items (sorted texts
    of the ids that hold the span). Items without words give none; an id that is missing counts as an empty text.
    """
    words = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"),
                             plain_words(F.col(text)).alias("words"))
    hashed = words.select("item", hashes_of(F.col("words")).alias("hashes")).filter(F.size("hashes") > 0)
    widths = [r.width for r in hashed.select(
        F.least(F.size("hashes"), F.lit(window)).alias("width")).distinct().sort("width").collect()]
    parts = []
    for width in widths or [window]:
        mine = hashed.filter(F.size("hashes") >= width if width == window else F.size("hashes") == width)
        grams = mine.select("item", window_hashes(F.col("hashes"), _gram(width)).alias("grams"))
        runs = grams.select("item", F.explode(_runs(F.col("grams"), width)).alias("r"))
        parts.append(runs.select("item", "r.width", "r.mark", F.explode(
            _spans(F.col("r.begin"), F.col("r.grams"), F.col("r.width"))).alias("s")).select(
            "item", "width", "mark", "s.first", "s.last"))
    spans = parts[0]
    for part in parts[1:]:
        spans = spans.union(part)
    found = spans.groupBy("width", "first", "last").agg(
        F.first("mark").alias("mark"), F.sort_array(F.collect_set("item")).alias("items"))
    return written_once(found)


def contamination(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text",
                  window: int = WINDOW) -> DataFrame:
    """What every row of ``docs`` shares with the benchmark.

    Columns: ``doc``, _key (hash of the text), n_words, n_hit (words within shared spans), n_items, items (sorted texts of ids), hits
    (shared spans as first word and width), contaminated. A missing text has no words; an empty benchmark hits
    nothing. Rows that repeat an id, with the same or another text, each get a row of their own.
    Hashes are of 64 bits for a fingerprint and 128 bits for a span.
    """
    spans = benchmark_spans(benchmark, text=text, window=window)
    widths = sorted(r.width for r in spans.select("width").distinct().collect())
    marks = written_once(spans.select("mark").distinct().withColumn("marked", F.lit(True)))
    sets = written_once(spans.select("items").distinct().withColumn("set_id", F.xxhash64("items")))
    if sets.groupBy("set_id").count().filter("count > 1").limit(1).count():
        raise RuntimeError("two sets of benchmark items share a hash")
    keyed = written_once(spans.select("width", "first", "last", F.xxhash64("items").alias("set_id")))

    rows = docs.select(F.col(doc).alias("_doc"), F.xxhash64(text).alias("_key"), plain_words(F.col(text)).alias("_words"))
    rows = rows.select("_doc", "_key", F.size("_words").alias("n_words"), hashes_of(F.col("_words")).alias("_hashes"))
    # a first entry without grams stands for the document itself; its mark spreads over all partitions
    entry = F.struct(F.xxhash64("_doc").alias("mark"), F.lit(0).alias("begin"), F.lit(0).alias("width"),
                     F.lit(None).cast("array<bigint>").alias("grams"))
    runs = [F.array(entry)]
    grams = {g: window_hashes(F.col("_hashes"), g) for g in {_gram(w) for w in widths}}
    rows = rows.select("_doc", "_key", "n_words", *[c.alias(f"_grams{g}") for g, c in grams.items()])
    runs += [_runs(F.col(f"_grams{_gram(w)}"), w) for w in widths]
    exploded = rows.select("_doc", "_key", "n_words", F.explode(F.concat(*runs)).alias("r")).select(
        "_doc", "_key", "n_words", "r.*")
    near = lookup_join(exploded, marks, "mark").filter("width = 0 or marked")
    spanned = near.select(
        "_doc", "_key", "n_words", "width",
        F.explode_outer(_spans(F.col("begin"), F.col("grams"), F.col("width"))).alias("s")).select(
        "_doc", "_key", "n_words", "width", "s.*")
    hits = lookup_join(spanned, keyed, ["width", "first", "last"]).filter("width = 0 or set_id is not null")

    by_set = hits.groupBy("_doc", "_key", "set_id").agg(
        F.sum((F.col("width") == 0).cast("long")).alias("copies"), F.max("n_words").alias("n_words"),
        F.collect_set(F.when(F.col("width") > 0, F.struct("start", "width"))).alias("hits"))
    merged = lookup_join(by_set, sets, "set_id").groupBy("_doc", "_key").agg(
        F.sum("copies").alias("copies"), F.max("n_words").alias("n_words"),
        F.sort_array(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    covered = F.aggregate(
        "hits", F.struct(F.lit(0).alias("total"), F.lit(0).alias("end")),
        lambda acc, x: F.struct(
            (acc["total"] + F.greatest(x["start"] + x["width"] - F.greatest(acc["end"], x["start"]), F.lit(0))).alias("total"),
            F.greatest(acc["end"], x["start"] + x["width"]).alias("end")))["total"]
    return repeated(merged.select(
        F.col("_doc").alias(doc), "_key", F.col("n_words").cast("long").alias("n_words"), covered.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), "items", "hits",
        (F.size("hits") > 0).alias("contaminated"), "copies"), "copies")


def uncontaminated(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text",
                   window: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` that share no span with the benchmark, with all their columns.

    Rows are told apart by id and text, so of two rows with one id only the contaminated one goes.
    """
    found = contamination(docs, benchmark, doc, text, window).filter("contaminated").select(
        F.col(doc).alias("hit"), F.col("_key").alias("hit_key")).distinct()
    same = docs[doc].eqNullSafe(found["hit"]) & (F.xxhash64(docs[text]) == found["hit_key"])
    return docs.join(found, same, "left_anti")
