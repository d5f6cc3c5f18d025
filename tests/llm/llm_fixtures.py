"""Small tables with the edge cases of training text; test modules import the fixtures they use."""

import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "n_words long, size long, kept boolean, component string, _key string")


def prose(rng, n, words=60):
    return " ".join(rng.choice(WORDS) for _ in range(n)) if n else ""


WORDS = [a + b for a in ("ta", "ro", "mi", "ku", "Le", "vÉ", "so") for b in ("na", "rel", "tok", "um", "iß", "da", "x")]


def small_docs():
    """Texts with every edge: missing, empty, blank, one word, very long, repeated rows, copies, ties."""
    rng = random.Random(7)
    texts = [None, "", " \t\n\x0b\f\r ", "one", "a b c", "!!! ???", "Über mensch x y"]
    texts += [prose(rng, n) + "." for n in (5, 12, 40, 80, 80, 200, 400)]
    texts += [prose(rng, 30) + "\n" + prose(rng, 30) + "\n\n" + prose(rng, 8)]
    texts += [texts[9] + " tail", texts[9], texts[9].replace("na", "no", 1)]
    texts += [" ".join(["same words again here now"] * 20), "a | b | c | d\nHome | About | Contact", "word*** " * 30]
    texts += [prose(rng, 30000), "x" * 50000]
    rows = [(k, t, "en", ["s1", "s2", None, "é"][k % 4], None, 1, 2, True, "c", "k") for k, t in enumerate(texts)]
    rows.append((None, prose(rng, 20), "en", "s1", 3, 1, 2, True, "c", "k"))
    rows += [rows[10], rows[10], rows[3]]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(small_docs(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
