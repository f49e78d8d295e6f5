"""Small documents with every awkward case, and plain-Python versions of what the queries must return."""

import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, vocabulary=400):
    words = [f"{a}{b}" for a in ("the", "an", "or", "in", "es", "ti", "wh", "né") for b in ("", "re", "ing", "th", "on", "sh", "ly,", "er.")]
    words += [f"w{i}x" for i in range(vocabulary)]
    return " ".join(rng.choice(words) for _ in range(n))


def nasty_rows(seed=3, n=60):
    """(doc_id, text, lang, source, n_chars): prose, copies, near copies, nulls, empties, ties, repeats, long texts."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.choice([1, 2, 3, 8, 30, 80, 200])), "en", f"s{i % 3}", 0) for i in range(n)]
    base = prose(rng, 150)
    passage = prose(rng, 40)
    for k in range(8):
        words = base.split(" ")
        for _ in range(k // 2):
            words[rng.randrange(len(words))] = f"edit{k}"
        rows.append((n + k, " ".join(words), "en", "s0", 0))
    rows += [(n + 8 + k, prose(rng, 20) + "\n" + passage + "\n" + prose(rng, 20), None, None, None) for k in range(5)]
    at = n + 20
    rows += [(at, None, None, None, None), (at + 1, "", "en", "s1", 0), (at + 2, " \t\n \x0b", "en", "", 3), (at + 3, "é" * 70, "fr", "s2", 70),
             (at + 4, "x" * 5000, "en", "s2", 1), (at + 5, "same line\nsame line\n\nsame line", "en", "s1", 5), (at + 6, "a b c d e " * 400, "en", "s1", 5),
             (at + 7, prose(rng, 30_000), "en", "s0", 1), (at + 8, "Ünïcode 🎉 naïve 漢字\x00nul İΣ", "xx", "é", 1), (at + 9, "One Two", "en", "s1", 1), (at + 10, "one two", "en", "s1", 1),
             (at + 11, base, "en", "s0", 0), (at + 11, base, "en", "s0", 0), (None, base, "en", "s0", 0), (None, None, None, None, None), (-5, passage, "en", "s1", 2)]
    return rows


@pytest.fixture(scope="session")
def nasty():
    return nasty_rows()


@pytest.fixture(scope="session")
def docs(spark, nasty):
    """With extra columns whose names clash with those the operators use inside."""
    extra = ("size", "key", "node", "h", "n", "gid", "v", "score", "times", "kept", "name", "component")
    frame = spark.createDataFrame(nasty, SCHEMA)
    for c in extra:
        frame = frame.withColumn(c, frame["lang"])
    return frame


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, nasty):
    return spark.createDataFrame([(i, int(i % 4 != 0), int(i % 5 == 0)) for i, *_ in nasty if i is not None and i < 60] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def table(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
