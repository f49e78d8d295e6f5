"""Operator 10, document fingerprints by consistent weighted sampling.

A text's terms are its words, weighted by how often they occur.  For each of K samples a term draws, from
hashes of itself alone, r and c from Gamma(2, 1) and b from Uniform(0, 1); with weight S it takes
t = floor(ln S / r + b) and a = c exp(-r (t - b + 1)).  The term of least a, with its t, is the sample, and two texts
share a sample with probability equal to their generalised Jaccard similarity.  All of it is built-in
Spark functions: the words are exploded, counted and reduced to K minima per text within the partition
that holds the text, so the texts are shuffled once and nothing else grows with their words.

Each minimum is one long: 38 bits of ln a above 24 bits of a hash of (term, t).

Defined results: null text: empty.  A text without words has one common fingerprint of its own.  Texts
are ordered by doc_id, nulls first, then by hash of the text; equal rows are one document with one result
row each.  Extra columns are ignored.  A single document is its own neighbour.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: A likeness is a share of K samples: its standard error is at most 0.5 / sqrt(K), 0.089 (0.071 at 0.8, 0.054 at 0.9).
K = 32
#: Characters of both versions that one partition holds; its words are counted in memory.  Beyond so many partitions
#: each holds more and its aggregates spill; the results are the same.
PARTITION_CHARS, MOST_PARTITIONS = 16_000_000, 100_000
#: What names a distinct document, and the one before it.
KEY, BEFORE = ["gid", "text_key"], ["before_gid", "before_text_key"]


def _packed(i: int) -> Column:
    """The i-th packed long of a row with term (long hash) and ln_s (log of its weight)."""
    h1, h2 = F.xxhash64("term", F.lit(2 * i)), F.xxhash64("term", F.lit(2 * i + 1))

    def unit(h: Column, shift: int, bits: int) -> Column:
        return (F.shiftrightunsigned(h, shift).bitwiseAND((1 << bits) - 1) + F.lit(0.5)) * F.lit(1.0 / (1 << bits))

    r = -F.ln(unit(h1, 0, 24) * unit(h1, 24, 24))
    ln_c = F.ln(-F.ln(unit(h2, 0, 24) * unit(h2, 24, 24)))
    b = unit(h1, 48, 16)
    t = F.floor(F.col("ln_s") / r + b)
    level = F.floor((ln_c - r * (t - b + 1) + 128.0) * float(1 << 30))
    return F.shiftleft(level, 24).bitwiseOR(F.xxhash64("term", t).bitwiseAND((1 << 24) - 1))


def sketch(texts: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """(by..., m: array of k longs) of rows (by..., text), already partitioned by some of ``by``."""
    words = F.split(F.btrim(F.col("text"), F.lit(" \t\n\x0b\f\r")), "[\\x20\\x09-\\x0D]+")     # [""] where there is no word
    counted = texts.select(*by, F.explode(words).alias("word")).select(*by, F.xxhash64("word").alias("term")).groupBy(*by, "term").agg(F.count(F.lit(1)).alias("n"))
    drawn = counted.select(*by, "term", F.ln(F.col("n").cast("double")).alias("ln_s"))
    least = drawn.groupBy(*by).agg(*(F.min(_packed(i)).alias(f"m{i}") for i in range(k)))
    return least.select(*by, F.array(*(F.col(f"m{i}").bitwiseAND((1 << 24) - 1) for i in range(k))).alias("m"))


def text_of(m: Column) -> Column:
    """A sketch as a string, six hexadecimal digits a sample."""
    return F.array_join(F.transform(m, lambda x: F.lpad(F.lower(F.hex(x)), 6, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples: estimates the generalised Jaccard similarity."""
    return F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: p["a"] == p["b"])) / F.size(a)


def _neighbours(keys: DataFrame) -> DataFrame:
    """Each distinct document (KEY) with its copies and the one before it in order; the first's is the last.

    Ranges of the order are ordered apart; only their ends meet.  Ranges and rows a range grow alike, with the root of
    the rows: 25,000 ranges of 400,000 rows for 10 ** 10 documents."""
    ranges = max(1, math.isqrt(keys.count()) // 4)
    k = keys.groupBy(*KEY, "doc_id", "h", "n_chars").agg(F.count(F.lit(1)).alias("copies"))
    k = materialize(k.repartitionByRange(ranges, "doc_id", "h", "n_chars").withColumn("part", F.spark_partition_id()), "ranged")
    k = k.withColumn("me", F.struct("doc_id", "h", "n_chars", *KEY))
    k = k.withColumn("before", F.lag("me").over(Window.partitionBy("part").orderBy("me")))
    ends = k.groupBy("part").agg(F.max("me").alias("last"))            # a row a range
    across, whole = Window.orderBy("part"), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lag("last").over(across), F.last("last").over(whole)).alias("part_before"))
    before = F.coalesce("before", "part_before")
    return k.join(F.broadcast(ends), "part").select(*KEY, "doc_id", "n_chars", "copies", *(before[c].alias(f"before_{c}") for c in (*KEY, "n_chars")))


def _pairs(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gid, text, edited) of each distinct document, and the order they have."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("h", F.xxhash64("text"))
    plain = plain.select("doc_id", "h", F.length("text").cast("long").alias("n_chars"), "text")
    # a hash alone could name two of very many documents; a doc_id with a hash of its text can't
    key = [F.coalesce("doc_id", F.lit(0).cast("long")).alias("gid"), F.xxhash64("h", "n_chars", F.col("doc_id").isNull()).alias("text_key")]
    keys = materialize(plain.select(*key, "doc_id", "h", "n_chars"), "keys")
    order = materialize(_neighbours(keys), "order")
    parts = 1 + 2 * (keys.agg(F.sum("n_chars")).first()[0] or 0) // PARTITION_CHARS
    # both uses of the texts below read the same columns, so their one exchange is shared
    one = plain.select(*key, "text").repartition(int(min(parts, MOST_PARTITIONS)), *KEY).groupBy(*KEY).agg(F.first("text").alias("text"))
    all_ = one.join(order.select(*KEY, "n_chars", *BEFORE, "before_n_chars"), KEY)
    given = all_.select(*(F.col(b).alias(c) for b, c in zip(BEFORE, KEY)), F.expr("left(text, int(before_n_chars div 2))").alias("prefix"))
    edited = F.concat(F.expr("left(text, int(n_chars - n_chars div 2))"), F.col("prefix"))
    return all_.select(*KEY, "n_chars", "text").join(given, KEY).select(*KEY, "text", edited.alias("edited")), order


def compare(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness, one row per input row."""
    pairs, order = _pairs(docs)
    versions = pairs.select(*KEY, F.explode(F.array(F.struct(F.lit(0).alias("version"), F.col("text")), F.struct(F.lit(1).alias("version"), F.col("edited").alias("text")))).alias("v"))
    drawn = sketch(versions.select(*KEY, "v.version", "v.text"), [*KEY, "version"], k)
    both = drawn.groupBy(*KEY).agg(F.max(F.when(F.col("version") == 0, F.col("m"))).alias("m"), F.max(F.when(F.col("version") == 1, F.col("m"))).alias("e"))
    known = both.join(pairs.select(*KEY, F.sha2("edited", 256).alias("edited_sha256")), KEY).join(order, KEY)
    data = ["doc_id", "n_chars", "copies", "edited_sha256", "m", "e"]
    sent = known.select(F.explode(F.array(     # each sketch also goes to the document before it
        F.struct(*KEY, *data, F.lit(0).alias("next")), F.struct(*(F.col(b).alias(c) for b, c in zip(BEFORE, KEY)), *data, F.lit(1).alias("next")))).alias("s")).select("s.*")
    met = sent.groupBy(*KEY).agg(F.max(F.when(F.col("next") == 0, F.struct(*data))).alias("own"), F.max(F.when(F.col("next") == 1, F.col("m"))).alias("after")).select("own.*", "after")
    out = met.select("doc_id", "n_chars", "edited_sha256", text_of(F.col("m")).alias("fingerprint"), text_of(F.col("e")).alias("edited_fingerprint"),
                     likeness(F.col("m"), F.col("e")).alias("near_edited"), likeness(F.col("m"), F.col("after")).alias("near_next"), "copies")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies", "copy")
