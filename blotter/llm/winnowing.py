"""Document fingerprints by winnowing, with DataFrame functions only.

The words of a text, lower-cased, are hashed; a k-gram of words gets a rolling hash of theirs (cyclic
shifts and exclusive or, built by doubling, which gives every window the hash that sliding
over the words would). Of every window of w consecutive k-grams the one with the smallest hash is
chosen, the rightmost of equal ones, and its position kept. Two texts that share a run of
w + k - 1 words therefore share a chosen hash, at the same place of the run.

A k-gram is chosen if some window has it as its rightmost minimum, which its w - 1 neighbours to
either side decide. Texts are taken whole; a fingerprint has about 2 / (w + 1) of the words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import only

K = 5
W = 4
# Ranges of documents that are put in order by one task each, per shuffle partition.
_RANGES = 4
_MOST_RANGES = 1 << 18


# ------------------------------------------------------------ fingerprints


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, also where lambdas refer to it."""
    return F.get(F.transform(F.array(value), body), 0)


def _turned(value: Column, by: int) -> Column:
    by %= 64
    if by == 0:
        return value
    return F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, 64 - by))


def _pairwise(left: Column, right: Column, shift: int) -> Column:
    """Hashes of grams from those of a head and of a tail of ``shift`` words that follows it."""
    return F.zip_with(left, right, lambda a, b: _turned(a, shift).bitwiseXOR(b))


def gram_hashes(hashes: Column, k: int) -> Column:
    """Rolling hashes of all runs of k word hashes; ``hashes`` has at least k."""

    def cut(array: Column, skip: int, long: int) -> Column:
        # Arrays of runs of this many words, as many as there are k-grams.
        return F.slice(array, skip + 1, F.size(array) + (long - k))

    def grown(array: Column, long: int) -> Column:
        """The array of k-grams from the one of runs of ``long`` words."""
        if long == k:
            return array
        if 2 * long <= k:
            n = F.size(array) - long
            longer = _pairwise(F.slice(array, 1, n), F.slice(array, long + 1, n), long)
            return _let(longer, lambda a: grown(a, 2 * long))
        # What is missing overlaps the run: build it from the words.
        rest = k - long
        tail = _let(hashes, lambda h: gram_hashes(h, rest))
        return _let(
            tail, lambda t: _pairwise(cut(array, 0, long), F.slice(t, long + 1, F.size(t) - long), rest)
        )

    return grown(hashes, 1)


def _chosen(grams: Column, w: int) -> Column:
    """Positions of the grams that are the rightmost minimum of some window of w of them."""

    def picked(i: Column) -> Column:
        own = F.get(grams, i)
        # A comparison beyond the ends is null: that window does not exist.
        left = [F.lit(True)]
        right = [F.lit(True)]
        for j in range(1, w):
            left.append(left[-1] & (F.get(grams, i - j) >= own))
            right.append(right[-1] & (F.get(grams, i + j) > own))
        windows = [left[j] & right[w - 1 - j] for j in range(w)]
        return reduce(lambda a, b: a | b, windows)

    return F.filter(F.sequence(F.lit(0), F.size(grams) - 1), picked)


def winnow(text: Column, k: int = K, w: int = W) -> Column:
    """struct(hashes, positions): the chosen k-grams of a text and the words they start at.

    A text of fewer than k words has one gram of all of them; fewer than w grams are one window.
    A null text counts as empty, and an empty text or one of white space has empty arrays.
    """
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    kind = "struct<hashes:array<bigint>,positions:array<int>>"

    def of_grams(grams: Column) -> Column:
        least = F.array_min(grams)
        last = F.size(grams) - F.array_position(F.reverse(grams), least).cast("int")
        at = F.when(F.size(grams) < w, F.array(last)).otherwise(_chosen(grams, w))
        return _let(
            at,
            lambda p: F.struct(F.transform(p, lambda i: F.get(grams, i)).alias("hashes"), p.alias("positions")),
        )

    def of_hashes(hashes: Column) -> Column:
        short = F.array(F.xxhash64(hashes))
        grams = F.when(F.size(hashes) < k, short).otherwise(gram_hashes(hashes, k))
        found = _let(grams, of_grams).cast(kind)
        none = F.struct(F.array().alias("hashes"), F.array().alias("positions")).cast(kind)
        return F.when(F.size(hashes) == 0, none).otherwise(found)

    return _let(F.transform(words, lambda x: F.xxhash64(x)), of_hashes)


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes among all of two arrays; 1 for two empty ones."""
    common = F.size(F.array_intersect(a, b))
    both = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - common
    return F.when(both == 0, F.lit(1.0)).otherwise(common / both)


def digest(hashes: Column) -> Column:
    """32 hex digits of the chosen hashes in their order."""
    parts = [F.lpad(F.lower(F.hex(F.xxhash64(F.lit(seed), hashes))), 16, "0") for seed in (1, 2)]
    return F.concat(*parts)


def fingerprint_documents(
    docs: DataFrame, k: int = K, w: int = W, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint, hashes, positions.

    Null, empty and short texts as ``winnow`` says; repeated rows stay repeated, a null doc_id is
    kept; other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    found = only(docs, doc_id=doc_id, text=text).select("doc_id", winnow(F.col("text"), k, w).alias("f"))
    return found.select("doc_id", digest(F.col("f.hashes")).alias("fingerprint"), "f.hashes", "f.positions")


# ---------------------------------------------------------- edited documents


def _bounds(keys: DataFrame, ranges: int) -> list[int]:
    """At most ``ranges`` - 1 ascending values that cut the keys into parts of like size."""
    wanted = [i / ranges for i in range(1, ranges)]
    if not wanted:
        return []
    cut = F.percentile_approx("turn", F.array(*map(F.lit, wanted)), F.lit(max(10_000, 10 * ranges)))
    return sorted(set(keys.agg(cut.alias("cut")).first()["cut"] or []))


def _range_of(turn: Column, bounds: list[int]) -> Column:
    """How many bounds lie below a key, by halving steps."""
    if not bounds:
        return F.lit(0)
    steps = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]
    return _let(
        F.array(*[F.lit(b).cast("long") for b in bounds]),
        lambda cuts: F.aggregate(
            F.array(*map(F.lit, steps)),
            F.lit(0),
            lambda at, step: F.when(F.get(cuts, at + step - 1) < turn, at + step).otherwise(at),
        ),
    )


def with_next(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """(doc_id, text, hashes, next_text, next_hashes) of the rows (doc_id, text) in order of falling id.

    The last row is followed by the first. Rows of one id stand in order of their texts' hashes, rows
    without an id come last; null texts count as empty. Texts are shuffled once, into ranges of
    the id; the first row of the next range is put at the end of each as well, so that no range
    looks into another.
    """
    spark = docs.sparkSession
    body = F.coalesce("text", F.lit(""))
    # Falling ids are rising complements.
    rows = docs.select(
        "doc_id",
        body.alias("text"),
        F.col("doc_id").isNull().alias("gone"),
        F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(0).cast("long")).alias("turn"),
        F.xxhash64(body).alias("mark"),
    )
    ranges = min(_MOST_RANGES, _RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = _bounds(rows.where("NOT gone").select("turn"), ranges)
    at = F.when(F.col("gone"), len(bounds) + 1).otherwise(_range_of(F.col("turn"), bounds))
    placed = rows.withColumn("range", at)
    key = F.struct("gone", "turn", "mark")
    # One row per range from here.
    firsts = placed.groupBy("range").agg(F.min(key).alias("first"))
    order = Window.orderBy("range")
    follow = firsts.select(
        "range",
        F.coalesce(
            F.lead("first").over(order),
            F.first("first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("first"),
    ).select("range", *[F.col(f"first.{c}").alias(f"{c}_") for c in ("gone", "turn", "mark")])
    same = [F.col(c) == F.col(f"{c}_") for c in ("gone", "turn", "mark")]
    guests = (
        rows.join(follow, same).groupBy("range").agg(F.first("text").alias("text"))
    )
    union = placed.select("range", "doc_id", "text", "gone", "turn", "mark", F.lit(False).alias("guest")).unionByName(
        guests.select("range", "text", F.lit(True).alias("guest")), allowMissingColumns=True
    )
    # Fingerprints are made where the rows have come to; only texts are shuffled.
    found = union.repartition("range").withColumn("hashes", winnow(F.col("text"), k, w)["hashes"])
    here = Window.partitionBy("range").orderBy("guest", "gone", "turn", "mark")
    ahead = found.withColumns(
        {"next_text": F.lead("text").over(here), "next_hashes": F.lead("hashes").over(here)}
    )
    return ahead.where("NOT guest").select("doc_id", "text", "hashes", "next_text", "next_hashes")


def compare_edits(
    docs: DataFrame, k: int = K, w: int = W, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Each document beside its edited text: the last third of its code points, rounded down, is
    replaced by the first as many (or all) of the next document in order of falling id.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. Null texts count as empty; ids are whole numbers; the order of repeated ids is that
    of ``with_next``; other columns are ignored, whatever their names; an empty table gives an
    empty result.
    """
    ahead = with_next(only(docs, doc_id=doc_id, text=text), k, w)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third)
    )
    both = ahead.withColumn("edited", edited)
    found = both.withColumn("edited_hashes", winnow(F.col("edited"), k, w)["hashes"])
    return found.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        digest(F.col("hashes")).alias("fingerprint"),
        digest(F.col("edited_hashes")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )
