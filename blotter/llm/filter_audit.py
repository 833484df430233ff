"""What each of several filters removes, in every order, and its fair share of all removals.

Documents are tabulated by the set of filters that they fail, once per part; from these at most
2^n counts a part follow the removals of all 2^n coalitions of n filters. A step of an order
removes what its coalition removes beyond the one before it. The Shapley values solve least squares:
additive values that come closest to the removals of all coalitions, weighted by the Shapley kernel,
under the constraint that they add up to what all filters remove. The normal equations with
their multiplier are solved in rationals, so the values are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MAX_FILTERS = 7

_BLANKS = r"[\x20\x09-\x0D]+"
_COUNTS = ("docs", "good", "toxic")
_AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


# ------------------------------------------------------------ failed filters


def text_failures(text: Column) -> list[Column]:
    """The conditions A to D on a text that is not null: few words, few distinct ones, many
    capitals, a special character."""
    words = F.array_remove(F.split(text, _BLANKS), "")
    return [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 3 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    ]


def failure_cells(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "lang",
    quality: str = "quality",
    toxic: str = "toxic",
) -> DataFrame:
    """(part, failed, docs, good, toxic): documents by the set of filters A to E they fail.

    Bit i of ``failed`` stands for filter i; E fails on a text that a smaller doc_id has as well,
    in any part. ``good`` and ``toxic`` count the documents with a label 1; several labels of one
    id count as 1 if one of them is. Null texts count as empty and null parts as the empty string;
    rows without an id have no labels and take no part in E. Repeated rows are documents of their
    own. Only hashes, ids and bits are shuffled, and copies are counted before they meet.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    bits = sum((fails.cast("int") * (1 << i) for i, fails in enumerate(text_failures(body))), F.lit(0))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
        bits.alias("failed"),
    )
    named = labels.where(F.col(f"`{doc_id}`").isNotNull()).groupBy(F.col(f"`{doc_id}`").alias("doc_id"))
    marks = named.agg(
        F.max(F.coalesce(F.col(f"`{quality}`") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col(f"`{toxic}`") == 1, F.lit(False))).alias("toxic"),
    )
    marked = rows.join(marks, "doc_id", "left").na.fill(False, ["good", "toxic"])
    kind = ["digest", "part", "failed", "good", "toxic"]
    # First by id, which the join has brought together; a group of copies is then folded to one
    # row per kind before it is shuffled by its text.
    by_id = marked.groupBy("doc_id", *kind).agg(F.count(F.lit(1)).alias("n"))
    named_row = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    by_text = by_id.groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
        F.min(named_row).alias("first"),
    )
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    own = F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    split = by_text.withColumn("copies", F.col("n") - F.col("nameless") - F.coalesce(own, F.lit(0)))
    both = F.array(
        F.struct(F.col("failed"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct((F.col("failed") + 16).alias("failed"), F.col("copies").alias("n")),
    )
    cells = split.select("part", "good", "toxic", F.explode(both).alias("cell")).where("cell.n > 0")
    n = F.col("cell.n")
    return cells.groupBy("part", F.col("cell.failed").alias("failed")).agg(
        F.sum(n).alias("docs"),
        F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"),
    )


# -------------------------------------------------------------------- audit


def coalition_removals(cells: dict[int, int], filters: int) -> list[int]:
    """By coalition, what it removes: all but the documents that fail none of its filters."""
    passing = [0] * (1 << filters)
    everything = (1 << filters) - 1
    for failed, n in cells.items():
        passing[everything & ~failed] += n
    for i in range(filters):  # what fails only filters outside the coalition passes it
        for s in range(1 << filters):
            if not s >> i & 1:
                passing[s] += passing[s | 1 << i]
    return [passing[0] - p for p in passing]


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The solution of a regular system, by elimination in rationals."""
    n = len(right)
    rows = [[*map(Fraction, row), Fraction(r)] for row, r in zip(matrix, right, strict=True)]
    for i in range(n):
        pivot = next(k for k in range(i, n) if rows[k][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k in range(n):
            if k != i and rows[k][i]:
                rows[k] = [x - rows[k][i] * y for x, y in zip(rows[k], rows[i], strict=True)]
    return [row[n] for row in rows]


def shapley_values(removals: Sequence[int]) -> list[Fraction]:
    """The values by filter: kernel-weighted least squares over the coalitions, constrained to
    add up to what all remove."""
    filters = len(removals).bit_length() - 1
    normal = [[Fraction(0)] * (filters + 1) for _ in range(filters + 1)]
    right = [Fraction(0)] * (filters + 1)
    for s in range(1, len(removals) - 1):
        inside = [i for i in range(filters) if s >> i & 1]
        size = len(inside)
        weight = Fraction(filters - 1, comb(filters, size) * size * (filters - size))
        for i in inside:
            right[i] += weight * removals[s]
            for j in inside:
                normal[i][j] += weight
    for i in range(filters):
        normal[i][filters] = normal[filters][i] = Fraction(1)
    right[filters] = Fraction(removals[-1])
    return solve(normal, right)[:filters]


def audit_rows(part: str, cells: Sequence[dict], names: str) -> list[tuple]:
    """All steps of all orders of one part, from its cells."""
    removals = {
        c: coalition_removals({cell["failed"]: cell[c] for cell in cells}, len(names)) for c in _COUNTS
    }
    removed = removals["docs"]
    total = sum(cell["docs"] for cell in cells)
    everything = len(removed) - 1
    shares = [value * factorial(len(names)) for value in shapley_values(removed)]
    out = []
    for order in permutations(range(len(names))):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            here = removed[after] - removed[before]
            out.append(
                (
                    part,
                    "".join(names[i] for i in order),
                    step,
                    total - removed[after],
                    here,
                    removed[1 << f] - here,
                    removed[everything] - removed[everything & ~(1 << f)],
                    removals["good"][after] - removals["good"][before],
                    removals["toxic"][after] - removals["toxic"][before],
                    int(shares[f]),
                )
            )
            before = after
    return out


def audit(cells: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from (part, failed, docs, good, toxic).

    A part has at most 2^n cells, which one row gathers; no parts, no rows. ``shapley`` is the
    value times n!, the removals of the filter summed over all orders.
    """
    if not 1 <= len(names) <= MAX_FILTERS:
        raise ValueError(f"from 1 to {MAX_FILTERS} filters can be audited in all orders")
    schema = pa.schema(
        [(c.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[c.split()[1]])
         for c in _AUDIT.split(", ")]
    )
    run = _run(names, schema)
    gathered = cells.groupBy("part").agg(F.collect_list(F.struct("failed", *_COUNTS)).alias("cells"))
    return gathered.mapInArrow(run, _AUDIT)


def _run(names: str, schema: pa.Schema) -> Callable:
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                columns = zip(*audit_rows(row["part"], row["cells"], names), strict=True)
                arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def audit_filters(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """The audit of filters A to E over ``docs`` by part; see ``failure_cells`` and ``audit``.

    Extra columns of both tables are ignored, whatever their names; empty documents give no rows,
    empty labels count nothing as good or toxic.
    """
    return audit(failure_cells(docs, labels, doc_id, text, part))
