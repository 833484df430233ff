"""Packing of documents into sequences by vector best fit.

A document becomes pieces of at most ``max_tokens`` ids. A piece takes a vector of three
capacities of a sequence: tokens, documents (one) and attention cost (the square of its length).
Sizes are placed from the largest down; a piece goes to the open sequence where it fits under
every capacity and scores best: by the weighted norm of what would stay free (the smallest) or
by the weighted dot product of the piece with what is free (the largest).

All three demands follow from the length, so pieces of equal length are alike and the whole
corpus is described by at most ``max_tokens`` counts. The best fit runs on these counts: pieces
of one length and sequences with one vector of free capacities move in groups, which gives the
same packing as one piece at a time over all pieces, for any number of them. Its result is a
short table of runs: the pieces of length s with ranks r..r+n go to the sequences q..q+n at one
offset. Ranks come from counts per length and slice, then row numbers inside a slice, so no
length, however common, is ranked in one task.

Attention cost is kept in units of 1/4096 of the capacity (or of one part per token, if these are
more), rounded up per piece, so that a capacity is never exceeded and the free vectors stay few.
Documents and cost are part of the vector whenever they are given. As many documents as tokens and the square of the tokens fit whatever
the tokens allow, rounding included: they are scored, but never force a further sequence.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import fresh_name, file_bytes, only, stored
from blotter.llm.word_ids import word_ids

END_ID = 1
# The pieces of one length are ranked in slices of about so many.
SLICE_ROWS = 100_000
COST_UNITS = 4096
# Runs are broadcast up to this many (40 bytes each); beyond it they are joined by shuffle.
MAX_BROADCAST_RUNS = 200_000


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds; ``None`` documents or cost: any, and no part of the vector."""

    tokens: int = 4096
    documents: int | None = None
    cost: int | None = None
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    rule: str = "norm"

    def __post_init__(self) -> None:
        if self.tokens < 1 or self.rule not in ("norm", "dot"):
            raise ValueError("capacity needs tokens and the rule norm or dot")
        if self.cost is not None and self.cost < self.tokens**2:
            raise ValueError("a piece of all tokens must fit the cost")
        if self.documents is not None and self.documents < 1:
            raise ValueError("a sequence holds at least one document")

    def binds(self) -> tuple[bool, bool, bool]:
        return True, self.documents is not None, self.cost is not None

    @classmethod
    def of_tokens(cls, tokens: int) -> Capacity:
        """All three capacities, of which documents and cost allow whatever the tokens allow."""
        return cls(tokens, tokens, tokens**2)

    def units(self) -> int:
        return max(COST_UNITS, self.tokens)

    def full(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or 0, self.units()], np.int64) * self.binds()

    def demand(self, length: int) -> np.ndarray:
        cost = -(-length * length * self.units() // self.cost) if self.cost else 0
        return np.array([length, 1, cost], np.int64) * self.binds()


# ------------------------------------------------------------------- pieces


def document_pieces(
    docs: DataFrame, vocabulary: str, max_tokens: int = 4096, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), only documents longer than a sequence are cut."""
    sent = docs.sparkSession.sparkContext.broadcast(file_bytes(vocabulary))
    rows = only(docs, doc_id=doc_id, text=text)
    end = END_ID.to_bytes(2, "little")

    def cut(batches):
        encode = word_ids(sent.value).encode
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, content in enumerate(batch.column(1).to_pylist()):
                ids = np.frombuffer(encode(content or "") + end, "<u2").astype("<u4")
                for k, at in enumerate(range(0, len(ids), max_tokens)):
                    part = ids[at : at + max_tokens]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


# ------------------------------------------------------------------ packing


def best_fit(counts: dict[int, int], capacity: Capacity) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first_rank, number, first_sequence, offset) for counts by length.

    Ranks of a length and sequences count from 0. Ties in the score go to the sequence with the
    least tokens free, then documents, then cost.
    """
    full, weights = capacity.full(), np.array(capacity.weights, float)
    scale = np.maximum(full, 1)
    free = np.zeros((0, 3), np.int64)  # vectors of open sequences, each once
    held: list[list[list[int]]] = []  # per vector the sequences, as ranges
    slot: dict[tuple, int] = {}
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def score(states: np.ndarray, need: np.ndarray) -> np.ndarray:
        """Smaller is better."""
        if capacity.rule == "dot":
            return -((states / scale) * (need / scale) * weights).sum(1)
        return ((((states - need) / scale) ** 2) * weights).sum(1)

    def put(state: np.ndarray, first: int, number: int) -> None:
        nonlocal free
        key = tuple(state)
        if key not in slot:
            slot[key] = len(held)
            held.append([])
            free = np.concatenate([free, state[None]])
        held[slot[key]].append([first, number])

    for length in sorted(counts, reverse=True):
        need, rank, left = capacity.demand(length), 0, counts[length]
        while left:
            open_ = np.array([bool(h) for h in held], bool)
            fits = np.flatnonzero((free >= need).all(1) & open_) if len(held) else np.zeros(0, int)
            best, others = None, np.inf
            if len(fits):
                scores = score(free[fits], need)
                order = np.lexsort((free[fits, 2], free[fits, 1], free[fits, 0], scores))
                best = int(fits[order[0]])
                others = float(scores[order[0]])
            state = full if best is None else free[best]
            # How many pieces in a row one sequence takes before another one scores better.
            chain, after = 1, state - need
            while (after >= need).all() and chain < left:
                if best is not None and float(score(after[None], need)[0]) > others:
                    break
                if best is None and len(fits):
                    break
                chain, after = chain + 1, after - need
            if best is None:
                number, first = max(1, left // chain), sequences
                chain = min(chain, left)
                sequences += number
            else:
                ranges = held[best]
                first, available = ranges[-1]
                number = min(available, max(1, left // chain))
                if number == available:
                    ranges.pop()
                else:
                    ranges[-1] = [first + number, available - number]
            offset = capacity.tokens - int(state[0])
            for k in range(chain):
                runs.append((length, rank, number, first, offset + k * length))
                rank += number
            left -= number * chain
            if (after[0] > 0) and (after[1] > 0 or not capacity.binds()[1]):
                put(after, first, number)
    return runs


def pack(pieces: DataFrame, capacity: Capacity = Capacity()) -> DataFrame:
    """``pieces`` (with ``length``, at most the capacity) plus sequence_id and offset.

    Every row is a piece of its own, repeated or not; which of the pieces of one length goes where
    is fixed by the order of their columns inside a slice. An added name that clashes with one of
    the pieces gets underscores. Empty input gives an empty result; an empty or too long piece
    is refused.
    """
    own = [F.col(f"`{c}`") for c in pieces.columns]
    names = ("salt", "slice", "n", "base", "inside", "rank", "first", "number", "start", "place", "length")
    salt, part, n, base, inside, rank, first, number, start, place, long = (
        fresh_name(pieces.columns, f"_{name}") for name in names
    )
    kept = stored(pieces.withColumn(salt, F.xxhash64(F.monotonically_increasing_id(), *own)), "pieces")
    # At most as many rows as a sequence has tokens, whatever the corpus.
    counts = {r["length"]: r["count"] for r in kept.groupBy("length").count().collect()}
    if counts and (min(counts) < 1 or max(counts) > capacity.tokens):
        raise ValueError("a piece is empty or longer than a sequence")
    runs = best_fit(counts, capacity)
    spark = pieces.sparkSession
    columns = list(zip(*runs, strict=True)) or [()] * 5
    table = spark.createDataFrame(
        pa.table(
            {c: pa.array(v, pa.int64()) for c, v in zip((long, first, number, start, place), columns, strict=True)}
        )
    )
    if len(runs) <= MAX_BROADCAST_RUNS:
        table = F.broadcast(table)
    slices = -(-max(counts.values(), default=1) // SLICE_ROWS)
    sliced = kept.withColumn(part, F.pmod(salt, F.lit(slices)).cast("int"))
    per_slice = sliced.groupBy("length", part).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy("length").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = per_slice.select("length", part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(base))
    order = Window.partitionBy("length", part).orderBy(*own)
    ranked = sliced.withColumn(inside, F.row_number().over(order) - 1).join(bases, ["length", part])
    ranked = ranked.withColumn(rank, F.col(inside) + F.col(base))
    placed = ranked.join(table, F.col("length") == F.col(long)).where(
        (F.col(rank) >= F.col(first)) & (F.col(rank) < F.col(first) + F.col(number))
    )
    sequence = F.col(start) + F.col(rank) - F.col(first)
    return placed.select(
        *own,
        sequence.alias(fresh_name(pieces.columns, "sequence_id")),
        F.col(place).alias(fresh_name(pieces.columns, "offset")),
    )


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    capacity: Capacity = Capacity(),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts count as empty: one piece, the end id. Repeated rows and ids are documents of
    their own. Other columns are ignored; an empty table gives an empty result.
    """
    return pack(document_pieces(docs, vocabulary, capacity.tokens, doc_id, text), capacity)
