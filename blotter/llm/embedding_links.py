"""Near-equal embeddings by collision counting on one-dimensional projections.

Vectors of one label link when their cosine reaches ``cosine``. Vectors are scaled to length
one, where that is a distance of at most sqrt(2 - 2 cosine) =: r, and projected on fixed random
directions; the projections of a linked pair differ by a normal amount of spread r at most. A
query's window on a projection reaches some spreads to both sides; a pair collides on a projection
when one lies in the other's window.

Candidates must collide on all *leads* of one of ``TABLES`` independent sets; what one set loses
another finds, and a pair found by several is counted by the first. The leads of a set:

- Dealt leads, more of them the more vectors a label has: their axes are cut into cells of one
  window's width, so a query's window meets two cells per lead. Each vector is a query in its own
  cell and visits those of the others that come after its own, so a pair across cells is met once
  and counts for both. A lead keeps about a third of the pairs of spread-out vectors, so the number
  of leads that brings a cell down to ``CELL_ROWS`` grows with the logarithm of the label.
- ``GRID`` leads cut in the same way inside a task, where meeting a cell is a look-up.
- One lead on which the vectors of a grid cell are sorted, so a window is a range of them.

The candidates' collisions on ``PROJECTIONS`` further directions are counted; a pair drops out as
soon as it cannot reach the count any more. The count is calibrated: the largest one that a pair
at distance r exactly still reaches with probability ``recall``. What passes is verified by
the cosine in double precision, so no pair below the bound ever links.

Projections are exact: vectors and directions are rounded to multiples of 2^-20 first, so that all
products and sums fit into a double and every task sees the same numbers.

Equal vectors are folded to one class first. Cells are dealt in pieces of at most ``CELL_ROWS``
rows, a crowded cell as many pieces that meet pairwise in different tasks. Tasks return link
counts per vector and a spanning forest of the links, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.blocks import spanning_roots
from blotter.llm.common import discard, only, stored
from blotter.llm.components import connected_components

COSINE = 0.98
RECALL = 0.9999
TABLES = 2
GRID = 2
PROJECTIONS = 16
SEED = 20_260
# Window half-widths in spreads of a pair at the bound: on leads, on counted projections.
LEAD_SPREADS, SPREADS = 3.0, 3.0
CELL_ROWS = 2048
# A vector visits up to 2^leads cells; beyond this many dealt leads cells fall into more pieces.
MOST_DEALT = 12
# Projections are multiples of the square of this.
STEP = 2.0**-20
# What a row is in its cell.
HOME, QUERY, VISITOR = 0, 1, 2
# Pairs looked at in one go.
SLAB_PAIRS = 1 << 20


def needed_collisions(projections: int = PROJECTIONS, recall: float = RECALL) -> int:
    """The largest count that a pair at the bound reaches with probability ``recall``."""
    p = math.erf(SPREADS / math.sqrt(2))
    tail, count = 0.0, projections
    while count > 0:
        tail += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if tail >= recall:
            break
        count -= 1
    return count


def directions(dim: int, n: int, block: int = 0) -> np.ndarray:
    """``n`` directions as columns, the same first ones for every ``n``; in multiples of STEP.

    Block 0 holds the counted projections, block 1 + t the leads of set t.
    """
    drawn = np.random.default_rng((SEED, block)).standard_normal((n, dim)).T
    return np.rint(drawn / STEP)


def projected(unit: np.ndarray, n: int, block: int = 0) -> np.ndarray:
    """Exact in double precision: integers below 2^53, whatever the order of the sums."""
    return (np.rint(unit / STEP) @ directions(unit.shape[1], n, block)) * STEP**2


def lead_share(spread: float) -> float:
    """Share of the pairs of spread-out vectors that collide on a lead."""
    return math.erf(LEAD_SPREADS * spread / 2)


def usable(embeddings: DataFrame) -> DataFrame:
    """Rows that can link: a label and a vector of finite numbers, not all zero."""
    element = F.col("embedding")
    finite = F.forall(
        element, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return embeddings.where(
        F.col("label").isNotNull() & element.isNotNull() & finite & F.exists(element, lambda x: x != 0)
    )


def link_vectors(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    recall: float = RECALL,
) -> DataFrame:
    """One row per row of ``embeddings``: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite numbers, and vectors without a
    label, link with nothing; so do vectors of different lengths. Repeated rows count as vectors
    of their own. Extra columns are ignored; an empty table gives an empty result.
    """
    rows = only(embeddings, vec_id=vec_id, embedding=embedding, label=label)
    if rows.schema["embedding"].dataType.elementType.typeName() != "float":
        rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    classes = stored(
        usable(rows)
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    found = stored(_neighbours(classes, cosine, recall), "vectors")
    edges = found.where(F.col("b").isNotNull()).select("a", "b")
    counts = found.where(F.col("a").isNotNull() & F.col("b").isNull()).groupBy("a").agg(F.sum("n").alias("near"))
    grouped = connected_components(edges)
    named = (
        classes.join(counts, classes["node"] == counts["a"], "left")
        .join(grouped, "node", "left")
        .select(
            "label",
            "embedding",
            "least",
            (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = stored(
        named.join(smallest, "component").select("label", "embedding", "n_links", "component_id"), "vectors"
    )
    discard(classes, found)
    component = F.coalesce("component_id", "vec_id")
    return rows.join(linked, ["label", "embedding"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )


def _dealt_leads(classes: DataFrame, spread: float) -> DataFrame:
    """The rows with the number of dealt leads that their label's size asks for."""
    share = lead_share(spread)
    if share > 0.5:  # windows that select little: pieces of whole labels meet instead
        return classes.withColumn("dealt", F.lit(0))
    sizes = classes.groupBy("label").agg(F.count(F.lit(1)).alias("vectors"))
    wanted = F.ceil(F.log(F.col("vectors") / CELL_ROWS) / -math.log(share))
    dealt = F.greatest(F.lit(0), F.least(F.lit(MOST_DEALT), wanted)).cast("int")
    return classes.join(sizes.select("label", dealt.alias("dealt")), "label")


def _neighbours(classes: DataFrame, cosine: float, recall: float) -> DataFrame:
    """(a, b, n): forest edges a, b; with b null, n vectors linked to class a; with both
    null, n candidate pairs whose collisions a task counted."""
    spread = math.sqrt(max(2 - 2 * cosine, 1e-12))
    half = LEAD_SPREADS * spread
    keys = "label string, cell binary, role int"

    def visit(batches, bare: bool):
        """Each vector in its own cell, and as a visitor in later cells its lead windows meet."""
        for batch in batches:
            lists = batch.column("embedding")
            dims = np.diff(lists.offsets.to_numpy())
            kinds = np.column_stack([dims, batch.column("dealt").to_numpy()])
            for dim, dealt in np.unique(kinds, axis=0):
                at = np.flatnonzero((kinds == (dim, dealt)).all(1))
                part = batch.take(pa.array(at))
                vectors = part.column("embedding").flatten().to_numpy().reshape(len(at), dim)
                unit = scaled(vectors)
                extra = {} if bare else {"node": part.column("node"), "copies": part.column("copies")}
                if not bare:
                    extra["raw"] = _rows(vectors)
                everyone = np.arange(len(at))
                for t in range(TABLES):
                    lead = projected(unit, dealt, 1 + t)
                    home = np.floor(lead / (2 * half)).astype(np.int64)
                    low = np.floor((lead - half) / (2 * half)).astype(np.int64)
                    own = _cells(home, t, dim)
                    yield _placed(part.column("label"), own, HOME, extra, everyone)
                    yield _placed(part.column("label"), own, QUERY, extra, everyone)
                    for corner in range(1 << int(dealt)):
                        other = low + (corner >> np.arange(dealt) & 1)
                        later = np.flatnonzero(_after(other, home))
                        yield _placed(part.column("label"), _cells(other, t, dim), VISITOR, extra, later)

    rows = _dealt_leads(classes, spread).select(
        F.col("label").cast("string").alias("label"), "node", "copies", "embedding", "dealt"
    )
    schema = f"{keys}, node long, copies long, raw binary"
    placed = rows.mapInArrow(lambda batches: visit(batches, False), schema)
    bare = rows.mapInArrow(lambda batches: visit(batches, True), keys)
    home = F.col("role") == HOME
    sizes = bare.groupBy("label", "cell").agg(
        F.count_if(home).alias("homes"), F.count_if(~home).alias("queries")
    )
    sizes = sizes.where("homes > 0").select(
        "label",
        "cell",
        F.ceil(F.col("homes") / CELL_ROWS).cast("int").alias("home_pieces"),
        F.ceil(F.col("queries") / CELL_ROWS).cast("int").alias("query_pieces"),
    )
    own = F.pmod(F.xxhash64("node"), F.when(home, F.col("home_pieces")).otherwise(F.col("query_pieces")))
    others = F.sequence(
        F.lit(0), F.when(home, F.col("query_pieces")).otherwise(F.col("home_pieces")) - 1
    )
    dealt = (
        placed.join(sizes, ["label", "cell"])
        .withColumn("own", own.cast("int"))
        .withColumn("other", F.explode(others))
        .select(
            "label",
            "cell",
            F.when(home, F.col("own")).otherwise(F.col("other")).alias("home_piece"),
            F.when(home, F.col("other")).otherwise(F.col("own")).alias("query_piece"),
            "role",
            "node",
            "copies",
            "raw",
        )
    )
    single = classes.schema["embedding"].dataType.elementType.typeName() == "float"
    need = needed_collisions(PROJECTIONS, recall)
    window = SPREADS * spread

    def compare(piece: pa.Table) -> pa.Table:
        role = piece.column("role").to_numpy()
        node, copies = piece.column("node").to_numpy(), piece.column("copies").to_numpy()
        unit = scaled(_matrix(piece.column("raw"), single))
        cell = np.frombuffer(piece.column("cell")[0].as_py(), "<i4")
        chosen, leads = int(cell[0]), len(cell) - 2 + GRID + 1
        sets = [projected(unit, leads, 1 + t) for t in range(chosen + 1)]
        counted = projected(unit, PROJECTIONS)
        homes, queries = np.flatnonzero(role == HOME), np.flatnonzero(role != HOME)
        near = np.zeros(len(node), np.int64)  # by row
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        looked = 0
        for a, b in met_pairs(sets[chosen], homes, queries, half):
            differ = node[a] != node[b]
            a, b = a[differ], b[differ]
            for earlier in sets[:chosen]:
                fresh = (np.abs(earlier[a] - earlier[b]) > half).any(1)
                a, b = a[fresh], b[fresh]
            looked += len(a)
            missed = np.zeros(len(a), np.int8)
            for i in range(PROJECTIONS):
                missed += np.abs(counted[a, i] - counted[b, i]) > window
                able = missed <= PROJECTIONS - need
                if not able.all():
                    a, b, missed = a[able], b[able], missed[able]
            for lo in range(0, len(a), 1 << 14):
                hi = lo + (1 << 14)
                linked = np.einsum("ij,ij->i", unit[a[lo:hi]], unit[b[lo:hi]]) >= cosine
                one, two = a[lo:hi][linked], b[lo:hi][linked]
                np.add.at(near, one, copies[two])
                visited = role[one] == VISITOR
                np.add.at(near, two[visited], copies[one[visited]])
                left.append(one)
                right.append(two)
            if len(left) > 16:
                left, right = _forest(node, left, right)
        left, right = _forest(node, left, right)
        some = np.flatnonzero(near)
        edges, none = len(left[0]), len(some) + 1
        return pa.table(
            {
                "a": pa.concat_arrays(
                    [pa.array(node[left[0]]), pa.array(node[some]), pa.nulls(1, pa.int64())]
                ),
                "b": pa.concat_arrays([pa.array(node[right[0]]), pa.nulls(none, pa.int64())]),
                "n": pa.concat_arrays(
                    [pa.nulls(edges, pa.int64()), pa.array(near[some]), pa.array([looked], pa.int64())]
                ),
            }
        )

    return dealt.groupBy("label", "cell", "home_piece", "query_piece").applyInArrow(
        compare, "a long, b long, n long"
    )


def met_pairs(lead: np.ndarray, homes: np.ndarray, queries: np.ndarray, half: float):
    """Pairs (query, home) of rows that collide on every column of ``lead``, each once, in slabs.

    Two columns make a grid of window-wide cells, the last one orders the homes of a grid cell.
    """
    grid, last = lead[:, -1 - GRID : -1], lead[:, -1]
    reach = np.abs(last).max(initial=0.0) + 2 * half + 1
    own = np.floor(grid[homes] / (2 * half)).astype(np.int64)
    codes, rank = np.unique(own @ _RADIX, return_inverse=True)
    if not len(codes):
        return
    # One number for grid cell and place on the last lead; ranges are a little too wide
    # and the exact windows follow.
    key = rank * (2 * reach) + last[homes]
    order = np.argsort(key)
    homes, key = homes[order], key[order]
    low = np.floor((grid[queries] - half) / (2 * half)).astype(np.int64)
    for corner in range(1 << GRID):
        code = (low + (corner >> np.arange(GRID) & 1)) @ _RADIX
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        there = np.flatnonzero(codes[at] == code)
        asked, centre = queries[there], at[there] * (2 * reach) + last[queries[there]]
        slack = half * (1 + 1e-6)
        start = np.searchsorted(key, centre - slack, "left")
        stop = np.searchsorted(key, centre + slack, "right")
        for first, end in _slabs(stop - start):
            width = (stop - start)[first:end]
            a = np.repeat(asked[first:end], width)
            skipped = np.repeat(np.cumsum(width) - width - start[first:end], width)
            b = homes[np.arange(len(a)) - skipped]
            for i in range(lead.shape[1]):
                met = np.abs(lead[a, i] - lead[b, i]) <= half
                a, b = a[met], b[met]
            yield a, b


# Places of the grid's cells in one number; |projection| / (2 half) is far below 2^30.
_RADIX = np.array([1 << 31, 1], np.int64)


def _cells(index: np.ndarray, chosen: int, dim: int) -> pa.Array:
    """The set, the dimension and the cells of its leads as bytes."""
    packed = np.empty((len(index), 2 + index.shape[1]), "<i4")
    packed[:, 0], packed[:, 1], packed[:, 2:] = chosen, dim, index
    return _rows(packed)


def _after(other: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which cells come after a row's own, lead by lead."""
    later, same = np.zeros(len(own), bool), np.ones(len(own), bool)
    for i in range(own.shape[1]):
        later |= same & (other[:, i] > own[:, i])
        same &= other[:, i] == own[:, i]
    return later


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one in double precision, whatever their size."""
    unit = vectors.astype(np.float64)
    unit /= np.abs(unit).max(1, keepdims=True)
    return unit / np.sqrt((unit * unit).sum(1, keepdims=True))


def _rows(matrix: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(matrix)
    offsets = np.arange(len(raw) + 1, dtype=np.int32) * (raw.shape[1] * raw.itemsize)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(raw), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)]
    )


def _matrix(column: pa.ChunkedArray, single: bool) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "f4" if single else "f8").reshape(len(rows), -1)


def _placed(
    label: pa.Array, cell: pa.Array, role: int, extra: dict, some: np.ndarray
) -> pa.RecordBatch:
    """The chosen vectors in the given role."""
    flag = pa.array(np.full(len(label), role, np.int32))
    rows = pa.RecordBatch.from_arrays(
        [label, cell, flag, *extra.values()], ["label", "cell", "role", *extra]
    )
    return rows.take(pa.array(some))


def _slabs(widths: np.ndarray):
    """Ranges of queries with at most about SLAB_PAIRS pairs each."""
    ends = np.cumsum(widths)
    first, done = 0, 0
    while first < len(widths):
        last = max(first + 1, int(np.searchsorted(ends, done + SLAB_PAIRS, "right")))
        yield first, last
        first, done = last, int(ends[last - 1])


def _forest(node: np.ndarray, left: list, right: list) -> tuple[list, list]:
    """The links so far as one list of tree edges; rows of one node are tied together."""
    a, b = np.concatenate(left), np.concatenate(right)
    if not len(a):
        return [a], [b]
    _, first, same = np.unique(node, return_index=True, return_inverse=True)
    root = spanning_roots(len(first), same[a], same[b])
    linked = np.flatnonzero(root != np.arange(len(first)))
    return [first[linked]], [first[root[linked]]]
