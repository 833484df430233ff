"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints have 64 bits and link at ``threshold`` or fewer differing bits. The bits are grouped
into partitions, correlated bits together; partition i gets its own threshold t_i >= -1 (-1: not
used), and as long as the t_i add up to threshold - partitions + 1 every linked pair differs in
some partition i by at most t_i bits. The t_i come from a dynamic programme over what each
partition would cost at each threshold: rows moved and pairs compared, from the counts of its
values over all fingerprints.

Documents are folded to distinct fingerprints first, so exact copies are one node. A fingerprint
is put into one bucket for each used partition, and probes further buckets up to t_i flipped bits
away where the counts say that one is met. A bucket of more than ``BUCKET_ROWS`` rows is never
compared as it is: the principle is applied to it again, with the bits that differ inside it dealt
to threshold + 1 masks, as two linked fingerprints agree on one of them. Each round fixes a share of the
bits that still differ, and distinct fingerprints that agree on all but ten bits fit into a
bucket, so the rounds end. Tasks keep pairs that pass the exact check and emit a spanning forest of
them, never all pairs.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.blocks import spanning_roots
from blotter.llm.common import discard, fresh_name, only, stored
from blotter.llm.components import connected_components

BITS = 64
SEED = 42
SHINGLE = 3
THRESHOLD = 3
PARTITIONS = 4
# Rows of a bucket that one task compares pair by pair; at least 2^10.
BUCKET_ROWS = 4096
# What moving a row through a shuffle costs, in comparisons of a pair.
ROW_COST = 200.0
# Rows a task gathers before it compares.
SLAB_ROWS = 200_000

_SPACE = bytes(b + 32 if 0x41 <= b <= 0x5A else 32 if 9 <= b <= 13 else b for b in range(256))


# ------------------------------------------------------------- fingerprints


def fingerprint(text: bytes) -> int:
    """64-bit SimHash over the 3-word shingles of a text, repeats included; no words: 0."""
    # Only blanks part words: bytes.split() would also part at others, which cannot be here.
    words = [w for w in text.translate(_SPACE).split(b" ") if w]
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], "<u8")
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 4096):
        slab = hashes[start : start + 4096].view(np.uint8)
        ones += np.unpackbits(slab, bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, mark, fp): the fingerprint and a 64-bit hash of the text, as signed longs."""
    rows = only(docs, doc_id=doc_id, body=text).withColumn("body", F.col("body").cast("binary"))
    rows = rows.select("doc_id", F.xxhash64("body").alias("mark"), "body")

    def run(batches):
        for batch in batches:
            found = [fingerprint(t) if t else 0 for t in batch.column(2).to_pylist()]
            fps = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], fps], ["doc_id", "mark", "fp"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, mark long, fp long")


# --------------------------------------------------------------- partitions


def bit_correlations(fps: DataFrame) -> np.ndarray:
    """64 x 64 correlations of the bits over all fingerprints, from sums added up per task."""

    def sums(batches):
        total = np.zeros((BITS + 1, BITS))
        for batch in batches:
            raw = batch.column(0).to_numpy().astype("<i8").view(np.uint8)
            bits = np.unpackbits(raw, bitorder="little").reshape(-1, BITS).astype(np.float64)
            total[:BITS] += bits.T @ bits
            total[BITS] += len(bits)
        at = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], ["at", "n"])

    added = fps.mapInArrow(sums, "at long, n double").groupBy("at").agg(F.sum("n").alias("n"))
    total = np.zeros((BITS + 1) * BITS)
    for row in added.collect():  # 65 x 64 sums, whatever the input
        total[row["at"]] = row["n"]
    total = total.reshape(BITS + 1, BITS)
    n = max(total[BITS, 0], 1.0)
    mean = np.diag(total[:BITS]) / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return (total[:BITS] / n - np.outer(mean, mean)) / np.outer(spread, spread)


def group_bits(correlation: np.ndarray, partitions: int = PARTITIONS) -> list[list[int]]:
    """Bits grouped greedily: a group starts at the strongest free pair and takes the free bit
    most correlated with it until it is full."""
    strength = np.abs(correlation) - 2 * np.eye(BITS)
    free, groups = set(range(BITS)), []
    for i in range(partitions):
        size = len(free) // (partitions - i)
        order = sorted(free)
        part = strength[np.ix_(order, order)]
        first, second = np.unravel_index(int(part.argmax()), part.shape)
        group = [order[first], order[second]][:size]
        while len(group) < size:
            rest = sorted(free.difference(group))
            group.append(rest[int(strength[np.ix_(rest, group)].sum(1).argmax())])
        free.difference_update(group)
        groups.append(sorted(group))
    return groups


def gathered(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """The values of the given bits of unsigned fingerprints."""
    value = np.zeros(len(fp), np.int64)
    for place, bit in enumerate(bits):
        value |= ((fp >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << place
    return value


def flips(width: int, most: int) -> list[int]:
    """Masks with up to ``most`` of ``width`` bits, none first."""
    return [sum(1 << b for b in c) for k in range(most + 1) for c in combinations(range(width), k)]


def value_counts(fps: DataFrame, groups: list[list[int]]) -> list[np.ndarray]:
    """How often every value of every partition occurs over all fingerprints.

    Tasks send the counts of the values they met, which are summed by value; at most
    2^width numbers a partition (4 times 65,536) reach the driver, whatever the input.
    """
    base = np.concatenate([[0], np.cumsum([1 << len(g) for g in groups])])

    def count(batches):
        total = np.zeros(base[-1], np.int64)
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for first, bits in zip(base, groups, strict=False):
                total[first : first + (1 << len(bits))] += np.bincount(
                    gathered(fp, bits), minlength=1 << len(bits)
                )
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["at", "n"])

    added = fps.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(base[-1], np.int64)
    total[added["at"].to_numpy()] = added["n"].to_numpy()
    return np.split(total, base[1:-1])


def costs(counts: list[np.ndarray], most: int) -> np.ndarray:
    """Cost by partition and threshold 0..most: rows that meet another and pairs compared.

    A pair is counted in bucket and probe order; of a bucket that is split again a row is
    compared with some ``BUCKET_ROWS`` others.
    """
    found = np.zeros((len(counts), most + 1))
    for i, count in enumerate(counts):
        values = np.flatnonzero(count)
        n, at = count[values], [0.0] * (most + 1)
        for mask in flips(int(len(count)).bit_length() - 1, most):
            met = count[values ^ mask]
            rows = n @ (met > 0) if mask else n @ (n > 1)
            at[mask.bit_count()] += ROW_COST * float(rows) + float(n @ np.minimum(met, BUCKET_ROWS))
        found[i] = np.cumsum(at)
    return found


def allocate(counts: np.ndarray, threshold: int) -> list[int]:
    """Thresholds per partition, -1 upwards, with the required sum and the least cost."""
    parts, most = counts.shape[0], counts.shape[1] - 1
    need = threshold - parts + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for i in range(parts):
        grown: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, chosen) in best.items():
            for t in range(-1, most + 1):
                found = (cost + (counts[i, t] if t >= 0 else 0.0), [*chosen, t])
                if total + t not in grown or found < grown[total + t]:
                    grown[total + t] = found
        best = grown
    return best[need][1]


# -------------------------------------------------------------------- links


def link_fingerprints(fps: DataFrame, threshold: int = THRESHOLD, partitions: int = PARTITIONS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that join whatever is linked; a column ``fp``.

    Any data give exact results; a null fingerprint is not allowed, an empty table has no edges.
    """
    dealt, kept = deal_buckets(fps, threshold, partitions)
    near = dealt.repartition("bucket").sortWithinPartitions("bucket")
    edges = stored(near.mapInArrow(_compare(threshold), "a long, b long"), "simhash")
    discard(*kept)
    return edges


def deal_buckets(fps: DataFrame, threshold: int, partitions: int = PARTITIONS) -> tuple[DataFrame, list[DataFrame]]:
    """Rows (bucket, fp) in buckets of at most ``BUCKET_ROWS``; two linked fingerprints share one.

    Also the stored frames that the rows come from, to be discarded after use.
    """
    groups = group_bits(bit_correlations(fps), partitions)
    counts = value_counts(fps, groups)
    # Up to one flipped bit is offered to the programme; more would cost more probes than pairs.
    thresholds = allocate(costs(counts, most=1), threshold)
    coming = [_coming(c, t) for c, t in zip(counts, thresholds, strict=True)]
    sent = fps.sparkSession.sparkContext.broadcast((counts, coming))
    ready = [fps.mapInArrow(_place(groups, thresholds, sent, large=False), "bucket long, fp long")]
    kept = []
    if any((c > BUCKET_ROWS).any() for c in coming):
        large = stored(
            fps.mapInArrow(_place(groups, thresholds, sent, large=True), "bucket long, fp long"), "buckets"
        )
        while not large.isEmpty():
            split = stored(_split(large, threshold), "buckets")
            sizes = split.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            met = split.join(sizes, "bucket")
            ready.append(met.where(F.col("n") <= BUCKET_ROWS).select("bucket", "fp"))
            discard(large)
            large = stored(met.where(F.col("n") > BUCKET_ROWS).select("bucket", "fp"), "buckets")
            kept.append(split)
        kept.append(large)
    # Two buckets of one number are compared as one, which the exact check makes harmless.
    return reduce(DataFrame.unionByName, ready), kept


def _coming(count: np.ndarray, threshold: int) -> np.ndarray:
    """Rows and probes that come to every bucket; none to one that is at home to nobody."""
    total = np.zeros_like(count)
    if threshold >= 0:
        values = np.arange(len(count))
        for mask in flips(int(len(count)).bit_length() - 1, threshold):
            total += count[values ^ mask]
    total[count == 0] = 0
    return total


def _place(groups: list[list[int]], thresholds: list[int], sent, large: bool):
    """Rows and probes of the buckets where something is met, either the large ones or the rest."""

    def run(batches):
        counts, coming = sent.value
        wanted = [(c > BUCKET_ROWS) if large else (c > 1) & (c <= BUCKET_ROWS) for c in coming]
        base = np.concatenate([[0], np.cumsum([len(c) for c in counts])])
        for batch in batches:
            signed = batch.column(0).to_numpy()
            buckets, rows = [], []
            for i, threshold in enumerate(thresholds):
                if threshold < 0:
                    continue
                value = gathered(signed.view(np.uint64), groups[i])
                for mask in flips(len(groups[i]), threshold):
                    there = value ^ mask
                    met = wanted[i][there]
                    buckets.append(there[met] + base[i])
                    rows.append(signed[met])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(buckets)), pa.array(np.concatenate(rows))], ["bucket", "fp"]
            )

    return run


def _split(large: DataFrame, threshold: int) -> DataFrame:
    """Large buckets split again: every row once for each of threshold + 1 masks of its bucket.

    The bits are dealt by how evenly they divide the bucket, the most dividing one to the first
    mask, the next to the second and so on; bits that are the same in all rows change nothing.
    """
    ones = [
        F.sum(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1).cast("long"))).alias(f"b{b}") for b in range(BITS)
    ]
    stats = large.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *ones)
    names = [f"m{j}" for j in range(threshold + 1)]

    def masks(batches):
        for batch in batches:
            n = batch.column(1).to_numpy()[:, None].astype(np.float64)
            set_ = np.stack([c.to_numpy() for c in batch.columns[2:]], axis=1)
            order = np.argsort(-(set_ * (n - set_)), axis=1, kind="stable").astype(np.uint64)
            dealt = [
                np.bitwise_or.reduce(np.uint64(1) << order[:, j :: len(names)], axis=1).view(np.int64)
                for j in range(len(names))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, dealt)], ["bucket", *names])

    dealt = stats.mapInArrow(masks, "bucket long, " + ", ".join(f"{m} long" for m in names))
    parts = F.array(
        *[F.xxhash64("bucket", F.lit(j), F.col("fp").bitwiseAND(F.col(m))) for j, m in enumerate(names)]
    )
    return large.join(dealt, "bucket").select(F.explode(parts).alias("bucket"), "fp")


def _compare(threshold: int):
    def close(bucket: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        n = len(fp)
        left, right = [], []
        alive = np.arange(n - 1)
        shift = 1
        while len(alive):
            alive = alive[alive + shift < n]
            alive = alive[bucket[alive] == bucket[alive + shift]]
            apart = np.bitwise_count(fp[alive] ^ fp[alive + shift])
            found = alive[(apart <= threshold) & (apart > 0)]
            if len(found):
                left.append(found)
                right.append(found + shift)
            shift += 1
            if len(left) > 64:  # fold what is linked so far into a forest
                left, right = _forest(n, left, right)
        left, right = _forest(n, left, right)
        signed = fp.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[left[0]]), pa.array(signed[right[0]])], ["a", "b"])

    def run(batches):
        buckets, fps, held = [], [], 0
        for batch in batches:
            buckets.append(batch.column(0).to_numpy())
            fps.append(batch.column(1).to_numpy().view(np.uint64))
            held += batch.num_rows
            if held >= SLAB_ROWS:
                bucket, fp = np.concatenate(buckets), np.concatenate(fps)
                cut = int(np.searchsorted(bucket, bucket[-1]))
                if cut:
                    yield close(bucket[:cut], fp[:cut])
                buckets, fps, held = [bucket[cut:]], [fp[cut:]], len(bucket) - cut
        if held:
            yield close(np.concatenate(buckets), np.concatenate(fps))

    return run


def _forest(n: int, left: list[np.ndarray], right: list[np.ndarray]) -> tuple[list, list]:
    none = np.zeros(0, np.int64)
    a, b = np.concatenate([none, *left]), np.concatenate([none, *right])
    root = spanning_roots(n, a, b)
    linked = np.flatnonzero(root != np.arange(n))
    return [linked], [root[linked]]


def _classes(marked: DataFrame, threshold: int) -> DataFrame:
    """(fp, component, least): the component of every fingerprint, stored, and the smallest
    (doc_id, mark) of its rows that have an id."""
    row = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "mark"))
    nodes = stored(marked.groupBy("fp").agg(F.min(row).alias("least")).repartition(F.col("fp")), "simhash")
    edges = link_fingerprints(nodes.select("fp"), threshold)
    grouped = connected_components(edges)
    classes = stored(
        nodes.join(grouped.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", F.coalesce("component", "fp").alias("component"), "least"
        ),
        "simhash",
    )
    discard(edges, nodes)
    return classes


def simhash_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    The component is the smallest doc_id reachable by links. Null and empty texts and texts of
    white space have fingerprint zero and link like any other. Repeated rows stay repeated; a
    null doc_id is kept but names no component unless all ids of it are null. Other columns are
    ignored; an empty table gives an empty result.
    """
    marked = stored(fingerprints(docs, doc_id, text), "simhash")
    classes = _classes(marked, threshold)
    smallest = classes.groupBy("component").agg(F.min("least.doc_id").alias("component_id"))
    named = stored(classes.join(smallest, "component").select("fp", "component_id"), "simhash")
    discard(classes)
    return marked.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Of every group the row with the smallest id, with its own columns.

    If one id stands for several texts of a group, the text with the smallest hash stays; of
    repeated rows (same id, same text) one stays. Rows without an id are all kept. Null and empty
    texts are texts like any other. Extra columns pass, whatever their names; an empty table
    stays empty. Texts are not moved to look for repeated rows: only rows whose (id, text)
    repeats are ranked.
    """
    head, mark, again = (fresh_name(docs.columns, n) for n in ("head", "mark", "again"))
    marked = stored(fingerprints(docs, doc_id, text), "simhash")
    classes = _classes(marked, THRESHOLD)
    least = F.min("least").alias("least")
    firsts = classes.groupBy("component").agg(least).where("least IS NOT NULL").select("least.*")
    repeats = marked.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    renamed = [F.col("doc_id").alias(head), F.col("mark").alias(mark)]
    # What goes is mostly far less than what stays, so it is the list that the texts are met with.
    named = marked.where(F.col("doc_id").isNotNull()).select("doc_id", "mark")
    dropped = stored(named.join(firsts, ["doc_id", "mark"], "left_anti").select(*renamed), "simhash")
    several = stored(firsts.join(repeats, ["doc_id", "mark"], "left_semi").select(*renamed), "simhash")
    discard(classes, marked)
    own = [F.col(f"`{c}`") for c in docs.columns]
    body = F.xxhash64(F.col(f"`{text}`").cast("binary"))
    same = (F.col(f"`{doc_id}`") == F.col(head)) & (body == F.col(mark))
    if several.isEmpty():
        return docs.join(dropped, same, "left_anti")
    order = Window.partitionBy(head, mark).orderBy(F.monotonically_increasing_id())
    ranked = docs.join(several, same).withColumn(again, F.row_number().over(order))
    others = docs.join(dropped.unionByName(several), same, "left_anti")
    return others.unionByName(ranked.where(F.col(again) == 1).select(*own))
