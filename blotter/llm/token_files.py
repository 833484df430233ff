"""Token-id files: canonical length-limited Huffman blocks in ascending document order.

A file set is a folder with two Parquet tables. ``codes`` has the code length of every id that
occurs (codes are canonical, so lengths are enough), from counts over all documents. ``blocks``
has rows of about ``BLOCK_TOKENS`` ids that decode on their own: part and block give the order,
``first`` the ids of the part before the block, ``doc_ids`` and ``n_tokens`` the documents of the
block, ``checkpoints`` the bit offset of every document's start and of every ``EVERY`` ids inside it,
``payload`` the codes. A document is never split; a very long one is a block of its own.

Documents are tokenised once and stored in the shared folder, counted, and dealt to parts by
ranges of the id; a part is one task and one file. There are as many parts as shuffle partitions
are set, within the bounds of ``LEAST_PART_TOKENS`` and ``MOST_PART_TOKENS`` ids for a part.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm import huffman
from blotter.llm.common import discard, file_bytes, only, stored
from blotter.llm.word_ids import word_ids

END_ID = 1
IDS = 1 << 16
EVERY = 512
BLOCK_TOKENS = 1 << 18
# A part is one task: at most this many ids, and no fewer than that for the sake of more tasks.
MOST_PART_TOKENS = 1 << 27
LEAST_PART_TOKENS = 1 << 20
_BLOCKS = (
    "part int, block int, first long, doc_ids array<long>, n_tokens array<long>, "
    "checkpoints array<long>, payload binary"
)


def tokenised(docs: DataFrame, vocabulary: str, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, ids): 16-bit little-endian ids with the end id; null texts count as empty."""
    sent = docs.sparkSession.sparkContext.broadcast(file_bytes(vocabulary))
    rows = only(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    end = END_ID.to_bytes(2, "little")

    def run(batches):
        encode = word_ids(sent.value).encode
        for batch in batches:
            ids = [encode(t or "") + end for t in batch.column(1).to_pylist()]
            n = pa.array([len(x) // 2 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n, pa.array(ids, pa.binary())], ["doc_id", "n", "ids"]
            )

    return rows.mapInArrow(run, "doc_id long, n long, ids binary")


def id_counts(tokens: DataFrame) -> np.ndarray:
    """Occurrences of every id in all documents; each task sends one row per id it met."""

    def count(batches):
        total = np.zeros(IDS, np.int64)
        for batch in batches:
            raw = b"".join(batch.column(0).to_pylist())
            total += np.bincount(np.frombuffer(raw, "<u2"), minlength=IDS)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(IDS, np.int64)
    for row in rows.collect():  # one row per id of the vocabulary
        counts[row["id"]] = row["n"]
    return counts


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Tokenise ``docs`` and write them below ``path``.

    Null texts count as empty (the end id alone); rows of one id stand next to each other in the
    order of their ids' bytes; rows without an id come first. No rows, no blocks.
    """
    spark = docs.sparkSession
    tokens = stored(tokenised(docs, vocabulary, doc_id, text), "tokens", "zstd")
    lengths = huffman.code_lengths(id_counts(tokens))
    used = np.flatnonzero(lengths)
    spark.createDataFrame(pa.table({"id": used.astype(np.int64), "bits": lengths[used].astype(np.int32)})).coalesce(
        1
    ).write.parquet(f"{path}/codes")
    total = tokens.agg(F.sum("n")).first()[0] or 0
    wished = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // LEAST_PART_TOKENS))
    parts = max(1, int(wished), int(-(-total // MOST_PART_TOKENS)))
    dealt = (
        tokens.select("doc_id", "ids")
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "ids")
        .withColumn("part", F.spark_partition_id())
    )
    sent = spark.sparkContext.broadcast(lengths)
    dealt.select("part", "doc_id", "ids").mapInArrow(_blocks(sent), _BLOCKS).write.option(
        "compression", "uncompressed"
    ).parquet(f"{path}/blocks")
    discard(tokens)


def _blocks(sent):
    def run(batches):
        lengths = sent.value
        codes = huffman.canonical_codes(lengths)
        first = number = 0
        docs: list[int | None] = []
        ids: list[bytes] = []
        held = 0

        def close(part: int) -> pa.RecordBatch:
            payload, marks, n = [], [], []
            bits = 0
            for raw in ids:
                found = np.frombuffer(raw, "<u2")
                packed, at = huffman.write_bits(found, codes, lengths, EVERY)
                marks.append(at + bits)
                bits += 8 * len(packed)
                payload.append(packed)
                n.append(len(found))
            columns = [[part], [number], [first], [docs], [n], [np.concatenate(marks)], [b"".join(payload)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary()]
            names = [c.split()[0] for c in _BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

        part = 0
        for batch in batches:
            for here, doc, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if docs and held + len(raw) // 2 > BLOCK_TOKENS:
                    yield close(part)
                    first, number, docs, ids, held = first + held, number + 1, [], [], 0
                part = here
                docs.append(doc)
                ids.append(raw)
                held += len(raw) // 2
        if docs:
            yield close(part)

    return run


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): one row per document with its little-endian 32-bit ids."""
    return _decoded(spark, path, "ids binary", lambda ids: ids.astype("<u4").tobytes(), pa.binary())


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the files, the ids as 32-bit little-endian."""
    return _decoded(spark, path, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4")), pa.int64())


def _decoded(spark: SparkSession, path: str, column: str, value, kind: pa.DataType) -> DataFrame:
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    lengths = np.zeros(IDS, np.uint8)
    for row in spark.read.parquet(f"{path}/codes").collect():  # one row per id of the vocabulary
        lengths[row["id"]] = row["bits"]
    sent = spark.sparkContext.broadcast(lengths)

    def run(batches):
        table = huffman.decode_table(sent.value)
        for batch in batches:
            for row in batch.to_pylist():
                yield _documents(row, table)

    def _documents(row: dict, table) -> pa.RecordBatch:
        n = np.array(row["n_tokens"], np.int64)
        runs = -(-n // EVERY)
        numbers = np.full(int(runs.sum()), EVERY, np.int64)
        ends = np.cumsum(runs)
        numbers[ends - 1] = n - EVERY * (runs - 1)
        payload = np.frombuffer(row["payload"], np.uint8)
        ids = huffman.read_bits(payload, np.array(row["checkpoints"], np.int64), numbers, table)
        stop = np.cumsum(n)
        start = stop - n
        values = [value(ids[a:b]) for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([row["part"]] * len(n), pa.int32()),
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(start + row["first"]),
                pa.array(n),
                pa.array(values, kind),
            ],
            ["part", "doc_id", "within", "n_tokens", column.split()[0]],
        )

    sizes = blocks.select("part", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    # One row per part from here.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        sizes.groupBy("part")
        .agg(F.sum("n").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    rows = blocks.mapInArrow(run, f"part int, doc_id long, within long, n_tokens long, {column}")
    return rows.join(base, "part").select(
        "doc_id", (F.col("within") + F.col("base")).alias("start"), "n_tokens", column.split()[0]
    )
