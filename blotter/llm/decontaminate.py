"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Words are the maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.
The test strings are all windows of ``window`` consecutive words of an item, or the whole item
when it is shorter. Strings of one length m form a searcher: the alphabet is words, a block is
the last two of them. The shift table tells for a block how far the search may move because no
string can end sooner (m - 1 words for a block in no string); a shift of zero leads to the
bucket of the strings that end in this block, which are compared word by word.

The benchmark is cut into pieces of bounded length and dealt into shards of bounded bytes. One
shard is broadcast and searched in one pass over the documents. Of several, each is searched in
a pass of its own that sends what it hits by the text's digest; these few rows are put together
and met with the documents. A task has the tables of one shard at a time.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import fresh_name, stored

WINDOW = 10
# Test strings broadcast at once, in bytes of text; more of them take more passes.
SHARD_BYTES = 4 << 20
PIECE_WORDS = 4096

_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 32
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Searcher:
    """Wu-Manber search for strings of exactly ``length`` words."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.skip = length - self.block + 1
        self.shift: dict = {}
        self.bucket: dict = {}

    def add(self, words: list[bytes], start: int, item) -> None:
        m, b = self.length, self.block
        for j in range(b - 1, m):
            key = words[start + j] if b == 1 else (words[start + j - 1], words[start + j])
            if self.shift.get(key, self.skip) > m - 1 - j:
                self.shift[key] = m - 1 - j
        self.bucket.setdefault(key, {}).setdefault(tuple(words[start : start + m]), set()).add(item)

    def hits(self, words: list[bytes]) -> Iterator[tuple[int, set]]:
        """(start, items) of every occurrence."""
        m, skip, shift, n = self.length, self.skip, self.shift.get, len(words)
        at = m - 1
        while at < n:
            key = words[at] if self.block == 1 else (words[at - 1], words[at])
            move = shift(key, skip)
            if not move:
                items = self.bucket[key].get(tuple(words[at - m + 1 : at + 1]))
                if items:
                    yield at - m + 1, items
                move = 1
            at += move


_built: dict[str, list[Searcher]] = {}


def searchers(key: str, pieces: list[tuple[str, str]], window: int) -> list[Searcher]:
    """The searchers of a shard, built once per Python worker; only the newest shard is kept."""
    if key not in _built:
        by_length: dict[int, Searcher] = {}
        for item, piece in pieces:
            words = piece.encode().split(b" ")
            m = min(window, len(words))
            found = by_length.setdefault(m, Searcher(m))
            for start in range(len(words) - m + 1):
                found.add(words, start, item)
        _built.clear()
        _built[key] = list(by_length.values())
    return _built[key]


def benchmark_pieces(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item, piece): space-joined words; pieces of one item overlap by ``window`` - 1 words."""

    def cut(batches):
        step = PIECE_WORDS - window + 1
        for batch in batches:
            items, pieces = [], []
            for item, body in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                words = words_of(body or b"")
                for start in range(0, max(1, len(words) - window + 1) if words else 0, step):
                    items.append(item)
                    pieces.append(b" ".join(words[start : start + PIECE_WORDS]).decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(pieces, pa.string())], ["item", "piece"]
            )

    rows = benchmark.select(
        F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{text}`").cast("binary").alias("body")
    )
    return rows.mapInArrow(cut, "item string, piece string").distinct()


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``docs`` with n_words, hit_spans (merged word ranges, end exclusive) and hit_items.

    Null or empty texts have no words and no hits; items without words match nothing; the windows
    of an item with a null id count as hits, but name no item. Repeated ids and rows are kept as
    they are. Columns of ``docs`` stay; an added name that clashes gets underscores. Items are
    listed as strings, sorted, each once.
    """
    pieces = stored(benchmark_pieces(benchmark, item_id, item_text, window), "windows")
    total = pieces.agg(F.sum(F.length("piece") + 24)).first()[0] or 0
    shards = -(-total // shard_bytes) or 1
    words, spans, items = (fresh_name(docs.columns, n) for n in ("n_words", "hit_spans", "hit_items"))
    none = F.array().cast("array<int>")
    found = docs.withColumns({words: F.lit(0).cast("long"), spans: none, items: F.array().cast("array<string>")})
    schema = found.schema
    at = {n: schema.names.index(n) for n in (text, words, spans, items)}
    spark = docs.sparkSession
    deal = F.pmod(F.xxhash64("item", "piece"), F.lit(shards))

    def sent(shard: int) -> Broadcast:
        # About shard_bytes, as pieces are dealt evenly and each has a bounded length.
        rows = [tuple(r) for r in pieces.where(deal == shard).collect()]
        return spark.sparkContext.broadcast(rows)

    if shards == 1:
        return found.mapInArrow(_scan(sent(0), window, at), schema)
    # Each shard is a branch of its own that sends the few texts it hits, so a task holds the
    # tables of one shard at a time, however many there are.
    bodies = docs.select(F.col(f"`{text}`").cast("binary").alias("body"))
    branches = [
        bodies.mapInArrow(_hit_texts(sent(i), window), "digest binary, spans array<int>, items array<string>")
        for i in range(shards)
    ]
    hits = stored(reduce(DataFrame.unionByName, branches).distinct(), "hits")
    by_text = hits.groupBy("digest").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    digest, got, named = (fresh_name(found.columns, n) for n in ("digest", "spans", "items"))
    told = by_text.mapInArrow(_joined, "digest binary, spans array<int>, items array<string>")
    told = told.toDF(digest, got, named)
    own = F.unhex(F.sha2(F.col(f"`{text}`").cast("binary"), 256))
    met = found.join(told, own == F.col(digest), "left").withColumns(
        {spans: F.coalesce(got, spans), items: F.coalesce(named, items)}
    )
    nothing = spark.sparkContext.broadcast([])
    return met.select(*[F.col(f"`{c}`") for c in schema.names]).mapInArrow(_scan(nothing, window, at), schema)


def _hit_texts(sent: Broadcast, window: int):
    """(digest, spans, items) of the texts that one shard hits."""
    key = uuid.uuid4().hex
    kinds = [pa.binary(), pa.list_(pa.int32()), pa.list_(pa.string())]

    def scan(batches):
        tests = searchers(key, sent.value, window)
        for batch in batches:
            found = []
            for content in batch.column(0).to_pylist():
                words = words_of(content) if content else []
                hits = [(s, s + t.length, i) for t in tests for s, i in t.hits(words)]
                if hits:
                    named = sorted({i for h in hits for i in h[2] if i is not None}, key=str.encode)
                    found.append((hashlib.sha256(content).digest(), merged([h[:2] for h in hits]), named))
            columns = list(zip(*found, strict=True)) or [()] * 3
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["digest", "spans", "items"])

    return scan


def _joined(batches):
    """The ranges that several shards have found in a text, put together."""
    for batch in batches:
        spans = [merged(list(zip(s[::2], s[1::2], strict=True))) for s in batch.column(1).to_pylist()]
        columns = [batch.column(0), pa.array(spans, pa.list_(pa.int32())), batch.column(2)]
        yield pa.RecordBatch.from_arrays(columns, ["digest", "spans", "items"])


def _scan(sent: Broadcast, window: int, at: dict[str, int]):
    body, *added = at.values()
    key = uuid.uuid4().hex

    def scan(batches):
        tests = searchers(key, sent.value, window)
        for batch in batches:
            n_words, all_spans, all_items = [], [], []
            texts = batch[body].cast(pa.binary()).to_pylist()
            before = zip(batch[added[1]].to_pylist(), batch[added[2]].to_pylist(), strict=True)
            for content, (spans, items) in zip(texts, before, strict=True):
                words = words_of(content) if content else []
                n_words.append(len(words))
                hits = [(s, s + t.length, i) for t in tests for s, i in t.hits(words)]
                if hits:
                    old = list(zip(spans[::2], spans[1::2], strict=True))
                    spans = merged(old + [h[:2] for h in hits])
                    named = {i for h in hits for i in h[2] if i is not None}
                    items = sorted(named.union(items), key=str.encode)
                all_spans.append(spans)
                all_items.append(items)
            columns = batch.columns
            columns[added[0]] = pa.array(n_words, pa.int64())
            columns[added[1]] = pa.array(all_spans, pa.list_(pa.int32()))
            columns[added[2]] = pa.array(all_items, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return scan


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """Sorted, joined ranges as a flat list start, end, start, end, .."""
    flat: list[int] = []
    for start, end in sorted(spans):
        if flat and start <= flat[-1]:
            flat[-1] = max(flat[-1], end)
        else:
            flat += [start, end]
    return flat


def hit_words(spans: Column) -> Column:
    """Number of words in flat ranges: the ends less the starts."""
    return F.aggregate(
        F.transform(spans, lambda v, i: F.when(i % 2 == 1, v).otherwise(-v)),
        F.lit(0).cast("long"),
        lambda total, v: total + v,
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without any benchmark window, with their own columns, whatever their names.

    Null and empty texts have no window and stay, as do all rows if the benchmark is empty;
    repeated rows and ids are judged each by its text; an empty table stays empty.
    """
    spans = fresh_name(docs.columns, "hit_spans")
    found = find_contamination(docs, benchmark, text)
    return found.where(F.size(spans) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
