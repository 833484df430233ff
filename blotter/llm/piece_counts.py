"""Token counts of a byte-fallback piece vocabulary, by the whole-token shortcut.

The vocabulary is examined once per Python worker, before any text: no piece has a space mark
behind another character, so tokens never reach over the start of a space run, and none holds a
line feed, so line feeds stand alone. A text therefore falls into pre-tokens at spaces and line
feeds whose counts add up. The proof also lists the pieces that, given alone, come out as one
token; pre-tokens equal to one count 1 without any merging. Only the rest goes to the tokenizer,
and its counts are kept in a table of bounded size. A vocabulary for which the proof fails is
refused. One pass, no shuffle.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import file_bytes, fresh_name

SPACE = "▁"
# Pre-tokens remembered per Python worker beside the whole tokens.
KNOWN_PRETOKENS = 400_000


class PretokenCounts(dict):
    """Counts by pre-token: ``x`` stands for one space mark and x; ``\\nx`` has no space mark."""

    def __init__(self, model: bytes):
        self.tokenizer = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.whole = prove_whole_tokens(self.tokenizer)
        super().__init__(self.whole)

    def __missing__(self, pretoken: str) -> int:
        n = len(self.tokenizer.encode(pretoken, num_threads=1))
        if pretoken[:1] == "\n":
            n -= 1  # the tokenizer put a space mark before it
        if len(self) >= KNOWN_PRETOKENS + len(self.whole):
            self.clear()
            self.update(self.whole)
        self[pretoken] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        parts = text.replace(SPACE, " ").replace("\n", " \n").split(" ")
        if "" in parts:
            parts = joined_spaces(parts)
        return sum(map(self.__getitem__, parts))


def joined_spaces(parts: list[str]) -> list[str]:
    """Empty parts are further spaces of the run before the next part; a run before a line feed
    or the end is a pre-token of its own. n spaces are written as n - 1, the first being implied."""
    out, run = [], 0
    for part in parts:
        if not part:
            run += 1
        elif part[0] == "\n":
            if run:
                out.append(" " * (run - 1))
            out.append(part)
            run = 0
        else:
            out.append(" " * run + part)
            run = 0
    if run:
        out.append(" " * (run - 1))
    return out


def prove_whole_tokens(tokenizer: sentencepiece.SentencePieceProcessor) -> dict[str, int]:
    """Pre-tokens that are one token, after checking that pre-tokens are independent."""
    ids = [i for i in range(tokenizer.get_piece_size()) if not tokenizer.is_control(i)]
    pieces = [tokenizer.id_to_piece(i) for i in ids if not (tokenizer.is_byte(i) or tokenizer.is_unknown(i))]
    for piece in pieces:
        if SPACE in piece.lstrip(SPACE) or "\n" in piece:
            raise ValueError(f"piece {piece!r} reaches over a space or a line feed")
    for probe, spelled in (("\n", 2), ("a \nb", 5), (" a", 2)):
        marks = tokenizer.encode(probe, out_type=str, num_threads=1)
        if "".join(marks).replace("<0x0A>", "\n") != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the model changes its text before encoding")
        if len(marks) > spelled:
            raise ValueError("the model has no byte pieces")
    # An unmarked empty pre-token is one space mark alone, which the library drops as no text.
    whole = {"": 1}
    alone = [p[1:] for p in pieces if p[:1] == SPACE and len(p) > 1 and p[1] != SPACE]
    for word, found in zip(alone, tokenizer.encode(alone, num_threads=1), strict=True):
        if len(found) == 1:
            whole[word] = 1
    return whole


_counts: dict[int, PretokenCounts] = {}


def pretoken_counts(model: bytes) -> PretokenCounts:
    key = zlib.crc32(model)
    if key not in _counts:
        _counts[key] = PretokenCounts(model)
    return _counts[key]


def count_tokens(
    docs: DataFrame, model_path: str, limit: int = 4096, text: str = "text"
) -> DataFrame:
    """``docs`` without the text column's copy, plus n_bytes, n_tokens and over_limit.

    Counts are those of the library for whole texts, without begin and end tokens. Null counts as
    empty: no bytes, no tokens. Rows, repeated or not, stay as they are; the other columns stay,
    and an added name that clashes gets underscores.
    """
    n_bytes, n_tokens, over = (
        fresh_name(docs.columns, n) for n in ("n_bytes", "n_tokens", "over_limit")
    )
    sent = docs.sparkSession.sparkContext.broadcast(file_bytes(model_path))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(*kept, F.col(f"`{text}`"), F.lit(0).cast("long").alias(n_tokens))

    def count(batches):
        counts = pretoken_counts(sent.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 2).to_pylist()
            found = pa.array([counts.count(t or "") for t in texts], pa.int64())
            sizes = pa.compute.binary_length(batch.column(batch.num_columns - 2))
            sizes = pa.compute.fill_null(sizes.cast(pa.int64()), 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], sizes, found], [*batch.schema.names[:-2], n_bytes, n_tokens]
            )

    schema = rows.drop(text, n_tokens).withColumns(
        {n_bytes: F.lit(0).cast("long"), n_tokens: F.lit(0).cast("long")}
    ).schema
    return rows.mapInArrow(count, schema).withColumn(over, F.col(n_tokens) > limit)
