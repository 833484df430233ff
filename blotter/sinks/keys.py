"""Keys of batch folders, and folding many of them into one.

"<stream>-<batch>" holds one batch, "<stream>-L<level>-<block>" a folded block of them, and
"<stream>-<batch>p" what a compaction during this batch has packed.
"""

from __future__ import annotations

from collections.abc import Callable, Container, Sequence

from pyspark.sql import SparkSession

from blotter.schema import BATCH_KEY
from blotter.session import folder_age, remove_folder, subfolders

# So many folders of one level are folded into one of the next.
FOLD = 32
LEVELS = 6


def batch_key(stream_id: str, batch_id: int) -> str:
    return f"{stream_id}-{batch_id:012d}"


def pack_key(stream_id: str, number: int) -> str:
    return f"{batch_key(stream_id, number)}p"


def is_pack(key: str) -> bool:
    return key.endswith("p")


def block_key(stream_id: str, level: int, block: int) -> str:
    return batch_key(stream_id, block) if level == 0 else f"{stream_id}-L{level}-{block:012d}"


def parsed_key(key: str) -> tuple[str, int, int]:
    """Stream, level and block of a folder key."""
    stream, _, block = key.removesuffix("p").rpartition("-")
    head, _, level = stream.rpartition("-L")
    if head and level.isdigit():
        return head, int(level), int(block)
    return stream, 0, int(block)


def valid_keys(keys: Sequence[str], fold: int) -> list[str]:
    """The keys that together hold every batch once: none that lies in a stored larger block."""
    blocks = {parsed_key(k) for k in keys}
    return [k for k in keys if not _larger(parsed_key(k), blocks, fold)]


def _larger(parsed: tuple[str, int, int], known: Container, fold: int) -> list[tuple[str, int, int]]:
    """The known blocks that a smaller one lies in."""
    stream, level, block = parsed
    ups = ((stream, up, block // fold ** (up - level)) for up in range(level + 1, LEVELS + 1))
    return [up for up in ups if up in known]


def stored_keys(spark: SparkSession, path: str) -> list[str]:
    """The batch keys of the folders right below a path."""
    return [n.partition("=")[2] for n in subfolders(spark, path) if n.startswith(f"{BATCH_KEY}=")]


def fold_folders(
    spark: SparkSession,
    path: str,
    stream_id: str,
    batch_id: int,
    fold: int,
    write: Callable[[list[str], str], None],
    grace_seconds: float = 0,
) -> None:
    """Fold the blocks below ``path`` that ended before this batch, and drop what lies in one.

    Batches before this one are committed and never rerun, so a block is folded when the next
    one begins. ``write`` puts the rows of some keys under a new one; its folder replaces the
    smaller ones by its mere presence. They are deleted once it is older than the grace time, so
    that who has listed them can still read them; after a failure the next batch deletes them.
    """
    found = stored_keys(spark, path)
    for level in range(1, LEVELS + 1):
        size = fold**level
        held = {parsed_key(k) for k in found}
        ended: dict[int, list[str]] = {}
        for key in found:
            stream, at, block = parsed_key(key)
            if stream == stream_id and at == level - 1 and (block // fold + 1) * size <= batch_id:
                ended.setdefault(block // fold, []).append(key)
        for block, keys in ended.items():
            if (stream_id, level, block) not in held:
                key = block_key(stream_id, level, block)
                write(keys, key)
                found.append(key)
    named = {parsed_key(k): k for k in found}
    for key in set(found) - set(valid_keys(found, fold)):
        larger = _larger(parsed_key(key), named, fold)
        ages = [folder_age(spark, f"{path}/{BATCH_KEY}={named[up]}") for up in larger]
        if not grace_seconds or max(ages) >= grace_seconds:
            remove_folder(spark, f"{path}/{BATCH_KEY}={key}")
