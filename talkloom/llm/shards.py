"""Keys that several documents share, found by shards of documents.

Documents are dealt into shards by a hash. A shard lists the keys of its documents once each (with the number of its documents that have
them and the smallest doc_id) as packed arrays, cut into buckets by key; a bucket adds up what the shards sent and sends every shard
the keys of it that are shared. However many documents hold a key, a bucket gets it at most once from a shard, so no key is hot.
Shards and buckets are bounded in bytes and dealt out evenly. doc_id null counts as the largest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm import buffers
from talkloom.llm.tables import shipped

#: Bytes of text of a shard: the root of a thousand times the input between these. Larger shards make fewer, larger messages.
LEAST_SHARD, MOST_SHARD = 4 << 20, 64 << 20
SHARDS_A_BUCKET = 4

_LAST = np.iinfo(np.int64).max


def shard_count(docs: DataFrame, shard_bytes: int | None = None) -> int:
    total = docs.agg(F.sum(F.octet_length("text") + 64).alias("n")).first()["n"] or 0
    size = shard_bytes or min(MOST_SHARD, max(LEAST_SHARD, isqrt(int(total) * 1024)))
    return max(1, -(-int(total) // size))


def sharded(docs: DataFrame, n: int) -> DataFrame:
    """Add _shard. Repeated rows may meet in a shard or not; results do not depend on it."""
    return docs.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)))


def doc_ids(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").cast(pa.int64()).fill_null(_LAST).to_numpy()


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts the keys, and where each run of equal keys starts in it."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    return order, np.flatnonzero(fresh)


def _packed(x: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


def _squeezed(keys: np.ndarray) -> bytes:
    """Ordered keys as compressed steps: six bytes a key, or fewer, if they have 48 bits."""
    steps = np.diff(keys, prepend=np.uint64(0))
    raw = steps.view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _keys(column: pa.ChunkedArray) -> list[np.ndarray]:
    raw = (pa.decompress(x[8:], int.from_bytes(x[:8], "little"), "zstd") for x in column.to_pylist())
    return [np.cumsum(np.frombuffer(x, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64) for x in raw]


def _unpacked(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


_SENT = "_shard long, bucket long, keys binary, docs binary, least binary"
_SHARED = "_shard long, keys binary, docs binary, least binary"


def shared_keys(shards: DataFrame, keys_of: Callable[..., tuple[np.ndarray, np.ndarray]], n: int, least_docs: int = 2, with_least: bool = True, known: DataFrame | None = None) -> DataFrame:
    """_shard, keys (uint64), docs (uint32, how many documents have it), least (int64, smallest doc_id): packed, keys in order, for every
    shard only its own keys that at least least_docs documents have. keys_of gives keys and rows for the texts of a chunk; with `known`, what
    an earlier call gave, it gets the ordered keys that the shard has from there as well. Without with_least the smallest doc_ids are left
    out (null) of all messages."""
    n_buckets = max(1, -(-n // SHARDS_A_BUCKET))

    def send(table: pa.Table, *got: pa.Table) -> pa.Table:
        ids, names = doc_ids(table), [merged(x)[0] for x in got]
        found = [(k, r + c.first) for c in buffers.chunks(buffers.from_arrow(table.column("text"))) for k, r in [keys_of(c, *names)]]
        keys, rows = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        # one entry a document: equal ids are one document
        order = np.lexsort((ids[rows], keys))
        keys, docs = keys[order], ids[rows][order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
        keys, docs = keys[new], docs[new]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(fresh)
        counts = np.diff(np.append(at, len(keys)))
        keys, least = keys[at], docs[at]
        bucket = (keys % np.uint64(n_buckets)).astype(np.int64)
        order, starts = grouped(bucket)
        parts = [p for p in np.split(order, starts[1:]) if len(p)]
        shard = table.column("_shard")[0].as_py() if len(table) else None
        return pa.table({
            "_shard": pa.array([shard] * len(parts), pa.int64()),
            "bucket": pa.array([int(bucket[p[0]]) for p in parts], pa.int64()),
            "keys": pa.array([_squeezed(keys[p]) for p in parts], pa.binary()),
            "docs": pa.array([_packed(np.minimum(counts[p], 2**32 - 1), np.uint32) for p in parts], pa.binary()),
            "least": pa.array([_packed(least[p], np.int64) if with_least else None for p in parts], pa.binary()),
        })

    def add(table: pa.Table) -> pa.Table:
        keys, docs = _keys(table.column("keys")), _unpacked(table.column("docs"), np.uint32)
        every = np.concatenate(keys)
        order, starts = grouped(every)
        total = np.add.reduceat(np.concatenate(docs)[order].astype(np.int64), starts)
        smallest = np.minimum.reduceat(np.concatenate(_unpacked(table.column("least"), np.int64))[order], starts) if with_least else None
        names = every[order][starts]
        out: dict[str, list] = {"_shard": [], "keys": [], "docs": [], "least": []}
        for shard, mine in zip(table.column("_shard").to_pylist(), keys, strict=True):
            at = np.searchsorted(names, mine)
            got = total[at] >= least_docs
            if got.any():
                out["_shard"].append(shard)
                out["keys"].append(_squeezed(mine[got]))
                out["docs"].append(_packed(np.minimum(total[at][got], 2**32 - 1), np.uint32))
                out["least"].append(_packed(smallest[at][got], np.int64) if with_least else None)
        return pa.table({k: pa.array(v, pa.int64() if k == "_shard" else pa.binary()) for k, v in out.items()})

    if known is None:
        sent = shipped(shards).groupBy("_shard").applyInArrow(send, _SENT)
    else:
        sent = with_shared(shards, known, send, _SENT)
    return sent.groupBy("bucket").applyInArrow(add, _SHARED)


def merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What one shard got from all buckets: keys in order, docs, least."""
    if not len(table):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
    parts, docs = _keys(table.column("keys")), np.concatenate(_unpacked(table.column("docs"), np.uint32))
    least = np.concatenate([np.zeros(len(k), np.int64) if x is None else np.frombuffer(x, np.int64) for k, x in zip(parts, table.column("least").to_pylist(), strict=True)])
    keys = np.concatenate(parts)
    order = np.argsort(keys)
    return keys[order], docs[order], least[order]


def looked_up(names: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is among the ordered names, and where."""
    if not len(names):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(names, keys), len(names) - 1)
    return names[at] == keys, at


def with_shared(shards: DataFrame, shared: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
    """work(documents of a shard, what the shard got) for every shard."""

    def run(left: pa.Table, right: pa.Table) -> Iterator[pa.Table] | pa.Table:
        return work(left, right)

    return shipped(shards).groupBy("_shard").cogroup(shared.groupBy("_shard")).applyInArrow(run, schema)
