"""Removal of repeated passages by suffix refinement: every byte of a string of `length` bytes that a document with a smaller doc_id has too.

Strings are judged on the input and overlap. Suffixes only need to be told apart to that length, and only where a string may repeat:

1. Every string has a key, the smallest hash of its 24-byte grams, so equal strings have equal keys. Neighbouring strings of a key are
   one run of bytes. Keys that two documents share are found by shards (shards.py).
2. A shard sends each different run of a shared key once to the key's bucket, with the smallest and largest doc_id that has it in the
   shard. Keys of very many documents (a common line in ever new surroundings) are sent as single strings, keyed by their own hash,
   so that no bucket holds them all.
3. A bucket refines its suffixes by bucket pointers: the suffixes are put into buckets by their first 8 bytes; each bucket of several is
   sorted by the bucket pointers of the suffixes 8 bytes on, the pointers are updated, and the same is done 16 and then 18 bytes on, so
   that each level uses the refined pointers of the one before. What is together at 50 bytes is equal, and the smallest doc_id of each
   such bucket is sent back.
4. A shard finds its runs again and marks the bytes of strings that a smaller doc_id has.

All messages are packed arrays, bytes of runs compressed. doc_id null counts as the largest; rows of equal doc_id are one document and take nothing from each
other. Null texts count as empty. Texts shorter than a string lose nothing. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm import buffers, shards

LENGTH = 50
GRAM = 24
#: Documents of a key from which its strings are sent one by one.
MANY_DOCS = 4096
BUCKETS_A_SHARD = 2

_WINDOW = LENGTH - GRAM + 1
_NAMES = buffers.mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over each stretch of width entries, by doubling."""
    done, size = x, 1
    while size * 2 <= width:
        done = pick(done[:-size], done[size:])
        size *= 2
    return pick(done[: len(done) - (width - size)], done[width - size :]) if width > size else done


def keyed_runs(texts: buffers.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings of one key within a text: first string, number of strings, key (48 bits), row."""
    none = np.zeros(0, np.int64)
    n = len(texts.data) - LENGTH + 1
    long = texts.ends - texts.starts >= LENGTH
    if n < 1 or not long.any():
        return none, none, none.astype(np.uint64), none
    h = _NAMES[texts.data]
    for step in (1, 2, 4):
        h = h[:-step] * np.uint64(0x9E3779B97F4A7C15 + 2 * step) + h[step:]
    # three eights make a gram
    h = (h[:-16] * np.uint64(0xD6E8FEB86659FD93) + h[8:-8]) * np.uint64(0xD6E8FEB86659FD93) + h[16:]
    key = _sliding(buffers.mixed(h), _WINDOW, np.minimum)
    inside = np.zeros(n + 1, np.int32)
    np.add.at(inside, texts.starts[long], 1)
    np.add.at(inside, texts.ends[long] - LENGTH + 1, -1)
    valid = np.cumsum(inside[:n]) > 0
    fresh = valid.copy()
    fresh[1:] &= (key[1:] != key[:-1]) | ~valid[:-1]
    fresh[texts.starts[long]] = True
    starts = np.flatnonzero(fresh)
    closed = valid.copy()
    closed[:-1] &= fresh[1:] | ~valid[1:]
    counts = np.flatnonzero(closed) + 1 - starts
    rows = np.flatnonzero(long)[np.searchsorted(texts.starts[long], starts, "right") - 1]
    return starts, counts, key[starts] >> np.uint64(16), rows


def _keys_of(texts: buffers.Texts) -> tuple[np.ndarray, np.ndarray]:
    _, _, keys, rows = keyed_runs(texts)
    return keys, rows


def _shared_runs(texts: buffers.Texts, names: np.ndarray, docs: np.ndarray, many: int) -> tuple[np.ndarray, ...]:
    """Runs of shared keys as they are sent: first string, number of strings, bucket key, row, hash of the bytes."""
    starts, counts, keys, rows = keyed_runs(texts)
    hit, at = shards.looked_up(names, keys)
    starts, counts, keys, rows, common = starts[hit], counts[hit], keys[hit], rows[hit], docs[at[hit]] > many
    if common.any():
        each = counts[common]
        offset = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        single = np.repeat(starts[common], each) + offset
        rows = np.concatenate([rows[~common], np.repeat(rows[common], each)])
        starts = np.concatenate([starts[~common], single])
        counts = np.concatenate([counts[~common], np.ones(len(single), np.int64)])
        keys = np.concatenate([keys[~common], np.zeros(len(single), np.uint64)])
    digest = buffers.Hasher(texts.data)(starts, starts + counts + LENGTH - 1)
    n_single = int(len(starts) - (~common).sum()) if common.any() else 0
    if n_single:
        keys[-n_single:] = digest[-n_single:]
    return starts, counts, keys, rows, digest


def _ragged(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """data[s : s + n] for each start and size, one after the other."""
    total = int(sizes.sum())
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return data[np.arange(total) + shift]


def refined(data: np.ndarray, suffixes: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Bucket pointers that are equal exactly for suffixes with equal first `length` bytes; data has `length` bytes after each.

    Pointers are kept for every position, as later offsets ask for them: the place where the position's bucket starts in the order.
    """
    n, q = len(data), 8
    padded = np.concatenate([data, np.zeros(length + q, np.uint8)])
    code = padded.astype(np.uint64)
    for step in (1, 2, 4):
        code = (code[:-step] << np.uint64(8 * step)) | code[step:]
    code = code[: n + length]
    order = np.argsort(code[:n])
    fresh = np.append(True, code[order][1:] != code[order][:-1])
    pointer = np.zeros(n + length, np.int64)
    pointer[order] = np.repeat(np.flatnonzero(fresh), np.diff(np.append(np.flatnonzero(fresh), n)))
    pointer[n:] = n  # past the end
    depth = q
    while depth < length:
        step = min(depth, length - depth)
        size = np.bincount(pointer[:n], minlength=n)
        open_ = np.flatnonzero(size[pointer[:n]] > 1) if depth + step < length else suffixes[size[pointer[suffixes]] > 1]
        if not len(open_):
            break
        pair = pointer[open_].astype(np.uint64) << np.uint64(32) | pointer[open_ + step].astype(np.uint64)
        order = np.argsort(pair)
        ordered, place = pair[order], np.arange(len(order))
        bucket = ordered >> np.uint64(32)
        new_bucket = np.append(True, bucket[1:] != bucket[:-1])
        new_part = np.append(True, ordered[1:] != ordered[:-1])
        first = np.repeat(place[new_bucket], np.diff(np.append(place[new_bucket], len(place))))
        part = np.repeat(place[new_part], np.diff(np.append(place[new_part], len(place))))
        pointer[open_[order]] = bucket.astype(np.int64) + part - first
        depth += step
    return pointer[suffixes]


_RUNS = "_shard long, bucket long, digests binary, counts binary, low binary, high binary, bytes binary"
_FOUND = "_shard long, keys binary, docs binary, least binary, digests binary, offsets binary, counts binary, smallest binary"


def _blob(x: np.ndarray, kind=None) -> bytes:
    """An array, compressed, after its size in bytes."""
    raw = np.ascontiguousarray(x if kind is None else x.astype(kind)).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _read(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(pa.decompress(x[8:], int.from_bytes(x[:8], "little"), "zstd"), kind) for x in column.to_pylist()]


def removed(docs: DataFrame, many_docs: int = MANY_DOCS, shard_bytes: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes)."""
    n = shards.shard_count(docs, shard_bytes)
    spread = shards.sharded(docs.select(F.col("doc_id").cast("long"), "text"), n)
    shared = shards.shared_keys(spread, _keys_of, n, with_least=False)

    def send(table: pa.Table, got: pa.Table) -> pa.Table:
        columns: dict[str, list] = {c.split()[0]: [] for c in _RUNS.split(", ")}
        names, counts_of, _ = shards.merged(got)
        if len(table) and len(names):
            ids, parts = shards.doc_ids(table), []
            for chunk in buffers.chunks(buffers.from_arrow(table.column("text"))):
                starts, counts, keys, rows, digest = _shared_runs(chunk, names, counts_of, many_docs)
                sizes = counts + LENGTH - 1
                order, fresh = shards.grouped(digest)
                if len(order):
                    docs_in_order = ids[rows + chunk.first][order]
                    one = order[fresh]
                    parts.append((digest[one], counts[one], keys[one], np.minimum.reduceat(docs_in_order, fresh), np.maximum.reduceat(docs_in_order, fresh), _ragged(chunk.data, starts[one], sizes[one])))
            if parts:
                digest, counts, keys, low, high = (np.concatenate([p[i] for p in parts]) for i in range(5))
                data = np.concatenate([p[5] for p in parts])
                sizes = counts + LENGTH - 1
                begins = np.cumsum(sizes) - sizes
                # a run that several chunks of the shard have is sent once
                order, fresh = shards.grouped(digest)
                low, high = np.minimum.reduceat(low[order], fresh), np.maximum.reduceat(high[order], fresh)
                one = order[fresh]
                bucket = (keys[one] % np.uint64(n * BUCKETS_A_SHARD)).astype(np.int64)
                order, fresh = shards.grouped(bucket)
                for part in np.split(order, fresh[1:]):
                    own = one[part]
                    columns["_shard"].append(table.column("_shard")[0].as_py())
                    columns["bucket"].append(int(bucket[part[0]]))
                    columns["digests"].append(_blob(digest[own]))
                    columns["counts"].append(_blob(counts[own], np.uint32))
                    columns["low"].append(_blob(low[part]))
                    columns["high"].append(_blob(high[part] - low[part]))
                    columns["bytes"].append(_blob(_ragged(data, begins[own], sizes[own])))
        return pa.table({k: pa.array(v, pa.int64() if k in ("_shard", "bucket") else pa.binary()) for k, v in columns.items()})

    def refine(table: pa.Table) -> pa.Table:
        read = lambda c, kind: _read(table.column(c), kind)
        per_row = read("digests", np.uint64)
        digest, counts = np.concatenate(per_row), np.concatenate(read("counts", np.uint32)).astype(np.int64)
        low = np.concatenate(read("low", np.int64))
        high = low + np.concatenate(read("high", np.int64))
        sizes = counts + LENGTH - 1
        data = np.concatenate(read("bytes", np.uint8))
        begins = np.cumsum(sizes) - sizes
        # equal runs of several shards are refined once; a digest that two different runs share gathers nothing
        order, fresh = shards.grouped(digest)
        unique = np.cumsum(np.bincount(fresh, minlength=len(order))) - 1
        kind = np.empty(len(order), np.int64)
        kind[order] = unique
        one = order[fresh]
        same = (sizes == sizes[one[kind]]).all() and all(
            (_ragged(data, begins[part], sizes[part]) == _ragged(data, begins[one[kind[part]]], sizes[part])).all() for part in np.array_split(np.arange(len(sizes)), 8)
        )
        if not same:
            one = kind = np.arange(len(sizes))
        lowest = np.full(len(one), np.iinfo(np.int64).max)
        np.minimum.at(lowest, kind, low)
        data, each = _ragged(data, begins[one], sizes[one]), counts[one]
        begins = np.cumsum(sizes[one]) - sizes[one]
        owner = np.repeat(np.arange(len(one)), each)
        offset = np.arange(len(owner)) - (np.cumsum(each) - each)[owner]
        pointer = refined(data, begins[owner] + offset)
        order, fresh = shards.grouped(pointer)
        smallest = np.empty(len(owner), np.int64)
        smallest[order] = np.repeat(np.minimum.reduceat(lowest[owner][order], fresh), np.diff(np.append(fresh, len(order))))
        # neighbouring strings of a run with one smallest doc_id are one stretch, for all equal runs
        begin = np.append(True, (owner[1:] != owner[:-1]) | (smallest[1:] != smallest[:-1]))
        at = np.flatnonzero(begin)
        spans = np.diff(np.append(at, len(owner)))
        first = np.searchsorted(owner[at], np.arange(len(one) + 1))
        n_parts = (first[1:] - first[:-1])[kind]
        run = np.repeat(np.arange(len(kind)), n_parts)
        which = np.arange(len(run)) - np.repeat(np.cumsum(n_parts) - n_parts, n_parts) + first[kind[run]]
        hit = smallest[at[which]] < high[run]
        run, which = run[hit], which[hit]
        shard = np.repeat(np.array(table.column("_shard").to_pylist()), [len(x) for x in per_row])
        order, fresh = shards.grouped(shard[run])
        parts = [p for p in np.split(order, fresh[1:]) if len(p)]
        binary = lambda values: pa.array(values, pa.binary())
        return pa.table({
            "_shard": pa.array([int(shard[run[p[0]]]) for p in parts], pa.int64()),
            **{c: binary([None] * len(parts)) for c in ("keys", "docs", "least")},
            "digests": binary([_blob(digest[run[p]]) for p in parts]),
            "offsets": binary([_blob(offset[at[which[p]]], np.uint32) for p in parts]),
            "counts": binary([_blob(spans[which[p]], np.uint32) for p in parts]),
            "smallest": binary([_blob(smallest[at[which[p]]]) for p in parts]),
        })

    def mark(table: pa.Table, got: pa.Table) -> pa.Table:
        ids, out = shards.doc_ids(table), []
        told = got.filter(got.column("digests").is_valid())
        names, counts_of, _ = shards.merged(got.filter(got.column("keys").is_valid()))
        read = lambda c, kind: np.concatenate([np.zeros(0, kind), *_read(told.column(c), kind)])
        digest = read("digests", np.uint64)
        order = np.argsort(digest, kind="stable")
        digest, offsets, lengths, smallest = digest[order], read("offsets", np.uint32)[order].astype(np.int64), read("counts", np.uint32)[order].astype(np.int64), read("smallest", np.int64)[order]
        for chunk in buffers.chunks(buffers.from_arrow(table.column("text"))):
            change = np.zeros(len(chunk.data) + 1, np.int32)
            if len(digest):
                starts, _, _, rows, own = _shared_runs(chunk, names, counts_of, many_docs)
                low, high = np.searchsorted(digest, own, "left"), np.searchsorted(digest, own, "right")
                run = np.repeat(np.arange(len(own)), high - low)
                which = np.arange(len(run)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[run]
                later = smallest[which] < ids[rows[run] + chunk.first]
                begin = starts[run[later]] + offsets[which[later]]
                np.add.at(change, begin, 1)
                np.add.at(change, begin + lengths[which[later]] + LENGTH - 1, -1)
            gone = np.cumsum(change[:-1]) > 0
            edge = gone.copy()
            edge[1:] &= ~gone[:-1]
            filled = chunk.starts < chunk.ends
            edge[chunk.starts[filled]] = gone[chunk.starts[filled]]
            n_gone, n_edges = np.append(0, np.cumsum(gone)), np.append(0, np.cumsum(edge))
            for row, (a, b) in enumerate(zip(chunk.starts.tolist(), chunk.ends.tolist(), strict=True)):
                lost = int(n_gone[b] - n_gone[a])
                kept = (chunk.data[a:b][~gone[a:b]] if lost else chunk.data[a:b]).tobytes()
                out.append((table.column("doc_id")[chunk.first + row].as_py(), b - a, lost, int(n_edges[b] - n_edges[a]), hashlib.sha256(kept).hexdigest(), kept))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names_out = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
        return pa.table({c: pa.array([r[i] for r in out], k) for i, (c, k) in enumerate(zip(names_out, kinds, strict=True))})

    sent = shards.with_shared(spread, shared, send, _RUNS)
    answered = sent.groupBy("bucket").applyInArrow(refine, _FOUND)
    told = shared.select("*", *[F.lit(None).cast("binary").alias(c) for c in ("digests", "offsets", "counts", "smallest")])
    return shards.with_shared(spread, told.unionByName(answered), mark, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
