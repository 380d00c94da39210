"""SimHash near-dedup over a byte-position inverted index with count filtering.

A fingerprint has eight positional bytes. Two that differ in at most four bits have at least four bytes in common, at four places; and
any four of eight places hold one of twenty triples of places (a fixed covering). So the index has twenty entries for each distinct
fingerprint: a triple of places and its bytes. In each posting list the common positional bytes of pairs are tallied, pairs with at
least four are verified by counting bits, and links come out as stars of the list's own components, never as all its pairs. Links
between different fingerprints are complete; equal fingerprints are one entry from the start. A long list is cut by each further byte
before pairs are tallied, which loses none of them, as a link shares a fourth byte.

Components are found by alternating stars over tables written to the shared folder. Documents never leave their rows but for
(doc_id, fingerprint).

Null and empty texts have fingerprint zero and link like any other. Repeated rows are returned each; extra columns are ignored by `link`
and kept by `representatives`. doc_id null is never the name of a component unless it holds no other. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.llm import buffers
from talkloom.llm.tables import free_names, shipped, written

WORDS = 4
BITS = 4
SEED = 42
#: Fingerprints of a posting list up to which pairs are tallied at once.
LIST = 2048
#: Pairs of one step of a tally.
_PAIRS = 1 << 20

_GROUPS = ((0, 1, 2), (3, 4, 5), (6, 7))


def covering() -> list[tuple[int, int, int]]:
    """Triples of eight places such that any four places hold one: within a group, or two of a group and one of the next."""
    out = [g for g in _GROUPS if len(g) == 3]
    for i, g in enumerate(_GROUPS):
        out += [tuple(sorted((*pair, one))) for pair in combinations(g, 2) for one in _GROUPS[(i + 1) % 3]]
    return out


def shingles(texts: buffers.Texts, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case words of a chunk joined by single spaces, and where each shingle starts and ends in it, and its row.

    A text with fewer words than a shingle is one shingle.
    """
    lower = buffers.Texts(buffers.LOWER[texts.data], texts.starts, texts.ends)
    words = buffers.words(lower)
    if not len(words.starts):
        return np.zeros(0, np.uint8), *(np.zeros(0, np.int64) for _ in range(3))
    size = words.ends - words.starts
    stop = np.cumsum(size + 1) - 1  # in the words joined by single spaces
    joined = np.full(stop[-1] + 1, 32, np.uint8)
    holds = np.ones(len(joined), bool)
    holds[stop] = False
    joined[holds] = lower.data[~buffers.SPACES[lower.data]]
    first = np.flatnonzero(np.append(True, words.rows[1:] != words.rows[:-1]))
    last = np.append(first[1:], len(size)) - 1
    begin = np.arange(len(size))
    ends = np.minimum(begin + n_words - 1, np.repeat(last, last - first + 1))
    whole = (ends - begin == n_words - 1) | (begin == np.repeat(first, last - first + 1))
    begin, ends = begin[whole], ends[whole]
    return joined, stop[begin] - size[begin], stop[ends], words.rows[begin]


def fingerprints_of(texts: buffers.Texts, n_words: int = WORDS) -> np.ndarray:
    """Fingerprints of the texts of a chunk."""
    out = np.zeros(len(texts), np.uint64)
    joined, starts, ends, owner = shingles(texts, n_words)
    if not len(starts):
        return out
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.array([digest(raw[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    at = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    ones = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    total = np.diff(np.append(at, len(owner)))
    out[owner[at]] = np.packbits(ones * 2 > total[:, None], axis=1).reshape(-1, 8).copy().view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, n_words: int = WORDS) -> DataFrame:
    """doc_id, fp."""

    def run(batches):
        for batch in batches:
            parts = [fingerprints_of(c, n_words) for c in buffers.chunks(buffers.from_arrow(batch.column("text")))]
            fp = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return shipped(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each one's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _tallied(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of one posting list, in steps of bounded size."""
    out = []
    rows = max(1, _PAIRS // len(fps))
    for low in range(0, len(fps), rows):
        apart = fps[low : low + rows, None] ^ fps[None, :]
        common = (apart.view(np.uint8).reshape(*apart.shape, 8) == 0).sum(axis=2, dtype=np.uint8)
        a, b = np.nonzero(common >= 8 - bits)
        a += low
        got = (a < b) & (np.bitwise_count(fps[a] ^ fps[b]) <= bits)
        out.append((a[got], b[got]))
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def _links(fps: np.ndarray, places: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars of the components of a list of distinct fingerprints that agree at the given places."""
    if len(fps) <= LIST or len(places) >= 8 - bits:
        a, b = _tallied(fps, bits)
    else:
        pieces = fps.view(np.uint8).reshape(-1, 8)
        found = []
        for place in set(range(8)) - set(places):
            order = np.argsort(pieces[:, place], kind="stable")
            cuts = np.flatnonzero(np.diff(pieces[order, place])) + 1
            for part in np.split(order, cuts):
                if len(part) > 1:
                    x, y = _tallied(fps[part], bits)
                    root = _roots(len(part), x, y)
                    moved = np.flatnonzero(root != np.arange(len(part)))
                    found.append((part[moved], part[root[moved]]))
        a, b = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int))
    root = _roots(len(fps), a, b)
    moved = np.flatnonzero(root != np.arange(len(fps)))
    return fps[moved], fps[root[moved]]


def _pairs_of_small(keys: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within many short lists at once: every row against the next, the one after, and so on."""
    a, b = [], []
    for d in range(1, len(keys)):
        same = np.flatnonzero(keys[d:] == keys[:-d])
        if not len(same):
            break
        apart = fps[same] ^ fps[same + d]
        tally = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        got = same[(tally >= 8 - bits) & (np.bitwise_count(apart) <= bits)]
        a.append(fps[got])
        b.append(fps[got + d])
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def links(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """a, b: links that connect whatever is connected, from distinct fingerprints fp."""
    triples = covering()

    def entry(k: int, places: tuple[int, ...]):
        key = F.lit(k)
        for p in places:
            key = key * 256 + F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))
        return key.cast("long")

    index = fps.select(F.explode(F.array(*[entry(k, t) for k, t in enumerate(triples)])).alias("key"), "fp")

    def flush(keys: np.ndarray, values: np.ndarray):
        cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        size = np.diff(np.append(cuts, len(keys)))
        short = np.repeat(size <= 32, size)
        found = [_pairs_of_small(keys[short], values[short], bits)]
        found += [_links(values[at : at + n].copy(), triples[int(keys[at]) >> 24], bits) for at, n in zip(cuts[size > 32], size[size > 32], strict=True)]
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def run(batches):
        """Rows come ordered by key; whole lists are worked on together."""
        keys, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.append(keys, batch.column("key").to_numpy(zero_copy_only=False))
            values = np.append(values, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
            if len(keys) > 100_000:
                done = int(np.searchsorted(keys, keys[-1]))
                if done:
                    yield flush(keys[:done], values[:done])
                    keys, values = keys[done:], values[done:]
        if len(keys):
            yield flush(keys, values)

    ordered = shipped(index).repartition("key").sortWithinPartitions("key", "fp")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for the nodes of the edges: large and small stars in turn until nothing moves."""
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    known = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state["n"] == 0 or tuple(state) == known:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        known = tuple(state)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.union(low.filter("m < u").select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct())
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct())


def link(docs: DataFrame, n_words: int = WORDS, bits: int = BITS) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id of what is reachable) for every row."""
    own = written(fingerprints(docs, n_words))
    named = written(own.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(named.select("fp"), bits))
    named = written(named.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    whole = named.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("component_id"))
    named = named.join(whole, F.col("root") == F.col("_root")).select(F.col("fp").alias("_fp"), "component_id")
    return own.join(named, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def one_each(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Of the rows of each `_root` the one of the smallest doc_id (null last, then by text), with the given columns. Rows combine before the shuffle."""
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id").cast("long"), F.xxhash64("text"))
    chosen = rows.groupBy("_root").agg(F.min_by(F.struct(*columns), order).alias("_row"))
    return chosen.select("_row.*")


@free_names("doc_id", "text")
def representatives(docs: DataFrame, n_words: int = WORDS, bits: int = BITS) -> DataFrame:
    """One row of docs for each component, that of its smallest doc_id, with all columns. Rows without a doc_id stand for their own component."""
    kind = T.StructType([*docs.schema.fields, T.StructField("_fp", T.LongType())])

    def run(batches):
        for batch in batches:
            parts = [fingerprints_of(c, n_words) for c in buffers.chunks(buffers.from_arrow(batch.column("text")))]
            fp = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp.view(np.int64))], [*batch.schema.names, "_fp"])

    rows = written(shipped(docs).mapInArrow(run, kind))
    roots = components(links(rows.select(F.col("_fp").alias("fp")).distinct(), bits))
    rows = rows.join(roots, F.col("_fp") == F.col("node"), "left").withColumn("_root", F.coalesce("root", "_fp"))
    return one_each(rows, docs.columns)
