"""Hard negatives for anchors and their positives, by an STR-packed R-tree over (label, components).

An anchor's positives are its best-scoring other rows of the same label; the negatives of an anchor and a positive are the best-scoring rows of other
labels whose score lies in a window below the positive's. Scores are integer inner products, ties go to the smaller vec_id.

Rows are dealt to trees by ranges of (label, first component, vec_id), so that equal vectors and a label with most of the rows spread as well. A tree is packed
by sort-tile-recursive: rows are sorted and cut into slabs of equal size by label, then each slab by one component after another (widest spread first), down
to leaves; levels of boxes are built bottom up. A minimum bounding box gives an interval for each coordinate, and so an interval of inner products: per
coordinate the larger and the smaller of the anchor's component times either end. A search takes boxes from a queue, best upper end first. A box is pruned if its labels
cannot match, if its interval lies outside the score window, or if its upper end is strictly below the k-th best found; equal ones are opened, as a smaller vec_id may be in
them. All windows of an anchor share one queue, so a leaf is scored once.

A tree is one row of the written index. Trees and anchors are sorted into the tasks: a task holds one tree and one Arrow batch of
anchors at a time. An anchor goes to
the trees that hold its label for positives, and to those that hold others for negatives. Every tree gives k rows a search, which are merged.

Rows with a null vec_id, label or vector, or with a null or non-finite component take no part. Rows of one vec_id count once, as that of the smallest label, then vector. Vectors
of unequal length count as filled up with zeros. Scores must fit a long. An anchor without positives, and a positive without negatives in its window, has no rows. Extra
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.llm.tables import few, shipped, written
from talkloom.llm.vectors import matrix, widened

K = 5
SCALE = 256
#: A negative scores between LOW and HIGH hundredths of the positive's score.
LOW, HIGH = 80, 100
#: Rows of a leaf, and branches of an inner box.
LEAF, FANOUT = 32, 16
#: Rows of a tree: a multiple of the root of all rows, between these.
LEAST_TREE, MOST_TREE, TREE_FACTOR = 4096, 32_768, 32


class Tree:
    """Boxes of all levels in flat arrays; rows lie in the order of the leaves."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        order = self._packed(labels, x)
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        cuts = np.arange(0, len(ids), LEAF)
        low, high = np.minimum.reduceat(self.x, cuts), np.maximum.reduceat(self.x, cuts)
        least, most = np.minimum.reduceat(self.labels, cuts), np.maximum.reduceat(self.labels, cuts)
        self.levels = [(low, high, least, most)]
        while len(self.levels[-1][0]) > 1:
            low, high, least, most = self.levels[-1]
            cuts = np.arange(0, len(low), FANOUT)
            self.levels.append((np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts), np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts)))

    @staticmethod
    def _packed(labels: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Row order of the leaves by sort-tile-recursive over the label and the components of the widest spread."""
        spread = np.argsort(-np.var(x, axis=0, dtype=np.float64), kind="stable")
        by = [labels, *(x[:, d] for d in spread)]
        out, work = [], [(np.arange(len(labels)), 0)]
        while work:
            rows, d = work.pop()
            pages = -(-len(rows) // LEAF)
            if pages <= 1 or d == len(by):
                out.append(rows)
                continue
            slabs = int(np.ceil(pages ** (1 / (len(by) - d)) - 1e-9)) if d else max(1, len(np.unique(labels)))
            size = -(-pages // slabs) * LEAF
            rows = rows[np.argsort(by[d][rows], kind="stable")]
            work += [(rows[at : at + size], d + 1) for at in range(0, len(rows), size)][::-1]
        return np.concatenate(out)

    def search(self, q: np.ndarray, own: int, label: int, same: bool, windows: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Window number, vec_ids and scores of the k best rows in each window (columns: from, to, both included) of the same or of other labels."""
        width = min(len(q), self.x.shape[1])
        q = q[:width]
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        begin, end = windows[:, 0], windows[:, 1]
        floor = np.where(begin <= end, begin, np.iinfo(np.int64).max)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(windows)

        def push(level: int, first: int, last: int) -> None:
            low, high, least, most = (a[first:last] for a in self.levels[level])
            fits = (least <= label) & (most >= label) if same else (least != label) | (most != label)
            low, high = low[:, :width], high[:, :width]
            top, bottom = high @ up + low @ down, low @ up + high @ down
            fits &= ((top[:, None] >= floor) & (bottom[:, None] <= end)).any(axis=1)
            for i in np.flatnonzero(fits).tolist():
                heappush(queue, (-int(top[i]), level, first + i))

        queue: list[tuple[int, int, int]] = []
        push(len(self.levels) - 1, 0, 1)
        while queue and -queue[0][0] >= floor.min():
            _, level, box = heappop(queue)
            if level:
                push(level - 1, box * FANOUT, (box + 1) * FANOUT)
                continue
            at = slice(box * LEAF, (box + 1) * LEAF)
            score, ids = self.x[at, :width] @ q, self.ids[at]
            good = ((self.labels[at] == label) == same) & (ids != own)
            for w in np.flatnonzero((score.max() >= floor) & (score.min() <= end)).tolist():
                take = good & (score >= floor[w]) & (score <= end[w])
                if take.any():
                    names, values = np.append(found[w][0], ids[take]), np.append(found[w][1], score[take])
                    best = np.lexsort((names, -values))[:k]
                    found[w] = names[best], values[best]
                    if len(best) == k:
                        floor[w] = max(floor[w], values[best[-1]])
        return ((w, *f) for w, f in enumerate(found) if len(f[0]))


def prepared(table: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """vec_id, label, x (array<long>) of the rows that take part, one for each vec_id."""
    x = F.transform(F.col("embedding").cast("array<double>"), lambda v: F.floor(v * scale))
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = table.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").filter(fine)
    rows = rows.select(F.col("vec_id").cast("long"), label.cast("long").alias("label"), x.alias("x"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("row")).select("vec_id", "row.*")


def _bytes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, np.int64).tobytes()


def _ints(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


def index(rows: DataFrame, tree_rows: int | None = None) -> DataFrame:
    """tree, labels (distinct), packed ids, labels and vectors: one row a tree, written."""
    total = rows.count()
    size = tree_rows or min(MOST_TREE, max(LEAST_TREE, TREE_FACTOR * isqrt(total)))
    first = F.coalesce(F.get("x", F.lit(0)), F.lit(0))
    dealt = rows.withColumn("first", first).repartitionByRange(max(1, -(-total // size)), "label", "first", "vec_id")
    dealt = dealt.sortWithinPartitions("label", "first", "vec_id").select("vec_id", "label", "x")

    def pack(part: pa.Table) -> pa.RecordBatch:
        ids, labels, x = part.column("vec_id").to_numpy(), part.column("label").to_numpy(), matrix(part.column("x")).astype(np.int64)
        return pa.RecordBatch.from_pydict({
            "tree": [f"{ids.min()}"], "held": [np.unique(labels).tolist()], "ids": [_bytes(ids)], "labels": [_bytes(labels)], "x": [_bytes(x)],
        }, schema=pa.schema([("tree", pa.string()), ("held", pa.list_(pa.int64())), ("ids", pa.binary()), ("labels", pa.binary()), ("x", pa.binary())]))

    def run(batches):
        held, n = [], 0
        for batch in batches:
            while len(batch):
                part = batch.slice(0, size - n)
                held, n, batch = [*held, part], n + len(part), batch.slice(len(part))
                if n == size:
                    yield pack(pa.Table.from_batches(held))
                    held, n = [], 0
        if n:
            yield pack(pa.Table.from_batches(held))

    return written(shipped(dealt).mapInArrow(run, "tree string, held array<long>, ids binary, labels binary, x binary"))


def _searched(trees: DataFrame, asked: DataFrame, same: bool, k: int) -> DataFrame:
    """anchor_id, window, vec_id, score: k best of every tree. asked: anchor_id, label, x, windows (array of from, to)."""
    if same:
        held = few(written(trees.select("tree", F.explode("held").alias("label"))))
        to = asked.join(held, "label").select("tree", *asked.columns)
    else:
        # a tree of one label has nothing for anchors of that label
        names = written(trees.select((F.row_number().over(Window.orderBy("tree")) - 1).alias("no"), "tree", F.when(F.size("held") == 1, F.get("held", F.lit(0))).alias("only")))
        numbers = F.explode(F.sequence(F.lit(0), F.lit(max(1, names.count()) - 1)))
        to = asked.withColumn("no", numbers).join(few(names), "no").filter("only IS NULL OR only <> label").select("tree", *asked.columns)
    binary = F.lit(None).cast("binary")
    left = trees.select("tree", F.lit(0).alias("kind"), "ids", "labels", F.col("x").alias("rows"), *(F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in asked.columns if c != "label"), F.lit(None).cast("long").alias("label"))
    right = to.select("tree", F.lit(1).alias("kind"), binary.alias("ids"), binary.alias("labels"), binary.alias("rows"), *[c for c in asked.columns if c != "label"], "label")
    dealt = shipped(left.union(right)).repartition("tree").sortWithinPartitions("tree", "kind", "anchor_id")

    def run(batches):
        tree = None
        for batch in batches:
            kinds = batch.column("kind").to_pylist()
            out: list[tuple[int, int, int, int]] = []
            for i, kind in enumerate(kinds):
                if kind == 0:
                    ids, labels, x = (_ints(batch.column(c)[i].as_py()) for c in ("ids", "labels", "rows"))
                    tree = Tree(ids, labels, x.reshape(len(ids), -1))
                    continue
                anchor, label = batch.column("anchor_id")[i].as_py(), batch.column("label")[i].as_py()
                windows = np.array([[w["begin"], w["end"]] for w in batch.column("windows")[i].as_py()], np.int64)
                q = batch.column("x")[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
                for w, names, scores in tree.search(q, anchor, label, same, windows, k):
                    out += [(anchor, w, n, s) for n, s in zip(names.tolist(), scores.tolist(), strict=True)]
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor_id", "window", "vec_id", "score"])

    found = dealt.mapInArrow(run, "anchor_id long, window long, vec_id long, score long")
    order = Window.partitionBy("anchor_id", "window").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _up(x: Column) -> Column:
    """A hundredth of a whole number, rounded up."""
    return F.call_function("div", F.when(x > 0, x + 99).otherwise(x), F.lit(100).cast("long"))


def mined(rows: DataFrame, is_anchor: Column, k: int = K, low: int = LOW, high: int = HIGH, tree_rows: int | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. rows: as `prepared` gives them."""
    rows = written(rows)
    trees = index(rows, tree_rows)
    anchors = rows.filter(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "x")
    window = lambda begin, end: F.struct(begin.cast("long").alias("begin"), end.cast("long").alias("end"))
    whole = F.array(window(F.lit(-(2**63) + 1), F.lit(2**63 - 1)))
    positives = written(_searched(trees, anchors.withColumn("windows", whole), True, k))
    of = positives.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))).alias("positives"))
    of = written(of)
    asked = anchors.join(of, "anchor_id").withColumn("windows", F.transform("positives", lambda p: window(_up(p["positive_score"] * low), -_up(-p["positive_score"] * high)))).drop("positives")
    found = _searched(trees, asked, False, k).join(of, "anchor_id")
    positive = F.get("positives", F.col("window").cast("int"))
    return found.select(
        "anchor_id", positive["positive_id"].alias("positive_id"), F.col("rank").cast("int"), F.col("vec_id").alias("negative_id"),
        positive["positive_score"].alias("positive_score"), F.col("score").alias("negative_score"),
    )
