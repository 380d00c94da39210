"""Reader of large nested dialogue documents: many tasks read one JSON document."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkloom import schemas, session
from talkloom.operators import scans

_BLOCK = "spark.sql.files.maxPartitionBytes"
#: Kinds of fragments: of an example, of its key, of a string at the top, and the last mark of what lies between those.
_EXAMPLE, _ID, _STRING, _GAP = 0, 1, 2, 3
#: Depth of what `examples` holds: in the document, in the object or array.
_TOP, _HOLDER = 1, 2
#: Blocks or files up to which their table is broadcast; a row each of a name, a text and a few numbers.
_FEW = 100_000


def read_document(spark: SparkSession, path: str, system: str | None = None, block_bytes: int | None = None) -> DataFrame:
    """file, system, pos, example_id, prompt, answer as `read_dialogues` gives them, of documents of any size.

    A document is read in blocks (`block_bytes`, or as the session splits files) as pieces between quotation marks. Where a block
    begins, it is not known if that is inside a string, nor how deep. So a first reading counts, for each block, its quotation marks that
    no backslash escapes, and the brackets outside of strings for either case; running sums over the blocks of a document give the
    state at the start of each. A second reading cuts the examples out at their brackets, which is written down, and the pieces of an example
    meet by its number: how many begin in earlier blocks, and how many before it in its own. No task holds more than a block or an example.

    Both readings run when this is called. A document without `examples`, or with ones that do not parse, is an error.
    """
    spark = session.prepare(spark)
    with _blocks_of(spark, block_bytes):
        raw = spark.read.text(path, lineSep='"').select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
        starts = _starts(raw)
        fragments = session.materialize(_fragments(raw, starts))
    return _examples(spark, fragments, system)


@contextmanager
def _blocks_of(spark: SparkSession, block_bytes: int | None) -> Iterator[None]:
    before = spark.conf.get(_BLOCK)
    if block_bytes is not None:
        spark.conf.set(_BLOCK, str(block_bytes))
    try:
        yield
    finally:
        spark.conf.set(_BLOCK, before)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Rows of a batch by file and block, which come one after another."""
    names = batch.column("file").dictionary_encode().indices.to_numpy(zero_copy_only=False)
    blocks = batch.column("block").to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.append(True, (names[1:] != names[:-1]) | (blocks[1:] != blocks[:-1])))
    for at, end in zip(cuts, np.append(cuts[1:], len(blocks)), strict=True):
        yield (batch.column("file")[int(at)].as_py(), int(blocks[at])), batch.slice(int(at), int(end - at))


def _closing(pieces: pa.Array) -> np.ndarray:
    """Whether the quotation mark after a piece is one: an even number of backslashes stands before it."""
    slashes = pc.subtract(pc.binary_length(pieces), pc.binary_length(pc.utf8_rtrim(pieces, "\\")))
    return slashes.to_numpy(zero_copy_only=False) % 2 == 0


def _deeper(pieces: pa.Array) -> np.ndarray:
    count = lambda c: pc.count_substring(pieces, c).to_numpy(zero_copy_only=False).astype(np.int64)
    return count("{") + count("[") - count("}") - count("]")


def _starts(raw: DataFrame) -> DataFrame:
    """file, block, inside, depth: the state at the start of every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, marks, deeper = None, 0, [0, 0]

        def out():
            return pa.RecordBatch.from_pydict({"file": [held[0]], "block": [held[1]], "marks": [marks], "outside": [deeper[0]], "inside": [deeper[1]]})

        for batch in batches:
            for key, part in _parts(batch):
                if key != held:
                    if held is not None:
                        yield out()
                    held, marks, deeper = key, 0, [0, 0]
                pieces = part.column("value")
                closing, change = _closing(pieces), _deeper(pieces)
                within = (marks + np.cumsum(closing) - closing) % 2
                # pieces outside of strings, if the block starts outside, and if it starts inside
                deeper = [deeper[0] + int(change[within == 0].sum()), deeper[1] + int(change[within == 1].sum())]
                marks += int(closing.sum())
        if held is not None:
            yield out()

    blocks = session.materialize(session.shipped(raw).mapInArrow(run, "file string, block long, marks long, outside long, inside long"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("odd", F.coalesce(F.sum("marks").over(before), F.lit(0)) % 2)
    change = F.when(F.col("odd") == 0, F.col("outside")).otherwise(F.col("inside"))
    return session.materialize(blocks.select("file", "block", "odd", F.coalesce(F.sum(change).over(before), F.lit(0)).alias("depth")))


def _fragments(raw: DataFrame, starts: DataFrame) -> DataFrame:
    """file, block, i, kind, number, text: number counts the examples that begin in the block up to here; a key belongs to the next one."""
    few = _is_few(starts)
    if not few:
        raw = raw.withColumn("row", F.monotonically_increasing_id())
    known = raw.join(F.broadcast(starts) if few else starts, ["file", "block"], "left")
    # the second reading must find the blocks of the first
    known = known.withColumn("odd", F.coalesce("odd", F.raise_error(F.lit("files were split differently")).cast("long")))
    if not few:
        known = known.sortWithinPartitions("file", "block", "row").drop("row")

    def cut(i: int, text: str, depth: int, number: int) -> Iterator[tuple]:
        """Fragments of a piece outside of strings; the last one is (depth, number) after it."""
        begin = 0 if depth > _HOLDER else None
        last, top = "", depth <= _TOP
        for at, c in enumerate(text):
            if c in "{[":
                depth += 1
                if depth == _HOLDER + 1:
                    begin, number = at, number + 1
            elif c in "}]":
                depth -= 1
                if depth == _HOLDER and begin is not None:
                    yield i, _EXAMPLE, number, text[begin : at + 1]
                    begin = None
            if c in "{[,:":
                last = c
        if begin is not None:
            yield i, _EXAMPLE, number, text[begin:]
        if top or depth <= _TOP:
            yield i, _GAP, number, last
        yield depth, number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, i, odd, depth, number = None, 0, 0, 0, 0
        for batch in batches:
            for key, part in _parts(batch):
                if key != held:
                    held, i, number = key, 0, 0
                    odd, depth = part.column("odd")[0].as_py(), part.column("depth")[0].as_py()
                pieces = part.column("value")
                closing, change = _closing(pieces), _deeper(pieces)
                inside = (odd + np.cumsum(closing) - closing) % 2 == 1
                after = depth + np.cumsum(np.where(inside, 0, change))
                # within an example all pieces are taken as they are; the others are few for each example
                closes = pc.match_substring_regex(pieces, r"[}\]]").to_numpy(zero_copy_only=False)
                plain = (np.concatenate([[depth], after[:-1]]) > _HOLDER) & (inside | ~closes)
                rows: list[tuple] = []
                texts = pieces.to_pylist()
                for k, text in enumerate(texts):
                    if plain[k]:
                        rows.append((i + k, _EXAMPLE, number, text))
                        depth = int(after[k])
                    elif not inside[k]:
                        *found, (depth, number) = cut(i + k, text, depth, number)
                        rows += found
                    elif depth == _HOLDER:
                        rows.append((i + k, _ID, number + 1, text))
                    elif depth == _TOP:
                        rows.append((i + k, _STRING, number, text))
                odd, i = int(odd + closing.sum()) % 2, i + len(texts)
                if rows:
                    columns = dict(zip(("i", "kind", "number", "text"), zip(*rows, strict=True), strict=True))
                    n = len(rows)
                    yield pa.RecordBatch.from_pydict({"file": [key[0]] * n, "block": [key[1]] * n, **{c: list(v) for c, v in columns.items()}})

    return session.shipped(known).mapInArrow(run, "file string, block long, i long, kind long, number long, text string")


def _unescaped(text):
    return F.from_json(F.concat(F.lit('{"t":"'), text, F.lit('"}')), "t string")["t"]


def _examples(spark: SparkSession, fragments: DataFrame, system: str | None) -> DataFrame:
    counts = fragments.filter(F.col("kind") == _EXAMPLE).groupBy("file", "block").agg(F.max("number").alias("n"))
    blocks = fragments.select("file", "block").distinct().join(counts, ["file", "block"], "left")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = session.materialize(blocks.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")))
    placed = fragments.join(offsets, ["file", "block"]).select("file", F.struct("block", "i").alias("place"), "kind", (F.col("earlier") + F.col("number")).alias("number"), "text")

    # the strings at the top, whole: keys, and values where a colon stands before
    order = Window.partitionBy("file").orderBy("place")
    gap = F.when(F.col("kind") == _GAP, F.col("text"))
    top = placed.filter(F.col("kind").isin(_STRING, _GAP)).withColumns({"gap": F.count(gap).over(order), "mark": F.last(gap, True).over(order)})
    strings = top.filter(F.col("kind") == _STRING).groupBy("file", "gap", "mark").agg(
        F.min("place").alias("place"), F.min("number").alias("number"), _joined(_STRING).alias("text")
    )
    value = F.when(F.lead("mark").over(order) == ":", F.lead("text").over(order))
    keys = strings.withColumn("value", value).filter(F.col("mark") != ":")
    keys = keys.withColumn("end", F.lead("place").over(order))
    heads = keys.groupBy("file").agg(
        F.max(F.when(F.col("text") == "system", F.struct("place", "value"))).alias("system"),
        F.max(F.when(F.col("text") == "examples", F.struct("place", "end", "number"))).alias("range"),
    )
    missing = F.raise_error(F.concat(F.lit("no examples in "), F.col("file")))
    heads = fragments.select("file").distinct().join(heads, "file", "left").select(
        "file", F.coalesce(_unescaped(F.col("system.value")), F.lit(system).cast("string")).alias("system"),
        F.coalesce("range.number", missing.cast("long")).alias("before"), F.col("range.place").alias("begin"), F.col("range.end").alias("end"),
    )
    heads = session.materialize(heads)
    heads = F.broadcast(heads) if _is_few(heads) else heads
    held = placed.filter(F.col("kind").isin(_EXAMPLE, _ID)).join(heads, "file")
    held = held.filter((F.col("place") > F.col("begin")) & (F.col("end").isNull() | (F.col("place") < F.col("end"))))
    found = held.groupBy("file", "system", (F.col("number") - F.col("before") - 1).cast("int").alias("pos")).agg(
        _joined(_EXAMPLE).alias("example"), _joined(_ID).alias("id")
    )
    read = F.from_json("example", schemas.EXAMPLE, {"mode": "FAILFAST"})
    rows = found.filter("example IS NOT NULL").select("file", "system", "pos", _unescaped(F.col("id")).alias("id"), read.alias("e"))
    return _last_of_equal_ids(session.materialize(rows)).select(
        "file", "system", "pos", F.coalesce("id", F.col("pos").cast("string")).alias("example_id"), "e.prompt", "e.answer"
    )


def _is_few(table: DataFrame) -> bool:
    return table.limit(_FEW + 1).count() <= _FEW


def _joined(kind: int):
    """The pieces of a kind as the text they were cut from, null without any."""
    mine = F.collect_list(F.when(F.col("kind") == kind, F.struct("place", "text")))
    return F.when(F.size(mine) > 0, F.array_join(F.transform(F.array_sort(mine), lambda x: x["text"]), '"'))


def _last_of_equal_ids(rows: DataFrame) -> DataFrame:
    """Of examples with the same id the last one counts, in the place of the first."""
    repeated = rows.filter("id IS NOT NULL").groupBy("file", "id").agg(F.count("*").alias("n"), F.min("pos").alias("first"), F.max("pos").alias("last")).filter("n > 1")
    repeated = session.materialize(repeated)
    if repeated.isEmpty():
        return rows
    marked = rows.join(repeated, ["file", "id"], "left").filter("last IS NULL OR pos = last")
    return scans.ordinal(marked.withColumn("pos", F.coalesce("first", "pos")), ["file"], "pos", "id", "_pos").withColumn("pos", F.col("_pos").cast("int"))
