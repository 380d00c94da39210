"""Spelling variants: words one edit apart, grouped under their most frequent forms, by blocked Gram matrices.

A word is a row of letter counts. The squared distance of two rows is |a|^2 + |b|^2 - 2 a b, a NumPy product of two blocks with the squares
as two more columns. One replaced letter gives a distance of 2 in a block of equal length, one inserted or deleted letter a distance of 1 in
the block of the next length; so of every product the pairs at most two apart are kept, and their edits are verified place by place.

A block holds the words of one length, parted by how many letters of each of a few classes they have (code point modulo the number of classes).
An edit moves at most one letter between two classes, so a block meets only itself, the blocks with one letter more and those with one letter in another
class: every other pair of blocks is farther apart than two. The number of classes grows with the logarithm of the words, which keeps blocks about equally large.
Blocks are cut into tiles bounded in words and characters, and a tile of one block with a tile of its neighbours is one task's work. Every pair is met once.

A word's form is its near word of largest n (ties: smallest in code-point order), if that n is at least `factor` times its own. Forms are followed to
the last one by doubling steps; as n grows by `factor` each time, the logarithm of the largest n bounds the steps.

Null texts have no words; equal words are one; an empty table gives no rows. Words of any length and of any letters take part. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, log, log2, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.llm.tables import few, shipped, written

#: Code points of a word, compared as they are after A-Z was lower-cased.
WORD = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT = 7, 2
FACTOR = 10
#: Words and characters of a tile, and of the neighbours that it meets at a time; squared distances held at a time.
TILE_WORDS, NEAR_WORDS, TILE_CHARS = 2048, 16_384, 1 << 20
CELLS = 1 << 22

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTERS = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]


def lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, _CAPITALS, _CAPITALS.lower())


def counted(docs: DataFrame, change: Callable[[Column, Column], Column] | None = None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words of all texts. `change` gives the word to count for (doc_id, lower-cased word); it may shorten it, but not lengthen it."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= least_length).select("doc_id", lower(F.col("run")).alias("word"))
    if change is not None:
        runs = runs.select(change(F.col("doc_id"), F.col("word")).alias("word")).filter(F.length("word") >= least_length)
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def class_counts(word: Column, classes: int) -> list[Column]:
    """How many letters of each class a word has; letters outside the alphabet are of the last one."""
    size = F.length(word)
    of = [size - F.length(F.translate(word, "".join(x for x in _LETTERS if ord(x) % classes == k), "")) for k in range(classes - 1)]
    last = size
    for c in of:
        last = last - c
    return [*of, last]


def _key(counts: list[Column]) -> Column:
    return F.concat_ws(",", *[c.cast("string") for c in counts])


def _homes(counts: list[Column]) -> Column:
    """The blocks that a word is a neighbour of, its own first: those with a letter less, and those with a letter in a later class instead."""
    keys = [_key(counts)]
    for i in range(len(counts)):
        moves = [{i: -1}, *({i: -1, j: 1} for j in range(i + 1, len(counts)))]
        for move in moves:
            keys.append(F.when(counts[i] > 0, _key([c + move.get(k, 0) for k, c in enumerate(counts)])))
    return F.filter(F.array(*keys), lambda k: k.isNotNull())


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points as rows filled up with zeros, and lengths."""
    size = np.array([len(w) for w in words], np.int64)
    out = np.zeros((len(words), int(size.max(initial=0))), np.uint32)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    out[np.arange(out.shape[1])[None, :] < size[:, None]] = flat
    return out, size


def gram_rows(codes: np.ndarray, alphabet: np.ndarray, left: bool) -> np.ndarray:
    """Letter counts with their square and one, so that a left row times a right row is their squared distance."""
    row, place = np.nonzero(codes)
    of = np.searchsorted(alphabet, codes[row, place])
    counts = np.bincount(row * len(alphabet) + of, minlength=len(codes) * len(alphabet)).reshape(len(codes), len(alphabet))
    square = (counts * counts).sum(axis=1, keepdims=True)
    kind = np.float32 if square.max(initial=0) < 1 << 21 else np.float64
    one = np.ones_like(square)
    return np.hstack([square, one, -2 * counts] if left else [one, square, counts]).astype(kind)


def one_edit(a: np.ndarray, b: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Whether rows differ by one replaced letter, or, where b is one letter longer, by one inserted."""
    n = a.shape[1]
    same = a == b[:, :n]
    good = (~same).sum(axis=1) == 1
    if longer.any():
        ahead = np.logical_and.accumulate(same[longer], axis=1).sum(axis=1)
        behind = np.logical_and.accumulate((a[longer] == b[longer, 1 : n + 1])[:, ::-1], axis=1).sum(axis=1)
        good[longer] = ahead + behind >= n
    return good


def close_pairs(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs one edit apart. All left words have one length, right words that or one more."""
    if not left or not right:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    (a, _), (b, size) = letters(left), letters(right)
    n = a.shape[1]
    if b.shape[1] == n:
        b = np.pad(b, ((0, 0), (0, 1)))
    alphabet = np.unique(np.concatenate([np.unique(a), np.unique(b)]))
    alphabet = alphabet[alphabet > 0]
    of_a, of_b = gram_rows(a, alphabet, left=True), gram_rows(b, alphabet, left=False).T
    found = []
    step = max(1, CELLS // len(right))
    for at in range(0, len(left), step):
        i, j = np.nonzero(of_a[at : at + step] @ of_b <= 2)
        for part in range(0, len(i), max(1, CELLS // n)):
            x, y = i[part : part + max(1, CELLS // n)] + at, j[part : part + max(1, CELLS // n)]
            good = one_edit(a[x], b[y], size[y] > n)
            found.append((x[good], y[good]))
    return tuple(np.concatenate(f) for f in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def near(words: DataFrame, classes: int) -> DataFrame:
    """word, other, n_other for every two words one edit apart, both ways. words: distinct, written."""
    sized = written(words.select("word", "n", F.length("word").alias("size"), F.array(*class_counts(F.col("word"), classes)).alias("c")))
    counts = [F.col("c")[k] for k in range(classes)]
    sized = sized.select("word", "n", "size", _key(counts).alias("own"), _homes(counts).alias("homes"))
    blocks = sized.groupBy("own").agg(F.count(F.lit(1)).alias("n_words"), F.sum("size").alias("n_chars"))
    pulled = sized.select("size", F.explode("homes").alias("home")).groupBy("home").agg(F.count(F.lit(1)).alias("n_near"), F.sum("size").alias("n_near_chars"))
    tiles = lambda n, most, chars: F.ceil(F.greatest(F.col(n) / most, F.col(chars) / TILE_CHARS)).cast("int")
    blocks = blocks.join(pulled, F.col("own") == F.col("home")).select(
        "home", tiles("n_words", TILE_WORDS, "n_chars").alias("lefts"), tiles("n_near", NEAR_WORDS, "n_near_chars").alias("rights")
    )
    blocks = few(written(blocks))
    deal = lambda n: F.pmod(F.xxhash64("word"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = sized.join(blocks, F.col("own") == F.col("home")).select("home", deal("lefts").alias("l"), each("rights").alias("r"), "word", "n")
    right = sized.select("word", "n", "own", F.explode("homes").alias("to")).join(blocks, F.col("to") == F.col("home"))
    right = right.select("home", each("lefts").alias("l"), deal("rights").alias("r"), "word", "n", (F.col("own") == F.col("home")).alias("inside"))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        ours, others, inside = a.column("word").to_pylist(), b.column("word").to_pylist(), b.column("inside").to_pylist()
        x, y = close_pairs(ours, others)
        once = [i for i, (p, q) in enumerate(zip(x.tolist(), y.tolist(), strict=True)) if not inside[q] or ours[p] < others[q]]
        x, y = x[once], y[once]
        first, second = a.select(["word", "n"]).take(pa.array(x)), b.select(["word", "n"]).take(pa.array(y))
        both = [(first.column("word"), second), (second.column("word"), first)]
        return pa.concat_tables(pa.table({"word": w, "other": o.column("word"), "n_other": o.column("n")}) for w, o in both)

    keys = ["home", "l", "r"]
    return shipped(left).groupBy(*keys).cogroup(right.toDF(*right.columns).groupBy(*keys)).applyInArrow(run, "word string, other string, n_other long")


def variants(words: DataFrame, factor: int = FACTOR, classes: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n for distinct words with their counts n."""
    words = written(words.select("word", "n"))
    total = words.agg(F.count(F.lit(1)).alias("words"), F.max("n").alias("most")).first()
    classes = classes or max(3, round(log10(max(1, total["words"]))) - 1)
    best = near(words, classes).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_other")).alias("less"), F.col("other").alias("form"))).alias("best")
    )
    found = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))
    kept = F.col("form_n") >= factor * F.col("n")
    found = written(found.withColumns({"form": F.when(kept, F.col("form")), "form_n": F.when(kept, F.col("form_n"))}))
    roots = found.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    steps = log(max(1, total["most"] or 1), factor) + 1
    for _ in range(ceil(log2(steps))):
        roots = written(roots)
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
