"""Line dedup by log templates: a tree of fixed depth over token count and leading tokens, and templates matched in its leaves.

A line's tokens are its words; a token that holds a digit is a variable field. The tree's path of a line is its token count and its
first tokens, variable fields as one wildcard; where a path ends, in a leaf, are all lines that share it. Within a leaf a token is
constant if at least two documents have it there at that place, any other is a variable field as well, whatever its place. A line's
template is its leaf with its constant tokens and their places. Templates need `CONSTANT` constant tokens that make up
`CONSTANT_SHARE` of all, so rows of numbers are no template. Every line is also its own template, with no variable field.

A template recurs if enough documents have it: two if it has `LONG` constant tokens, three if it has fewer. A line below `CONSTANT`
tokens recurs only as itself and from `SHORT_DOCS` documents and `SHORT_SHARE` of all rows on, since short lines recur by chance. Of the
lines of a recurring template those of the smallest doc_id stay and all others are dropped.

Paths, tokens of shared leaves and templates are each counted over all documents by shards (see shards.py): a leaf, however
full, is never in one task.

Lines are separated by "\n"; those that stay are joined again by it. Null text is left null and has no lines. Rows of equal doc_id
are one document. Documents that lose nothing are returned as they were, others with their new text and n_chars, if there is such a
column; all rows and columns are kept. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from talkloom.llm import buffers, shards
from talkloom.llm.tables import free_names

#: Leading tokens of a path; `parsed` combines the first two.
LEADING = 2
#: Constant tokens that a template must have, and their share of its tokens.
CONSTANT = 4
CONSTANT_SHARE = 0.6
#: Constant tokens from which two documents are enough.
LONG = 8
FEW_DOCS, LONG_DOCS = 3, 2
#: Documents, and their share of all rows, from which lines of fewer tokens than CONSTANT recur.
SHORT_DOCS, SHORT_SHARE = 10, 0.002

_LINE = np.ones(256, bool)
_LINE[10] = False
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_WILDCARD = np.uint64(0x5851F42D4C957F2D)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_EXACT, _LEAF, _TEMPLATE = (np.uint64(x) for x in (1, 2, 3))


@dataclass
class Parsed:
    """The lines of a chunk that hold tokens: `lines` has all lines, `at` the index there; the rest is an entry a line or a token."""

    lines: buffers.Runs
    at: np.ndarray
    first: np.ndarray
    count: np.ndarray
    leaf: np.ndarray
    token: np.ndarray
    place: np.ndarray
    masked: np.ndarray
    field: np.ndarray

    def rows(self) -> np.ndarray:
        return self.lines.rows[self.at]

    def long(self) -> np.ndarray:
        return self.count >= CONSTANT

    def exact(self) -> np.ndarray:
        """Key of every line as it is."""
        return buffers.mixed(np.add.reduceat(buffers.mixed(self.token + self.place), self.first) + _EXACT)

    def constants_of(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lines and keys (leaf, place, token) of the tokens that are no fields in the chosen lines."""
        tokens = np.flatnonzero(np.repeat(chosen, self.count) & ~self.field)
        line = np.searchsorted(self.first, tokens, "right") - 1
        return line, buffers.mixed(self.masked[tokens] + self.leaf[line])

    def templates(self, constant: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Template of every line from the keys of constant tokens, its number of constant tokens, and whether it is one."""
        chosen = self.long()
        for i in range(LEADING):
            # all documents of a leaf share its leading tokens: if one of them is not constant, none is
            lines = np.flatnonzero(chosen)
            tokens = self.first[lines] + i
            single = ~shards.looked_up(constant, buffers.mixed(self.masked[tokens] + self.leaf[lines]))[0] & ~self.field[tokens]
            chosen[lines[single]] = False
        line, keys = self.constants_of(chosen)
        held = shards.looked_up(constant, keys)[0]
        line, keys = line[held], keys[held]
        total, n = np.zeros(len(self.first), np.uint64), np.bincount(line, minlength=len(self.first))
        if len(line):
            begins = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
            total[line[begins]] = np.add.reduceat(buffers.mixed(keys + _TEMPLATE), begins)
        return buffers.mixed(total + self.leaf * _STEP + _TEMPLATE), n, (n >= CONSTANT) & (n >= CONSTANT_SHARE * self.count)


def parsed(texts: buffers.Texts) -> Parsed | None:
    """None if there are no tokens."""
    lines, words = buffers.runs(texts, _LINE), buffers.words(texts)
    if not len(words.starts):
        return None
    token = buffers.Hasher(texts.data)(words.starts, words.ends)
    field = np.zeros(len(token), bool)
    field[np.searchsorted(words.starts, np.flatnonzero(_DIGIT[texts.data]), "right") - 1] = True
    begins = np.searchsorted(words.starts, lines.starts)
    counts = np.diff(np.append(begins, len(token)))
    at = np.flatnonzero(counts)
    first, count = begins[at], counts[at]
    place = (np.arange(1, len(token) + 1) - np.repeat(first, count)).astype(np.uint64) * _STEP
    masked = buffers.mixed(np.where(field, _WILDCARD, token) + place)
    second = np.where(count > 1, masked[first + (count > 1)], 0).astype(np.uint64)
    leaf = buffers.mixed(masked[first] + second + count.astype(np.uint64) * _STEP + _LEAF)
    return Parsed(lines, at, first, count, leaf, token, place, masked, field)


_NONE = np.zeros(0, np.uint64), np.zeros(0, np.int64)


def _lines_and_leaves(texts: buffers.Texts) -> tuple[np.ndarray, np.ndarray]:
    p = parsed(texts)
    if p is None:
        return _NONE
    return np.concatenate([p.exact(), p.leaf[p.long()]]), np.concatenate([p.rows(), p.rows()[p.long()]])


def _tokens(texts: buffers.Texts, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = parsed(texts)
    if p is None:
        return _NONE
    line, keys = p.constants_of(p.long() & shards.looked_up(shared, p.leaf)[0])
    return keys, p.rows()[line]


def _templates(texts: buffers.Texts, constant: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = parsed(texts)
    if p is None:
        return _NONE
    names, _, enough = p.templates(constant)
    return names[enough], p.rows()[enough]


def _later(p: Parsed, ids: np.ndarray, names: np.ndarray, docs: np.ndarray, least: np.ndarray, short_docs: int) -> np.ndarray:
    """Which lines a document of a smaller id has already, as themselves or by their template, and enough documents have."""

    def recurs(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        hit, at = shards.looked_up(names, keys)
        hit[hit] = (docs[at[hit]] >= wanted[hit]) & (least[at[hit]] < ids[hit])
        return hit

    template, n, enough = p.templates(names)
    exact = recurs(p.exact(), np.where(p.count >= LONG, LONG_DOCS, np.where(p.long(), FEW_DOCS, short_docs)))
    return exact | (enough & recurs(template, np.where(n >= LONG, LONG_DOCS, FEW_DOCS)))


def _replaced(table: pa.Table, name: str, mask: np.ndarray, values: pa.Array) -> pa.Table:
    """The column with its masked rows replaced, in order."""
    kind = table.schema.field(name).type
    column = pc.replace_with_mask(table.column(name).combine_chunks(), pa.array(mask), values.cast(kind))
    return table.set_column(table.schema.get_field_index(name), pa.field(name, kind), column)


@free_names("doc_id", "text", "n_chars")
def dedup(docs: DataFrame, shard_bytes: int | None = None) -> DataFrame:
    """docs without the recurring lines of all but the first document of each template, same columns."""
    n = shards.shard_count(docs, shard_bytes)
    short_docs = max(SHORT_DOCS, math.ceil(SHORT_SHARE * docs.count()))
    spread = shards.sharded(docs, n)
    shared = shards.shared_keys(spread, _lines_and_leaves, n)
    constant = shards.shared_keys(spread, _tokens, n, with_least=False, known=shared)
    recurring = shards.shared_keys(spread, _templates, n, known=constant)

    def drop(table: pa.Table, got: pa.Table) -> pa.Table:
        if not len(table):
            return table.drop_columns("_shard")
        names, held, least = shards.merged(got)
        ids = shards.doc_ids(table)
        column = table.column("text")
        rows, fresh, texts = [], [], buffers.from_arrow(column)
        for chunk in buffers.chunks(texts):
            found = parsed(chunk)
            if found is None:
                continue
            lines = found.lines
            later = np.zeros(len(lines.starts), bool)
            later[found.at[_later(found, ids[found.rows() + chunk.first], names, held, least, short_docs)]] = True
            gone = set(lines.starts[later].tolist())
            for row in np.unique(lines.rows[later]).tolist():
                start = int(chunk.starts[row])
                pieces = chunk.data[start : chunk.ends[row]].tobytes().split(b"\n")
                begins = accumulate((len(p) + 1 for p in pieces), initial=start)
                rows.append(chunk.first + row)
                fresh.append(b"\n".join(p for p, begin in zip(pieces, begins, strict=False) if begin not in gone).decode())
        if rows:
            mask = np.zeros(len(table), bool)
            mask[rows] = True
            table = _replaced(table, "text", mask, pa.array(fresh, pa.string()))
            if "n_chars" in table.column_names and pa.types.is_integer(table.schema.field("n_chars").type):
                table = _replaced(table, "n_chars", mask, pa.array([len(x) for x in fresh], pa.int64()))
        return table.drop_columns("_shard")

    return shards.with_shared(spread, shared.unionByName(constant).unionByName(recurring), drop, docs.schema)
