"""Toxic spans by a linear-chain conditional random field; document scores from its marginals.

Tokens are words; a token's features are the hashes of its whole form and of its beginnings of 4 to 10 bytes, ASCII capitals in lower
case. The chain has two states (clean, toxic). Forward-backward gives the marginal of the toxic state for every token of every whole
text; tokens of at least SPAN_ODDS are offending, and neighbours join into spans. A document's score is a logistic function of its
marginals (the largest log-odds, and the logarithm of the expected number of toxic tokens), fitted on the sample.

Only labelled rows outside the held-out fold are learnt from, at most `sample_rows` of each label, chosen by a hash of doc_id. As labels
are of documents, tokens are labelled by beginnings that tell toxic documents from clean ones: those with enough distinct surroundings
in toxic documents and few clean documents. Words that only copies of one document share have one surrounding and do not count.

The model is a table of 2^18 weights and a few numbers, whatever the size of the corpus; it goes to every task with the function.
Null and empty texts have no tokens and get the score of no evidence. Repeated doc_ids are scored each. Labels that are null are left
out. Without labels of both kinds all scores are 0. Extra columns are ignored by `score` and kept by `clean_documents`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.llm import buffers
from talkloom.llm.tables import free_names, shipped

SAMPLE_ROWS = 2000
FOLDS = 5
BITS = 18
#: Lengths in bytes of the beginnings that are features, besides the whole word.
BEGINNINGS = tuple(range(4, 11))
ROUNDS = 15
SPAN_ODDS = 0.5
#: Smaller marginals do not add up to evidence, so that a long text is not toxic for its length.
FAINT = 0.3
#: Of a beginning that marks toxic tokens: distinct surroundings, share of toxic among its documents, and how far the count of toxic
#: documents lies above the expected one, in standard deviations.
MARK_AROUND, MARK_SHARE, MARK_DEVIATIONS = 6, 0.75, 5.0

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_START = np.array([0.98, 0.02])


@dataclass
class Model:
    weights: np.ndarray  # toxic minus clean score of a token, summed over its features
    chain: np.ndarray  # log scores of clean-clean, clean-toxic, toxic-clean, toxic-toxic
    bias: float
    aggregate: np.ndarray  # of the document score: constant, largest log-odds, log of the expected number

    @staticmethod
    def empty() -> Model:
        return Model(np.zeros(1 << BITS, np.float32), np.zeros(4), -50.0, np.array([-50.0, 0.0, 0.0]))


def held_out(doc_id: Column) -> Column:
    """The fold that is never learnt from."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == 0


def tokens(texts: buffers.Texts) -> tuple[buffers.Runs, np.ndarray, np.ndarray]:
    """Words of a chunk, their hashes, and their features: a row for each token, -1 where a beginning would be the whole word or longer."""
    lower = buffers.Texts(buffers.LOWER[texts.data], texts.starts, texts.ends, texts.first)
    found = buffers.runs(lower, _WORD)
    hasher, length = buffers.Hasher(lower.data), found.ends - found.starts
    shift = np.uint64(64 - BITS)
    features = np.full((len(length), 1 + len(BEGINNINGS)), -1, np.int32)
    whole = hasher(found.starts, found.ends)
    features[:, 0] = whole >> shift
    for i, n in enumerate(BEGINNINGS, 1):
        longer = length > n
        features[longer, i] = hasher(found.starts[longer], found.starts[longer] + n) >> shift
    return found, whole, features


def emissions(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    padded = np.append(weights, np.float32(0))  # -1 takes the zero at the end
    return padded[features].sum(axis=1, dtype=np.float64)


def _scan(steps: tuple[np.ndarray, ...]) -> np.ndarray:
    """For every i the ratio of the two entries of (1, 1) @ steps[0] @ ... @ steps[i]; steps are the entries 00, 01, 10, 11 of matrices.

    Cost grows with the tokens, not with the longest text: blocks are multiplied side by side, then joined one after the other.
    """
    n = len(steps[0])
    width = max(1, int(np.sqrt(n)))
    blocks = -(-n // width)
    fill = (1.0, 0.0, 0.0, 1.0)
    a, b, c, d = (np.concatenate([x, np.full(blocks * width - n, y)]).reshape(blocks, width).T.copy() for x, y in zip(steps, fill, strict=True))
    p, q, r, s = a[0], b[0], c[0], d[0]
    for j in range(1, width):
        p, q, r, s = p * a[j] + q * c[j], p * b[j] + q * d[j], r * a[j] + s * c[j], r * b[j] + s * d[j]
        scale = 1 / np.maximum(np.maximum(p, q), np.maximum(r, s))
        p, q, r, s = p * scale, q * scale, r * scale, s * scale
    before, ratio = np.empty(blocks), 1.0
    for i, (w, x, y, z) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist(), strict=True)):
        before[i] = ratio
        ratio = (x + ratio * z) / (w + ratio * y)
    out = np.empty((width, blocks))
    for j in range(width):
        before = (b[j] + before * d[j]) / (a[j] + before * c[j])
        out[j] = before
    return out.T.reshape(-1)[:n]


def marginals(emission: np.ndarray, rows: np.ndarray, chain: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray]:
    """Of each token: the probability of the toxic state, and of the four transitions into it (0 for a text's first token).

    All texts of a chunk are one chain in which the step into a new text forgets the state before.
    """
    n = len(emission)
    if not n:
        return np.zeros(0), np.zeros((0, 4))
    new = np.ones(n, bool)
    new[1:] = rows[1:] != rows[:-1]
    odds = np.clip(emission + bias, -30, 30)
    clean, bad = np.exp(np.minimum(0, -odds)), np.exp(np.minimum(0, odds))
    t = np.exp(chain - chain.max())
    forward = _scan(tuple(np.where(new, _START[k % 2], t[k]) * (bad if k % 2 else clean) for k in range(4)))
    # backward[i] is the ratio for what follows i; before a new text it is 1
    backward = np.ones(n)
    if n > 1:
        cut = new[1:][::-1]
        follow = [np.where(cut, 1.0, t[k] * (bad if k % 2 else clean)[1:][::-1]) for k in (0, 2, 1, 3)]
        backward[:-1] = _scan(tuple(follow))[::-1]
        backward[:-1][new[1:]] = 1.0
    toxic = forward * backward / (1 + forward * backward)
    pair = np.zeros((n, 4))
    inner = np.flatnonzero(~new)
    if len(inner):
        f, g = forward[inner - 1], backward[inner]
        joint = np.stack([t[0] * clean[inner], t[1] * bad[inner] * g, f * t[2] * clean[inner], f * t[3] * bad[inner] * g], axis=1)
        pair[inner] = joint / joint.sum(axis=1, keepdims=True)
    return toxic, pair


def evidence(toxic: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Of each text: the largest log-odds of a token and the logarithm of the expected number of toxic tokens."""
    clipped = np.clip(toxic, 1e-9, 1 - 1e-9)
    top, total = np.full(n, 1e-9), np.full(n, 0.1)
    np.maximum.at(top, rows, clipped)
    total += np.bincount(rows, np.where(toxic >= FAINT, toxic, 0), n)
    return np.stack([np.ones(n), np.log(top / (1 - top)) / 5, np.log(total)], axis=1)


@dataclass
class _Sample:
    """Tokens of the sample: the word (a row of forms, its features) and the text of each."""

    forms: np.ndarray
    kind: np.ndarray
    rows: np.ndarray

    def steps(self, size: int = 1 << 17):
        """Slices of whole texts, so that temporary arrays stay small."""
        low = 0
        while low < len(self.rows):
            high = min(len(self.rows), low + size)
            high = int(np.searchsorted(self.rows, self.rows[high - 1], "right"))
            yield slice(low, high)
            low = high


def _sample(texts: pa.Array) -> _Sample:
    names, forms, rows = [], [], []
    for chunk in buffers.chunks(buffers.from_arrow(texts)):
        found, whole, features = tokens(chunk)
        fresh, at = np.unique(whole, return_index=True)
        names.append(whole)
        forms.append((fresh, features[at]))
        rows.append((found.rows + chunk.first).astype(np.int32))
    if not names:
        return _Sample(np.zeros((0, 1), np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32))
    every, at = np.unique(np.concatenate([n for n, _ in forms]), return_index=True)
    kind = np.concatenate([np.searchsorted(every, n).astype(np.int32) for n in names])
    return _Sample(np.concatenate([f for _, f in forms])[at], kind, np.concatenate(rows))


def _marks(sample: _Sample, label: np.ndarray) -> np.ndarray:
    """Flags of the features that mark toxic tokens, by the documents that hold them and their surroundings."""
    size, kind = 1 << BITS, sample.kind.astype(np.uint64)
    near = np.zeros(len(kind), np.uint64)
    near[1:] = kind[:-1] * np.uint64(31)
    near[:-1] += kind[1:]
    near = (buffers.mixed(near) >> np.uint64(40)).astype(np.int64)
    bad = label[sample.rows] == 1
    held = np.unique(sample.kind.astype(np.int64) << 32 | sample.rows)
    around_bad = np.unique(sample.kind[bad].astype(np.int64) << 24 | near[bad])
    toxic_docs, docs, around = (np.zeros(size) for _ in range(3))
    for column in sample.forms.T:
        feature = column[held >> 32].astype(np.int64)
        pairs = np.unique((feature << 32 | held & 0xFFFFFFFF)[feature >= 0])
        docs += np.bincount(pairs >> 32, minlength=size)
        toxic_docs += np.bincount(pairs >> 32, label[pairs & 0xFFFFFFFF], size)
        feature = column[around_bad >> 24].astype(np.int64)
        seen = np.unique((feature << 24 | around_bad & 0xFFFFFF)[feature >= 0])
        around += np.bincount(seen >> 24, minlength=size)
    base = label.mean()
    spread = np.sqrt(np.maximum(docs * base * (1 - base), 1e-9))
    return (around >= MARK_AROUND) & (toxic_docs >= MARK_SHARE * docs) & (toxic_docs - base * docs >= MARK_DEVIATIONS * spread)


def fit(texts: pa.Array, label: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Maximum likelihood of the token labels with a quadratic penalty, by scaled gradient steps."""
    sample = _sample(texts)
    rows, kind, forms = sample.rows, sample.kind, sample.forms
    if not len(rows) or not label.any() or label.all():
        return Model.empty()
    marked = np.append(_marks(sample, label), False)[forms].any(axis=1)
    tagged = marked[kind] & (label[rows] == 1)
    size, n = 1 << BITS, len(forms)
    flat, where = forms[forms >= 0], np.nonzero(forms >= 0)[0]
    model = Model(np.zeros(size, np.float32), np.log(np.array([0.98, 0.02, 0.9, 0.1])), -3.0, np.zeros(3))
    prior = np.zeros(size)
    inner = rows[1:] == rows[:-1]
    seen_pairs = np.bincount((tagged[:-1].astype(int) * 2 + tagged[1:])[inner], minlength=4).astype(float)
    for _ in range(rounds):
        by_form, gaps, curves, found = emissions(model.weights, forms), np.zeros(n), np.zeros(n), np.zeros(4)
        for part in sample.steps():
            p, pair = marginals(by_form[kind[part]], rows[part], model.chain, model.bias)
            gaps += np.bincount(kind[part], tagged[part] - p, n)
            curves += np.bincount(kind[part], p * (1 - p), n)
            found += pair.sum(axis=0)
        push = np.bincount(flat, gaps[where], size) - 0.05 * model.weights
        prior = 0.5 * prior + push / (np.bincount(flat, curves[where], size) * forms.shape[1] + 1.0)
        model.weights = np.clip(model.weights + prior, -8, 8).astype(np.float32)
        model.bias += float(np.clip(gaps.sum() / (curves.sum() + 1), -0.5, 0.5))
        model.chain = np.clip(model.chain + 0.3 * np.log((seen_pairs + 1) / (found + 1)), -12, 4)
    by_form = emissions(model.weights, forms)
    toxic = np.concatenate([marginals(by_form[kind[part]], rows[part], model.chain, model.bias)[0] for part in sample.steps()])
    model.aggregate = _logistic(evidence(toxic, rows, len(label)), label)
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps. Both labels weigh as they stand in the sample."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - 0.1 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.linalg.solve(hess, grad)
    return w


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most sample_rows labelled documents of each label, whole texts. The sample is bounded, so it goes to the driver."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_toxic")).filter("_id IS NOT NULL AND _toxic IN (0, 1)")
    known = known.filter(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    order = F.xxhash64("_id")
    known = known.filter("_toxic = 1").orderBy(order, "_id").limit(sample_rows).union(known.filter("_toxic = 0").orderBy(order, "_id").limit(sample_rows))
    sample = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
    sample = sample.groupBy("_id").agg(F.max("text").alias("text"), F.max("_toxic").alias("_toxic")).toArrow().sort_by("_id")
    return fit(sample["text"].combine_chunks(), sample["_toxic"].to_numpy().astype(np.int64))


def _spans(found: buffers.Runs, toxic: np.ndarray, texts: buffers.Texts) -> list[str]:
    """start:end of offending stretches in code points, comma-joined, for each text of the chunk."""
    out: list[list[str]] = [[] for _ in range(len(texts))]
    bad = np.flatnonzero(toxic >= SPAN_ODDS)
    if len(bad):
        points = buffers.code_points(texts.data)
        fresh = np.ones(len(bad), bool)
        fresh[1:] = (np.diff(bad) > 1) | (np.diff(found.rows[bad]) != 0)
        last = np.append(np.flatnonzero(fresh)[1:] - 1, len(bad) - 1)
        for a, b in zip(bad[fresh], bad[last], strict=True):
            row = found.rows[a]
            base = points[texts.starts[row]]
            out[row].append(f"{points[found.starts[a]] - base}:{points[found.ends[b]] - base}")
    return [",".join(x) for x in out]


def score_texts(model: Model, column: pa.Array) -> tuple[np.ndarray, list[str]]:
    scores, spans = [np.zeros(0)], []
    for chunk in buffers.chunks(buffers.from_arrow(column)):
        found, _, features = tokens(chunk)
        toxic, _ = marginals(emissions(model.weights, features), found.rows, model.chain, model.bias)
        z = evidence(toxic, found.rows, len(chunk)) @ model.aggregate
        scores.append(1 / (1 + np.exp(-np.clip(z, -50, 50))))
        spans += _spans(found, toxic, chunk)
    return np.concatenate(scores), spans


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, spans. A map over the documents: nothing is shuffled."""

    def run(batches):
        for batch in batches:
            scores, spans = score_texts(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, pa.string())], ["doc_id", "score", "spans"])

    return shipped(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, spans string")


@free_names("doc_id", "text")
def clean_documents(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The documents that score below the limit, all their columns. The score is computed beside the text, so no join is needed."""
    fields = docs.schema

    def run(batches):
        for batch in batches:
            scores, _ = score_texts(model, batch.column(batch.schema.get_field_index("text")))
            yield batch.filter(pa.array(scores < limit))

    return shipped(docs).mapInArrow(run, fields)
