"""Encoding to pieces by a streaming Viterbi search, and decoding.

The ids of a text are the path of the highest sum of piece scores; of equal paths that whose last piece is the longer. A character that is
no piece costs less than any piece and is spelt in byte pieces (or is the unknown piece, in a model without them). The search keeps a
window of positions as long as the longest piece, traces the surviving paths back, and commits what lies before the boundary on which
all of them converge; so memory does not grow with the text, unless paths never meet.

No piece of the usual models goes on past a word into a space; paths always converge there. Words are therefore searched once each and
their ids kept, up to a bound. A model with pieces across that boundary is searched text by text.

The vocabulary file is a parameter and goes to the tasks as a broadcast of a few hundred kB. Its normaliser must be the identity: a
space is put before the text if the model asks for it, and U+2581 counts as a space. Decoding gives the text back with that one
change. Null texts count as empty and have no ids; rows are independent, so repeated ids and extra columns play no part.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from talkloom.llm.tables import shipped

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Words whose ids a worker keeps.
KEPT_WORDS = 600_000
#: A word longer than this is not kept.
_LONG_WORD = 64
#: How far below the lowest score a character lies that is no piece.
_UNKNOWN = 10.0
_SEGMENT = re.compile(r" *[^ ]+| +")


class _Words(dict):
    """Ids of words as packed int32, found when first asked for."""

    def __init__(self, codec: Codec):
        super().__init__()
        self._codec = codec

    def __missing__(self, word: str) -> bytes:
        text = word.replace(" ", SPACE)
        ids = array("i", self._codec.search_short(text) if len(text) <= 2 * self._codec.longest else self._codec.search(text)).tobytes()
        if len(word) <= _LONG_WORD:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = ids
        return ids


class Codec:
    """Encoder and decoder of one model."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models with the identity normaliser are supported")
        lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(lib.vocab_size())
        self.prefix = proto.normalizer_spec.add_dummy_prefix
        plain = [i for i in ids if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        self.pieces = {lib.id_to_piece(i): (i, lib.get_score(i)) for i in reversed(plain)}
        # pieces by text, and None for what pieces begin with
        self._begun: dict[str, tuple[int, float] | None] = {p[:n]: None for p in self.pieces for n in range(1, len(p))}
        self._begun.update(self.pieces)
        self.longest = max((len(p) for p in self.pieces), default=1)
        self.bytes = {int(lib.id_to_piece(i)[3:5], 16): i for i in ids if lib.is_byte(i)}
        self.unknown = lib.unk_id()
        self.unknown_score = min((s for _, s in self.pieces.values()), default=0.0) - _UNKNOWN
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        texts = [bytes([int(lib.id_to_piece(i)[3:5], 16)]) if lib.is_byte(i) else b"" if lib.is_control(i) else " ⁇ ".encode() if lib.is_unknown(i) else lib.id_to_piece(i).replace(SPACE, " ").encode() for i in ids]
        self.texts = pa.array(texts, pa.large_binary())
        self._words = _Words(self)

    def _spelt(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode()] if len(self.bytes) == 256 else [self.unknown]

    def search(self, text: str) -> Iterator[int]:
        """Ids of the best path; text has its spaces replaced already."""
        get, longest = self.pieces.get, self.longest
        base, scores, back = 0, [0.0], [0]  # of positions base, base + 1, ...
        look = 2 * longest
        for end in range(1, len(text) + 1):
            best, source = None, 0
            for start in range(max(base, end - longest), end):
                hit = get(text[start:end])
                if hit is None:
                    if start < end - 1:
                        continue
                    score = scores[start - base] + self.unknown_score
                else:
                    score = scores[start - base] + hit[1]
                if best is None or score > best:
                    best, source = score, start
            scores.append(best)
            back.append(source)
            if end - base >= look:
                meet = self._meeting(range(max(base, end - longest + 1), end + 1), base, back)
                if meet > base:
                    yield from self._path(text, base, meet, back)
                    del scores[: meet - base], back[: meet - base]
                    base, look = meet, 2 * longest
                else:
                    look = 2 * (end - base)
        yield from self._path(text, base, len(text), back)

    def search_short(self, text: str) -> list[int]:
        """The same for a text within the window, from each position on as far as any piece goes."""
        get, n = self._begun.get, len(text)
        scores: list[float | None] = [0.0] + [None] * n
        back, names = [0] * (n + 1), [-1] * (n + 1)
        for start in range(n):
            score, single, stop = scores[start], False, start + 1
            while stop <= n:
                hit = get(text[start:stop], 0)
                if hit == 0:
                    break
                if hit is not None:
                    total, known = score + hit[1], scores[stop]
                    if known is None or total > known:
                        scores[stop], back[stop], names[stop] = total, start, hit[0]
                    single = single or stop == start + 1
                stop += 1
            if not single:
                total, known = score + self.unknown_score, scores[start + 1]
                if known is None or total > known:
                    scores[start + 1], back[start + 1], names[start + 1] = total, start, -1
        out: list[int] = []
        while n:
            start = back[n]
            out += [names[n]] if names[n] >= 0 else reversed(self._spelt(text[start:n]))
            n = start
        out.reverse()
        return out

    @staticmethod
    def _meeting(ends: range, base: int, back: list[int]) -> int:
        """The last boundary that the paths to all of the ends go through."""
        alive = set(ends)
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(back[last - base])
        return alive.pop()

    def _path(self, text: str, base: int, end: int, back: list[int]) -> list[int]:
        cuts = [end]
        while cuts[-1] > base:
            cuts.append(back[cuts[-1] - base])
        out: list[int] = []
        for stop, start in zip(reversed(cuts[:-1]), reversed(cuts[1:]), strict=True):
            hit = self.pieces.get(text[start:stop])
            out += [hit[0]] if hit else self._spelt(text[start:stop])
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids as packed int32."""
        if not text:
            return b""
        text = text.replace(SPACE, " ")
        text = " " + text if self.prefix else text
        if not self.by_word:
            return np.fromiter(self.search(text.replace(" ", SPACE)), np.int32).tobytes()
        return b"".join(map(self._words.__getitem__, _SEGMENT.findall(text)))

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of consecutive stretches of ids, each up to its end."""
        offsets = pa.array(np.append(0, ends), pa.int64())
        joined = pc.binary_join(pa.LargeListArray.from_arrays(offsets, self.texts.take(pa.array(ids))), pa.scalar(b"", pa.large_binary()))
        texts = [raw[1:] if self.prefix and raw[:1] == b" " else raw for raw in joined.to_pylist()]
        return pa.array([raw.decode(errors="replace") for raw in texts], pa.string())


@lru_cache(4)
def codec(model: bytes) -> Codec:
    return Codec(model)


def round_trip(docs: DataFrame, model_file: str = MODEL, rows: int = 256) -> DataFrame:
    """doc_id, ids, n_ids, decoded: a map over the documents."""
    with open(model_file, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        # the name is looked up in the worker, where the codec stays from task to task
        from talkloom.llm.sentencepiece import codec as kept

        own = kept(model.value)
        for whole in batches:
            for at in range(0, len(whole), rows):
                batch = whole.slice(at, rows)
                packed = [own.encode(t) for t in batch.column("text").to_pylist()]
                ids = np.frombuffer(b"".join(packed), np.int32)
                ends = np.cumsum([len(p) // 4 for p in packed])
                offsets = pa.array(np.append(0, ends), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.array(np.diff(np.append(0, ends)), pa.int32()), own.decode(ids, ends)], ["doc_id", "ids", "n_ids", "decoded"])

    return shipped(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>, n_ids int, decoded string")
