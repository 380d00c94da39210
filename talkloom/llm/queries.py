"""All registered queries of this subpackage."""

from __future__ import annotations

from talkloom.llm import (
    q_chat,
    q_lines,
    q_mixing,
    q_negatives,
    q_passages,
    q_pii,
    q_sentencepiece,
    q_simhash,
    q_spelling,
    q_toxicity,
    q_urls,
    q_vectors,
)

QUERIES = {**q_vectors.QUERIES, **q_passages.QUERIES, **q_sentencepiece.QUERIES, **q_simhash.QUERIES, **q_lines.QUERIES, **q_pii.QUERIES, **q_chat.QUERIES, **q_toxicity.QUERIES, **q_mixing.QUERIES, **q_spelling.QUERIES, **q_urls.QUERIES, **q_negatives.QUERIES}
