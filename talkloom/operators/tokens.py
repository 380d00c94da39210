"""Vocabulary, encoding and length measurement."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom import constants as C
from talkloom.functions import arrays

WORD = r"[^ \n\t\r]+"

_ENTRIES_PER_BUCKET = 2


@dataclass(frozen=True)
class Vocabulary:
    """Tokens with ids. `table` has token, freq, token_id and at most `max_size` rows."""

    table: DataFrame
    max_size: int
    specials: tuple[str, ...]
    pattern: str = WORD

    def special_id(self, name: str) -> int:
        return self.specials.index(name)

    def with_specials(self) -> DataFrame:
        """All entries including the special ones, whose frequency is null."""
        spark = self.table.sparkSession
        rows = [(name, None, i) for i, name in enumerate(self.specials)]
        extra = spark.createDataFrame(rows, "token string, freq long, token_id int")
        return extra.unionByName(self.table)


def add_pad_token(specials: Sequence[str], pad: str = C.PAD_TOKEN) -> tuple[str, ...]:
    """T1. Specials with a pad token, added at the end when there is none."""
    return tuple(specials) if pad in specials else (*specials, pad)


SPECIALS = add_pad_token(("<unk>", "<s>", "</s>"))


def tokens_of(text: Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def build_vocab(
    docs: DataFrame,
    text: str,
    max_size: int,
    specials: Sequence[str] = SPECIALS,
    pattern: str = WORD,
) -> Vocabulary:
    """T1/A5. The `max_size` most frequent tokens; ids follow the special tokens.

    Counts are combined before the shuffle, so a frequent token is no hot key. Rows below the
    frequency that the last kept token has are dropped where they are, by a histogram of the
    frequencies, so that the final sort gets about `max_size` rows and not all distinct tokens.
    The histogram reads the same shuffled counts. Only the kept rows are numbered.
    """
    counts = (
        docs.select(F.explode(tokens_of(F.col(text), pattern)).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("freq"))
    )
    per_freq = counts.groupBy("freq").agg(F.count("*").alias("n"))
    at_least = F.sum("n").over(Window.orderBy(F.desc("freq")))
    enough = per_freq.select("freq", at_least.alias("n")).filter(F.col("n") >= max_size)
    lowest = enough.agg(F.coalesce(F.max("freq"), F.lit(0)))
    frequent = counts.filter(F.col("freq") >= lowest.scalar())
    kept = frequent.orderBy(F.desc("freq"), "token").limit(max_size)
    rank = F.row_number().over(Window.orderBy(F.desc("freq"), "token"))
    table = kept.select("token", "freq", (rank - 1 + len(specials)).alias("token_id"))
    return Vocabulary(table, max_size, tuple(specials), pattern)


def encode(
    df: DataFrame,
    vocab: Vocabulary,
    columns: Mapping[str, str],
    add_special: bool = False,
    unknown: str = "<unk>",
    bos: str = "<s>",
    limit: int | None = None,
) -> DataFrame:
    """T2. Add an array of ids for every text column; `columns` maps text column to output column.

    The vocabulary is one value that every task holds, at most `max_size` entries, so no text and no
    token is shuffled, whatever the size of the vocabulary.
    `add_special` puts BOS in front; leave it off for text that a chat template has marked already.
    With `limit` only that many tokens of a text are looked up, for rows that are cut there (T3).
    """
    buckets = max(1, -(-vocab.max_size // _ENTRIES_PER_BUCKET))
    unknown_id = vocab.special_id(unknown)
    with_vocab = df.withColumn("_vocab", _bucketed(vocab.table, buckets).scalar())

    def ids(text: str) -> Column:
        def look_up(token: Column) -> Column:
            bucket = F.get("_vocab", F.pmod(F.hash(token), F.lit(buckets)))
            return F.coalesce(F.element_at(bucket, token), F.lit(unknown_id))

        return F.transform(_limited_tokens(text, vocab, limit), look_up)

    encoded = with_vocab.withColumns({out: ids(text) for text, out in columns.items()}).drop("_vocab")
    return _with_bos(encoded, columns, vocab.special_id(bos)) if add_special else encoded


def _limited_tokens(text: str, vocab: Vocabulary, limit: int | None) -> Column:
    tokens = tokens_of(F.col(text), vocab.pattern)
    return tokens if limit is None else F.slice(tokens, 1, limit)


def _with_bos(df: DataFrame, columns: Mapping[str, str], bos_id: int) -> DataFrame:
    return df.withColumns({out: F.concat(F.array(F.lit(bos_id)), F.col(out)) for out in columns.values()})


def _bucketed(table: DataFrame, buckets: int) -> DataFrame:
    """The vocabulary as one row: an array of small maps, looked up by hash of the token."""
    spark = table.sparkSession
    number = F.pmod(F.hash("token"), F.lit(buckets)).alias("b")
    filled = table.select(number, F.struct("token", "token_id").alias("entry"))
    empty = spark.range(buckets).select(F.col("id").cast("int").alias("b"), F.lit(None).alias("entry"))
    return (
        filled.unionByName(empty)
        .groupBy("b")
        .agg(F.map_from_entries(F.collect_list("entry")).alias("m"))
        .agg(F.collect_list(F.struct("b", "m")).alias("parts"))
        .select(F.transform(F.array_sort("parts", lambda x, y: x["b"] - y["b"]), lambda p: p["m"]).alias("v"))
    )


def encode_with(
    df: DataFrame, make_tokenizer: Callable[[], Callable[[str], Sequence[int]]], text: str, out: str
) -> DataFrame:
    """T2 with a supplied tokenizer: made once per task, fed by Arrow batches."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenize = make_tokenizer()
        for batch in batches:
            yield batch.map(lambda t: None if t is None else list(tokenize(t)))

    return df.withColumn(out, F.pandas_udf(run, "array<int>")(text))


def encode_context(
    df: DataFrame,
    vocab: Vocabulary,
    system: str,
    user: str,
    n_ctx: int = C.CONTEXT_IDS,
    role_ids: Mapping[str, int] = C.ROLE_IDS,
    bos: str = "<s>",
    eos: str = "</s>",
    notice: str | None = None,
) -> DataFrame:
    """T6/F3. Ids of the tagged system and user message and the reply opening, last `n_ctx` kept.

    Adds `context`, `n_tokens` before the cut, and `over_context`; `notice` is the text a user gets
    whose message was cut.
    """
    encoded = encode(df, vocab, {system: "_system_ids", user: "_user_ids"})
    whole = arrays.context_ids(
        F.coalesce("_system_ids", F.array().cast("array<int>")),
        F.coalesce("_user_ids", F.array().cast("array<int>")),
        vocab.special_id(bos),
        vocab.special_id(eos),
        role_ids,
    )
    return (
        encoded.withColumn("_whole", whole)
        .withColumn("n_tokens", F.size("_whole"))
        .withColumn("over_context", F.col("n_tokens") > n_ctx)
        .withColumn("notice", F.when(F.col("over_context"), F.lit(notice).cast("string")))
        .withColumn("context", arrays.keep_last(F.col("_whole"), n_ctx))
        .drop("_whole", "_system_ids", "_user_ids")
    )


def length_profile(df: DataFrame, length: str, cutoffs: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """T7. Row count, range, quartiles and the rows above each cutoff.

    Quantiles are exact; they are taken from counts per length, which are as few as the lengths.
    """
    counts = df.groupBy(*by, length).agg(F.count("*").alias("_n"))
    over = [
        F.sum(F.when(F.col(length) > c, F.col("_n")).otherwise(0)).alias(f"over_{c}") for c in cutoffs
    ]
    quartiles = [
        F.percentile(length, F.lit(q), F.col("_n")).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)
    ]
    return counts.groupBy(*by).agg(
        F.sum("_n").alias("n_rows"),
        F.min(length).alias("min_len"),
        F.max(length).alias("max_len"),
        F.sum(F.col(length) * F.col("_n")).alias("sum_len"),
        *quartiles,
        *over,
    )
