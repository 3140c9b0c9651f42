"""Mixing sources to target shares of all text tokens.

Tokens are counted once per document and written to the shared checkpoint folder,
and again for the documents used as they are emitted with their text. From the sums per source follow repetition rates; each document is emitted
floor(rate) times and once more with the fractional part's probability, decided
by a seeded hash of its id, so a rerun gives the same set.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: How the vocabulary's tokenizer cuts texts before merging (a fixed value), and
#: the vocabulary used where none is named.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@lru_cache(maxsize=2)
def _encoder(vocabulary: str):  # noqa: ANN202
    """tiktoken encoder of a vocabulary file; one for each worker process."""
    import base64

    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("tokens", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY, carry: list[str] | None = None) -> DataFrame:
    """(doc_id, source, n_tokens, <carry>): whole texts, 0 for null and empty ones.
    ``vocabulary`` is the path of a file of byte-level BPE ranks, there on every
    worker."""
    carry = carry or []

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = _encoder(vocabulary)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column("text").to_pylist()]
            names = ["doc_id", "source", *carry]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(n, pa.int64())], [*names, "n_tokens"])

    read = documents.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), "text", *(c for c in carry if c != "text"))
    return read.mapInArrow(count, read.select("doc_id", "source", *carry).withColumn("n_tokens", F.lit(0).cast("bigint")).schema)


def repetition_rates(counted: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, n_tokens, rate): how often a document
    of each source is used on average. The total is the largest at which every
    source can reach its share within its cap, min(tokens x cap / share); then
    each rate is share x total / tokens, at most its cap, and the shares hold.

    Sources without target, with share 0 or without tokens are not used. Shares
    are taken relative to the sum of those that can be used. Of several rows for
    one source the largest share counts. One row a source of ``targets``."""
    goal = targets.filter("source is not null and target_share > 0 and max_repeats > 0").groupBy("source").agg(
        F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")
    )
    have = counted.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"))
    rows = goal.join(have, "source").filter("n_tokens > 0")
    total = rows.agg(
        F.sum("target_share").alias("s"),
        F.min(F.col("n_tokens") * F.col("max_repeats") / F.col("target_share")).alias("t"),
    ).select(F.struct("s", "t").alias("total")).scalar()
    # The target of all is t of the unnormalised shares: the same rates, for they are relative to each other.
    return rows.withColumn("total", total).select(
        "source",
        (F.col("target_share") / F.col("total.s")).alias("target_share"),
        "max_repeats",
        "n_tokens",
        F.least(F.col("target_share") * F.col("total.t") / F.col("n_tokens"), F.col("max_repeats").cast("double")).alias("rate"),
    )


def copies(rate, key, seed: int):  # noqa: ANN001, ANN201
    """floor(rate) plus a Bernoulli draw from the fraction by hash of ``key``.
    Rates that are whole but for rounding are whole."""
    rate = F.round(rate, 9)
    draw = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def mix(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(training set, shares).

    training set   (doc_id, source, n_tokens, copy, <the document's other columns,
                   its text among them>): one row each time a document is used,
                   copy counting from 1, never above max_repeats
    shares         (source, target_share, max_repeats, rate, n_documents, n_rows,
                   n_tokens, actual_share) as they came out; a source none of whose
                   documents is used is there with zeros

    The texts never shuffle and aren't checkpointed: the draw needs the id and its
    source's rate only, so the set is made where the documents are read, and the
    tokens of those used are counted there once more. A doc_id on several rows
    draws the same for each, as equal documents."""
    from tidewell.session import shared_dir

    shared_dir(documents.sparkSession)
    counted = token_counts(documents, vocabulary).checkpoint()
    # At most one row a source of mix_target; beyond Spark's own broadcast limit it is a shuffle join.
    rates = repetition_rates(counted, targets)
    drawn = counted.join(rates.select("source", "rate"), "source").withColumn("n", copies(F.col("rate"), F.col("doc_id"), seed))
    own = [c for c in documents.columns if c not in ("doc_id", "source", "n_tokens", "copy")]
    # One short row a source; without the hint the texts would shuffle by source.
    by_source = F.broadcast(rates.select("source", F.col("rate").alias("__rate")))
    picked = documents.join(by_source, "source").withColumn("__n", copies(F.col("__rate"), F.col("doc_id").cast("bigint"), seed))
    used = token_counts(picked.filter("__n > 0"), vocabulary, [*own, "__n"])
    training = used.select("doc_id", "source", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("copy"), *own)
    sums = drawn.groupBy("source").agg(
        F.count_if(F.col("n") > 0).alias("n_documents"), F.sum("n").alias("n_rows"), F.sum(F.col("n") * F.col("n_tokens")).alias("used_tokens")
    )
    everything = sums.agg(F.sum("used_tokens")).scalar()
    goal = targets.filter("source is not null").groupBy("source").agg(F.max("target_share").alias("goal_share"), F.max("max_repeats").alias("cap"))
    shares = goal.join(rates.select("source", "target_share", "rate"), "source", "left").join(sums, "source", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    return training, shares.select(
        "source",
        F.coalesce("target_share", "goal_share").alias("target_share"),
        F.col("cap").alias("max_repeats"),
        F.coalesce("rate", F.lit(0.0)).alias("rate"),
        zero("n_documents").alias("n_documents"),
        zero("n_rows").alias("n_rows"),
        zero("used_tokens").alias("n_tokens"),
        F.coalesce(F.col("used_tokens") / everything, F.lit(0.0)).alias("actual_share"),
    )
