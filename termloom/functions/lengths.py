"""Text lengths, length buckets and what follows from them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, functions as F

# Sequence-length buckets, the margin on top of p99, and the largest advice.
BUCKETS = [128, 256, 512, 768, 1024, 1536, 2048, 3072, 4096]
MARGIN = 32
MAX_SEQUENCE = 2048


def word_length(text: Column) -> Column:
    """Number of blank-separated words: the default length where no tokenizer is given.

    Splitting leaves an empty piece at an end that is blank; those are not counted.
    """
    pieces = F.size(F.split(text, r"\s+", -1))
    first, last = F.substring(text, 1, 1), F.substring(text, -1, 1)
    empty = sum(end.rlike(r"\A\s?\z").cast("int") for end in (first, last))
    return F.greatest(pieces - empty, F.lit(0)).cast("bigint")


def char_length(text: Column) -> Column:
    return F.length(text).cast("bigint")


def token_length(
    load_tokenizer: Callable[[], Callable[[str], Sequence]], extra_tokens: int = 0
) -> Callable[[Column], Column]:
    """Length under a real tokenizer, loaded once per task and fed Arrow batches.

    ``load_tokenizer()`` returns a function from text to tokens. ``extra_tokens`` stands for
    marks an encoder adds itself.
    """

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load_tokenizer()
        for texts in batches:
            yield texts.map(lambda text: len(encode(text)) + extra_tokens, na_action="ignore")

    return count


def round_to_bucket(length: Column, buckets: Sequence[int] = BUCKETS) -> Column:
    """Smallest bucket that holds the length, or the last one."""
    chain = None
    for bucket in buckets:
        chain = (F if chain is None else chain).when(length <= bucket, bucket)
    return chain.otherwise(buckets[-1])


def recommend_length(
    p99: Column, override: int | None = None, buckets: Sequence[int] = BUCKETS
) -> Column:
    """Bucket of the truncated p99 plus margin, at most ``MAX_SEQUENCE``; an override wins.

    The percentile is rounded first, as interpolation may leave it just under a whole number.
    """
    if override:
        return F.lit(override)
    padded = F.floor(F.round(p99, 6)) + MARGIN
    return F.least(round_to_bucket(padded, buckets), F.lit(MAX_SEQUENCE))


def over_limit(length: Column, limit: Column) -> Column:
    """Whether a sample would be cut at the limit."""
    return length > limit
