"""Token id arrays: padding, truncation and removal of the prompt."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MAX_PROMPT_TOKENS = 2048


def left_pad(ids: Column, width: Column, pad_id: int = 0) -> Column:
    return F.concat(F.array_repeat(F.lit(pad_id), width - F.size(ids)), ids)


def attention_mask(ids: Column, width: Column) -> Column:
    return F.concat(
        F.array_repeat(F.lit(0), width - F.size(ids)), F.array_repeat(F.lit(1), F.size(ids))
    )


def truncate(ids: Column, limit: int = MAX_PROMPT_TOKENS) -> Column:
    return F.slice(ids, 1, limit)


def strip_prompt(ids: Column, prompt_width: Column) -> Column:
    """Ids generated behind a padded prompt of the given width."""
    return F.slice(ids, prompt_width + 1, F.greatest(F.size(ids) - prompt_width, F.lit(0)))
