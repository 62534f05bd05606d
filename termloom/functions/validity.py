"""Which field values count as missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from termloom.schemas import OPTIONAL_COLUMNS, VOCAB_COLUMNS

# The characters a Unicode-aware strip removes, as a regular-expression class body
# that Java and RE2 read alike.
BLANK = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
BLANK_TEXT = rf"\A[{BLANK}]*\z"

# Cell texts that a CSV reader with default settings takes for missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def is_valid(text: Column) -> Column:
    """True for a text that holds something besides blanks; false, never NULL, otherwise."""
    return text.isNotNull() & ~text.rlike(BLANK_TEXT)


def valid(text: Column) -> Column:
    """The text itself, untrimmed, or NULL where it is blank."""
    return F.when(~text.rlike(BLANK_TEXT), text)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A[{BLANK}]+|[{BLANK}]+\z", "")


def na_to_null(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """Turn the missing-value spellings into NULL in every text column."""
    tokens = NA_TOKENS if tokens is None else tokens
    if not tokens:
        return df
    return df.select(
        *(
            F.when(~F.col(f"`{name}`").isin(tokens), F.col(f"`{name}`")).alias(name)
            if kind == "string"
            else F.col(f"`{name}`")
            for name, kind in df.dtypes
        )
    )


def with_vocab_columns(df: DataFrame) -> DataFrame:
    """Add absent vocabulary columns as NULL, so that an absent field reads as a missing one."""
    missing = {
        name: F.lit(None).cast("string") for name in VOCAB_COLUMNS if name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Normalise every optional field once, so later expressions only test for NULL."""
    return df.withColumns({name: valid(F.col(name)) for name in OPTIONAL_COLUMNS})
