"""Exact samples, splits and the checks between training and evaluation rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from termloom.functions.grading import extract_headword
from termloom.functions.hashing import draw, row_key
from termloom.operators.ordering import cut_point, up_to
from termloom.operators.rank_index import RankIndex

SAMPLE_SEED = 42
SPLIT_SEED = 3407
TEST_RATIO = 0.05
EVAL_SPLIT = 0.05
QUICK_SAMPLES = 50
VALIDATION_SAMPLES = 100
SAMPLES_PER_SUBJECT = 20

# What an index of a table's draws is made for.
DRAWS = (
    (SAMPLE_SEED, "holdout"),
    (SPLIT_SEED, "split"),
    (SAMPLE_SEED, "cap"),
    (SAMPLE_SEED, "validation"),
    (SAMPLE_SEED, "shuffle"),
    (SAMPLE_SEED, "index"),
)

# Copies of one row are rebuilt in runs of this length, spread over tasks.
COPIES_PER_RUN = 100_000

def with_draw(df: DataFrame, key: str, seed: int, salt: str, name: str = "drawn") -> DataFrame:
    return df.withColumn(name, draw(seed, F.col(key), F.lit(salt)))


def with_sample_id(df: DataFrame) -> DataFrame:
    """Unique ``sample_id`` for rows that have no key of their own.

    Identical rows are counted and rebuilt with an occurrence number. Counting collapses copies
    map-side, and rebuilding goes by runs that are spread again, so a row that makes up a third
    of the table never sits in one task.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    counted = df.groupBy(*columns).agg(F.count("*").alias("_copies"))
    counted = counted.withColumn("_key", row_key(columns))

    def numbered(rows: DataFrame, first: Column, last: Column) -> DataFrame:
        copies = rows.withColumn("_copy", F.explode(F.sequence(first, last)))
        number = F.col("_copy").cast("string")
        return copies.select(*columns, F.concat_ws("-", "_key", number).alias("sample_id"))

    few = counted.filter(F.col("_copies") <= COPIES_PER_RUN)
    many = counted.filter(F.col("_copies") > COPIES_PER_RUN)
    last_run = F.expr(f"(_copies - 1) div {COPIES_PER_RUN}")
    runs = many.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("bigint"), last_run)))
    first = F.col("_run") * COPIES_PER_RUN
    last = F.least(first + COPIES_PER_RUN, F.col("_copies")) - 1
    # Both branches read one shuffle: the aggregate's exchange is reused.
    return numbered(few, F.lit(0).cast("bigint"), F.col("_copies") - 1).unionAll(
        numbered(runs.repartition("_key", "_run"), first, last)
    )


def fraction_size(ratio: float) -> Callable[[Column], Column]:
    """max(1, truncated share): the size of the held-out evaluation sample."""
    return lambda n: F.greatest(F.floor(n.cast("double") * F.lit(ratio)), F.lit(1))


def split_size(ratio: float) -> Callable[[Column], Column]:
    """Share rounded up: the size of a validation split."""
    return lambda n: F.ceil(n.cast("double") * F.lit(ratio))


def _cut(
    drawn: DataFrame, seed: int, salt: str, size: Callable[[Column], Column], index: RankIndex | None
) -> Column:
    """The last draw of a sample: from the index where the table has one, else from passes over it."""
    if index is not None:
        return index.cut(seed, salt, size)
    return cut_point(drawn, "drawn", size).scalar()


def mark_fraction(
    df: DataFrame,
    key: str,
    ratio: float = TEST_RATIO,
    seed: int = SAMPLE_SEED,
    index: RankIndex | None = None,
) -> DataFrame:
    """Column ``held``, true for exactly ``max(1, int(n * ratio))`` rows; ``key`` must be unique.

    Sample and rest then differ by a comparison per row, so no join takes them apart.
    """
    drawn = with_draw(df, key, seed, "holdout")
    cut = _cut(drawn, seed, "holdout", fraction_size(ratio), index)
    return drawn.withColumn("held", F.col("drawn") <= cut).drop("drawn")


def exact_fraction(
    df: DataFrame,
    key: str,
    ratio: float = TEST_RATIO,
    seed: int = SAMPLE_SEED,
    index: RankIndex | None = None,
) -> DataFrame:
    return mark_fraction(df, key, ratio, seed, index).filter("held").drop("held")


def label_split(
    df: DataFrame,
    key: str,
    ratio: float = EVAL_SPLIT,
    seed: int = SPLIT_SEED,
    index: RankIndex | None = None,
) -> DataFrame:
    """Column ``split`` with 'eval' for exactly ``ceil(n * ratio)`` rows and 'train' otherwise.

    Both parts come from one comparison per row, so no join takes them apart. Ratio 0 means no
    evaluation part.
    """
    if not ratio:
        return df.withColumn("split", F.lit("train"))
    drawn = with_draw(df, key, seed, "split")
    cut = _cut(drawn, seed, "split", split_size(ratio), index)
    label = F.when(F.col("drawn") <= cut, "eval").otherwise("train")
    return drawn.withColumn("split", label).drop("drawn")


def train_eval_split(
    df: DataFrame,
    key: str,
    ratio: float = EVAL_SPLIT,
    seed: int = SPLIT_SEED,
    index: RankIndex | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    labelled = label_split(df, key, ratio, seed, index)
    train = labelled.filter(F.col("split") == "train").drop("split")
    if not ratio:
        return train, None
    return train, labelled.filter(F.col("split") == "eval").drop("split")


def cap_rows(
    df: DataFrame,
    key: str,
    count: int | None,
    seed: int = SAMPLE_SEED,
    salt: str = "cap",
    index: RankIndex | None = None,
) -> DataFrame:
    """Exactly ``count`` rows if there are more; all rows otherwise or without a count."""
    if not count:
        return df
    drawn = with_draw(df, key, seed, salt)
    cut = _cut(drawn, seed, salt, lambda n: F.lit(count), index)
    return up_to(drawn, "drawn", cut).drop("drawn")


def sample_validation(
    df: DataFrame, key: str, count: int = VALIDATION_SAMPLES, seed: int = SAMPLE_SEED
) -> DataFrame:
    return cap_rows(df, key, count, seed, "validation")


def stratified_sample(
    df: DataFrame,
    stratum: str,
    key: str,
    count: int = SAMPLES_PER_SUBJECT,
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """Up to ``count`` rows of each stratum: those with the smallest draws.

    Tasks drop all but ``count`` rows of a stratum and leading digit before the shuffle, which spreads a
    stratum over as many groups; what is left of it, at most 16 times ``count`` rows, is ranked as one.
    """
    drawn = with_draw(df, key, seed, "stratum").withColumn("_head", F.substring("drawn", 1, 1))
    spread = Window.partitionBy(stratum, "_head").orderBy("drawn")
    whole = Window.partitionBy(stratum).orderBy("drawn")
    few = drawn.withColumn("_rank", F.row_number().over(spread)).filter(F.col("_rank") <= count)
    return (
        few.withColumn("_rank", F.row_number().over(whole))
        .filter(F.col("_rank") <= count)
        .drop("_head", "_rank", "drawn")
    )


def exclude_holdout(
    train: DataFrame, holdout: DataFrame, key: str | Column, mode: str = "disjoint"
) -> DataFrame:
    """Training rows without the held-out ones; ``mode='reference'`` keeps them all.

    ``key`` is a column name, or an expression that both tables can evaluate.
    """
    if mode == "reference":
        return train
    if mode != "disjoint":
        raise ValueError(f"unknown mode {mode!r}")
    if isinstance(key, str):
        return train.join(holdout.select(key).distinct(), key, "left_anti")
    held = holdout.select(key.alias("_key")).distinct()
    return train.withColumn("_key", key).join(held, "_key", "left_anti").drop("_key")


def leakage_within(rows: DataFrame, held: Column) -> DataFrame:
    """Held rows whose question, pair or headword also occurs in a row that is not held.

    Rows hold ``question`` and ``ground_truth``. One grouped pass over digests answers the three
    levels together: nothing is joined, and a question repeated in a third of the rows is
    combined before the shuffle.
    """
    question, truth = F.col("question"), F.col("ground_truth")
    levels = F.array(
        F.struct(F.lit("question").alias("level"), F.md5(question).alias("key")),
        F.struct(F.lit("pair").alias("level"), row_key([question, truth]).alias("key")),
        F.struct(F.lit("headword").alias("level"), F.md5(extract_headword(truth)).alias("key")),
    )
    keys = rows.select(F.inline(levels), held.alias("held")).filter("key is not null")
    counted = keys.groupBy("level", "key").agg(
        F.count_if("held").alias("held"), F.count_if(~F.col("held")).alias("trained")
    )

    def total(level: str, leaked: bool) -> Column:
        counts = (F.col("level") == level) & (F.col("trained") > 0 if leaked else F.lit(True))
        return F.coalesce(F.sum(F.when(counts, F.col("held"))), F.lit(0))

    report = F.array(
        *(
            F.struct(
                F.lit(level).alias("level"),
                total(level, False).alias("evaluated"),
                total(level, True).alias("leaked"),
            )
            for level in ("question", "pair", "headword")
        )
    )
    return counted.agg(report.alias("report")).select(F.inline("report"))


def leakage_report(train: DataFrame, evaluation: DataFrame) -> DataFrame:
    """``leakage_within`` for two tables."""
    texts = ["question", "ground_truth"]
    both = train.select(*texts, F.lit(False).alias("held")).unionAll(
        evaluation.select(*texts, F.lit(True).alias("held"))
    )
    return leakage_within(both, F.col("held"))


def requested_minus_found(requested: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Requested keys of which no row was found."""
    return requested.select(key).distinct().join(found.select(key).distinct(), key, "left_anti")
