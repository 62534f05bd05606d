"""Table schemas. Every vocabulary field is text: no type is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Column headers of the source workbooks and their table names, in table order.
VOCAB_HEADERS = {
    "범주": "Category",
    "표제어": "Headword",
    "원어": "Original_Word",
    "한자": "Hanja",
    "약어": "Abbreviation",
    "의미": "Meaning",
    "상위어": "Hypernym",
    "하위어": "Hyponym",
    "동의어": "Synonym",
    "관련어": "Related_Word",
    "사전명": "Dictionary_Name",
    "출전": "Source",
    "등록일": "Registration_Date",
}

VOCAB_COLUMNS = list(VOCAB_HEADERS.values())
REQUIRED_COLUMNS = ["Headword", "Meaning"]
OPTIONAL_COLUMNS = [name for name in VOCAB_COLUMNS if name not in REQUIRED_COLUMNS]


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


VOCAB = _texts(*VOCAB_COLUMNS)
MESSAGE = _texts("role", "content")
CHAT = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE))])
EVAL = _texts("question", "ground_truth")

_ACCURACY = T.StructType(
    [
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("correct", T.LongType()),
        T.StructField("total", T.LongType()),
    ]
)

RECALL_REPORT = T.StructType(
    [
        T.StructField(
            "bertscore",
            T.StructType(
                [T.StructField("f1_mean", T.DoubleType()), T.StructField("f1_std", T.DoubleType())]
            ),
        ),
        T.StructField("headword_recall", _ACCURACY),
        T.StructField("abbreviation_match", _ACCURACY),
        T.StructField(
            "passed",
            T.StructType(
                [
                    T.StructField("bertscore", T.BooleanType()),
                    T.StructField("headword", T.BooleanType()),
                ]
            ),
        ),
        T.StructField("num_samples", T.LongType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("overall_passed", T.BooleanType()),
        T.StructField("num_scored", T.LongType()),
        T.StructField("num_unscored", T.LongType()),
    ]
)

_BY_SUBJECT = T.MapType(T.StringType(), _ACCURACY)

CHOICE_REPORT = T.StructType(
    [
        T.StructField(
            "finetuned",
            T.StructType([*_ACCURACY.fields, T.StructField("by_subject", _BY_SUBJECT)]),
        ),
        T.StructField("run_name", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField(
            "base",
            T.StructType(
                [
                    T.StructField("accuracy", T.DoubleType()),
                    T.StructField("by_subject", _BY_SUBJECT),
                ]
            ),
        ),
        T.StructField("performance_drop", T.DoubleType()),
        T.StructField(
            "passed",
            T.StructType(
                [
                    T.StructField("drop_acceptable", T.BooleanType()),
                    T.StructField("min_accuracy_met", T.BooleanType()),
                ]
            ),
        ),
        T.StructField("overall_passed", T.BooleanType()),
    ]
)

_VARIANT_METRICS = T.StructType(
    [
        T.StructField(name, T.DoubleType())
        for name in ("test1_bertscore_f1", "test1_headword_recall", "test2_accuracy")
    ]
)


def comparison_schema(first: str, second: str) -> T.StructType:
    """Shape of a comparison report of two variants."""
    flags = ("test1_bertscore", "test1_headword", "test2_accuracy")
    return T.StructType(
        [
            T.StructField(first, _VARIANT_METRICS),
            T.StructField(second, _VARIANT_METRICS),
            T.StructField("performance_drop", _VARIANT_METRICS),
            T.StructField("passed", T.StructType([T.StructField(f, T.BooleanType()) for f in flags])),
            T.StructField("overall_passed", T.BooleanType()),
            T.StructField("run_name", T.StringType()),
            T.StructField("timestamp", T.StringType()),
        ]
    )


SETTINGS = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)
