"""Inputs of the registered queries, derived from the given tables.

Each stand-in is a projection of one whole table. The expressions are plain SQL that Spark and
DuckDB read alike. Values vary with the number of characters where exact copies of a text are to
stay copies, and with the row number elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VOCAB = {
    "doc_id": "doc_id",
    "Category": "case when n_chars % 13 = 4 then ' ' else concat('field ', lang) end",
    "Headword": (
        "case when n_chars % 97 = 5 then '  ' when n_chars % 97 = 6 then '　' else concat("
        "case n_chars % 4 when 0 then '전술' when 1 then '정밀' when 2 then '유도' else '장갑' end,"
        " ' ', lang, '-', cast(n_chars as string)) end"
    ),
    "Original_Word": (
        "case when n_chars % 3 = 0 then concat(lang, case when n_chars % 2 = 0 then ' weapon'"
        " else ' weapon system with a name of more than fifty characters' end) end"
    ),
    "Hanja": "case when n_chars % 4 = 1 then '戰術' when n_chars % 4 = 2 then '' end",
    "Abbreviation": (
        "case when n_chars % 6 = 0 then upper(concat(lang, '-X')) when n_chars % 6 = 1"
        " then 'kW' end"
    ),
    "Meaning": "case when n_chars % 11 = 0 then null else text end",
    "Hypernym": "case when n_chars % 5 = 0 then concat('kind of ', lang) end",
    "Hyponym": "case when n_chars % 7 = 0 then 'sub a, sub b' end",
    "Synonym": "case when n_chars % 8 = 0 then concat('syn ', lang) end",
    "Related_Word": "case when n_chars % 9 = 0 then 'rel {context} {Headword} | x' end",
    "Dictionary_Name": "case when n_chars % 2 = 0 then '용어사전' end",
    "Source": "lang",
    "Registration_Date": "cast(null as string)",
}

PREDICTIONS = {
    "sample_id": "doc_id",
    "question": "concat(lang, ' ', source)",
    "ground_truth": (
        "case when doc_id % 10 = 9 then concat('TERM ', text) else concat('전술 ', lang,"
        " '은(는) ', text, case when doc_id % 3 = 0 then concat(' ☜ ', upper(source), '-7 x')"
        " else '' end) end"
    ),
    "prediction": (
        "case doc_id % 5 when 0 then concat('전술 ', text, ' ☜ ', lower(source), '-7 x')"
        " when 1 then concat('전술 장비 ', text) when 2 then concat('about ', source, '-7 ', text)"
        " when 3 then '정밀 장비' else '' end"
    ),
    "score": "cast(doc_id % 101 as double) / cast(100 as double)",
}

CHOICE_SOURCE = {
    "sample_id": "doc_id",
    "subject": "lang",
    "question": "text",
    "A": "concat(source, ' a')",
    "B": "concat(source, ' b')",
    "C": "concat(lang, ' c')",
    "D": "concat(lang, ' d')",
    "answer": (
        "case doc_id % 9 when 0 then 'A' when 1 then 'B' when 2 then 'C' when 3 then 'D'"
        " when 4 then 'A' when 5 then 'B' when 6 then 'E' when 7 then 'AB' else 'C' end"
    ),
    "response": (
        "case doc_id % 7 when 0 then 'C' when 1 then '　b. because' when 2 then 'The answer is D'"
        " when 3 then '' when 4 then '정답: B' else text end"
    ),
    "base_response": (
        "case doc_id % 5 when 0 then 'A' when 1 then 'b)' when 2 then ' C' when 3 then '?' else"
        " text end"
    ),
}

VARIANT_SCORES = {
    "variant": "case when doc_id % 2 = 0 then 'full' else 'quantised' end",
    "subject": "lang",
    "sample_id": "doc_id",
    "correct": "case when (doc_id * 7) % 10 < 6 then 1 else 0 end",
}

SETTINGS_LOG = {
    "run": "concat('run-', cast(user_id as string))",
    "key": "event_type",
    "value": "props",
    "ts": "ts",
    "event_id": "event_id",
}

VIEWS = {
    "vocab": (VOCAB, "documents"),
    "predictions": (PREDICTIONS, "documents"),
    "choice_source": (CHOICE_SOURCE, "documents"),
    "variant_scores": (VARIANT_SCORES, "documents"),
    "settings_log": (SETTINGS_LOG, "events"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    columns, source = VIEWS[name]
    return table(spark, sf_dir, source).selectExpr(
        *(f"{expression} as `{column}`" for column, expression in columns.items())
    )


def standin_sql(name: str) -> str:
    columns, source = VIEWS[name]
    listed = ", ".join(f'{expression} as "{column}"' for column, expression in columns.items())
    return f"select {listed} from {source}"
