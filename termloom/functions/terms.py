"""Answer texts of a vocabulary row.

Every function takes ``row``, which maps a vocabulary column name to a Column. Optional fields
must be NULL where blank (see ``blanks_to_null``): a sentence with a missing field is then NULL
and left out.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from string import Formatter

from pyspark.sql import Column, functions as F

Row = Mapping[str, Column]

# The sentences of each answer, joined by a space as far as their fields exist.
# {term} is the headword with its variants, {brief} the meaning up to its first full stop.
SENTENCES = {
    "full_response": [
        "{term}은(는) {Meaning}",
        "☜ {Abbreviation}",
        "이 용어는 {Category}에 속한다.",
        "{Headword}은(는) {Hypernym}의 한 종류이다.",
        "예를 들어, {Headword}의 하위 개념으로는 {Hyponym} 등이 있다.",
        "동의어로는 {Synonym}를(을) 들 수 있다.",
        "관련어로는 {Related_Word}가(이) 있다.",
        "이 용어는 {Dictionary_Name}에 수록되어 있다.",
    ],
    "category_response": [
        "{Headword}은(는) {Category}에 속합니다.",
        "{Headword}은(는) {Hypernym}의 한 종류입니다.",
    ],
    "classification_response": [
        "{term}은(는) {Hypernym}의 한 종류입니다.",
        "{brief}",
    ],
    "characteristics_response": [
        "{Headword}의 주요 특성은 다음과 같습니다: {Meaning}",
        "하위 유형으로는 {Hyponym} 등이 있습니다.",
    ],
    "abbreviation_response": [
        "{Abbreviation}는(은) {term}의 약어입니다.",
        "{brief}",
    ],
    "mechanism_response": ["{term}의 작동 원리는 다음과 같습니다: {Meaning}"],
    "extraction_response": ["{Headword}의 정의: {Meaning}"],
}

# Labels of the extraction context and the fields behind them, in output order.
CONTEXT_LABELS = {
    "분류": "Category",
    "용어명": "Headword",
    "한자": "Hanja",
    "영문": "Original_Word",
    "약어": "Abbreviation",
    "정의": "Meaning",
    "상위어": "Hypernym",
    "하위어": "Hyponym",
    "동의어": "Synonym",
    "관련어": "Related_Word",
    "출처": "Dictionary_Name",
}


def say(*pieces: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in pieces))


def fill(template: str, values: Row) -> Column:
    """Expand a template in one pass; NULL where a field is missing."""
    pieces: list[Column | str] = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(literal)
        if field:
            pieces.append(values[field])
    return say(*pieces)


def term_variants(row: Row) -> Column:
    """Headword, followed by (Hanja, Original_Word) as far as they exist."""
    hanja, original = row["Hanja"], row["Original_Word"]
    variants = say("(", F.concat_ws(", ", hanja, original), ")")
    return say(
        row["Headword"],
        F.when(hanja.isNotNull() | original.isNotNull(), variants).otherwise(""),
    )


def brief_meaning(row: Row) -> Column:
    """Text before the first full stop, closed by one."""
    return say(F.substring_index(row["Meaning"], ".", 1), ".")


def extraction_context(row: Row) -> Column:
    return F.concat_ws(
        " | ", *(say(f"{label}: ", row[field]) for label, field in CONTEXT_LABELS.items())
    )


def _answer(name: str) -> Callable[[Row], Column]:
    def build(row: Row) -> Column:
        values = {"term": term_variants(row), "brief": brief_meaning(row), **row}
        return F.concat_ws(" ", *(fill(sentence, values) for sentence in SENTENCES[name]))

    build.__name__ = name
    return build


full_response = _answer("full_response")
classification_response = _answer("classification_response")
characteristics_response = _answer("characteristics_response")
abbreviation_response = _answer("abbreviation_response")
mechanism_response = _answer("mechanism_response")
extraction_response = _answer("extraction_response")
_placement = _answer("category_response")


def category_response(row: Row) -> Column:
    """Where the term belongs; the full answer if that is unknown."""
    known = row["Category"].isNotNull() | row["Hypernym"].isNotNull()
    return F.when(known, _placement(row)).otherwise(full_response(row))
