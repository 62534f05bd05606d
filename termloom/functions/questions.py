"""Question types, their templates, and the seeded choice among them."""

from __future__ import annotations

from collections.abc import Mapping
from string import Formatter

from pyspark.sql import Column, functions as F

from termloom.functions import terms
from termloom.functions.hashing import draw, slot

# Question templates by type.
TEMPLATES = {
    1: [
        "{Headword}에 대해 설명해주세요.",
        "{Headword}이(가) 무엇인가요?",
        "{Headword}란 무엇입니까?",
        "{Headword}을(를) 설명해줘.",
    ],
    2: [
        "{Abbreviation}에 대해서 설명해줘.",
        "{Abbreviation}가 무엇인가요?",
        "{Abbreviation}란?",
    ],
    3: [
        "{Original_Word}가 무엇인가요?",
        "{Original_Word}에 대해 설명해주세요.",
    ],
    4: [
        "{Headword}는 어떤 종류인가요?",
        "{Headword}은(는) 무엇의 한 종류인가요?",
        "{Headword}는 어떤 종류에 속하나요?",
    ],
    5: [
        "{Headword}은(는) 어떤 범주에 속하나요?",
        "{Headword}은(는) 어떤 분야에 해당하나요?",
        "{Headword}은(는) 무슨 영역에 속하는 용어인가요?",
    ],
    6: [
        "{Headword}은(는) 어떤 특성을 가지고 있나요?",
        "{Headword}의 주요 특징은 무엇인가요?",
        "{Headword}의 특성을 설명해주세요.",
    ],
    7: [
        "{Abbreviation}의 전체 명칭은 무엇인가요?",
        "{Abbreviation}는 무엇의 약어인가요?",
        "{Abbreviation}의 원래 용어는 무엇입니까?",
    ],
    8: [
        "{Headword}은(는) 어떤 원리로 작동하나요?",
        "{Headword}의 작동 원리는 무엇인가요?",
        "{Headword}은(는) 어떻게 동작하나요?",
    ],
    9: [
        "다음 정보에서 {Headword}의 정의를 찾아주세요: {context}",
        "아래 내용에서 {Headword}에 대한 설명을 추출해주세요: {context}",
    ],
}

PAIRS_PER_ROW = 4
MAX_ORIGINAL_WORD_CHARS = 50

# Each type's lot is its own run of digits of one long digest.
LOT_DIGITS = 7
# Lots are hexadecimal, so this sorts behind each of them.
NO_LOT = "~"

RESPONSES = {
    1: terms.full_response,
    2: terms.full_response,
    3: terms.full_response,
    4: terms.classification_response,
    5: terms.category_response,
    6: terms.characteristics_response,
    7: terms.abbreviation_response,
    8: terms.mechanism_response,
    9: terms.extraction_response,
}


def short_text(text: Column, limit: int = MAX_ORIGINAL_WORD_CHARS) -> Column:
    return F.length(text) < limit


def type_conditions(
    row: Mapping[str, Column], max_original_word_chars: int = MAX_ORIGINAL_WORD_CHARS
) -> dict[int, Column]:
    """When each question type can be asked of a row."""
    always = F.lit(True)
    has = {name: column.isNotNull() for name, column in row.items()}
    return {
        1: always,
        2: has["Abbreviation"],
        3: has["Original_Word"] & short_text(row["Original_Word"], max_original_word_chars),
        4: has["Hypernym"],
        5: has["Category"] | has["Hypernym"],
        6: always,
        7: has["Abbreviation"],
        8: always,
        9: always,
    }


def available_types(conditions: Mapping[int, Column]) -> Column:
    return F.array_compact(F.array(*(F.when(c, F.lit(t)) for t, c in conditions.items())))


def picked_types(
    conditions: Mapping[int, Column], key: Column, seed: int, count: int = PAIRS_PER_ROW
) -> Column:
    """Up to ``count`` available types, drawn without replacement, as array<struct<lot, type>>.

    Each available type has a lot and the lowest win. No row meets another one, so this needs no
    shuffle; one digest per row serves all types.
    """
    digest = F.sha2(F.concat_ws("|", F.lit(str(seed)), key, F.lit("types")), 256)

    def lot(t: int) -> Column:
        return F.substring(digest, (t - 1) * LOT_DIGITS + 1, LOT_DIGITS)

    lots = F.array(
        *(
            F.struct(
                F.when(condition, lot(t)).otherwise(NO_LOT).alias("lot"), F.lit(t).alias("type")
            )
            for t, condition in conditions.items()
        )
    )
    available = sum((c.cast("int") for c in conditions.values()), F.lit(0))
    return F.slice(F.sort_array(lots), F.lit(1), F.least(F.lit(count), available))


def template_index(kind: Column, key: Column, seed: int) -> Column:
    """0-based template of the given type, uniform."""
    sizes = F.array(*(F.lit(len(texts)) for texts in TEMPLATES.values()))
    return slot(draw(seed, key, kind, F.lit("template")), F.element_at(sizes, kind))


def _split(template: str) -> tuple[list[str], list[str]]:
    """Literal pieces around at most two placeholders, and the names of those."""
    parts = list(Formatter().parse(template))
    fields = [field for _, field, _, _ in parts if field]
    literals = [literal for literal, *_ in parts]
    return (literals + [""] * 3)[:3], fields


def question(kind: Column, template: Column, row: Mapping[str, Column]) -> Column:
    """The question text, filled in one pass: braces inside a value are never expanded again.

    Templates are taken apart here, once; a row only looks its pieces up. The long context is
    built only where a template asks for it.
    """
    values = {**row, "context": terms.extraction_context(row)}
    split = {t: [_split(text) for text in texts] for t, texts in TEMPLATES.items()}

    def piece(place: int) -> Column:
        table = F.array(*(F.array(*(F.lit(p[place]) for p, _ in s)) for s in split.values()))
        return F.element_at(F.element_at(table, kind), template + 1)

    def field(place: int) -> Column:
        """All templates of a type share their fields."""
        kinds: dict[str, list[int]] = {}
        for t, templates in split.items():
            names = {fields[place] if place < len(fields) else "" for _, fields in templates}
            (name,) = names
            kinds.setdefault(name, []).append(t)
        empty = kinds.pop("", None)
        chain = F.when(kind.isin(empty), F.lit("")) if empty else F
        for name, those in kinds.items():
            chain = chain.when(kind.isin(those), values[name])
        return chain

    return terms.say(piece(0), field(0), piece(1), field(1), piece(2))


def response(kind: Column, row: Mapping[str, Column]) -> Column:
    """The answer text; the three definition types share one branch."""
    shared: dict = {}
    for t, build in RESPONSES.items():
        shared.setdefault(build, []).append(t)
    chain = None
    for build, kinds in shared.items():
        test = kind.isin(kinds)
        text = build(row)
        chain = F.when(test, text) if chain is None else chain.when(test, text)
    return chain
