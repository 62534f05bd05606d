"""Judging one answer: headwords, abbreviations, multiple choice and pass thresholds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from termloom.functions.terms import say
from termloom.functions.validity import BLANK

# Pass thresholds.
MIN_SEMANTIC_F1 = 0.70
MIN_HEADWORD_RECALL = 0.80
MIN_CHOICE_ACCURACY = 0.30
MAX_DROP_FROM_BASE = 0.10
MAX_DROP_BETWEEN_VARIANTS = 0.05

# Patterns of a leading Hangul headword and of an abbreviation behind its mark.
HEADWORD = "^([가-힣]+)"
ABBREVIATION = rf"☜[{BLANK}]*([A-Z0-9\-]+)"

CHOICES = "ABCD"
NO_CHOICE = -1
INVALID_CHOICE = "INVALID"

# The one-shot example and the closing line of a multiple-choice prompt.
CHOICE_EXAMPLE = (
    "질문: 대한민국의 수도는?\nA. 부산\nB. 서울\nC. 대구\nD. 인천\n\n"
    "정답을 A, B, C, D 중 하나로 답하세요. 정답: B\n\n"
)
CHOICE_CLOSING = "\n정답을 A, B, C, D 중 하나로 답하세요. 정답:"

# Besides a to d, one letter has an upper case that starts with one of A to D.
_LOWER = "abcdẚ"
_UPPER = "ABCDA"


def _found(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def extract_headword(truth: Column) -> Column:
    return _found(truth, HEADWORD)


def contains_headword(prediction: Column, headword: Column) -> Column:
    return prediction.contains(headword)


def extract_abbreviation(truth: Column) -> Column:
    return _found(truth, ABBREVIATION)


def contains_abbreviation(prediction: Column, abbreviation: Column) -> Column:
    return F.lower(prediction).contains(F.lower(abbreviation))


def normalize_answer(answer: Column, numeric: bool = False, answer_base: int = 0) -> Column:
    """Index of the right choice: a letter counted from A, or a number counted from its base.

    A text that is not a single letter has no index and gives NULL.
    """
    if numeric:
        return answer.cast("int") - answer_base
    return F.when(F.length(answer) == 1, F.ascii(answer) - ord(CHOICES[0]))


def pack_choices(*choices: Column) -> Column:
    return F.array(*choices)


def choice_prompt(question: Column, choices: Column) -> Column:
    lines = F.transform(
        choices,
        lambda choice, i: say(F.substring(F.lit(CHOICES), i + 1, F.lit(1)), ". ", choice, "\n"),
    )
    return say(
        CHOICE_EXAMPLE, "질문: ", question, "\n", F.array_join(lines, ""), CHOICE_CLOSING
    )


def extract_choice(response: Column) -> Column:
    """Index of the chosen letter, or -1.

    A response that starts with a letter means that letter; otherwise the first letter in the
    order A to D that occurs anywhere counts, whatever its place ("The answer is D" gives A).
    """
    lead = F.regexp_extract(response, rf"\A[{BLANK}]*([{CHOICES}{_LOWER}])", 1)
    upper = F.translate(response, _LOWER, _UPPER)
    chain = F.when(response.isNull(), NO_CHOICE).when(
        lead != "", F.instr(F.lit(CHOICES), F.translate(lead, _LOWER, _UPPER)) - 1
    )
    for i, letter in enumerate(CHOICES):
        chain = chain.when(upper.contains(letter), i)
    return chain.otherwise(NO_CHOICE)


def choice_label(index: Column, invalid: Column | str = INVALID_CHOICE) -> Column:
    """Letter of a choice. A prediction off the list is invalid; pass the number for a truth."""
    letter = F.substring(F.lit(CHOICES), index + 1, F.lit(1))
    off_list = F.lit(invalid) if isinstance(invalid, str) else invalid.cast("string")
    return F.when(index.between(0, len(CHOICES) - 1), letter).otherwise(off_list)


def at_least(metric: Column, threshold: float) -> Column:
    return metric >= F.lit(threshold)


def drop_within(before: Column, after: Column, limit: float) -> Column:
    """Absolute drop, in points."""
    return (before - after) <= F.lit(limit)


def all_passed(passed: Column, names: list[str]) -> Column:
    """Conjunction over the fields of a struct of flags."""
    return F.forall(F.array(*(passed[name] for name in names)), lambda flag: flag)
