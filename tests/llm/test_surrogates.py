"""Persons across titles and mentions, scripts, and column names."""

from __future__ import annotations

import re

import pytest

from termloom.llm import surrogates


def changed(spark, *texts, columns="doc_id long, text string"):
    rows = spark.createDataFrame(list(enumerate(texts)), columns)
    return [r.text for r in surrogates.pseudonymise(rows, "key").orderBy("doc_id").collect()]


def test_names_of_any_script_move(spark):
    texts = ["Dr Արամ Սարգսյան left.", "Mr Łukasz Żółć", "Frau Ёлка Ёжикова", "Mr Κώστας Ήρας", "Dr ᎠᏂᏯ ᎣᏏᏲ", "Herr 김철수", "Mr Ḷḷ Ṁṁ"]
    got = changed(spark, *texts)
    for old, new in zip(texts, got, strict=True):
        title, *words = re.findall(r"[^\s.]+", old)
        assert new.startswith(title)
        # A sign without a range of its own may stay within a word, no word as a whole does.
        assert not [w for w in words if w in new.split()]
    assert re.fullmatch(r"Dr [Ա-Ֆ][ա-ֆ]+ [Ա-Ֆ][ա-ֆ]+ left\.", got[0])
    assert len(got[1]) in (len(texts[1]), len(texts[1]) + 1)


def test_later_mentions_follow_the_person(spark):
    (got,) = changed(spark, "Mr John Smith met Mary Jones. John Smith said so. Smith left, Smithers stayed.")
    match = re.fullmatch(r"Mr (\S+) (\S+) met Mary Jones\. (\S+) (\S+) said so\. (\S+) left, Smithers stayed\.", got)
    first, last, again, other, alone = match.groups()
    assert (first, last) == (again, other) and alone == last and "Smith " not in got and "John" not in got


def test_one_person_under_several_titles(spark):
    got = changed(spark, "Mrs Anna Lee", "Dr Anna Lee", "Anna Lee was there, said Prof. Anna Lee.", "Mr Kim Roe", "Ms Kim Roe")
    name = got[0].removeprefix("Mrs ")
    assert got[1] == f"Dr {name}" and name.split()[0].endswith("a")
    assert got[2] == f"{name} was there, said Prof. {name}."
    # Titles that disagree leave the name without an ending.
    assert got[3].removeprefix("Mr ") == got[4].removeprefix("Ms ")


def test_columns_of_any_name_and_odd_rows(spark):
    schema = "doc_id long, text string, pieces string, row int, found int, names string, pattern string, puts int, n_entities_ int"
    rows = [(1, "Mr Max Moe, 10.0.0.1", "a", 1, 2, "b", "c", 3, 4), (1, None, "a", 1, 2, "b", "c", 3, 5), (None, "plain", None, None, None, None, None, None, None)]
    rows += [rows[0]]
    frame = spark.createDataFrame(rows, schema)
    got = surrogates.without_personal_data(frame, "key")
    assert got.columns == frame.columns
    found = got.collect()
    assert sorted(str(r[2:]) for r in found) == sorted(str(tuple(r[2:])) for r in frame.collect())
    assert len({r.text for r in found if r.text and r.text.startswith("Mr")}) == 1 and "Moe" not in str(found) and "plain" in str(found)
    empty = surrogates.pseudonymise(frame.drop("n_entities_").limit(0), "key")
    assert empty.count() == 0 and empty.columns[-1] == "n_entities_"


def test_a_very_long_text(spark):
    text = "Mr Max Moe. " + "word " * 300_000 + "Max Moe and Moe."
    (got,) = changed(spark, text)
    assert "Moe" not in got and got.count("word ") == 300_000


@pytest.mark.parametrize("name", ["Smith", "O'Neil-Ray"])
def test_mentions_are_whole_words(spark, name):
    (got,) = changed(spark, f"Mr {name} x{name} {name}y {name}.")
    assert f"x{name}" in got and f"{name}y" in got and not got.endswith(f" {name}.")
