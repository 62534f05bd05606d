"""Golden texts and field edge cases."""

import pytest
from pyspark.sql import functions as F

from termloom.functions import chat, grading, lengths, questions, terms, validity
from termloom.operators import choice, pairs
from termloom.schemas import VOCAB, VOCAB_COLUMNS

BLANKS = ["", " ", "\t\n", "　", "\x1c\x1f", "\xa0 ", "　\x1c ", "\x85 "]


def vocab(spark, *rows):
    return spark.createDataFrame(
        [tuple(row.get(name) for name in VOCAB_COLUMNS) for row in rows], VOCAB
    )


def one(df):
    (row,) = df.collect()
    return row[0]


FILTER = {
    "Category": "화력",
    "Headword": "자외선 필터",
    "Original_Word": "UV Filter",
    "Hanja": "紫外線filter",
    "Abbreviation": "UV Filter",
    "Meaning": "대기 중에 끼어 있는 400nm 이하의 단파장 자외선을 흡수해서...",
    "Hypernym": "광학 필터",
    "Synonym": "자외선 흡수 필터",
    "Related_Word": "사진 필터",
    "Dictionary_Name": "국방과학기술용어사전",
}
FILTER_RESPONSE = (
    "자외선 필터(紫外線filter, UV Filter)은(는) 대기 중에 끼어 있는 400nm 이하의 단파장 자외선을"
    " 흡수해서... ☜ UV Filter 이 용어는 화력에 속한다. 자외선 필터은(는) 광학 필터의 한 종류이다."
    " 동의어로는 자외선 흡수 필터를(을) 들 수 있다. 관련어로는 사진 필터가(이) 있다."
    " 이 용어는 국방과학기술용어사전에 수록되어 있다."
)
MISSILE = {
    "Category": "화력",
    "Headword": "전술 탄도 미사일",
    "Original_Word": "Tactical Ballistic Missile",
    "Hanja": "戰術彈道missile",
    "Abbreviation": "TBM",
    "Meaning": "전술 목적의 미사일. 사거리 3.5km",
}


def told(spark, row, build):
    return one(pairs.keyed_terms(vocab(spark, row)).select(build(pairs.row_fields())))


def test_full_response(spark):
    assert told(spark, FILTER, terms.full_response) == FILTER_RESPONSE


def test_extraction_context(spark):
    assert told(spark, MISSILE, terms.extraction_context) == (
        "분류: 화력 | 용어명: 전술 탄도 미사일 | 한자: 戰術彈道missile | 영문: Tactical Ballistic"
        " Missile | 약어: TBM | 정의: 전술 목적의 미사일. 사거리 3.5km"
    )


def test_other_responses(spark):
    named = "전술 탄도 미사일(戰術彈道missile, Tactical Ballistic Missile)"
    row = {**MISSILE, "Hypernym": "미사일", "Hyponym": "단거리"}
    assert told(spark, row, terms.classification_response) == (
        f"{named}은(는) 미사일의 한 종류입니다. 전술 목적의 미사일."
    )
    assert told(spark, row, terms.abbreviation_response) == (
        f"TBM는(은) {named}의 약어입니다. 전술 목적의 미사일."
    )
    assert told(spark, row, terms.mechanism_response) == (
        f"{named}의 작동 원리는 다음과 같습니다: {MISSILE['Meaning']}"
    )
    assert told(spark, row, terms.characteristics_response) == (
        "전술 탄도 미사일의 주요 특성은 다음과 같습니다: 전술 목적의 미사일. 사거리 3.5km"
        " 하위 유형으로는 단거리 등이 있습니다."
    )
    assert told(spark, row, terms.category_response) == (
        "전술 탄도 미사일은(는) 화력에 속합니다. 전술 탄도 미사일은(는) 미사일의 한 종류입니다."
    )
    assert told(spark, row, terms.extraction_response) == (
        f"전술 탄도 미사일의 정의: {MISSILE['Meaning']}"
    )
    bare = {"Headword": "가", "Meaning": "나"}
    assert told(spark, bare, terms.category_response) == "가은(는) 나"
    assert told(spark, bare, terms.term_variants) == "가"
    assert told(spark, {**bare, "Hanja": "可"}, terms.term_variants) == "가(可)"


@pytest.mark.parametrize(
    "meaning, brief", [("a. b", "a."), ("no stop", "no stop."), (".x", "."), ("3.5mm", "3.")]
)
def test_brief_meaning(spark, meaning, brief):
    assert told(spark, {"Headword": "가", "Meaning": meaning}, terms.brief_meaning) == brief


def test_blank_is_what_strip_leaves_empty(spark):
    texts = [*BLANKS, "x", " x ", "​", "ㅤ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", validity.is_valid(F.col("t")), validity.valid(F.col("t"))).collect()
    for text, flag, kept in rows:
        expected = text is not None and text.strip() != ""
        assert flag is expected, repr(text)
        assert kept == (text if expected else None)
    stripped = df.select("t", validity.strip(F.col("t"))).filter("t is not null").collect()
    assert all(ours == text.strip() for text, ours in stripped)


def test_na_tokens(spark):
    df = spark.createDataFrame([(t, 1) for t in (*validity.NA_TOKENS, "Na", " NA")], "t string, n int")
    kept = [row.t for row in validity.na_to_null(df).collect() if row.t is not None]
    assert kept == ["Na", " NA"]
    assert validity.na_to_null(df, []).filter("t = 'NA'").count() == 1


def test_templates_expand_once(spark):
    row = {"Headword": "{context} {Headword} 'a'", "Meaning": 'm "q"\n|', "Related_Word": "{x}"}
    asked = pairs.qa_pairs(vocab(spark, row), pairs_per_row=9)
    for pair in asked.collect():
        options = [
            t.format(Headword=row["Headword"], context="CTX") for t in questions.TEMPLATES[pair.type]
        ]
        context = f"용어명: {row['Headword']} | 정의: {row['Meaning']} | 관련어: {{x}}"
        assert pair.question in [o.replace("CTX", context) for o in options]


def test_chat_rendering_and_spans(spark):
    df = spark.createDataFrame([("q1", "a1")], "q string, a string")
    messages = chat.to_messages(F.col("q"), F.col("a"))
    text = (
        "<start_of_turn>user\nq1<end_of_turn>\n<start_of_turn>model\na1<end_of_turn>"
    )
    assert one(df.select(chat.render_chat(messages))) == text
    assert one(df.select(chat.render_pair(F.col("q"), F.col("a")))) == text
    assert one(df.select(chat.render_prompt(F.col("q")))) == text[: text.index("a1")]
    many = F.concat(messages, messages)
    spans = one(df.select(chat.response_spans(chat.render_chat(many))))
    assert spans.prompt == text[: text.index("a1")]
    assert spans.responses == ["a1<end_of_turn>\n", "a1<end_of_turn>"]
    assert spans.response_share == pytest.approx(31 / (2 * len(text) + 1))
    none = one(df.select(chat.response_spans(F.col("q"))))
    assert (none.prompt, none.responses, none.response_share) == ("q1", [], 0.0)


def test_short_chat_is_an_error(spark):
    from termloom.schemas import CHAT

    df = spark.createDataFrame([([("user", "q")],)], CHAT)
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        df.select(*chat.messages_to_eval(F.col("messages"))).collect()


@pytest.mark.parametrize(
    "response, index",
    [
        ("C", 2), (" b. because", 1), ("The answer is D", 0), ("", -1), ("정답: B", 1), (None, -1),
        ("　d", 3), ("xyz", -1), ("ẚ", 0), ("xc b", 1), ("ß", -1), ("\x1fD A", 3),
    ],
)
def test_extract_choice(spark, response, index):
    df = spark.createDataFrame([(response,)], "r string")
    assert one(df.select(grading.extract_choice(F.col("r")))) == index
    if response is not None:
        upper = response.upper().strip()
        expected = next((i for i, c in enumerate("ABCD") if upper.startswith(c)), None)
        if expected is None:
            expected = next((i for i, c in enumerate("ABCD") if c in upper), -1)
        assert index == expected


def test_choice_prompt(spark):
    source = spark.createDataFrame(
        [("q?", "w", "x", "y", "z", "D", "Law")],
        "question string, A string, B string, C string, D string, answer string, subject string",
    )
    item = choice.choice_items(source).first()
    assert item.prompt == (
        "질문: 대한민국의 수도는?\nA. 부산\nB. 서울\nC. 대구\nD. 인천\n\n"
        "정답을 A, B, C, D 중 하나로 답하세요. 정답: B\n\n"
        "질문: q?\nA. w\nB. x\nC. y\nD. z\n\n정답을 A, B, C, D 중 하나로 답하세요. 정답:"
    )
    assert (item.answer, item.choices) == (3, ["w", "x", "y", "z"])


def test_answers_and_labels(spark):
    df = spark.createDataFrame([("A", 2), ("D", 4), ("E", -1), ("AB", 0), (None, None)], "a string, n int")
    rows = df.select(
        grading.normalize_answer(F.col("a")),
        grading.normalize_answer(F.col("n"), numeric=True, answer_base=1),
        grading.choice_label(F.col("n")),
        grading.choice_label(F.col("n"), F.col("n")),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (0, 1, "C", "C"),
        (3, 3, "INVALID", "4"),
        (4, -2, "INVALID", "-1"),
        (None, -1, "A", "A"),
        (None, None, "INVALID", None),
    ]


def test_headword_and_abbreviation(spark):
    df = spark.createDataFrame(
        [
            ("전술 탄도은(는) x ☜ UV Filter",),
            ("TERM 전술 ☜ kW",),
            ("가나☜　TBM-7",),
            ("x",),
        ],
        "t string",
    )
    rows = df.select(
        grading.extract_headword(F.col("t")), grading.extract_abbreviation(F.col("t"))
    ).collect()
    assert [tuple(r) for r in rows] == [("전술", "UV"), (None, None), ("가나", "TBM-7"), (None, None)]


def test_buckets(spark):
    values = [0, 128, 129, 256, 2048, 2049, 4096, 9999]
    df = spark.createDataFrame([(v,) for v in values], "n bigint")
    found = [r[0] for r in df.select(lengths.round_to_bucket(F.col("n"))).collect()]
    assert found == [128, 128, 256, 256, 2048, 3072, 4096, 4096]


@pytest.mark.parametrize(
    "p99, limit", [(96.0, 128), (96.99, 128), (97.0, 256), (95.9999999999, 128), (5000.0, 2048)]
)
def test_recommended_length(spark, p99, limit):
    df = spark.createDataFrame([(p99,)], "p double")
    assert one(df.select(lengths.recommend_length(F.col("p")))) == limit
    assert one(df.select(lengths.recommend_length(F.col("p"), override=77))) == 77


def test_word_length(spark):
    texts = ["", " ", "a", " a", "a ", " a  b\n\tc ", "a b", "\n\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(lengths.word_length(F.col("t"))).collect()]
    assert found == [len(t.split()) for t in texts]


def load_characters():
    return list


def test_token_length(spark):
    df = spark.createDataFrame([("abc",), ("",), (None,)], "t string")
    measure = lengths.token_length(load_characters, extra_tokens=1)
    assert [r[0] for r in df.select(measure(F.col("t"))).collect()] == [4, 1, None]
