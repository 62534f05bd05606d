"""Round trips through every reader and writer."""

import json
import zipfile
from datetime import datetime
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from termloom.functions.chat import to_messages
from termloom.operators import choice, combine, recall
from termloom.schemas import CHOICE_REPORT, RECALL_REPORT, VOCAB, VOCAB_HEADERS
from termloom.sources import jsonl, reports, settings, subjects, vocab_csv, workbook

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINK = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def letter(i):
    return chr(65 + i) if i < 26 else chr(64 + i // 26) + chr(65 + i % 26)


def write_workbook(path, rows, shared=False):
    """A minimal workbook; a cell is (style, number), a text, a number, a flag or None."""
    strings, lines = [], []
    for r, row in enumerate(rows, 1):
        cells = []
        for c, value in enumerate(row):
            at = f"{letter(c)}{r}"
            if value is None:
                continue
            if isinstance(value, tuple):
                cells.append(f'<c r="{at}" s="{value[0]}"><v>{value[1]}</v></c>')
            elif isinstance(value, bool):
                cells.append(f'<c r="{at}" t="b"><v>{int(value)}</v></c>')
            elif isinstance(value, (int, float)):
                cells.append(f'<c r="{at}"><v>{value}</v></c>')
            elif shared:
                strings.append(value)
                cells.append(f'<c r="{at}" t="s"><v>{len(strings) - 1}</v></c>')
            else:
                text = f'<t xml:space="preserve">{escape(value)}</t>'
                cells.append(f'<c r="{at}" t="inlineStr"><is>{text}</is></c>')
        if cells:
            lines.append(f'<row r="{r}">{"".join(cells)}</row>')
    with zipfile.ZipFile(path, "w") as out:
        out.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{MAIN}" xmlns:r="{LINK}"><sheets><sheet name="a" sheetId="1"'
            ' r:id="rId7"/><sheet name="b" sheetId="2" r:id="rId8"/></sheets></workbook>',
        )
        out.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="x"><Relationship Id="rId7" Target="worksheets/sheet1.xml"/>'
            '<Relationship Id="rId8" Target="worksheets/sheet2.xml"/></Relationships>',
        )
        items = "".join(
            f'<si><r><t xml:space="preserve">{escape(s[:1])}</t></r><r><t xml:space="preserve">'
            f"{escape(s[1:])}</t></r><rPh><t>no</t></rPh></si>"
            for s in strings
        )
        out.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{items}</sst>')
        out.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{MAIN}"><numFmts><numFmt numFmtId="200" formatCode="yyyy\\-mm"/>'
            '<numFmt numFmtId="201" formatCode="0.0&quot;d&quot;"/></numFmts><cellXfs>'
            '<xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="200"/><xf numFmtId="201"/>'
            "</cellXfs></styleSheet>",
        )
        out.writestr(
            "xl/worksheets/sheet1.xml",
            f'<worksheet xmlns="{MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
        )


@pytest.fixture
def books(tmp_path):
    folder = tmp_path / "books"
    folder.mkdir()
    write_workbook(
        folder / "b.xlsx",
        [
            [None, "표제어", "의미", "등록일", "약어"],
            [0, "가 <1>", "뜻\n둘", (1, 45292), "NA"],
            [1, "나", 3.5, (2, 45292.5), None],
            [],
            [3, "가 <1>", "뜻\n둘", (1, 45292), "NA"],
        ],
    )
    write_workbook(
        folder / "a.xlsx", [["i", "의미", "기타", "표제어"], [0, "다", 12, "라"]], shared=True
    )
    (folder / "note.txt").write_text("not a workbook")
    return str(folder)


def test_workbooks_are_stacked_by_name(spark, books):
    rows = workbook.read_workbooks(spark, books)
    assert rows.columns == ["의미", "기타", "표제어", "등록일", "약어"]
    found = sorted((tuple(r) for r in rows.collect()), key=str)
    assert found == sorted(
        [
            ("다", "12", "라", None, None),
            ("뜻\n둘", None, "가 <1>", "2024-01-01", None),
            ("3.5", None, "나", "2024-01-01 12:00:00", None),
            (None, None, None, None, None),
            ("뜻\n둘", None, "가 <1>", "2024-01-01", None),
        ],
        key=str,
    )
    named = workbook.read_workbooks(spark, books, list(VOCAB_HEADERS))
    table = combine.rename_vocab(named)
    assert table.columns == VOCAB.names
    assert combine.count_duplicates(table).first().duplicates == 1


def test_empty_folder_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        workbook.read_workbooks(spark, str(tmp_path))


def test_workbook_to_jsonl_keeps_kinds(spark, tmp_path):
    path = str(tmp_path / "e.xlsx")
    write_workbook(
        path,
        [
            ["질문", "n", "x", "ok", "when", "mixed", "part"],
            ["가", 1, 1.5, True, (1, 45292), 1, 1],
            ["나", 2, 2, False, (1, 45293), "b", None],
        ],
    )
    workbook.workbook_to_jsonl(spark, path, str(tmp_path / "out"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(lines, key=lambda x: x["n"]) == [
        {"질문": "가", "n": 1, "x": 1.5, "ok": True, "when": 1704067200000, "mixed": "1", "part": 1.0},
        {"질문": "나", "n": 2, "x": 2.0, "ok": False, "when": 1704153600000, "mixed": "b", "part": None},
    ]


def test_vocab_csv_round_trip(spark, tmp_path):
    values = ['say "x", y', "two\nlines", " kept ", "　", "a\\b", "", "NA", None]
    rows = [tuple([v] + ["k"] * 12) for v in values]
    table = spark.createDataFrame(rows, VOCAB)
    vocab_csv.write_vocab_csv(table, str(tmp_path / "csv"))
    back = vocab_csv.read_vocab_csv(spark, str(tmp_path / "csv"))
    assert back.columns == VOCAB.names
    found = [r.Category for r in back.collect()]
    expected = [v if v not in ("", "NA") else None for v in values]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    kept = vocab_csv.read_vocab_csv(spark, str(tmp_path / "csv"), na_tokens=())
    assert kept.filter("Category = 'NA'").count() == 1


def test_chat_jsonl_round_trip(spark, tmp_path):
    pairs = spark.createDataFrame([('한 "글"\n', "답\\"), ("q", "a")], "q string, a string")
    chats = pairs.select(to_messages(F.col("q"), F.col("a")).alias("messages"))
    path = str(tmp_path / "chats")
    jsonl.write_jsonl(chats, path)
    raw = sorted(r.value for r in spark.read.text(path).collect())
    assert raw[0].startswith('{"messages":[{"role":"user","content":"q"}')
    assert "한" in raw[1]
    assert sorted(map(str, jsonl.read_chat_jsonl(spark, path).collect())) == sorted(
        map(str, chats.collect())
    )


def test_malformed_line_fails(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"question":"q","ground_truth":"t"}\n{"question":\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        jsonl.read_eval_jsonl(spark, str(tmp_path / "bad.jsonl")).collect()


def test_eval_jsonl(spark, tmp_path):
    (tmp_path / "ok.jsonl").write_text('{"ground_truth": "답", "question": "q"}\n', "utf-8")
    assert [tuple(r) for r in jsonl.read_eval_jsonl(spark, str(tmp_path / "ok.jsonl")).collect()] == [
        ("q", "답")
    ]


def test_subjects_are_pruned_and_missing_ones_named(spark, tmp_path):
    rows = spark.createDataFrame(
        [("q1", "Law"), ("q2", "Economics"), ("q3", "Chemistry")], "question string, subject string"
    )
    rows.write.partitionBy("subject").parquet(str(tmp_path / "s"))
    items = subjects.read_subjects(spark, str(tmp_path / "s"))
    assert {r.subject for r in items.collect()} == {"Law", "Economics"}
    plan = items._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "subject#" in plan.split("PartitionFilters: [")[1]
    missing = {r.subject for r in subjects.missing_subjects(items).collect()}
    assert missing == {"Korean-History", "Criminal-Law", "Psychology"}


def test_reports_and_details(spark, tmp_path):
    judged = recall.judged(
        spark.createDataFrame(
            [("1", "q", "가", "가 x", 0.9)],
            "sample_id string, question string, prediction string, ground_truth string, score double",
        )
    )
    report = recall.recall_report(judged, "r1", "2026-01-01T00:00:00")
    reports.write_report(report, str(tmp_path / "t1"))
    back = reports.read_report(spark, str(tmp_path / "t1"), RECALL_REPORT)
    assert back.first() == report.first()
    details = recall.recall_details(judged.withColumn("row_index", F.lit(0)))
    reports.write_details(details, str(tmp_path / "d1"))
    (line,) = spark.read.text(str(tmp_path / "d1")).collect()
    assert json.loads(line.value)["headword_correct"] is True
    for run in ("r1", "r2"):
        reports.write_by_run(details, str(tmp_path / "runs"), run)
    assert spark.read.parquet(str(tmp_path / "runs")).filter("run_name = 'r2'").count() == 1

    answered = choice.with_choice(
        spark.createDataFrame([("Law", 0, "A")], "subject string, answer int, response string")
    )
    second = choice.choice_report(answered, answered, "r1", "t")
    reports.write_report(second, str(tmp_path / "t2"))
    assert reports.read_report(spark, str(tmp_path / "t2"), CHOICE_REPORT).first().finetuned.by_subject[
        "Law"
    ].total == 1


def test_settings_merge(spark, tmp_path):
    path = str(tmp_path / "settings")
    settings.append_settings(spark, path, "r", {"a": 1, "b": "x"}, datetime(2026, 1, 1))
    settings.append_settings(spark, path, "r", {"a": 2}, datetime(2026, 1, 2))
    latest = settings.latest_config(spark.read.parquet(path))
    assert {(r.key, r.value) for r in latest.collect()} == {("a", "2"), ("b", "x")}
    assert tuple(settings.setting(latest, "r", "a", 9).first()) == ("2", False)
    assert tuple(settings.setting(latest, "r", "zz", 2048).first()) == ("2048", True)
