"""The registered queries as SQL for DuckDB, written from the meaning of each operator.

Views are common table expressions; each query names the ones it needs and gets theirs too.
"""

from __future__ import annotations

from string import Formatter

from termloom.functions import grading
from termloom.functions.chat import RESPONSE_MARKER, TURN_END, USER_MARKER
from termloom.functions.lengths import BUCKETS, MARGIN, MAX_SEQUENCE
from termloom.functions.questions import TEMPLATES
from termloom.functions.terms import CONTEXT_LABELS
from termloom.functions.validity import BLANK, BLANK_TEXT, NA_TOKENS
from termloom.plans.standins import VIEWS, standin_sql
from termloom.schemas import VOCAB_COLUMNS


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def drawn(seed: int, *parts: str) -> str:
    return f"md5(concat_ws('|', '{seed}', {', '.join(parts)}))"


def digest(columns: list[str]) -> str:
    parts = [f"coalesce(cast(strlen({c}) as varchar), 'N'), coalesce({c}, '')" for c in columns]
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def case(number: str, choices: dict[int, str]) -> str:
    return (
        f"case {number} " + " ".join(f"when {k} then {v}" for k, v in choices.items()) + " end"
    )


def is_valid(column: str) -> str:
    return f"({column} is not null and not regexp_matches({column}, {quoted(BLANK_TEXT)}))"


def filled(template: str) -> str:
    pieces = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(quoted(literal))
        if field:
            pieces.append(ANSWERS["extraction_context"] if field == "context" else field)
    return " || ".join(pieces)


COLS = ", ".join(VOCAB_COLUMNS)

# (condition, type) of the types a row may get.
TYPE_TESTS = {
    1: "true",
    2: "Abbreviation is not null",
    3: "Original_Word is not null and length(Original_Word) < 50",
    4: "Hypernym is not null",
    5: "Category is not null or Hypernym is not null",
    6: "true",
    7: "Abbreviation is not null",
    8: "true",
    9: "true",
}

TERM = (
    "(Headword || case when Hanja is null and Original_Word is null then ''"
    " else '(' || concat_ws(', ', Hanja, Original_Word) || ')' end)"
)
BRIEF = "(split_part(Meaning, '.', 1) || '.')"
ANSWERS = {
    "term_variants": TERM,
    "brief_meaning": BRIEF,
    "full_response": (
        f"concat_ws(' ', {TERM} || '은(는) ' || Meaning, '☜ ' || Abbreviation,"
        " '이 용어는 ' || Category || '에 속한다.',"
        " Headword || '은(는) ' || Hypernym || '의 한 종류이다.',"
        " '예를 들어, ' || Headword || '의 하위 개념으로는 ' || Hyponym || ' 등이 있다.',"
        " '동의어로는 ' || Synonym || '를(을) 들 수 있다.',"
        " '관련어로는 ' || Related_Word || '가(이) 있다.',"
        " '이 용어는 ' || Dictionary_Name || '에 수록되어 있다.')"
    ),
    "classification_response": (
        f"concat_ws(' ', {TERM} || '은(는) ' || Hypernym || '의 한 종류입니다.', {BRIEF})"
    ),
    "characteristics_response": (
        "concat_ws(' ', Headword || '의 주요 특성은 다음과 같습니다: ' || Meaning,"
        " '하위 유형으로는 ' || Hyponym || ' 등이 있습니다.')"
    ),
    "abbreviation_response": (
        f"concat_ws(' ', Abbreviation || '는(은) ' || {TERM} || '의 약어입니다.', {BRIEF})"
    ),
    "mechanism_response": f"{TERM} || '의 작동 원리는 다음과 같습니다: ' || Meaning",
    "extraction_context": "concat_ws(' | ', "
    + ", ".join(f"'{label}: ' || {field}" for label, field in CONTEXT_LABELS.items())
    + ")",
    "extraction_response": "Headword || '의 정의: ' || Meaning",
}
ANSWERS["category_response"] = (
    "case when Category is null and Hypernym is null then "
    + ANSWERS["full_response"]
    + " else concat_ws(' ', Headword || '은(는) ' || Category || '에 속합니다.',"
    " Headword || '은(는) ' || Hypernym || '의 한 종류입니다.') end"
)
TYPE_ANSWER = {
    1: "full_response",
    2: "full_response",
    3: "full_response",
    4: "classification_response",
    5: "category_response",
    6: "characteristics_response",
    7: "abbreviation_response",
    8: "mechanism_response",
    9: "extraction_response",
}

TEMPLATE = (
    f"cast(((cast('0x' || substr({drawn(42, 'row_key', 'cast(type as varchar)', quoted('template'))}"
    ", 1, 8) as bigint) * "
    + case("type", {t: str(len(texts)) for t, texts in TEMPLATES.items()})
    + ") >> 32) as integer)"
)
QUESTION = case(
    "type",
    {
        t: case("template", {i: filled(text) for i, text in enumerate(texts)})
        for t, texts in TEMPLATES.items()
    },
)
RESPONSE = case("type", {t: ANSWERS[name] for t, name in TYPE_ANSWER.items()})


def types_of(source: str) -> str:
    return " union all ".join(
        f"select *, {t} as type from {source} where {test}" for t, test in TYPE_TESTS.items()
    )


def keyed(source: str, *others: str) -> str:
    """Row key over the raw values, then blanks to NULL, then rows with the required fields."""
    cleaned = ", ".join(f"case when {is_valid(c)} then {c} end as {c}" for c in VOCAB_COLUMNS)
    return (
        f"select * from (select * exclude ({COLS}), {digest([*VOCAB_COLUMNS, *others])} as row_key, {cleaned}"
        f" from {source}) where Headword is not null and Meaning is not null"
    )


def picked(source: str, by: str) -> str:
    lot = "substr(sha256(concat_ws('|', '42', row_key, 'types')), (type - 1) * 7 + 1, 7)"
    rank = f"row_number() over (partition by {by} order by {lot}, type)"
    return (
        f"select * exclude (lot) from (select *, {rank} as lot from ({types_of(source)}))"
        " where lot <= 4"
    )


def hit(number: str) -> str:
    return f"count(*) filter (where {number})"


def rendered(question: str, answer: str) -> str:
    return (
        f"{quoted(USER_MARKER)} || {question} || {quoted(TURN_END)} || chr(10) ||"
        f" {quoted(RESPONSE_MARKER)} || {answer} || {quoted(TURN_END)}"
    )


def prompt(question: str) -> str:
    return (
        f"{quoted(USER_MARKER)} || {question} || {quoted(TURN_END)} || chr(10) ||"
        f" {quoted(RESPONSE_MARKER)}"
    )


def words(text: str) -> str:
    return rf"len(regexp_extract_all({text}, '\S+'))"


def position(seed: int, key: str, salt: str) -> str:
    return f"row_number() over (order by {drawn(seed, key, quoted(salt))})"


RECOMMEND = (
    f"least(case "
    + " ".join(f"when floor(round(p99, 6)) + {MARGIN} <= {b} then {b}" for b in BUCKETS)
    + f" else {BUCKETS[-1]} end, {MAX_SEQUENCE})"
)


def bucket(length: str) -> str:
    return (
        "case "
        + " ".join(f"when {length} <= {b} then {b}" for b in BUCKETS)
        + f" else {BUCKETS[-1]} end"
    )


UPPER = "translate(response, 'abcdẚ', 'ABCDA')"
CHOSEN = (
    "case "
    + " ".join(
        f"when starts_with(regexp_replace({UPPER}, {quoted(rf'\A[{BLANK}]+')}, ''), '{letter}')"
        f" then {i}"
        for i, letter in enumerate("ABCD")
    )
    + " "
    + " ".join(
        f"when contains({UPPER}, '{letter}') then {i}" for i, letter in enumerate("ABCD")
    )
    + " else -1 end"
)


def chosen(response: str) -> str:
    return (
        f"select *, predicted = answer as correct from (select * exclude (response), {response} as"
        f" response, {CHOSEN.replace('response', response)} as predicted from items"
        " where answer is not null)"
    )


def letter(number: str, otherwise: str) -> str:
    return f"case when {number} between 0 and 3 then substr('ABCD', {number} + 1, 1) else {otherwise} end"


HEADWORD = "nullif(regexp_extract(ground_truth, '^([가-힣]+)', 1), '')"
ABBREVIATION = f"nullif(regexp_extract(ground_truth, {quoted(grading.ABBREVIATION)}, 1), '')"


def leakage(held: str, kept: str) -> str:
    return (
        "select 'question' as level, count(*) as evaluated,"
        f" {hit(f'question in (select question from {kept})')} as leaked from {held} union all"
        " select 'pair', count(*), count(*) filter (where (question, ground_truth) in"
        f" (select (question, ground_truth) from {kept})) from {held} union all"
        f" select 'headword', count(*), {hit(f'h in (select {HEADWORD} from {kept})')} from"
        f" (select {HEADWORD} as h from {held}) where h is not null"
    )


def compared(second_score: str) -> str:
    """Three metrics of two variants, then the verdict over all."""
    f1 = (
        "(select avg(score) from predictions where sample_id % 2 = 0)",
        f"(select avg({second_score}) from predictions where sample_id % 2 = 1)",
    )
    named = "avg(case when headword is null or headword_hit then 1.0 else 0.0 end)"
    heads = [f"(select {named} from judged where sample_id % 2 = {rest})" for rest in (0, 1)]
    right = [f"(select avg(cast(correct as integer)) from {v})" for v in ("chosen", "base_chosen")]
    rows = " union all ".join(
        f"select '{metric}' as metric, {a} as f, {b} as q"
        for metric, (a, b) in {
            "test1_bertscore_f1": f1,
            "test1_headword_recall": heads,
            "test2_accuracy": right,
        }.items()
    )
    passed = "coalesce(f - q <= 0.05, false)"
    return (
        f"select metric, round(f, 6) as \"full\", round(q, 6) as quantised, round(f - q, 6) as"
        f" performance_drop, {passed} as passed from ({rows}) union all select 'overall', null,"
        f" null, null, bool_and({passed}) from ({rows})"
    )


WITH = {name: standin_sql(name) for name in VIEWS}
WITH |= {
    "vocab_rows": f"select distinct {COLS} from vocab",
    "usable_docs": keyed("vocab", "cast(doc_id as varchar)"),
    "usable_rows": keyed("vocab_rows"),
    "doc_types": picked("usable_docs", "doc_id"),
    "row_types": picked("usable_rows", "row_key"),
    "pairs": (
        "select md5(concat_ws('|', row_key, cast(type as varchar))) as sample_id, row_key, type,"
        f" {QUESTION} as question, {RESPONSE} as response"
        f" from (select *, {TEMPLATE} as template from row_types)"
    ),
    "pair_texts": f"select sample_id, {rendered('question', 'response')} as text from pairs",
    "ranked": (
        "select sample_id, question, response as ground_truth,"
        f" {position(42, 'sample_id', 'holdout')} as place, count(*) over () as n from pairs"
    ),
    "held": "select * from ranked where place <= greatest(floor(n * cast(0.05 as double)), 1)",
    "kept": "select * from ranked where place > greatest(floor(n * cast(0.05 as double)), 1)",
    "chat_pairs": (
        "select u.conv_id, u.turn, u.text as question, a.text as ground_truth from conversations u"
        " join conversations a on u.conv_id = a.conv_id and a.turn = u.turn + 1"
        " where u.role = 'user' and a.role = 'assistant'"
    ),
    "pair_lengths": f"select {words('text')} as length from pair_texts",
    "doc_lengths": f"select doc_id, {words('text')} as length from documents",
    "judged": (
        "select *, contains(prediction, headword) as headword_hit, contains(lower(prediction),"
        f" lower(abbreviation)) as abbreviation_hit from (select *, {HEADWORD} as headword,"
        f" {ABBREVIATION} as abbreviation from predictions)"
    ),
    "items": (
        "select * exclude (answer), case when length(answer) = 1 then ascii(answer) - 65 end as"
        " answer from choice_source"
    ),
    "chosen": chosen("response"),
    "base_chosen": chosen("base_response"),
    "prompt_ids": (
        "select conv_id, turn, list_transform(string_split(question, ' '), lambda w: length(w)) as"
        f" ids, cast(floor(({position(42, quoted('') + ' || conv_id || ' + quoted('-') + ' || turn', 'batch')}"
        " - 1) / 16) as bigint) as batch from chat_pairs"
    ),
    "prompt_widths": (
        "select *, cast(max(len(ids)) over (partition by batch) as integer) as padded_length from"
        " prompt_ids"
    ),
    "length_ids": (
        "select conv_id, turn, question, cast(len(ids) as integer) as length, cast(floor((row_number()"
        f" over (order by len(ids), {drawn(42, quoted('') + ' || conv_id || ' + quoted('-') + ' || turn', quoted('batch'))})"
        " - 1) / 16) as bigint) as batch from (select *, string_split(question, ' ') as ids from"
        " chat_pairs)"
    ),
    "spoken": (
        "select sample_id, true as predicted, unnest(list_filter(string_split_regex(prediction,"
        r" '\s+'), lambda w: w <> '')) as word from predictions union all select sample_id, false,"
        r" unnest(list_filter(string_split_regex(ground_truth, '\s+'), lambda w: w <> ''))"
        " from predictions"
    ),
    "counted": (
        f"select sample_id, word, {hit('predicted')} as here, {hit('not predicted')} as there"
        " from spoken group by sample_id, word"
    ),
    "token_shares": (
        "select sample_id, coalesce(sum(case when there > 0 then here else 0 end) /"
        " nullif(cast(sum(here) as double), 0), 0) as p, coalesce(sum(case when here > 0 then there"
        " else 0 end) / nullif(cast(sum(there) as double), 0), 0) as r from counted group by"
        " sample_id"
    ),
    "angles": (
        "select sample_id, predicted, length(w) % 8 as a, count(*) as n from (select sample_id, true"
        " as predicted, unnest(string_split(prediction, ' ')) as w from predictions union all select"
        " sample_id, false, unnest(string_split(ground_truth, ' ')) from predictions) where w <> ''"
        " group by all"
    ),
    "angle_shares": (
        "select sample_id, predicted, sum(n * best) / sum(n) as share from (select x.sample_id,"
        " x.predicted, x.a, any_value(x.n) as n, max(cos((x.a - y.a) * pi() / 16)) as best from"
        " angles x join angles y on x.sample_id = y.sample_id and x.predicted <> y.predicted"
        " group by x.sample_id, x.predicted, x.a) group by sample_id, predicted"
    ),
    "partly": (
        "select * exclude (score), case when sample_id % 4 <> 0 then score end as score from judged"
    ),
    "vectors": (
        "select cast(floor(vec_id / 16) as bigint) as text_pair, vec_id % 16 < 8 as predicted,"
        " vec_id, cast(embedding as double[]) as v from embeddings"
    ),
    "cosines": (
        "select a.text_pair, a.vec_id as i, b.vec_id as j, list_cosine_similarity(a.v, b.v) as c"
        " from vectors a join vectors b on a.text_pair = b.text_pair and a.predicted and not"
        " b.predicted"
    ),
}

SQL: dict[str, str] = {
    "vocab_valid_rows": (
        f"select doc_id, Headword, Meaning from vocab where {is_valid('Headword')} and"
        f" {is_valid('Meaning')}"
    ),
    "vocab_dedup": f"select distinct {COLS} from vocab",
    "vocab_duplicate_count": (
        "select (select count(*) from vocab) as entries, (select count(*) from vocab) -"
        " (select count(*) from vocab_rows) as duplicates"
    ),
    "vocab_union": (
        "select doc_id, Category, Headword, Meaning, null as Abbreviation, null as Source from"
        " vocab union all by name select doc_id, Headword, Abbreviation, Source from vocab"
    ),
    "na_tokens_to_null": (
        "select doc_id, case when n_chars % 3 = 2 and lang not in ("
        + ", ".join(quoted(t) for t in NA_TOKENS)
        + ") then lang end as lang, case when text not in ("
        + ", ".join(quoted(t) for t in NA_TOKENS)
        + ") then text end as text from documents"
    ),
    **{name: f"select doc_id, {text} as text from usable_docs" for name, text in ANSWERS.items()},
    "available_types": f"select doc_id, type from ({types_of('usable_docs')})",
    "picked_types": "select doc_id, row_key, type from doc_types",
    "picked_templates": f"select doc_id, type, {TEMPLATE} as template from doc_types",
    "qa_pairs": "select * from pairs",
    "qa_type_counts": "select type, count(*) as samples from pairs group by type",
    "qa_skipped": (
        f"select count(*) as entries, {hit(f'not ({is_valid('Headword')} and {is_valid('Meaning')})')}"
        " as skipped, (select count(*) from pairs) as pairs from vocab_rows"
    ),
    "chat_messages": (
        "select sample_id, 0 as place, 'user' as role, question as content from pairs union all"
        " select sample_id, 1, 'assistant', response from pairs"
    ),
    "chat_json_lines": (
        "select to_json({'messages': [{'role': 'user', 'content': question}, {'role': 'assistant',"
        " 'content': response}]})::varchar as value from pairs"
    ),
    "chat_rendered": "select sample_id, text from pair_texts",
    "prompts_rendered": f"select conv_id, turn, {prompt('question')} as prompt from chat_pairs",
    "response_spans": (
        f"select conv_id, turn, {prompt('question')} as prompt, ground_truth || {quoted(TURN_END)}"
        f" as response, round(cast(length(ground_truth) + {len(TURN_END)} as double) /"
        f" length({rendered('question', 'ground_truth')}), 6) as response_share from chat_pairs"
    ),
    "eval_from_messages": "select * from chat_pairs",
    "previews": "select sample_id, substr(response, 1, 200) as preview from pairs",
    "sample_ids": (
        f"select text, {digest(['text'])} || '-' || (row_number() over (partition by text) - 1) as"
        " sample_id from documents"
    ),
    "holdout_sample": "select sample_id, question, ground_truth from held",
    "train_eval_split": (
        f"select sample_id, case when {position(3407, 'sample_id', 'split')} <= ceil(count(*) over ()"
        " * cast(0.05 as double)) then 'eval' else 'train' end as split from pairs"
    ),
    "cap_rows": (
        "select sample_id, question, response as ground_truth from pairs qualify"
        f" {position(42, 'sample_id', 'cap')} <= 50"
    ),
    "validation_sample": (
        "select * from chat_pairs qualify"
        f" {position(42, quoted('') + ' || conv_id || ' + quoted('-') + ' || turn', 'validation')} <= 100"
    ),
    "shuffled_rank": (
        f"select sample_id, {position(42, 'sample_id', 'shuffle')} - 1 as position from pairs"
    ),
    "shuffled_chats": (
        f"select {drawn(42, 'sample_id', quoted('shuffle'))} as drawn, question, response from pairs"
    ),
    "head_rows": (
        f"select sample_id, question from pairs qualify {position(42, 'sample_id', 'shuffle')} <= 3"
    ),
    "train_without_holdout": "select sample_id, question from kept",
    "train_without_labelled": (
        "select sample_id, question from predictions where sample_id not in (select doc_id from labels)"
    ),
    "leakage_report": leakage("held", "kept"),
    "leakage_between_tables": leakage(
        "(select * from predictions where sample_id not in (select doc_id from labels))",
        "(select * from predictions where sample_id in (select doc_id from labels))",
    ),
    "stratified_sample": (
        "select doc_id, lang from documents qualify row_number() over (partition by lang order by"
        f" {drawn(42, 'cast(doc_id as varchar)', quoted('stratum'))}) <= 20"
    ),
    "requested_minus_found": (
        "select doc_id from documents except select doc_id from labels"
    ),
    "top_scores": (
        "select sample_id, round(score, 6) as score, row_number() over (order by score desc,"
        " sample_id) - 1 as position from predictions qualify position < 25"
    ),
    "rank_scores": (
        "select sample_id, round(score, 6) as score, row_number() over (order by score desc,"
        " sample_id) - 1 as position from predictions"
    ),
    "token_lengths": (
        f"select doc_id, {words('text')} as words, length(text) as chars from documents"
    ),
    "length_stats": (
        "select min(length) as min, max(length) as max, round(avg(length), 6) as mean,"
        " round(quantile_cont(length, 0.5), 6) as median, round(quantile_cont(length, 0.95), 6) as"
        " p95, round(quantile_cont(length, 0.99), 6) as p99, count(*) as num_samples from"
        " pair_lengths"
    ),
    "recommended_length": (
        f"select num_samples, cast({RECOMMEND} as integer) as recommended_max_seq_length from (select"
        " count(*) as num_samples, quantile_cont(length, 0.99) as p99 from pair_lengths)"
    ),
    "length_buckets": (
        f"select {bucket('length')} as bucket, count(*) as samples from doc_lengths group by 1"
    ),
    "over_limit": (
        f"select {hit('length > m')} as over_limit, count(*) as num_samples,"
        f" round({hit('length > m')} * cast(100 as double) / count(*), 6) as over_limit_percent"
        f" from doc_lengths, (select {RECOMMEND} as m from (select quantile_cont(length, 0.99) as"
        " p99 from doc_lengths))"
    ),
    "score_summary": (
        "select round(avg(score), 6) as f1_mean, round(stddev_pop(score), 6) as f1_std,"
        " count(score) as num_samples from predictions"
    ),
    "score_histogram": (
        "select cast(b as integer) as bin, round(lo + b * (hi - lo) / 20, 6) as low, round(lo + (b +"
        " 1) * (hi - lo) / 20, 6) as high, (select count(*) from predictions where score >= lo + b *"
        " ((hi - lo) / 20) and (score < lo + (b + 1) * ((hi - lo) / 20) or b = 19)) as n from"
        " range(20) t(b), (select min(score) as lo, max(score) as hi from predictions)"
    ),
    "step_plan": (
        "select n as num_samples, n // 64 as steps_per_epoch, greatest(1, n // 64 // 10) as"
        " eval_steps, greatest(1, n // 64 // 10) as save_steps from (select count(*) -"
        " cast(ceil(count(*) * cast(0.05 as double)) as bigint) as n from pairs)"
    ),
    "step_plan_without_evaluation": (
        "select n as num_samples, n // 64 as steps_per_epoch, cast(null as bigint) as eval_steps,"
        " cast(500 as bigint) as save_steps from (select count(*) as n from pairs)"
    ),
    "aligned_predictions": "select sample_id, prediction, ground_truth from predictions",
    "unmatched_predictions": (
        "select (select count(*) from documents where doc_id not in (select doc_id from labels)) as"
        " predictions_without_truth, (select count(*) from labels where doc_id not in (select doc_id"
        " from documents)) as truths_without_prediction"
    ),
    "headword_hits": (
        "select sample_id, headword, headword_hit, abbreviation, abbreviation_hit from judged"
    ),
    "headword_recall_lenient": (
        "select round(avg(case when headword is null or headword_hit then 1.0 else 0.0 end), 6) as"
        f" accuracy, {hit('headword is null or headword_hit')} as correct, count(*) as total from"
        " judged"
    ),
    "headword_recall_strict": (
        "select round(avg(case when headword_hit then 1.0 else 0.0 end), 6) as accuracy,"
        f" {hit('headword_hit')} as correct, count(*) as total from judged where headword is not"
        " null"
    ),
    "abbreviation_match": (
        "select round(avg(case when abbreviation_hit then 1.0 else 0.0 end), 6) as accuracy,"
        f" {hit('abbreviation_hit')} as correct, count(*) as total from judged where abbreviation"
        " is not null"
    ),
    "headword_counts": (
        f"select {hit('headword is null or headword_hit')} as correct,"
        f" {hit('not (headword is null or headword_hit)')} as incorrect from judged"
    ),
    "recall_details": (
        f"select {position(42, 'cast(sample_id as varchar)', 'index')} - 1 as index, question,"
        " prediction, ground_truth, round(score, 6) as bertscore_f1, headword,"
        " coalesce(headword_hit, true) as headword_correct from judged"
    ),
    "test1_report": (
        "select metric, round(value, 6) as value, passed from (select avg(score) as f1,"
        " stddev_pop(score) as sd, avg(case when headword is null or headword_hit then 1.0 else 0.0"
        " end) as hw, avg(cast(abbreviation_hit as integer)) as ab, count(*) as n from judged),"
        " lateral (values ('bertscore_f1_mean', f1, f1 >= 0.7), ('bertscore_f1_std', sd, null),"
        " ('headword_recall', hw, hw >= 0.8), ('abbreviation_match', ab, null), ('num_samples', n,"
        " f1 >= 0.7 and hw >= 0.8)) t(metric, value, passed)"
    ),
    "validation_report": (
        "select round(avg(score), 6) as bertscore_f1, round(stddev_pop(score), 6) as bertscore_std,"
        " round(coalesce(avg(case when headword is not null then cast(headword_hit as integer)"
        " end), 0), 6) as headword_recall, count(*) as num_samples from judged"
    ),
    "unscored_recall_report": (
        "select metric, round(value, 6) as value, passed from (select avg(score) as f1, count(score)"
        " as s, count(*) - count(score) as u, avg(case when headword is null or headword_hit then"
        " 1.0 else 0.0 end) as hw from partly), lateral (values ('bertscore_f1_mean', f1, f1 >= 0.7"
        " and u = 0), ('num_scored', s, null), ('num_unscored', u, f1 >= 0.7 and u = 0 and hw >="
        " 0.8)) t(metric, value, passed)"
    ),
    "unscored_validation_report": (
        "select round(avg(score), 6) as bertscore_f1, round(stddev_pop(score), 6) as bertscore_std,"
        " round(coalesce(avg(case when headword is not null then cast(headword_hit as integer)"
        " end), 0), 6) as headword_recall, count(*) as num_samples, count(score) as num_scored,"
        " count(*) - count(score) as num_unscored from partly"
    ),
    "mcq_items": (
        "select sample_id, subject, answer, concat_ws(',', A, B, C, D) as choices from items"
    ),
    "mcq_rejected": (
        "select subject, count(*) as rejected from items where answer is null group by subject"
    ),
    "mcq_prompts": (
        f"select sample_id, {quoted(grading.CHOICE_EXAMPLE)} || '질문: ' || question || chr(10) ||"
        " 'A. ' || A || chr(10) || 'B. ' || B || chr(10) || 'C. ' || C || chr(10) || 'D. ' || D ||"
        f" chr(10) || {quoted(grading.CHOICE_CLOSING)} as prompt from items"
    ),
    "mcq_predictions": "select sample_id, predicted, correct from chosen",
    "mcq_accuracy": (
        "select case when grouping(subject) = 1 then 'overall' else 'subject' end as level, subject,"
        f" round({hit('correct')} / cast(count(*) as double), 6) as accuracy, {hit('correct')} as"
        " correct, count(*) as total from chosen group by grouping sets ((subject), ())"
    ),
    "mcq_correct_incorrect": (
        "select case when grouping(subject) = 1 then 'overall' else 'subject' end as level, subject,"
        f" {hit('correct')} as correct, {hit('not correct')} as incorrect from chosen group by"
        " grouping sets ((subject), ())"
    ),
    "mcq_details": (
        f"select {position(42, 'cast(sample_id as varchar)', 'index')} - 1 as index, question,"
        " concat_ws(',', A, B, C, D) as choices, answer as ground_truth_idx,"
        f" {letter('answer', 'cast(answer as varchar)')} as ground_truth, predicted as"
        f" prediction_idx, {letter('predicted', quoted('INVALID'))} as prediction, response,"
        " correct, subject from chosen"
    ),
    "test2_report": (
        "select metric, round(value, 6) as value, passed from (select avg(cast(correct as integer))"
        " as t, count(*) as n, (select avg(cast(correct as integer)) from base_chosen) as b from"
        " chosen), lateral (values ('accuracy', t, t >= 0.3), ('base_accuracy', b, null),"
        " ('performance_drop', b - t, b - t <= 0.1), ('total', n, t >= 0.3 and b - t <= 0.1))"
        " v(metric, value, passed) union all select 'subject ' || subject, round(avg(cast(correct"
        " as integer)), 6), null from chosen group by subject"
    ),
    "variant_comparison": (
        'select metric, round(f, 6) as first_value, round(q, 6) as second_value, round(f - q, 6) as'
        ' "drop", f - q <= 0.05 as passed from (select subject as metric, avg(correct) filter (where'
        " variant = 'full') as f, avg(correct) filter (where variant = 'quantised') as q from"
        " variant_scores group by subject)"
    ),
    "comparison_report": compared("score * cast(0.9 as double)"),
    "comparison_report_unscored": compared("cast(null as double)"),
    "base_comparison": (
        "select round(f, 6) as base_accuracy, round(q, 6) as tuned_accuracy, round(f - q, 6) as"
        " performance_drop, f - q <= 0.1 as drop_acceptable, q >= 0.3 as min_accuracy_met,"
        " f - q <= 0.1 and q >= 0.3 as overall_passed from (select avg(correct) filter (where"
        " variant = 'full') as f, avg(correct) filter (where variant = 'quantised') as q from"
        " variant_scores)"
    ),
    "unshared_samples": (
        "select count(*) filter (where variant = 'full') as only_first, count(*) filter (where"
        " variant = 'quantised') as only_second from variant_scores where sample_id in (select"
        " sample_id from variant_scores group by sample_id having count(distinct variant) = 1)"
    ),
    "left_padded_batches": (
        "select conv_id, turn, batch, padded_length, array_to_string(list_concat(list_transform("
        "range(padded_length - len(ids)), lambda x: 0), ids), ',') as input_ids, array_to_string("
        "list_concat(list_transform(range(padded_length - len(ids)), lambda x: 0), list_transform("
        "ids, lambda x: 1)), ',') as mask from prompt_widths"
    ),
    "prompt_tokens": (
        "select doc_id, cast(list_sum(ids[1:2048]) as bigint) as kept, cast(coalesce(list_sum(ids[5:"
        "]), 0) as bigint) as generated from (select doc_id, list_transform(string_split(text, ' '),"
        " lambda w: length(w)) as ids from documents)"
    ),
    "batched_predictions": (
        f"select conv_id, turn, length({prompt('question')}) || ' characters' as prediction from"
        " chat_pairs"
    ),
    "token_overlap_f1": (
        "select s.sample_id, round(coalesce(p, 0), 6) as precision, round(coalesce(r, 0), 6) as"
        " recall, round(case when p + r > 0 then 2 * p * r / (p + r) else 0 end, 6) as f1 from"
        " predictions s left join token_shares using (sample_id)"
    ),
    "semantic_scores": (
        "select sample_id, round(coalesce(p, 0), 6) as precision, round(coalesce(r, 0), 6) as recall,"
        " round(coalesce(2 * p * r / (p + r), 0), 6) as score from predictions left join (select"
        " sample_id, share as p from angle_shares where predicted) using (sample_id) left join"
        " (select sample_id, share as r from angle_shares where not predicted) using (sample_id)"
    ),
    "embedding_match_f1": (
        "select text_pair, round(coalesce(p, 0), 4) as precision, round(coalesce(r, 0), 4) as recall,"
        " round(coalesce(2 * p * r / (p + r), 0), 4) as f1 from (select distinct text_pair from"
        " vectors) left join (select text_pair, avg(c) as p from (select text_pair, max(c) as c from"
        " cosines group by text_pair, i) group by text_pair) using (text_pair) left join (select"
        " text_pair, avg(c) as r from (select text_pair, max(c) as c from cosines group by text_pair,"
        " j) group by text_pair) using (text_pair)"
    ),
    "paired_by_position": (
        "select * from (select row_number() over (order by sample_id) - 1 as position, sample_id as"
        " prediction_id, prediction from predictions) join (select row_number() over (order by"
        " sample_id) - 1 as position, sample_id as truth_id, ground_truth from predictions where"
        " sample_id % 10 <> 9) using (position)"
    ),
    "vocab_file_round_trip": (
        "select "
        + ", ".join(
            f"case when {c} not in ({', '.join(quoted(t) for t in ['', *NA_TOKENS])}) then {c} end as {c}"
            for c in VOCAB_COLUMNS
        )
        + " from vocab"
    ),
    "chat_file_round_trip": "select question, ground_truth from chat_pairs",
    "eval_samples": (
        f"select question, ground_truth, {digest(['question', 'ground_truth'])} || '-' ||"
        " (row_number() over (partition by question, ground_truth) - 1) as sample_id from (select"
        " question, left(ground_truth, 40) as ground_truth from predictions)"
    ),
    "report_round_trip": (
        "select metric, round(value, 6) as value, passed from (select avg(score) as f1, avg(case when"
        " headword is null or headword_hit then 1.0 else 0.0 end) as hw, count(*) as n from judged),"
        " lateral (values ('bertscore_f1_mean', f1, f1 >= 0.7), ('headword_recall', hw, hw >= 0.8),"
        " ('num_samples', n, f1 >= 0.7 and hw >= 0.8)) t(metric, value, passed)"
    ),
    "details_by_run": (
        "select sample_id, headword, headword_hit, 'second' as run_name from judged where headword_hit"
    ),
    "subject_items": (
        "select subject, question, answer, concat_ws(',', A, B, C, D) as choices from items where"
        " subject in ('de', 'en') and answer is not null"
    ),
    "subject_warnings": (
        "select 'xx' as subject, 'no folder' as reason union all select subject, count(*) || ' rejected'"
        " from items where answer is null and subject in ('de', 'en') group by subject"
    ),
    "length_batches": (
        "select conv_id, turn, length, batch, max(length) over (partition by batch) as padded_length"
        " from length_ids"
    ),
    "padding_shares": " union all ".join(
        f"select '{name}' as batches, cast(sum(t) as bigint) as tokens, cast(sum(p) as bigint) as places,"
        " round((sum(p) - sum(t)) / cast(sum(p) as double), 6) as padding from (select"
        f" sum({size}) as t, max({size}) * count(*) as p from {view} group by batch)"
        for name, view, size in (
            ("by draw", "prompt_ids", "len(ids)"),
            ("by length", "length_ids", "length"),
        )
    ),
    "planned_predictions": (
        "select conv_id, turn, batch, length(question) || ' of ' || cast(sum(length(question)) over"
        " (partition by batch) as bigint) || ', at most 256' as prediction from length_ids"
    ),
    "latest_settings": (
        'select run, "key", arg_max("value", (ts, event_id)) as "value" from settings_log group by'
        ' run, "key"'
    ),
}


def _needed(sql: str) -> list[str]:
    """Views a query names, each after the ones it builds on."""
    found: list[str] = []

    def visit(text: str) -> None:
        tokens = set("".join(c if c.isalnum() or c == "_" else " " for c in text).split())
        for name, body in WITH.items():
            if name in tokens and name not in found:
                visit(body)
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def oracle(name: str) -> str:
    sql = SQL[name]
    views = ", ".join(f"{view} as ({WITH[view]})" for view in _needed(sql))
    return f"with {views} {sql}" if views else sql
