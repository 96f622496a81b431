"""Exam evaluation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill import fixed
from turnmill.functions import text as tx
from turnmill.operators import fewshot, grading, models
from turnmill.plans import stubs
from turnmill.plans.inputs import ITEMS_SQL, items, q, table
from turnmill.session import run_dir
from turnmill.sources import writers

#: What the written reports say.
SHOTS = 5
COMPLETED_AT = "2024-01-01 00:00:00"

STUB_INPUTS = ["item_id", "answer"]


def extract_answers(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    return rows.select("conv_id", "turn", tx.extract_answer(F.col("text")).alias("predicted"))


def extract_answers_docs(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents")
    return rows.select("doc_id", tx.extract_answer(F.col("text")).alias("predicted"))


def few_shot_prompts(spark: SparkSession, folder: str) -> DataFrame:
    asked = fewshot.few_shot_prompts(items(spark, folder, "test"), items(spark, folder, "dev"))
    return asked.select("item_id", "prompt")


def few_shot_by_subject(spark: SparkSession, folder: str) -> DataFrame:
    asked = fewshot.few_shot_prompts(items(spark, folder, "test"), items(spark, folder, "dev"), ["subject"])
    return asked.select("subject", "item_id", "prompt")


def _asked(spark: SparkSession, folder: str) -> DataFrame:
    asked = fewshot.few_shot_prompts(items(spark, folder, "test"), items(spark, folder, "dev"))
    answered = models.generate(asked, stubs.VARIANTS["base"], extra_inputs=STUB_INPUTS)
    return answered.select("subject", "item_id", "response")


def batch_generate(spark: SparkSession, folder: str) -> DataFrame:
    return _asked(spark, folder).select("item_id", "response")


def grade_answers(spark: SparkSession, folder: str) -> DataFrame:
    gold = items(spark, folder, "test").select("item_id", "subject", "answer")
    return grading.grade(_asked(spark, folder), gold).select("subject", "item_id", "predicted", "answer", "is_correct")


def _graded(spark: SparkSession, folder: str) -> DataFrame:
    return models.evaluate(
        items(spark, folder, "test"), items(spark, folder, "dev"), stubs.VARIANTS["base"], extra_inputs=STUB_INPUTS
    )


def _variants(spark: SparkSession, folder: str) -> DataFrame:
    asked = fewshot.few_shot_prompts(items(spark, folder, "test"), items(spark, folder, "dev"), ["subject"])
    runs = models.generate_variants(asked, stubs.VARIANTS, fixed.MODEL_TYPES, extra_inputs=STUB_INPUTS)
    return grading.grade_rows(runs)


def report_file(spark: SparkSession, folder: str) -> DataFrame:
    """The reports of all runs, written and read back, a row a line."""
    root = run_dir(spark, "results")
    adapters = {m: f"out/adapter-{m}" for m in fixed.MODEL_TYPES if m != "base"}
    done = F.to_timestamp(F.lit(COMPLETED_AT))
    writers.write_results(_variants(spark, folder), root, shots=SHOTS, adapters=adapters, completed_at=done)
    files = spark.read.text(f"{root}/out/{fixed.RESULTS_FOLDER}/*/*{fixed.RESULTS_SUFFIX}", wholetext=True)
    whole = files.select(F.regexp_extract("_metadata.file_path", "/(out/[^/]+/[^/]+/[^/]+)$", 1).alias("path"), "value")
    line = F.posexplode(F.split("value", "\n")).alias("line_no", "line")
    return whole.select("path", line).select("path", F.col("line_no").cast("long").alias("line_no"), "line")


def eval_details(spark: SparkSession, folder: str) -> DataFrame:
    return grading.details(_graded(spark, folder))


def eval_summary(spark: SparkSession, folder: str) -> DataFrame:
    return grading.summarize(_graded(spark, folder)).withColumn("accuracy", F.round("accuracy", 6))


def running_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    steps = grading.running_accuracy(_variants(spark, folder), ["model_id", "subject"])
    return steps.withColumn("accuracy", F.round("accuracy", 6))


def model_compare(spark: SparkSession, folder: str) -> DataFrame:
    wide = grading.compare_models(_variants(spark, folder), fixed.MODEL_TYPES, "base")
    return wide.select("subject", *[F.round(c, 6).alias(c) for c in wide.columns[1:]])


def run_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Where the result of each subject and variant belongs."""
    adapter = F.concat(F.lit("out/adapter-"), F.col("subject"))
    label = tx.run_label(F.col("model_type"), adapter)
    subjects = items(spark, folder).select("subject").distinct()
    kinds = F.explode(F.array(*map(F.lit, fixed.MODEL_TYPES))).alias("model_type")
    return subjects.select("subject", kinds).select(
        "subject", "model_type", tx.report_path("out", F.col("subject"), label).alias("path")
    )


def report_lines(spark: SparkSession, folder: str) -> DataFrame:
    return grading.report_lines(eval_details(spark, folder))


QUERIES = {
    f.__name__: f
    for f in (
        extract_answers,
        extract_answers_docs,
        few_shot_prompts,
        few_shot_by_subject,
        batch_generate,
        grade_answers,
        eval_details,
        eval_summary,
        running_accuracy,
        model_compare,
        run_labels,
        report_lines,
        report_file,
    )
}


# Oracle --------------------------------------------------------------------------------

STRIP = f"trim({{}}, {q(tx.SPACES)})"
_RULE_2 = rf"(?i)[{fixed.ANSWER_MARKS}]{tx.SPACE_CLASS}*([A-D])"
_RULE_3 = r"(?i)(?:^|[^\p{L}\p{N}_])([A-D])(?:$|[^\p{L}\p{N}_])"


def extract_sql(source: str, keep: str, column: str) -> str:
    """A query adding ``predicted`` for a text column of ``source``."""
    return f"""
        select * exclude (_s), case
            when upper(substr(_s, 1, 1)) in ('A', 'B', 'C', 'D') then upper(substr(_s, 1, 1))
            when regexp_extract(_s, {q(_RULE_2)}, 1) <> '' then upper(regexp_extract(_s, {q(_RULE_2)}, 1))
            when regexp_extract(_s, {q(_RULE_3)}, 1) <> '' then upper(regexp_extract(_s, {q(_RULE_3)}, 1))
            when contains(upper(_s), 'A') then 'A' when contains(upper(_s), 'B') then 'B'
            when contains(upper(_s), 'C') then 'C' when contains(upper(_s), 'D') then 'D'
            else 'UNKNOWN' end as predicted
        from (select {keep}, {STRIP.format(column)} as _s from {source})"""


def _question(number: str) -> str:
    options = " || ".join(f"'{c}. ' || {c} || chr(10)" for c in "ABCD")
    return f"'问题' || {number} || ': ' || question || chr(10) || {options} || '答案:'"


def _prompts_sql(by: str) -> str:
    group, join = (by + ",", f"left join prefix using ({by})") if by else ("", "cross join prefix")
    return f"""
        with mcq as ({ITEMS_SQL}),
        dev as (select *, row_number() over ({'partition by ' + by if by else ''} order by item_id) as n
                from mcq where split = 'dev'),
        prefix as (select {group} string_agg({_question('n')} || ' ' || answer || chr(10) || chr(10), ''
                                             order by item_id) as shown, count(*) as shots
                   from dev {'group by ' + by if by else ''})
        select {group} item_id, {q(fixed.EXAM_INSTRUCTION)} || coalesce(shown, '') ||
               {_question('(coalesce(shots, 0) + 1)')} as prompt
        from mcq {join} where split = 'test'"""


def _response(plain_from: int = 8) -> str:
    return f"""case when item_id % 8 >= {plain_from} then answer else case item_id % 8
        when 0 then answer when 1 then '答案是' || answer when 2 then 'I think ' || answer || '.'
        when 3 then '选择 ' || lower(answer) when 4 then 'Definitely ' || answer when 5 then '' when 6 then '无'
        else '我认为' || answer || '正确' end end"""


_RUN = f"select *, {_response()} as response from ({ITEMS_SQL}) where split = 'test'"
_GRADED = f"""select *, predicted = answer as is_correct from
    ({extract_sql(f'({_RUN})', '*', 'response')})"""
_RUNS = " union all ".join(
    f"select *, '{m}' as model_id, {_response(n)} as response from ({ITEMS_SQL}) where split = 'test'"
    for m, n in (("base", 8), ("lora", 6), ("grpo", 5))
)
_GRADED_RUNS = f"""select *, predicted = answer as is_correct from
    ({extract_sql(f'({_RUNS})', '*', 'response')})"""
_DETAILS = f"""select item_id as id,
    case when length(question) > 50 then substr(question, 1, 50) || '...' else question end as question,
    predicted, answer as correct, is_correct, response as raw_response from ({_GRADED})"""


def _pad(column: str, width: int) -> str:
    return f"{column} || repeat(' ', greatest({width} - length({column}), 0))"


_FILE = f"""
    with r as (select *, 'out/ceval-exma/' || subject || '/' || case when model_id = 'base' then 'base'
                             else model_id || '_adapter-' || model_id end || '_results.txt' as path,
                      case when length(question) > 50 then substr(question, 1, 50) || '...' else question end as short
               from ({_GRADED_RUNS})),
    s as (select path, any_value(model_id) as model_id, any_value(subject) as subject, count(*) as total,
                 sum(is_correct::int) as correct, count(*) filter (predicted = 'UNKNOWN') as unknown,
                 string_agg({_pad('cast(item_id as varchar)', 6)} || ' | ' || {_pad('short', 40)} || ' | ' ||
                            {_pad('predicted', 5)} || ' | ' || {_pad('answer', 5)} || ' | ' ||
                            case when is_correct then '✓' else '✗' end, chr(10) order by item_id) as body
          from r group by path),
    t as (select path, concat_ws(chr(10), repeat('=', 70),
                 'C-Eval ' || upper(subject[1]) || subject[2:] || ' Evaluation Results', repeat('=', 70), '',
                 'Model Configuration:', '  Model Type: ' || model_id, '  Base Model: model/qwen',
                 case when model_id <> 'base' then '  Adapter Path: out/adapter-' || model_id end,
                 '  Dataset: ' || subject, '', 'Generation Parameters:', '  Temperature: 0.0', '  Do Sample: False',
                 '  Max New Tokens: 10', '', 'Evaluation Setup:', '  Test Split: ' || total || ' questions',
                 '  Few-shot: {SHOTS} examples', '', repeat('=', 70), 'Summary Results:', repeat('=', 70),
                 '  Total Questions: ' || total, '  Correct: ' || correct, '  Incorrect: ' || (total - correct),
                 '  Failed Extractions: ' || unknown,
                 '  Accuracy: ' || printf('%.2f', correct::double / total * 100) || '%', '', repeat('=', 70),
                 'Detailed Results:', repeat('=', 70),
                 'ID     | Question                                 | Pred  | True  | Status', repeat('-', 70), body, '',
                 repeat('=', 70), 'Evaluation completed at: {COMPLETED_AT}', repeat('=', 70), '') as text from s)
    select path, unnest(range(len(string_split(text, chr(10))))) as line_no, unnest(string_split(text, chr(10))) as line from t"""

ORACLE = {
    "report_file": _FILE,
    "extract_answers": extract_sql("conversations", "conv_id, turn", "text"),
    "extract_answers_docs": extract_sql("documents", "doc_id", "text"),
    "few_shot_prompts": _prompts_sql(""),
    "few_shot_by_subject": _prompts_sql("subject"),
    "batch_generate": f"select item_id, response from ({_RUN})",
    "grade_answers": f"select subject, item_id, predicted, answer, is_correct from ({_GRADED})",
    "eval_details": _DETAILS,
    "eval_summary": f"""
        select count(*) as total, cast(sum(is_correct::int) as bigint) as correct,
               cast(count(*) - sum(is_correct::int) as bigint) as incorrect,
               count(*) filter (predicted = 'UNKNOWN') as unknown,
               round(sum(is_correct::int)::double / count(*) * 100, 6) as accuracy
        from ({_GRADED})""",
    "running_accuracy": f"""
        select model_id, subject, item_id, seen, round(good::double / seen * 100, 6) as accuracy from (
            select model_id, subject, item_id, row_number() over w as seen, sum(is_correct::int) over w as good
            from ({_GRADED_RUNS}) window w as (partition by model_id, subject order by item_id
                                               rows between unbounded preceding and current row))
        where seen % 10 = 0""",
    "model_compare": f"""
        with a as (select coalesce(subject, 'ALL') as subject, model_id,
                          sum(is_correct::int)::double / count(*) * 100 as accuracy
                   from ({_GRADED_RUNS}) group by grouping sets ((subject, model_id), (model_id))),
        w as (select subject, max(accuracy) filter (model_id = 'base') as base,
                     max(accuracy) filter (model_id = 'lora') as lora,
                     max(accuracy) filter (model_id = 'grpo') as grpo from a group by subject)
        select subject, round(base, 6) as base, round(lora, 6) as lora, round(grpo, 6) as grpo,
               round(lora - base, 6) as lora_gain, round(grpo - base, 6) as grpo_gain from w""",
    "run_labels": f"""
        select subject, model_type, 'out/ceval-exma/' || subject || '/' ||
               case when model_type = 'base' then 'base' else model_type || '_adapter-' || subject end ||
               '_results.txt' as path
        from (select distinct subject from ({ITEMS_SQL})), (values ('base'), ('lora'), ('grpo')) as m(model_type)""",
    "report_lines": f"""
        select id, {_pad('cast(id as varchar)', 6)} || ' | ' || {_pad('question', 40)} || ' | ' ||
               {_pad('predicted', 5)} || ' | ' || {_pad('correct', 5)} || ' | ' ||
               case when is_correct then '✓' else '✗' end as line
        from ({_DETAILS})""",
}
