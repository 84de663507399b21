"""Flows that join texts and a model: translation by batches of lines, corrections, and the levels of quality that need them.

Prompts are asked once each, however many rows share one, so the answers of a run are its cache; ``answered`` takes the
place of the service, with retries. Joins with answers are by hash of the prompt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions import scoring, translation
from docflow.functions.rx import let, strip
from docflow.operators import adapters, calls, chunking, reports

#: Level 2: least likeness, and the share of pages that may differ. Level 5: most issues, least confidence.
LEAST_LIKENESS, MAY_DIFFER, MOST_ISSUES, LEAST_CONFIDENCE = 0.95, 0.1, 10, 0.7

Model = Callable[..., adapters.TextModel]


def answers_to(prompts: DataFrame, make: Model, attempts: int, clock: calls.Clock | None) -> DataFrame:
    """Answers to the column ``_prompt``: in waves with delays by the clock (``make`` gets the attempt's number), or without one at once."""
    if clock is None:
        return adapters.answered(prompts, make, "_prompt", attempts=attempts)
    return calls.outcomes(calls.attempts_of(prompts, make, clock, attempts, prompt_col="_prompt"))


# Translation


def translate_single(rows: DataFrame, make: Model, source: str, target: str, text_col: str = "text", to: str = "translated", attempts: int = 3, clock: calls.Clock | None = None) -> DataFrame:
    """``rows`` with the text's translation: blank texts and those the model fails on as they are, others cleaned up."""
    text = F.col(text_col)
    prompt = translation.chat_template(translation.translation_messages(strip(text), F.lit(source), F.lit(target)))
    asked = rows.withColumn("_prompt", F.when(strip(text) != "", prompt))
    answers = answers_to(asked.where("_prompt is not null"), make, attempts, clock)
    both = adapters.with_answers(asked, answers, "_prompt")
    return both.withColumn(to, F.when(F.col("answer.ok"), translation.post_process_model(F.col("answer.text"), target)).otherwise(text)).drop("_prompt", "answer")


def translate_lines(docs: DataFrame, make: Model, source: str = "zh-CN", target: str = "ru", text_col: str = "text", attempts: int = 3, clock: calls.Clock | None = None) -> DataFrame:
    """(doc_id, translated) of (doc_id, text): batches of lines go to the model; where an answer has another number of lines, each goes alone.

    Blank lines between batches stay. Batches move on as ``chunking.batch_plan`` has it.
    """
    plan = docs.select("doc_id", F.explode(chunking.batch_plan(F.col(text_col), blanks=True)).alias("b")).select("doc_id", F.col("b.first").alias("first"), F.col("b.lines").alias("lines"))
    done = translate_single(plan.withColumn("text", F.array_join("lines", "\n")), make, source, target, attempts=attempts, clock=clock)
    parts = F.split("translated", "\n")
    fits = (F.size("lines") == 1) | (F.size(parts) == F.size("lines"))
    whole = done.where(fits).select("doc_id", "first", F.lit(0).alias("at"), F.col("translated").alias("line"))
    alone = done.where(~fits).select("doc_id", "first", F.posexplode("lines").alias("at", "text"))
    each = translate_single(alone, make, source, target, attempts=attempts, clock=clock).select("doc_id", "first", "at", F.col("translated").alias("line"))
    ordered = F.array_sort(F.collect_list(F.struct("first", "at", "line")))
    return whole.union(each).groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("translated"))


# Corrections


def correction_prompt(text: Column, issues: Column) -> Column:
    listed = F.array_join(F.transform(issues, lambda i: F.concat(F.lit("- "), i)), "\n")
    return F.concat(F.lit("Edit the Markdown document so that these faults are gone. Keep meaning, terms and commands. Answer with the document only.\n\nFaults:\n"), listed, F.lit("\n\nDocument:\n"), text)


def auto_correct(docs: DataFrame, make: Model, attempts: int = 3, clock: calls.Clock | None = None) -> DataFrame:
    """Level 5 of (doc_id, text, issues): (doc_id, corrections, confidence, corrected, score, issues).

    Documents without issues or with more than ``MOST_ISSUES`` are not sent. An answer is taken from ``LEAST_CONFIDENCE`` on.
    """
    n = F.size("issues")
    asked = docs.withColumn("_prompt", F.when((n > 0) & (n <= MOST_ISSUES), correction_prompt(F.col("text"), F.col("issues"))))
    answers = answers_to(asked.where("_prompt is not null"), make, attempts, clock)
    both = adapters.with_answers(asked, answers, "_prompt")
    sent = F.col("_prompt").isNotNull()
    trust = F.when(F.col("answer.ok"), scoring.correction_quality(F.col("text"), F.col("answer.text"))).otherwise(0.0)
    judged = both.withColumn("_trust", F.when(sent, trust))
    taken = F.coalesce(F.col("_trust") >= LEAST_CONFIDENCE, F.lit(False))
    said = F.when(sent & ~taken, F.array(F.lit("correction confidence is low"))).when(n > MOST_ISSUES, F.array(F.lit("too many issues"))).otherwise(F.array().cast("array<string>"))
    return judged.select(
        "doc_id",
        F.when(taken, n).otherwise(0).alias("corrections"),
        F.when(taken, F.col("_trust")).otherwise(0.0).alias("confidence"),
        F.when(taken, F.col("answer.text")).otherwise(F.col("text")).alias("corrected"),
        F.when(taken, F.col("_trust")).otherwise(1.0).alias("score"),
        said.alias("issues"),
    )


#: What each kind of planned correction asks for.
ASKS = {"ocr": "Mend errors of text recognition.", "structure": "Mend headings and their levels.", "translation": "Mend technical terms and commands.", "formatting": "Mend Markdown formatting."}


def apply_corrections(docs: DataFrame, make: Model, attempts: int = 3, clock: calls.Clock | None = None) -> DataFrame:
    """(doc_id, planned, applied, failed, corrected) of (doc_id, text, plan): the plan's sure entries one after the other, each on the last one's text.

    ``plan`` is that of ``reports.planned_corrections``; entries not marked as applied, and those the model fails on, count as
    failed. At the end a text that lost too many words is dropped for the first; without a success there is no corrected text.
    """
    table = F.create_map(*(F.lit(x) for kv in ASKS.items() for x in kv))
    state = docs.withColumns({"_now": F.col("text"), "_done": F.lit(0)})
    for i in range(reports.MOST_CORRECTIONS):
        entry = F.get("plan", F.lit(i))
        ask = F.concat(F.try_element_at(table, entry["type"]), F.lit(" Fault: "), entry["description"], F.lit(". Answer with the document only.\n\n"), F.col("_now"))
        asked = state.withColumn("_prompt", F.when(F.coalesce(entry["applied"], F.lit(False)), ask))
        if asked.where("_prompt is not null").isEmpty():
            continue
        both = adapters.with_answers(asked, answers_to(asked.where("_prompt is not null"), make, attempts, clock), "_prompt")
        ok = F.coalesce(F.col("answer.ok"), F.lit(False))
        state = both.withColumns({"_now": F.when(ok, F.col("answer.text")).otherwise(F.col("_now")), "_done": F.col("_done") + ok.cast("int")}).drop("_prompt", "answer")
    n = F.coalesce(F.size("plan"), F.lit(0))
    return state.select("doc_id", n.alias("planned"), F.col("_done").alias("applied"), (n - F.col("_done")).alias("failed"), F.when(F.col("_done") > 0, scoring.guarded_review(F.col("text"), F.col("_now"))).alias("corrected"))


# Levels of quality


def visual_level(summary: DataFrame, pages: DataFrame) -> DataFrame:
    """Level 2: (doc_id, level, score, issues) of ``structure.visual_summary`` rows and (doc_id, pages)."""
    s = F.col("similarity")
    n = F.col("n_added") + F.col("n_removed") + F.col("n_changed")
    may = F.greatest(F.lit(1), F.bround(F.col("pages") * MAY_DIFFER))
    severe = F.col("n_high") + F.col("n_critical") > 0
    issues = F.array_compact(F.array(F.when(s < LEAST_LIKENESS, "low visual likeness"), F.when(n > may, "too many differences"), F.when(severe, "severe differences")))
    return summary.join(pages, "doc_id").select("doc_id", F.lit(2).alias("level"), s.alias("score"), issues.alias("issues"))


def correction_level(corrected: DataFrame) -> DataFrame:
    """Level 5 as (doc_id, level, score, issues) from ``auto_correct`` rows."""
    return corrected.select("doc_id", F.lit(5).alias("level"), "score", "issues")


def finished(docs: DataFrame, report: DataFrame, corrected: DataFrame | None = None) -> DataFrame:
    """(doc_id, final_text, pipeline_ready, corrected): the corrected text if there are corrections, else ``docs.text``; ready if the report passed."""
    rows = docs.join(report.select("doc_id", "quality_passed"), "doc_id")
    if corrected is None:
        return rows.select("doc_id", F.col("text").alias("final_text"), F.col("quality_passed").alias("pipeline_ready"), F.lit(False).alias("corrected"))
    some = F.coalesce(F.col("corrections"), F.lit(0)) > 0
    both = rows.join(corrected.select("doc_id", "corrections", F.col("corrected").alias("_new")), "doc_id", "left")
    return both.select("doc_id", F.when(some, F.col("_new")).otherwise(F.col("text")).alias("final_text"), F.col("quality_passed").alias("pipeline_ready"), some.alias("corrected"))


# Small rules of extraction


def list_items(text: Column) -> Column:
    """The items of a list's lines: one leading marker character and blanks go, empty lines too."""
    bare = F.transform(F.split(text, "\n"), lambda x: strip(F.regexp_replace(strip(x), r"(?U)^[•\-*\d+.]\s*", "")))
    return F.filter(bare, lambda x: x != "")


def structure_quality(found: Column) -> Column:
    """The fixed quality of an extracted structure, for whatever was found; a missing one (an error) has zeros."""
    fixed = lambda a, b, c: F.struct(F.lit(a).alias("structure"), F.lit(b).alias("text"), F.lit(c).alias("tables"))
    return F.when(found.isNotNull(), fixed(0.9, 0.8, 0.7)).otherwise(fixed(0.0, 0.0, 0.0))


def stub_text(title: Column, pages: Column, method: Column) -> Column:
    """Markdown that stands in for a document which no reader could read."""
    return let(F.coalesce(title, F.lit("Document")), lambda t: F.format_string("# %s\n\nNo text could be read.\n\n---\n\nPages: %d\nMethod: %s\n", t, F.coalesce(pages, F.lit(0)), F.coalesce(method, F.lit("none"))))
