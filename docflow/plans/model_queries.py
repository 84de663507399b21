"""Queries over calls to a model and what becomes of the answers, with models that follow a rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.operators import calls, flows
from docflow.plans import duck
from docflow.plans.quality_queries import CASED
from docflow.plans.registry import query
from docflow.plans.text_queries import _fixed, _scrubbed
from docflow.sources.md_docs import md_docs

#: What a service does at each attempt at a prompt of each kind: a status, no answer (None) or an answer.
BEHAVIOUR = {0: ("yes",), 1: (503, 429, "late"), 2: (500, 500, 500), 3: (404, 404, "found"), 4: (None, "back"), 5: (None, None, None), 6: (429, None, "done")}


class Service:
    """Answers "document <id>" as BEHAVIOUR has it for the id modulo seven."""

    def __init__(self, attempt: int):
        self.attempt = attempt

    def __call__(self, prompt: str) -> str:
        step = BEHAVIOUR[int(prompt.split(" ")[1]) % 7][self.attempt - 1]
        if isinstance(step, int):
            raise calls.CallFailed(step)
        return step or ""


def _steps() -> str:
    """The behaviour as SQL rows (kind, attempt, status, answer)."""
    lit = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join(f"({k}, {n}, {lit(s if isinstance(s, int) else None)}, {lit(s if isinstance(s, str) else None)})" for k, steps in BEHAVIOUR.items() for n, s in enumerate(steps, 1))


_TRIED = f"""s(kind, attempt, status, answer) AS (VALUES {_steps()}),
    d AS (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL),
    t AS (SELECT doc_id, attempt, status::int AS status, answer, sum(CASE WHEN status IN (429, 500, 503) THEN 10.0 WHEN status IS NULL THEN 5.0 ELSE 0.0 END) OVER (PARTITION BY doc_id ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS due FROM d JOIN s ON doc_id % 7 = kind)"""


def _log(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id is not null")
    return calls.attempts_of(docs.select(F.concat(F.lit("document "), F.col("doc_id")).alias("prompt")), Service, calls.StepClock())


@query(f"WITH {_TRIED} SELECT doc_id, attempt::int AS attempt, coalesce(due, 0)::double AS due, status, answer AS text FROM t")
def call_attempts(spark, sf_dir):
    """Every attempt at a call for every document, by when it was due."""
    return _log(spark, sf_dir).select(F.split("prompt", " ")[1].cast("long").alias("doc_id"), "attempt", "due", "status", "text")


@query(f"WITH {_TRIED} SELECT attempts, ok, count(*)::bigint AS n FROM (SELECT doc_id, max(attempt)::int AS attempts, count(answer) > 0 AS ok FROM t GROUP BY doc_id) GROUP BY ALL")
def call_outcomes(spark, sf_dir):
    """How many prompts ended in an answer or not, by attempts."""
    return calls.outcomes(_log(spark, sf_dir)).groupBy("attempts", "ok").agg(F.count(F.lit(1)).alias("n"))


#: What the stand-in for a translator puts for source words.
PAIRS = (("内存", "память"), ("处理器", "процессор"), ("存储", "хранилище"), ("问天服务器", "сервер WenTian"))


class Substituting:
    """Answers with a part of the prompt, the user's message or the document, in which words are put for others."""

    def __call__(self, prompt: str) -> str:
        if "<|im_start|>user\n" in prompt:
            prompt = prompt.rsplit("<|im_start|>user\n", 1)[1].rsplit("<|im_end|>", 1)[0]
        else:
            prompt = prompt.split("\n\nDocument:\n", 1)[1]
        for a, b in PAIRS:
            prompt = prompt.replace(a, b)
        return prompt


_ANSWER = duck.strip(duck.replace(duck.strip("md"), PAIRS))


@query(duck.over_md(f"doc_id, md5({duck.strip(duck.clean_breaks(_fixed(_scrubbed(_ANSWER), 'ru')))}) AS translated"))
def translate_flow(spark, sf_dir):
    """Every Markdown document through the prompt, a model, and the clean-up of its answer."""
    done = flows.translate_single(md_docs(spark, sf_dir).withColumnRenamed("md", "text"), Substituting, "zh-CN", "ru")
    return done.select("doc_id", F.md5(F.col("translated").cast("binary")).alias("translated"))


_TRUST = (
    f"CASE WHEN b = '' OR a = b THEN 0.0 ELSE least(1.0, 0.8 + CASE WHEN length(b)::double / greatest(length(a), 1) BETWEEN 0.8 AND 1.3 THEN 0.1 ELSE -0.2 END + CASE WHEN {CASED('b')} >= {CASED('a')} * 0.9 THEN 0.1 ELSE 0.0 END) END"
)


@query(
    duck.over_md(
        "doc_id, CASE WHEN taken THEN n ELSE 0 END::int AS corrections, round(CASE WHEN taken THEN trust ELSE 0.0 END, 6)::double AS confidence, md5(CASE WHEN taken THEN b ELSE a END) AS corrected, round(CASE WHEN taken THEN trust ELSE 1.0 END, 6)::double AS score, "
        "CASE WHEN n BETWEEN 1 AND 10 AND NOT taken THEN ['correction confidence is low'] WHEN n > 10 THEN ['too many issues'] ELSE [] END::varchar[] AS issues",
        f", p AS (SELECT doc_id, doc_id % 13 AS n, md AS a, {_ANSWER} AS b FROM md_docs), t AS (SELECT *, {_TRUST} AS trust FROM p), k AS (SELECT *, n BETWEEN 1 AND 10 AND b <> '' AND trust >= 0.7 AS taken FROM t)",
        "k",
    )
)
def auto_correction(spark, sf_dir):
    """Level 5 for every Markdown document, with none to twelve issues each."""
    n = (F.col("doc_id") % 13).cast("int")
    issues = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("issue "), i))).otherwise(F.array().cast("array<string>"))
    done = flows.auto_correct(md_docs(spark, sf_dir).select("doc_id", F.col("md").alias("text"), issues.alias("issues")), Substituting)
    return done.select("doc_id", "corrections", F.round("confidence", 6).alias("confidence"), F.md5(F.col("corrected").cast("binary")).alias("corrected"), F.round("score", 6).alias("score"), "issues")
