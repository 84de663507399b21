"""Queries over quality: scores, validators, reports, consensus, correction plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions import lexicon, markdown, scoring, translation
from docflow.operators import reports, segmentation, similarity
from docflow.plans import duck
from docflow.plans.registry import query
from docflow.plans.text_queries import ANNOTATED, _translated
from docflow.sources.md_docs import md_docs, spread

L = lexicon


def _featured(spark, sf_dir):
    return md_docs(spark, sf_dir).withColumn("f", markdown.features(F.col("md")))


FEATURED = f", feat AS (SELECT doc_id, md, {duck.features('md')} FROM md_docs)"


def _level4() -> str:
    t = "md"
    floor = lambda x: f"greatest(100 - ({x}), 0)::double / 100"
    terms, found = duck.present(t, L.QA_TERMS), duck.present(t, L.REQUIRED_SECTIONS)
    clashes = " + ".join(f"(contains({t}, {duck.q(a)}) AND NOT contains({t}, {duck.q(b)}))::int" for a, b in L.CONSISTENT_PAIRS)
    parts = (
        f"(chars < 100)::int * 30 + ({duck.count(t, '^#+' + chr(92) + 's+')} < 1)::int * 20 + (titles < 1)::int * 15",
        "empty_sections * 10 + (repetition > 0.3)::int * 20",
        f"CASE WHEN {terms} = 0 THEN 30 WHEN {terms} < 3 THEN 15 ELSE 0 END",
        "bad_headings * 5 + empty_links * 3 + (table_rows > 0 AND separators = 0)::int * 15",
        "(chars > 0 AND cjk::double / greatest(chars, 1) > 0.3)::int * 20",
        "empty_items * 5 + (fences % 2 <> 0)::int * 20",
        f"({clashes}) * 10",
        f"CASE WHEN {found} < 2 THEN (4 - {found}) * 15 ELSE 0 END",
    )
    return ", ".join(f"{floor(p)} AS {n}" for p, n in zip(parts, scoring.LEVEL4, strict=True))


LEVEL4 = FEATURED + f", l4 AS (SELECT doc_id, md, {_level4()} FROM feat), l4s AS (SELECT *, ({' + '.join(scoring.LEVEL4)}) / 8 * 100 AS total FROM l4)"


def _level4_rows(spark, sf_dir):
    rows = _featured(spark, sf_dir).select("doc_id", "md", *scoring.level4(F.col("md"), F.col("f")))
    total = sum((F.col(c) for c in scoring.LEVEL4[1:]), F.col(scoring.LEVEL4[0])) / 8 * 100
    return rows.withColumn("total", total)


@query(duck.over_md(f"doc_id, {', '.join(f'round({c}, 6) AS {c}' for c in scoring.LEVEL4)}, round(total, 6) AS overall_score, total >= 80 AS quality_passed", LEVEL4, "l4s"))
def qa_level4(spark, sf_dir):
    """The eight checks of a document and their mean."""
    rows = _level4_rows(spark, sf_dir)
    return rows.select("doc_id", *(F.round(c, 6).alias(c) for c in scoring.LEVEL4), F.round("total", 6).alias("overall_score"), (F.col("total") >= 80).alias("quality_passed"))


REQUIRED = duck.present("md", L.REQUIRED_TERMS)
CV_ISSUES = f"list_filter([CASE WHEN {REQUIRED} < 5 THEN 'few terms' END, CASE WHEN code_blocks < 1 AND contains(lower(md), 'command') THEN 'few code blocks' END, CASE WHEN NOT regexp_matches(md, '(?m)^#{{1,6}}\\s+.+$') THEN 'no headings' END], lambda x: x IS NOT NULL)"


@query(duck.over_md(f"doc_id, round(greatest(0.0, 1.0 - 0.2 * len({CV_ISSUES})), 6)::double AS score, array_to_string({CV_ISSUES}, ',') AS issues, {REQUIRED} AS terms", FEATURED, "feat"))
def content_validator(spark, sf_dir):
    c = _featured(spark, sf_dir).select("doc_id", scoring.content_validation(F.col("md"), F.col("f")).alias("v"))
    return c.select("doc_id", F.round("v.score", 6).alias("score"), F.array_join("v.issues", ",").alias("issues"), F.col("v.terms").alias("terms"))


def _qa(n: int | None = None) -> str:
    return duck.present("md", L.QA_TERMS[:n])


PROXY = f"least(1.0, 0.92 + least(0.05, {_qa()} * 0.01) - greatest(0.0, (1000 - length(md))::double / 10000))"


@query(duck.over_md(f"doc_id, round({PROXY}, 6)::double AS proxy, round(least(1.0, {PROXY} * 0.7 + 0.87 * 0.3 + least(0.05, length(md)::double / 10000)), 6)::double AS consensus"))
def ocr_proxy_consensus(spark, sf_dir):
    t = F.col("md")
    return md_docs(spark, sf_dir).select("doc_id", F.round(scoring.ocr_proxy(t), 6).alias("proxy"), F.round(scoring.ocr_proxy_consensus(t), 6).alias("consensus"))


STRUCTURE = f"least(1.0, greatest(0.6, (regexp_matches(md, '(?m)^#+\\s+(.+)'))::int * 0.3 + (table_lines > 0)::int * 0.2 + (lists > 0)::int * 0.2 + (code_blocks > 0)::int * 0.2 + least(0.1, {_qa()} * 0.02)))"
SEMANTIC = f"least(1.0, greatest(0.7, 0.8 - (length(md) < 500)::int * 0.2 + least(0.1, {_qa(10)} * 0.02)))"


@query(duck.over_md(f"doc_id, round({STRUCTURE}, 6)::double AS structure, round({SEMANTIC}, 6)::double AS semantic, round(({STRUCTURE} + {SEMANTIC}) / 2, 6)::double AS level3", FEATURED, "feat"))
def structure_score(spark, sf_dir):
    rows = _featured(spark, sf_dir)
    s, m = scoring.structure_score(F.col("md"), F.col("f")), scoring.semantic_fallback(F.col("md"))
    return rows.select("doc_id", F.round(s, 6).alias("structure"), F.round(m, 6).alias("semantic"), F.round((s + m) / 2, 6).alias("level3"))


def _pair(new: str) -> str:
    return f", p AS (SELECT doc_id, md AS a, {new} AS b FROM md_docs), pf AS (SELECT *, {duck.features('a', 'o_')}, {duck.features('b', 'n_')} FROM p)"


BASIC = "greatest(0.0, 100.0 - (n_chars::double / greatest(o_chars, 1) < 0.8 OR n_chars::double / greatest(o_chars, 1) > 1.3)::int * 10 - (n_headings < o_headings)::int * 15 - (o_table_lines > 0 AND n_table_lines::double / greatest(o_table_lines, 1) < 0.9)::int * 10 - (o_cjk > 0 AND n_cjk::double / greatest(o_cjk, 1) < 0.9)::int * 20)"
PLAIN_TERMS = [b for _, b in L.PRESERVE_TERMS]


def _kept(a: str, b: str, high: float, low: float) -> str:
    return f"CASE WHEN {a} <= 0 THEN 0.0 WHEN {b}::double / greatest({a}, 1) >= {high} THEN 0.2 WHEN {b}::double / greatest({a}, 1) >= {low} THEN 0.1 ELSE 0.0 END"


RATIO = "n_chars::double / greatest(o_chars, 1)"
ENHANCED = (
    f"CASE WHEN b = '' OR a = b THEN 0.0 ELSE least(1.0, CASE WHEN {RATIO} BETWEEN 0.9 AND 1.3 THEN 0.3 WHEN {RATIO} BETWEEN 0.8 AND 1.5 THEN 0.1 ELSE 0.0 END + {_kept('o_cjk', 'n_cjk', 0.95, 0.8)}"
    f" + {_kept(duck.occurrences('a', PLAIN_TERMS), duck.occurrences('b', PLAIN_TERMS), 0.9, 0.7)} + (n_headings >= o_headings)::int * 0.15 + (n_table_lines >= o_table_lines)::int * 0.15) END"
)


def _pairs(spark, sf_dir, new):
    rows = md_docs(spark, sf_dir).select("doc_id", F.col("md").alias("a"), new(F.col("md")).alias("b"))
    return rows.withColumn("o", markdown.features(F.col("a"))).withColumn("n", markdown.features(F.col("b")))


def _halved(t):
    return F.when(F.col("doc_id") % 3 == 0, F.substring(t, F.lit(1), (F.length(t) / 2).cast("int"))).otherwise(markdown.annotate_terms(t))


HALVED = f"CASE WHEN doc_id % 3 = 0 THEN substr(md, 1, (length(md) // 2)::bigint) ELSE {ANNOTATED} END"


@query(duck.over_md(f"doc_id, round({BASIC}, 6)::double AS basic, round({ENHANCED}, 6)::double AS enhancement, {BASIC} >= 70 AS ready, round(least(100.0, greatest(0.0, {BASIC} + CASE WHEN ({ENHANCED}) >= 0.7 THEN ({ENHANCED}) * 20 ELSE 0.0 END - CASE WHEN {RATIO} < 0.8 THEN (0.8 - {RATIO}) * 50 ELSE 0.0 END)), 6)::double AS final", _pair(HALVED), "pf"))
def transform_quality(spark, sf_dir):
    """Basic, enhancement and final quality of a changed document, with the gate between them."""
    rows = _pairs(spark, sf_dir, _halved)
    b, e = scoring.basic_quality(F.col("o"), F.col("n")), scoring.enhancement_quality(F.col("a"), F.col("b"), F.col("o"), F.col("n"))
    rows = rows.select("doc_id", "o", "n", b.alias("basic"), e.alias("enhancement"))
    final = scoring.final_quality(F.col("basic"), F.col("enhancement") >= 0.7, F.col("enhancement"), F.col("o.chars"), F.col("n.chars"))
    return rows.select("doc_id", F.round("basic", 6).alias("basic"), F.round("enhancement", 6).alias("enhancement"), (F.col("basic") >= 70).alias("ready"), F.round(final, 6).alias("final"))


KEPT, SOURCE = duck.occurrences("b", [b for _, b in L.TECHNICAL_TERMS]), duck.occurrences("a", [a for a, _ in L.TECHNICAL_TERMS])


@query(
    duck.over_md(
        f"doc_id, round(least(100.0, greatest(0.0, 100.0 - ({RATIO} < 0.5 OR {RATIO} > 2.0)::int * 15 + CASE WHEN {SOURCE} > 0 THEN least(1.0, {KEPT}::double / greatest({SOURCE}, 1)) * 10 ELSE 0.0 END - (o_headings > 0 AND n_headings::double / greatest(o_headings, 1) < 0.9)::int * 10 + CASE WHEN o_cjk > 0 THEN (1 - n_cjk::double / greatest(o_cjk, 1)) * 20 ELSE 0.0 END)), 6)::double AS score",
        _pair(_translated("md", "ru")),
        "pf",
    )
)
def translation_quality(spark, sf_dir):
    rows = _pairs(spark, sf_dir, lambda t: translation.translate(t, "ru"))
    return rows.select("doc_id", F.round(scoring.dictionary_quality(F.col("a"), F.col("b"), F.col("o"), F.col("n"), "ru"), 6).alias("score"))


ASIDES = " + ".join(duck.count("b", p, "") for p in L.THINKING_PATTERNS)
TECH = f"greatest(0, 100 - least(50, {duck.count('b', duck.CJK, '')} * 3) - least(30, ({ASIDES}) * 10) - (contains(a, '问天') AND NOT contains(b, 'WenTian'))::int * 20 - (o_table_rows > 0 AND n_table_rows::double / greatest(o_table_rows, 1) < 0.9)::int * 15 - ({RATIO} > 2.5 OR {RATIO} < 0.4)::int * 10 - ({duck.count('a', scoring.UNITS)} <> {duck.count('b', scoring.UNITS)})::int * 10)::bigint"


@query(duck.over_md(f"doc_id, {TECH} AS score, CASE WHEN {TECH} >= 95 THEN 'excellent' WHEN {TECH} >= 85 THEN 'good' WHEN {TECH} >= 70 THEN 'fair' ELSE 'poor' END AS status", _pair(_translated("md", "en")), "pf"))
def technical_validation(spark, sf_dir):
    rows = md_docs(spark, sf_dir).select("doc_id", F.col("md").alias("a"), translation.translate(F.col("md"), "en").alias("b"))
    return rows.select("doc_id", scoring.technical_validation(F.col("a"), F.col("b")).alias("v")).select("doc_id", "v.score", "v.status")


CASED = lambda t: "(" + " + ".join(f"contains({t}, {duck.q(x)})::int" for x in L.QA_TERMS) + ")"


@query(duck.over_md(f"doc_id, round(CASE WHEN b = '' OR a = b THEN 0.0 ELSE least(1.0, greatest(0.0, 0.8 + CASE WHEN length(b)::double / greatest(length(a), 1) BETWEEN 0.8 AND 1.3 THEN 0.1 ELSE -0.2 END + CASE WHEN {CASED('b')} >= {CASED('a')} * 0.9 THEN 0.1 ELSE 0.0 END)) END, 6)::double AS score, md5(CASE WHEN len(regexp_extract_all(b, '\\S+')) < 0.7 * len(regexp_extract_all(a, '\\S+')) THEN a ELSE b END) AS reviewed", f", p AS (SELECT doc_id, md AS a, {HALVED} AS b FROM md_docs)", "p"))
def correction_quality(spark, sf_dir):
    """Score of a corrected text, and the text that the review keeps."""
    rows = md_docs(spark, sf_dir).select("doc_id", F.col("md").alias("a"), _halved(F.col("md")).alias("b"))
    return rows.select("doc_id", F.round(scoring.correction_quality(F.col("a"), F.col("b")), 6).alias("score"), F.md5(scoring.guarded_review(F.col("a"), F.col("b")).cast("binary")).alias("reviewed"))


LEVELS = "SELECT doc_id, level, CASE WHEN doc_id % 5 = 0 AND level = 2 THEN NULL ELSE round(0.5 + ((doc_id * level) % 50) / 100.0, 4)::double END AS score, CASE WHEN (doc_id + level) % 3 = 0 THEN ['issue ' || level] ELSE [] END AS issues FROM documents, (SELECT unnest(range(1, 6)) AS level)"


def _levels(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("level"))
    score = F.when((F.col("doc_id") % 5 == 0) & (F.col("level") == 2), F.lit(None)).otherwise(F.round(0.5 + ((F.col("doc_id") * F.col("level")) % 50) / 100, 4))
    issues = F.when((F.col("doc_id") + F.col("level")) % 3 == 0, F.array(F.concat(F.lit("issue "), F.col("level").cast("string")))).otherwise(F.array().cast("array<string>"))
    return d.select("doc_id", "level", score.alias("score"), issues.alias("issues"))


def _report_sql(score: str) -> str:
    return f"WITH l AS ({LEVELS}) SELECT doc_id, round(avg({score}) * 100, 6) AS overall_score, avg({score}) >= 0.85 AS quality_passed, array_to_string(flatten(list(issues ORDER BY level)), ',') AS all_issues FROM l GROUP BY doc_id"


@query(_report_sql("coalesce(score, 0)"))
def qa_report_dag(spark, sf_dir):
    """Mean of five levels, missing ones as 0."""
    r = reports.qa_report(_levels(spark, sf_dir))
    return r.select("doc_id", F.round("overall_score", 6).alias("overall_score"), "quality_passed", F.array_join("all_issues", ",").alias("all_issues"))


@query(_report_sql("score"))
def qa_report_service(spark, sf_dir):
    """Mean of the levels that there are."""
    r = reports.qa_report(_levels(spark, sf_dir), available_only=True)
    return r.select("doc_id", F.round("overall_score", 6).alias("overall_score"), "quality_passed", F.array_join("all_issues", ",").alias("all_issues"))


@query(
    duck.over_md(
        "doc_id, array_to_string(list_transform(list_slice(c, 1, 10), lambda x: x), ',') AS plan, len(c)::int AS n",
        f""", t AS (SELECT doc_id, md, 0.5 + (doc_id % 5) / 10.0 AS conf, 0.8 + (doc_id % 3) / 10.0 AS likeness FROM md_docs),
        c AS (SELECT doc_id, list_concat(list_concat(list_concat(
          CASE WHEN conf < 0.8 THEN ['ocr:0.8'] ELSE [] END,
          CASE WHEN likeness < 0.9 THEN ['structure:0.7', 'structure:0.8'] ELSE [] END),
          CASE WHEN {duck.count('md', '[A-Z]{2,}[A-Za-z0-9_-]*', '')} < 5 THEN ['translation:0.6'] WHEN NOT contains(lower(md), 'ipmi') AND NOT contains(lower(md), 'bmc') THEN ['translation:0.7'] ELSE [] END),
          list_slice(list_filter([CASE WHEN NOT regexp_matches(md, '(?m)^#{{1,6}}\\s+.+$') THEN 'formatting:0.9' END, CASE WHEN NOT contains(md, '|') AND contains(lower(md), 'table') THEN 'formatting:0.9' END, CASE WHEN contains(lower(md), 'ipmi') AND NOT contains(md, '```') THEN 'formatting:0.9' END], lambda x: x IS NOT NULL), 1, 2)) AS c FROM t)""",
        "c",
    )
)
def correction_plan(spark, sf_dir):
    t = F.col("md")
    ocr = F.array(F.lit("Low similarity between engines"))
    tree = F.array(F.lit("3 headings missing"), F.lit("levels differ"), F.lit("other level"))
    plan = reports.planned_corrections(t, 0.5 + (F.col("doc_id") % 5) / 10, ocr, 0.8 + (F.col("doc_id") % 3) / 10, tree)
    rows = md_docs(spark, sf_dir).select("doc_id", plan.alias("c"))
    return rows.select("doc_id", F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["type"], x["confidence"].cast("string"))), ",").alias("plan"), F.size("c").alias("n"))


OCR = "SELECT doc_id, ord, 'e' || ord AS engine, round(0.5 + ((doc_id * (ord + 3)) % 50) / 100.0, 4)::double AS confidence, CASE WHEN (doc_id + ord) % 4 = 0 THEN 'unknown' WHEN (doc_id + ord) % 4 = 1 THEN 'zh' ELSE 'en' END AS language, 10 + (doc_id * ord) % 40 AS word_count, round(0.6 + (doc_id % 40) / 100.0, 4)::double AS similarity FROM documents, (SELECT unnest(range(3)) AS ord) WHERE doc_id % 7 <> 0 OR ord = 0"


@query(
    f"""WITH r AS ({OCR}), g AS (SELECT doc_id, arg_max(engine, (confidence, -ord)) AS engine, max(confidence) AS base, count(*) AS n, list(language) FILTER (WHERE language <> 'unknown') AS langs, max(word_count) AS most, min(word_count) AS fewest, any_value(similarity) AS sim FROM r GROUP BY doc_id),
    c AS (SELECT *, CASE WHEN sim < 0.8 THEN base * sim ELSE base END * CASE WHEN coalesce(len(langs), 0) > 0 AND NOT list_contains(langs, 'zh') THEN 0.9 ELSE 1.0 END * CASE WHEN most::double / fewest > 2 THEN 0.95 ELSE 1.0 END AS conf FROM g)
    SELECT doc_id, engine, round(CASE WHEN n = 1 THEN base ELSE conf END, 6)::double AS confidence, round(CASE WHEN n = 1 THEN base ELSE conf * sim END, 6)::double AS score FROM c"""
)
def ocr_consensus(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("ord")).where("doc_id % 7 <> 0 or ord = 0")
    i, o = F.col("doc_id"), F.col("ord")
    r = d.select(
        "doc_id",
        "ord",
        F.concat(F.lit("e"), o.cast("string")).alias("engine"),
        F.round(0.5 + ((i * (o + 3)) % 50) / 100, 4).alias("confidence"),
        F.when((i + o) % 4 == 0, "unknown").when((i + o) % 4 == 1, "zh").otherwise("en").alias("language"),
        (10 + (i * o) % 40).alias("word_count"),
    )
    sims = d.select("doc_id", F.round(0.6 + (i % 40) / 100, 4).alias("similarity")).distinct()
    c = reports.ocr_consensus(r, sims)
    return c.select("doc_id", "engine", F.round("confidence", 6).alias("confidence"), F.round("score", 6).alias("score"))


@query()
def text_similarity(spark, sf_dir):
    """Each document against a perturbed copy, one without the letter e; matching blocks run in Python. Texts are whole."""
    t = F.col("text")
    rows = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).select("doc_id", t.alias("a"), F.regexp_replace(t, "e", "").alias("b"))
    return rows.select("doc_id", F.round(similarity.text_similarity(F.col("a"), F.col("b")), 6).alias("score"))


@query()
def segmented_overlap(spark, sf_dir):
    """Words of every Markdown document by a lexicon counted from all of them, and what it shares with its translated form."""
    docs = md_docs(spark, sf_dir)
    words = segmentation.read_lexicon(segmentation.lexicon_counts(docs, "md"))
    both = segmentation.segmented(docs.withColumn("other", translation.substitute_terms(F.col("md"))), words, {"md": "x", "other": "y"})
    return both.select("doc_id", F.size("x").cast("long").alias("n_words"), F.round(segmentation.token_overlap(F.col("x"), F.col("y")), 6).alias("overlap"))


WORDS = "list_distinct(regexp_extract_all({}, '\\S+'))"


@query(f"SELECT doc_id, round(len(list_intersect({WORDS.format('text')}, {WORDS.format('b')}))::double / len(list_distinct(list_concat({WORDS.format('text')}, {WORDS.format('b')}))), 6) AS score FROM (SELECT *, replace(text, 'a', 'o') AS b FROM documents)")
def jaccard_words(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return rows.select("doc_id", F.round(similarity.word_jaccard(F.col("text"), F.replace("text", F.lit("a"), F.lit("o"))), 6).alias("score"))


@query("WITH v AS (SELECT label, list_transform(embedding, lambda x: x::double) AS e FROM embeddings), p AS (SELECT label, unnest(range(len(e))) AS i, unnest(list_transform(e, lambda x: x / sqrt(list_dot_product(e, e)))) AS x FROM v), s AS (SELECT label, i, sum(x) AS s, sum(x * x) AS q, count(*) AS n FROM p GROUP BY ALL) SELECT label, round((sum(s * s) - sum(q)) / (max(n) * (max(n) - 1)), 6) AS cosine FROM s GROUP BY label")
def section_cosine(spark, sf_dir):
    """Mean cosine over all pairs of a label's vectors."""
    c = similarity.mean_pair_cosine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "label", "embedding")
    return c.select("label", F.round("cosine", 6).alias("cosine"))


@query("SELECT quality, count(*)::bigint AS n, count_if(passed)::bigint AS passed FROM (SELECT l.quality, length(text) >= 100 AS passed FROM labels l JOIN documents USING (doc_id)) GROUP BY quality")
def gate_by_label(spark, sf_dir):
    """How many documents of each label a length gate lets through."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", (F.length("text") >= 100).alias("passed"))
    j = spark.read.parquet(f"{sf_dir}/labels.parquet").join(d, "doc_id")
    return j.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.count_if("passed").alias("passed"))
