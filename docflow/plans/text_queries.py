"""Queries over text: counts, Markdown rules, translation, chunks, files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions import lexicon, markdown, translation
from docflow.functions.rx import count, occurrences, present
from docflow.operators import chunking
from docflow.plans import duck
from docflow.plans.registry import query
from docflow.sources.md_docs import md_docs

L = lexicon


def _text():
    return F.col("md")


def _one(spark: SparkSession, sf_dir: str, **columns) -> DataFrame:
    return md_docs(spark, sf_dir).select("doc_id", *(c.alias(n) for n, c in columns.items()))


def _md(**columns: str) -> str:
    return duck.over_md("doc_id, " + ", ".join(f"{c} AS {n}" for n, c in columns.items()))


@query(_md(n=duck.count("md", r"^#+\s")))
def heading_count(spark, sf_dir):
    return _one(spark, sf_dir, n=markdown.heading_count(_text()))


@query(_md(n=duck.count("md", duck.CJK, "")))
def cjk_count(spark, sf_dir):
    return _one(spark, sf_dir, n=markdown.cjk_count(_text()))


@query(_md(n_target=duck.occurrences("md", [b for _, b in L.PRESERVE_TERMS]), n_source=duck.occurrences("md", [a for a, _ in L.TECHNICAL_TERMS])))
def term_count(spark, sf_dir):
    return _one(spark, sf_dir, n_target=markdown.term_occurrences(_text()), n_source=occurrences(_text(), [a for a, _ in L.TECHNICAL_TERMS]))


@query(_md(n_qa=duck.present("md", L.QA_TERMS), n_required=duck.present("md", L.REQUIRED_TERMS)))
def term_presence(spark, sf_dir):
    return _one(spark, sf_dir, n_qa=present(_text(), L.QA_TERMS), n_required=present(_text(), L.REQUIRED_TERMS))


@query(_md(n_lines=f"len(list_filter({duck.lines('md')}, lambda x: starts_with({duck.strip('x')}, '```')))::bigint", n_fences=duck.count("md", "```", ""), odd=f"{duck.count('md', '```', '')} % 2 = 1"))
def fence_parity(spark, sf_dir):
    return _one(spark, sf_dir, n_lines=markdown.fence_lines(_text()), n_fences=markdown.fence_count(_text()), odd=markdown.fence_count(_text()) % 2 == 1)


@query(_md(ratio=f"round({duck.repetition('md')}, 9)"))
def repetition_ratio(spark, sf_dir):
    return _one(spark, sf_dir, ratio=F.round(markdown.repetition_ratio(_text()), 9))


@query(_md(n=duck.count("md", r"^#+\s+.*\n\s*\n\s*#+")))
def empty_sections(spark, sf_dir):
    return _one(spark, sf_dir, n=markdown.empty_section_count(_text()))


@query(_md(units=r"array_to_string(regexp_extract_all(md, '\d+(?:\.\d+)?(?:W|MHz|GB|TB|GHz|mm)'), ',')"))
def numbers_with_units(spark, sf_dir):
    return _one(spark, sf_dir, units=F.array_join(F.regexp_extract_all(_text(), F.lit(r"\d+(?:\.\d+)?(?:W|MHz|GB|TB|GHz|mm)"), 0), ","))


@query(_md(tokens="array_to_string(regexp_extract_all(md, '[A-Z]{2,}[A-Za-z0-9_-]*'), ',')", n=duck.count("md", "[A-Z]{2,}[A-Za-z0-9_-]*", "")))
def technical_tokens(spark, sf_dir):
    rx = "[A-Z]{2,}[A-Za-z0-9_-]*"
    return _one(spark, sf_dir, tokens=F.array_join(F.regexp_extract_all(_text(), F.lit(rx), 0), ","), n=count(_text(), rx, ""))


@query(duck.over_md("doc_id, " + duck.features("md").replace(duck.repetition("md"), f"round({duck.repetition('md')}, 9)")))
def document_features(spark, sf_dir):
    return _one(spark, sf_dir, f=markdown.features(_text())).select("doc_id", "f.*").withColumn("repetition", F.round("repetition", 9))


KIND = rf"""CASE WHEN {duck.strip('line')} = '' THEN 'empty' WHEN starts_with({duck.strip('line')}, '#') THEN 'header'
 WHEN starts_with({duck.strip('line')}, '|') AND length({duck.strip('line')}) - length(replace({duck.strip('line')}, '|', '')) > 6 THEN 'complex_table'
 WHEN regexp_matches(line, '\d+\s*(GB|MB|GHz|MHz|W|TB)') THEN 'technical_specs'
 WHEN regexp_matches(line, '(?i)\b(ipmitool|chassis|power|0x[0-9a-f]+)\b') THEN 'commands' ELSE 'text' END"""
LINES = f", md_lines AS (SELECT doc_id, unnest({duck.lines('md')}) AS line, unnest(range(len({duck.lines('md')}))) AS pos FROM md_docs)"


@query(duck.over_md("kind, count(*)::bigint AS n", LINES + f", k AS (SELECT {KIND} AS kind FROM md_lines)", "k GROUP BY kind"))
def complexity_histogram(spark, sf_dir):
    rows = md_docs(spark, sf_dir).select(F.explode(F.split("md", "\n")).alias("line"))
    return rows.groupBy(markdown.complexity(F.col("line")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


SIZES = "CASE kind " + " ".join(f"WHEN '{k}' THEN {n}" for k, n in L.BATCH_SIZES) + " END"


@query(duck.over_md("doc_id, sum(size)::bigint AS total, max(size)::int AS most", LINES + f", k AS (SELECT doc_id, {SIZES} AS size FROM (SELECT doc_id, {KIND} AS kind FROM md_lines))", "k GROUP BY doc_id"))
def batch_size_plan(spark, sf_dir):
    rows = md_docs(spark, sf_dir).select("doc_id", F.explode(F.split("md", "\n")).alias("line"))
    size = markdown.batch_size(markdown.complexity(F.col("line")))
    return rows.groupBy("doc_id").agg(F.sum(size).alias("total"), F.max(size).alias("most"))


@query(_md(key="substr(md5('zh-CN-ru-' || md), 1, 16)", prompt="sha256(md)"))
def cache_key(spark, sf_dir):
    return _one(spark, sf_dir, key=translation.cache_key(_text(), F.lit("zh-CN"), F.lit("ru")), prompt=translation.prompt_key(_text()))


@query("WITH d AS (SELECT doc_id, sha256(text) AS k FROM documents), c AS (SELECT DISTINCT k FROM d WHERE doc_id % 2 = 0) SELECT (count(*) FILTER (WHERE c.k IS NOT NULL))::bigint AS hits, (count(*) FILTER (WHERE c.k IS NULL))::bigint AS misses, (count(DISTINCT d.k) FILTER (WHERE c.k IS NULL))::bigint AS calls FROM d LEFT JOIN c USING (k)")
def cache_lookup(spark, sf_dir):
    """Prompts against answers known so far: hits, misses, and the different prompts that are left to ask."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", translation.prompt_key(F.col("text")).alias("k"))
    known = d.where("doc_id % 2 = 0").select("k").distinct().withColumn("hit", F.lit(True))
    j = d.join(known, "k", "left")
    return j.agg(F.count_if("hit").alias("hits"), F.count_if(F.col("hit").isNull()).alias("misses"), F.count_distinct(F.when(F.col("hit").isNull(), F.col("k"))).alias("calls"))


ANNOTATED = duck.replace("md", [(a, f"{a} ({b})") for a, b in L.PRESERVE_TERMS])


@query(_md(result=ANNOTATED))
def annotate_terms(spark, sf_dir):
    return _one(spark, sf_dir, result=markdown.annotate_terms(_text()))


def _clean(t: str) -> str:
    t = rf"regexp_replace({t}, '({duck.CJK})\s+({duck.CJK})', '\1\2', 'g')"
    t = rf"regexp_replace({t}, '({duck.CJK})\s*([，。；：！？])', '\1\2', 'g')"
    return duck.strip(duck.map_lines(duck.clean_breaks(t), duck.rstrip("x")))


@query(_md(result=_clean("md")))
def clean_formatting(spark, sf_dir):
    return _one(spark, sf_dir, result=markdown.clean_formatting(_text()))


def _level(b: str) -> str:
    hit = " OR ".join(f"regexp_matches({b}, {duck.q(p)})" for p in L.HEADING_PATTERNS)
    return f"CASE WHEN NOT ({hit}) THEN 0 WHEN contains({b}, '第') AND contains({b}, '章') THEN 1 WHEN contains({b}, '第') AND contains({b}, '节') THEN 2 WHEN regexp_matches({b}, {duck.q(L.HEADING_PATTERNS[1])}) THEN 3 ELSE 2 END"


PROMOTED = duck.map_lines("md", f"CASE WHEN {duck.strip('x')} <> '' AND NOT starts_with({duck.strip('x')}, '#') AND {_level(duck.strip('x'))} > 0 THEN repeat('#', ({_level(duck.strip('x'))})::bigint) || ' ' || {duck.strip('x')} ELSE x END")


@query(_md(result=PROMOTED))
def promote_headings(spark, sf_dir):
    return _one(spark, sf_dir, result=markdown.promote_headings(_text()))


CELLS = f"len(list_filter(string_split(line, '|'), lambda c: {duck.strip('c')} <> ''))"
SEPARATED = LINES + rf""", f AS (SELECT *, contains(line, '|') AND {CELLS} >= 2 AS is_row, lead(line) OVER w AS nxt FROM md_lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
s AS (SELECT *, coalesce(last_value(CASE WHEN is_row THEN 1 WHEN {duck.strip('line')} = '' THEN 0 END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inside FROM f),
o AS (SELECT doc_id, pos, line || CASE WHEN is_row AND inside = 0 AND nxt IS NOT NULL AND NOT regexp_matches(nxt, '^\|[\s\-:|]+\|') THEN chr(10) || '|' || repeat(' --- |', {CELLS}) ELSE '' END AS line FROM s)"""


@query(duck.over_md("doc_id, string_agg(line, chr(10) ORDER BY pos) AS result", SEPARATED, "o GROUP BY doc_id"))
def table_separator(spark, sf_dir):
    return _one(spark, sf_dir, result=markdown.add_separators(_text()))


SPACED = LINES + f""", n AS (SELECT doc_id, pos, CASE WHEN {duck.strip('line')} = '' THEN '' ELSE line END AS line FROM md_lines),
o AS (SELECT doc_id, pos, CASE WHEN starts_with({duck.strip('line')}, '|') AND length(line) - length(replace(line, '|', '')) >= 2 AND lag(line) OVER (PARTITION BY doc_id ORDER BY pos) <> '' THEN chr(10) ELSE '' END || line AS line FROM n)"""


@query(duck.over_md("doc_id, string_agg(line, chr(10) ORDER BY pos) AS result", SPACED, "o GROUP BY doc_id"))
def space_tables(spark, sf_dir):
    return _one(spark, sf_dir, result=markdown.space_tables(_text()))


IMPROVED = SPACED + r""", b AS (SELECT o.doc_id, CASE WHEN regexp_matches(any_value(md), '(?m)^#\s+(.+)') THEN '' ELSE '# Doc ' || o.doc_id || chr(10) || chr(10) END || string_agg(line, chr(10) ORDER BY pos) AS body FROM o JOIN md_docs USING (doc_id) GROUP BY o.doc_id)"""


def _added(title: str) -> str:
    return f"CASE WHEN contains(body, '{title}') THEN '' ELSE chr(10) || chr(10) || '## {title}' || chr(10) END"


WITH_TITLES = duck.strip("(body || " + _added("处理器") + " || " + _added("Appendix") + ")")


@query(duck.over_md(f"doc_id, {WITH_TITLES} AS result", IMPROVED, "b"))
def improve_structure(spark, sf_dir):
    titles = F.array(F.lit("处理器"), F.lit("Appendix"))
    return _one(spark, sf_dir, result=markdown.improve_structure(_text(), F.concat(F.lit("Doc "), F.col("doc_id").cast("string")), titles))


def _final(t: str) -> str:
    t = rf"regexp_replace({duck.strip(t)}, '(\n#+.*?)\n\n+', '\1' || chr(10) || chr(10), 'g')"
    t = rf"regexp_replace({t}, '(#+\s+.*?)\n([^\n])', '\1' || chr(10) || chr(10) || '\2', 'g')"
    t = rf"regexp_replace({t}, '\b(\d{{1,3}}\.\d{{1,3}}\.\d{{1,3}}\.\d{{1,3}})\b', '`\1`', 'g')"
    return rf"regexp_replace({t}, '\b(0x[0-9a-fA-F]+)\b', '`\1`', 'g')"


@query(_md(result=_final("md")))
def finalize_formatting(spark, sf_dir):
    return _one(spark, sf_dir, result=markdown.finalize_formatting(_text()))


@query(_md(result=rf"CASE WHEN len(list_filter({duck.lines('md')}, lambda x: starts_with({duck.strip('x')}, '```'))) % 2 = 1 THEN regexp_replace(md, '\n$', '') || chr(10) || '```' || chr(10) ELSE md END"))
def close_fences(spark, sf_dir):
    return _one(spark, sf_dir, result=markdown.close_fences(_text()))


@query(_md(reason=f"CASE WHEN {duck.count('md', '^#+' + chr(92) + 's')} < 1 THEN 'too few headings' WHEN len(list_filter({duck.lines('md')}, lambda x: starts_with({duck.strip('x')}, '```'))) % 2 = 1 THEN 'unclosed code fence' END"))
def validate_structure(spark, sf_dir):
    return _one(spark, sf_dir, reason=markdown.valid_structure(_text()))


BARE = f"list_transform({duck.lines('regexp_replace(md, ' + duck.q(chr(92) + 'n$') + ', ' + duck.q('') + ')')}, lambda x: {duck.strip('x')})"
UNMARKED = f"CASE WHEN starts_with(x, '#') THEN {duck.strip('ltrim(x, ' + duck.q('#') + ')')} ELSE x END"


@query(duck.over_md(f"doc_id, {duck.strip('array_to_string(ls, chr(10))')} AS result", f", b AS (SELECT doc_id, list_transform(list_filter(list_transform({BARE}, lambda x: {{'a': x, 'b': {UNMARKED}}}), lambda s: s.a = '' OR (s.b <> '' AND NOT (starts_with(s.b, '|') AND ends_with(s.b, '|')) AND NOT regexp_matches(s.b, '^[|: -]+$'))), lambda s: replace(s.b, '`', '')) AS ls FROM md_docs)", "b"))
def markdown_to_plain(spark, sf_dir):
    return _one(spark, sf_dir, result=markdown.to_plain(_text()))


SECTIONS = f""", l0 AS (SELECT doc_id, unnest({duck.lines("regexp_replace(md, chr(10) || '$', '')")}) AS line, unnest(range(len({duck.lines("regexp_replace(md, chr(10) || '$', '')")}))) AS pos FROM md_docs),
l1 AS (SELECT *, starts_with({duck.strip('line')}, '#') AS head FROM l0),
l2 AS (SELECT *, sum(head::int) OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM l1),
s0 AS (SELECT doc_id, g, min(CASE WHEN head THEN {duck.strip('line')} END) AS mark, coalesce(string_agg(CASE WHEN NOT head THEN line END, chr(10) ORDER BY pos), '') AS content FROM l2 GROUP BY doc_id, g),
s1 AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY g) - 1)::int AS id, mark, {duck.strip('content')} AS content FROM s0),
sections AS (SELECT doc_id, id, coalesce(nullif({duck.strip("ltrim(mark, '#')")}, ''), 'Section ' || (id + 1)) AS title, CASE WHEN mark IS NULL THEN 1 ELSE least(length(mark) - length(ltrim(mark, '#')), 6) END::int AS level, 1 AS page, content FROM s1)"""


@query(duck.over_md("doc_id, id, title, level, page, content", SECTIONS, "sections"))
def sections_from_markdown(spark, sf_dir):
    return md_docs(spark, sf_dir).select("doc_id", F.inline(markdown.sections(_text())))


BUILT = f"string_agg(repeat('#', level) || ' ' || title || CASE WHEN content <> '' THEN chr(10) || content ELSE '' END || chr(10), chr(10) ORDER BY id)"


@query(duck.over_md(f"doc_id, {duck.strip(BUILT)} AS result", SECTIONS, "sections GROUP BY doc_id"))
def build_markdown(spark, sf_dir):
    return _one(spark, sf_dir, result=markdown.build_markdown(markdown.sections(_text())))


@query("SELECT n_nationkey, '| key | ' || trim(n_name) || ' |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || n_regionkey || ' | x |' AS result FROM nation")
def render_table(spark, sf_dir):
    rows = F.array(F.array(F.lit("key"), F.concat(F.col("n_name"), F.lit(" "))), F.array(F.col("n_regionkey").cast("string"), F.lit(" x")))
    return spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", markdown.render_table(rows).alias("result"))


def _headings(t: str, lang: str) -> str:
    return duck.map_lines(t, f"CASE WHEN starts_with({duck.strip('x')}, '#') THEN {duck.replace('x', [p for p in L.HEADING_WORDS[lang] if p[1]])} ELSE x END")


def _tables(t: str, lang: str) -> str:
    words = [p for p in translation.DICTIONARIES[lang] if p[1]]
    cells = f"array_to_string(list_transform(string_split(x, '|'), lambda c: {duck.replace(duck.strip('c'), words)}), '|')"
    return duck.map_lines(t, f"CASE WHEN len(string_split(x, '|')) >= 3 THEN {cells} ELSE x END")


def _post(t: str, lang: str) -> str:
    t = duck.clean_breaks(t)
    if lang == "ru":
        t = rf"replace(regexp_replace({t}, '\.([А-Я])', '. \1', 'g'), '\"', '«')".replace('\\"', '"')
    return duck.strip(rf"regexp_replace({t}, '\(\s*([A-Za-z0-9]+)\s*\)', ' (\1)', 'g')")


def _translated(t: str, lang: str) -> str:
    t = duck.replace(duck.replace(t, L.TECHNICAL_TERMS), [p for p in translation.DICTIONARIES[lang] if p[1]])
    return _post(_tables(_headings(t, lang), lang), lang)


@query(_md(result=_translated("md", "ru")))
def dictionary_translate_ru(spark, sf_dir):
    return _one(spark, sf_dir, result=translation.translate(_text(), "ru"))


@query(_md(result=_translated("md", "en")))
def dictionary_translate_en(spark, sf_dir):
    return _one(spark, sf_dir, result=translation.translate(_text(), "en"))


@query(_md(result=_headings("md", "en")))
def translate_headings(spark, sf_dir):
    return _one(spark, sf_dir, result=translation.translate_headings(_text(), "en"))


@query(_md(result=_tables("md", "ru")))
def translate_tables(spark, sf_dir):
    return _one(spark, sf_dir, result=translation.translate_tables(_text(), "ru"))


@query(_md(result=_post("md", "ru")))
def postprocess(spark, sf_dir):
    return _one(spark, sf_dir, result=translation.post_process(_text(), "ru"))


def _scrubbed(t: str) -> str:
    t = duck.strip(t)
    for p in L.SCRUB_PATTERNS:
        t = f"regexp_replace({t}, {duck.q('(?is)' + p)}, '', 'g')"
    return t


@query(_md(result=_scrubbed("'Let me see. <thinking>a' || chr(10) || 'b</thinking>Here is it: ' || md")))
def scrub_output(spark, sf_dir):
    return _one(spark, sf_dir, result=translation.scrub(F.concat(F.lit("Let me see. <thinking>a\nb</thinking>Here is it: "), _text())))


def _fixed(t: str, lang: str) -> str:
    for p in L.BRAND_FIXES:
        t = f"regexp_replace({t}, {duck.q(p)}, 'WenTian', 'g')"
    return duck.replace(t, L.TERMINOLOGY_RU if lang == "ru" else L.TERMINOLOGY)


@query(_md(result=_fixed("'Qitian ' || md", "ru")))
def fix_terms(spark, sf_dir):
    return _one(spark, sf_dir, result=translation.fix_terms(F.concat(F.lit("Qitian "), _text()), "ru")["text"])


@query(_md(fragments=rf"array_to_string(list_slice(regexp_extract_all(md, '{duck.CJK}{{2,}}'), 1, 10), ',')"))
def residual_fragments(spark, sf_dir):
    return _one(spark, sf_dir, fragments=F.array_join(translation.residual_fragments(_text()), ","))


@query("SELECT conv_id, turn, CASE WHEN (" + " + ".join(f"contains(lower(text), {duck.q(w)})::int" for w in L.TRANSLATION_KEYWORDS) + ") > (" + " + ".join(f"contains(lower(text), {duck.q(w)})::int" for w in L.CONTENT_KEYWORDS) + ") THEN 'translation' ELSE 'content_transformation' END AS task FROM (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'Translate language: ' WHEN turn % 3 = 1 THEN 'markdown pdf ' ELSE '' END || text AS text FROM conversations)")
def route_task(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    text = F.concat(F.when(F.col("turn") % 3 == 0, "Translate language: ").when(F.col("turn") % 3 == 1, "markdown pdf ").otherwise(""), F.col("text"))
    return c.select("conv_id", "turn", translation.route_task(text).alias("task"))


@query("SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>', chr(10) ORDER BY turn, role, text) || chr(10) || '<|im_start|>assistant' || chr(10) AS prompt FROM conversations GROUP BY conv_id")
def chat_template(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    return turns.select("conv_id", translation.chat_template(F.col("m")).alias("prompt"))


MESSAGES = "CASE event_id % 6 WHEN 0 THEN 'TableData is not JSON serializable' WHEN 1 THEN 'Permission denied: x' WHEN 2 THEN 'No such file or directory' WHEN 3 THEN 'Connection reset' WHEN 4 THEN 'Read TIMEOUT' ELSE 'boom' END"


@query(f"SELECT category, action, count(*)::bigint AS n FROM (SELECT CASE WHEN contains(m, 'TableData') THEN 'serialization_error' WHEN contains(m, 'Permission denied') THEN 'permission_error' WHEN contains(m, 'No such file or directory') THEN 'file_not_found' WHEN contains(m, 'Connection') OR contains(lower(m), 'timeout') THEN 'network_error' ELSE 'general_error' END AS category, CASE WHEN contains(m, 'TableData') THEN 'disable_table_extraction' WHEN contains(m, 'Permission denied') THEN 'check_file_permissions' WHEN contains(m, 'No such file or directory') THEN 'verify_file_path' WHEN contains(m, 'Connection') OR contains(lower(m), 'timeout') THEN 'retry_with_backoff' ELSE 'investigate_logs' END AS action FROM (SELECT {MESSAGES} AS m FROM events)) GROUP BY ALL")
def classify_error(spark, sf_dir):
    m = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.expr(MESSAGES).alias("m"))
    return m.select(translation.classify_error(F.col("m")).alias("e")).groupBy("e.category", "e.action").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {duck.MD_CTE}, s AS (SELECT doc_id, md, unnest(CASE WHEN length(md) <= 6000 THEN [1] ELSE range(1, length(md) + 1, 5500) END) AS i FROM md_docs), c AS (SELECT doc_id, i, CASE WHEN length(md) <= 6000 THEN md ELSE substr(md, i, 6000) END AS chunk FROM s) SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::int AS pos, length(chunk)::int AS size, md5(chunk) AS digest FROM c WHERE {duck.strip('chunk')} <> ''")
def chunk_fixed(spark, sf_dir):
    rows = md_docs(spark, sf_dir).select("doc_id", F.posexplode(chunking.fixed_chunks(_text())).alias("pos", "chunk"))
    return rows.select("doc_id", "pos", F.length("chunk").alias("size"), F.md5(F.col("chunk").cast("binary")).alias("digest"))


@query()
def chunk_headers(spark, sf_dir):
    rows = md_docs(spark, sf_dir).select("doc_id", F.posexplode(chunking.header_chunks(_text(), longest=2000, overlap=200, shortest=300)).alias("pos", "chunk"))
    return rows.select("doc_id", "pos", F.length("chunk").alias("size"), F.md5(F.col("chunk").cast("binary")).alias("digest"))


@query()
def merge_chunks(spark, sf_dir):
    chunks = chunking.fixed_chunks(_text(), 2000, 200)
    return _one(spark, sf_dir, result=chunking.merge_chunks(chunks, 200))


@query()
def batch_planner(spark, sf_dir):
    rows = md_docs(spark, sf_dir).select("doc_id", F.posexplode(chunking.batch_plan(_text())).alias("batch", "b"))
    return rows.select("doc_id", "batch", F.col("b.first").alias("first_line"), F.size("b.lines").alias("n"))


@query(r"SELECT doc_id, substr(source, 1, 3) = 'src' AND length(text) > 0 AND length(text) <= 524288000 AS valid, md5(text) AS md5, sha256(text) AS sha256, greatest(1, strlen(text) // 102400)::bigint AS pages, len(regexp_extract_all(substr(text, 1, 500), '[\x{4e00}-\x{9fff}]')) > 5 AS has_source_script, len(regexp_extract_all(substr(text, 1, 500), '[\x{4e00}-\x{9fff}]')) <= 5 AS recommended_ocr, CASE WHEN strlen(text) > 52428800 THEN 'high' ELSE 'medium' END AS complexity FROM documents")
def file_profile(spark, sf_dir):
    from docflow.sources.files import profile

    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return profile(d, "text", F.startswith("source", F.lit("src")))


@query(r"SELECT doc_id, len(string_split(text, chr(10)))::bigint AS n_lines, len(regexp_extract_all(text, '[^ \t\n\r\f\v]+'))::bigint AS n_words, strlen(text)::bigint AS n_bytes, strlen(text) > 100 AS adequate, array_to_string(list_slice(string_split(text, chr(10)), 1, 5), chr(10)) AS head FROM documents")
def file_statistics(spark, sf_dir):
    from docflow.sources.files import statistics

    return statistics(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query(r"SELECT page_id, regexp_replace(url, '[^A-Za-z0-9._-]', '_', 'g') AS name, regexp_replace(url, '^https?://', '/mnt/') AS path FROM pages")
def sanitize_names(spark, sf_dir):
    from docflow.sources.files import mapped_path, safe_name

    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", safe_name(F.col("url")).alias("name"), mapped_path(F.col("url"), "^https?://", "/mnt/").alias("path"))


@query(r"SELECT page_id, (len(regexp_extract_all(html, '<li>')))::bigint AS n_items, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS title FROM pages")
def html_headings(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return p.select("page_id", count(F.col("html"), "<li>", "").alias("n_items"), F.regexp_extract("html", "<h1>([^<]*)</h1>", 1).alias("title"))


@query("SELECT doc_id, CASE lang WHEN 'zh-CN' THEN 'китайский' WHEN 'zh' THEN 'китайский' WHEN 'ru' THEN 'русский' WHEN 'en' THEN 'английский' ELSE lang END AS name, lang NOT IN ('original', 'zh', 'zh-CN') AS translate FROM documents")
def language_names(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return d.select("doc_id", translation.language_name(F.col("lang")).alias("name"), (~F.col("lang").isin("original", "zh", "zh-CN")).alias("translate"))
