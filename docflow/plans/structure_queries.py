"""Queries over structure: elements, sections, heading trees, tables, pages; and the relational set that Spark provides."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions import lexicon, markdown
from docflow.operators import flows, structure, vectors
from docflow.plans import duck
from docflow.plans.registry import query
from docflow.plans.text_queries import SECTIONS
from docflow.sources.md_docs import md_docs


def _t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TITLES = "CASE p_partkey % 6 WHEN 0 THEN p_partkey || '. ' || p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN p_name || ':' WHEN 3 THEN '1.' || p_size || ' ' || p_name WHEN 4 THEN 'IV. ' || p_name ELSE p_name END"
HEADING_RX = "(?i)" + "|".join(f"(?:{p})" for p in lexicon.TEXT_HEADING_PATTERNS)
IS_HEADING = f"(length(t) BETWEEN 5 AND 200 AND (regexp_matches(t, {duck.q(HEADING_RX)}) OR (upper(t) = t AND lower(t) <> t AND length(t) < 100) OR (ends_with(t, ':') AND length(t) < 150)))"
HEADING_LEVEL = r"CASE WHEN regexp_matches(t, '^[IVX]{1,4}\.?\s+') THEN 1 WHEN regexp_matches(t, '^\d+\.?\s+') THEN 2 WHEN regexp_matches(t, '^\d+\.\d+\.?\s+') THEN 3 ELSE 2 END"


@query(f"SELECT p_partkey, {IS_HEADING} AS heading, {HEADING_LEVEL}::int AS level FROM (SELECT p_partkey, {TITLES} AS t FROM part)")
def is_heading(spark, sf_dir):
    p = _t(spark, sf_dir, "part").selectExpr("p_partkey", f"{TITLES} AS t")
    return p.select("p_partkey", markdown.is_text_heading(F.col("t")).alias("heading"), markdown.text_heading_level(F.col("t")).alias("level"))


ELEMENTS = f"SELECT p_partkey % 40 AS doc_id, p_size % 4 + 1 AS page, p_partkey AS seq, p_retailprice AS y, CASE WHEN p_partkey % 11 = 0 THEN 'list' WHEN p_partkey % 5 = 0 THEN 'heading' ELSE 'text' END AS type, CASE WHEN p_partkey % 17 = 0 THEN ' ' WHEN p_partkey % 3 = 0 THEN {TITLES} ELSE '(' || p_name || ' - plain)' END AS text FROM part"


def _elements(spark, sf_dir):
    _t(spark, sf_dir, "part").createOrReplaceTempView("docflow_part")
    return structure.classify_elements(spark.sql(ELEMENTS.replace("FROM part", "FROM docflow_part")))


CLASSIFIED = f"e0 AS ({ELEMENTS}), e AS (SELECT *, {duck.strip('text')} AS t FROM e0 WHERE {duck.strip('text')} <> ''), c AS (SELECT *, CASE WHEN type = 'heading' OR {IS_HEADING} THEN 'heading' WHEN type IN ('list', 'table') THEN type ELSE 'paragraph' END AS kind, {HEADING_LEVEL} AS lv FROM e)"


@query(f"WITH {CLASSIFIED} SELECT doc_id, seq, kind, CASE WHEN kind = 'heading' THEN lv END::int AS level FROM c")
def classify_elements(spark, sf_dir):
    return _elements(spark, sf_dir).select("doc_id", "seq", "kind", "level")


@query(f"WITH {CLASSIFIED}, s AS (SELECT *, sum((kind = 'heading')::int) OVER (PARTITION BY doc_id ORDER BY page, y, seq) AS section FROM c) SELECT doc_id, section::bigint AS section, arg_min(text, (page, y, seq)) AS title, arg_min(CASE WHEN kind = 'heading' THEN lv END, (page, y, seq))::int AS level, min(page) AS page_start, max(page) AS page_end, count(*)::bigint AS n FROM s WHERE section > 0 GROUP BY doc_id, section")
def logical_sections(spark, sf_dir):
    return structure.logical_sections(_elements(spark, sf_dir))


@query(f"WITH {CLASSIFIED} SELECT doc_id, seq, row_number() OVER (PARTITION BY doc_id ORDER BY page, CASE WHEN kind = 'heading' THEN 1 ELSE 2 END, seq) AS position FROM c WHERE kind IN ('heading', 'paragraph')")
def reading_order(spark, sf_dir):
    return structure.reading_order(_elements(spark, sf_dir)).select("doc_id", "seq", "position")


@query("WITH t AS (SELECT p_partkey % 10 AS doc_id, p_partkey AS seq, p_type || ' ' || p_size AS text FROM part), c AS (SELECT DISTINCT p_partkey % 10 AS doc_id, lower(p_type || ' ' || p_size) AS k FROM part WHERE p_partkey % 3 = 0), x AS (SELECT t.*, row_number() OVER (PARTITION BY doc_id, lower(text) ORDER BY seq) AS n FROM t ANTI JOIN c ON t.doc_id = c.doc_id AND lower(t.text) = c.k) SELECT doc_id, seq, text FROM x WHERE n = 1")
def not_captured(spark, sf_dir):
    p = _t(spark, sf_dir, "part").select((F.col("p_partkey") % 10).alias("doc_id"), F.col("p_partkey").alias("seq"), F.concat_ws(" ", "p_type", "p_size").alias("text"))
    return structure.not_captured(p, p.where("seq % 3 = 0").withColumn("text", F.upper("text")))


@query("SELECT 1 AS doc_id, row_number() OVER (ORDER BY path) AS position, node_id, title, level, child_count FROM (SELECT 0 AS node_id, 'World' AS title, 1 AS level, [0] AS path, (SELECT count(*) FROM region) AS child_count UNION ALL SELECT 100 + r_regionkey, r_name, 2, [0, r_regionkey], (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) FROM region UNION ALL SELECT 1000 + n_nationkey, n_name, 3, [0, n_regionkey, n_nationkey], 0 FROM nation)")
def ast_flatten(spark, sf_dir):
    r, n = _t(spark, sf_dir, "region"), _t(spark, sf_dir, "nation")
    root = spark.range(1).selectExpr("1 AS doc_id", "0 AS node_id", "CAST(NULL AS INT) AS parent_id", "0 AS pos", "'World' AS title")
    nodes = root.union(r.selectExpr("1", "100 + r_regionkey", "0", "r_regionkey", "r_name")).union(n.selectExpr("1", "1000 + n_nationkey", "100 + n_regionkey", "n_nationkey", "n_name"))
    return structure.flatten_tree(spark, nodes)


CHANGED = "CASE p_partkey % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name || 'x' WHEN 2 THEN reverse(p_name) ELSE p_name END"
ORIGINAL = "SELECT p_partkey % 50 AS doc_id, p_partkey AS pos, p_name AS title, p_size % 3 + 1 AS level FROM part"
RESULT = f"SELECT p_partkey % 50 AS doc_id, p_partkey AS pos, {CHANGED} AS title, p_size % 4 + 1 AS level FROM part WHERE p_partkey % 5 <> 0"


def _sides(spark, sf_dir):
    _t(spark, sf_dir, "part").createOrReplaceTempView("docflow_part")
    return tuple(spark.sql(s.replace("FROM part", "FROM docflow_part")) for s in (ORIGINAL, RESULT))


MATCHED = f"""a AS ({ORIGINAL}), b AS ({RESULT}),
x AS (SELECT a.*, (SELECT max_by({{'t': b.title, 'l': b.level}}, b.pos) FROM b WHERE b.doc_id = a.doc_id AND lower(b.title) = lower(a.title)) AS r FROM a),
s AS (SELECT x.doc_id, x.pos, b.title, b.level, b.pos AS rpos, 1 - levenshtein(lower(x.title), lower(b.title))::double / greatest(length(x.title), length(b.title)) AS sim FROM x JOIN b ON x.doc_id = b.doc_id WHERE x.r IS NULL),
m AS (SELECT doc_id, pos, arg_max({{'t': title, 'l': level}}, (sim, -rpos)) AS f, max(sim) AS sim FROM s WHERE sim >= 0.8 GROUP BY ALL),
j AS (SELECT x.*, CASE WHEN r IS NOT NULL THEN 'exact' WHEN f IS NOT NULL THEN 'approximate' ELSE 'missing' END AS match_type, coalesce(r, f) AS hit, CASE WHEN r IS NOT NULL THEN 1.0 ELSE coalesce(m.sim, 0.0) END AS sim FROM x LEFT JOIN m USING (doc_id, pos))"""


@query(f"WITH {MATCHED} SELECT doc_id, pos, match_type, hit.t AS result_title, round(sim, 6)::double AS similarity, coalesce(hit.l = level, false) AS level_match FROM j")
def heading_match_fuzzy(spark, sf_dir):
    m = structure.match_headings(*_sides(spark, sf_dir))
    return m.select("doc_id", "pos", "match_type", "result_title", F.round("similarity", 6).alias("similarity"), "level_match")


STRUCTURAL = f"WITH a AS ({ORIGINAL}), b AS ({RESULT}), g1 AS (SELECT doc_id, list(DISTINCT level) AS l1, list(DISTINCT lower(title)) AS t1, count(*) AS n1 FROM a GROUP BY doc_id), g2 AS (SELECT doc_id, list(DISTINCT level) AS l2, list(DISTINCT lower(title)) AS t2, count(*) AS n2 FROM b GROUP BY doc_id), "


@query(STRUCTURAL + "g AS (SELECT * FROM g1 FULL JOIN g2 USING (doc_id)) SELECT doc_id, round(coalesce(len(list_intersect(l1, l2))::double / len(list_distinct(list_concat(l1, l2))) * 0.4 + len(list_intersect(t1, t2))::double / len(list_distinct(list_concat(t1, t2))) * 0.4 + (1 - abs(n1 - n2)::double / greatest(n1, n2)) * 0.2, 0), 6)::double AS similarity FROM g WHERE l1 IS NOT NULL")
def ast_structural(spark, sf_dir):
    s = structure.structural_similarity(*_sides(spark, sf_dir))
    return s.select("doc_id", F.round("similarity", 6).alias("similarity"))


def _hashed(table: str, to: str) -> str:
    return f"(SELECT doc_id, ('0x' || substr(md5(w), 1, 2))::int % 32 AS k, sum(CASE WHEN substr(md5(w), 3, 1) >= '8' THEN 1 ELSE -1 END)::double AS {to} FROM (SELECT doc_id, unnest(list_filter(string_split_regex(lower(title), '\\s+'), lambda w: w <> '')) AS w FROM {table}) GROUP BY ALL)"


OVERALL = f"""o1 AS (SELECT doc_id, list(DISTINCT level) AS l1, list(DISTINCT lower(title)) AS t1, count(*) AS n1 FROM a GROUP BY doc_id),
o2 AS (SELECT doc_id, list(DISTINCT level) AS l2, list(DISTINCT lower(title)) AS t2, count(*) AS n2 FROM b GROUP BY doc_id),
st AS (SELECT doc_id, coalesce(len(list_intersect(l1, l2))::double / len(list_distinct(list_concat(l1, l2))) * 0.4 + len(list_intersect(t1, t2))::double / len(list_distinct(list_concat(t1, t2))) * 0.4 + (1 - abs(n1 - n2)::double / greatest(n1, n2)) * 0.2, 0) AS structural FROM o1 FULL JOIN o2 USING (doc_id)),
me AS (SELECT doc_id, greatest(0, coalesce(sum(coalesce(x, 0) * coalesce(y, 0)) / nullif(sqrt(sum(coalesce(x, 0) * coalesce(x, 0))) * sqrt(sum(coalesce(y, 0) * coalesce(y, 0))), 0), 0)) AS semantic FROM {_hashed('a', 'x')} p FULL JOIN {_hashed('b', 'y')} q USING (doc_id, k) GROUP BY doc_id),
ov AS (SELECT doc_id, structural, coalesce(semantic, 0) AS semantic, structural * 0.7 + coalesce(semantic, 0) * 0.3 AS overall FROM st LEFT JOIN me USING (doc_id))"""


@query(f"WITH a AS ({ORIGINAL}), b AS ({RESULT}), {OVERALL} SELECT doc_id, round(structural, 6)::double AS structural, round(semantic, 6)::double AS semantic, round(overall, 6)::double AS overall FROM ov")
def ast_overall(spark, sf_dir):
    """Likeness of heading trees in structure and meaning."""
    s = structure.overall_similarity(*_sides(spark, sf_dir))
    return s.select("doc_id", *(F.round(c, 6).alias(c) for c in ("structural", "semantic", "overall")))


@query()
def title_meaning(spark, sf_dir):
    """Likeness of both sides' titles by word vectors that all titles train."""
    a, b = _sides(spark, sf_dir)
    words = vectors.word_vectors(a.select("title").unionByName(b.select("title")), "title")
    return vectors.title_likeness(a, b, words).withColumn("semantic", F.round("semantic", 6))


@query()
def section_coherence(spark, sf_dir):
    """How much the sections of every Markdown document have to do with each other, by word vectors that all sections train."""
    docs = md_docs(spark, sf_dir)
    return vectors.section_coherence(docs, vectors.section_words(docs)).withColumn("semantic", F.round("semantic", 6))


@query(f"WITH {MATCHED}, {OVERALL}, n AS (SELECT doc_id, count(*) AS n1, (SELECT count(*) FROM b WHERE b.doc_id = a.doc_id) AS n2 FROM a GROUP BY doc_id), g AS (SELECT doc_id, count_if(match_type = 'missing') AS missing, count_if(match_type <> 'missing' AND NOT coalesce(hit.l = level, false)) AS levels, count_if(match_type = 'approximate') AS approximate FROM j GROUP BY doc_id) SELECT doc_id, missing::bigint AS missing, levels::bigint AS levels, approximate::bigint AS approximate, array_to_string(list_filter([CASE WHEN overall < 0.9 THEN 'low similarity' END, CASE WHEN missing > 0 THEN 'missing headings' END, CASE WHEN levels > 0 THEN 'levels differ' END, CASE WHEN abs(n1 - n2) > n1 * 0.1 THEN 'counts differ' END, CASE WHEN approximate > n1 * 0.2 THEN 'approximate matches' END], lambda x: x IS NOT NULL), ',') AS issues FROM n JOIN g USING (doc_id) JOIN ov USING (doc_id)")
def ast_issues(spark, sf_dir):
    a, b = _sides(spark, sf_dir)
    n = a.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n1")).join(b.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n2")), "doc_id", "left").na.fill(0)
    overall = structure.overall_similarity(a, b).select("doc_id", "overall")
    out = structure.comparison_issues(structure.match_headings(a, b), n.join(overall, "doc_id"))
    return out.withColumn("issues", F.array_join("issues", ","))


@query(duck.over_md("doc_id, array_to_string(list_slice(list(title ORDER BY id) FILTER (WHERE NOT contains(other, title)), 1, 5), '|') AS missing", SECTIONS + ", j AS (SELECT sections.*, replace(md, 'A', '') AS other FROM sections JOIN md_docs USING (doc_id))", "j GROUP BY doc_id"))
def missing_titles(spark, sf_dir):
    """The first five section titles that another version of the text (here one without the letter A) lacks."""
    rows = md_docs(spark, sf_dir).select("doc_id", F.replace("md", F.lit("A"), F.lit("")).alias("other"), markdown.sections(F.col("md")).alias("s"))
    lost = F.filter("s", lambda x: ~F.contains("other", x["title"]))
    titles = F.slice(F.transform(lost, lambda x: x["title"]), 1, 5)
    return rows.select("doc_id", F.when(F.size(titles) > 0, F.array_join(titles, "|")).alias("missing"))


@query("SELECT p_partkey, n_rows >= 2 AND n_cols >= 2 AND empty::double / (n_rows * n_cols) <= 0.5 AS valid, round(least(1.0, greatest(0.0, 0.5 + (n_rows >= 3)::int * 0.1 + (n_cols >= 3)::int * 0.1 - empty::double / (n_rows * n_cols) * 0.3 + (head)::int * 0.1 + (variety > 1)::int * 0.1)), 6)::double AS quality FROM (SELECT p_partkey, p_size % 4 + 1 AS n_rows, 2 AS n_cols, CASE WHEN p_partkey % 3 = 0 THEN p_size % 4 + 1 ELSE 0 END AS empty, true AS head, ((p_size % 4 + 1) + CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 1 END) / 2.0 AS variety FROM part)")
def table_quality(spark, sf_dir):
    cell = F.when(F.col("p_partkey") % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("x"))
    rows = F.transform(F.sequence(F.lit(1), F.col("p_size") % 4 + 1), lambda i: F.array(i.cast("string"), cell))
    p = _t(spark, sf_dir, "part").select("p_partkey", rows.alias("r"))
    return p.select("p_partkey", structure.table_validity(F.col("r")).alias("valid"), F.round(structure.table_quality(F.col("r")), 6).alias("quality"))


@query()
def dedup_tables(spark, sf_dir):
    li = _t(spark, sf_dir, "part").selectExpr("p_partkey % 30 AS doc_id", "p_size % 3 AS page", "p_partkey AS seq", "if(p_partkey % 2 = 0, 'lattice', 'stream') AS engine", "p_size AS rows", "length(p_brand) + p_partkey % 5 AS columns", "p_retailprice / 3000 AS quality_score")
    return structure.dedup_tables(li).withColumn("quality_score", F.round("quality_score", 6))


PAGES1 = "SELECT p_partkey % 60 AS doc_id, p_size AS page, max(p_retailprice) AS a FROM part GROUP BY ALL"
PAGES2 = "SELECT p_partkey % 60 AS doc_id, p_size AS page, min(p_retailprice) AS b FROM part WHERE p_partkey % 7 <> 0 GROUP BY ALL"


@query(f"WITH x AS ({PAGES1}), y AS ({PAGES2}), n AS (SELECT doc_id, (SELECT count(*) FROM x WHERE x.doc_id = d.doc_id) AS n1, (SELECT count(*) FROM y WHERE y.doc_id = d.doc_id) AS n2 FROM (SELECT doc_id FROM x UNION SELECT doc_id FROM y) d) SELECT doc_id, page, round(a - b, 6) AS gap, NULL AS severity FROM x JOIN y USING (doc_id, page) UNION ALL SELECT doc_id, 0, NULL, 'high' FROM n WHERE n1 <> n2")
def page_zip(spark, sf_dir):
    _t(spark, sf_dir, "part").createOrReplaceTempView("docflow_part")
    x, y = (spark.sql(s.replace("FROM part", "FROM docflow_part")) for s in (PAGES1, PAGES2))
    pairs, odd = structure.zip_pages(x, y)
    one = pairs.select("doc_id", "page", F.round(F.col("a") - F.col("b"), 6).alias("gap"), F.lit(None).cast("string").alias("severity"))
    return one.union(odd.select("doc_id", "page", F.lit(None).cast("double"), "severity"))


DIFFS = "SELECT p_partkey % 50 AS doc_id, CASE p_size % 3 WHEN 0 THEN 'added' WHEN 1 THEN 'removed' ELSE 'changed' END AS type, CASE p_partkey % 5 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' WHEN 3 THEN 'critical' ELSE 'odd' END AS severity, round(p_size / 500.0, 4) AS confidence FROM part WHERE p_partkey % 20 < 3"


@query(f"WITH d AS ({DIFFS}), g AS (SELECT doc_id, {', '.join(f'count_if(type = {duck.q(k)})::bigint AS n_{k}' for k in ('added', 'removed', 'changed'))}, {', '.join(f'count_if(severity = {duck.q(k)})::bigint AS n_{k}' for k in ('low', 'medium', 'high', 'critical'))}, sum(CASE severity WHEN 'low' THEN 0.01 WHEN 'high' THEN 0.1 WHEN 'critical' THEN 0.2 ELSE 0.05 END * confidence) AS pen FROM d GROUP BY doc_id), s AS (SELECT p_partkey % 50 AS doc_id, avg(round(0.9 + p_size / 1000.0, 4)) AS ssim FROM part GROUP BY ALL) SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in ('added', 'removed', 'changed', 'low', 'medium', 'high', 'critical'))}, round(least(1.0, greatest(0.0, ssim - coalesce(pen, 0))), 6)::double AS similarity FROM s LEFT JOIN g USING (doc_id)")
def visual_summary(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    p.createOrReplaceTempView("docflow_part")
    diffs = spark.sql(DIFFS.replace("FROM part", "FROM docflow_part").replace("500.0", "500D"))
    ssim = p.select((F.col("p_partkey") % 50).alias("doc_id"), F.round(0.9 + F.col("p_size") / 1000, 4).alias("ssim"))
    return structure.visual_summary(diffs, ssim).drop("penalty", "ssim").withColumn("similarity", F.round("similarity", 6))


VISUAL = f"d AS ({DIFFS}), g AS (SELECT doc_id, count(*) AS n, count_if(severity IN ('high', 'critical')) AS severe, sum(CASE severity WHEN 'low' THEN 0.01 WHEN 'high' THEN 0.1 WHEN 'critical' THEN 0.2 ELSE 0.05 END * confidence) AS pen FROM d GROUP BY doc_id), s AS (SELECT p_partkey % 50 AS doc_id, avg(round(0.9 + p_size / 1000.0, 4)) AS ssim, count(*) AS pages FROM part GROUP BY ALL), v AS (SELECT doc_id, pages, coalesce(n, 0) AS n, coalesce(severe, 0) AS severe, least(1.0, greatest(0.0, ssim - coalesce(pen, 0))) AS likeness FROM s LEFT JOIN g USING (doc_id))"


@query(f"WITH {VISUAL} SELECT doc_id, round(likeness, 6)::double AS score, array_to_string(list_filter([CASE WHEN likeness < 0.95 THEN 'low visual likeness' END, CASE WHEN n > greatest(1, round_even(pages * 0.1, 0)) THEN 'too many differences' END, CASE WHEN severe > 0 THEN 'severe differences' END], lambda x: x IS NOT NULL), ',') AS issues FROM v")
def qa_level2(spark, sf_dir):
    """The visual level from page differences and likeness."""
    p = _t(spark, sf_dir, "part")
    diffs = p.where("p_partkey % 20 < 3").selectExpr("p_partkey % 50 AS doc_id", "CASE p_size % 3 WHEN 0 THEN 'added' WHEN 1 THEN 'removed' ELSE 'changed' END AS type", "CASE p_partkey % 5 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' WHEN 3 THEN 'critical' ELSE 'odd' END AS severity", "round(p_size / 500D, 4) AS confidence")
    pages = p.select((F.col("p_partkey") % 50).alias("doc_id"), F.round(0.9 + F.col("p_size") / 1000, 4).alias("ssim"))
    level = flows.visual_level(structure.visual_summary(diffs, pages), pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pages")))
    return level.select("doc_id", F.round("score", 6).alias("score"), F.array_join("issues", ",").alias("issues"))


# Provided by Spark, here as named queries over the star schema.


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*)::bigint AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def pricing_summary(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(revenue, 2).alias("revenue"), F.count(F.lit(1)).alias("n"))


@query("SELECT n_name, round(sum(o_totalprice), 2) AS total, count(*)::bigint AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def orders_by_nation(spark, sf_dir):
    o, c, n = (_t(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    j = o.select("o_custkey", "o_totalprice").join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    by = j.groupBy("c_nationkey").agg(F.sum("o_totalprice").alias("t"), F.count(F.lit(1)).alias("n"))
    return by.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", F.round("t", 2).alias("total"), "n")


@query("SELECT c_mktsegment, o_orderpriority, count(*)::bigint AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ROLLUP (c_mktsegment, o_orderpriority)")
def orders_rollup(spark, sf_dir):
    o, c = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "customer")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).rollup("c_mktsegment", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_custkey, o_orderkey, rank FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3")
def top_orders(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("rank", F.expr("row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey)").cast("long"))
    return o.where("rank <= 3").select("o_custkey", "o_orderkey", "rank")
