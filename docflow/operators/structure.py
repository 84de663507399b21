"""Structure: elements, logical sections, reading order, heading trees and their comparison, pages, tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions.markdown import is_text_heading, text_heading_level
from docflow.functions.rx import clamp, strip


def classify_elements(elements: DataFrame) -> DataFrame:
    """(doc_id, page, seq, type, text, …) to ``kind`` and ``level``; empty texts fall out."""
    heading = (F.col("type") == "heading") | is_text_heading(F.col("text"))
    kind = F.when(heading, "heading").when(F.col("type").isin("list", "table"), F.col("type")).otherwise("paragraph")
    kept = elements.where(strip(F.col("text")) != "")
    return kept.withColumn("kind", kind).withColumn("level", F.when(F.col("kind") == "heading", text_heading_level(F.col("text"))))


def vertical_position(box: Column, pair: Column) -> Column:
    """The top edge: from a box struct, else from a coordinate array, else 0."""
    return F.coalesce(box["y1"], F.get(pair, F.lit(1)), F.lit(0.0))


def logical_sections(elements: DataFrame) -> DataFrame:
    """(doc_id, section, title, level, page_start, page_end, n): elements by page and position from each heading on.

    ``elements`` has doc_id, page, y, seq, kind, text, level. One shuffle by document serves the running number and the groups.
    """
    rows = elements.withColumn("section", F.expr("sum(int(kind = 'heading')) over (partition by doc_id order by page, y, seq)")).where("section > 0")
    first = F.min_by(F.struct("text", "level"), F.struct("page", "y", "seq")).alias("h")
    out = rows.groupBy("doc_id", "section").agg(first, F.min("page").alias("page_start"), F.max("page").alias("page_end"), F.count(F.lit(1)).alias("n"))
    return out.select("doc_id", F.col("section").cast("long").alias("section"), F.col("h.text").alias("title"), F.col("h.level").alias("level"), "page_start", "page_end", "n")


def reading_order(elements: DataFrame) -> DataFrame:
    """Headings before paragraphs on each page, otherwise as they come; position from 1."""
    rows = elements.where("kind in ('heading', 'paragraph')")
    return rows.withColumn("position", F.expr("row_number() over (partition by doc_id order by page, if(kind = 'heading', 1, 2), seq)").cast("long"))


def not_captured(texts: DataFrame, captured: DataFrame) -> DataFrame:
    """Rows (doc_id, seq, text) whose text, whatever its case, is neither among ``captured`` nor earlier in ``texts``."""
    key = F.lower(strip(F.col("text")))
    known = captured.select("doc_id", key.alias("_key")).distinct()
    rows = texts.withColumn("_key", key).join(known, ["doc_id", "_key"], "left_anti")
    return rows.withColumn("_n", F.expr("row_number() over (partition by doc_id, _key order by seq)")).where("_n = 1").drop("_n", "_key")


def flatten_tree(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """Pre-order rows of trees given as (doc_id, node_id, parent_id, pos, title): depth from 1, children, position."""
    children = nodes.groupBy("doc_id", F.col("parent_id").alias("node_id")).agg(F.count(F.lit(1)).alias("child_count"))
    level = nodes.where("parent_id is null").select("doc_id", "node_id", "title", F.lit(1).alias("level"), F.array("pos").alias("path"))
    found = level
    while True:
        below = nodes.select("doc_id", F.col("node_id").alias("n"), F.col("parent_id").alias("p"), "pos", F.col("title").alias("t"))
        level = level.select("doc_id", F.col("node_id").alias("p"), "level", "path").join(below, ["doc_id", "p"]).select("doc_id", F.col("n").alias("node_id"), F.col("t").alias("title"), (F.col("level") + 1).alias("level"), F.concat("path", F.array("pos")).alias("path"))
        if level.isEmpty():
            break
        found = found.unionByName(level)
    out = found.join(children, ["doc_id", "node_id"], "left")
    order = F.expr("row_number() over (partition by doc_id order by path)").cast("long")
    return out.select("doc_id", order.alias("position"), "node_id", "title", "level", F.coalesce("child_count", F.lit(0)).cast("long").alias("child_count"))


#: Pairs of titles in a document from which pieces of titles are joined instead of the pairs; results are the same.
MANY_PAIRS = 100_000


def _allowed(n: Column, least: float) -> Column:
    """The edits that a likeness of ``least`` allows, for the longer title's length."""
    return F.floor((1 - least) * n + 1e-9).cast("int")


def _piece_start(n: Column, edits: Column, i: Column) -> Column:
    """Where piece i of a title of length n begins that is cut evenly into one piece more than edits; the last ones are longer."""
    size = F.floor(n / (edits + 1)).cast("int")
    return i * size + F.greatest(F.lit(0), i - ((edits + 1) * (size + 1) - n))


def title_pairs(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """Pairs of titles (doc_id, key, rkey) of one document that may be alike, for ``key`` on the left and ``rkey`` on the right; none is missed.

    A title cut into one piece more than edits are allowed has a piece that stays whole, so it is in the other title, moved by no more than
    the edits before it or after it allow. Titles meet on such pieces, for each pair of lengths, and not on being in one document.
    """
    n, m = F.length("key"), F.length("rkey")
    each = lambda lo, hi, f: F.when(lo <= hi, F.transform(F.sequence(lo, hi), f))
    cut = lambda t, at, size: F.substring(t, at + 1, size)
    longest = F.floor(n / least + 1e-9).cast("int")
    pieces = each(_allowed(n, least), _allowed(longest, least), lambda e: F.transform(F.sequence(F.lit(0), e), lambda i: F.struct(e.alias("e"), i.alias("i"), cut(F.col("key"), _piece_start(n, e, i), _piece_start(n, e, i + 1) - _piece_start(n, e, i)).alias("p"))))
    own = left.select("doc_id", "key").distinct().select("doc_id", "key", n.alias("n"), F.explode(F.flatten(pieces)).alias("x")).select("doc_id", "key", "n", "x.*")

    def places(k: Column) -> Column:
        e = _allowed(F.greatest(k, m), least)

        def at(i: Column) -> Column:
            start, size = _piece_start(k, e, i), _piece_start(k, e, i + 1) - _piece_start(k, e, i)
            lo = F.greatest(start - i, start + (m - k) - (e - i), F.lit(0))
            hi = F.least(start + i, start + (m - k) + (e - i), m - size)
            return F.coalesce(each(lo, hi, lambda p: F.struct(k.alias("n"), e.alias("e"), i.alias("i"), cut(F.col("rkey"), p, size).alias("p"))), F.array())

        return F.flatten(F.transform(F.sequence(F.lit(0), e), at))

    probes = each(F.ceil(m * least - 1e-9).cast("int"), F.floor(m / least + 1e-9).cast("int"), places)
    other = right.select("doc_id", "rkey").distinct().select("doc_id", "rkey", F.explode(F.flatten(probes)).alias("x")).select("doc_id", "rkey", "x.*").distinct()
    return own.join(other, ["doc_id", "n", "e", "i", "p"]).select("doc_id", "key", "rkey").distinct()


def match_headings(original: DataFrame, result: DataFrame, least: float = 0.8) -> DataFrame:
    """Each original heading with its match: the last of equal titles, else the most alike title (first on ties), else missing.

    Both sides have doc_id, pos, title, level. Exact matches are an equi-join; only what is left meets the other side's titles of the
    same document, and only those whose length allows the likeness. In documents of very many titles pieces of titles are joined first.
    """
    last = F.max_by(F.struct("title", "level"), "pos").alias("r")
    exact = result.groupBy("doc_id", F.lower("title").alias("key")).agg(last)
    joined = original.withColumn("key", F.lower("title")).join(exact, ["doc_id", "key"], "left")
    left = joined.where("r is null").select("doc_id", "pos", "key")
    other = result.select("doc_id", F.col("pos").alias("rpos"), F.lower("title").alias("rkey"), F.struct("title", "level").alias("f"))
    longest = F.greatest(F.length("key"), F.length("rkey"))
    sizes = left.groupBy("doc_id").agg(F.count(F.lit(1)).alias("a")).join(other.groupBy("doc_id").agg(F.count(F.lit(1)).alias("b")), "doc_id")
    large = sizes.where(F.col("a") * F.col("b") > MANY_PAIRS).select("doc_id")
    few = left.join(large, "doc_id", "left_anti").join(other, "doc_id")
    pairs = title_pairs(left.join(large, "doc_id", "left_semi"), other.join(large, "doc_id", "left_semi"), least)
    near = few.unionByName(left.join(pairs, ["doc_id", "key"]).join(other, ["doc_id", "rkey"]).select(*few.columns))
    near = near.where(F.abs(F.length("key") - F.length("rkey")) <= (1 - least) * longest + 1e-9)
    near = near.withColumn("likeness", 1 - F.levenshtein("key", "rkey") / longest).where(F.col("likeness") >= least)
    best = near.groupBy("doc_id", "pos").agg(F.max(F.struct("likeness", (-F.col("rpos")).alias("order"), "f")).alias("b"))
    out = joined.join(best, ["doc_id", "pos"], "left")
    kind = F.when(F.col("r").isNotNull(), "exact").when(F.col("b").isNotNull(), "approximate").otherwise("missing")
    hit = F.coalesce("r", "b.f")
    return out.select(
        "doc_id",
        "pos",
        "title",
        "level",
        kind.alias("match_type"),
        hit["title"].alias("result_title"),
        F.when(F.col("r").isNotNull(), 1.0).otherwise(F.coalesce("b.likeness", F.lit(0.0))).alias("similarity"),
        F.coalesce(hit["level"] == F.col("level"), F.lit(False)).alias("level_match"),
    )


def structural_similarity(original: DataFrame, result: DataFrame) -> DataFrame:
    """(doc_id, similarity): levels, titles and counts of two heading lists; 0 where one is empty."""
    side = lambda d, s: d.groupBy("doc_id").agg(F.collect_set("level").alias(f"l{s}"), F.collect_set(F.lower("title")).alias(f"t{s}"), F.count(F.lit(1)).alias(f"n{s}"))
    both = side(original, 1).join(side(result, 2), "doc_id", "full")
    jaccard = lambda a, b: F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1))
    counts = 1 - F.abs(F.col("n1") - F.col("n2")) / F.greatest("n1", "n2")
    score = jaccard(F.col("l1"), F.col("l2")) * 0.4 + jaccard(F.col("t1"), F.col("t2")) * 0.4 + counts * 0.2
    return both.select("doc_id", F.coalesce(score, F.lit(0.0)).alias("similarity"))


#: Dimensions of the word hashes that stand for title vectors; weights of structure and meaning in the overall likeness.
DIMENSIONS, STRUCTURE, MEANING = 32, 0.7, 0.3


def semantic_similarity(original: DataFrame, result: DataFrame) -> DataFrame:
    """(doc_id, semantic): cosine of the mean vectors of both heading lists, at least 0; 0 where one is empty.

    Words hashed to signed dimensions stand for a sentence model; the cosine of means is that of sums, so sums by document
    and dimension are all that is shuffled.
    """

    def sums(d: DataFrame, to: str) -> DataFrame:
        words = d.select("doc_id", F.explode(F.filter(F.split(F.lower("title"), r"\s+"), lambda w: w != "")).alias("w")).withColumn("h", F.md5(F.col("w").cast("binary")))
        k = (F.conv(F.substring("h", 1, 2), 16, 10).cast("int") % DIMENSIONS).alias("k")
        return words.groupBy("doc_id", k).agg(F.sum(F.when(F.substring("h", 3, 1) >= "8", 1).otherwise(-1)).alias(to))

    both = sums(original, "x").join(sums(result, "y"), ["doc_id", "k"], "full").na.fill(0)
    g = both.groupBy("doc_id").agg(F.sum(F.col("x") * F.col("y")).alias("dot"), F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("y") * F.col("y")).alias("yy"))
    cosine = F.try_divide(F.col("dot"), F.sqrt("xx") * F.sqrt("yy"))
    return g.select("doc_id", F.greatest(F.lit(0.0), F.coalesce(cosine, F.lit(0.0))).alias("semantic"))


def overall_similarity(original: DataFrame, result: DataFrame) -> DataFrame:
    """(doc_id, structural, semantic, overall) of two heading lists."""
    both = structural_similarity(original, result).join(semantic_similarity(original, result), "doc_id", "left").na.fill(0.0)
    return both.select("doc_id", F.col("similarity").alias("structural"), "semantic", (F.col("similarity") * STRUCTURE + F.col("semantic") * MEANING).alias("overall"))


def comparison_issues(matches: DataFrame, counts: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(doc_id, issues) from matches and (doc_id, n1, n2, overall)."""
    m = matches.groupBy("doc_id").agg(
        F.count_if(F.col("match_type") == "missing").alias("missing"),
        F.count_if(~F.col("level_match") & (F.col("match_type") != "missing")).alias("levels"),
        F.count_if(F.col("match_type") == "approximate").alias("approximate"),
    )
    j = counts.join(m, "doc_id", "left").na.fill(0)
    say = lambda c, text: F.when(c, text)
    issues = F.array_compact(
        F.array(
            say(F.col("overall") < threshold, "low similarity"),
            say(F.col("missing") > 0, "missing headings"),
            say(F.col("levels") > 0, "levels differ"),
            say(F.abs(F.col("n1") - F.col("n2")) > F.col("n1") * 0.1, "counts differ"),
            say(F.col("approximate") > F.col("n1") * 0.2, "approximate matches"),
        )
    )
    return j.select("doc_id", "missing", "levels", "approximate", issues.alias("issues"))


# Tables


def table_validity(rows: Column, least_rows: int = 2, least_columns: int = 2, most_empty: float = 0.5) -> Column:
    """Whether ``array<array<string>>`` has enough rows, columns and filled cells."""
    columns = F.array_max(F.transform(rows, F.size))
    empty = F.aggregate(rows, F.lit(0), lambda n, r: n + F.size(F.filter(r, lambda c: c.isNull())))
    return F.coalesce((F.size(rows) >= least_rows) & (columns >= least_columns) & (empty / (F.size(rows) * columns) <= most_empty), F.lit(False))


def table_quality(rows: Column) -> Column:
    """Between 0 and 1: size, filled cells, a head, variety of columns."""
    n, columns = F.size(rows), F.array_max(F.transform(rows, F.size))
    empty = F.aggregate(rows, F.lit(0), lambda k, r: k + F.size(F.filter(r, lambda c: c.isNull())))
    head = F.exists(F.get(rows, F.lit(0)), lambda c: c.isNotNull())
    kinds = F.transform(F.sequence(F.lit(0), columns - 1), lambda i: F.size(F.array_distinct(F.filter(F.transform(rows, lambda r: F.get(r, i)), lambda c: c.isNotNull()))))
    variety = F.aggregate(kinds, F.lit(0), lambda a, k: a + k) / columns
    bonus = lambda c: F.when(c, 0.1).otherwise(0.0)
    score = 0.5 + bonus(n >= 3) + bonus(columns >= 3) - empty / (n * columns) * 0.3 + bonus(head) + bonus(variety > 1)
    return F.when(n > 0, clamp(score, 0.0, 1.0)).otherwise(0.0)


def dedup_tables(tables: DataFrame) -> DataFrame:
    """Tables (doc_id, page, seq, engine, rows, columns, quality_score) of each page without those like a better one.

    By falling quality, a table within one row and one column of a kept one falls out; the best is relabelled hybrid.
    Pages that only one engine read stay as they are.
    """
    kind = "array<struct<quality:double,seq:int,engine:string,rows:int,columns:int>>"
    entry = F.struct((-F.col("quality_score")).alias("quality"), F.col("seq").cast("int").alias("seq"), "engine", F.col("rows").cast("int").alias("rows"), F.col("columns").cast("int").alias("columns"))
    pages = tables.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(entry)).cast(kind).alias("all"), F.count_distinct("engine").alias("engines"))
    like = lambda a, b: (F.abs(a["rows"] - b["rows"]) <= 1) & (F.abs(a["columns"] - b["columns"]) <= 1)
    kept = F.aggregate("all", F.array().cast(kind), lambda out, t: F.when(F.exists(out, lambda k: like(k, t)), out).otherwise(F.concat(out, F.array(t))))
    one = pages.select("doc_id", "page", "engines", F.posexplode(F.when(F.col("engines") > 1, kept).otherwise(F.col("all"))).alias("i", "t"))
    engine = F.when((F.col("i") == 0) & (F.col("engines") > 1), "hybrid").otherwise(F.col("t.engine"))
    return one.select("doc_id", "page", F.col("t.seq").alias("seq"), engine.alias("engine"), F.col("t.rows").alias("rows"), F.col("t.columns").alias("columns"), (-F.col("t.quality")).alias("quality_score"))


# Pages


def zip_pages(first: DataFrame, second: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages (doc_id, page, …) that both sides have, and one difference for each document whose counts differ."""
    pairs = first.join(second, ["doc_id", "page"])
    n = first.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n1")).join(second.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n2")), "doc_id", "full").na.fill(0)
    odd = n.where("n1 <> n2").select("doc_id", F.lit(0).alias("page"), F.lit("changed").alias("type"), F.lit("high").alias("severity"), F.lit(1.0).alias("confidence"))
    return pairs, odd


def visual_summary(diffs: DataFrame, ssim: DataFrame) -> DataFrame:
    """(doc_id, counts by type and severity, similarity): mean page likeness less the differences' weights."""
    kinds, severities = ("added", "removed", "changed"), ("low", "medium", "high", "critical")
    weight = F.when(F.col("severity") == "low", 0.01).when(F.col("severity") == "high", 0.1).when(F.col("severity") == "critical", 0.2).otherwise(0.05)
    counts = [F.count_if(F.col("type") == k).alias(f"n_{k}") for k in kinds] + [F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in severities]
    d = diffs.groupBy("doc_id").agg(*counts, F.sum(weight * F.col("confidence")).alias("penalty"))
    s = ssim.groupBy("doc_id").agg(F.avg("ssim").alias("ssim"))
    j = s.join(d, "doc_id", "full").na.fill(0)
    return j.withColumn("similarity", clamp(F.col("ssim") - F.col("penalty"), 0.0, 1.0))
