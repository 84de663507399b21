"""Markdown as columns: counts, heading and table rules, clean-up, rendering. Nothing here shuffles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.functions import lexicon
from docflow.functions.rx import CJK, FENCE, ML, count, let, lines, map_lines, occurrences, replace_in_order, rstrip, strip

# Counts


def cjk_count(text: Column) -> Column:
    return count(text, CJK, "")


def heading_count(text: Column) -> Column:
    return count(text, r"^#+\s")


def table_line_count(text: Column) -> Column:
    return count(text, r"\|.*\|")


def table_row_count(text: Column) -> Column:
    return count(text, r"^\|.*\|$")


def list_count(text: Column) -> Column:
    return count(text, r"^[\-\*\+]\s+")


def fence_count(text: Column) -> Column:
    return count(text, FENCE)


def code_block_count(text: Column) -> Column:
    return count(text, r"```[\s\S]*?```")


def empty_section_count(text: Column) -> Column:
    return count(text, r"^#+\s+.*\n\s*\n\s*#+")


def repetition_ratio(text: Column) -> Column:
    """One less the share of different non-blank lines among all lines."""
    all_lines = lines(text)
    kinds = F.size(F.array_distinct(F.filter(F.transform(all_lines, strip), lambda x: x != "")))
    return 1 - kinds / F.greatest(F.size(all_lines), F.lit(1))


def fence_lines(text: Column) -> Column:
    return F.size(F.filter(lines(text), lambda x: strip(x).startswith(FENCE))).cast("long")


def features(text: Column) -> Column:
    """All counts of a document as one struct, for the scores to read."""
    return F.struct(
        F.length(text).cast("long").alias("chars"),
        cjk_count(text).alias("cjk"),
        heading_count(text).alias("headings"),
        table_line_count(text).alias("table_lines"),
        table_row_count(text).alias("table_rows"),
        count(text, r"^\|[\s\-:|]+\|$").alias("separators"),
        list_count(text).alias("lists"),
        fence_count(text).alias("fences"),
        code_block_count(text).alias("code_blocks"),
        empty_section_count(text).alias("empty_sections"),
        count(text, r"^#{7,}").alias("bad_headings"),
        count(text, r"]\(\s*\)").alias("empty_links"),
        count(text, r"^\s*[\-\*\+]\s*$").alias("empty_items"),
        count(text, r"^#\s+").alias("titles"),
        repetition_ratio(text).alias("repetition"),
    )


def valid_structure(text: Column, least_headings: int = 1) -> Column:
    """Null if the structure is sound, else the reason."""
    return F.when(heading_count(text) < least_headings, F.lit("too few headings")).when(fence_lines(text) % 2 == 1, F.lit("unclosed code fence"))


def close_fences(text: Column) -> Column:
    """An open code fence gets its end; a last line feed stays or comes with it."""
    open_ = fence_lines(text) % 2 == 1
    body = F.regexp_replace(text, r"\n\z", "")
    return F.when(open_, F.concat(body, F.lit("\n```\n"))).otherwise(text)


# Headings


def source_heading_level(line: Column) -> Column:
    """0 if the line is no heading, else its level by numbering."""
    hit = line.rlike("|".join(f"(?:{p})" for p in lexicon.HEADING_PATTERNS))
    chapter = F.contains(line, F.lit("第")) & F.contains(line, F.lit("章"))
    section = F.contains(line, F.lit("第")) & F.contains(line, F.lit("节"))
    level = F.when(chapter, 1).when(section, 2).when(line.rlike(lexicon.HEADING_PATTERNS[1]), 3).otherwise(2)
    return F.when(hit, level).otherwise(0)


def promote_headings(text: Column) -> Column:
    """Numbered lines become Markdown headings."""

    def promoted(line: Column) -> Column:
        bare = strip(line)
        level = source_heading_level(bare)
        return F.when((bare != "") & (level > 0) & ~bare.startswith("#"), F.concat(F.repeat(F.lit("#"), level), F.lit(" "), bare)).otherwise(line)

    return map_lines(text, promoted)


def is_text_heading(text: Column) -> Column:
    """Whether extracted text looks like a heading: by numbering, capitals or a colon at its end, within lengths."""
    t = strip(text)
    numbered = t.rlike("(?iuU)" + "|".join(f"(?:{p})" for p in lexicon.TEXT_HEADING_PATTERNS))
    capitals = (F.upper(t) == t) & (F.lower(t) != t) & (F.length(t) < 100)
    return F.length(t).between(5, 200) & (numbered | capitals | (t.endswith(":") & (F.length(t) < 150)))


def text_heading_level(text: Column) -> Column:
    t = strip(text)
    return F.when(t.rlike(r"^[IVX]{1,4}\.?\s+"), 1).when(t.rlike(r"^\d+\.?\s+"), 2).when(t.rlike(r"^\d+\.\d+\.?\s+"), 3).otherwise(2)


# Tables


def _cells(line: Column) -> Column:
    return F.size(F.filter(F.split(line, r"\|"), lambda c: strip(c) != ""))


def is_table_row(line: Column) -> Column:
    return F.contains(line, F.lit("|")) & (_cells(line) >= 2)


def _runs(all_lines: Column, starts: Column, body) -> Column:
    """``body(lines, last)`` of each run of lines: one begins at line 0 and at each of the sorted ``starts`` above 0."""
    n = F.size(all_lines)
    begins = F.concat(F.array(F.lit(0)), F.filter(starts, lambda i: i > 0))
    ends = F.concat(F.filter(starts, lambda i: i > 0), F.array(n))
    return F.zip_with(begins, ends, lambda a, b: body(F.slice(all_lines, a + 1, b - a), b == n))


def _where(all_lines: Column, test) -> Column:
    """The indices of the lines that pass."""
    return F.filter(F.transform(all_lines, lambda x, i: F.when(test(x), i)), lambda i: i.isNotNull())


def add_separators(text: Column) -> Column:
    """A separator after the first row of each table that has none; only a blank line ends a table, the last line gets none.

    Runs of lines end with their blank line, so the first row of a run is where a table starts.
    """

    def run(part: Column, last: Column) -> Column:
        def split_at(row: Column) -> Column:
            line, following = F.get(part, row - 1), F.get(part, row)
            add = (row > 0) & F.when(row < F.size(part), ~following.rlike(r"^\|[\s\-:|]+\|")).otherwise(~last)
            mark = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), _cells(line)))
            return F.when(add, F.concat(F.slice(part, F.lit(1), row), F.array(mark), F.slice(part, row + 1, F.size(part)))).otherwise(part)

        return let(F.array_position(F.transform(part, is_table_row), F.lit(True)).cast("int"), split_at)

    def runs(all_lines: Column) -> Column:
        after_blank = F.filter(F.transform(_where(all_lines, lambda x: strip(x) == ""), lambda i: i + 1), lambda i: i < F.size(all_lines))
        return F.array_join(F.flatten(let(after_blank, lambda s: _runs(all_lines, s, run))), "\n")

    return let(lines(text), runs)


def space_tables(text: Column) -> Column:
    """A blank line before each table row whose last line is not blank."""

    def spaced(each: Column) -> Column:
        def one(line: Column, before: Column) -> Column:
            bare = strip(line)
            row = bare.startswith("|") & (F.length(bare) - F.length(F.replace(bare, F.lit("|"), F.lit(""))) >= 2)
            kept = F.when(bare == "", F.lit("")).otherwise(line)
            return F.when(row & before.isNotNull() & (strip(before) != ""), F.concat(F.lit("\n"), kept)).otherwise(kept)

        before = F.concat(F.array(F.lit(None).cast("string")), F.slice(each, F.lit(1), F.size(each) - 1))
        return F.array_join(F.zip_with(each, before, one), "\n")

    return let(lines(text), spaced)


def render_table(rows: Column) -> Column:
    """Markdown of ``array<array<string>>``; the first row is the head."""
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r, strip), " | "), F.lit(" |"))
    mark = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), F.size(F.get(rows, F.lit(0)))))
    body = F.transform(F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0))), line)
    return F.when(F.size(rows) > 0, F.array_join(F.concat(F.array(line(F.get(rows, F.lit(0))), mark), body), "\n")).otherwise("")


# Whole documents


def annotate_terms(text: Column) -> Column:
    """Terms followed by their translation in parentheses, one term after the other."""
    return replace_in_order(text, [(a, f"{a} ({b})") for a, b in lexicon.PRESERVE_TERMS])


def clean_formatting(text: Column) -> Column:
    t = F.regexp_replace(text, rf"(?U)({CJK})\s+({CJK})", "$1$2")
    t = F.regexp_replace(t, rf"(?U)({CJK})\s*([，。；：！？])", "$1$2")
    t = F.regexp_replace(t, r"(?U)\n\s*\n\s*\n+", "\n\n")
    return strip(map_lines(t, rstrip))


def apply_source_rules(text: Column) -> Column:
    """Terms, headings, tables and formatting of source documents."""
    return clean_formatting(add_separators(promote_headings(annotate_terms(text))))


def finalize_formatting(text: Column) -> Column:
    """Blank lines around headings; addresses and hexadecimal numbers as code."""
    t = F.regexp_replace(strip(text), r"(?dU)(\n#+.*?)\n\n+", "$1\n\n")
    t = F.regexp_replace(t, r"(?dU)(#+\s+.*?)\n([^\n])", "$1\n\n$2")
    t = F.regexp_replace(t, r"(?U)\b(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})\b", "`$1`")
    return F.regexp_replace(t, r"(?U)\b(0x[0-9a-fA-F]+)\b", "`$1`")


def improve_structure(text: Column, title: Column, section_titles: Column) -> Column:
    """The title if there is none, spaced tables, and section titles that the text lacks."""
    head = F.when((strip(F.coalesce(title, F.lit(""))) != "") & ~text.rlike(rf"{ML}^#\s+(.+)"), F.concat(F.lit("# "), strip(title), F.lit("\n\n"))).otherwise("")
    body = F.concat(head, space_tables(text))
    missing = F.transform(F.filter(section_titles, lambda t: (t != "") & ~F.contains(body, t)), lambda t: F.concat(F.lit("\n\n## "), t, F.lit("\n")))
    return strip(F.concat(body, F.array_join(missing, "")))


def to_plain(text: Column) -> Column:
    """Text without heading marks, table lines and backticks; blank lines stay."""
    bare = F.transform(lines(F.regexp_replace(text, r"\n\z", "")), strip)
    unmarked = F.transform(bare, lambda x: F.when(x.startswith("#"), strip(F.regexp_replace(x, "^#+", ""))).otherwise(x))
    table = lambda x: (x.startswith("|") & x.endswith("|")) | x.rlike(r"^[|: -]+\z") | ((x == "") & F.lit(False))
    # A heading that is all marks is empty afterwards and, unlike a blank line, falls out with the separators.
    kept = F.filter(F.zip_with(bare, unmarked, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda x: (x["a"] == "") | ((x["b"] != "") & ~table(x["b"])))
    return strip(F.array_join(F.transform(kept, lambda x: F.replace(x["b"], F.lit("`"), F.lit(""))), "\n"))


def sections(text: Column) -> Column:
    """Sections by heading lines: array of (id, title, level, page, content). Text before the first heading is a section."""
    kind = "array<struct<id:int,title:string,level:int,page:int,content:string>>"

    def named(run: Column, last: Column) -> Column:
        first = strip(F.get(run, F.lit(0)))
        heading = first.startswith("#")
        title = F.when(heading, strip(F.regexp_replace(first, "^#+", ""))).otherwise("")
        level = F.when(heading, F.least(F.length(first) - F.length(F.regexp_replace(first, "^#+", "")), F.lit(6))).otherwise(1)
        body = F.when(heading, F.slice(run, F.lit(2), F.size(run))).otherwise(run)
        return F.struct(title.alias("title"), level.cast("int").alias("level"), strip(F.array_join(body, "\n")).alias("content"))

    found = let(lines(F.regexp_replace(text, r"\n\z", "")), lambda all_lines: let(_where(all_lines, lambda x: strip(x).startswith("#")), lambda s: _runs(all_lines, s, named)))
    auto = lambda s, i: F.when(s["title"] != "", s["title"]).otherwise(F.concat(F.lit("Section "), (i + 1).cast("string")))
    numbered = F.transform(found, lambda s, i: F.struct(i.cast("int").alias("id"), auto(s, i).alias("title"), s["level"].alias("level"), F.lit(1).alias("page"), s["content"].alias("content")))
    return F.when(text == "", F.array().cast(kind)).otherwise(numbered.cast(kind))


def build_markdown(found: Column) -> Column:
    """Markdown of sections (title, level, content)."""

    def piece(s: Column) -> Column:
        head = F.when(strip(s["title"]) != "", F.concat(F.repeat(F.lit("#"), F.least(F.greatest(s["level"], F.lit(1)), F.lit(6))), F.lit(" "), strip(s["title"]))).otherwise(F.lit(None))
        body = F.when(strip(s["content"]) != "", strip(s["content"]))
        return F.concat_ws("\n", head, body, F.lit(""))

    return strip(F.array_join(F.transform(found, piece), "\n"))


# Lines for translation


def complexity(text: Column) -> Column:
    """The kind of a text, by the first rule that fits."""
    t = strip(text)
    each = lines(t)
    table = F.filter(each, lambda x: strip(x).startswith("|"))
    pipes = F.array_max(F.transform(table, lambda x: F.length(x) - F.length(F.replace(x, F.lit("|"), F.lit("")))))
    return (
        F.when(t == "", "empty")
        .when(F.exists(each, lambda x: strip(x).startswith("#")), "header")
        .when(pipes > 6, "complex_table")
        .when(F.size(table) > 5, "table")
        .when(t.rlike(r"(?d)\d+[^\S\n]*(GB|MB|GHz|MHz|W|TB)"), "technical_specs")
        .when(t.rlike(r"(?iuU)\b(ipmitool|chassis|power|0x[0-9a-f]+)\b"), "commands")
        .when((F.size(each) > 3) & F.contains(t, F.lit("|")), "mixed")
        .otherwise("text")
    )


def batch_size(kind: Column) -> Column:
    sizes = F.create_map(*(x for k, n in lexicon.BATCH_SIZES for x in (F.lit(k), F.lit(n))))
    return F.coalesce(F.try_element_at(sizes, kind), F.lit(6))


def term_occurrences(text: Column) -> Column:
    return occurrences(text, [b for _, b in lexicon.PRESERVE_TERMS])
