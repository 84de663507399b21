"""Pieces of DuckDB SQL for the oracles."""

from __future__ import annotations

from collections.abc import Iterable

from docflow.sources.md_docs import MD_CTE

CJK = r"[\x{4e00}-\x{9fff}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def count(t: str, pattern: str, flags: str = "(?m)") -> str:
    return f"len(regexp_extract_all({t}, {q(flags + pattern)}))::bigint"


def strip(t: str) -> str:
    return rf"regexp_replace({t}, '^\s+|\s+$', '', 'g')"


def rstrip(t: str) -> str:
    return rf"regexp_replace({t}, '\s+$', '')"


def lines(t: str) -> str:
    return f"string_split({t}, chr(10))"


def map_lines(t: str, body: str) -> str:
    """``body`` reads a line as x."""
    return f"array_to_string(list_transform({lines(t)}, lambda x: {body}), chr(10))"


def replace(t: str, pairs: Iterable[tuple[str, str]]) -> str:
    for a, b in pairs:
        t = f"replace({t}, {q(a)}, {q(b)})"
    return t


def occurrences(t: str, terms: Iterable[str]) -> str:
    return "(" + " + ".join(f"(length({t}) - length(replace({t}, {q(x)}, ''))) // {len(x)}" for x in terms) + ")::bigint"


def present(t: str, terms: Iterable[str]) -> str:
    return "(" + " + ".join(f"contains(lower({t}), {q(x.lower())})::int" for x in terms) + ")::bigint"


def clean_breaks(t: str) -> str:
    return rf"regexp_replace({t}, '\n\s*\n\s*\n+', chr(10) || chr(10), 'g')"


def repetition(t: str) -> str:
    ls = f"list_filter(list_transform({lines(t)}, lambda x: {strip('x')}), lambda x: x <> '')"
    return f"(1 - len(list_distinct({ls}))::double / greatest(len({lines(t)}), 1))"


def features(t: str, prefix: str = "") -> str:
    """Select list of a document's counts."""
    found = {
        "chars": f"length({t})",
        "cjk": count(t, CJK, ""),
        "headings": count(t, r"^#+\s"),
        "table_lines": count(t, r"\|.*\|"),
        "table_rows": count(t, r"^\|.*\|$"),
        "separators": count(t, r"^\|[\s\-:|]+\|$"),
        "lists": count(t, r"^[\-\*\+]\s+"),
        "fences": count(t, "```", ""),
        "code_blocks": count(t, r"```[\s\S]*?```", ""),
        "empty_sections": count(t, r"^#+\s+.*\n\s*\n\s*#+"),
        "bad_headings": count(t, r"^#{7,}"),
        "empty_links": count(t, r"\]\(\s*\)", ""),
        "empty_items": count(t, r"^\s*[\-\*\+]\s*$"),
        "titles": count(t, r"^#\s+"),
        "repetition": repetition(t),
    }
    return ", ".join(f"{v} AS {prefix}{k}" for k, v in found.items())


def over_md(select: str, more: str = "", source: str = "md_docs") -> str:
    return f"WITH {MD_CTE}{more} SELECT {select} FROM {source}"
