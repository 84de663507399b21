"""SQL names for the functions that queries may want: Pandas UDFs, and table functions over texts."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

#: Table functions in SQL, which the optimizer expands in place.
TABLE_FUNCTIONS = {
    "md_lines(t STRING) RETURNS TABLE (pos INT, line STRING)": "SELECT pos, col FROM (SELECT posexplode(split(coalesce(t, ''), '\\n')))",
    "chunks(t STRING, size INT, overlap INT) RETURNS TABLE (pos INT, chunk STRING)": (
        "SELECT pos, substring(t, col, size) FROM (SELECT posexplode(sequence(1, greatest(length(coalesce(t, '')), 1), greatest(size - overlap, 1))))"
    ),
}


_WORDS = "array_distinct(filter(split({0}, r'(?U)\\s+'), w -> w <> ''))"
_PAIRS = "array_distinct(flatten(transform(regexp_extract_all({0}, r'[\\x{{4e00}}-\\x{{9fff}}]+', 0), r -> CASE WHEN length(r) < 2 THEN array(r) ELSE transform(sequence(1, length(r) - 1), i -> substring(r, i, 2)) END)))"
_SHARE = "try_divide(size(array_intersect({0}, {1})), size(array_union({0}, {1})))"
_PARTS = (
    "1 - try_divide(levenshtein(a, b), greatest(length(a), length(b)))",
    f"coalesce({_SHARE.format(_WORDS.format('a'), _WORDS.format('b'))}, 1D)",
    "seq_ratio(a, b)",
    f"coalesce({_SHARE.format(_PAIRS.format('a'), _PAIRS.format('b'))}, 0D)",
)
#: As ``similarity.text_similarity``.
TEXT_SIMILARITY = (
    r"text_similarity(a STRING, b STRING) RETURNS DOUBLE RETURN CASE WHEN regexp_replace(a, r'(?U)\s+', '') = '' OR regexp_replace(b, r'(?U)\s+', '') = '' THEN 0D "
    rf"WHEN concat(a, b) RLIKE r'[\x{{4e00}}-\x{{9fff}}]' THEN ({_PARTS[0]}) * 0.3D + ({_PARTS[1]}) * 0.2D + ({_PARTS[2]}) * 0.3D + ({_PARTS[3]}) * 0.2D "
    f"ELSE ({_PARTS[0]}) * 0.4D + ({_PARTS[1]}) * 0.3D + ({_PARTS[2]}) * 0.3D END"
)


@udtf(returnType="id int, title string, level int, content string")
class MdSections:
    """Sections of a text by its heading lines, as ``markdown.sections`` has them."""

    def eval(self, text: str):
        text = text or ""
        found: list[tuple[str, int, list[str]]] = []
        for line in text[: -1 if text.endswith("\n") else None].split("\n") if text else ():
            bare = line.strip()
            if bare.startswith("#"):
                name = bare.lstrip("#")
                found.append((name.strip() or f"Section {len(found) + 1}", min(len(bare) - len(name), 6), []))
            elif found:
                found[-1][2].append(line)
            else:
                found.append(("Section 1", 1, [line]))
        for i, (title, level, body) in enumerate(found):
            yield i, title, level, "\n".join(body).strip()


def register(spark: SparkSession) -> None:
    """Makes seq_ratio, text_similarity, page_ssim, md_lines, chunks and md_sections known to SQL."""
    from docflow.operators import images, similarity

    spark.udf.register("seq_ratio", similarity.sequence_ratio)
    spark.udf.register("page_ssim", images.ssim)
    for head, body in TABLE_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {TEXT_SIMILARITY}")
    spark.udtf.register("md_sections", MdSections)
