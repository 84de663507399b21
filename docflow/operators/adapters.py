"""External models and programs behind small interfaces, with stand-ins that run anywhere.

An adapter runs on executors through Arrow batches, pandas or a Pandas UDF; it is made once for each worker process.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


class TextModel(Protocol):
    """Answers a prompt; raises on failure."""

    def __call__(self, prompt: str) -> str: ...


class Extractor(Protocol):
    """Reads a file's bytes into title, Markdown and raw text."""

    def __call__(self, content: bytes) -> dict[str, str]: ...


@dataclass(frozen=True)
class EchoModel:
    """Answers with the prompt."""

    def __call__(self, prompt: str) -> str:
        return prompt


@dataclass(frozen=True)
class DictionaryModel:
    """Answers with the prompt after ordered substitutions."""

    pairs: tuple[tuple[str, str], ...]

    def __call__(self, prompt: str) -> str:
        for a, b in self.pairs:
            prompt = prompt.replace(a, b)
        return prompt


@dataclass(frozen=True)
class TextExtractor:
    """Reads bytes as UTF-8 text; the first line is the title."""

    def __call__(self, content: bytes) -> dict[str, str]:
        text = content.decode("utf-8", "replace")
        return {"title": text.split("\n", 1)[0].lstrip("# ").strip(), "markdown_content": text, "raw_text": text}


#: Bytes of Arrow data that become Python objects at a time, whatever the size of Spark's batches.
PIECE = 4 << 20


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches halved until a piece has at most ``PIECE`` bytes or one row, so that what a worker holds does not follow a batch."""
    for batch in batches:
        parts = [batch]
        while parts:
            part = parts.pop()
            half = part.num_rows // 2
            if half and part.nbytes > PIECE:
                parts += [part.slice(half), part.slice(0, half)]
            elif part.num_rows:
                yield part


def in_pieces(rows: DataFrame, work: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``rows.mapInPandas(work, schema)`` by pieces; ``work`` yields one frame or more for each, in the schema's columns."""
    kinds = pa.schema([(f.name, f.type) for f in to_arrow_schema(StructType.fromDDL(schema))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in work(piece.to_pandas() for piece in pieces(batches)):
            yield from pa.Table.from_pandas(out, kinds, preserve_index=False).to_batches()

    return rows.mapInArrow(run, schema)


ANSWER = "ok boolean, text string, error string, attempts int"


def answered(prompts: DataFrame, make: Callable[[], TextModel], prompt_col: str = "prompt", key_col: str = "key", attempts: int = 3) -> DataFrame:
    """(key, ok, text, error, attempts) for every different prompt: each is asked once, up to ``attempts`` times if it fails or answers nothing."""
    asked = prompts.select(F.col(prompt_col).alias("prompt")).distinct().withColumn("key", F.sha2("prompt", 256))

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for part in parts:
            rows = []
            for key, prompt in zip(part["key"], part["prompt"], strict=True):
                text, error, n = None, None, 0
                while n < attempts and not text:
                    n += 1
                    try:
                        text, error = (model(prompt) or "").strip(), None
                    except Exception as e:  # noqa: BLE001  any failure of a foreign model is an answer's error
                        error = f"{type(e).__name__}: {e}"
                rows.append((key, bool(text), text or None, error or (None if text else "empty answer"), n))
            yield pd.DataFrame(rows, columns=["key", "ok", "text", "error", "attempts"])

    return in_pieces(asked.select("key", "prompt"), work, f"key string, {ANSWER}").withColumnRenamed("key", key_col)


def with_answers(rows: DataFrame, answers: DataFrame, prompt_col: str = "prompt", key_col: str = "key") -> DataFrame:
    """``rows`` with the struct ``answer``; earlier answers serve as a cache, by the prompt's hash."""
    keyed = rows.withColumn(key_col, F.sha2(prompt_col, 256))
    packed = answers.select(key_col, F.struct("ok", "text", "error", "attempts").alias("answer"))
    return keyed.join(packed, key_col, "left").drop(key_col)


def unanswered(rows: DataFrame, cache: DataFrame, prompt_col: str = "prompt", key_col: str = "key") -> DataFrame:
    """Rows whose prompt the cache lacks."""
    return rows.withColumn(key_col, F.sha2(prompt_col, 256)).join(cache.select(key_col), key_col, "left_anti").drop(key_col)


def within_budget(answers: DataFrame, by: str) -> DataFrame:
    """(by, ok): whether at most half of a document's pieces (one at least) failed."""
    g = answers.groupBy(by).agg(F.count_if(~F.col("answer.ok")).alias("failed"), F.count(F.lit(1)).alias("n"))
    return g.select(by, (F.col("failed") <= F.greatest(F.lit(1), F.floor(F.col("n") / 2))).alias("within_budget"))


def extracted(files: DataFrame, make: Callable[[], Extractor]) -> DataFrame:
    """(path, title, markdown_content, raw_text, error) of files (path, content)."""

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = make()
        for part in parts:
            rows = []
            for path, content in zip(part["path"], part["content"], strict=True):
                try:
                    d = read(bytes(content))
                    rows.append((path, d.get("title"), d.get("markdown_content"), d.get("raw_text"), None))
                except Exception as e:  # noqa: BLE001  a file that can't be read is a row with a reason
                    rows.append((path, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "title", "markdown_content", "raw_text", "error"])

    return in_pieces(files.select("path", "content"), work, "path string, title string, markdown_content string, raw_text string, error string")


def extracted_with_fallback(files: DataFrame, first: Callable[[], Extractor], second: Callable[[], Extractor]) -> DataFrame:
    """Like ``extracted``; files that the first reader finds empty go to the second."""
    one = extracted(files, first).persist()
    empty = F.coalesce(F.trim("markdown_content"), F.lit("")).eqNullSafe("") & F.coalesce(F.trim("raw_text"), F.lit("")).eqNullSafe("")
    again = files.join(one.where(empty).select("path"), "path", "left_semi")
    return one.where(~empty).unionByName(extracted(again, second))


def hash_embedding(text: str, size: int = 32) -> list[float]:
    """A stand-in for sentence vectors: word hashes folded into ``size`` signed counts."""
    out = [0.0] * size
    for word in text.lower().split():
        h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big")
        out[h % size] += 1.0 if h >> 63 else -1.0
    return out


#: What readers of files give: pages as images, tables with their cells, and facts about a file.
PAGE_IMAGES = "page int, width int, height int, image binary"
TABLES = "page int, seq int, engine string, confidence double, cells array<array<string>>"
FILE_INFO = "pages int, title string, has_text boolean, size long"


def per_file(files: DataFrame, make: Callable[[], Callable[[bytes], list[tuple]]], schema: str) -> DataFrame:
    """(path, …schema, error): the rows that a reader gives for each file (path, content); a file it fails on is one row with the error.

    Page renderers, table extractors, PDF writers and file inspectors are such readers.
    """
    names = [c.strip().split(" ")[0] for c in schema.split(",") if " " in c.strip()]

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = make()
        for part in parts:
            for path, content in zip(part["path"], part["content"], strict=True):
                try:
                    rows = [(path, *r, None) for r in read(bytes(content))]
                except Exception as e:  # noqa: BLE001  a file that can't be read is a row with a reason
                    rows = [(path, *[None] * len(names), f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=["path", *names, "error"]).astype(object)

    return files.select("path", "content").mapInPandas(work, f"path string, {schema}, error string")


def with_retry(files: DataFrame, make: Callable[[], Callable[[bytes], list[tuple]]], plainer: Callable[[], Callable[[bytes], list[tuple]]], schema: str) -> DataFrame:
    """Like ``per_file``; files that fail go to a plainer reader once."""
    first = per_file(files, make, schema).persist()
    again = files.join(first.where("error is not null").select("path").distinct(), "path", "left_semi")
    return first.where("error is null").unionByName(per_file(again, plainer, schema))
