"""Fill-in-the-middle against a plain rule over code points, an exact round trip and SQL."""

import hashlib
import random
import re

import pytest

from docflow.llm import fill_middle
from tests.compare import connect, same

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(tokens) + 1) for x in h[:2])
    pre, mid, suf = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(tokens), "plain", None, None, text
    form = "spm" if h[3] % 100 < 80 else "psm"
    return len(tokens), form, len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}" if form == "psm" else f"<S>{suf}<P>{pre}<M>{mid}"


def texts(rng):
    odd = ["", None, " ", "\n\t ", "a", " a", "a ", "é 🎉\x0b\x0cß", "\x85 \xa0 x", "<P>", "a<", "S> <M", "x <M> y", "<S", ">P>", "<<P", "p" * 200_000, "w x\n" * 50_000]
    parts = ["a", "Z", " ", "\n", "\t", "é", "世", "🎉", "<", ">", "P", "S", "M", "<P", "M>"]
    return odd + ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(400)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    found = list(enumerate(texts(rng)))
    return [*found, (None, "null id and words"), (7, found[7][1]), (7, found[7][1])]


@pytest.mark.parametrize("piece", [fill_middle.PIECE, 100])
def test_every_row_equals_the_rule(spark, rows, piece, monkeypatch):
    monkeypatch.setattr(fill_middle, "PIECE", piece)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, output string, form int")
    done = fill_middle.transform(df)
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in done.collect()), key=repr)
    assert got == sorted(((i, *brute(i, t)) for i, t in rows), key=repr)
    assert {"plain", "psm", "spm"} == {r[2] for r in got}
    back = fill_middle.restore(done, carry=("doc_id", "form"))
    assert sorted(((r.doc_id, r.restored) for r in back.collect()), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)


def test_rates_and_seed(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.form for r in fill_middle.transform(df, rate=0).collect()} == {"plain"}
    assert {r.form for r in fill_middle.transform(df, rate=100, spm_rate=0).collect()} == {"plain", "psm"}
    assert fill_middle.transform(df, seed=1).exceptAll(fill_middle.transform(df)).count() > 100


def test_query_equals_sql(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    same(fill_middle.query(docs), connect(sf), fill_middle.ORACLE)
    assert fill_middle.query(docs.limit(0)).count() == 0
