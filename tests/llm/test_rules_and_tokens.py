"""Quality rules and byte-level BPE against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docflow.llm import byte_bpe, quality_rules, queries
from tests.compare import connect, same

HARD = [None, "", " \t\n", "one", "a b c d e a b c d e", "x " * 3000, "\n\na b\na b\n\r\na b", "#*$%&|<> " * 4, "é🎉\x0b\x0cß w", "w" * 100_000, ("k1 k2 k3 k4 k5 " * 2 + "z ") * 20]


def frame(spark, texts=HARD):
    rows = [(i if i % 5 else None, t, 1) for i, t in enumerate(texts)] + [(3, texts[3], 2), (3, texts[3], 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int")  # a clashing extra column


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)


def test_measures_by_brute_force(spark):
    df = frame(spark).select("doc_id", "text", "n_words", F.col("text").alias("T2"))
    got = quality_rules.quality_ledger(df, carry=("doc_id", "T2")).collect()
    assert len(got) == len(HARD) + 2
    for r in got:
        n, chars, symbols, dup, rep = brute(r.T2)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert bool(r.failed_bits & 1) == (n < 10) and bool(r.failed_bits & 2) == (100 * rep > 20 * n)


def test_query_equals_sql(spark, sf):
    same(queries.op1_quality_rules(spark, sf), connect(sf), quality_rules.ORACLE)


def test_policies_and_ablation(spark, sf):
    ledger = quality_rules.quality_ledger(spark.read.parquet(f"{sf}/documents.parquet")).persist()
    kept = {p: quality_rules.apply_policy(ledger, p).where("kept").count() for p in quality_rules.POLICIES}
    assert kept["base"] >= kept["v1"] >= kept["v2"] > 0
    rows = ledger.select("failed_bits").collect()
    m = quality_rules.mask("v2")
    for r in quality_rules.ablation(ledger, "v2").collect():
        bit = 1 << [x.name for x in quality_rules.RULES].index(r.rule)
        assert r.n_fail == sum(bool(x.failed_bits & bit) for x in rows)
        assert r.n_kept_without == sum(not x.failed_bits & m & ~bit for x in rows)
        assert r.n_fail_alone == sum(x.failed_bits & m == bit for x in rows)


def test_filter_keeps_rows_as_they_are(spark):
    df = frame(spark)
    kept = quality_rules.keep_quality(df)
    assert kept.columns == df.columns
    assert quality_rules.keep_quality(df.limit(0)).count() == 0 and quality_rules.quality_ledger(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    path, pattern = byte_bpe.default_vocabulary()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})


def test_every_vocabulary_entry_is_reached_by_merges():
    path, pattern = byte_bpe.default_vocabulary()
    b = byte_bpe.ByteBpe(path, pattern)
    pieces = b.model.encode([r.decode("latin-1").translate(b.table) for r in b.ranks], out_type=int, num_threads=1)
    assert all([b.order[i - 1] for i in p] == [rank] for p, rank in zip(pieces, b.ranks.values(), strict=True))


def test_ids_equal_the_library_and_round_trip(spark, sf, reference):
    rng = random.Random(5)
    odd = "".join(chr(rng.choice((rng.randrange(1, 128), rng.randrange(0x80, 0x3000), rng.randrange(0x1F300, 0x1F700)))) for _ in range(4000))
    df = frame(spark, [*HARD, odd, "don't I'LL  <|endoftext|>\n\n 12 345"])
    rows = df.select("text").collect()
    ids = [r.token_ids for r in byte_bpe.encode(df, carry=()).collect()]
    assert sorted(ids) == sorted(reference.encode_ordinary(r.text or "") for r in rows)
    back = byte_bpe.decode(byte_bpe.encode(df, carry=("text",)), carry=("text",))
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in queries.op2_byte_bpe(spark, sf).collect():
        want = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert byte_bpe.digests(df.limit(0)).count() == 0
