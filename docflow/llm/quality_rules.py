"""Quality rules as a bitmask ledger: every rule is evaluated once, policies are masks over the stored bits.

``quality_ledger`` measures each document and stores one bit for each rule that it fails; ``apply_policy`` reads
the bits under a versioned policy; ``ablation`` counts, from one aggregation over the bits, what each rule
rejects alone and what a policy would keep without it. Only DataFrame functions run, without any shuffle
for ledger and policy; the ablation aggregates at most 2**(number of rules) distinct masks.

Defined results: null text counts as empty (no words, so it fails ``few_words``); repeated rows are each
measured; rows of any length are measured whole; an empty table gives an empty ledger; columns of the input
other than the two named do not matter, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import WORD, WORD_BREAK, let, where_settled, words_of

WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A document fails the rule where ``fails`` (SQL over the measurements) holds."""

    name: str
    fails: str


#: The order is the order of bits and is only ever appended to, so stored ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
)

#: Versioned policies: the rules that reject.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "repeated_lines"),
    "v2": ("few_words", "repeated_windows", "symbols", "repeated_lines", "short_words", "long_words"),
}


def mask(policy: str) -> int:
    """The bits of a policy's rules."""
    return sum(1 << i for i, r in enumerate(RULES) if r.name in POLICIES[policy])


def _repeat_words(windows: Column) -> Column:
    """Words in windows that occur again in the text, from the windows' hashes by position.

    Equal windows meet by sorting (hash, position); 64-bit hashes of one text's windows stand for the windows.
    """
    by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        same = lambda e, k: (k >= 0) & (k < F.size(s)) & (F.get(s, k)["h"] == e["h"])
        return F.sort_array(F.transform(F.filter(s, lambda e, k: same(e, k - 1) | same(e, k + 1)), lambda e: e["i"]))

    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    step = lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + F.least(F.lit(WINDOW), i + WINDOW - a["end"])).alias("n"))
    return F.aggregate(let(by_hash, repeated), start, step, lambda a: a["n"])


def measured(df: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The measurements of each row as longs, after the columns in ``carry``.

    n_words, word_chars (code points in words), n_symbols, n_lines (lines with a word), n_dup_lines (such lines
    equal to an earlier one), n_repeat_words (words in 5-word windows found twice or more, the first included).
    """
    own = df.select(*(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    kept = [f"_c{i}" for i in range(len(carry))]
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD))
    own = own.select(*kept, words_of(F.col("_text")).alias("_words"), lines.alias("_lines"), F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).alias("_symbols"))
    at = lambda i: F.xxhash64(*(F.get(F.col("_words"), i + j) for j in range(WINDOW)))
    windows = F.when(F.size("_words") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("_words") - WINDOW), at)).otherwise(F.array().cast("array<bigint>"))
    own = own.select(
        *kept,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.col("_symbols").cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("_windows"),
    )
    repeats = F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), _repeat_words(F.col("_windows"))).otherwise(F.lit(0))
    return own.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)), *(c for c in MEASURES if c != "n_repeat_words"), repeats.cast("long").alias("n_repeat_words"))


def failed_bits() -> Column:
    """One bit for each rule that the measurements fail."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(RULES)]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return total.cast("long")


def quality_ledger(df: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ledger: ``carry``, the measurements and ``failed_bits``."""
    return measured(df, text_col, carry).withColumn("failed_bits", failed_bits())


def apply_policy(ledger: DataFrame, policy: str = "v2") -> DataFrame:
    """``base_failed`` and ``kept`` (false if a rule of the base or the policy failed) from the stored bits."""
    base = (F.col("failed_bits").bitwiseAND(F.lit(mask("base")))) != 0
    rejected = (F.col("failed_bits").bitwiseAND(F.lit(mask(policy)))) != 0
    return ledger.withColumn("base_failed", base).withColumn("kept", ~base & ~rejected)


def ablation(ledger: DataFrame, policy: str = "v2") -> DataFrame:
    """For each rule of the policy: how many fail it, fail it alone, and how many stay without it.

    One aggregation by the masked bits, then sums over at most 2**(number of rules) rows.
    """
    masks = ledger.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask(policy))).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    bit = {r.name: 1 << i for i, r in enumerate(RULES)}
    rows = []
    for name in POLICIES[policy]:
        on = F.col("bits").bitwiseAND(F.lit(bit[name])) != 0
        rest = F.col("bits").bitwiseAND(F.lit(mask(policy) & ~bit[name])) == 0
        total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
        rows.append(F.struct(F.lit(name).alias("rule"), total(on).alias("n_fail"), total(on & rest).alias("n_fail_alone"), total(rest).alias("n_kept_without")))
    return masks.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def keep_quality(df: DataFrame, policy: str = "v2", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that the policy keeps, with their own columns only."""
    packed = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), F.col(f"`{text_col}`").alias("_t"))
    return where_settled(apply_policy(quality_ledger(packed, "_t", ("_row",)), policy), "kept").select("_row.*")


#: DuckDB SQL for the ledger of ``documents`` under policy v2.
ORACLE = rf"""
with d as (select doc_id, coalesce(text, '') as text from documents),
w as (select doc_id, row_number() over () as r, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
pos as (select r, unnest(range(1, len(ws) - {WINDOW - 2})) as i from w where len(ws) >= {WINDOW}),
win as (select pos.r, i, list_slice(ws, i, i + {WINDOW - 1}) as g from pos join w using (r)),
rep as (select r, i from win qualify count(*) over (partition by r, g) > 1),
cov as (select r, count(distinct i + j) as n from rep, (select unnest(range({WINDOW})) as j) group by r),
m as (select doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, len(ls)::bigint as n_lines,
        (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(cov.n, 0)::bigint as n_repeat_words
      from w left join cov using (r)),
b as (select *, (case when n_words < 10 then 1 else 0 end + case when 100 * n_repeat_words > 20 * n_words then 2 else 0 end
        + case when 100 * n_symbols > 10 * n_words then 4 else 0 end + case when 100 * n_dup_lines > 50 * n_lines then 8 else 0 end
        + case when word_chars < 2 * n_words then 16 else 0 end + case when word_chars > 15 * n_words then 32 else 0 end)::bigint as failed_bits from m)
select doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, failed_bits,
  (failed_bits & 3) <> 0 as base_failed, failed_bits = 0 as kept from b
"""

__all__ = ["MEASURES", "ORACLE", "POLICIES", "RULES", "WORD_BREAK", "Rule", "ablation", "apply_policy", "keep_quality", "mask", "measured", "quality_ledger"]
