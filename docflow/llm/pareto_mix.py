"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share of all words by weight, at most ``CAP`` times its size; the excess is shared again by
weight until no source is above. Within a source a document is due copies in proportion to its preference (a whole
number, by default ``LEAST`` and the binary digits of its size, so longer texts are taken somewhat more often), at most ``CAP``, such
that the words due add up to the target. Whole copies are certain; what is left, below 1, is the document's inclusion
probability. Documents are ranked by random odds divided by inclusion odds and taken in that order up to the
words that are missing. A document that would pass the mark is skipped and the gap filled, in order, by documents
that fit, in ``PASSES`` passes; at the end one skipped document is taken if that comes nearer.

The random number of a document comes from its id and text, so reruns agree and rows with the same id and text
share one fate.

Texts are read and ranked once, to rows of a source, a size and a rank. The plan has one row for each source and one for
each source and preference, found from sums: no source, however large, is sorted in one task; only the rows of the
one bin of a bin that the mark falls in are.

Defined results: null texts have size 0; null sources are one source, last in order; null ids are a value like
any other; repeated rows are taken together; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import WORD, stored, where_settled

CAP, PASSES, BINS, SEED = 3, 4, 4096, 42
#: Preference of a text without words; preferences are whole numbers up to ``MOST``, so a source has as many classes at most.
LEAST, MOST = 4, 1000
WEIGHTS = (1, 2, 3)
#: Sources up to this number (some 200 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_SOURCES = 20_000


def size_of(text: Column) -> Column:
    """Words of a text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def preference_of(size: Column) -> Column:
    """``LEAST`` and the binary digits of a size: 4 for none, 5 for 1, 14 for 1000 words."""
    return (F.length(F.bin(size)) + F.when(size > 0, LEAST).otherwise(LEAST - 1)).cast("long")


def uniform(id_: Column, text: Column, seed: int = SEED) -> Column:
    """A number strictly between 0 and 1 from id and text: 52 bits of an MD5."""
    key = F.concat_ws("|", F.lit(str(seed)), F.coalesce(id_.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return (F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _small(plan: DataFrame, n: int) -> DataFrame:
    return F.broadcast(plan) if n <= BROADCAST_SOURCES else plan.hint("merge")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size): shares by weight under the cap.

    Sources sorted by cap per weight are capped one after the other until the level of the rest lies below its caps.
    """
    ranked = sizes.selectExpr("source", "source_size", f"double({CAP}) * source_size as cap", f"element_at(array({', '.join(map(str, WEIGHTS))}), int((row_number() over (order by source asc nulls last) - 1) % {len(WEIGHTS)}) + 1) as weight")
    steps = ranked.selectExpr(
        "*",
        "row_number() over (order by cap / weight, source asc nulls last) as k",
        "(sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, source asc nulls last rows between unbounded preceding and 1 preceding), 0)) "
        "/ sum(weight) over (order by cap / weight, source asc nulls last rows between current row and unbounded following) as at",
    )
    level = steps.selectExpr("*", "min(if(at <= cap / weight, struct(k, at), null)) over () as level")
    return level.selectExpr("source", "source_size", "least(cap, level.at * weight) as target")


def shares(classes: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, preference, whole, f) from (source, preference, words) and targets: certain copies and inclusion probability.

    Copies due are ``least(CAP, level * preference)``. Classes from the highest preference on are capped one after the other
    until the level of the rest lies below the cap.
    """
    goal = goals.select(F.col("source").alias("_s"), "target")
    rows = classes.where("words > 0").join(goal, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    steps = rows.selectExpr(
        "*",
        "row_number() over (partition by source order by preference desc) as k",
        f"(target - {CAP} * coalesce(sum(words) over (partition by source order by preference desc rows between unbounded preceding and 1 preceding), 0)) "
        "/ sum(words * preference) over (partition by source order by preference desc rows between current row and unbounded following) as at",
    )
    level = steps.selectExpr("*", f"min(if(at * preference <= {CAP} * (1 + 1e-12), struct(k, at), null)) over (partition by source) as level")
    due = level.selectExpr("source", "preference", f"least(double({CAP}), greatest(level.at, 0) * preference) as due")
    return due.selectExpr("source", "preference", "cast(floor(due) as int) as whole", "due - floor(due) as f")


def _with_shares(rows: DataFrame, parts: DataFrame, n: int) -> DataFrame:
    """Rows with whole copies, inclusion probability, and q, which ranks between 0 and 1: odds ratio r as r / (1 + r)."""
    own = parts.select(F.col("source").alias("_s"), F.col("preference").alias("_p"), "whole", "f")
    joined = rows.join(_small(own, n), F.col("source").eqNullSafe(F.col("_s")) & (F.col("preference") == F.col("_p")), "left").drop("_s", "_p").na.fill({"whole": 0, "f": 0.0})
    ratio = (F.col("u") / (1 - F.col("u"))) / (F.col("f") / (1 - F.col("f")))
    return joined.withColumn("q", F.when(F.col("f") > 0, ratio / (1 + ratio)).otherwise(F.lit(1.0)))


def _planned(rows: DataFrame, plan: DataFrame, n: int) -> DataFrame:
    return rows.join(_small(plan.withColumnRenamed("source", "_s"), n), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")


def _fits(k: int) -> Column:
    """Whether pass k looks at a ranked row: the first at all, the others at those after the last mark that the gap holds."""
    return (F.col("f") > 0) & (F.col("size") <= F.col(f"gap{k}")) & (F.col("q") > F.col(f"mark{k - 1}")) if k else F.col("f") > 0


def make_plan(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The plan from (source, size, u, preference) rows, both stored: by source the target, marks and gaps of each pass and the pass whose mark is taken too; by class ``shares``."""
    rows = stored(rows.select("source", "size", "u", "preference"), "sized")
    classes = stored(rows.groupBy("source", "preference").agg(F.sum("size").alias("words")), "classes")
    sizes = stored(classes.groupBy("source").agg(F.sum("words").alias("source_size")), "sizes")
    n = sizes.count()
    goals = stored(targets(sizes), "goals")
    parts = stored(shares(classes, goals), "shares")
    n_parts = parts.count()
    certain = classes.join(parts.select(F.col("source").alias("_s"), F.col("preference").alias("_p"), "whole"), F.col("source").eqNullSafe(F.col("_s")) & (F.col("preference") == F.col("_p")))
    certain = certain.groupBy(F.col("source").alias("_s")).agg(F.sum(F.col("words") * F.col("whole")).alias("certain"))
    plan = goals.join(certain, F.col("source").eqNullSafe(F.col("_s")), "left")
    plan = stored(plan.select("source", "source_size", "target", (F.col("target") - F.coalesce("certain", F.lit(0))).alias("gap0")), "plan")
    ranked = stored(_with_shares(rows, parts, n_parts).where("f > 0 and size > 0").select("source", "size", "f", "q"), "ranked")
    for k in range(PASSES):
        plan = stored(_with_mark(ranked, plan, k, n), "plan")
    left = F.col(f"gap{PASSES}")
    each = [F.when((F.col(f"group{k}") > 0) & (F.abs(left - F.col(f"group{k}")) < left), F.struct(F.abs(left - F.col(f"group{k}")).alias("d"), F.lit(k).alias("k"))) for k in range(PASSES)]
    return stored(plan.withColumn("extra", F.least(*each)["k"]), "plan"), parts


def _full(sums: DataFrame, bin_: str) -> DataFrame:
    """(_s, _b, before) of the first bin that passes the gap, from (source, bin, words, gap, before0): words before it."""
    upto = sums.withColumn("upto", F.col("before0") + F.expr(f"sum(words) over (partition by source order by {bin_})"))
    first = upto.where("upto > gap").groupBy("source").agg(F.min(F.struct(F.col(bin_).alias("b"), (F.col("upto") - F.col("words")).alias("before"))).alias("m"))
    return first.select(F.col("source").alias("_s"), F.col("m.b").alias("_b"), F.col("m.before").alias("_before"))


def _with_mark(ranked: DataFrame, plan: DataFrame, k: int, n: int) -> DataFrame:
    """Adds the rank ``mark{k}`` of the first rows that would pass the gap (2 if all fit), their words ``group{k}``, and the gap left."""
    place = F.col("q") * BINS
    fit = _planned(ranked, plan, n).where(_fits(k)).select(
        "source", "q", "size", F.col(f"gap{k}").alias("gap"), F.least(F.floor(place), F.lit(BINS - 1)).alias("bin"), F.least(F.floor((place - F.floor(place)) * BINS), F.lit(BINS - 1)).alias("fine")
    )
    sums = stored(fit.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("gap").alias("gap")).withColumn("before0", F.lit(0)), "bins")
    at = stored(_full(sums, "bin"), "bin")
    inside = fit.join(_small(at, n), fit["source"].eqNullSafe(at["_s"]) & (fit["bin"] == at["_b"])).drop("_s", "_b")
    fines = stored(inside.groupBy("source", "fine").agg(F.sum("size").alias("words"), F.first("gap").alias("gap"), F.first("_before").alias("before0")), "bins")
    then = stored(_full(fines, "fine"), "bin")
    edge = inside.drop("_before").join(_small(then, n), inside["source"].eqNullSafe(then["_s"]) & (inside["fine"] == then["_b"])).drop("_s", "_b")
    edge = edge.groupBy("source", "q").agg(F.sum("size").alias("words"), F.first("gap").alias("gap"), F.first("_before").alias("before"))
    edge = edge.withColumn("upto", F.col("before") + F.expr("sum(words) over (partition by source order by q)"))
    mark = edge.where("upto > gap").groupBy("source").agg(F.min(F.struct("q", "words", (F.col("upto") - F.col("words")).alias("taken"))).alias("m"))
    rest = sums.groupBy("source").agg(F.sum("words").alias("all"))
    found = rest.join(mark.withColumnRenamed("source", "_m"), F.col("source").eqNullSafe(F.col("_m")), "left").drop("_m").withColumnRenamed("source", "_s")
    out = plan.join(found, plan["source"].eqNullSafe(F.col("_s")), "left")
    taken = F.coalesce(F.col("m.taken"), F.col("all"), F.lit(0))
    return out.select(*plan.columns, F.coalesce("m.q", F.lit(2.0)).alias(f"mark{k}"), F.coalesce("m.words", F.lit(0)).alias(f"group{k}"), (F.col(f"gap{k}") - taken).alias(f"gap{k + 1}"))


def _picked() -> Column:
    taken = F.lit(False)
    for k in range(PASSES):
        taken = taken | (_fits(k) & (F.col("q") < F.col(f"mark{k}")))
        taken = taken | ((F.col("extra") == k) & _fits(k) & (F.col("q") == F.col(f"mark{k}")))
    return F.coalesce(taken, F.lit(False))


def sized(df: DataFrame, text_col: str, source_col: str, id_col: str, preference: Column | None, seed: int, keep: tuple[str, ...]) -> DataFrame:
    """(_row, source, size, u, preference) of each row; ``_row`` holds the columns in ``keep``."""
    text = F.col(f"`{text_col}`")
    own = [F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_row"), F.col(f"`{source_col}`").alias("source"), size_of(text).alias("size"), uniform(F.col(f"`{id_col}`"), text, seed).alias("u")]
    if preference is None:
        return df.select(*own).withColumn("preference", preference_of(F.col("size")))
    return df.select(*own, F.least(F.greatest(F.round(preference), F.lit(1)), F.lit(MOST)).cast("long").alias("preference"))


def with_copies(rows: DataFrame) -> DataFrame:
    """``sized`` rows with source_size, target and the ``copies`` that the mix takes."""
    plan, parts = make_plan(rows)
    due = _planned(_with_shares(rows, parts, parts.count()), plan, plan.count())
    return due.withColumn("copies", (F.col("whole") + _picked().cast("int")).cast("int"))


def mixed(df: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", preference: Column | None = None, seed: int = SEED) -> DataFrame:
    """Every row of ``df`` as ``_row`` with size, source, source_size, target and the ``copies`` that the mix takes.

    ``preference`` is a column of whole numbers from 1 to ``MOST`` (others count as the nearest).
    """
    return with_copies(sized(df, text_col, source_col, id_col, preference, seed, tuple(df.columns)))


def mix(df: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it."""
    return where_settled(mixed(df, text_col, source_col, id_col), "copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("_row.*")


def query(df: DataFrame) -> DataFrame:
    """The contract's columns, and the copies."""
    rows = stored(sized(df, "text", "source", "doc_id", None, SEED, ("doc_id",)), "rows")
    return with_copies(rows).select(F.col("_row.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), F.col("copies").cast("long").alias("copies"))


def _oracle() -> str:
    q = "(u / (1 - u)) / (f / (1 - f))"
    sql = f"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
    (('0x' || substr(md5('{SEED}|' || coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, ''))), 1, 13))::bigint::double + 0.5) / 4503599627370496.0 as u from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
r as (select *, {CAP}.0 * source_size as cap, 1 + (row_number() over (order by source asc nulls last) - 1) % 3 as weight from s),
st as (select *, row_number() over o as k,
    (sum(source_size) over ()::double - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0)::double)
    / (sum(weight) over (o rows between current row and unbounded following))::double as lev
    from r window o as (order by cap::double / weight, source asc nulls last)),
lv as (select arg_min(lev, k) as level from st where lev <= cap::double / weight),
t as (select source, source_size, least(cap::double, level * weight) as target from st, lv),
dp as (select *, case when size > 0 then length(bin(size)) + {LEAST} else {LEAST} end as preference from d),
cl as (select source, preference, sum(size)::bigint as words from dp group by all having sum(size) > 0),
cs as (select cl.*, target, row_number() over o as k,
    (target - {CAP} * coalesce(sum(words) over (o rows between unbounded preceding and 1 preceding), 0)::double)
    / (sum(words * preference) over (o rows between current row and unbounded following))::double as lev
    from cl join t on cl.source is not distinct from t.source window o as (partition by cl.source order by preference desc)),
lc as (select source, arg_min(lev, k) as level from cs where lev * preference <= {CAP} * (1 + 1e-12) group by source),
du as (select cs.source, preference, words, least({CAP}::double, greatest(level, 0) * preference) as due from cs join lc on cs.source is not distinct from lc.source),
sh as (select source, preference, words, floor(due) as whole, due - floor(due) as f from du),
p0 as (select t.source, source_size, target, target - coalesce(certain, 0) as gap from t left join (select source, sum(words * whole)::double as certain from sh group by source) c on t.source is not distinct from c.source),
x0 as (select dp.*, source_size, target, coalesce(whole, 0) as whole, coalesce(f, 0) as f, gap as gap0, -1.0::double as mark, false as picked, case when f > 0 then ({q}) / (1 + {q}) else 1.0 end as q
    from dp join p0 on dp.source is not distinct from p0.source left join sh on dp.source is not distinct from sh.source and dp.preference = sh.preference),
"""
    for k in range(PASSES):
        fits = f"(f > 0 and size <= gap{k} and q > mark)" if k else "(f > 0)"
        sql += f"""c{k} as (select *, sum(words) over (partition by source order by q) as upto from
    (select source, q, gap{k} as gap, sum(size) as words from x{k} where {fits} group by all)),
m{k} as (select source, coalesce(min(q) filter (where upto > gap), 2.0) as nm, coalesce(arg_min(words, q) filter (where upto > gap), 0) as grp,
    coalesce(arg_min(upto - words, q) filter (where upto > gap), sum(words)) as got from c{k} group by source),
x{k + 1} as (select x.* replace (picked or ({fits} and q < coalesce(nm, 2.0)) as picked, coalesce(nm, 2.0) as mark),
    gap{k} - coalesce(got, 0) as gap{k + 1}, coalesce(grp, 0) as group{k}, {fits} and q = coalesce(nm, 2.0) as on{k} from x{k} x left join m{k} m on x.source is not distinct from m.source),
"""
    near = lambda k: f"case when group{k} > 0 and abs(gap{PASSES} - group{k}) < gap{PASSES} then abs(gap{PASSES} - group{k}) else 'inf'::double end"
    nearest = f"least({', '.join(near(k) for k in range(PASSES))})"
    extra = " ".join(f"when {nearest} < 'inf'::double and {near(k)} = {nearest} then on{k}" for k in range(PASSES))
    return sql + f"fin as (select *, (picked or case {extra} else false end)::int as more from x{PASSES}) select doc_id, size, source_size, target, (size * (whole + more))::bigint as taken, (whole + more)::bigint as copies from fin"


#: DuckDB SQL for ``query(documents)``.
ORACLE = _oracle()
