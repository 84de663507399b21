r"""Personal data: exact patterns, and terms that disclose what they found by corpus co-occurrence.

Base spans are the leftmost non-overlapping matches of four patterns, checked afterwards. A value found is a protected
entity. Over whole documents the corpus gives the pointwise mutual information of word and entity; divided by the
entity's own information it says which part of the entity the word gives away (1: every document with the word has
the entity). Words from ``THRESHOLD`` on, seen with the entity in at least ``SUPPORT`` different texts, disclose it:
wherever such a word stands, in whatever text, it becomes a span of kind ``term``. Sanitising generalises it to the
longest of its first ``PREFIXES`` letters that discloses less than the threshold as a class of words, or removes it if
none does.

Only DataFrame functions run. Base spans need no shuffle. Statistics shuffle the words of those texts only that hold an
entity known from ``SUPPORT`` texts, and of these, before words meet entities, the ones that are rare enough to
reach the threshold with any of the text's entities; counts over all documents are kept to the words that remain. Words
that disclose go to the scan as literals up to ``LITERAL_WORDS``; more of them are joined.

The patterns are the contract's with possessive loops (the classes on both sides of each loop are disjoint, so no
match changes) and an anchor that forbids starting inside a run of the first class, unless the last match ended
there; a start inside a run could only match where the run's own start does. This keeps long runs linear, as do
folds that never copy what they have emitted.

Defined results: null texts are empty; repeated rows each get their spans and count as documents in the statistics,
while the support of a word counts different texts; words in an address are part of it and not terms; texts of any
length are searched whole; an empty table gives an empty result; other columns, whatever their names, do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.rx import emitted
from docflow.llm.common import let, stored, where_settled

KINDS = ("email", "ip", "card", "phone", "term")
LABELS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")
PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"\p{L}[\p{L}\p{M}]{2,}+"

#: Part of an entity's information from which a word is disclosing, and different texts in which both must be seen.
THRESHOLD, SUPPORT = 0.8, 3
#: Letters that a generalised word may keep, the most first.
PREFIXES = (4, 2)
#: Words up to this number (some 20 bytes each) are broadcast to a count; more are joined by shuffle. Words that the scan holds as literals.
BROADCAST_WORDS, LITERAL_WORDS = 200_000, 5_000

SPAN = "array<struct<start:int,ord:int,end:int,value:string>>"
ONE_SPAN = "struct<start:int,ord:int,end:int,value:string>"


def _none() -> Column:
    return F.array().cast(SPAN)


def _matches(text: Column, pattern: str, order: int, valid=None) -> Column:
    """The matches of a pattern as spans in code points; pieces between matches give the positions."""
    pieces = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0), lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("m")))

    def step(a: Column, x: Column) -> tuple[dict[str, Column], Column]:
        start = a["pos"] + x["gap"]
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        span = F.array(F.struct(start.alias("start"), F.lit(order).alias("ord"), end.alias("end"), x["m"].alias("value")))
        ok = x["m"].isNotNull() if valid is None else x["m"].isNotNull() & valid(x["m"])
        return {"pos": end}, F.when(ok, span).otherwise(_none())

    return emitted(pieces, {"pos": F.lit(0)}, ONE_SPAN, step)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    doubled = F.array(*(F.lit(2 * d - 9 * (d > 4)) for d in range(10)))

    def total(x: Column) -> Column:
        digit = lambda i: F.substring(x, F.length(x) - i + 1, F.lit(1)).cast("int")
        return F.aggregate(F.sequence(F.lit(1), F.length(x)), F.lit(0), lambda a, i: a + F.when(i % 2 == 0, F.element_at(doubled, digit(i) + 1)).otherwise(digit(i)))

    x = _digits(m)
    return F.when(F.length(x).between(12, 19), let(x, total) % 10 == 0).otherwise(False)


def base_spans(text: Column) -> Column:
    """All valid matches by start, then kind. ``text`` must not be null."""
    email = F.when(F.contains(text, F.lit("@")), _matches(text, EMAIL, 0)).otherwise(_none())
    ip = F.when(text.rlike(r"[0-9]\.[0-9]"), _matches(text, IP, 1, lambda m: m.rlike(rf"^{PART}(?:\.{PART}){{3}}$"))).otherwise(_none())
    card = F.when(text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), _matches(text, CARD, 2, _luhn)).otherwise(_none())
    phone = F.when(text.rlike(r"\+[0-9]"), _matches(text, PHONE, 3, lambda m: F.length(_digits(m)).between(9, 15))).otherwise(_none())
    return F.sort_array(F.concat(email, ip, card, phone))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["ord"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _masked(text: Column) -> Column:
    """The text with blanks in place of addresses, the only base spans that can hold letters."""
    blank = F.zip_with(F.split(text, EMAIL, -1), F.regexp_extract_all(text, F.lit(EMAIL), 0), lambda gap, m: F.concat(gap, F.repeat(F.lit(" "), F.coalesce(F.length(m), F.lit(0)))))
    return F.when(F.contains(text, F.lit("@")), F.array_join(blank, "")).otherwise(text)


def terms_of(text: Column) -> Column:
    """The different words of a text outside its addresses, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(_masked(text), F.lit(TERM), 0), F.lower))


def entities_of(spans: Column) -> Column:
    """The different entities of a text's spans: kind and value in lower case."""
    return F.array_distinct(F.transform(spans, lambda s: F.concat_ws(":", s["ord"].cast("string"), F.lower(s["value"]))))


def marked(df: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry``, the base ``spans``, and for rows that have any the text's ``digest``."""
    own = df.select(*(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    own = own.withColumn("spans", base_spans(F.col("_text")))
    return own.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)), "spans", F.when(F.size("spans") > 0, F.sha2("_text", 256)).alias("digest"))


def _part(total: Column, n: Column, n_term: Column, n_entity: Column) -> Column:
    return F.least(F.log2(total * n / (n_term * n_entity)) / F.log2(total / n_entity), F.lit(1.0))


def _said(df: DataFrame, text_col: str, words: DataFrame, of=lambda t: t) -> DataFrame:
    """(term, n_term): documents of ``df`` that say each of ``words.term``; ``of`` maps a text's words to what is counted."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    said = df.select(F.explode(of(terms_of(text))).alias("term"))
    if words.count() <= BROADCAST_WORDS:
        return said.join(F.broadcast(words), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    return said.groupBy("term").agg(F.count(F.lit(1)).alias("n_term")).join(words, "term", "left_semi")


class Disclosures:
    """What the corpus tells of words and entities; tables are stored.

    ``told`` has (entity, term, part). Counts are of documents: n with both, n_term with the word, n_entity with the
    entity, of all rows. A word cannot reach the threshold where more documents of those counted here say it
    than ``total ** (1 - threshold) * n_entity ** threshold``, as n is at most n_entity and n_term at least their number.
    """

    def __init__(self, df: DataFrame, found: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, support: int = SUPPORT):
        self.df, self.text_col, self.threshold = df, text_col, threshold
        self.total = F.lit(float(df.count()))
        with_any = found.where("digest is not null")
        by_text = stored(with_any.groupBy("digest").agg(F.count(F.lit(1)).alias("rows"), F.first(entities_of(F.col("spans"))).alias("entities")), "texts")
        each = by_text.select("digest", "rows", F.explode("entities").alias("entity"))
        known = each.groupBy("entity").agg(F.sum("rows").alias("n_entity"), F.count(F.lit(1)).alias("texts"))
        known = stored(known.where((F.col("texts") >= support) & (F.col("n_entity") < self.total)).select("entity", "n_entity"), "known")
        held = stored(each.join(known.hint("merge"), "entity"), "held")
        self.held = held
        # The words of the texts that hold a known entity; how many of these texts' rows say each.
        text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
        busy = held.groupBy("digest").agg(F.max("n_entity").alias("widest"))
        asked = df.where(text.rlike("[@+0-9]")).select(F.sha2(text, 256).alias("digest"), text.alias("t"))
        asked = asked.join(busy.hint("merge"), "digest").dropDuplicates(["digest"])
        words = stored(asked.select("digest", "widest", F.explode(terms_of(F.col("t"))).alias("term")).join(by_text.select("digest", "rows").hint("merge"), "digest"), "words")
        here = words.groupBy("term").agg(F.sum("rows").alias("n_here"), F.count(F.lit(1)).alias("texts"), F.max("widest").alias("widest"))
        most = lambda n: F.pow(self.total, F.lit(1 - threshold)) * F.pow(n, F.lit(threshold)) * (1 + 1e-9)
        rare = stored(here.where((F.col("texts") >= support) & (F.col("n_here") <= most(F.col("widest")))).select("term", "n_here"), "rare")
        pairs = words.select("digest", "rows", "term").join(rare.hint("merge"), "term").join(held.select("digest", "entity", "n_entity").hint("merge"), "digest").where(F.col("n_here") <= most(F.col("n_entity")))
        met = pairs.groupBy("entity", "term").agg(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("texts"), F.first("n_entity").alias("n_entity"), F.first("n_here").alias("n_here"))
        self.met = stored(met.where((F.col("texts") >= support) & (_part(self.total, F.col("n"), F.col("n_here"), F.col("n_entity")) >= threshold)), "met")
        counts = _said(df, text_col, self.met.select("term").distinct())
        told = self.met.join(counts.hint("merge"), "term").select("entity", "term", _part(self.total, F.col("n"), F.col("n_term"), F.col("n_entity")).alias("part"))
        self.told = stored(told.where(F.col("part") >= threshold), "told")
        self.words = stored(self.told.groupBy("term").agg(F.max("part").alias("part")), "terms")

    def general(self) -> DataFrame:
        """(term, instead): the longest prefix that discloses none of the word's entities, with a star, or nothing."""
        text = F.coalesce(F.col(f"`{self.text_col}`"), F.lit(""))
        cut = lambda t: F.array_distinct(F.flatten(F.transform(t, lambda w: F.array(*(F.concat(F.left(w, F.lit(k)), F.lit("*")) for k in PREFIXES)))))
        cases = self.told.select("entity", "term", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.concat(F.left("term", F.lit(k)), F.lit("*")).alias("prefix")) for k in PREFIXES if k))).alias("p")).select("entity", "term", "p.k", "p.prefix").where(F.length("term") > F.col("k"))
        wanted = stored(cases.select(F.col("prefix").alias("term")).distinct(), "prefixes")
        counts = _said(self.df, self.text_col, wanted, cut)
        # Documents with an entity and a word of the prefix: among the texts that hold the entity.
        busy = self.held.join(self.told.select("entity").distinct().hint("merge"), "entity", "left_semi")
        asked = self.df.where(text.rlike("[@+0-9]")).select(F.sha2(text, 256).alias("digest"), text.alias("t")).join(busy.select("digest").distinct().hint("merge"), "digest").dropDuplicates(["digest"])
        said = asked.select("digest", F.explode(cut(terms_of(F.col("t")))).alias("prefix")).join(wanted.withColumnRenamed("term", "prefix").hint("merge"), "prefix")
        both = said.join(busy.hint("merge"), "digest").groupBy("entity", "prefix").agg(F.sum("rows").alias("n"), F.first("n_entity").alias("n_entity"))
        judged = cases.join(both.hint("merge"), ["entity", "prefix"]).join(counts.withColumnRenamed("term", "prefix").hint("merge"), "prefix")
        judged = judged.withColumn("safe", _part(self.total, F.col("n"), F.col("n_term"), F.col("n_entity")) < self.threshold)
        safe = judged.groupBy("term", "k", "prefix").agg(F.min("safe").alias("safe")).where("safe").groupBy("term").agg(F.max_by("prefix", "k").alias("instead"))
        return stored(self.words.select("term").join(safe.hint("merge"), "term", "left").withColumn("instead", F.coalesce("instead", F.lit(""))), "general")


def _literal(words: DataFrame) -> list[str] | None:
    """The words, if they are few enough to go to the scan as literals."""
    found = [r.term for r in words.select("term").limit(LITERAL_WORDS + 1).collect()]
    return found if len(found) <= LITERAL_WORDS else None


def term_spans(df: DataFrame, words: DataFrame, instead: str | None = None) -> DataFrame:
    """``df`` (with ``_text``) and ``added``: the spans of ``words.term`` in each text; ``instead`` names a map of the text's words to ``words.instead``."""
    few = _literal(words) if instead is None else None
    if few is not None:
        if not few:
            return df.withColumn("added", _none())
        told = lambda w: F.lower(w).isin(few)
        masked = _masked(F.col("_text"))
        any_told = F.exists(F.regexp_extract_all(masked, F.lit(TERM), 0), told)
        return df.withColumn("added", F.when(any_told, F.filter(_matches(masked, TERM, 4), lambda s: told(s["value"]))).otherwise(_none()))
    keyed = df.withColumn("_digest", F.sha2("_text", 256))
    said = "instead" if instead else "term"
    hits = keyed.dropDuplicates(["_digest"]).select("_digest", F.explode(terms_of(F.col("_text"))).alias("term")).join(words.select("term", F.col(said).alias("_said")).hint("merge"), "term")
    own = hits.groupBy("_digest").agg(F.map_from_entries(F.collect_list(F.struct("term", "_said"))).alias("_told"))
    both = keyed.join(own.hint("merge"), "_digest", "left").drop("_digest")
    some = F.filter(_matches(_masked(F.col("_text")), TERM, 4), lambda s: F.map_contains_key("_told", F.lower(s["value"])))
    marked = both.withColumn("added", F.when(F.col("_told").isNotNull(), some).otherwise(_none()))
    return marked.withColumnRenamed("_told", instead) if instead else marked.drop("_told")


def find_personal_data(df: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry``, the base ``spans`` and the ``added`` spans of disclosing words (empty arrays if none)."""
    found = stored(marked(df, text_col, carry), "found")
    words = Disclosures(df, found, text_col).words
    own = df.select(*(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    rows = term_spans(own.withColumn("spans", base_spans(F.col("_text"))), words)
    return rows.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)), "spans", "added")


def _replaced(text: Column, spans: Column, instead) -> Column:
    """The text with ``instead(span)`` in place of spans; of overlapping spans the first says what stands there."""
    kind = "struct<from:int,to:int,then:string>"

    def step(a: Column, s: Column) -> tuple[dict[str, Column], Column]:
        piece = F.struct(a["pos"].alias("from"), s["start"].alias("to"), instead(s).alias("then"))
        return {"pos": F.greatest(a["pos"], s["end"])}, F.when(s["start"] >= a["pos"], F.array(piece)).otherwise(F.array().cast(f"array<{kind}>"))

    def cut(every: Column) -> Column:
        last = F.struct(F.coalesce(F.array_max(F.transform(every, lambda s: s["end"])), F.lit(0)).alias("from"), F.length(text).alias("to"), F.lit("").alias("then"))
        return F.concat(emitted(every, {"pos": F.lit(0)}, kind, step), F.array(last.cast(kind)))

    def joined(cuts: Column) -> Column:
        # A text with many spans is taken apart once, as each substring walks it from the start.
        near = F.array_join(F.transform(cuts, lambda c: F.concat(F.substring(text, c["from"] + 1, c["to"] - c["from"]), c["then"])), "")
        far = let(F.split(text, ""), lambda chars: F.array_join(F.transform(cuts, lambda c: F.concat(F.array_join(F.slice(chars, c["from"] + 1, c["to"] - c["from"]), ""), c["then"])), ""))
        return F.when(F.size(cuts) <= 64, near).otherwise(far)

    return let(let(spans, cut), joined)


def sanitise(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with base spans replaced by labels, and disclosing words generalised, or removed where no class of words is safe."""
    found = stored(where_settled(marked(df, text_col, ()), "digest is not null"), "found")
    about = Disclosures(df, found, text_col)
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row")
    packed = df.select(row, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text")).withColumn("_spans", base_spans(F.col("_text")))
    labels = F.array(*map(F.lit, LABELS))
    # Few words go to the scan as literals, more by join with what each text says: the same classes either way.
    general = about.general() if not about.words.isEmpty() else None
    few = general.limit(LITERAL_WORDS + 1).collect() if general is not None else []
    if len(few) <= LITERAL_WORDS:
        rows = term_spans(packed, about.words)
        table = F.create_map(*(F.lit(x) for r in few for x in (r.term, r.instead))) if few else F.create_map().cast("map<string,string>")
    else:
        rows = term_spans(packed, general, "_instead")
        table = F.col("_instead")
    stead = lambda s: F.coalesce(F.try_element_at(table, F.lower(s["value"])), F.lit(""))
    both = F.sort_array(F.concat("_spans", "added"))
    new = F.when(F.size("_spans") + F.size("added") > 0, _replaced(F.col("_text"), F.col("_both"), lambda s: F.when(s["ord"] == 4, stead(s)).otherwise(F.get(labels, s["ord"])))).otherwise(F.col(f"_row.`{text_col}`"))
    clean = rows.withColumn("_both", both).withColumn("_new", new)
    return clean.select(*(F.col("_new").alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in df.columns))


def query(df: DataFrame) -> DataFrame:
    """The contract's columns."""
    rows = find_personal_data(df)
    n = lambda k: F.size(F.filter("spans", lambda s: s["ord"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return rows.select("doc_id", *(n(k) for k in range(5)), F.sha2(written(F.col("spans")), 256).alias("base_sha256"), written(F.sort_array(F.concat("spans", "added"))).alias("spans")).withColumn("n_term", F.regexp_count("spans", F.lit("term:")).cast("long"))


def _oracle() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def found(source: str, text: str, key: str, pattern: str, offset: str) -> str:
        """Rows (key…, start, stop, value) of the matches in a column."""
        rx = quote(pattern)
        return f"""select {key}, start + {offset} as start, start + len + {offset} as stop, value from (
          select {key}, {offset}, value, length(value) as len, sum(length(gap)) over w + coalesce(sum(length(value)) over (w rows between unbounded preceding and 1 preceding), 0) as start
          from (select {key}, {offset}, unnest(regexp_extract_all({text}, {rx})) as value, unnest(list_slice(string_split_regex({text}, {rx}), 1, len(regexp_extract_all({text}, {rx})))) as gap, unnest(range(len(regexp_extract_all({text}, {rx})))) as i from {source})
          window w as (partition by {key} order by i))"""

    digits = "regexp_replace(value, '[^0-9]', '', 'g')"
    luhn = f"list_sum(list_transform(range(length({digits})), lambda k: case when k % 2 = 0 then substr({digits}, (length({digits}) - k)::bigint, 1)::int else [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][substr({digits}, (length({digits}) - k)::bigint, 1)::int + 1] end)) % 10 = 0"
    valid = {
        "email": "true",
        "ip": "len(list_filter(string_split(value, '.'), lambda p: length(ltrim(p, '0')) > 3 or coalesce(nullif(ltrim(p, '0'), ''), '0')::hugeint > 255)) = 0",
        "card": f"length({digits}) between 12 and 19 and {luhn}",
        "phone": f"length({digits}) between 9 and 15",
    }
    kinds = " union all ".join(f"select r, {k} as ord, start, stop, value from ({found('d', 'text', 'r', plain[n], 'zero')}) where {valid[n]}" for k, n in enumerate(KINDS[:4]))
    words = r"\p{L}[\p{L}\p{M}]{2,}"
    email = quote(plain["email"])
    blank = f"""array_to_string(list_transform(range(len(string_split_regex(text, {email}))), lambda i: string_split_regex(text, {email})[i + 1] || coalesce(repeat(' ', length(regexp_extract_all(text, {email})[i + 1])), '')), '')"""
    part = "least(log2(total::double * n / (n_term * n_entity)) / log2(total::double / n_entity), 1.0)"
    count = lambda k: f"count_if(ord = {k})::bigint as n_{KINDS[k]}"
    names = "[" + ", ".join(map(quote, KINDS)) + "]"
    return rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text, 0 as zero from documents),
base as ({kinds}),
masked as (select r, zero, {blank} as text from d),
spoken as (select r, start, stop, lower(value) as term from ({found('masked', 'text', 'r', words, 'zero')})),
said as (select distinct r, term from spoken),
ent as (select distinct r, ord || ':' || lower(value) as entity from base),
ne as (select entity, count(*) as n_entity from ent group by entity),
met as (select entity, term, count(*) as n from ent join said using (r) join d using (r) group by all having count(distinct text) >= {SUPPORT}),
nt as (select term, count(*) as n_term from said group by term),
tot as (select count(*) as total from d),
told as (select distinct term from met join ne using (entity) join nt using (term), tot where n_entity < total and {part} >= {THRESHOLD}),
added as (select r, 4 as ord, start, stop from spoken join told using (term)),
every as (select r, ord, start, stop from base union all select * from added),
agg as (select r, {', '.join(count(k) for k in range(5))}, string_agg({names}[ord + 1] || ':' || start || ':' || stop, ',' order by start, ord) as spans,
  string_agg({names}[ord + 1] || ':' || start || ':' || stop, ',' order by start, ord) filter (where ord < 4) as base from every group by r)
select doc_id, {', '.join(f'coalesce(n_{k}, 0) as n_{k}' for k in KINDS)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join agg using (r)
"""


#: DuckDB SQL for ``query(documents)``.
ORACLE = _oracle()
