"""Fill-in-the-middle: a text is cut into prefix, middle and suffix at token borders and put together in another order.

The kernel takes a whole Arrow batch of texts as one UTF-8 buffer. A lookup table classes each byte as white space or not;
a token begins where a document begins and where a white space byte follows another one that is none, so a mask over
adjacent bytes marks all beginnings at once. Cumulative sums of the mask, counted anew from each document's start,
number the tokens; ``searchsorted`` on them finds the cuts of all rows together, and one gather writes all outputs.
White space is ASCII, so cuts never part a character. ``restore`` finds the markers in the same way and puts texts back.

Tokens are ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``. Cuts and form come from the SHA-256 of
``seed:id``, so reruns and other partitionings agree.

Defined results: null texts are empty, and empty texts stay as they are (plain, no tokens); texts that hold a marker stay
plain; a null id hashes as no digits; repeated rows with one id are cut alike; texts of any length are cut whole, a
batch is worked through in pieces of about ``PIECE`` bytes and at least one row; an empty table gives an empty
result; other columns do not matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that the kernel takes at once.
PIECE = 4_000_000
#: Shares in percent: texts transformed, and of these suffix-prefix-middle against prefix-suffix-middle.
RATE, SPM_RATE = 50, 80
SEED = 42

#: Fixed by the contract: the markers of prefix, suffix and middle.
MARKERS = (b"<P>", b"<S>", b"<M>")
_MARK = len(MARKERS[0])
PLAIN, PSM, SPM = range(3)
FORMS = np.array(["plain", "psm", "spm"])

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_INSIDE = (np.arange(256) & 0xC0) == 0x80  # bytes that continue a character


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from zero and bytes of a string array; nulls are empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data


def _strings(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)])


def _pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about PIECE bytes."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, side="right")) - 1)
        yield at, to
        at = to


def _marked(data: np.ndarray, letter: int) -> np.ndarray:
    """Positions of the marker ``<letter>``."""
    return np.flatnonzero((data[:-2] == ord("<")) & (data[1:-1] == letter) & (data[2:] == ord(">"))) if len(data) > 2 else np.zeros(0, np.int64)


def _gathered(source: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of segments (starts, sizes: row x segment) of ``source``, joined: offsets and bytes."""
    lengths = sizes.ravel()
    ends = np.cumsum(lengths)
    shift = np.repeat(starts.ravel() - (ends - lengths), lengths)
    offsets = np.concatenate([[0], ends.reshape(sizes.shape)[:, -1]]) if len(sizes) else np.zeros(1, np.int64)
    return offsets, source[np.arange(int(offsets[-1])) + shift]


def _cut(offsets: np.ndarray, data: np.ndarray, h: np.ndarray, rate: int, spm_rate: int) -> tuple:
    """For texts in one buffer and their four hashes: tokens, form, characters of prefix and middle, output."""
    start, end = offsets[:-1], offsets[1:]
    space = _SPACE[data]
    begins = np.zeros(len(data), bool)
    begins[1:] = space[1:] & ~space[:-1]
    begins[start[start < end]] = True
    count = np.zeros(len(data) + 1, np.int32)
    np.cumsum(begins, out=count[1:])
    base = count[start]  # counts restart with each document
    n = (count[end] - base).astype(np.int64)
    pick = h[:, :2] % (n + 1)[:, None]
    # The first byte by which so many tokens and one more have begun; where there are no more, the document's end.
    found = np.searchsorted(count, base[:, None] + 1 + np.sort(pick, 1), side="left") - 1
    cuts = np.minimum(found, end[:, None])

    held = np.zeros(len(n), bool)
    for m in MARKERS:
        at = _marked(data, m[1])
        row = np.searchsorted(offsets, at, side="right") - 1
        held[row[at + _MARK <= end[row]]] = True
    plain = (start == end) | held | (h[:, 2] % 100 >= rate)
    form = np.where(plain, PLAIN, np.where(h[:, 3] % 100 < spm_rate, SPM, PSM))

    chars = np.zeros(len(data) + 1, np.int32)
    np.cumsum(~_INSIDE[data], out=chars[1:])
    prefix, middle = chars[cuts[:, 0]] - chars[start], chars[cuts[:, 1]] - chars[cuts[:, 0]]

    source = np.concatenate([data, np.frombuffer(b"".join(MARKERS), np.uint8)])
    p, s, m = (np.full(len(n), len(data) + _MARK * i) for i in range(3))
    mark, spm = np.where(plain, 0, _MARK), form == SPM
    pre, mid, suf = (start, cuts[:, 0] - start), (cuts[:, 0], cuts[:, 1] - cuts[:, 0]), (cuts[:, 1], end - cuts[:, 1])
    either = lambda a, b: np.where(spm, b, a)
    parts = [(either(p, s), mark), (either(pre[0], suf[0]), either(pre[1], suf[1])), (either(s, p), mark), (either(suf[0], pre[0]), either(suf[1], pre[1])), (m, mark), mid]
    starts, sizes = (np.stack([x[i] for x in parts], 1) for i in range(2))
    starts[plain, 1], sizes[plain, 1] = start[plain], (end - start)[plain]
    sizes[plain, 3:] = 0
    return n, form, prefix, middle, _gathered(source, starts, sizes)


def _join(offsets: np.ndarray, data: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of outputs in one buffer. No marker can arise where pieces meet, and texts that hold one are plain."""
    start, end = offsets[:-1], offsets[1:]
    at = np.zeros((len(form), 3), np.int64)
    for k, m in enumerate(MARKERS):
        found = _marked(data, m[1])
        if len(found):
            at[:, k] = found[np.minimum(np.searchsorted(found, start), len(found) - 1)]
    p, s, m = at.T
    plain, spm = form == PLAIN, form == SPM
    starts = np.stack([np.where(plain, start, p + _MARK), m + _MARK, s + _MARK], 1)
    ends = np.stack([np.where(plain, end, np.where(spm, m, s)), end, np.where(spm, p, m)], 1)
    sizes = ends - starts
    sizes[plain, 1:] = 0
    return _gathered(data, starts, sizes)


def hashes(id_: Column, seed: int = SEED) -> Column:
    """The first four 8-digit groups of the SHA-256 of ``seed:id``, as longs."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)))


def transform(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """(id_col, n, form, prefix_chars, middle_chars, output) of every row; the two counts are null for plain texts."""
    own = df.select(F.col(f"`{id_col}`").alias("_id"), hashes(F.col(f"`{id_col}`"), seed).alias("_h"), F.col(f"`{text_col}`").cast("string").alias("_text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets, data = _buffers(b.column(2))
            h = b.column(1).flatten().to_numpy().reshape(-1, 4)
            for i, j in _pieces(offsets):
                n, form, prefix, middle, out = _cut(offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]], h[i:j], rate, spm_rate)
                plain = form == PLAIN
                columns = [pa.array(n), pa.array(FORMS[form], pa.string()), pa.array(prefix, pa.int64(), mask=plain), pa.array(middle, pa.int64(), mask=plain), _strings(*out).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *columns], names=["_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = own.schema["_id"].dataType.simpleString()
    return own.mapInArrow(work, f"_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string").withColumnRenamed("_id", id_col)


def restore(df: DataFrame, output_col: str = "output", form_col: str = "form", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` and ``restored``, the exact text rebuilt from output and form; null outputs or forms are plain."""
    own = df.select(*(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)), F.col(f"`{form_col}`").alias("_form"), F.col(f"`{output_col}`").alias("_out"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets, data = _buffers(b.column("_out"))
            named = b.column("_form").fill_null("plain").to_numpy(zero_copy_only=False)
            form = np.where(named == "psm", PSM, np.where(named == "spm", SPM, PLAIN))
            for i, j in _pieces(offsets):
                text = _join(offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]], form[i:j])
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in b.columns[:-2]), _strings(*text).cast(pa.string())], names=[*b.schema.names[:-2], "restored"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in own.schema.fields[:-2])
    return own.mapInArrow(work, f"{kinds}restored string").withColumnsRenamed({f"_c{i}": c for i, c in enumerate(carry)})


def query(docs: DataFrame) -> DataFrame:
    """Digests of outputs and of the texts restored from them, for every row of ``docs``."""
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    kept = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256")
    told = transform(docs.select("doc_id", "text")).withColumn("output_sha256", sha("output"))
    return restore(told, carry=kept).select(*kept, sha("restored").alias("restored_sha256"))


#: DuckDB SQL for the query over ``documents``.
ORACLE = r"""
with d as (select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(doc_id::varchar, '')) as h from documents),
t as (select doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as ts,
        ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
        ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4 from d),
c as (select *, len(ts)::bigint as n, least(h1 % (len(ts) + 1), h2 % (len(ts) + 1)) as a, greatest(h1 % (len(ts) + 1), h2 % (len(ts) + 1)) as b from t),
p as (select doc_id, n, text, array_to_string(ts[1:a], '') as pre, array_to_string(ts[a + 1:b], '') as mid, array_to_string(ts[b + 1:], '') as suf,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
             when h4 % 100 < 80 then 'spm' else 'psm' end as form from c)
select doc_id, n, form, case when form <> 'plain' then length(pre)::bigint end as prefix_chars, case when form <> 'plain' then length(mid)::bigint end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(text) as restored_sha256 from p
"""
