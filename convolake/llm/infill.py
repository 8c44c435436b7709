"""Operator 13: fill-in-the-middle transformation by displacement scatter.

A text is cut at two places between its lines into prefix, middle and suffix, and written in another order with sentinels
(psm: prefix, suffix, middle; spm: suffix, prefix, middle). Texts of a batch are moved together: line ends are found by one
scan over the batch's bytes, a difference array holds, at the first byte of each part, by how much its place changes,
and its running sum gives every byte its place in the output, to which numpy scatters it. restored() finds the sentinels
in the output, builds the inverse displacement from their places alone, and gathers the text back.

Each batch is moved in blocks of at most BLOCK bytes (a longer text is a block of its own), so memory is bounded by the
longest text. There is no shuffle; a lost task is run again with the same result, since cuts depend on doc_id only.

Defined results: a null text counts as empty, and an empty text stays plain with 0 lines; a null doc_id is hashed as an
empty one; rows with equal doc_id are cut by the same draws; repeated rows give repeated rows; an empty table gives none;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convolake.llm.common import table

SENTINELS = {"P": "<P>", "S": "<S>", "M": "<M>"}
SEED = 7
#: Of 100 texts so many are transformed, and of 100 of these so many as suffix, prefix, middle.
RATE, SPM_RATE = 100, 50
BLOCK = 8 << 20
_MARK = {k: np.frombuffer(v.encode(), np.uint8) for k, v in SENTINELS.items()}


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and where each of its texts begins (one place more than texts)."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def _strings(data: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data))


def _blocks(at: np.ndarray, size: int) -> Iterator[slice]:
    """Runs of texts of at most so many bytes, one text at least."""
    row = 0
    while row < len(at) - 1:
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, side="right")) - 1)
        yield slice(row, end)
        row = end


def places(starts: np.ndarray, moved_to: np.ndarray, size: int) -> np.ndarray:
    """The new place of each of size bytes, where the part that begins at starts[i] goes to moved_to[i]. Parts are in
    order and cover all; of parts with the same start all but the last are empty."""
    kind = np.int32 if max(size, int(moved_to.max(initial=0))) < 2**31 - 1 else np.int64
    step = np.zeros(size + 1, kind)
    np.add.at(step, starts, np.diff(moved_to - starts, prepend=0).astype(kind))
    return np.arange(size, dtype=kind) + np.cumsum(step[:-1], dtype=kind)


def cut(data: np.ndarray, at: np.ndarray, draw_a: np.ndarray, draw_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of each text, and the bytes at which its prefix and its middle end."""
    start, end = at[:-1], at[1:]
    breaks = np.flatnonzero(data == 10)
    first = np.searchsorted(breaks, start)
    inside = np.searchsorted(breaks, end) - first
    open_end = (end > start) & (data[np.maximum(end - 1, 0)] != 10) if len(data) else np.zeros(len(start), bool)
    lines = inside + open_end

    def after(units: np.ndarray) -> np.ndarray:
        found = breaks[np.minimum(first + np.maximum(units, 1) - 1, max(len(breaks) - 1, 0))] + 1 if len(breaks) else end
        return np.where(units == 0, start, np.where(units <= inside, found, end))

    a, b = draw_a % (lines + 1), draw_b % (lines + 1)
    return lines, after(np.minimum(a, b)), after(np.maximum(a, b))


def scattered(data: np.ndarray, at: np.ndarray, form: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and places of the outputs of texts whose prefixes end at a and middles at b (form: 0 plain, 1 psm, 2 spm)."""
    start, end = at[:-1], at[1:]
    plain, suffix_first = form == 0, form == 2
    a, b = np.where(plain, end, a), np.where(plain, end, b)
    mark = np.where(plain, 0, len(_MARK["P"]))
    out_at = np.concatenate(([0], np.cumsum(end - start + 3 * mark)))
    prefix, suffix, at_0 = a - start, end - b, out_at[:-1]
    to_prefix = at_0 + mark + np.where(suffix_first, suffix + mark, 0)
    to_suffix = at_0 + mark + np.where(suffix_first, 0, prefix + mark)
    to_middle = at_0 + 3 * mark + prefix + suffix
    starts, to = (np.stack(x, 1).ravel() for x in ((start, a, b), (to_prefix, to_middle, to_suffix)))
    out = np.empty(out_at[-1], np.uint8)
    out[places(starts, to, len(data))] = data
    for k, to_part in (("P", to_prefix), ("S", to_suffix), ("M", to_middle)):
        out[(to_part[~plain] - len(_MARK[k]))[:, None] + np.arange(len(_MARK[k]))] = _MARK[k]
    return out, out_at


def gathered(out: np.ndarray, at: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and places of the texts that outputs were made of, from the sentinels' places."""
    begin, end = at[:-1], at[1:]
    moved = np.flatnonzero(form != 0)
    hit = np.flatnonzero((out[:-2] == ord("<")) & (out[2:] == ord(">")) & np.isin(out[1:-1], [ord(k) for k in SENTINELS])) if len(out) > 2 else np.zeros(0, np.int64)
    row = np.searchsorted(at, hit, side="right") - 1
    hit = hit[(form[row] != 0) & (hit + 3 <= end[row])]  # a transformed text has no sentinels of its own
    if len(hit) != 3 * len(moved):
        raise ValueError("an output does not have three sentinels")
    one, two, three = (hit.reshape(-1, 3)[:, k] for k in range(3))
    if not np.array_equal(one, begin[moved]) or (out[three + 1] != ord("M")).any() or (out[two + 1] != np.where(form[moved] == 1, ord("S"), ord("P"))).any():
        raise ValueError("an output's sentinels do not fit its form")
    suffix_first = form[moved] == 2
    near, far = two - one - 3, three - two - 3
    prefix, suffix = np.zeros(len(form), np.int64), np.zeros(len(form), np.int64)
    prefix[moved], suffix[moved] = np.where(suffix_first, far, near), np.where(suffix_first, near, far)
    from_prefix, from_middle, from_suffix = begin.copy(), begin.copy(), end.copy()
    from_prefix[moved], from_suffix[moved], from_middle[moved] = np.where(suffix_first, two, one) + 3, np.where(suffix_first, one, two) + 3, three + 3
    text_at = np.concatenate(([0], np.cumsum(end - begin - np.where(form != 0, 9, 0))))
    start = text_at[:-1]
    starts, source = (np.stack(x, 1).ravel() for x in ((start, start + prefix, text_at[1:] - suffix), (from_prefix, from_middle, from_suffix)))
    return out[places(starts, source, int(text_at[-1]))], text_at


_FORMS = pa.array(["plain", "psm", "spm"])


def _infill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = _bytes(batch.column("text"))
        form, one, two = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("form", "h1", "h2"))
        for rows in _blocks(at, BLOCK):
            here = at[rows.start : rows.stop + 1]
            text, here = data[here[0] : here[-1]], here - here[0]
            f = form[rows]
            lines, a, b = cut(text, here, one[rows], two[rows])
            points = np.concatenate(([0], np.cumsum((text & 0xC0) != 0x80)))
            out, out_at = scattered(text, here, f, a, b)
            chars = lambda x, y: pa.array(points[y] - points[x], mask=f == 0)  # noqa: B023, E731
            columns = [batch.column("doc_id").slice(rows.start, len(f)), pa.array(lines, pa.int64()), _FORMS.take(pa.array(f)), chars(here[:-1], a), chars(a, b), _strings(out, out_at)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def _restore(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = _bytes(batch.column("output"))
            form = batch.column("__form").to_numpy(zero_copy_only=False)
            for rows in _blocks(at, BLOCK):
                here = at[rows.start : rows.stop + 1]
                text, text_at = gathered(data[here[0] : here[-1]], here - here[0], form[rows])
                part = batch.slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], _strings(text, text_at)], [*names, "restored"])

    return run


def _form_code(form: Column) -> Column:
    return F.when(form == "psm", 1).when(form == "spm", 2).otherwise(0)


def infilled(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars (code points, null if plain) and output of each text."""
    kind = dict(docs.dtypes)["doc_id"]
    text = F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draw = lambda k: F.conv(F.substring("digest", 1 + 8 * k, 8), 16, 10).cast("long")
    d = docs.select("doc_id", text.alias("text"), digest.alias("digest"))
    plain = (F.col("text") == "") | (draw(2) % 100 >= rate)
    for mark in SENTINELS.values():
        plain = plain | F.contains("text", F.lit(mark))
    form = F.when(plain, 0).when(draw(3) % 100 < spm_rate, 2).otherwise(1)
    d = d.select("doc_id", "text", form.alias("form"), draw(0).alias("h1"), draw(1).alias("h2"))
    return d.mapInArrow(_infill, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(outputs: DataFrame) -> DataFrame:
    """outputs with restored: the text, from output and form alone. ValueError (in the task) where sentinels do not fit."""
    d = outputs.withColumns({"output": F.coalesce("output", F.lit("")), "__form": _form_code(F.col("form"))})
    return d.mapInArrow(_restore(outputs.columns), ", ".join(f"`{c}` {t}" for c, t in outputs.dtypes) + ", restored string")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = restored(infilled(table(spark, sf_dir, "documents")))
    return d.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS l, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(l) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS a, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(l[1:a], '') AS prefix, array_to_string(l[a + 1:b], '') AS middle, array_to_string(l[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""
