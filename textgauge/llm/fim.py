"""Fill-in-the-middle: texts cut at two unit ranks and rearranged, with the cuts found in an indexable skip list.

A unit is a word with the white space before it; white space at the end is a unit of its own.  The units of a text are
the bottom lane of a skip list; every lane above keeps each eighth node.  A link of a lane carries its widths: how many
units, code points and bytes it spans.  To reach the cut after ``rank`` units one starts in the top lane, follows links
while the units so far stay within the rank, and goes down a lane when the next link would pass it.  The widths added
up on the way are the cut's place in units, code points and bytes, so no text is scanned for a cut.

Ranks, form and kind are drawn from a sha256 of the key: the same under any partitioning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.llm.tables import narrow

SEED = 42
RATE = 50
SPM = 80
MARKS = (b"<P>", b"<S>", b"<M>")
FAN = 8


def unit_ends(text: bytes) -> np.ndarray:
    """Where each unit of a UTF-8 text ends, in bytes."""
    if not text:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(text, np.uint8)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    last = ~space
    last[:-1] &= space[1:]
    ends = np.flatnonzero(last) + 1
    return np.append(ends, len(text)) if space[-1] else ends


class SkipList:
    """The units of a text with express lanes; every link carries its widths in units, code points and bytes."""

    def __init__(self, text: bytes, fan: int = FAN):
        ends = unit_ends(text)
        self.fan, self.n = fan, len(ends)
        if text.isascii():
            points = ends
        else:
            first = np.frombuffer(text, np.uint8) & 0xC0 != 0x80
            points = np.concatenate([[0], np.cumsum(first)])[ends]
        at = np.stack([np.arange(self.n + 1), np.concatenate([[0], points]), np.concatenate([[0], ends])], 1)
        self.lanes = []
        while True:
            self.lanes.append(np.diff(at, axis=0).tolist())
            if len(at) <= fan:
                break
            # The next lane keeps each ``fan``-th node and the last one.
            kept = np.arange(0, len(at), fan)
            at = at[kept if kept[-1] == len(at) - 1 else np.append(kept, len(at) - 1)]

    def reach(self, rank: int) -> tuple[int, int, int]:
        """Units, code points and bytes before the cut after ``rank`` units."""
        if not 0 <= rank <= self.n:
            raise IndexError(rank)
        units = points = size = node = 0
        for lane in reversed(self.lanes):
            while node < len(lane) and units + lane[node][0] <= rank:
                width = lane[node]
                units, points, size, node = units + width[0], points + width[1], size + width[2], node + 1
            if units == rank:
                break
            node *= self.fan
        return units, points, size


@dataclass
class Cut:
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def transform(key: int | None, text: bytes | None, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> Cut:
    """A text's units, its form, and the text rearranged for it."""
    text = text or b""
    drawn = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(drawn[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = SkipList(text)
    if not text or h[2] % 100 >= rate or any(m in text for m in MARKS):
        return Cut(units.n, "plain", None, None, text)
    ranks = sorted((h[0] % (units.n + 1), h[1] % (units.n + 1)))
    (_, a, low), (_, b, high) = map(units.reach, ranks)
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h[3] % 100 < spm:
        form, parts = "spm", (b"<S>", suffix, b"<P>", prefix, b"<M>", middle)
    else:
        form, parts = "psm", (b"<P>", prefix, b"<S>", suffix, b"<M>", middle)
    return Cut(units.n, form, a, b - a, b"".join(parts))


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row.

    ``n`` counts units; of the texts, ``rate`` in a hundred are rearranged, ``spm`` in a hundred of these with the suffix
    first.  An empty or null text and one that holds a mark stay plain, with null cuts.  Rows with equal keys draw the
    same ranks; a null key draws like an empty one.  Repeated rows are each kept; an empty table gives no rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                keys = part.column(0).to_pylist()
                cuts = [transform(k, t.as_py(), seed, rate, spm) for k, t in zip(keys, part.column(1), strict=True)]
                output = pa.array([c.output for c in cuts], pa.binary()).cast(pa.string())
                own = [pa.array([getattr(c, f.name) for c in cuts], f.type) for f in list(schema)[1:5]]
                yield pa.RecordBatch.from_arrays([part.column(0), *own, output], schema=schema)

    rows = narrow(docs, {"doc_id": key, "_text": text})
    rows = rows.select(F.col("doc_id").cast("long"), F.col("_text").cast("binary"))
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form") -> Column:
    """The text before the transformation, from its output and form."""
    parts = F.split(F.col(output), "<[PSM]>", -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))


def fim_digest(docs: DataFrame) -> DataFrame:
    """One narrow row per document: its cuts, and digests of the output and of the text rebuilt from it."""
    rows = fill_in_middle(docs)
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256")
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


DIGEST_SQL = r"""with cut as (
    select doc_id, t, h, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as units
    from (select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(doc_id::varchar, '')) as h from documents)),
  drawn as (
    select *, len(units)::bigint as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
        ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from cut),
  formed as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as low, greatest(h1 % (n + 1), h2 % (n + 1)) as high,
        case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50 then 'plain'
            when h4 % 100 < 80 then 'spm' else 'psm' end as form from drawn),
  parts as (
    select *, array_to_string(units[1:low], '') as p, array_to_string(units[low + 1:high], '') as m,
        array_to_string(units[high + 1:], '') as s from formed)
  select doc_id, n, form, case when form <> 'plain' then length(p)::bigint end as prefix_chars,
    case when form <> 'plain' then length(m)::bigint end as middle_chars,
    sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
        else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
    sha256(t) as restored_sha256
  from parts"""
