"""Counts of neighbouring words, combined within tasks before anything is shuffled.

A text is split where ``X.words`` splits it: the white space of ``X.SPACE`` is that of Python's ``str.split``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words a task combines at a time, different words it keeps numbered, and rows of a batch.
HELD = 1 << 21
NUMBERED = 1 << 19
ROWS = 1 << 16


def run_counts(df: DataFrame, text: Column, *keep: str, size: int = 1, ends: bool = False) -> DataFrame:
    """``keep``, ``w0`` to ``w<size - 1>`` (neighbouring words of a text) and ``n``: occurrences, in partial counts to be summed.

    With ``ends`` the last words of a text begin runs as well, which have null behind the end.
    """
    most, different, rows = HELD, NUMBERED, ROWS
    schema = T.StructType([*(df.schema[c] for c in keep), *(T.StructField(f"w{i}", T.StringType()) for i in range(size)), T.StructField("n", T.LongType())])

    # Nested, so that workers need not have this package installed.
    class Numbers(dict):
        def __missing__(self, key):
            self[key] = number = len(self)
            return number

    def counted(texts: list[np.ndarray], owner: list[int], words: Numbers, keys: Numbers, kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
        # Behind every text stands 0, the end, so often that no run reaches the next text.
        gap = np.zeros(size, np.int32)
        flat = np.concatenate([x for t in texts for x in (t, gap)])
        own = np.repeat(np.array(owner, np.int64), [len(t) + size for t in texts])
        at = np.flatnonzero(flat if ends else flat[: len(flat) - size + 1] * (flat[size - 1 :] > 0))
        code, span = own[at], len(keys)
        for i in range(size):
            if span * len(words) >= 1 << 62:
                code, found = pd.factorize(code)
                span = len(found)
            code, span = code * len(words) + flat[at + i], span * len(words)
        code, found = pd.factorize(code)
        first = np.empty(len(found), np.int64)
        first[code[::-1]] = at[::-1]
        times, names, known = np.bincount(code, minlength=len(found)), pa.array(list(words), pa.string()), list(keys)
        columns = [pa.array([k[i] for k in known], kind).take(pa.array(own[first])) for i, kind in enumerate(kinds)]
        columns += [names.take(pa.array(flat[first + i])) for i in range(size)]
        columns.append(pa.array(times.astype(np.int64)))
        for low in range(0, len(found), rows):
            yield pa.RecordBatch.from_arrays([c.slice(low, rows) for c in columns], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, keys, texts, owner, held, kinds = Numbers({None: 0}), Numbers(), [], [], 0, []
        for batch in batches:
            kinds = [batch.column(i).type for i in range(len(keep))]
            given = [batch.column(i).to_pylist() for i in range(len(keep))]
            for i, whole in enumerate(batch.column(len(keep))):
                split = (whole.as_py() or "").split()
                texts.append(np.fromiter(map(words.__getitem__, split), np.int32, len(split)))
                owner.append(keys[tuple(g[i] for g in given)])
                held += len(split) + size
                if held >= most:
                    yield from counted(texts, owner, words, keys, kinds)
                    texts, owner, held = [], [], 0
                    if len(words) > different:
                        words = Numbers({None: 0})
                    if len(keys) > different:
                        keys = Numbers()
        if texts:
            yield from counted(texts, owner, words, keys, kinds)

    return df.select(*keep, text.alias("_text")).mapInArrow(run, schema)
