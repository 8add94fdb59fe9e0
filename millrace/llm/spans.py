"""Spans in texts: kinds, positions, digests. Positions are code points, ends exclusive."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.arrays import parts
from millrace.llm.common import Shared

Span = tuple[str, int, int]


def joined(spans: list, order: dict[str, int]) -> str:
    """kind:start:end by start, then kind in the given order, then end."""
    ranked = sorted(spans, key=lambda s: (s[1], order[s[0]], s[2]))
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in ranked)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def over_texts(docs: DataFrame, columns: list[str], schema: str, row: Callable[[str], tuple], shared: Shared | None = None) -> DataFrame:
    """Carry ``columns`` along and add what ``row(text)`` finds in each whole text; null counts as empty.

    With ``shared`` it is ``row(text, shared object)``.
    """
    kept = docs.select(*columns, "text")
    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        more = (shared.get(),) if shared else ()
        for batch in (part for whole in batches for part in parts(whole)):
            found = [row(text or "", *more) for text in batch.column("text").to_pylist()]
            width = len(found[0]) if found else 0
            arrays = [batch.column(c) for c in columns] + [pa.array([f[i] for f in found]) for i in range(width)]
            if found:
                yield pa.RecordBatch.from_arrays(arrays, names=columns + names)

    names = [part.split()[0] for part in schema.split(", ")]
    return kept.mapInArrow(work, f"{head}, {schema}")
