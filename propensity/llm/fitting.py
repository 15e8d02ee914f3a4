"""Shared by the fitted operators: sparse rows of a bounded sample, one fitting task, models as text."""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.llm.words import slices


def featurised(rows: DataFrame, make: Callable, keep: list[str]) -> DataFrame:
    """(the kept columns, features, values) of each row's ``text``: a bounded sample's texts as sparse rows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(len(keep))):
                text, column, value = make(data, offsets)
                ends = pa.array(np.searchsorted(text, np.arange(b - a + 1)).astype(np.int32))
                lists = [
                    pa.ListArray.from_arrays(ends, pa.array(column, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(value, pa.float32())),
                ]
                yield pa.record_batch([batch.column(i).slice(a, b - a) for i in range(len(keep))] + lists, names=[*keep, "features", "values"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.select(*keep, "text").mapInArrow(cut, f"{kinds}, features array<int>, values array<float>")


def sparse(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lists = table["features"].combine_chunks()
    n = np.diff(lists.offsets.to_numpy())
    return (
        np.repeat(np.arange(len(n)), n),
        lists.flatten().to_numpy().astype(np.int64),
        table["values"].combine_chunks().flatten().to_numpy().astype(float),
    )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def packed(**arrays: np.ndarray) -> str:
    return json.dumps({k: base64.b64encode(np.asarray(v, np.float32).tobytes()).decode() for k, v in arrays.items()})


def unpacked(model: str) -> dict[str, np.ndarray]:
    return {k: np.frombuffer(base64.b64decode(v), np.float32).astype(float) for k, v in json.loads(model).items()}


def sample_share(rows: DataFrame, bound: int, key: Column) -> DataFrame:
    """About ``bound`` rows, or all if there are no more, chosen by a hash of ``key``."""
    n = rows.count()
    return rows if n <= bound else rows.where(F.pmod(F.xxhash64(key.cast("string"), F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * bound / n))


def fit_in_task(rows: DataFrame, fit: Callable[[pa.Table], str]) -> str:
    """``fit`` of a bounded sample in one task; only the model's text comes back."""
    out = rows.groupBy(F.lit(0).alias("all")).applyInArrow(lambda t: pa.table({"model": [fit(t)]}), "model string").collect()
    return out[0].model if out else fit(rows.toArrow())


def held_out(doc_id: Column) -> Column:
    """The third of the ids whose labels are never learned; rows without an id belong to it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))
