"""User aggregate functions with the accumulator contract.

An ``Aggregator`` has ``create()``, ``add(acc, rows)``, ``merge(a, b)`` and
``result(acc)``.  ``aggregate`` runs it the way Spark runs a built-in
aggregate, in two phases:

1. map side: each Arrow batch folds its rows into one accumulator per key
   (``add`` gets a pandas frame of that key's rows, with Arrow types, so nulls
   and large integers are kept) and emits (key, pickled accumulator);
2. after a hash shuffle on the key, one pass per partition merges the
   accumulators of each key, never the raw rows, and ``result`` gives the
   output row.

Use a built-in aggregate when one exists; this is for folds Spark lacks.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


class Aggregator:
    """Base class; override the four methods.  ``result`` returns a tuple
    matching ``result_schema``."""

    result_schema: str = ""

    def create(self):
        raise NotImplementedError

    def add(self, acc, rows: pd.DataFrame):
        raise NotImplementedError

    def merge(self, a, b):
        raise NotImplementedError

    def result(self, acc) -> tuple:
        raise NotImplementedError


class SumAggregator(Aggregator):
    """Sum of one column (the accumulator is the running sum)."""

    def __init__(self, col: str, out: str = "sum", dtype: str = "bigint"):
        self.col, self.result_schema = col, f"{out} {dtype}"

    def create(self):
        return 0

    def add(self, acc, rows):
        return acc + (rows[self.col].sum() if rows[self.col].notna().any() else 0)

    def merge(self, a, b):
        return a + b

    def result(self, acc):
        return (int(acc),)


class CountAggregator(Aggregator):
    """Generic count of records."""

    def __init__(self, out: str = "count"):
        self.result_schema = f"{out} bigint"

    def create(self):
        return 0

    def add(self, acc, rows):
        return acc + len(rows)

    def merge(self, a, b):
        return a + b

    def result(self, acc):
        return (int(acc),)


class Combined(Aggregator):
    """Several aggregators side by side (one accumulator tuple)."""

    def __init__(self, *parts: Aggregator):
        self.parts = parts
        self.result_schema = ", ".join(p.result_schema for p in parts)

    def create(self):
        return tuple(p.create() for p in self.parts)

    def add(self, acc, rows):
        return tuple(p.add(a, rows) for p, a in zip(self.parts, acc))

    def merge(self, a, b):
        return tuple(p.merge(x, y) for p, x, y in zip(self.parts, a, b))

    def result(self, acc):
        return sum((p.result(a) for p, a in zip(self.parts, acc)), ())


def aggregate(df: DataFrame, keys: Sequence[str], agg: Aggregator) -> DataFrame:
    """``groupBy(keys)`` + a user ``Aggregator`` (partial, shuffle, final).

    Keys stay typed Arrow columns from end to end, so a null is a key like any
    other and large integers keep every digit.  Both phases hold one Arrow
    batch and one accumulator per key of it; the final phase reads its keys in
    sorted order and merges neighbours.
    """
    keys = list(keys)
    key_fields = [df.schema[k] for k in keys]
    partial_schema = T.StructType(key_fields + [T.StructField("_acc", T.BinaryType())])
    result_fields = T._parse_datatype_string(agg.result_schema).fields
    out_schema = T.StructType(key_fields + list(result_fields))
    names = [f.name for f in result_fields]
    arrow = to_arrow_schema(out_schema)
    step = 10_000

    def partial(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            frame = table.to_pandas(types_mapper=pd.ArrowDtype)
            if keys:
                places = table.select(keys).append_column("_row", pa.array(range(table.num_rows)))
                groups = places.group_by(keys).aggregate([("_row", "list")])
                rows = groups["_row_list"].to_pylist()
                cols = [groups[k].combine_chunks() for k in keys]
            else:
                rows, cols = [list(range(table.num_rows))], []
            accs = [pickle.dumps(agg.add(agg.create(), frame.iloc[r])) for r in rows]
            yield pa.record_batch([*cols, pa.array(accs, pa.binary())], names=keys + ["_acc"])

    def final(batches):
        done_keys, done, last, acc = [], [], None, None

        def flush():
            cols = [pa.array([float("nan") if k[i] == "NaN" and pa.types.is_floating(arrow.field(i).type) else k[i]
                              for k in done_keys], arrow.field(i).type) for i in range(len(keys))]
            cols += [pa.array([r[i] for r in done], arrow.field(len(keys) + i).type) for i in range(len(names))]
            return pa.record_batch(cols, names=keys + names)

        for batch in batches:
            cols = [batch[k].to_pylist() for k in keys]
            for i, blob in enumerate(batch["_acc"].to_pylist()):
                key = tuple("NaN" if c[i] != c[i] else c[i] for c in cols)      # a NaN equals itself here
                if acc is not None and key == last:
                    acc = agg.merge(acc, pickle.loads(blob))
                    continue
                if acc is not None:
                    done_keys.append(last)
                    done.append(agg.result(acc))
                    if len(done) == step:
                        yield flush()
                        done_keys.clear()
                        done.clear()
                last, acc = key, pickle.loads(blob)
        if acc is not None:
            done_keys.append(last)
            done.append(agg.result(acc))
            yield flush()

    parts = df.mapInArrow(partial, partial_schema)
    # shuffle the (few) accumulators on the key; each partition merges its keys
    merged = parts.repartition(*keys).sortWithinPartitions(*keys) if keys else parts.repartition(1)
    return merged.mapInArrow(final, out_schema)
