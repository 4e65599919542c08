"""Record-level transforms: map, flatMap, filter, union, connect, split/select.

All are narrow (no shuffle) except ``redistribute``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def project(df: DataFrame, **exprs: str | Column) -> DataFrame:
    """1 -> 1 record construction (map)."""
    return df.select(*[_c(e).alias(n) for n, e in exprs.items()])


def split_tokens(line: Column, sep: str = " ") -> Column:
    """Tokens of a line split on a single separator, trailing empties dropped.

    Leading and inner empty tokens are kept (two separators in a row give an
    empty token); an empty line gives one empty token.
    """
    sep_re = _regex_quote(sep)
    if sep == " ":
        return F.split(F.rtrim(line), " ")      # rtrim drops trailing spaces only
    return F.split(F.regexp_replace(line, f"({sep_re})+$", ""), sep_re)


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in s)


def tokenize(lines: DataFrame, col: str = "value", sep: str = " ",
             out: str = "word") -> DataFrame:
    """flatMap line -> one row per token, with a count of 1 (``one``).

    A non-empty line made only of separators has no tokens.
    """
    if sep == " ":
        only_sep = (F.length(F.col(col)) > 0) & (F.length(F.rtrim(F.col(col))) == 0)
    else:
        only_sep = ((F.length(F.col(col)) > 0)
                    & (F.length(F.regexp_replace(F.col(col), _regex_quote(sep), "")) == 0))
    return (lines.where(~only_sep)
            .select(F.explode(split_tokens(F.col(col), sep)).alias(out))
            .withColumn("one", F.lit(1).cast("bigint")))


def lines_of(df: DataFrame, text_col: str, out: str = "value") -> DataFrame:
    """A text column -> one row per line (split on newline), whole text kept."""
    return df.select(F.explode(F.split(F.col(text_col), "\n")).alias(out))


def explode_map(df: DataFrame, list_col: str, fn: Callable[[Column], Column],
                out: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """flatMap over a list column: one row per element, mapped by ``fn``, with
    the columns in ``keep``."""
    return df.select(*keep, F.explode(F.transform(F.col(list_col), fn)).alias(out))


def filter_rows(df: DataFrame, predicate: Column) -> DataFrame:
    return df.where(predicate)


def filter_project(df: DataFrame, predicate: Column, **exprs: str | Column) -> DataFrame:
    """flatMap emitting 0 or 1 records: filter and map in one step."""
    return project(df.where(predicate), **exprs)


def redistribute(df: DataFrame, n: int | None = None) -> DataFrame:
    """Round-robin repartition (same rows, new spread)."""
    return df.repartition(n) if n else df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def union_all(*dfs: DataFrame) -> DataFrame:
    """n-ary union of same-typed inputs, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def connect_map(left: DataFrame, right: DataFrame, left_fn: Callable[[DataFrame], Column],
                right_fn: Callable[[DataFrame], Column], out: str = "value",
                tag: str | None = "source") -> DataFrame:
    """Two differently typed inputs, one function each, one output type.

    Each side is projected to ``out`` (plus an optional source tag) and the two
    are unioned — no join, no shuffle.
    """
    lcols = [left_fn(left).alias(out)] + ([F.lit("left").alias(tag)] if tag else [])
    rcols = [right_fn(right).alias(out)] + ([F.lit("right").alias(tag)] if tag else [])
    a, b = left.select(*lcols), right.select(*rcols)
    if a.schema[out].dataType != b.schema[out].dataType:
        raise TypeError("both functions must return the same type")
    return a.unionByName(b)


def label_split(df: DataFrame, rules: Sequence[tuple[Column, Sequence[str]]],
                otherwise: Sequence[str], out: str = "labels") -> DataFrame:
    """Attach a list of labels to every record: the first matching rule wins.

    ``rules = [(condition, [labels...]), ...]``; records matching none get
    ``otherwise``.  One record may carry several labels.
    """
    expr = F.array(*[F.lit(x) for x in otherwise])
    for cond, labels in reversed(list(rules)):
        expr = F.when(cond, F.array(*[F.lit(x) for x in labels])).otherwise(expr)
    return df.withColumn(out, expr)


def select_label(df: DataFrame, *labels: str, col: str = "labels") -> DataFrame:
    """Records carrying any of ``labels`` (the label column is dropped)."""
    cond = reduce(lambda a, b: a | b, [F.array_contains(F.col(col), x) for x in labels])
    return df.where(cond).drop(col)


def side_output(df: DataFrame, predicate: Column, **side: str | Column) -> tuple[DataFrame, DataFrame]:
    """Main stream keeps every record; the side stream gets a record built
    from ``side`` for each one matching ``predicate``."""
    return df, project(df.where(predicate), **side)


def fan_out_tags(df: DataFrame, outputs: Mapping[str, Column], out: str = "output") -> DataFrame:
    """Tag each row with every output it belongs to (one row per output);
    the batch form of several side outputs of one job."""
    tags = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in outputs.items()]),
                    lambda x: x.isNotNull())
    return df.withColumn(out, F.explode(tags))
