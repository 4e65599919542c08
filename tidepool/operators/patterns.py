"""Sequence patterns over keyed, event-time ordered records.

Declarative forms of the usual pattern steps.  Records of a key are put in
``order`` (event time, then arrival sequence); a pattern starts at every
record satisfying the first condition (no skipping after a match).

* ``where`` / and / or  -> a boolean Column (``pattern_filter``)
* strict ``next``        -> ``next_pair``      (the very next record)
* relaxed ``followedBy`` -> ``followed_by``    (the first later match)
* ``followedByAny``      -> ``followed_by_any`` (every later match in time)
* ``times(m, n)``        -> ``times``          (one match per length)
* ``within(t)``          -> last - first < t   (strict)
* timeouts               -> ``followed_by(..., timeouts=True)``

Every form is built on the chunked scans of ``ordered`` (one busy key is
spread over many tasks) plus equi-joins on unique ids.  Output columns are
the keys and ``{step}_{field}`` for each step and field.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import duration
from . import ordered


def _within(first_t: Column, last_t: Column, within) -> Column:
    return last_t < first_t + F.make_dt_interval(secs=F.lit(duration(within)))


def _step_cols(prefix: str, struct_col: str | None, fields: Sequence[str]):
    if struct_col is None:
        return [F.col(f).alias(f"{prefix}_{f}") for f in fields]
    return [F.col(f"{struct_col}.{f}").alias(f"{prefix}_{f}") for f in fields]


def pattern_filter(df: DataFrame, condition: Column) -> DataFrame:
    """Single-step pattern: every record satisfying the step condition.
    Several ``where`` = ``&``, ``or`` = ``|`` over everything so far."""
    return df.where(condition)


def next_pair(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column,
              second: Column, fields: Sequence[str], within=None,
              names: tuple[str, str] = ("first", "second")) -> DataFrame:
    """``begin(first).next(second)``: the record right after a ``first``
    record must satisfy ``second`` (``within``: strictly less apart)."""
    time_col = order[0]
    nb = ordered.neighbours(df.withColumn("_b", second), keys, order,
                            {**{f: f for f in fields}, "_b": "_b", "_t": time_col}, [1], prefix="_n")
    m = nb.where(first & F.col("_n1").isNotNull() & F.col("_n1._b"))
    if within is not None:
        m = m.where(_within(F.col(time_col), F.col("_n1._t"), within))
    return m.select(*keys, *_step_cols(names[0], None, fields), *_step_cols(names[1], "_n1", fields))


def followed_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column,
                second: Column, fields: Sequence[str], within=None,
                names: tuple[str, str] = ("first", "second"),
                timeouts: bool = False) -> DataFrame:
    """``begin(first).followedBy(second)``: each ``first`` record with the
    first later ``second`` record.  With ``within`` a match needs
    ``second.t - first.t < within``; otherwise the partial match times out.

    ``timeouts=True`` returns the timed-out starts instead (no ``second`` at
    all, or the first one too late) — bounded input ends with every pending
    start timed out.
    """
    time_col = order[0]
    # a record that is both `first` and `second` may not match itself: the
    # scan looks strictly after the current record
    m = ordered.next_match(df.withColumn("_a", first), keys, order, second,
                           {**{f: f for f in fields}, "_t": time_col}, "_m")
    m = m.where(F.col("_a"))
    ok = F.col("_m").isNotNull()
    if within is not None:
        ok = ok & _within(F.col(time_col), F.col("_m._t"), within)
    if timeouts:
        return m.where(~ok).select(*keys, *_step_cols(names[0], None, fields))
    return m.where(ok).select(*keys, *_step_cols(names[0], None, fields),
                              *_step_cols(names[1], "_m", fields))


def followed_by_any(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column,
                    second: Column, fields: Sequence[str], within,
                    names: tuple[str, str] = ("first", "second")) -> DataFrame:
    """``begin(first).followedByAny(second).within(t)``: every later
    ``second`` record less than ``within`` after each ``first`` record.

    The output is every qualifying pair, so a time bound is required; the
    pairs are found with an equi-join on (keys, time bucket of width
    ``within``) — each start probes its own and the next bucket — and an
    exact order/time filter.
    """
    if within is None:
        raise ValueError("followed_by_any needs a within bound")
    time_col, w_us = order[0], max(int(round(duration(within) * 1e6)), 1)
    us = F.unix_micros(F.col(time_col).cast("timestamp"))
    a = (df.where(first)
         .select(*[F.col(k).alias(f"_ak{i}") for i, k in enumerate(keys)],
                 F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)]).alias("_ao"),
                 *[F.col(f).alias(f"{names[0]}_{f}") for f in fields],
                 F.explode(F.array(F.floor(us / w_us), F.floor(us / w_us) + 1)).alias("_abk")))
    b = (df.where(second)
         .select(*[F.col(k).alias(f"_bk{i}") for i, k in enumerate(keys)],
                 F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)]).alias("_bo"),
                 *[F.col(f).alias(f"{names[1]}_{f}") for f in fields],
                 F.floor(us / w_us).alias("_bbk")))
    cond = [a["_abk"] == b["_bbk"], b["_bo"] > a["_ao"],
            _within(a["_ao._o0"], b["_bo._o0"], within)]
    cond += [a[f"_ak{i}"].eqNullSafe(b[f"_bk{i}"]) for i in range(len(keys))]
    j = a.join(b, on=cond, how="inner")
    return j.select(*[F.col(f"_ak{i}").alias(k) for i, k in enumerate(keys)],
                    *[f"{names[0]}_{f}" for f in fields], *[f"{names[1]}_{f}" for f in fields])


def times(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column,
          repeated: Column, fields: Sequence[str], lo: int, hi: int, within=None,
          id_col: str | None = None, names: tuple[str, str] = ("first", "repeats")) -> DataFrame:
    """``begin(first).next(repeated).times(lo, hi)``: the record right after a
    ``first`` record starts the repetition (strict); further repetitions are
    the next ``repeated`` records, others skipped.  One match per length
    ``k`` in ``lo..hi``; with ``within`` the k-th repetition must be less
    than ``within`` after the start.

    Output: keys, ``first_*`` fields, ``k`` and ``repeats`` = array of
    structs of the repeated records.  ``id_col`` (default: last order column)
    must be unique; it links a start to its first repetition.
    """
    if lo < 1 or hi < lo:
        raise ValueError("need 1 <= lo <= hi")
    time_col, id_col = order[0], id_col or order[-1]
    payload = {**{f: f for f in fields}, "_t": time_col}
    # the record after each start (full sequence)
    b = ordered.boundaries(df, keys, order)
    nxt = ordered.neighbours(df.withColumn("_b", repeated), keys, order,
                             {"_id": id_col, "_b": "_b"}, [1], prefix="_n", bounds=b)
    starts = nxt.where(first & F.col("_n1").isNotNull() & F.col("_n1._b"))
    # runs of the next hi-1 repeated records, on the repeated records only
    reps = df.where(repeated)
    offs = list(range(1, hi))
    chain = (ordered.neighbours(reps, keys, order, payload, offs, prefix="_r", bounds=b)
             if offs else reps)
    chain = chain.select(
        F.col(id_col).alias("_rid"),
        F.array(F.struct(*[F.col(v).alias(k) for k, v in payload.items()]),
                *[F.col(f"_r{o}") for o in offs]).alias("_run"))
    j = starts.join(chain, starts["_n1._id"] == chain["_rid"], "inner")
    j = j.select(*keys, *[F.col(f) for f in fields], F.col(time_col).alias("_t0"), "_run",
                 F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("k"))
    run_k = F.slice(F.col("_run"), 1, F.col("k"))
    last = F.element_at(run_k, F.col("k"))
    ok = last.isNotNull()
    if within is not None:
        ok = ok & _within(F.col("_t0"), last["_t"], within)
    out = j.where(ok)
    rep_struct = F.transform(run_k, lambda r: F.struct(*[r[f].alias(f) for f in fields]))
    return out.select(*keys, *[F.col(f).alias(f"{names[0]}_{f}") for f in fields], "k",
                      rep_struct.alias(names[1]))


def match_steps(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                steps: Sequence[tuple[str, Column, str]], fields: Sequence[str], within=None,
                id_col: str | None = None) -> DataFrame:
    """A sequence of any number of steps ``(name, condition, how)``; ``how`` is
    ``next`` (the record right after) or ``followed_by`` (the first later
    record that satisfies the condition) and is ignored for the first step.
    With ``within`` the last record is less than that after the first.

    Each record's continuation per step comes from one ordered scan; partial
    matches then go from step to step by a join on ``id_col`` (unique, the last
    order column by default), so no key is one task.
    """
    time_col, id_col = order[0], id_col or order[-1]
    payload = {**{f: f for f in fields}, "_id": id_col, "_t": time_col}
    b = ordered.boundaries(df, keys, order)
    rows = df
    for i, (_, condition, how) in enumerate(steps[1:], 1):
        if how == "next":
            rows = ordered.neighbours(rows.withColumn("_b", condition), keys, order, {**payload, "_b": "_b"}, [1],
                                      prefix="_n", bounds=b)
            rows = rows.withColumn(f"_s{i}", F.when(F.col("_n1._b"), F.struct(*[F.col(f"_n1.{p}") for p in payload]))) \
                       .drop("_n1", "_n_pos", "_b")
        elif how == "followed_by":
            rows = ordered.next_match(rows, keys, order, condition, payload, f"_s{i}", bounds=b)
        else:
            raise ValueError(f"unknown kind of step: {how!r}")
    first = steps[0][0]
    out = rows.where(steps[0][1])
    if len(steps) > 1:
        out = out.where(F.col("_s1").isNotNull())
    out = out.select(*keys, *[F.col(f).alias(f"{first}_{f}") for f in fields], F.col(time_col).alias("_t0"),
                     *(["_s1"] if len(steps) > 1 else []))
    for i, (name, _, _) in enumerate(steps[1:], 1):
        out = out.select("*", *[F.col(f"_s{i}.{f}").alias(f"{name}_{f}") for f in fields])
        if i + 1 < len(steps):
            step = rows.where(F.col(f"_s{i + 1}").isNotNull()).select(F.col(id_col).alias("_rid"), f"_s{i + 1}")
            out = out.join(step, out[f"_s{i}"]["_id"] == step["_rid"]).drop("_rid")
        elif within is not None:
            out = out.where(_within(F.col("_t0"), F.col(f"_s{i}._t"), within))
    return out.drop("_t0", *[f"_s{i}" for i in range(1, len(steps))])
