"""Ready-made analyses composed from the operators (record-shaped inputs).

Each function takes already-typed DataFrames (see ``tidepool.schemas``) and
returns a DataFrame; ``plans.queries`` maps them onto the driver tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import joins, patterns, rolling, texts, transforms, windows


def word_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """Batch word count: tokens of every line, summed per word.

    The grouped sum is a partial + final aggregate, so a very common word
    is combined map-side before the shuffle."""
    toks = transforms.tokenize(lines, col)
    return toks.groupBy("word").agg(F.sum("one").alias("count"))


def word_count_rolling(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Bounded-stream word count: after every token, the running count of its
    word, tokens in (document, line, position) order (1-based positions).

    Words are counted per block of documents and each block is read in order
    from what the blocks before have, so no token is shuffled and a very
    common word is split across tasks (``operators.texts``)."""
    return texts.running_word_count(docs, id_col, text_col)


def page_views(events: DataFrame, behavior_col: str, pv_value: str = "pv",
               out: str = "count") -> DataFrame:
    """Total page views: filter ``pv`` then count."""
    return (events.where(F.col(behavior_col) == pv_value)
            .groupBy(F.lit(pv_value).alias(behavior_col)).agg(F.count(F.lit(1)).alias(out)))


def page_views_rolling(events: DataFrame, behavior_col: str, order: Sequence[str],
                       pv_value: str = "pv") -> DataFrame:
    """Page-view counter after every view (process-function form)."""
    return rolling.rolling_count(events.where(F.col(behavior_col) == pv_value), [], list(order))


def page_views_windowed(events: DataFrame, behavior_col: str, time_col: str, size="1 hour",
                        pv_value: str = "pv") -> DataFrame:
    return windows.tumbling(events.where(F.col(behavior_col) == pv_value), time_col, size)


def unique_visitors(events: DataFrame, behavior_col: str, user_col: str,
                    pv_value: str = "pv", approx: bool = False) -> DataFrame:
    """Distinct users among page views (``approx``: HyperLogLog++)."""
    v = events.where(F.col(behavior_col) == pv_value)
    agg = F.approx_count_distinct(user_col) if approx else F.count_distinct(F.col(user_col))
    return v.agg(agg.alias("uv"))


def unique_visitors_windowed(events: DataFrame, behavior_col: str, user_col: str, time_col: str,
                             size="1 hour", pv_value: str = "pv") -> DataFrame:
    v = events.where(F.col(behavior_col) == pv_value)
    return windows.tumbling(v, time_col, size, aggs={"uv": ("count_distinct", user_col)})


def key_count(df: DataFrame, key: Column, out_key: str = "key") -> DataFrame:
    """Count per derived key (marketing channel_behavior, province_ad, ...)."""
    return df.groupBy(key.alias(out_key)).agg(F.count(F.lit(1)).alias("count"))


def hot_items(behavior: DataFrame, item_col: str, time_col: str, behavior_col: str = "behavior",
              pv_value: str = "pv", size="1 hour", slide="5 minutes", n: int = 3) -> DataFrame:
    """Top ``n`` items by page views per sliding window end.

    Filter -> sliding count per (item, window) from slide panes -> top-N per
    window end (ties: smaller item first)."""
    v = behavior.where(F.col(behavior_col) == pv_value)
    counts = windows.sliding(v, time_col, size, slide, [item_col],
                             {"item_count": ("count", F.lit(1))})
    top = windows.top_n_per_window(counts, "window_end", "item_count", n, tie=[item_col])
    return top.select("window_end", item_col, "item_count", F.col("rank").cast("bigint").alias("rank"))


def hot_pages(log: DataFrame, url_col: str, time_col: str, size="10 minutes", slide="5 seconds",
              n: int = 3) -> DataFrame:
    """Top ``n`` urls by views per sliding window end (10 min every 5 s)."""
    counts = windows.sliding(log, time_col, size, slide, [url_col], {"view_count": ("count", F.lit(1))})
    top = windows.top_n_per_window(counts, "window_end", "view_count", n, tie=[url_col])
    return top.select("window_end", url_col, "view_count", F.col("rank").cast("bigint").alias("rank"))


def login_fail_alert(logins: DataFrame, user_col: str, type_col: str, order: Sequence[str],
                     fields: Sequence[str], within="2 seconds", fail_value: str = "fail") -> DataFrame:
    """Two failed logins in a row (strict next) less than ``within`` apart."""
    fail = F.col(type_col) == fail_value
    return patterns.next_pair(logins, [user_col], list(order), fail, fail, fields, within)


def order_pay(orders: DataFrame, key: str, type_col: str, order: Sequence[str], fields: Sequence[str],
              within="15 minutes", create="create", pay="pay", timeouts: bool = False) -> DataFrame:
    """Per key: ``create`` followed by ``pay`` within the bound (matched), or
    the creates that timed out (``timeouts=True``)."""
    return patterns.followed_by(orders, [key], list(order), F.col(type_col) == create,
                                F.col(type_col) == pay, fields, within,
                                names=(create, pay), timeouts=timeouts)


def order_receipt_reconcile(orders: DataFrame, receipts: DataFrame, key: str,
                            order_seq: Sequence[str], receipt_seq: Sequence[str]) -> DataFrame:
    return joins.reconcile(orders, receipts, key, order_seq, receipt_seq)
