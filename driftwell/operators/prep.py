"""Filters, labels and reshaped cells that come before any statistic."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from driftwell.functions.columns import any_of


@dataclass(frozen=True)
class BetFilter:
    """What the feature pipeline reads; ``groups``: label to partition id, without Default."""

    start: date
    end: date
    currencies: tuple[str, ...]
    game: str
    excluded_ops: tuple[str, ...]
    groups: dict[str, str] = field(default_factory=dict)
    selected: tuple[str, ...] = ()
    status: str = "COMPLETED"


def group_label(partition: Column, groups: dict[str, str]) -> Column:
    """The label of a partition id; any other one, and none, is Default."""
    out = F.lit("Default")
    for label, own in groups.items():
        out = F.when(partition == own, label).otherwise(out)
    return out


def group_filter(partition: Column, groups: dict[str, str], selected: tuple[str, ...]) -> Column:
    """One of the selected labels; all selected, or none named, is no filter.  Default: no partition, or an unknown one."""
    if not selected or set(selected) >= {*groups, "Default"}:
        return F.lit(True)
    default = partition.isNull() | ~partition.isin(*groups.values()) if groups else F.lit(True)
    return any_of([default if label == "Default" else partition == groups[label] for label in selected])


def base_bets(bets: DataFrame, cfg: BetFilter) -> DataFrame:
    """The bets of one game in [start, end), with their group; a null op_code is dropped, as by NOT IN."""
    first = F.get("partition_ab", F.lit(0))
    keep = (F.col("created_at") >= F.lit(cfg.start)) & (F.col("created_at") < F.lit(cfg.end)) & F.col("currency_type").isin(*cfg.currencies)
    keep = keep & (F.col("status") == cfg.status) & (F.col("game_id") == cfg.game) & ~F.col("op_code").isin(*cfg.excluded_ops)
    return bets.where(keep).where(group_filter(first, cfg.groups, cfg.selected)).withColumn("ai_group", group_label(first, cfg.groups))


def chosen(df: DataFrame, lists: dict[str, list[str]]) -> DataFrame:
    """Rows whose columns are in their lists; an empty list, or one that holds 'all', is no filter."""
    for name, values in lists.items():
        if values and "all" not in values:
            df = df.where(F.col(name).isin(*values))
    return df


def between_dates(df: DataFrame, column: str, start: date, end: date) -> DataFrame:
    return df.where(F.col(column).between(F.lit(start), F.lit(end)))


def numeric_only(df: DataFrame) -> DataFrame:
    return df.select(*(f.name for f in df.schema if isinstance(f.dataType, NumericType)))


def split_threshold(df: DataFrame, limits: dict[str, float]) -> DataFrame:
    """For each column ``c`` and limit ``t``: ``c_below_t`` (null above ``t``) and ``c_above_t`` (null up to ``t``)."""
    new = {}
    for c, t in limits.items():
        new |= {f"{c}_below_{t}": F.when(~(F.col(c) > t), F.col(c)), f"{c}_above_{t}": F.when(~(F.col(c) <= t), F.col(c))}
    return df.withColumns(new)


def without_zeros(df: DataFrame, columns: list[str], eps: float = 1e-10) -> DataFrame:
    """Rows whose columns are all above ``eps``: negative ones go too."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & (F.col(c) > eps)
    return df.where(keep)


def split_columns(df: DataFrame, column: str, pattern: str, prefix: str) -> DataFrame:
    """As many columns ``prefix1``... as the row with most parts has; missing parts are null."""
    parts = F.split(column, pattern, -1)
    most = df.agg(F.max(F.size(parts))).first()[0] or 0
    return df.withColumns({f"{prefix}{i + 1}": F.get(parts, F.lit(i)) for i in range(most)})


def result_cells(result: Column, n: int = 15, name: str = "result_pos") -> list[Column]:
    """The first ``n`` whole numbers of 'a,b,...;'; what is none is null."""
    parts = F.split(F.btrim(result, F.lit(";")), ",", -1)
    return [F.get(parts, F.lit(i)).try_cast("int").alias(f"{name}{i + 1}") for i in range(n)]


def flat_logs(logs: DataFrame, most: int = 10) -> DataFrame:
    """A row for each packed fish of a log line (and one for a line without any): its index from 1, id, type and cost.

    ``fields['fish']`` stands for the id where it is there.  One explode replaces a union per index."""
    at = lambda k: F.try_element_at("fields", F.lit(k))
    packed = F.slice(F.split(F.coalesce(at("fishes"), F.lit("")), ";", -1), 1, most)
    rows = logs.select("*", F.posexplode(packed).alias("place", "item"))
    part = lambda i: F.nullif(F.split_part("item", F.lit("/"), F.lit(i)), F.lit(""))
    return rows.select("event_id", "user_id", "event_time", at("room").try_cast("long").alias("room"), (F.col("place") + 1).alias("fish_index"), F.coalesce(at("fish"), part(1)).alias("fish"), part(2).try_cast("int").alias("fish_type"), part(3).try_cast("double").alias("cost"))


def policy(ts: Column, cutoff: str) -> Column:
    return F.when(ts <= F.lit(cutoff).cast("timestamp"), "origin").otherwise("updated")


def relabel_bought(bets: DataFrame, special: int) -> DataFrame:
    """Bets at the special table take the table of the user's next bet, and are flagged as bought free games."""
    w = Window.partitionBy("user_id").orderBy("spin_id")
    bought = F.col("table_id") == special
    return bets.select("*", F.when(bought, F.lead("table_id").over(w)).otherwise(F.col("table_id")).alias("mathtable"), F.when(bought, 1).otherwise(0).alias("buy_free_game"))


def cluster_of(player: Column) -> Column:
    return F.nullif(F.regexp_extract(player, r"cluster(\d+)", 1), F.lit("")).try_cast("int")


def bare_id(value: Column) -> Column:
    """An id without quotes and white space around it."""
    return F.regexp_replace(F.trim(value), "[\"']", "")


def arm_of(value: Column) -> Column:
    return F.lower(F.substring(bare_id(value), 1, 4))


def code_name(code: Column, names: dict[int, str]) -> Column:
    out = F.lit(None).cast("string")
    for number, name in names.items():
        out = F.when(code == number, name).otherwise(out)
    return out


#: Entities that stand in page texts.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def html_to_text(html: Column) -> Column:
    """Breaks and paragraph ends become lines, other tags go, runs of lines and spaces shrink."""
    html = F.regexp_replace(html, r"(?i)<br\s*/?>|</(?:p|div|li|tr|h[1-6])\s*>", "\n")
    html = F.regexp_replace(html, r"<[^>]*>", " ")
    for entity, put in ENTITIES:
        html = F.replace(html, F.lit(entity), F.lit(put))
    html = F.regexp_replace(F.regexp_replace(html, r"[ \t\r]+", " "), r" ?\n[ \n]*", "\n")
    return F.regexp_replace(html, r"^\s+|\s+$", "")


# ------------------------------------------------------------------- encodings


def string_index(df: DataFrame, column: str, name: str) -> DataFrame:
    """``column`` as 0, 1, ...: the most frequent value first, ties in order; null stays null.

    The index table has a row for each value; it is joined, and broadcast if Spark finds it small."""
    known = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("__n"))
    place = F.row_number().over(Window.orderBy(F.desc("__n"), F.asc(column))) - 1  # one row a value
    return df.join(known.select(column, place.alias(name)), column, "left")


def one_hot(column: str, values: list[str]) -> list[Column]:
    return [F.when(F.col(column) == v, 1).otherwise(0).alias(f"{column}_{v}") for v in values]


def nearest_level(value: Column, levels: list[float]) -> Column:
    """The place of the nearest of the levels; of two, the first."""
    far = [F.struct(F.abs(value - x).alias("far"), F.lit(i).alias("at")) for i, x in enumerate(levels)]
    return F.when(value.isNotNull(), F.least(*far)["at"])


def gap_band(seconds: Column, short: float, long: float) -> Column:
    return F.when(seconds <= short, 0).when(seconds <= long, 1).when(seconds.isNotNull(), 2)


def in_currency(amount: Column, currency: Column, rates: dict[str, float]) -> Column:
    """An amount at its currency's rate; an unknown currency counts as 1."""
    table = F.create_map(*(F.lit(x) for pair in rates.items() for x in pair))
    return amount * F.coalesce(F.try_element_at(table, currency), F.lit(1.0))


def to_number(value: Column) -> Column:
    """A double where the text is one, else null; infinities are null too."""
    got = value.try_cast("double")
    return F.when(~F.isnan(got) & (F.abs(got) < float("inf")), got)


def without_empty_columns(df: DataFrame) -> DataFrame:
    """``df`` without the columns that are null in every row."""
    counts = df.agg(*(F.count(c).alias(c) for c in df.columns)).first()
    return df.select(*(c for c in df.columns if counts[c]))
