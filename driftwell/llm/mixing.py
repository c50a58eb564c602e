"""Mixing sources to target weights by hierarchical budgets, in DataFrame functions alone.

The budget goes down a domain-language-source tree by weight.  What a node's
documents cannot fill goes to its siblings first, and to the parent's siblings
only when the whole parent is short.  A leaf takes whole epochs, and of the last
one the prefix of a seeded order that its tokens allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.store import materialise

LEVELS = ("domain", "lang", "source")
#: Relative weights (whole numbers) by level; names that are not listed have weight 1.
WEIGHTS = {"domain": {"web": 5, "books": 3, "news": 2}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}, "source": {}}


def domain_of(source: Column) -> Column:
    """The query's domains: by the last digit of a source's name, 0-3 web, 4-6 books, else news."""
    last = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9])$", 1)
    return F.when(last.isin(*"0123"), "web").when(last.isin(*"456"), "books").otherwise("news")


def words_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("long")


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    out = F.lit(1)
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, w).otherwise(out)
    return out.cast("long")


def _fill(rows: DataFrame, parents: list[str], level: str, weights: dict) -> DataFrame:
    """``rows`` (parents, level, cap, budget) with the node's own ``budget``.

    The level of water rises in proportion to weight; nodes are full in the order
    of cap / weight.  Shares are whole tokens, rounded down.
    """
    w = _weight(level, weights)
    rows = rows.withColumn("w", w).withColumn("ratio", F.when(F.col("w") > 0, F.col("cap") / F.col("w")))
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(1))
    before = siblings.orderBy(F.asc_nulls_last("ratio"), F.asc(level)).rowsBetween(Window.unboundedPreceding, -1)
    full = F.coalesce(F.sum(F.when(F.col("w") > 0, F.col("cap"))).over(before), F.lit(0))
    open_ = F.sum("w").over(siblings) - F.coalesce(F.sum("w").over(before), F.lit(0))
    rows = rows.withColumn("rise", (F.col("budget") - full) / F.nullif(open_, F.lit(0)))
    rows = rows.withColumn("line", F.max(F.when(F.col("rise") <= F.col("ratio"), F.col("rise"))).over(siblings))
    share = F.when(F.col("w") == 0, F.lit(0)).otherwise(F.least(F.col("cap"), F.coalesce(F.floor(F.col("line") * F.col("w")), F.col("cap"))))
    return rows.withColumn("budget", share.cast("long")).drop("w", "ratio", "rise", "line")


def leaf_budgets(leaves: DataFrame, share: float, max_epochs: int, weights: dict) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens) with ``budget`` tokens each.

    The whole budget is ``share`` of all tokens; a leaf holds ``max_epochs``
    times its own, a node what its children of a weight above 0 hold.  Each
    level's rows are one for each node, so the windows are as small as the tree."""
    total = leaves.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(share)).cast("long").alias("budget"))
    for depth, level in enumerate(LEVELS):
        path = list(LEVELS[: depth + 1])
        spent = F.lit(True)
        for below in LEVELS[depth + 1 :]:
            spent = spent & (_weight(below, weights) > 0)
        nodes = leaves.groupBy(*path).agg((F.sum(F.when(spent, F.col("tokens")).otherwise(0)) * max_epochs).alias("cap"))
        nodes = nodes.crossJoin(total) if not depth else nodes.join(above, path[:-1])  # total is one row
        above = _fill(nodes, path[:-1], level, weights).select(*path, "budget")
    return leaves.join(above, list(LEVELS))


def mix(docs: DataFrame, domain: Column, tokens: Column, share: float = 0.6, max_epochs: int = 2, seed: int = 3, weights: dict | None = None) -> DataFrame:
    """The chosen documents with ``__mix``: domain, lang, source, tokens and epoch (from 0).

    A document that is chosen in several epochs has a row for each.  The order of
    an epoch is md5(seed|epoch|doc_id); rows of one doc_id are taken together or
    not at all.  Null domains, languages and sources are one name each, '(none)'.
    Zero-token documents belong to the prefix that reaches their place.  An empty
    table gives an empty table.

    Prefixes are found in 256 ranges of the order, then in 256 of the range
    where the prefix ends, of which one a leaf is ranked row by row, so a leaf of
    a third of all rows is no hot task; texts are never shuffled if the table of
    leaves is below the broadcast threshold.  Columns of ``docs`` may have any
    names.
    """
    weights = WEIGHTS if weights is None else weights
    names = docs.columns
    leaf = [F.coalesce(c.cast("string"), F.lit("(none)")).alias(n) for n, c in zip(LEVELS, (domain, F.col("lang"), F.col("source")))]
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    slim = materialise(docs.select(key.alias("key"), *leaf, tokens.alias("tokens")), "tokens")
    leaves = materialise(slim.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "leaves")
    plan = leaf_budgets(leaves, share, max_epochs, weights)
    whole = F.coalesce(F.floor(F.col("budget") / F.nullif(F.col("tokens"), F.lit(0))), F.lit(0)).cast("long")
    plan = plan.withColumn("epochs", whole).withColumn("rest", F.col("budget") - whole * F.col("tokens"))
    plan = materialise(plan.select(*LEVELS, "epochs", "rest"), "budgets")

    turn = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epochs").cast("string"), F.col("key")).cast("binary"))
    ordered = slim.join(plan, list(LEVELS)).withColumn("turn", turn)
    cut = None  # the range of each leaf's order where its rest ends, and the tokens before it
    for digits in (2, 4):
        inside = ordered.withColumn("before", F.lit(0).cast("long"))
        if cut is not None:
            inside = ordered.withColumn("range", F.substring("turn", 1, digits - 2)).join(cut, [*LEVELS, "range"]).drop("range")
        ranges = inside.groupBy(*LEVELS, "rest", "before", F.substring("turn", 1, digits).alias("range")).agg(F.sum("tokens").alias("own"))
        upto = Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
        ranges = ranges.withColumn("upto", F.col("before") + F.sum("own").over(upto)).where(F.col("upto") > F.col("rest"))
        first = ranges.groupBy(*LEVELS).agg(F.min(F.struct("range", (F.col("upto") - F.col("own")).alias("before"))).alias("cut"))
        cut = materialise(first.select(*LEVELS, F.col("cut.range").alias("range"), F.col("cut.before").alias("before")), "cuts")
    ordered = ordered.withColumn("range", F.substring("turn", 1, 4))
    inside = ordered.join(cut, [*LEVELS, "range"])
    sofar = Window.partitionBy(*LEVELS).orderBy("turn").rangeBetween(Window.unboundedPreceding, 0)
    last = inside.withColumn("sofar", F.col("before") + F.sum("tokens").over(sofar)).where(F.col("sofar") <= F.col("rest"))
    last = last.groupBy(*LEVELS).agg(F.max("turn").alias("last"))
    table = plan.join(cut.select(*LEVELS, "range"), list(LEVELS), "left").join(last, list(LEVELS), "left")
    table = materialise(table.select(*(F.col(n).alias(f"__{n}") for n in LEVELS), F.col("epochs").alias("__epochs"), F.col("range").alias("__range"), F.col("last").alias("__last")), "mixture")

    tagged = docs.select(F.struct(*names).alias("__doc"), key.alias("__key"), *(c.alias(f"__{n}") for n, c in zip(LEVELS, leaf)), tokens.alias("__tokens"))
    turn = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("__epochs").cast("string"), F.col("__key")).cast("binary"))
    out = tagged.join(table, [f"__{n}" for n in LEVELS])
    # without a range to cut, the rest is all of an epoch of zero-token documents
    more = F.coalesce((turn < F.col("__range")) | (turn <= F.coalesce("__last", F.lit(""))), F.lit(False))
    out = out.withColumn("__n", F.col("__epochs") + more.cast("long")).where("__n > 0")
    out = out.withColumn("epoch", F.explode(F.expr("sequence(0L, __n - 1)")))
    return out.select(F.struct(*(F.col(f"__{n}").alias(n) for n in LEVELS), F.col("__tokens").alias("tokens"), "epoch").alias("__mix"), "__doc")


def op3_hierarchical_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mixed = mix(docs, domain_of(F.col("source")), words_of(F.col("text")))
    return mixed.select("__doc.doc_id", "__mix.domain", "__mix.lang", "__mix.source", "__mix.tokens", "__mix.epoch")


def mix_documents(spark, docs: DataFrame, share: float = 0.9, max_epochs: int = 2) -> DataFrame:
    """The chosen documents with their own columns, a row for each epoch."""
    return mix(docs, domain_of(F.col("source")), words_of(F.col("text")), share, max_epochs).select("__doc.*")


def _case(level: str) -> str:
    cases = " ".join(f"WHEN '{n}' THEN {w}" for n, w in WEIGHTS[level].items())
    return f"CAST(CASE {level} {cases} ELSE 1 END AS BIGINT)" if cases else "CAST(1 AS BIGINT)"


def _sql_fill(depth: int) -> str:
    level, path, parents = LEVELS[depth], ", ".join(LEVELS[: depth + 1]), ", ".join(LEVELS[:depth])
    part = f"PARTITION BY {parents}" if parents else ""
    above = f"JOIN f{depth - 1} USING ({parents})" if depth else "CROSS JOIN total"
    return f"""
n{depth} AS (SELECT *, cap / w AS ratio FROM (SELECT {path}, CAST(sum(tokens) * 2 AS BIGINT) AS cap, {_case(level)} AS w FROM leaves GROUP BY {path}) {above}),
r{depth} AS (SELECT *, (budget - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER ({part}) - coalesce(sum(w) OVER b, 0)) AS rise FROM n{depth}
  WINDOW b AS ({part} ORDER BY ratio, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f{depth} AS (SELECT {path}, CAST(least(cap, coalesce(floor(max(CASE WHEN rise <= ratio THEN rise END) OVER ({part}) * w), cap)) AS BIGINT) AS budget FROM r{depth}),"""


OP3_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
    CASE WHEN regexp_matches(coalesce(source, ''), '[0-3]$') THEN 'web' WHEN regexp_matches(coalesce(source, ''), '[456]$') THEN 'books' ELSE 'news' END AS domain,
    CAST(len(regexp_extract_all(coalesce(text, ''), '\S+')) AS BIGINT) AS tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(tokens) AS tokens FROM d GROUP BY ALL),
total AS (SELECT CAST(floor(coalesce(sum(tokens), 0) * CAST(0.6 AS DOUBLE)) AS BIGINT) AS budget FROM leaves),
{"".join(_sql_fill(i) for i in range(3))}
plan AS (SELECT domain, lang, source, coalesce(CAST(budget // nullif(tokens, 0) AS BIGINT), 0) AS epochs, budget - coalesce(CAST(budget // nullif(tokens, 0) AS BIGINT), 0) * tokens AS rest
    FROM leaves JOIN f2 USING (domain, lang, source)),
o AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('3|' || epochs || '|' || key) RANGE UNBOUNDED PRECEDING) AS sofar,
    sum(tokens) OVER (PARTITION BY domain, lang, source) AS whole FROM d JOIN plan USING (domain, lang, source)),
n AS (SELECT *, epochs + CASE WHEN sofar <= rest AND whole > rest THEN 1 ELSE 0 END AS n FROM o)
SELECT doc_id, domain, lang, source, tokens, CAST(unnest(range(0, n)) AS BIGINT) AS epoch FROM n WHERE n > 0
"""
