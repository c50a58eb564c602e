"""Near-duplicate groups of texts: SimHash links that are compared whole, and every link that they miss.

A text is its set of shingle hashes.  SimHash fingerprints and their Gray-order
index propose pairs; a pair is kept if its sets have a Jaccard similarity of the
limit or more.  What is left between the groups is found by a prefix filter over
the sets, so the groups are those of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.llm.components import components
from driftwell.llm.simhash import BATCH, linked, sampled_views, shingle_set, sketch
from driftwell.llm.store import discard, materialise, trim

#: Rows of a table of row numbers that is broadcast; a larger one is joined by a shuffle.
SMALL = 500_000
#: Rows with a common shingle that are paired at once; longer runs are paired by their sketches, cut into blocks.
RUN, BLOCK = 64, 4_000
#: Pairs that one step compares, and partners of a row that the first round of long runs tries.
PAIRS, PARTNERS = 200_000, 4
#: Texts whose common shingles are counted, and shingles that are told to workers.
HOT_SAMPLE, HOT_LIMIT = 5_000, 50_000
PARITY = 64
_SKETCH = "fingerprint binary, digest binary, size int, parity binary"


# -------------------------------------------------------------------- sketches


def parity(tokens: np.ndarray) -> bytes:
    """A bit for each hash slot: is the number of tokens in it odd.  Two sets differ
    in as many tokens at least as their parities do in bits.  The slots grow with the set."""
    slots = 8 * PARITY << max(0, int(len(tokens) - 1).bit_length() - 10)
    odd = np.bincount((tokens & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair of parities the least number of tokens that only one of the sets holds."""
    out = np.zeros(len(a), dtype=np.int64)
    size_a, size_b = (np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (a, b))
    kinds = size_a * (1 << 32) + size_b
    for kind in np.unique(kinds):
        at = np.flatnonzero(kinds == kind)
        width = int(min(size_a[at[0]], size_b[at[0]]))
        x, y = (np.bitwise_xor.reduce(np.frombuffer(b"".join(s[at]), dtype=np.uint8).reshape(len(at), -1, width), axis=1) for s in (a, b))  # a longer one is folded
        out[at] = np.bitwise_count(np.ascontiguousarray(x ^ y).view(np.uint64)).sum(axis=1)
    return out


def possible(size_a: np.ndarray, size_b: np.ndarray, apart: np.ndarray, least: float) -> np.ndarray:
    """May sets of these sizes that differ in ``apart`` tokens or more have a Jaccard similarity of ``least``."""
    return (np.minimum(size_a, size_b) >= least * np.maximum(size_a, size_b) - 1e-9) & (apart * (1 + least) <= (1 - least) * (size_a + size_b) + 1e-9)


def sketches(texts: pd.Series, shingle: int, bits: int) -> pd.DataFrame:
    made = []
    for text in texts:
        code, tokens = sketch(text, shingle, bits)
        made.append((code, xxhash.xxh3_128_digest(tokens.tobytes()), len(tokens), parity(tokens)))
    return pd.DataFrame(made, columns=["fingerprint", "digest", "size", "parity"])


# ---------------------------------------------------------------- verification


def _semi(df: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """``df`` with or without the rows of ``ids``; their number is checked before they are broadcast."""
    return df.join(F.broadcast(ids) if ids.count() <= SMALL else ids, key, how)


def verified(pairs: DataFrame, sole: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """Those of ``pairs`` (u, v) whose sets have a Jaccard similarity of ``least`` or more.

    ``sole``: row, size, parity; ``texts``: row, text.  Sizes and parities rule
    most pairs out; only the others' texts are moved, and compared whole.
    """

    @F.pandas_udf("boolean")
    def may(size_a: pd.Series, size_b: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(possible(size_a.to_numpy(), size_b.to_numpy(), least_apart(a.to_numpy(), b.to_numpy()), least), dtype=bool)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        for batch in batches:  # texts are taken one by one, so that few of them are held twice
            u, out, last, x = batch.column("u").to_numpy(), [], None, np.zeros(0)
            for i in range(len(u)):
                if u[i] != last:
                    last, x = u[i], shingle_set(batch.column("a")[i].as_py(), shingle)
                y = shingle_set(batch.column("b")[i].as_py(), shingle)
                both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(both >= least * (len(x) + len(y) - both) - 1e-9)
            yield batch.select(["u", "v"]).filter(pa.array(out, pa.bool_()))

    side = lambda c: sole.select(F.col("row").alias(c), F.col("size").alias(f"size_{c}"), F.col("parity").alias(f"parity_{c}"))
    some = pairs.join(side("u"), "u").join(side("v"), "v").where(may("size_u", "size_v", "parity_u", "parity_v"))
    some = materialise(some.select("u", "v"), "candidates")
    ids = some.select(F.col("u").alias("row")).unionByName(some.select(F.col("v").alias("row"))).distinct()
    met = _semi(texts, ids, "row")
    left = met.select(F.col("row").alias("u"), F.col("text").alias("a"))
    right = met.select(F.col("row").alias("v"), F.col("text").alias("b"))
    both = some.join(left, "u").join(right, "v").select("u", "v", "a", "b")
    out = materialise(both.mapInArrow(near, "u long, v long"), "verified")
    discard(some)
    return out


# -------------------------------------------------------------- what is missed


def _common(texts: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several of some ``HOT_SAMPLE`` texts hold, and how many do.  They only put
    shingles in order, common ones last: links are the same whatever is counted."""
    share = min(1.0, HOT_SAMPLE / max(1, texts.count()))
    some = texts.where(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text.as_py(), shingle).view("<i8"))], names=["token"])

    held = some.select("text").mapInArrow(each, "token long").groupBy("token").agg(F.count("*").alias("n")).where("n > 2")
    top = held.orderBy(F.desc("n"), "token").limit(HOT_LIMIT).collect()
    token = np.array([r["token"] for r in top], dtype="<i8").view("<u8")
    order = np.argsort(token)
    return token[order], np.array([r["n"] for r in top], dtype=np.int64)[order]


def prefix(tokens: np.ndarray, common: tuple[np.ndarray, np.ndarray], least: float) -> np.ndarray:
    """The rarest of a sorted set's tokens, so many that two sets of similarity ``least`` share one."""
    known, counts = common
    n = np.zeros(len(tokens), dtype=np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        n = np.where(known[at] == tokens, counts[at], 0)
    return tokens[np.lexsort((tokens, n))[: len(tokens) - int(np.ceil(least * len(tokens) - 1e-9)) + 1]]


def _runs(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted tokens: where each begins, and how many rows it has."""
    first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.zeros(0, dtype=np.int64)
    return first, np.diff(np.r_[first, len(token)])


def _nulls(n: int) -> pd.arrays.IntegerArray:
    return pd.arrays.IntegerArray(np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool))


def _by_token(each):
    """A function of frames in the order of ``token`` (and ``part``) that sees whole runs, ``BATCH`` rows or more at once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trim()
        held, rows = [], 0
        for frame in frames:
            held.append(frame)
            rows += len(frame)
            if rows < BATCH:
                continue
            whole = pd.concat(held, ignore_index=True)
            open_ = (whole["token"] == whole["token"].iloc[-1]).to_numpy()
            if not open_.all():
                yield from each(whole[~open_])
            held = [whole[open_]]
            rows = len(held[0])
        if rows:
            yield from each(pd.concat(held, ignore_index=True))

    return run


def _within(run: np.ndarray, size: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of one run whose sizes allow ``least``, some ``PAIRS`` at once; rows are in order of run and size."""
    upto = np.searchsorted((run << 32) + size, (run << 32) + np.floor(size / least + 1e-9).astype(np.int64), side="right")
    more = upto - np.arange(len(run)) - 1  # the others of its run that aren't too large
    last = np.flatnonzero(np.r_[run[1:] != run[:-1], True]) + 1 if len(run) else np.zeros(0, dtype=np.int64)
    ends, begin = np.cumsum(more), 0
    while begin < len(run):  # whole runs
        at = int(np.searchsorted(ends[last - 1], (ends[begin - 1] if begin else 0) + PAIRS, side="right"))
        stop = int(last[at - 1]) if at and last[at - 1] > begin else int(last[np.searchsorted(last, begin, side="right")])
        m = more[begin:stop]
        a = np.repeat(np.arange(begin, stop), m)
        yield a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(m) - m, m)
        begin = stop


def _mixed(x: np.ndarray) -> np.ndarray:
    """Hashes of row numbers (SplitMix64)."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _meetings(least: float):
    """Of rows that share a token, those that may reach ``least`` with one of a different component.

    A run makes no more rows than it has: its pairs (u, v), if they are no more
    than the rows in them, else a row (token, u, comp) for each of those.  Their
    ``token`` is a hash of the run's rows, so runs of the same rows are one (if
    hashes meet, more pairs are compared).  A longer run of several components is
    handed on by its own token, ``long``."""

    def each(held: pd.DataFrame) -> Iterator[pd.DataFrame]:
        held = held.sort_values(["token", "size"], kind="stable")
        token, own, size, at, comp = (held[c].to_numpy() for c in ("token", "row", "size", "at", "comp"))
        first, n = _runs(token)
        mixed = np.minimum.reduceat(comp, first) != np.maximum.reduceat(comp, first)
        long_ = np.repeat(mixed & (n > RUN), n)
        if long_.any():
            yield pd.DataFrame({"token": token[long_], "u": own[long_], "v": _nulls(long_.sum()), "comp": comp[long_], "long": True})
        short = np.repeat(mixed & (n <= RUN), n)
        run = np.repeat(np.arange(len(first)), n)[short]
        own, size, at, comp = own[short], size[short].astype(np.int64), at[short], comp[short]
        for a, b in _within(run, size, least):
            need = np.ceil(least / (1 + least) * (size[a] + size[b]) - 1e-9)
            keep = (comp[a] != comp[b]) & (np.minimum(size[a] - at[a], size[b] - at[b]) >= need)
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            low = run[a[0]]
            met = np.unique(np.r_[a, b])
            many = np.bincount(run[a] - low) > np.bincount(run[met] - low)  # more pairs than rows
            few = ~many[run[a] - low]
            u, v = own[a[few]], own[b[few]]
            if len(u):
                out = pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v)}).drop_duplicates()
                yield pd.DataFrame({"token": _nulls(len(out)), "u": out["u"].to_numpy(), "v": out["v"].to_numpy(), "comp": _nulls(len(out)), "long": False})
            met = met[many[run[met] - low]]
            if len(met):
                first_, n_ = _runs(run[met])
                same = np.repeat(np.add.reduceat(_mixed(own[met]), first_), n_).view(np.int64)
                out = pd.DataFrame({"token": same, "u": own[met], "comp": comp[met]}).drop_duplicates(["token", "u"])
                yield out.assign(v=_nulls(len(out)), long=False)[["token", "u", "v", "comp", "long"]]

    return _by_token(each)


def _short_runs(least: float):
    """Pairs (u, v) of different components in each run that sizes and parities allow."""

    def each(held: pd.DataFrame) -> Iterator[pd.DataFrame]:
        held = held.sort_values(["token", "size"], kind="stable")
        own, size, comp, bits = (held[c].to_numpy() for c in ("row", "size", "comp", "parity"))
        first, n = _runs(held["token"].to_numpy())
        size = size.astype(np.int64)
        for a, b in _within(np.repeat(np.arange(len(first)), n), size, least):
            keep = comp[a] != comp[b]
            pairs = pd.DataFrame({"a": a[keep], "b": b[keep], "u": np.minimum(own[a], own[b])[keep], "v": np.maximum(own[a], own[b])[keep]}).drop_duplicates(["u", "v"])
            a, b = pairs["a"].to_numpy(), pairs["b"].to_numpy()
            keep = possible(size[a], size[b], least_apart(bits[a], bits[b]), least)
            if keep.any():
                yield pairs.loc[keep, ["u", "v"]]

    return _by_token(each)


def _long_runs(least: float, partners: int | None):
    """Pairs of different components in each (token, part) that sizes and parities allow; of each row the ``partners`` nearest."""

    def each(held: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for _, run in held.groupby(["token", "part"], sort=False):
            own, size, comp, bits = (run[c].to_numpy() for c in ("row", "size", "comp", "parity"))
            _, which, n = np.unique(comp, return_inverse=True, return_counts=True)
            few = np.flatnonzero(which != n.argmax())  # rows outside the largest component meet all others
            step = max(1, PAIRS // len(own))
            for begin in range(0, len(few), step):
                a = np.repeat(few[begin : begin + step], len(own))
                b = np.tile(np.arange(len(own)), len(few[begin : begin + step]))
                keep = (comp[a] != comp[b]) & possible(size[a], size[b], np.zeros(len(a)), least)
                a, b = a[keep], b[keep]
                apart = least_apart(bits[a], bits[b])
                keep = possible(size[a], size[b], apart, least)
                a, b, apart = a[keep], b[keep], apart[keep]
                if partners is not None and len(a):
                    order = np.lexsort((apart, a))
                    a, b = a[order], b[order]
                    first, m = _runs(a)
                    near = np.arange(len(a)) - np.repeat(first, m) < partners
                    a, b = a[near], b[near]
                if len(a):
                    yield pd.DataFrame({"u": np.minimum(own[a], own[b]), "v": np.maximum(own[a], own[b])}).drop_duplicates()

    return _by_token(each)


def missed(sole: DataFrame, texts: DataFrame, links: DataFrame, shingle: int, least: float) -> DataFrame:
    """``links`` (u, v) and pairs that join the rest: together they have the components
    of all pairs of ``sole`` with a Jaccard similarity of ``least`` or more.

    Sets that similar share one of their rarest tokens (prefix filter).  Rows that
    do, of different components, and pass the filters by size and place and by
    parity, are compared whole.  A token's rows are handed on as rows, and paired
    beside their parities, wherever they have more pairs.  Long runs of a token are taken a block against a
    block; their first round tries each row's nearest partners, so that the second,
    over what is still apart, has few pairs that link.
    """
    joined = materialise(components(links).select(F.col("node").alias("row"), F.col("component").alias("comp")), "joined")
    common = texts.sparkSession.sparkContext.broadcast(_common(texts, shingle))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        for batch in batches:
            made, size = [], []
            for text in batch.column("text"):
                whole = shingle_set(text.as_py(), shingle)
                made.append(prefix(whole, common.value, least) if len(whole) else whole)
                size.append(len(whole))
            n = np.array([len(x) for x in made], dtype=np.int64)
            if not n.sum():
                continue
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            arrays = [np.concatenate(made).view("<i8"), *(np.repeat(batch.column(c).to_numpy(), n) for c in ("row", "comp")), np.repeat(size, n).astype(np.int32), at.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["token", "row", "comp", "size", "at"])

    of = F.broadcast(joined) if joined.count() <= SMALL else joined
    rows = texts.join(of, "row", "left").select("row", F.coalesce("comp", "row").alias("comp"), "text")
    rows = rows.mapInArrow(tokens, "token long, row long, comp long, size int, at int")
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = rows.repartition(tasks, "token").sortWithinPartitions("token")
    met = materialise(together.mapInPandas(_meetings(least), "token long, u long, v long, comp long, long boolean"), "met")
    traits = sole.select("row", "size", "parity")
    rows = met.where("token IS NOT NULL AND NOT long").select("token", F.col("u").alias("row"), "comp").distinct().join(traits, "row")
    rows = rows.repartition(tasks, "token").sortWithinPartitions("token")
    short = materialise(rows.mapInPandas(_short_runs(least), "u long, v long").distinct(), "short")
    pairs = met.where("token IS NULL").select("u", "v").unionByName(short).distinct()
    links = links.unionByName(verified(pairs, sole, texts, shingle, least))
    discard(short)

    runs = materialise(met.where("long").select("token", F.col("u").alias("row")).join(traits, "row"), "runs")
    discard(met)
    if not runs.isEmpty():
        blocks = materialise(runs.groupBy("token").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks")), "blocks")
        for partners in (PARTNERS, None):
            now = components(links).select(F.col("node").alias("row"), F.col("component").alias("comp"))
            dealt = runs.join(now, "row", "left").withColumn("comp", F.coalesce("comp", "row")).join(blocks, "token")
            dealt = dealt.withColumn("own", F.pmod(F.xxhash64("row"), F.col("blocks"))).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
            part = F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")
            dealt = dealt.select("token", part.alias("part"), "row", "size", "parity", "comp").repartition(tasks, "token", "part").sortWithinPartitions("token", "part")
            found = materialise(dealt.mapInPandas(_long_runs(least, partners), "u long, v long").distinct(), "long")
            links = materialise(links.unionByName(verified(found, sole, texts, shingle, least)), "linked")
            discard(found)
        discard(blocks)
    discard(runs)
    return links


# -------------------------------------------------------------------- the stage


def keep_one(spark, docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 5, least: float = 0.8, bits: int = 256, max_diff: int = 48, views: list[list[int]] | None = None) -> DataFrame:
    """One document of each near-duplicate group: the least id (null ones last), of equal ones any one.
    Columns stay as they are, whatever their names.

    Groups are the components of all pairs with a Jaccard similarity of ``least``
    or more of their sets of ``shingle`` words.  Null and empty texts are one
    group, and so are texts of equal sets; a text shorter than a shingle is one
    shingle.  SimHash links of ``max_diff`` or fewer bits are candidates, each
    compared whole (the default views are sampled: 40 of 16 bits); what they
    miss, ``missed`` finds.  An empty table gives an empty table.
    """
    names = docs.columns

    @F.pandas_udf(_SKETCH)
    def sketched(texts: pd.Series) -> pd.DataFrame:
        return sketches(texts, shingle, bits)

    inner = docs.select(F.struct(*names).alias("__doc"), F.monotonically_increasing_id().alias("__row"))
    rows = materialise(inner.withColumn("__s", sketched(F.col(f"__doc.`{text_col}`"))), "rows")
    slim = rows.select(F.col("__row").alias("row"), F.col(f"__doc.`{id_col}`").alias("key"), "__s.*")
    sole = slim.groupBy("digest").agg(F.min("row").alias("row"), *(F.min(c).alias(c) for c in ("fingerprint", "size", "parity")))
    sole = materialise(sole, "sets")
    copies = materialise(slim.select("row").join(sole.select("row"), "row", "left_anti"), "copies")
    texts = _semi(rows.select(F.col("__row").alias("row"), F.col(f"__doc.`{text_col}`").alias("text")), copies, "row", "left_anti")

    heads = materialise(sole.groupBy("fingerprint").agg(F.min("row").alias("head")), "heads")
    edges = linked(heads.select(F.col("fingerprint").alias("code")), bits, max_diff, sampled_views(bits, 16, 40) if views is None else views, nearest=True)
    head = lambda c: heads.select(F.col("fingerprint").alias(c), F.col("head").alias(f"{c}_row"))
    pairs = edges.join(head("u"), "u").join(head("v"), "v").select(F.least("u_row", "v_row").alias("u"), F.greatest("u_row", "v_row").alias("v"))
    pairs = pairs.unionByName(sole.join(heads, "fingerprint").where("row <> head").select(F.col("head").alias("u"), F.col("row").alias("v")))
    links = missed(sole, texts, verified(pairs.distinct(), sole, texts, shingle, least), shingle, least)

    groups = materialise(components(links).select(F.col("node").alias("row"), "component"), "groups")
    of = sole.join(groups, "row", "left").select("digest", F.coalesce("component", "row").alias("group"))
    best = slim.select("digest", "key", "row").groupBy("digest").agg(F.min(F.struct(F.col("key").isNull(), "key", "row")).alias("best"))
    best = best.join(of, "digest").groupBy("group").agg(F.min("best").alias("best")).select(F.col("best.row").alias("row"))
    gone = materialise(slim.select("row").join(best, "row", "left_anti").select(F.col("row").alias("__row")), "gone")
    return _semi(rows, gone, "__row", "left_anti").select("__doc.*")
