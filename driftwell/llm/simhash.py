"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints that may link share the bits of at least one *view* (a set of bit
places).  Each view's groups are sorted by Gray rank, runs of neighbours become
nodes that keep the bits all their members share, and the search descends pairs
of nodes while the accumulated differences of shared bits stay in the limit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.llm.components import components
from driftwell.llm.store import discard, materialise

FANOUT = 8
#: Pairs of nodes that are expanded at once.
FRONTIER = 16_384
#: Fingerprints of one key that one task searches; larger groups are cut into blocks.
GROUP_LIMIT = 50_000
#: Rows that a task gathers before it searches.
BATCH = 200_000
_BIT = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


# ---------------------------------------------------------------- fingerprints


def _majority(hashes: np.ndarray) -> np.ndarray:
    """Per bit of the rows of ``hashes`` (n, words): is it set in over half of them."""
    lanes = hashes.shape[1] * 8
    counts = np.zeros(lanes * 256, dtype=np.int64)
    place = np.arange(lanes, dtype=np.int64) * 256
    for at in range(0, len(hashes), 16_384):
        part = np.ascontiguousarray(hashes[at : at + 16_384]).view(np.uint8).reshape(-1, lanes)
        counts += np.bincount((part + place).ravel(), minlength=lanes * 256)
    ones = counts.reshape(lanes, 256) @ _BIT
    return np.packbits((2 * ones > len(hashes)).ravel(), bitorder="little").view("<u8")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _shingles(words: list[bytes], size: int) -> np.ndarray:
    """The hash of each run of ``size`` words, from the words' XXH64 values (seed 42)."""
    own = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(42)), dtype="<u8", count=len(words))
    n = len(words) - size + 1
    whole = np.zeros(n, dtype="<u8")
    with np.errstate(over="ignore"):
        for i in range(size):
            whole = _mix(whole + own[i : i + n] + np.uint64(i + 1))
    return whole


def _lanes(whole: np.ndarray, lanes: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.stack([_mix(whole + np.uint64((lane + 1) * 0x9E3779B97F4A7C15 % 2**64)) for lane in range(lanes)], axis=1)


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; one that is shorter is a single shingle."""
    words = _words(text)
    if not words:
        return np.zeros(0, dtype="<u8")
    size = min(shingle, len(words))
    return np.unique(_shingles(words, size) + np.uint64(0 if size == shingle else size))


def fingerprint(text: str | None, shingle: int, bits: int) -> str:
    """Hex digits of a text's SimHash; words are runs of anything but ASCII white space.

    64 bits hash the shingle's text by XXH64 (seed 42).  Wider fingerprints mix
    the words' XXH64 values, a lane for each 64 bits.  No word: zero.
    """
    words = _words(text)
    lanes = bits // 64
    if not words:
        return "0" * (bits // 4)
    size = min(shingle, len(words))
    if bits == 64:
        line = b" ".join(words)
        starts = [0, *accumulate(len(w) + 1 for w in words)]
        parts = []
        for at in range(0, len(words) - size + 1, 1 << 18):
            upto = min(at + (1 << 18), len(words) - size + 1)
            cut = (line[a : b - 1] for a, b in zip(starts[at:upto], starts[at + size : upto + size]))
            parts.append(np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(42)), dtype="<u8", count=upto - at))
        hashes = np.concatenate(parts)[:, None]
    else:
        hashes = _lanes(_shingles(words, size), lanes)
    return "".join(f"{int(w):016x}" for w in _majority(hashes)[::-1])


def sketch(text: str | None, shingle: int, bits: int) -> tuple[bytes, np.ndarray]:
    """A text's fingerprint from the words' values, as in ``fingerprint``, and its ``shingle_set``, hashed once."""
    words = _words(text)
    if not words:
        return bytes(bits // 8), np.zeros(0, dtype="<u8")
    size = min(shingle, len(words))
    whole = _shingles(words, size)
    code = _majority(_lanes(whole, bits // 64))
    return code[::-1].astype(">u8").tobytes(), np.unique(whole + np.uint64(0 if size == shingle else size))


def with_fingerprint(df: DataFrame, text_col: str, name: str, shingle: int = 5, bits: int = 64) -> DataFrame:
    """``df`` and its rows' fingerprints in a new column ``name``."""

    @F.pandas_udf("string")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle, bits) for t in texts], dtype=object)

    return df.withColumn(name, made(F.col(text_col)))


# ----------------------------------------------------------------------- views


def exact_views(bits: int, max_diff: int) -> list[list[int]]:
    """Bit places such that codes with ``max_diff`` or fewer differences agree on some view."""
    cuts = np.array_split(np.arange(bits), max_diff + 1)
    return [part.tolist() for part in cuts]


def sampled_views(bits: int, places: int, views: int, seed: int = 9) -> list[list[int]]:
    """Random sets of ``places`` bits.  Codes whose bits agree with probability p
    share one of them with probability 1 - (1 - p ** places) ** views."""
    rng = np.random.default_rng(seed)
    return [sorted(rng.choice(bits, places, replace=False).tolist()) for _ in range(views)]


# ----------------------------------------------------------------------- index


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Places of the codes (n, words, most significant word first) in the Gray sequence."""
    out, odd = np.empty_like(codes), np.zeros(len(codes), dtype=bool)
    for w in range(codes.shape[1]):
        x = codes[:, w].copy()
        for s in (1, 2, 4, 8, 16, 32):
            x ^= x >> np.uint64(s)
        out[:, w] = np.where(odd, ~x, x)
        odd = (out[:, w] & np.uint64(1)).astype(bool)
    return out


def _count(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int32)


def _settle(label: np.ndarray) -> None:
    while True:
        up = label[label]
        if np.array_equal(up, label):
            return
        label[:] = up


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        x, y = label[a], label[b]
        keep = x != y
        if not keep.any():
            return
        a, b, x, y = a[keep], b[keep], x[keep], y[keep]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        _settle(label)


class GrayIndex:
    """Nodes over codes that are sorted by (segment, Gray rank); a root for each segment."""

    def __init__(self, codes: np.ndarray, segment: np.ndarray):
        self.codes = codes
        first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        sizes = np.diff(np.r_[first, len(codes)])
        self.below: list[np.ndarray] = []  # of each level: where its nodes' members start, and the end
        self.starts = [np.arange(len(codes))]  # of each level: the first code of each node
        self.both, self.any = [codes], [codes]
        while sizes.max(initial=1) > 1:
            nodes = -(-sizes // FANOUT)
            inner = np.arange(nodes.sum()) - np.repeat(np.cumsum(nodes) - nodes, nodes)
            member = np.repeat(first, nodes) + inner * FANOUT
            self.below.append(np.r_[member, len(self.both[-1])])
            self.both.append(np.bitwise_and.reduceat(self.both[-1], member))
            self.any.append(np.bitwise_or.reduceat(self.any[-1], member))
            self.starts.append(self.starts[-1][member])
            first, sizes = np.cumsum(nodes) - nodes, nodes

    def nearest(self, max_diff: int) -> np.ndarray:
        """For each code the nearest other one that the search met within ``max_diff`` differences, else -1.

        Close ones are looked for first, and nodes that links have joined already
        are not compared again, so of a dense group each code meets a few."""
        near = np.full(len(self.codes), np.iinfo(np.int64).max)
        label = np.arange(len(self.codes))
        for limit in (max_diff // 2, max_diff):
            self.components(limit, label, near)
        return np.where(near == np.iinfo(np.int64).max, -1, near & ((1 << 40) - 1))

    def _meet(self, near: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        far = _count(self.codes[a] ^ self.codes[b]).astype(np.int64) << 40
        np.minimum.at(near, a, far | b)
        np.minimum.at(near, b, far | a)

    def components(self, max_diff: int, label: np.ndarray | None = None, near: np.ndarray | None = None) -> np.ndarray:
        """For each code the first one that links of ``max_diff`` or fewer differences reach."""
        label = np.arange(len(self.codes)) if label is None else label
        top = len(self.below)
        roots = np.arange(len(self.both[top]))
        stack = [(top, roots, roots)]
        while stack:
            level, a, b = stack.pop()
            if len(a) > FRONTIER:
                stack.append((level, a[FRONTIER:], b[FRONTIER:]))
                a, b = a[:FRONTIER], b[:FRONTIER]
            both, some = self.both[level], self.any[level]
            apart = (both[a] & ~some[b]) | (both[b] & ~some[a])  # shared by one, and the other shares the opposite
            keep = _count(apart) <= max_diff
            if level == 0:
                keep &= a != b
                a, b = a[keep], b[keep]
                if near is not None:
                    new = label[a] != label[b]
                    a, b = a[new], b[new]
                    self._meet(near, a, b)
                _unite(label, a, b)
                continue
            low = np.minimum.reduceat(label, self.starts[level])
            high = np.maximum.reduceat(label, self.starts[level])
            keep &= ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))  # all in one component already
            a, b = a[keep], b[keep]
            spread = (some[a] | some[b]) & ~(both[a] & both[b])
            close = _count(spread) <= max_diff  # any two of their codes link: no need to descend
            if close.any():
                for x, y in zip(a[close], b[close]):
                    ends = [np.arange(self.starts[level][n], self.starts[level][n + 1] if n + 1 < len(both) else len(label)) for n in (x, y)]
                    every = np.concatenate(ends)
                    if near is not None:
                        other = every[every != every[0]]
                        self._meet(near, other, np.full(len(other), every[0]))
                    _unite(label, every, np.full(len(every), every[0]))
                a, b = a[~close], b[~close]
            if not len(a):
                continue
            edge = self.below[level - 1]
            na, nb = edge[a + 1] - edge[a], edge[b + 1] - edge[b]
            total = na * nb
            row = np.repeat(np.arange(len(a)), total)
            at = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
            ca, cb = edge[a][row] + at // nb[row], edge[b][row] + at % nb[row]
            once = (a[row] != b[row]) | (ca <= cb)
            ca, cb = ca[once], cb[once]
            same = ca == cb
            if (~same).any():
                stack.append((level - 1, ca[~same], cb[~same]))
            if level > 1 and same.any():  # neighbours first: they spare the pairs between them
                stack.append((level - 1, ca[same], cb[same]))
        return label


def _codes(raw: pd.Series, bits: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), dtype=">u8").reshape(len(raw), bits // 64).astype(np.uint64)


def _search(bits: int, max_diff: int, nearest: bool):
    def links(held: pd.DataFrame) -> pd.DataFrame:
        keys = pd.factorize(pd.MultiIndex.from_frame(held[["slot", "part"]]))[0]
        many = np.bincount(keys)[keys] > 1
        held, keys = held["code"].to_numpy()[many], keys[many]
        if not len(held):
            return pd.DataFrame({"u": [], "v": []}, dtype=object)
        codes = _codes(held, bits)
        rank = gray_rank(codes)
        order = np.lexsort([*rank.T[::-1], keys])
        index = GrayIndex(codes[order], keys[order])
        other = index.nearest(max_diff) if nearest else index.components(max_diff)
        far = np.flatnonzero((other >= 0) & (other != np.arange(len(other))))
        return pd.DataFrame({"u": held[order[far]], "v": held[order[other[far]]]}, dtype=object).drop_duplicates()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0
        for frame in frames:
            held.append(frame)
            rows += len(frame)
            if rows < BATCH:
                continue
            whole = pd.concat(held, ignore_index=True)
            last = whole[["slot", "part"]].iloc[-1]
            open_ = (whole[["slot", "part"]] == last).all(axis=1).to_numpy()
            if not open_.all():
                yield links(whole[~open_])
            held = [whole[open_]]
            rows = len(held[0])
        if held:
            yield links(pd.concat(held, ignore_index=True))

    return run


def linked(codes: DataFrame, bits: int, max_diff: int, views: list[list[int]], nearest: bool = False) -> DataFrame:
    """Edges (u, v) between distinct ``codes`` (code, binary) at ``max_diff`` or fewer differences that share a view.

    They span each component of such links; if ``nearest``, each code has one to
    the nearest code that the search meets instead.  A slot (a view's key) with
    over ``GROUP_LIMIT`` codes is cut into blocks, and each pair of blocks is
    searched by a task of its own; which slots those are is read off a sample of
    the codes, and changes no link.
    """
    spark = codes.sparkSession

    @F.pandas_udf("array<long>")
    def keyed(raw: pd.Series) -> pd.Series:
        """A slot for each view's key.  Where it overflows, keys may share one: that only adds pairs to compare."""
        bit = np.unpackbits(_codes(raw, bits)[:, ::-1].copy().view(np.uint8), axis=1, bitorder="little") if len(raw) else np.zeros((0, bits))
        each = [bit[:, v].astype(np.int64) @ (1 << np.arange(len(v), dtype=np.int64)) * len(views) + i for i, v in enumerate(views)]
        return pd.Series(list(np.stack(each, axis=1)) if len(raw) else [], dtype=object)

    # a code is spread to every view, so its row is kept small: the bytes and one number
    spread = codes.select("code", F.explode(keyed("code")).alias("slot"))
    dealt, hot = spread.withColumn("part", F.lit(0).cast("long")), None
    if (n := codes.count()) > GROUP_LIMIT:
        one_in = min(50, n // GROUP_LIMIT)
        some = codes.where(F.pmod(F.xxhash64("code"), F.lit(one_in)) == 0).select(F.explode(keyed("code")).alias("slot"))
        many = some.groupBy("slot").count().where(F.col("count") * one_in > GROUP_LIMIT)
        hot = materialise(many.select("slot", F.ceil(F.col("count") * one_in / GROUP_LIMIT).cast("long").alias("blocks")), "hot")
        if not hot.isEmpty():
            dealt = (
                spread.join(hot, "slot", "left")
                .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
                .withColumn("own", F.pmod(F.xxhash64("code"), F.col("blocks")))
                .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
                .select("code", "slot", (F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).alias("part"))
            )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    together = dealt.repartition(tasks, "slot", "part").sortWithinPartitions("slot", "part")
    found = materialise(together.mapInPandas(_search(bits, max_diff, nearest), "u binary, v binary"), "links")
    if hot is not None:
        discard(hot)
    return found


def near_duplicates(df: DataFrame, text_col: str = "text", shingle: int = 5, bits: int = 64, max_diff: int = 3, views: list[list[int]] | None = None) -> DataFrame:
    """``df`` and two columns: ``fingerprint`` and ``group_fingerprint``, the least
    fingerprint of its component.

    A pair of texts links at ``max_diff`` or fewer differing bits.  The default
    views are exact: they find every link, whatever ``max_diff`` is, and take the
    longer the larger it is.  Views of ``sampled_views`` may miss links.

    Null and empty texts have the fingerprint zero, so they form one group.
    Repeated rows each keep their own row.  An empty table gives an empty table.
    Columns of ``df`` with those two names are replaced.
    """
    kept = df.drop("fingerprint", "group_fingerprint")
    rows = materialise(with_fingerprint(kept, text_col, "fingerprint", shingle, bits), "fingerprints")
    groups = _groups(rows, bits, max_diff, views)
    return rows.join(groups, "fingerprint", "left").withColumn("group_fingerprint", F.coalesce("group_fingerprint", "fingerprint"))


def _groups(rows: DataFrame, bits: int, max_diff: int, views: list[list[int]] | None) -> DataFrame:
    """(fingerprint, group_fingerprint) of the fingerprints of ``rows`` that have a link."""
    codes = materialise(rows.select(F.unhex("fingerprint").alias("code")).distinct(), "codes")
    edges = linked(codes, bits, max_diff, exact_views(bits, max_diff) if views is None else views)
    groups = components(edges).select(F.lower(F.hex("node")).alias("fingerprint"), F.lower(F.hex("component")).alias("group_fingerprint"))
    groups = materialise(groups, "groups")
    discard(codes)
    discard(edges)
    return groups


def op9_simhash_gray(spark, sf_dir: str) -> DataFrame:
    """The contract's fingerprints, and the least doc_id each document reaches by
    links of two or fewer bits.  A null doc_id keeps its row; a group of nulls
    only has a null component.

    Ids meet a fingerprint at a time, combined before the shuffle, and groups
    have a row for each fingerprint, so many copies are no hot group."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = materialise(with_fingerprint(docs, "text", "fingerprint", 3, 64).select("doc_id", "fingerprint"), "fingerprints")
    own = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    group = F.coalesce("group_fingerprint", "fingerprint")
    own = materialise(own.join(_groups(rows, 64, 2, None), "fingerprint", "left").select("fingerprint", "least", group.alias("group_fingerprint")), "groups")
    least = own.groupBy("group_fingerprint").agg(F.min("least").alias("component_id"))
    of = materialise(own.join(least, "group_fingerprint").select("fingerprint", "component_id"), "least")
    return rows.join(of, "fingerprint").select("doc_id", "fingerprint", "component_id")
