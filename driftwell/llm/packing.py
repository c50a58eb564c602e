"""Best-fit packing of documents into sequences by bin completion.

The lengths of all pieces are integers of 1 to ``capacity``, so the whole
problem is a histogram of at most ``capacity`` counts.  It is solved once, on
the driver, as patterns with repeat counts; each piece then finds its place
from its rank among the pieces of its length.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.store import materialise

#: The split pattern of byte-level BPE vocabularies.
BYTE_LEVEL_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words whose ids a worker remembers; the memory is emptied when it is full.
REMEMBERED = 300_000
Pattern = tuple[tuple[int, int], ...]  # (length, copies), the largest length first


# ------------------------------------------------------------------- token ids


class Encoder:
    """Little-endian 32-bit ids of texts under a byte-level BPE vocabulary of the tokenizers library."""

    held: dict[str, Encoder] = {}

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in plain)}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(map(shown.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.bpe = tiktoken.Encoding("own", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.merge = self.bpe._core_bpe.encode_ordinary
        self.memory: dict[str, bytes] = {}
        self.apart = re.compile(r"\s ").search
        self.added = {t["content"]: np.array([t["id"]], dtype="<u4").tobytes() for t in spec["added_tokens"]}
        if any(t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that are matched as words, stripped or normalized")
        self.at_added = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls.held:
            cls.held[path] = cls(path)
        return cls.held[path]

    def whole(self, text: str) -> bytes:
        try:
            ids = array("I", self.merge(text))
        except UnicodeEncodeError:  # lone surrogates
            ids = array("I", self.bpe.encode_ordinary(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def ids(self, text: str) -> bytes:
        """The split pattern never joins what a space parts, if no white space precedes
        the space; then words are encoded one by one, most of them from memory."""
        if self.apart(text) or text[:1] == " ":
            return self.whole(text)
        first, *words = text.split(" ")
        memory, out = self.memory, [self.whole(first)]
        for word in words:
            got = memory.get(word)
            if got is None:
                if len(memory) >= REMEMBERED:
                    memory.clear()
                got = self.whole(" " + word)
                if len(word) < 64:
                    memory[word] = got
            out.append(got)
        return b"".join(out)

    def library_ids(self, text: str) -> bytes:
        """The ids that the library gives by default: added tokens, such as special ones, are cut
        out of the text first, and the parts between them are ordinary text."""
        if self.at_added is None or not self.at_added.search(text):
            return self.ids(text)
        out, at = [], 0
        for m in self.at_added.finditer(text):
            out += [self.ids(text[at : m.start()]), self.added[m.group()]]
            at = m.end()
        return b"".join([*out, self.ids(text[at:])])


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, end: int = 0) -> DataFrame:
    """Rows (id, piece, start, length, ids_crc32, and ids if asked) of each document.

    A document is its ids and then ``end``; null text counts as empty, so it is
    ``end`` alone.  If it is longer than ``capacity``, it is cut so that only
    the first piece may be shorter.  Repeated rows are packed each, ids of any
    type are kept as they are, null ones too.
    """
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    last = np.array([end], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        for batch in batches:
            rows, parts = [], []
            for at_row, text in enumerate(batch.column(1).to_pylist()):
                raw = encoder.library_ids(text or "") + last
                n = len(raw) // 4
                at, piece = 0, 0
                while at < n:
                    size = (n - 1) % capacity + 1 if at == 0 else capacity
                    part = raw[4 * at : 4 * (at + size)]
                    rows.append((at_row, piece, at, size, zlib.crc32(part)))
                    if with_ids:
                        parts.append(np.frombuffer(part, dtype="<i4"))
                    at, piece = at + size, piece + 1
            owner, *columns = (np.array(c) for c in zip(*rows)) if rows else [np.zeros(0, dtype=np.int64)] * 5
            out = [batch.column(0).take(pa.array(owner, pa.int64()))]
            out += [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            if with_ids:
                out.append(pa.array(parts, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(out, names=["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(cut, schema).withColumnRenamed("id", id_col)


# ---------------------------------------------------------------- the solution


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over a histogram: equal bins are filled at once."""
    open_: dict[int, list[tuple[Pattern, int]]] = {}
    free = np.zeros(capacity + 1, dtype=bool)

    def add(room: int, pattern: Pattern, bins: int) -> None:
        if bins:
            open_.setdefault(room, []).append((pattern, bins))
            free[room] = True

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fits = np.flatnonzero(free[length:])
            if not len(fits):
                each = capacity // length
                add(capacity - each * length, ((length, each),), left // each)
                if left % each:
                    add(capacity - left % each * length, ((length, left % each),), 1)
                break
            room = int(fits[0]) + length
            pattern, bins = open_[room].pop()
            free[room] = bool(open_[room])
            each = room // length
            full = min(bins, left // each)
            add(room - each * length, (*pattern, (length, each)), full)
            left -= full * each
            if full < bins:
                if left:  # fewer than one bin's worth
                    add(room - left * length, (*pattern, (length, left)), 1)
                    full, left = full + 1, 0
                add(room, pattern, bins - full)
    return [x for each in open_.values() for x in each]


def _least_bins(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer bins: the filled volume, and what large lengths waste (Martello and Toth's L2)."""
    if not counts:
        return 0
    x = np.array(sorted(counts), dtype=np.int64)
    n = np.array([counts[int(v)] for v in x], dtype=np.int64)
    number, volume = np.r_[0, np.cumsum(n)], np.r_[0, np.cumsum(n * x)]  # of the lengths before a place
    small = np.r_[0, x[2 * x <= capacity]]
    middle = np.searchsorted(x, capacity // 2, side="right")
    large = np.maximum(np.searchsorted(x, capacity - small, side="right"), middle)
    over = volume[middle] - volume[np.searchsorted(x, small)] - ((large > middle) * (capacity * (number[large] - number[middle]) - (volume[large] - volume[middle])))
    bins = number[-1] - number[middle] + np.maximum(0, -(-over // capacity))
    return int(max(-(-volume[-1] // capacity), bins.max()))


def fillings(counts: dict[int, int], room: int, effort: int, every: bool = False) -> tuple[list[tuple[int, Pattern]], bool]:
    """Undominated ways (waste, filling) to use ``room``, the least waste first, and whether they are all.

    A filling is dominated if a length that is left fits beside it, could stand
    in for one of its lengths with less waste, or for two of them.  ``effort``
    bounds the steps of the enumeration; unless ``every``, it ends at the first
    filling without waste.
    """
    lengths = np.array(sorted((x for x in counts if x <= room and counts[x]), reverse=True), dtype=np.int64)
    found: dict[Pattern, int] = {}
    used: dict[int, int] = {}

    def spare(low: int, high: int) -> bool:
        at = np.searchsorted(-lengths, -high)
        while at < len(lengths) and lengths[at] >= low:
            if counts[int(lengths[at])] > used.get(int(lengths[at]), 0):
                return True
            at += 1
        return False

    def dominated(waste: int) -> bool:
        if spare(1, waste):
            return True
        mine = sorted(used)
        if any(spare(x + 1, x + waste) for x in mine):
            return True
        return any(spare(x + y, x + y + waste) for i, x in enumerate(mine) for y in mine[i + (used[x] < 2) :])

    path: list[int] = []
    stack = [[0, room, 0]]  # from which length on, room left, lengths tried below
    steps = 0
    while stack:
        at, left, tried = frame = stack[-1]
        at = max(at, int(np.searchsorted(-lengths, -left)))
        while at < len(lengths) and used.get(int(lengths[at]), 0) >= counts[int(lengths[at])]:
            at += 1
        if at < len(lengths):
            steps += 1
            if steps > effort:
                break
            x = int(lengths[at])
            frame[0], frame[2] = at + 1, tried + 1
            used[x] = used.get(x, 0) + 1
            path.append(x)
            stack.append([at, left - x, 0])
            continue
        if not tried and not dominated(left):
            found[tuple(sorted(used.items(), reverse=True))] = left
            if not left and not every:
                break
        stack.pop()
        if path:
            x = path.pop()
            used[x] -= 1
            if not used[x]:
                del used[x]
    whole = not stack
    if not found:  # cut before the first end: the greedy one
        left, greedy = room, {}
        for x in map(int, lengths):
            if n := min(counts[x], left // x):
                greedy[x], left = n, left - n * x
        found[tuple(greedy.items())] = left
    return sorted((waste, filling) for filling, waste in found.items()), whole


def solve(counts: dict[int, int], capacity: int, nodes: int = 150, effort: int = 2_000, branches: int = 3, exact_nodes: int = 300) -> tuple[list[tuple[Pattern, int]], int, bool]:
    """Patterns and how many sequences each fills, a lower bound of the sequences, and whether no packing has fewer.

    Branch and bound: around the largest length left, each undominated filling
    is a branch.  Best fit completes every node as an incumbent; a branch ends
    where its waste is more than a better packing can have.  It stops where the
    incumbent meets the lower bound.  At first the ``branches`` best fillings
    are used as often as their lengths last (``nodes`` nodes); what gap is left
    is searched one sequence at a time with every filling (``exact_nodes``
    nodes).  The result is never worse than best fit, and is proven the least
    if it meets the bound or that search came to its end.
    """
    counts = {int(x): int(n) for x, n in counts.items() if n}
    best = best_fit(counts, capacity)
    size = sum(n for _, n in best)
    least, total = _least_bins(counts, capacity), sum(x * n for x, n in counts.items())
    for every, budget in ((False, nodes), (True, exact_nodes)):
        whole = every
        seen: dict[bytes, int] = {}
        stack: list[tuple[tuple | None, int, int]] = [(None, 0, 0)]  # (pattern, times, the sequences before), how many, their waste
        while stack and size > least:
            if not budget:
                whole = False
                break
            budget -= 1
            chain, bins, waste = stack.pop()
            if waste > (size - 1) * capacity - total:
                continue
            left, done, at = dict(counts), [], chain
            while at:
                done.append(at[:2])
                for x, n in at[0]:
                    left[x] -= n * at[1]
                at = at[2]
            left = {x: n for x, n in left.items() if n}
            key = hashlib.blake2b(np.array(sorted(left.items()), dtype=np.int64).tobytes(), digest_size=16).digest()
            if seen.get(key, bins + 1) <= bins:  # the same pieces were left by as few sequences
                continue
            seen[key] = bins
            if done:
                rest = best_fit(left, capacity)
                if bins + sum(n for _, n in rest) < size:
                    best, size = done + rest, bins + sum(n for _, n in rest)
            if not left or bins + _least_bins(left, capacity) >= size:
                continue
            top = max(left)
            made, all_ = fillings({**left, top: left[top] - 1}, capacity - top, effort, every)
            whole = whole and all_
            for lost, filling in reversed(made if every else made[:branches]):
                use = dict(filling)
                use[top] = use.get(top, 0) + 1
                times = 1 if every else min(left[x] // n for x, n in use.items())
                stack.append(((tuple(sorted(use.items(), reverse=True)), times, chain), bins + times, waste + lost * times))
        if whole or size <= least:
            return best, least, True
    return best, least, False


def bin_completion(counts: dict[int, int], capacity: int, **search) -> list[tuple[Pattern, int]]:
    """The patterns of ``solve`` alone."""
    return solve(counts, capacity, **search)[0]


def _places(patterns: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """Runs of equal pieces: from which rank on, in which sequence, copies a sequence, first offset."""
    rows, taken, sequence = [], {}, 0
    for pattern, times in patterns:
        offset = 0
        for length, copies in pattern:
            rows.append((length, taken.get(length, 0), sequence, copies, offset))
            taken[length] = taken.get(length, 0) + copies * times
            offset += copies * length
        sequence += times
    rows.sort()
    names = ("length", "rank", "sequence", "copies", "offset")
    return {k: np.array([r[i] for r in rows], dtype=np.int64) for i, k in enumerate(names)}


def pack(pieces: DataFrame, capacity: int, **search) -> DataFrame:
    """``pieces`` and the columns ``sequence_id``, ``offset``, ``least_sequences``
    (no packing has fewer) and ``proven`` (no packing has fewer than this one).

    Only the histogram of lengths (at most ``capacity`` counts) reaches the
    driver, and only its patterns the workers.  A length that very many pieces
    share is ranked part by part, so no task holds it whole.  An empty table
    gives an empty table; columns with those names are replaced, and columns
    that begin with two underscores are not to be given.
    """
    pieces = pieces.drop("sequence_id", "offset", "least_sequences", "proven")
    names = pieces.columns
    kept = materialise(pieces.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()), "pieces")
    spread = kept.groupBy("length", "__part").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    spread = materialise(spread.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))), "lengths")
    counts = {r["length"]: r["n"] for r in spread.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError(f"lengths must be 1 to {capacity}")
    patterns, least, proven = solve(counts, capacity, **search)
    place = _places(patterns)
    held = pieces.sparkSession.sparkContext.broadcast(place)

    @F.pandas_udf("sequence_id long, offset long")
    def put(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        p = held.value
        far = 1 << 44
        at = np.searchsorted(p["length"] * far + p["rank"], length.to_numpy() * far + rank.to_numpy(), side="right") - 1
        nth = rank.to_numpy() - p["rank"][at]
        return pd.DataFrame({"sequence_id": p["sequence"][at] + nth // p["copies"][at], "offset": p["offset"][at] + nth % p["copies"][at] * length.to_numpy()})

    own = F.row_number().over(Window.partitionBy("length", "__part").orderBy("__at")) - 1
    ranked = kept.join(spread.select("length", "__part", "__before"), ["length", "__part"]).withColumn("__rank", F.col("__before") + own)
    return ranked.withColumn("__put", put("length", "__rank")).select(*names, "__put.sequence_id", "__put.offset", F.lit(least).cast("long").alias("least_sequences"), F.lit(proven).alias("proven"))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, from packed pieces that carry ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = 2048, **search) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return pack(token_pieces(docs, tokenizer, capacity), capacity, **search)


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in the sequences of 2048 tokens."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
