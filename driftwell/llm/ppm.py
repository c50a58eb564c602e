"""LM scoring by prediction by partial matching over bytes.

A text is coded as its tokens: each word's bytes and a space, then one end.  The
context trie holds what follows the last ``ORDER`` bytes in the training texts;
a byte not seen in a context escapes to the next shorter one, where the symbols of
the longer context are excluded.  How likely an escape is, is counted over the
whole trie: each training byte is left out once, and contexts with about as many
bytes and symbols share their counts.  The model is pretrained: a byte's code
length depends on its ``ORDER`` + 1 gram alone.

Documents are dealt into blocks.  A block sends its distinct words and grams
once, and gets back their counts and code lengths, so neither the vocabulary
nor the trie is ever whole in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.store import materialise, trim

ORDER = 5
SPAN = ORDER + 1
#: Characters of a block, and bytes that are counted and scored at once.
BLOCK_CHARS, CHUNK, SCORED = 16_000_000, 1_500_000, 500_000
#: Rows of one id and text, beyond which they are counted and scored as one.
COPIES = 1_000
PAD, GAP, END = b"\t", b" ", b"\n"  # white space never stands in a word
BYTES = 256
#: Groups that the trie is cut into, by the last two bytes of the contexts; the result doesn't hang on it.
GROUPS = 1_024
#: Steps of a context's bytes, and of its symbols, that escapes are counted by.
STEPS = 60


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def coded(words: list[bytes]) -> bytes:
    return _coded(GAP.join(words))


def _coded(text: bytes) -> bytes:
    return PAD * ORDER + text + (GAP if text else b"") + END


def grams(stream: bytes) -> np.ndarray:
    """The gram that ends at each byte of a stream of coded texts, but padding."""
    a = np.frombuffer(stream, dtype=np.uint8)
    out = np.zeros(len(a) - ORDER, dtype=np.int64)
    for i in range(SPAN):
        out <<= 8
        out |= a[i : len(a) - ORDER + i]
    return out[a[ORDER:] != PAD[0]]


def _chunks(blobs: pa.Array, least: int) -> Iterator[list[bytes]]:
    """The texts of ``blobs``, ``least`` bytes or more at once."""
    unpress = zstandard.ZstdDecompressor()
    held, size = [], 0
    for blob in blobs:
        held.append(unpress.decompress(blob.as_py()))
        size += len(held[-1]) + SPAN
        if size >= least:
            yield held
            held, size = [], 0
    if held:
        yield held


def _split(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of texts that single spaces part, in one array, and how many each text has."""
    lists = pc.split_pattern(pa.array(texts, pa.binary()), pattern=b" ")
    n = lists.value_lengths().to_numpy()
    flat = lists.flatten()
    if b"" in texts:  # an empty text has no word
        flat = flat.filter(pc.not_equal(pc.binary_length(flat), 0))
        n = np.where([not t for t in texts], 0, n)
    return flat, n


def _sum(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], (np.add.reduceat(n, first) if len(keys) else n)


# ------------------------------------------------------------------- the model


def _of(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(asked))
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0.0)


def _totals(contexts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted contexts: each once, the sum of ``n`` and the number of its symbols."""
    first = np.flatnonzero(np.r_[True, contexts[1:] != contexts[:-1]]) if len(contexts) else np.zeros(0, dtype=np.int64)
    sums = np.add.reduceat(n, first) if len(contexts) else n
    return contexts[first], sums.astype(float), np.diff(np.r_[first, len(contexts)]).astype(float)


def _class(total: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The class of contexts by their bytes and symbols, three steps a doubling."""
    step = lambda x: np.minimum((3 * np.log2(np.maximum(x, 1))).astype(np.int64), STEPS - 1)
    return step(total) * STEPS + step(symbols)


class Trie:
    """The levels of the grams whose last two context bytes are any that ``trained`` has.

    ``pairs``: (256, 256) counts of all byte pairs.
    """

    def __init__(self, trained: np.ndarray, counts: np.ndarray, pairs: np.ndarray):
        self.levels = {SPAN: _sum(trained.astype(np.int64), counts.astype(np.int64))}
        for size in range(SPAN - 1, 2, -1):
            self.levels[size] = _sum(self.levels[size + 1][0] & ((1 << 8 * size) - 1), self.levels[size + 1][1])
        some = np.flatnonzero(pairs.ravel())
        self.levels[2] = (some, pairs.ravel()[some])
        single = pairs.sum(axis=0)
        self.levels[1] = (np.flatnonzero(single), single[single > 0])
        self.unseen = max(1, BYTES - np.count_nonzero(single))
        self.contexts = {size: _totals(keys >> 8, n) for size, (keys, n) in self.levels.items()}
        self.left_out = {}  # of each longer context: what its symbols count in the shorter one, and how many they are
        for size in range(1, SPAN):
            longer = self.levels[size + 1][0]
            self.left_out[size] = _totals(longer >> 8, _of(*self.levels[size], longer & ((1 << 8 * size) - 1)))

    def of(self, size: int, gram: np.ndarray, above: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the context of each gram of ``size`` bytes: its bytes and symbols without those
        of the longer context ``above``, and the count of the gram."""
        contexts, total, symbols = self.contexts[size]
        t, d = _of(contexts, total, gram >> 8), _of(contexts, symbols, gram >> 8)
        if above is not None:
            longer, out_total, out_symbols = self.left_out[size]
            t, d = t - _of(longer, out_total, above), d - _of(longer, out_symbols, above)
        return t, d, _of(*self.levels[size], gram)

    def escapes(self, size: int) -> np.ndarray:
        """(escapes, bytes) of each class at this size, over the training bytes that came so far when left out."""
        if size == SPAN:
            gram, times = self.levels[SPAN]
            t, d, own = self.of(SPAN, gram, None)
        else:  # what came once in the longer context escapes from it
            keys, n = self.levels[size + 1]
            once = keys[n == 1]
            gram, times = once & ((1 << 8 * size) - 1), np.ones(len(once))
            t, d, own = self.of(size, gram, once >> 8)
            t, d = t + own, d + 1  # it is not left out there, now that the longer context lacks it
        t, d = t - 1, d - (own == 1)
        some = t > 0
        kind = _class(t[some], d[some])
        return np.stack([np.bincount(kind, weights=(times * w)[some], minlength=STEPS**2) for w in (own == 1, own > 0)])

    def code_lengths(self, asked: np.ndarray, escapes: dict[int, np.ndarray]) -> np.ndarray:
        """log10 probability of the last byte of each ``asked`` gram after the others."""
        out, done = np.zeros(len(asked)), np.zeros(len(asked), dtype=bool)
        for size in range(SPAN, 0, -1):
            gram = asked & ((1 << 8 * size) - 1)
            above = (asked & ((1 << 8 * (size + 1)) - 1)) >> 8 if size < SPAN else None
            t, d, own = self.of(size, gram, above)
            left = ~done & (t > 0)
            safe = np.where(t > 0, t, 1)
            gone, all_ = escapes[size][:, _class(safe, d)]
            escape = np.clip((gone + np.clip(d / 2 / safe, 0.01, 0.99)) / (all_ + 1), 1e-4, 1 - 1e-4)  # one byte's worth of method D
            hit = left & (own > 0)
            out += np.where(hit, np.log10(np.where(hit, own / safe * (1 - escape), 1)), 0)
            out += np.where(left & (own == 0), np.log10(escape), 0)
            done |= hit
        return np.where(done, out, out - np.log10(self.unseen))


# --------------------------------------------------------------------- queries


def _once(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``docs`` (id, text, train) with ``times``, and whether any row is repeated.

    Rows of one id and text that come over ``COPIES`` times are one row, combined
    before they are shuffled, so that they don't fill a block; others stay as they are."""
    key = F.xxhash64("id", "text")
    many = materialise(docs.groupBy(key.alias("key")).agg(F.count("*").alias("n")).where(F.col("n") > COPIES).select("key"), "copies")
    n = many.count()
    if not n:
        return docs.withColumn("times", F.lit(1).cast("long")), False
    if n <= 500_000:
        many = F.broadcast(many)
    keyed = docs.withColumn("key", key)
    alone = keyed.join(many, "key", "left_anti").select("id", "text", "train", F.lit(1).cast("long").alias("times"))
    copied = keyed.join(many, "key", "left_semi").groupBy("id", "text", "train").agg(F.count("*").alias("times"))
    return alone.unionByName(copied), True


def _packed(docs: DataFrame, blocks: int) -> DataFrame:
    """(block, id, train, times, blob): the words of each text, compressed for the shuffle."""

    @F.pandas_udf("binary")
    def pack(texts: pd.Series) -> pd.Series:
        press = zstandard.ZstdCompressor(level=1)
        return pd.Series([press.compress(b" ".join(words_of(t))) for t in texts], dtype=object)

    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int")
    return docs.select(block.alias("block"), "id", "train", "times", pack("text").alias("blob"))


def _gather(block: pa.Table) -> pa.Table:
    """A block's distinct words and grams, and how often its training texts have them."""
    trim()
    weight = block.column("times").to_numpy() * block.column("train").to_numpy()
    counted = []
    found = [np.zeros(0, dtype=np.int64)] * 2
    for w in np.unique(weight):  # 0 for texts that are only scored, mostly 1 for the others
        for texts in _chunks(block.column("blob").filter(pa.array(weight == w)), CHUNK):
            each = _split(texts)[0].value_counts()
            counted.append(pa.table({"word": each.field("values"), "n": pa.array(each.field("counts").to_numpy() * w)}))
            keys, n = np.unique(grams(b"".join(map(_coded, texts))), return_counts=True)
            found = list(_sum(np.r_[found[0], keys], np.r_[found[1], n * w]))
    words = pa.concat_tables(counted).group_by("word", use_threads=False).aggregate([("n", "sum")])
    n = np.r_[words.column("n_sum").to_numpy(), found[1]]
    own = np.r_[np.full(len(words), -1), found[0]]
    words = pa.concat_arrays([words.column("word").combine_chunks(), pa.nulls(len(found[0]), pa.binary())])
    number = np.full(len(own), block.column("block")[0].as_py(), dtype=np.int32)
    return pa.table({"block": number, "word": words, "gram": own, "n": n})


def _score(block: pa.Table, slices: pa.Table) -> pa.Table:
    """Of a block's documents: words, known ones, sum of log10(count + 1) and log10 probability."""
    trim()
    keys, value = slices.column("gram").to_numpy(), slices.column("value").to_numpy()
    is_word = keys < 0
    words = slices.column("word").filter(pa.array(is_word)).combine_chunks()
    logs = np.log10(value[is_word] + 1)
    keys, lengths = keys[~is_word], value[~is_word]
    order = np.argsort(keys)
    keys, lengths = keys[order], lengths[order]
    del order, value, is_word
    count, known, base, score = [], [], [], []
    for texts in _chunks(block.column("blob"), 2 * CHUNK):
        flat, n = _split(texts)
        each, of = logs[pc.index_in(flat, value_set=words).to_numpy(zero_copy_only=False)], np.repeat(np.arange(len(n)), n)
        count.append(n)
        known.append(np.bincount(of, weights=each > 0, minlength=len(n)).astype(np.int64))
        base.append(np.bincount(of, weights=each, minlength=len(n)))
    del words, logs
    for texts in _chunks(block.column("blob"), SCORED):
        asked = grams(b"".join(map(_coded, texts)))
        order = np.argsort(asked)  # sorted questions find their places near each other
        each = np.empty(len(asked))
        each[order] = lengths[np.searchsorted(keys, asked[order])]
        size = np.fromiter((len(t) + (2 if t else 1) for t in texts), dtype=np.int64, count=len(texts))
        score.append(np.add.reduceat(each, np.cumsum(size) - size))
    columns = (np.concatenate(x) for x in (count, known, base, score))
    names = (("words", pa.int64()), ("known", pa.int64()), ("logs", pa.float64()), ("score", pa.float64()))
    return pa.table({"id": block.column("id"), "times": block.column("times")} | {k: pa.array(c, t) for (k, t), c in zip(names, columns)})


def score_corpus(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, train, n_tokens, n_known, train_tokens, base_score, score) of each row of ``docs``.

    ``train`` tells the rows whose texts the model learns from (null: true).
    ``score`` is the model's log10 probability of the row's tokens, ``base_score``
    that of the add-one unigram model.  Null and empty texts are the end alone.
    Repeated rows are learnt from and scored each.  Without a training row all
    bytes are as likely.  Texts are coded whole, whatever their length.
    """
    size = docs.agg(F.sum(F.length(text_col)).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // BLOCK_CHARS))
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    rows, copied = _once(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(True)).alias("train")))
    packed = _packed(rows, blocks)
    counted = materialise(packed.groupBy("block").applyInArrow(_gather, "block int, word binary, gram long, n long"), "counts")
    own_words, own_grams = counted.where("gram < 0"), counted.where("gram >= 0")

    by_word = Window.partitionBy("word")
    words = own_words.withColumn("value", F.sum("n").over(by_word)).withColumn("first", F.row_number().over(by_word.orderBy("block")) == 1)
    words = materialise(words.select("block", "word", "value", "first"), "words")
    ends = docs.agg(F.count(F.when(F.coalesce(train, F.lit(True)), 1)).alias("n")).first()["n"]
    row = words.where("first").agg(F.sum("value").alias("n"), F.count(F.when(F.col("value") > 0, 1)).alias("v")).first()
    tokens, kinds = (row["n"] or 0) + ends, row["v"] + (ends > 0)

    totals = materialise(own_grams.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    pairs = np.zeros((BYTES, BYTES), dtype=np.int64)  # 65,536 sums at most reach the driver
    for r in totals.where("n > 0").groupBy(F.col("gram").bitwiseAND(0xFFFF).alias("pair")).agg(F.sum("n").alias("n")).collect():
        pairs[r["pair"] >> 8, r["pair"] & 255] = r["n"]
    held = docs.sparkSession.sparkContext.broadcast(pairs)
    suffix = F.shiftright("gram", 8).bitwiseAND(0xFFFF)  # contexts that end alike stay together
    by_suffix = totals.withColumn("part", F.pmod(F.xxhash64(suffix), F.lit(GROUPS))).groupBy("part")

    def left_out(part: pd.DataFrame) -> pd.DataFrame:
        part = part[part["n"] > 0]
        trie = Trie(part["gram"].to_numpy(), part["n"].to_numpy(), held.value)
        rows = [(size, at, *each[:, at]) for size in range(SPAN, 1, -1) for each in [trie.escapes(size)] for at in np.flatnonzero(each[1])]
        return pd.DataFrame(rows, columns=["size", "kind", "gone", "all"])

    escapes = {size: np.zeros((2, STEPS**2)) for size in range(1, SPAN + 1)}  # a few thousand sums
    escapes[1] = Trie(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), pairs).escapes(1)
    for r in by_suffix.applyInPandas(left_out, "size int, kind int, gone double, all double").groupBy("size", "kind").agg(F.sum("gone").alias("gone"), F.sum("all").alias("all")).collect():
        escapes[r["size"]][:, r["kind"]] = r["gone"], r["all"]
    known = docs.sparkSession.sparkContext.broadcast(escapes)

    def model(part: pd.DataFrame) -> pd.DataFrame:
        gram, n = part["gram"].to_numpy(), part["n"].to_numpy()
        return pd.DataFrame({"gram": gram, "value": Trie(gram[n > 0], n[n > 0], held.value).code_lengths(gram, known.value)})

    lengths = materialise(by_suffix.applyInPandas(model, "gram long, value double"), "code-lengths")
    back = own_grams.select("block", "gram").join(lengths, "gram").select("block", F.lit(None).cast("binary").alias("word"), "gram", "value")
    slices = back.unionByName(words.select("block", "word", F.lit(-1).cast("long").alias("gram"), F.col("value").cast("double").alias("value")))

    scored = packed.groupBy("block").cogroup(slices.groupBy("block")).applyInArrow(_score, f"id {kind}, times long, words long, known long, logs double, score double")
    if copied:
        scored = scored.withColumn("one", F.explode(F.expr("sequence(1L, times)")))
    end_known, end_log = int(ends > 0), float(np.log10(ends + 1))
    down = float(np.log10(tokens + kinds + 1))
    return scored.select(
        F.col("id").alias(id_col),
        (F.col("words") + 1).alias("n_tokens"),
        (F.col("known") + end_known).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + end_log - (F.col("words") + 1) * down).alias("base_score"),
        "score",
    )


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def op2_ppm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = score_corpus(docs, ~held_out(F.col("doc_id")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
