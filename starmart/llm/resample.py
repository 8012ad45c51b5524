"""Target-distribution importance resampling (operator 11).

Documents are drawn so that their words resemble a target text's. A pre-tokeniser of the
tokenizers library (an untrained regex Split) over the ASCII-lowered text returns words
with their offsets; windows from the first to the last offset of ``low``..``high``
consecutive words are the features, hashed by crc32 into ``buckets``. With s of the S
features of all documents and t of the T target features in a bucket, its gain is
floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))). A document's weight is the floored mean gain of
its features; its score adds Gumbel noise fixed by its id and the seed; the ``percent``
highest scores of the documents with enough words are drawn.

Texts are pre-tokenised once: each document's buckets are stored (two bytes a feature),
from which the histogram is summed (one partial histogram a task) and, with the gains
broadcast (``buckets`` numbers), the weights. Ranks come from a range partitioning on the
score and one offset a partition; no window holds all rows, and ties are cut as well.

Defined results: a null or empty text has no features, weight 0; a null id has the noise of
the empty text and ranks behind other ids of its score; repeated rows are drawn one by one,
in their stored order; an empty target gives gains of T = 0; an empty table gives an empty
result. ``draw`` returns the documents with their own columns, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm import textkit as K
from starmart.llm.components import stored

#: What stands between words: ASCII but for digits and letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOW, HIGH, BUCKETS = 1, 1, 10_000
PERCENT, SEED, LEAST_WORDS = 10, 2024, 20
CACHED = 500_000               # features whose bucket a task remembers


class Buckets(dict):
    """Feature -> bucket, forgotten when too many are held."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, feature: str) -> int:
        if len(self) > CACHED:
            self.clear()
        self[feature] = b = zlib.crc32(feature.encode()) % self.n
        return b


def pretokenizer():
    from tokenizers import Regex, pre_tokenizers
    return pre_tokenizers.Split(Regex(GAP), behavior="removed")


def windows(tokens: list, low: int, high: int):
    """Features of pre-tokenised words: the text from the first to the last offset of each
    window, with one space between words."""
    if low <= 1:
        yield from (w for w, _ in tokens)
    if high > 1:
        line = " ".join(w for w, _ in tokens)
        size = np.array([b - a for _, (a, b) in tokens], np.int64)
        starts = np.cumsum(size + 1) - size - 1
        for n in range(max(2, low), high + 1):
            yield from (line[a:b] for a, b in zip(starts.tolist(), (starts + size)[n - 1:].tolist()))


def text_buckets(text: str, split, low: int, high: int, buckets: Buckets, gap=re.compile(GAP)) -> tuple[int, np.ndarray]:
    """(words, bucket of every feature) of a whole text."""
    n, out, before = 0, [], []
    for part in K.pieces(K.ascii_lower(text), gap):
        tokens = split.pre_tokenize_str(part)
        n += len(tokens)
        if high == 1:
            out.append(np.array([buckets[w] for w, _ in tokens], np.uint32))
            continue
        # windows over the cut: the last words of the part before stand in front, and the
        # windows inside them alone are not taken again
        size = len(before)
        for k in range(low, high + 1):
            old = before[size - min(k - 1, size):]
            out.append(np.array([buckets[f] for f in windows(old + tokens, k, k)], np.uint32))
        before = (before + tokens)[-(high - 1):]
    return n, np.concatenate(out) if out else np.zeros(0, np.uint32)


def bucket_batches(batches, low: int, high: int, n: int):
    """Worker: the columns of a row, its number of words and the buckets of its features."""
    split, buckets = pretokenizer(), Buckets(n)
    width = "<u2" if n <= 1 << 16 else "<u4"
    for b in batches:
        texts = b.column("text")
        rest = [b.column(i) for i in range(b.num_columns - 1)]
        for lo, hi in K.slices(texts):
            got = [text_buckets(t or "", split, low, high, buckets) for t in texts.slice(lo, hi - lo).to_pylist()]
            yield pa.record_batch([c.slice(lo, hi - lo) for c in rest] + [pa.array([w for w, _ in got], pa.int64()),
                                  pa.array([x.astype(width).tobytes() for _, x in got], pa.binary())],
                                  names=[*b.schema.names[:-1], "n_words", "buckets"])


def histogram_batches(batches, n: int):
    """Worker: the counts of the task's buckets."""
    width = "<u2" if n <= 1 << 16 else "<u4"
    total = np.zeros(n, np.int64)
    for b in batches:
        for x in b.column("buckets"):
            total += np.bincount(np.frombuffer(x.as_buffer(), width), minlength=n)
    at = np.flatnonzero(total)
    yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["bucket", "c"])


def weigh_batches(batches, shared):
    """Worker: the number of features and the floored mean gain of every row."""
    gains = shared.value
    width = "<u2" if len(gains) <= 1 << 16 else "<u4"
    for b in batches:
        n, weight = [], []
        for x in b.column("buckets"):
            k = np.frombuffer(x.as_buffer(), width)
            n.append(len(k))
            weight.append(int(gains[k].sum()) // len(k) if len(k) else 0)
        at = b.schema.names.index("buckets")
        keep = [i for i in range(b.num_columns) if i != at]
        yield pa.record_batch([b.column(i) for i in keep] + [pa.array(n, pa.int64()), pa.array(weight, pa.int64())],
                              names=[*(b.schema.names[i] for i in keep), "n_features", "weight"])


def bucketed(rows: DataFrame, low: int, high: int, buckets: int) -> DataFrame:
    """``rows``, whose last column is text, with that column replaced by n_words and buckets."""
    fields = [f for f in rows.schema.fields if f.name != "text"]
    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("buckets", T.BinaryType())])
    return K.arrow_map(rows, "starmart.llm.resample:bucket_batches", schema, low, high, buckets)


def histogram(rows: DataFrame, buckets: int) -> list[int]:
    """Features in each bucket, summed over all rows; at most ``buckets`` rows reach the driver."""
    h = (K.arrow_map(rows.select("buckets"), "starmart.llm.resample:histogram_batches", "bucket long, c long", buckets)
         .groupBy("bucket").agg(F.sum("c").alias("c")).collect())
    out = [0] * buckets
    for r in h:
        out[r.bucket] = r.c
    return out


def gains_of(s: list[int], t: list[int]) -> np.ndarray:
    """The gain of every bucket."""
    b, ss, tt = len(s), sum(s), sum(t)
    return np.array([math.floor(1000 * math.log((x + 1.0) * (ss + b) / ((y + 1.0) * (tt + b)))) for x, y in zip(t, s)], np.int64)


def noise(seed: int):
    """Gumbel noise in thousandths from the first 32 bits of sha256(``seed:doc_id``)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """The rows with their rank, null where not drawn. Rows are range partitioned and sorted
    by score; a row's rank is its place in its partition and the rows of those before."""
    n = scored.where(F.col("n_words") >= least_words).count()
    taken = n * percent // 100
    short = (F.col("n_words") < least_words).cast("int")
    order = [short.asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("rid").asc()]
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(scored.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                  .withColumn("at", F.monotonically_increasing_id()), "resample-ranks")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()   # one row a partition
    before, offsets = 0, []
    for r in sizes:
        offsets.append((r.part, before))
        before += r.n
    table = F.broadcast(scored.sparkSession.createDataFrame(offsets, "part long, before long"))
    rank = F.col("before") + place + 1
    return (rows.withColumn("part", part).join(table, "part")
            .withColumn("rank", F.when(rank <= taken, rank)).drop("part", "before", "at", "rid"))


def resample(docs: DataFrame, target: DataFrame, low: int = LOW, high: int = HIGH, buckets: int = BUCKETS, percent: int = PERCENT,
             seed: int = SEED, least_words: int = LEAST_WORDS, carry: bool = False) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document; ``carry`` adds
    the whole document as the struct ``row``. Both frames have a column text."""
    own = [F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []
    src = docs.select(*own, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(bucketed(src, low, high, buckets), "resample-buckets")
    goal = bucketed(target.select(F.col("text").cast("string").alias("text")), low, high, buckets)
    gains = gains_of(histogram(rows, buckets), histogram(goal, buckets))
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    keyed = rows.withColumn("rid", F.monotonically_increasing_id())
    fields = [f for f in keyed.schema.fields if f.name != "buckets"]
    schema = T.StructType([*fields, T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())])
    weighed = K.arrow_map(keyed, "starmart.llm.resample:weigh_batches", schema, shared)
    scored = stored(weighed.withColumn("score", F.col("weight") + noise(seed)), "resample-scores")
    return ranked(scored, percent, least_words)


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents, with their own columns."""
    return resample(docs, target, carry=True, **options).where("rank is not null").select("row.*")
