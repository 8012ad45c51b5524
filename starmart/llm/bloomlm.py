"""Language-model scoring with a log-frequency Bloom filter (operator 9).

Counts come from every training document (crc32(doc_id) mod 10 not 0): tokens are words
and one end token a text; a text's first word follows the end token of the text before.

Documents are taken in slices of about ``SLICE_BYTES`` of text. A slice asks for each of
its distinct words and bigrams once, and the answers come back in the same order:

1. Asking. A slice sends its sorted distinct words and bigrams, with their counts in its
   training texts, to the shards of the hash space they belong to: one packed row a shard.
2. Answering. A shard adds the counts up. Words get their exact counts. For bigrams it
   builds a log-frequency Bloom filter of all its training bigrams: a bigram of count c has
   level q = 1 + floor(log c / log ``STEP``) and is stored as the q keys (bigram, 1..q);
   every asked bigram is then looked up by probing level after level until one is absent.
   The answer is one byte, the level.
3. Scoring. Texts and answers of a slice meet; level q stands for the mean count of all
   bigrams stored at that level, so the counts of the model sum to those of the corpus.

The filter grows with the corpus, so it is not broadcast whole: each worker holds the
filter of a shard, and ``SHARD`` entries bound it. A word or bigram that stands in every
text is one entry a slice, so no shard is hot. The rule is one at every corpus size, and
nothing is left out.

* P(w|v) = L * c(v,w)/c(v) + (1-L) * P(w) after a context v seen in training, else
  P(w), with P(w) = (c+0.1)/(N+0.1(V+1)) and c(v,w) at most c(v) and c(w).
* Bigrams are told apart by 48 bits of a hash, words by 64.

The slices are made twice, from the same rows in the same order (a scan of files gives
that; store other frames first). Each answer carries a checksum of what was asked, and a
slice that does not match fails the job instead of giving a wrong score.

Defined results: a null or empty text is its end token alone; without training rows N and
V are 0 and every score is that of an empty model; a null id counts as held out (remainder
0); repeated rows are scored one by one; a text longer than a slice is a slice of its own
and must fit a worker's memory; an empty table gives an empty result. Further columns are
not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm import textkit as K
from starmart.llm.components import stored

SLICE_BYTES = 8 << 20
SHARD = 2_000_000              # entries a shard should get; it holds that many keys in memory
STEP = 1.5                     # ratio of neighbouring levels
HASHES = 8
BITS_PER_KEY = 12
MAX_LEVELS = 64
L = 0.4
_U = np.uint64


# --- the filter -----------------------------------------------------------------------------

def levels_of(counts: np.ndarray) -> np.ndarray:
    """The level of each count, 0 for a count of 0."""
    q = 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(STEP) + 1e-9).astype(np.int64)
    return np.where(counts > 0, np.minimum(q, MAX_LEVELS), 0)


class LogFrequencyBloom:
    """Bit array of (key, level) entries."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, bits_per_key: int = BITS_PER_KEY):
        q = levels_of(counts)
        size = 1 << max(10, int(np.ceil(np.log2(max(1, q.sum()) * bits_per_key))))
        self.mask = _U(size - 1)
        bits = np.zeros(size, bool)
        for level in range(1, int(q.max()) + 1 if len(q) else 1):
            some = keys[q >= level]
            for k in range(HASHES):
                bits[self.place(some, level, k)] = True
        self.bits = np.packbits(bits, bitorder="little")

    def place(self, keys, level, k):
        """Bit of the k-th hash of (key, level): double hashing on two halves."""
        h = K.mix(keys + _U(level * int(K.MULT[50]) % 2**64))
        return (h + _U(k) * ((h >> _U(32)) | _U(1))) & self.mask

    def has(self, keys: np.ndarray, level: int) -> np.ndarray:
        """Membership of (key, level); a key is dropped at its first unset bit."""
        left = np.arange(len(keys))
        for k in range(HASHES):
            at = self.place(keys[left], level, k)
            left = left[(self.bits[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1]
            if not len(left):
                break
        out = np.zeros(len(keys), bool)
        out[left] = True
        return out

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The stored levels, 0 for absent keys, by repeated probes."""
        out, left = np.zeros(len(keys), np.uint8), np.arange(len(keys))
        for level in range(1, MAX_LEVELS + 1):
            left = left[self.has(keys[left], level)]
            if not len(left):
                break
            out[left] = level
        return out


# --- tokens of a slice ------------------------------------------------------------------------

def token_stream(texts):
    """(tokens, first): words of each text followed by its end token."""
    h, first = K.word_hashes(texts)
    out = np.insert(h, first[1:], K.END[0])
    return out, first + np.arange(len(first))


def previous(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The token before each one; the end token stands before a text's first token."""
    prev = np.empty_like(tokens)
    prev[1:] = tokens[:-1]
    prev[first[:-1]] = K.END[0]
    return prev


def bigram_keys(prev: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """48-bit keys of bigrams."""
    return K.mix(prev * K.MULT[0] + tokens * K.MULT[1]) >> _U(16)


def slices_of(batches, slice_bytes: int = SLICE_BYTES):
    """Batches joined and cut into slices: (number, rows), each of whole documents and of
    about ``slice_bytes``. They depend on the rows and their order only, not on how these
    are batched."""
    held, size, k = [], 0, 0
    for b in batches:
        _, offs = K.text_buffers(b.column("text"))
        lo = 0
        for i, n in enumerate(np.diff(offs).tolist()):
            size += n + 1
            if size >= slice_bytes:
                held.append(b.slice(lo, i + 1 - lo))
                yield k, pa.Table.from_batches(held)
                held, size, k, lo = [], 0, k + 1, i + 1
        if lo < b.num_rows:
            held.append(b.slice(lo))
    if held:
        yield k, pa.Table.from_batches(held)


def slice_tokens(texts: pa.ChunkedArray):
    """(tokens, first, bigram keys) of a slice, worked through a megabyte at a time."""
    parts = []
    for chunk in texts.chunks:
        for lo, hi in K.slices(chunk):
            tokens, first = token_stream(chunk.slice(lo, hi - lo))
            parts.append((tokens, np.diff(first), bigram_keys(previous(tokens, first), tokens)))
    tokens, sizes, keys = (np.concatenate(x) for x in zip(*parts))
    return tokens, np.r_[0, np.cumsum(sizes)], keys


def shard_of(keys: np.ndarray, bits: int, shards: int) -> np.ndarray:
    """Shards are ranges of the hash space: sorted keys have ascending shards."""
    return ((keys >> _U(bits - 32)) * _U(shards)) >> _U(32)


def checksum(keys: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(K.mix(keys)).view(np.int64)) if len(keys) else 0


# --- asking ------------------------------------------------------------------------------------

ASK_SCHEMA = "shard long, slice long, keys binary, counts binary, large binary"


def packed(counts: np.ndarray) -> tuple[bytes, bytes]:
    """Counts in a byte each; those of 255 and more follow in full."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[counts >= 255].astype("<i8").tobytes()


def unpacked(small: bytes, large: bytes) -> np.ndarray:
    out = np.frombuffer(small, np.uint8).astype(np.int64)
    out[out == 255] = np.frombuffer(large, "<i8")
    return out


def ask_batches(batches, shards: int, slice_bytes: int):
    """Worker: what each slice asks of each shard; words of shard s ask ``shards + s``."""
    for k, rows in slices_of(batches, slice_bytes):
        number = TaskContext.get().partitionId() << 32 | k
        tokens, first, keys = slice_tokens(rows.column("text"))
        train = np.repeat(~rows.column("held_out").to_numpy(), np.diff(first))
        for x, bits, base in ((tokens, 64, shards), (keys, 48, 0)):
            distinct, back = np.unique(x, return_inverse=True)
            counts = np.bincount(back, weights=train, minlength=len(distinct)).astype(np.int64)
            shard = shard_of(distinct, bits, shards)
            at = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
            out = []
            for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(distinct)]):
                part = distinct[lo:hi]
                small = part.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :bits // 8].tobytes()
                out.append((base + int(shard[lo]), number, small, *packed(counts[lo:hi])))
            for lo in range(0, len(out), 64):
                yield pa.record_batch([pa.array(c) for c in zip(*out[lo:lo + 64])], names=["shard", "slice", "keys", "counts", "large"])


# --- answering ----------------------------------------------------------------------------------

ANSWER_SCHEMA = "slice long, shard long, answer binary, asked long, stats array<long>"


def keys_of(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def answer_shard(shard: int, rows: list, shards: int, bits_per_key: int):
    """Rows of answers, and one row of statistics: for words their number and that of all
    tokens, for bigrams the number and the counts' sum at each level."""
    words = shard >= shards
    asked = [keys_of(r[1], 8 if words else 6) for r in rows]
    every = np.concatenate(asked)
    keys, back = np.unique(every, return_inverse=True)
    counts = np.bincount(back, weights=np.concatenate([unpacked(r[2], r[3]) for r in rows]), minlength=len(keys)).astype(np.int64)
    seen = counts > 0
    if words:
        replies = counts.astype("<i8")[back]
        stats = [int(counts.sum()), int(seen.sum())]
    else:
        bloom = LogFrequencyBloom(keys[seen], counts[seen], bits_per_key)
        replies = bloom.levels(keys)[back]
        q = levels_of(counts[seen])
        stats = [*np.bincount(q, minlength=MAX_LEVELS + 1).tolist(), *np.bincount(q, weights=counts[seen], minlength=MAX_LEVELS + 1).astype(int).tolist()]
    out, lo = [], 0
    for r, a in zip(rows, asked):
        out.append((r[0], shard, replies[lo:lo + len(a)].tobytes(), checksum(a), None))
        lo += len(a)
    return out + [(-1, shard, b"", 0, stats)]


def answer_batches(batches, shards: int, bits_per_key: int):
    """Worker: the answers of its shards, whose rows follow one another."""
    def out(rows):
        for lo in range(0, len(rows), 64):
            cols = list(zip(*rows[lo:lo + 64]))
            types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=["slice", "shard", "answer", "asked", "stats"])

    shard, rows = None, []
    for b in batches:
        for s, *row in zip(*(b.column(c).to_pylist() for c in ("shard", "slice", "keys", "counts", "large"))):
            if s != shard and rows:
                yield from out(answer_shard(shard, rows, shards, bits_per_key))
                rows = []
            shard = s
            rows.append(row)
    if rows:
        yield from out(answer_shard(shard, rows, shards, bits_per_key))


# --- scoring -------------------------------------------------------------------------------------

class Model:
    """What scoring needs beside a slice's answers: N, V and the mean count of each level."""

    def __init__(self, n: int, v: int, means: np.ndarray):
        self.n, self.v, self.means = n, v, means

    def p(self, c):
        return (c + 0.1) / (self.n + 0.1 * (self.v + 1))

    def scores(self, c, before, level):
        """log10 P(w) and log10 P(w|v) of tokens of count c after contexts of count before."""
        p = self.p(c)
        both = np.minimum(np.minimum(self.means[level], c), before)
        after = np.where(before > 0, L * both / np.maximum(before, 1) + (1 - L) * p, p)
        return np.log10(p), np.log10(after)


SCORE_SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_slice(rows: pa.Table, answers: dict, shards: int, model: Model):
    tokens, first, keys = slice_tokens(rows.column("text"))

    def answered(x, base, bits, kind):
        distinct, back = np.unique(x, return_inverse=True)
        shard = shard_of(distinct, bits, shards)
        at = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
        got = []
        for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(distinct)]):
            reply, asked = answers.get(base + int(shard[lo]), (b"", None))
            if asked != checksum(distinct[lo:hi]):
                raise RuntimeError("a slice holds other rows than when it asked: store the documents before scoring them")
            got.append(np.frombuffer(reply, kind))
        return np.concatenate(got)[back]

    c, level = answered(tokens, shards, 64, "<i8"), answered(keys, 0, 48, np.uint8)
    ends = first[1:] - 1
    before = np.empty_like(c)
    before[1:] = c[:-1]
    before[first[:-1]] = c[ends[0]]                    # the end token's count
    base, score = model.scores(c, before, level)
    a = first[:-1]
    total = lambda x: np.add.reduceat(x, a)  # noqa: E731  every text has its end token
    n = rows.num_rows
    return pa.record_batch(
        [rows.column("doc_id").combine_chunks(), rows.column("held_out").combine_chunks(), pa.array(np.diff(first)),
         pa.array(total((c > 0).astype(np.int64))), pa.array(np.full(n, model.n, np.int64)), pa.array(total(base)), pa.array(total(score))],
        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def score_batches(batches, shards: int, shared):
    """Worker: slices one after another, each with its answers in front of its documents."""
    model, number, answers, held = shared.value, None, {}, []

    def done():
        return score_slice(pa.Table.from_batches(held).select(["doc_id", "held_out", "text"]), answers, shards, model)

    for b in batches:
        slices = b.column("slice").to_numpy()
        cuts = np.flatnonzero(np.r_[True, slices[1:] != slices[:-1]]).tolist() if len(slices) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(slices)]):
            part = b.slice(lo, hi - lo)
            if slices[lo] != number and held:
                yield done()
            if slices[lo] != number:
                number, answers, held = slices[lo], {}, []
            for s, a, asked in zip(*(part.column(c).to_pylist() for c in ("shard", "answer", "asked"))):
                if s is not None:
                    answers[s] = (a, asked)
            docs = part.filter(pc.is_null(part.column("shard")))
            if docs.num_rows:
                held.append(docs)
    if held:
        yield done()


def number_batches(batches, slice_bytes: int):
    """Worker: the rows with the number of their slice."""
    for k, rows in slices_of(batches, slice_bytes):
        number = TaskContext.get().partitionId() << 32 | k
        for b in rows.to_batches():
            for lo, hi in K.slices(b.column("text")):
                yield pa.record_batch([pa.array(np.full(hi - lo, number)), *b.slice(lo, hi - lo).columns], names=["slice", *b.schema.names])


def shard_count(docs: DataFrame) -> int:
    """Shards for about ``SHARD`` entries each (a slice asks for about one in eight bytes)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-size // (8 * SHARD)))


def score(docs: DataFrame, held_out: Column | None = None, shards: int | None = None, slice_bytes: int = SLICE_BYTES,
          bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """Per document the base score, the model's score and token numbers. The model is
    learned from the documents that are not ``held_out`` (default: by the id's remainder);
    to score other texts than those learned from, hold them out."""
    spark = docs.sparkSession
    held = held_out if held_out is not None else K.crc_mod(F.col("doc_id"), 10) == 0
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = shards or shard_count(src)
    asked = K.arrow_map(src, "starmart.llm.bloomlm:ask_batches", ASK_SCHEMA, n, slice_bytes)
    asked = asked.repartition(2 * n, "shard").sortWithinPartitions("shard")
    answers = stored(K.arrow_map(asked, "starmart.llm.bloomlm:answer_batches", ANSWER_SCHEMA, n, bits_per_key), "lm-answers")
    stats = answers.where("slice = -1").select((F.col("shard") >= n).alias("words"), F.posexplode("stats"))
    got = {(r.words, r.pos): r["sum(col)"] for r in stats.groupBy("words", "pos").agg(F.sum("col")).collect()}     # 2 + 130 numbers
    of = np.array([got.get((False, i), 0) for i in range(2 * MAX_LEVELS + 2)], float)
    means = of[MAX_LEVELS + 1:] / np.maximum(of[:MAX_LEVELS + 1], 1)
    shared = spark.sparkContext.broadcast(Model(got.get((True, 0), 0), got.get((True, 1), 0), means))
    none = lambda t: F.lit(None).cast(t)
    texts = (K.arrow_map(src, "starmart.llm.bloomlm:number_batches", "slice long, doc_id long, held_out boolean, text string", slice_bytes)
             .select("slice", none("long").alias("shard"), "doc_id", "held_out", "text", none("binary").alias("answer"), none("long").alias("asked")))
    replies = answers.where("slice >= 0").select("slice", "shard", none("long").alias("doc_id"), none("boolean").alias("held_out"),
                                                 none("string").alias("text"), "answer", "asked")
    rows = texts.unionByName(replies).repartition("slice").sortWithinPartitions("slice", F.col("shard").asc_nulls_last())
    return K.arrow_map(rows, "starmart.llm.bloomlm:score_batches", SCORE_SCHEMA, n, shared)
