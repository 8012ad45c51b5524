"""Shared helpers: Arrow text buffers, word spans, 64-bit hashes and counting passes.

Words follow one rule everywhere: ASCII A-Z is lower-cased and the text is cut at the
bytes 0x20 and 0x09-0x0D. All of it is vectorised over a slice of documents; only the
documents, never their characters, are looped over in Python.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SLICE_BYTES = 1 << 20          # documents handled by one round of NumPy calls
BATCH_BYTES = 8 << 20          # of an Arrow batch handed to a worker
MERGE_ROWS = 1_000_000         # distinct keys a counting task holds before it emits them

_U = np.uint64
_rng = np.random.default_rng(20240229)
BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
BASE = 0x9E3779B97F4A7C15 | 1
MULT = _rng.integers(1, 2**63, 64, dtype=np.uint64) | _U(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
END = np.array([0x5E7D0C0FFEE12345], dtype=np.uint64)   # the end-of-text token

_powers: list = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


# --- running a worker function over the partitions of a frame ---------------------------

def arrow_map(df: DataFrame, target: str, schema: str, *args) -> DataFrame:
    """``df.mapInArrow`` with the function ``"module:name"`` called as ``f(batches, *args)``.

    The worker imports the function by name, so nothing of the module is pickled; the
    library root is put on the worker's path first.
    """
    root = ROOT
    module, name = target.split(":")
    # texts are long: batches of the default 64 MB, twice over in the JVM and in Python,
    # would be most of a worker's memory
    conf = df.sparkSession.conf
    now = re.fullmatch(r"(\d+)b", str(conf.get("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b")))
    if now and int(now[1]) > BATCH_BYTES:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")

    def run(batches):
        import importlib
        import sys
        if root not in sys.path:
            sys.path.insert(0, root)
        return getattr(importlib.import_module(module), name)(batches, *args)

    return df.mapInArrow(run, schema)


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as remainder 0 of its empty text."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(n))


# --- Arrow buffers ----------------------------------------------------------------------

def text_buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is an empty one."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    large = pa.types.is_large_string(col.type)
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], dtype=np.int64 if large else np.int32)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    offs = offs.astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None and len(col) else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def slices(col, limit: int = SLICE_BYTES):
    """Row ranges (lo, hi) of about ``limit`` bytes of text; one longer text is a range."""
    _, offs = text_buffers(col)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def pieces(text: str, cut: re.Pattern, limit: int = SLICE_BYTES):
    """A text in parts of about ``limit`` characters, each ending behind a match of ``cut``
    (what stands between words), so that no word is split; together they are the text."""
    lo = 0
    while len(text) - lo > limit:
        m = cut.search(text, lo + limit)
        if m is None:
            break
        yield text[lo:m.end()]
        lo = m.end()
    yield text[lo:]


def ascii_lower(text: str) -> str:
    """A-Z in lower case, everything else as it is."""
    return text.encode().lower().decode()


# --- words and hashes -------------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift rounds)."""
    x = x.copy()
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n, grown on demand."""
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, b in enumerate((BASE, pow(BASE, -1, 2**64))):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            np.cumprod(p, out=p)
            _powers[k] = p
    return _powers[0], _powers[1]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` reads the hash of any span."""
    out = np.zeros(len(buf) + 1, np.uint64)
    v = BYTE_VALUE[buf]
    v *= powers(len(buf) + 1)[0][:len(buf)]
    np.cumsum(v, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans; equal bytes give equal hashes wherever they stand."""
    inv = powers(len(prefix))[1]
    h = (prefix[ends] - prefix[starts]) * inv[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def word_spans(buf: np.ndarray, offs: np.ndarray):
    """(starts, ends, first): spans of all words; document i has words first[i]:first[i+1]."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    space = IS_SPACE[buf]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    edge[1:] |= space
    edge[0] = True
    after = np.zeros(n + 1, bool)
    after[offs] = True
    after[:-1] |= space
    starts = np.flatnonzero(~space & edge[:-1])
    ends = np.flatnonzero(~space & after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(col):
    """(hashes, first) of the lower-cased words of a string column."""
    buf, offs = text_buffers(col)
    buf = LOWER[buf]
    s, e, first = word_spans(buf, offs)
    return span_hash(prefix_hash(buf), s, e), first


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams starting at each of the first len(words)-n+1 words."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(m, n * int(MULT[63]) % 2**64, np.uint64)
    for k in range(n):
        h += words[k:k + m] * MULT[k]
    return mix(h)


def shingle_sets(col, n: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its n-word shingles; a text of fewer words
    has its whole word sequence as one, a text without words has none."""
    words, first = word_hashes(col)
    grams = gram_hashes(words, n)
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        if hi - lo >= n:
            out.append(np.unique(grams[lo:hi - n + 1]))
        elif hi > lo:
            out.append(gram_hashes(words[lo:hi], hi - lo))
        else:
            out.append(words[:0])
    return out


def in_sorted(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, found) of keys in a sorted table."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    i = np.searchsorted(table, keys)
    i[i == len(table)] = 0
    return i, table[i] == keys


class Counter64:
    """Counts of 64-bit keys in one task; holds at most a few million distinct keys."""

    def __init__(self, limit: int = MERGE_ROWS):
        self.parts, self.rows, self.limit = [], 0, limit

    def add(self, keys: np.ndarray):
        """Add keys; yields (keys, counts) when the held distinct keys pass the limit."""
        if len(keys):
            k, c = np.unique(keys, return_counts=True)
            self.parts.append((k, c))
            self.rows += len(k)
        if self.rows > 2 * self.limit:
            self.merge()
            if self.rows > self.limit:
                yield from self.flush()

    def merge(self):
        if len(self.parts) > 1:
            k = np.concatenate([p[0] for p in self.parts])
            c = np.concatenate([p[1] for p in self.parts])
            order = np.argsort(k, kind="stable")
            k, c = k[order], c[order]
            at = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            self.parts = [(k[at], np.add.reduceat(c, at))]
            self.rows = len(at)

    def flush(self):
        self.merge()
        for k, c in self.parts:
            for lo in range(0, len(k), 200_000):
                yield k[lo:lo + 200_000], c[lo:lo + 200_000]
        self.parts, self.rows = [], 0


def pairs_batch(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))],
                           names=["h", "c"])


def count_words(batches, distinct: bool, add_end: bool):
    """Worker: partial counts (h, c) of words; ``distinct`` counts a word once a text."""
    acc = Counter64()
    for b in batches:
        texts = b.column(0)
        for lo, hi in slices(texts):
            h, first = word_hashes(texts.slice(lo, hi - lo))
            if distinct:
                h = np.concatenate([np.unique(h[a:z]) for a, z in zip(first[:-1].tolist(), first[1:].tolist())] or [h])
            if add_end:
                h = np.concatenate([h, np.repeat(END, hi - lo)])
            for k, c in acc.add(h):
                yield pairs_batch(k, c)
    for k, c in acc.flush():
        yield pairs_batch(k, c)


def word_counts(texts: DataFrame, distinct: bool = False, add_end: bool = False) -> DataFrame:
    """(h, c): counts of word hashes over all rows of a one-column text frame. Each task
    counts first, so the exchange carries its distinct words only."""
    return (arrow_map(texts, "starmart.llm.textkit:count_words", "h long, c long", distinct, add_end)
            .groupBy("h").agg(F.sum("c").alias("c")))


def frequent(counts: DataFrame, total: int, bound: int, least: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
    """The keys with count >= total/bound, sorted, with their counts, and that threshold.

    Counts sum to ``total``, so at most ``bound`` keys qualify: 16*bound bytes on the
    driver and in each worker, whatever the corpus size.
    """
    threshold = max(least, -(-total // bound))
    t = counts.where(F.col("c") >= threshold).toArrow()
    k = t.column("h").to_numpy().view(np.uint64) if len(t) else np.zeros(0, np.uint64)
    c = t.column("c").to_numpy() if len(t) else np.zeros(0, np.int64)
    order = np.argsort(k)
    return k[order], c[order], threshold


def documents(spark, sf_dir: str, *columns: str) -> DataFrame:
    """The documents table, only the named columns."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)
