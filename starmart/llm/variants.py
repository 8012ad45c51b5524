"""Spelling variant grouping (operator 13): sorted-list dynamic programming.

Words of the documents are counted, and words that differ by exactly one inserted, deleted
or replaced code point are near. A word's form is its near word of largest count if that
count is at least ``RATIO`` times its own; following forms ends at the word's root.

* One edit leaves the first p code points of both words equal, or else the last p
  (p = half of the least length). So the vocabulary is sorted twice, as it is and with
  words reversed, and only words with the same first p code points in one of the lists are
  compared; a pair that both lists hold is taken from the first.
* A sorted list is cut into blocks of one prefix. The blocks' common prefixes form a sorted
  list of their own, and two blocks are only scanned together if their prefixes are within
  one edit.
* A scan compares the words of a block (queries) with a sorted block. The edit matrix is
  kept as a band of three cells a query. Neighbouring words share the matrix rows of their
  longest common prefix: rows are computed once for each distinct prefix, depth by depth,
  for all queries at once. A range of words is left as soon as its prefix is over one edit
  from a query.
* Counts and the best near word leave a scan, never pairs.

A block holds at most ``BLOCK`` words (more only where the vocabulary passes
``BLOCK * BLOCKS`` words) and about ``BLOCK_CHARS`` code points, so a hot prefix is many
blocks dealt to many tasks. The list of block prefixes has at most about 4 * ``BLOCKS`` rows.

Defined results: a null text has no words; a null id stands as the empty text before the
colon; a repeated row counts again; words of any length are compared; equal counts among
near words go to the first in code-point order; an empty table gives an empty result.
Further columns of the documents are not read, whatever their names.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm import textkit as K
from starmart.llm.components import stored

RUN = "[A-Za-z\u00C0-\u00FF]+"
NOT_RUN = re.compile("[^A-Za-z\u00C0-\u00FF]")
DROP_EVERY = 31                # one run in so many loses a code point
LEAST_CHARS, LEAST_COUNT, RATIO = 7, 2, 10
BLOCK, BLOCKS, BLOCK_CHARS = 4096, 1 << 16, 1 << 20
HELD = 200_000                 # distinct words a counting task holds before it emits them
QUERIES = 8192                 # queries scanned together
PREFIX = 16                    # code points of a block's common prefix that are compared


# --- words --------------------------------------------------------------------------------

def words_of(doc_id, text: str, every: int = DROP_EVERY) -> Counter:
    """Counts of a text's words: lower-cased runs, of which those with crc32 of
    ``<doc_id>:<run>`` divisible by ``every`` lose one code point."""
    seen: Counter = Counter()
    runs = re.compile(RUN)
    for part in K.pieces(K.ascii_lower(text), NOT_RUN):
        seen.update(runs.findall(part))
    head = f"{'' if doc_id is None else doc_id}:"
    out: Counter = Counter()
    for w, c in seen.items():
        h = zlib.crc32((head + w).encode())
        if h % every == 0:
            at = h % len(w)
            w = w[:at] + w[at + 1:]
        out[w] += c
    return out


def count_batches(batches, least_chars: int, every: int):
    """Worker: partial counts of words of at least ``least_chars`` code points."""
    held: Counter = Counter()

    def out():
        words = list(held)
        for lo in range(0, len(words), 50_000):
            part = words[lo:lo + 50_000]
            yield pa.record_batch([pa.array(part, pa.string()), pa.array([held[w] for w in part], pa.int64())], names=["word", "n"])
        held.clear()

    for b in batches:
        for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            for w, c in words_of(i, t or "", every).items():
                if len(w) >= least_chars:
                    held[w] += c
            if len(held) > HELD:
                yield from out()
    yield from out()


def vocabulary(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT,
               every: int = DROP_EVERY) -> DataFrame:
    """(word, n) of all words that are long and common enough."""
    src = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (K.arrow_map(src, "starmart.llm.variants:count_batches", "word string, n long", least_chars, every)
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


# --- sorted blocks --------------------------------------------------------------------------

BLOCK_SCHEMA = "bid long, side int, head string, prefix string, words array<string>, counts array<long>"


def cut_blocks(batches, size: int):
    """Worker: the sorted rows (side, word as listed, head, n) of a partition as blocks."""
    part, k = TaskContext.get().partitionId() << 32, 0
    key, words, counts, chars = None, [], [], 0

    def block():
        prefix = os.path.commonprefix([words[0], words[-1]])[:PREFIX]
        return pa.record_batch([pa.array([part + k]), pa.array([key[0]], pa.int32()), pa.array([key[1]]), pa.array([prefix]),
                                pa.array([words], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64()))],
                               names=["bid", "side", "head", "prefix", "words", "counts"])

    for b in batches:
        for side, w, head, n in zip(*(b.column(c).to_pylist() for c in ("side", "listed", "head", "n"))):
            if words and ((side, head) != key or len(words) >= size or chars >= BLOCK_CHARS):
                yield block()
                k, words, counts, chars = k + 1, [], [], 0
            key = side, head
            words.append(w)
            counts.append(n)
            chars += len(w)
    if words:
        yield block()


def sorted_blocks(vocab: DataFrame, p: int, size: int) -> DataFrame:
    """Both sorted lists in blocks, stored."""
    sides = F.explode(F.array(*[F.struct(F.lit(i).alias("side"), w.alias("listed")) for i, w in enumerate((F.col("word"), F.reverse("word")))]))
    rows = vocab.select("n", sides.alias("s")).select("s.side", "s.listed", F.substring("s.listed", 1, p).alias("head"), "n")
    parts = int(vocab.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, "side", "listed").sortWithinPartitions("side", "listed")
    return stored(K.arrow_map(rows, "starmart.llm.variants:cut_blocks", BLOCK_SCHEMA, size), "variant-blocks")


def within_one(prefix: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether words that start with ``prefix`` and with each of ``others`` (rows of code
    points, padded with 0) can be within one edit."""
    m = int((prefix > 0).sum())
    b0, b1, b2 = (np.full(len(others), x, np.int8) for x in (2, 0, 1))
    ended, ok = np.zeros(len(others), bool), np.zeros(len(others), bool)
    lens = (others > 0).sum(axis=1)
    at = lambda j: int(prefix[j]) if 0 <= j < m else 0
    for d in range(others.shape[1] + 1):
        # where one of the prefixes is used up, anything may follow it
        for delta, b in ((-1, b0), (0, b1), (1, b2)):
            if m == d + delta:
                ok |= ~ended & (b <= 1)
        done = ~ended & (lens == d)
        best = np.minimum(b0 if d > 0 else 2, b1)
        best = np.minimum(best, b2) if d + 1 <= m else best
        ok |= done & (best <= 1)
        ended |= done
        if d == others.shape[1] or (ended | ok).all():
            break
        c = others[:, d]
        n0 = np.minimum(b0 + (c != at(d - 1)), b1 + 1)
        n1 = np.minimum(np.minimum(b1 + (c != at(d)), b2 + 1), n0 + 1)
        n2 = np.minimum(b2 + (c != at(d + 1)), n1 + 1)
        b0, b1, b2 = n0.astype(np.int8), n1.astype(np.int8), n2.astype(np.int8)
        b0, b1, b2 = np.minimum(b0, 2), np.minimum(b1, 2), np.minimum(b2, 2)
    return ok


def codes(prefixes) -> np.ndarray:
    out = np.zeros((len(prefixes), PREFIX), np.uint32)
    for i, p in enumerate(prefixes):
        out[i, :len(p)] = np.frombuffer(p.encode("utf-32-le"), np.uint32)
    return out


def pair_blocks(batches, shared):
    """Worker: for each block the later blocks of its list and head that it is scanned with."""
    bids, prefixes, span = shared.value
    for b in batches:
        for bid, side, head in zip(*(b.column(c).to_pylist() for c in ("bid", "side", "head"))):
            lo, hi = span[side, head]
            i = lo + int(np.searchsorted(bids[lo:hi], bid))
            js = i + 1 + np.flatnonzero(within_one(prefixes[i], prefixes[i + 1:hi]))
            for at in range(0, len(js), 10_000):
                part = bids[js[at:at + 10_000]]
                yield pa.record_batch([pa.array(np.full(len(part), bid)), pa.array(part)], names=["i", "j"])


def block_pairs(blocks: DataFrame) -> DataFrame | None:
    """(i, j) of the block pairs to be scanned; None where every head is one block."""
    spark = blocks.sparkSession
    several = blocks.groupBy("side", "head").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    rows = blocks.select("bid", "side", "head", "prefix").join(several, ["side", "head"]).orderBy("side", "head", "bid").collect()
    if not rows:
        return None
    span: dict = {}
    for i, r in enumerate(rows):
        span[r.side, r.head] = span.get((r.side, r.head), (i, 0))[0], i + 1
    shared = spark.sparkContext.broadcast((np.array([r.bid for r in rows]), codes([r.prefix for r in rows]), span))
    own = blocks.select("bid", "side", "head").join(several, ["side", "head"]).select("bid", "side", "head")
    return stored(K.arrow_map(own, "starmart.llm.variants:pair_blocks", "i long, j long", shared), "variant-pairs")


# --- the scan ---------------------------------------------------------------------------------

class Words:
    """Words in one buffer of code points."""

    def __init__(self, words: list[str]):
        self.words = words
        self.len = np.array([len(w) for w in words], np.int64)
        self.off = np.r_[0, np.cumsum(self.len)]
        self.flat = np.append(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), 0)

    def at(self, i: np.ndarray, pos) -> np.ndarray:
        """Code point ``pos`` of each word, 0 outside of it."""
        inside = (pos >= 0) & (pos < self.len[i])
        return np.where(inside, self.flat[np.where(inside, self.off[i] + pos, 0)], 0)

    def lcp(self) -> np.ndarray:
        """Longest common prefix of each word with the one before it (0 for the first)."""
        out = np.zeros(len(self.words), np.int64)
        live, d = np.arange(1, len(self.words)), 0
        while len(live):
            same = (self.at(live - 1, d) == self.at(live, d)) & (d < self.len[live])
            live = live[same]
            d += 1
            out[live] = d
        return out


def scan(w: Words, tiles: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(query, listed): all pairs at exactly one edit. A tile (q0, q1, l0, l1) compares the
    words q0..q1 with the sorted words l0..l1."""
    lcp = w.lcp()
    lcp[[t[2] for t in tiles if t[2] < len(lcp)]] = -1
    q = np.concatenate([np.arange(q0, q1) for q0, q1, _, _ in tiles])
    s = np.concatenate([np.full(q1 - q0, l0) for q0, q1, l0, _ in tiles])
    e = np.concatenate([np.full(q1 - q0, l1) for q0, q1, _, l1 in tiles])
    b0, b1, b2 = (np.full(len(q), x, np.int8) for x in (2, 0, 1))
    found_q, found_l = [], []
    d = 0
    while len(q):
        # words that end here: the cell of the query's whole length
        end = np.flatnonzero(w.len[s] == d)
        delta = w.len[q[end]] - d
        cell = np.where(delta == 0, b1[end], np.where(delta == 1, b2[end], np.where(delta == -1, b0[end], 2)))
        hit = end[cell == 1]
        found_q.append(q[hit])
        found_l.append(s[hit])
        # the ranges of words that share one code point more; their rows are computed once
        edge = np.flatnonzero(lcp <= d)
        start = edge[w.len[edge] > d]
        a, z = np.searchsorted(start, s), np.searchsorted(start, e)
        n = z - a
        back = np.repeat(np.arange(len(q)), n)
        s = start[np.repeat(a, n) + np.arange(len(back)) - np.repeat(np.cumsum(n) - n, n)]
        after = np.searchsorted(edge, s, "right")
        e = np.minimum(np.where(after < len(edge), edge[np.minimum(after, len(edge) - 1)], len(lcp)), e[back])
        q, b0, b1, b2 = q[back], b0[back], b1[back], b2[back]
        c = w.at(s, d)
        n0 = np.minimum(b0 + (w.at(q, d - 1) != c), b1 + 1)
        n1 = np.minimum(np.minimum(b1 + (w.at(q, d) != c), b2 + 1), n0 + 1)
        n2 = np.minimum(b2 + (w.at(q, d + 1) != c), n1 + 1)
        live = np.flatnonzero(np.minimum(np.minimum(n0, n1), n2) <= 1)     # the others' ranges are over one edit
        q, s, e = q[live], s[live], e[live]
        b0, b1, b2 = (np.minimum(x[live], 2).astype(np.int8) for x in (n0, n1, n2))
        d += 1
    return np.concatenate(found_q), np.concatenate(found_l)


NEAR_SCHEMA = "word string, near long, best_n long, best string"


def near_batch(words: list[str], counts: list[int], tiles, sides: list[int], both: list[bool], p: int) -> pa.RecordBatch:
    """Per word of the tiles its near words counted, and the best of them. ``sides`` gives
    each word's list; tiles of two blocks count in both directions."""
    w = Words(words)
    side, n = np.array(sides), np.array(counts)
    a, b = scan(w, tiles)
    if len(a):                              # pairs of equal heads belong to the first list
        back = side[a] == 1
        same = np.ones(len(a), bool)
        for k in range(p):
            same &= w.at(a, w.len[a] - 1 - k) == w.at(b, w.len[b] - 1 - k)
        a, b = a[~(back & same)], b[~(back & same)]
        two = np.array(both)[a]
        a, b = np.r_[a, b[two]], np.r_[b, a[two]]
    plain = [x if s == 0 else x[::-1] for x, s in zip(words, sides)]
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=plain.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    at = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
    return pa.record_batch([pa.array([plain[i] for i in a[at]], pa.string()), pa.array(np.diff(np.r_[at, len(a)]).astype(np.int64)),
                            pa.array(n[b[at]].astype(np.int64)), pa.array([plain[i] for i in b[at]], pa.string())],
                           names=["word", "near", "best_n", "best"])


def scan_batches(batches, p: int, cross: bool):
    """Worker: near words inside each block, or between the two blocks of a row."""
    words, counts, sides, both, tiles, n_queries = [], [], [], [], [], 0

    def put(side, ws, ns, two):
        lo = len(words)
        words.extend(ws)
        counts.extend(ns)
        sides.extend([side] * len(ws))
        both.extend([two] * len(ws))
        return lo, len(words)

    for b in batches:
        for r in b.to_pylist():
            q = put(r["side"], r["words"], r["counts"], cross)
            tiles.append((*q, *put(r["side"], r["words2"], r["counts2"], cross)) if cross else (*q, *q))
            n_queries += q[1] - q[0]
            if n_queries >= QUERIES:
                yield near_batch(words, counts, tiles, sides, both, p)
                words, counts, sides, both, tiles, n_queries = [], [], [], [], [], 0
    if tiles:
        yield near_batch(words, counts, tiles, sides, both, p)


def near_words(vocab: DataFrame, least_chars: int = LEAST_CHARS, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best_n, best) of every word with a near word."""
    p = least_chars // 2
    size = max(block, -(-vocab.count() // BLOCKS))
    blocks = sorted_blocks(vocab, p, size)
    parts = K.arrow_map(blocks.select("side", "words", "counts"), "starmart.llm.variants:scan_batches", NEAR_SCHEMA, p, False)
    pairs = block_pairs(blocks)
    if pairs is not None:
        first = blocks.select(F.col("bid").alias("i"), "side", "words", "counts")
        second = blocks.select(F.col("bid").alias("j"), F.col("words").alias("words2"), F.col("counts").alias("counts2"))
        tiles = pairs.join(first, "i").join(second, "j").select("side", "words", "counts", "words2", "counts2")
        parts = parts.unionByName(K.arrow_map(tiles, "starmart.llm.variants:scan_batches", NEAR_SCHEMA, p, True))
    best = F.min(F.struct((-F.col("best_n")).alias("k"), F.col("best").alias("w")))
    return parts.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.k")).alias("best_n"), F.col("b.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the rows (word, form): every round doubles the steps followed. Counts
    grow by ``RATIO`` a step, so chains are short and have no circle."""
    now = stored(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        nxt = now.select(F.col("word").alias("root"), F.col("root").alias("far"))
        after = now.join(nxt, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved"))
        after = stored(after, "variant-roots")
        if not after.where("moved").limit(1).count():
            return after.select("word", "root")
        now = after.select("word", "root")


def group_variants(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, ratio: int = RATIO,
                   every: int = DROP_EVERY, block: int = BLOCK) -> DataFrame:
    """Every word with its form, root, counts and number of near words."""
    vocab = stored(vocabulary(docs, least_chars, least_count, every), "variant-words")
    form = F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best"))
    words = vocab.join(near_words(vocab, least_chars, block), "word", "left")
    words = stored(words.select("word", form.alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                F.when(form.isNotNull(), F.col("best_n")).alias("form_n")), "variant-forms")
    up = roots(words.where("form is not null"))
    return words.join(up, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.col("n_near").cast("long").alias("n_near"), "form_n")
