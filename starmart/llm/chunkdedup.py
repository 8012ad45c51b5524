"""Substring dedup by content-defined chunks (operator 6).

A 16-bit gear rolling hash (h = 2h + G[byte], so a byte is forgotten after 16 steps) runs
over each text's UTF-8 bytes; a chunk ends where the hash's top bits are zero, at least
``LEAST`` and at most ``MOST`` bytes after its start and never inside a character. Cuts
depend on nearby bytes only, so they fall in step again soon after an insertion. Chunks
are compared by a 128-bit digest over the whole corpus.

A chunk seen more than once is *shared*; a run of neighbouring shared chunks is a *repeat*
if ``RUN_WORDS`` words begin in it (or, in text with hardly any blanks, it has ``RUN``
characters). The chunks at both ends of a repeated passage are mostly not shared, so the
rule is well under the 50 words a passage should have. Of each shared chunk the first place (smallest doc_id,
then position) is kept; repeats elsewhere are *removable*. Shorter shared runs, as common
phrases make them, are left alone.

Chunks are written once; one exchange with a partial aggregate counts the digests, and
only rows that pass a bounded Bloom filter of shared digests meet them in a join.

Defined results: a null or empty text has no chunk; rows of one doc_id are one document,
each row keeping what the document keeps; a null id comes last; a repeat inside one text
is found like any other. A text of one byte run (``aaaa``) is cut by ``MOST``. An empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm import textkit as K
from starmart.llm.components import stored

LEAST, MOST = 16, 256
CUT_BITS = 4                   # a cut every 2**4 bytes on average, after LEAST: chunks of 32
RUN_WORDS, RUN = 20, 240       # words, characters
BLOOM_BITS = 1 << 28           # bound of the filter of shared digests (32 MB)
GEAR = np.random.default_rng(77).integers(0, 2**16, 256, dtype=np.uint16)
_LAST_ID = 2**63 - 1


def gear_cuts(buf: np.ndarray) -> np.ndarray:
    """Positions where a chunk may end: the rolling hash of the 16 bytes before is a cut
    and the byte after starts a character. The hash is built by doubling its window."""
    h = GEAR[buf]
    for step in (1, 2, 4, 8):
        older = h[:-step] << np.uint16(step)
        h[step:] += older
    cut = np.flatnonzero(h < (1 << (16 - CUT_BITS))) + 1
    cut = cut[cut < len(buf)]
    return cut[(buf[cut] & 0xC0) != 0x80]


def chunk_ends(buf: np.ndarray, lo: int, hi: int, cuts: list[int]) -> list[int]:
    """Ends of the chunks of buf[lo:hi]; ``cuts`` are its candidate positions in order."""
    out, pos = [], lo
    for c in [*cuts, hi]:
        if c - pos < LEAST and c < hi:
            continue
        while c - pos > MOST:
            end = pos + MOST
            while buf[end] & 0xC0 == 0x80:
                end -= 1
            out.append(end)
            pos = end
        if c > pos and (c - pos >= LEAST or c == hi):
            out.append(c)
            pos = c
    return out


def chunk_batches(batches):
    """Worker: per text its chunks' code-point ends and 128-bit digests."""
    for b in batches:
        texts = b.column("text")
        for lo, hi in K.slices(texts):
            part = texts.slice(lo, hi - lo)
            buf, offs = K.text_buffers(part)
            data = buf.tobytes()
            cuts = gear_cuts(buf) if len(buf) else np.zeros(0, np.int64)
            at = np.searchsorted(cuts, offs, "right")
            cuts = cuts.tolist()
            chars = np.r_[0, np.cumsum((buf & 0xC0) != 0x80)]       # code points before a byte
            begun = np.searchsorted(K.word_spans(buf, offs)[0], np.arange(len(buf) + 1))     # words begun before a byte
            ends, sizes, lens = [], [], []
            for i, (a, z) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
                e = chunk_ends(buf, a, z, cuts[at[i]:at[i + 1]]) if z > a else []
                ends += e
                sizes.append(len(e))
                lens.append(int(chars[z] - chars[a]))
            digest = b"".join([xxhash.xxh3_128_digest(data[a:z]) for a, z in zip([0, *ends[:-1]], ends)])
            d = np.frombuffer(digest, np.int64).reshape(-1, 2)
            listed = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            ends = np.array(ends, np.int64)
            own = chars[ends] - np.repeat(chars[offs[:-1]], sizes)
            words = begun[ends] - begun[np.r_[0, ends[:-1]]]         # of the chunk; a text starts where one ends
            lists = [pa.ListArray.from_arrays(listed, pa.array(v))
                     for v in (own.astype(np.int32), np.minimum(words, 255).astype(np.int16), d[:, 0].copy(), d[:, 1].copy())]
            yield pa.record_batch([b.column("rid").slice(lo, hi - lo), b.column("doc_id").slice(lo, hi - lo), pa.array(lens, pa.int64()), *lists],
                                  names=["rid", "doc_id", "n_chars", "ends", "words", "d1", "d2"])


def digest_bits(batches, bits: int):
    """Worker: words of the shared digests' filter this task sets."""
    words = np.zeros(bits // 64, np.uint64)
    for b in batches:
        for at in _places(b.column(0).to_numpy().view(np.uint64), bits):
            np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    some = np.flatnonzero(words)
    for lo in range(0, len(some), 100_000):
        yield pa.record_batch([pa.array(some[lo:lo + 100_000]), pa.array(words[some[lo:lo + 100_000]].view(np.int64))], names=["i", "w"])


def _places(h: np.ndarray, bits: int):
    for k in range(3):
        yield K.mix(h ^ K.MULT[k]) & np.uint64(bits - 1)


def shared_batches(batches, filter_):
    """Worker: one row per chunk that the filter takes for shared."""
    words = filter_.value
    bits = len(words) * 64
    for b in batches:
        d1 = b.column("d1")
        size = np.diff(d1.offsets.to_numpy())
        lo, hi = d1.offsets[0].as_py(), d1.offsets[-1].as_py()
        v1, v2, ends, words_in = (b.column(n).values.to_numpy()[lo:hi] for n in ("d1", "d2", "ends", "words"))
        ok = np.ones(len(v1), bool)
        for at in _places(v1.view(np.uint64), bits):
            ok &= (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        row = np.repeat(np.arange(len(size)), size)
        idx = np.arange(len(v1)) - np.repeat(np.cumsum(size) - size, size)
        start = np.where(idx == 0, 0, np.r_[0, ends[:-1]]) if len(ends) else ends
        k = np.flatnonzero(ok)
        rows = pa.array(row[k])
        yield pa.record_batch([b.column("rid").take(rows), b.column("ord").take(rows), pa.array(idx[k].astype(np.int32)),
                               pa.array(start[k].astype(np.int32)), pa.array(ends[k].astype(np.int32)), pa.array(words_in[k]), pa.array(v1[k]), pa.array(v2[k])],
                              names=["rid", "ord", "idx", "start", "end", "words", "d1", "d2"])


def run_batches(batches):
    """Worker: (rid, shared chunks in any order) to the document's repeats."""
    for b in batches:
        out = []
        for chunks in b.column("chunks").to_pylist():
            runs, cut, firsts, seen = [], [], set(), set()
            for c in sorted(chunks, key=lambda c: c["idx"]):
                key = (c["d1"], c["d2"])
                again = not c["own"] or key in seen
                seen.add(key)
                if runs and runs[-1][0] == c["idx"] - 1:
                    runs[-1][0], runs[-1][2] = c["idx"], c["end"]
                    runs[-1][4] += c["words"]
                    runs[-1][3].append((c["start"], c["end"], again, c["first"], c["own"]))
                else:
                    runs.append([c["idx"], c["start"], c["end"], [(c["start"], c["end"], again, c["first"], c["own"])], c["words"]])
            runs = [r for r in runs if r[4] >= RUN_WORDS or r[2] - r[1] >= RUN]
            for r in runs:
                for a, z, again, first, own in r[3]:
                    if again:
                        if cut and cut[-1][1] == a:
                            cut[-1][1] = z
                        else:
                            cut.append([a, z])
                        if not own and first != _LAST_ID:
                            firsts.add(first)
            text = lambda spans: ",".join(f"{a}:{z}" for a, z in spans)
            out.append((len(chunks), len(runs), sum(r[2] - r[1] for r in runs), sum(z - a for a, z in cut),
                        text((r[1], r[2]) for r in runs), text(cut), sorted(firsts)))
        cols = list(zip(*out)) or [()] * 7
        yield pa.record_batch([b.column("rid"), *(pa.array(c, pa.int64()) for c in cols[:4]), *(pa.array(c, pa.string()) for c in cols[4:6]),
                               pa.array(cols[6], pa.list_(pa.int64()))],
                              names=["rid", "n_shared", "n_repeats", "repeat_chars", "removable_chars", "repeats", "removable", "first_docs"])


def repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, n_chunks, n_shared, n_repeats, repeat_chars,
    removable_chars, the spans ``start:end`` (code points) of repeats and of what may be
    removed, and the documents that keep what it repeats."""
    spark = docs.sparkSession
    src = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = stored(K.arrow_map(src, "starmart.llm.chunkdedup:chunk_batches",
                               "rid long, doc_id long, n_chars long, ends array<int>, words array<short>, d1 array<long>, d2 array<long>"), "chunks")
    order = F.coalesce("doc_id", F.lit(_LAST_ID))
    pair = F.explode(F.arrays_zip("d1", "d2")).alias("d")
    shared = stored(table.select(order.alias("ord"), pair).select("ord", "d.d1", "d.d2")
                    .groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first")).where("n > 1").drop("n"), "chunks-shared")
    n = shared.count()
    bits = min(BLOOM_BITS, 1 << max(12, (12 * max(1, n) - 1).bit_length()))
    t = (K.arrow_map(shared.select("d1"), "starmart.llm.chunkdedup:digest_bits", "i long, w long", bits)
         .groupBy("i").agg(F.bit_or("w").alias("w")).toArrow())
    words = np.zeros(bits // 64, np.uint64)
    if len(t):
        words[t.column("i").to_numpy()] = t.column("w").to_numpy().view(np.uint64)
    asked = K.arrow_map(table.select("rid", order.alias("ord"), "ends", "words", "d1", "d2"), "starmart.llm.chunkdedup:shared_batches",
                        "rid long, ord long, idx int, start int, end int, words short, d1 long, d2 long", spark.sparkContext.broadcast(words))
    met = (asked.join(shared, ["d1", "d2"])
           .groupBy("rid").agg(F.collect_list(F.struct("idx", "start", "end", "words", "d1", "d2", "first", (F.col("ord") == F.col("first")).alias("own"))).alias("chunks")))
    found = K.arrow_map(met, "starmart.llm.chunkdedup:run_batches",
                        "rid long, n_shared long, n_repeats long, repeat_chars long, removable_chars long, repeats string, removable string, first_docs array<long>")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return (table.select("rid", "doc_id", "n_chars", F.size("ends").cast("long").alias("n_chunks")).join(found, "rid", "left")
            .select("doc_id", "n_chars", "n_chunks", zero("n_shared"), zero("n_repeats"), zero("repeat_chars"), zero("removable_chars"),
                    F.coalesce("repeats", F.lit("")).alias("repeats"), F.coalesce("removable", F.lit("")).alias("removable"),
                    F.coalesce("first_docs", F.array().cast("array<long>")).alias("first_docs")))


def cut_batches(batches):
    """Worker: rows with their removable spans cut out of ``text``."""
    for b in batches:
        texts = []
        for t, spans in zip(b.column("text").to_pylist(), b.column("removable").to_pylist()):
            if t and spans:
                at, out = 0, []
                for a, z in (map(int, s.split(":")) for s in spans.split(",")):
                    out.append(t[at:a])
                    at = z
                t = "".join(out) + t[at:]
            texts.append(t)
        names = [n for n in b.schema.names if n != "removable"]
        yield pa.record_batch([pa.array(texts, pa.string()) if n == "text" else b.column(n) for n in names], names=names)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with removable repeats cut out of ``text``. Ids must be
    unique here, as texts meet their spans by id."""
    spans = repeats(docs).select("doc_id", "removable")
    src = docs.drop("removable").join(spans, "doc_id", "left")
    return K.arrow_map(src, "starmart.llm.chunkdedup:cut_batches", docs.drop("removable").select("doc_id", *[c for c in docs.columns if c not in ("doc_id", "removable")]).schema)
