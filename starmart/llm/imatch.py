"""Document fingerprints (operator 3): I-Match over several randomised lexicons.

Terms are words. The lexicon holds the terms inside an inverse-document-frequency band:
document frequency at least ``MIN_SHARE`` of the documents (and 2) and at most
``MAX_SHARE``. From it ``LEXICONS`` randomised subsets are drawn by hashing, ``REPEATS``
at each of the rates 1/2, 1/4, ... ``2**-SCALES``. A document's distinct terms inside a
subset are sorted and hashed to 16 bits; the fingerprint is the list of these hashes,
``----`` where a subset has no term of the document.

The likeness of two fingerprints is taken at the rate where it is largest: equal hashes
over subsets that hold a term of either, at rates where at least ``LEAST`` such subsets
exist. Small rates see one or two terms of a document, so a lexicon still agrees after an
edit elsewhere; large rates serve short texts.

The lexicon is the only broadcast. A term in the band has a document frequency of at
least T/``MAX_LEXICON``, with T the sum of all document frequencies, so it holds at most
``MAX_LEXICON`` terms (8 bytes each) at every corpus size.

Defined results: a text with fewer than ``SHORT`` band terms uses all its distinct terms;
a null or empty text, or one of blanks, has the fingerprint of its whole text's hash in
every place. Equal texts have equal fingerprints and likeness 1. The next document is the
one after by doc_id; null ids come first, documents of one id are ordered by their first
``HEAD`` characters (then by the text's hash), and the last one's next is the first.
Repeated rows are kept; a single document is its own next one. A long text is worked on
whole, in a slice of its own; an empty table gives an empty result; further columns are
not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm import textkit as K
from starmart.llm.components import stored
from starmart.session import scratch_path

HEAD = 64
MIN_SHARE = 2e-4
MAX_SHARE = 0.2
MAX_LEXICON = 1 << 20
SHORT = 12
SCALES, REPEATS = 12, 8
LEXICONS = SCALES * REPEATS
LEAST = 4
_U = np.uint64
_EMPTY = 0x10000               # no term of the document in the subset


def band(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of the lexicon's terms."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    n = docs.count()
    df = K.word_counts(texts, distinct=True)
    where = scratch_path(docs.sparkSession, "imatch-df")
    df.write.parquet(where)
    df = docs.sparkSession.read.schema("h long, c long").parquet(where)
    total = df.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    terms, counts, _ = K.frequent(df, total, MAX_LEXICON, max(2, int(np.ceil(MIN_SHARE * n))))
    return terms[counts <= max(2, MAX_SHARE * n)]


def fingerprints(texts, lexicon: np.ndarray) -> np.ndarray:
    """[text, LEXICONS] of 16-bit hashes, 0x10000 for a subset without terms."""
    n = len(texts)
    words, first = K.word_hashes(texts)
    inside = K.in_sorted(lexicon, words)[1]
    terms, sizes = [], np.zeros(n, np.int64)
    for i, (a, z) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        t = np.unique(words[a:z][inside[a:z]])
        if len(t) < SHORT:
            t = np.unique(words[a:z])
        terms.append(t)
        sizes[i] = len(t)
    out = np.full((n, LEXICONS), _EMPTY, np.int32)
    flat = np.concatenate(terms) if terms else words[:0]
    some = np.flatnonzero(sizes)
    if len(some):
        at = (np.cumsum(sizes) - sizes)[some]
        # position of a term in its document's sorted list does not enter: the subset's
        # sorted terms are hashed as a sum of mixed values, the same for any order
        for r in range(REPEATS):
            draw = K.mix(flat ^ K.MULT[r])
            value = K.mix(flat + K.MULT[r + 20])
            for s in range(SCALES):
                member = (draw & _U((1 << (s + 1)) - 1)) == 0
                h = K.mix(np.add.reduceat(np.where(member, value, _U(0)), at))
                any_ = np.maximum.reduceat(member, at)
                out[some, s * REPEATS + r] = np.where(any_, (h >> _U(48)).astype(np.int32), _EMPTY)
    for i in np.flatnonzero(sizes == 0):
        digest = hashlib.sha256((texts[i].as_py() or "").encode()).digest()
        out[i] = int.from_bytes(digest[:2], "big")
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise likeness of fingerprint matrices, 0 to 1."""
    if not len(a):
        return np.zeros(0)
    held = (a != _EMPTY) | (b != _EMPTY)
    equal = (a == b) & (a != _EMPTY)
    held, equal = (x.reshape(len(a), SCALES, REPEATS).sum(2) for x in (held, equal))
    share = np.where(held >= LEAST, equal / np.maximum(held, 1), 0.0).max(1)
    return np.where((a == b).all(1), 1.0, share)


def as_text(f: np.ndarray) -> list[str]:
    return ["".join("----" if v == _EMPTY else f"{v:04x}" for v in row) for row in f.tolist()]


def edited(text: str, after: str) -> str:
    """The last quarter replaced by the first as many code points of the next text."""
    q = len(text) // 4
    return text[:len(text) - q] + after[:q] if q else text


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_NAMES = [c.split()[0] for c in RESULT.split(", ")]


def compared(rows: list, lexicon) -> pa.RecordBatch:
    """Results of (doc_id, text, next text) rows."""
    ids, texts, nexts = zip(*rows)
    new = pa.array([edited(t, x) for t, x in zip(texts, nexts)], pa.string())
    # the next text mostly is the next row: its fingerprint is taken once
    own, after = list(texts), np.arange(1, len(texts) + 1)
    for i, x in enumerate(nexts):
        if i + 1 == len(texts) or x is not texts[i + 1]:
            after[i] = len(own)
            own.append(x)
    f, g = fingerprints(pa.array(own, pa.string()), lexicon), fingerprints(new, lexicon)
    f, h = f[:len(texts)], f[after]
    return pa.record_batch(
        [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
         pa.array([hashlib.sha256(x.as_py().encode()).hexdigest() for x in new]), pa.array(as_text(f)), pa.array(as_text(g)),
         pa.array(likeness(f, g)), pa.array(likeness(f, h))], names=_NAMES)


EDGE = "part int, first_text string, last_id long, last_text string"


def edit_batches(batches, shared):
    """Worker over a sorted range: each document meets the one after it. The last one meets
    the first of the next range later: both texts are handed on."""
    lexicon, part = shared.value, TaskContext.get().partitionId()
    held, size, first, last = [], 0, None, None

    def done(out, edges=None):
        n = out.num_rows
        none = [pa.nulls(n, t) for t in (pa.int32(), pa.string(), pa.int64(), pa.string())]
        return pa.record_batch([*out.columns, *none], names=[*_NAMES, "part", "first_text", "last_id", "last_text"])

    for b in (b.slice(lo, 256) for b in batches for lo in range(0, b.num_rows, 256)):
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            text = text or ""
            if last is None:
                first = text
            else:
                held.append((*last, text))
                size += len(last[1])
            last = doc_id, text
            if size > K.SLICE_BYTES or len(held) >= 2000:
                yield done(compared(held, lexicon))
                held, size = [], 0
    if held:
        yield done(compared(held, lexicon))
    if last is not None:
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.record_batch([*(pa.nulls(1, t) for t in types), pa.array([part], pa.int32()), pa.array([first]), pa.array([last[0]], pa.int64()), pa.array([last[1]])],
                              names=[*_NAMES, "part", "first_text", "last_id", "last_text"])


def close_batches(batches, shared):
    """Worker: (doc_id, text, next text) rows where two ranges meet."""
    for b in batches:
        rows = list(zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "next"))))
        if rows:
            yield compared(rows, shared.value)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its edited text and both likenesses.

    One exchange of the texts, to ranges of (doc_id, head and hash of the text, row), so an
    id that many rows share is cut as well, even if their texts are alike."""
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lexicon = spark.sparkContext.broadcast(band(src))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce("text", F.lit(""))
    keyed = src.select("doc_id", "text", F.substring(text, 1, HEAD).alias("head"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("rid"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("head").asc(), F.col("h").asc(), F.col("rid").asc()]
    dealt = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    out = stored(K.arrow_map(dealt, "starmart.llm.imatch:edit_batches", f"{RESULT}, {EDGE}", lexicon), "imatch-parts")
    # one row a range: the last text of each meets the first of the next one, the last of all the first of all
    edges = out.where("part is not null").select("part", "first_text", "last_id", "last_text")
    n = edges.select("part").orderBy("part").collect()
    follows = spark.createDataFrame([(r.part, n[(i + 1) % len(n)].part) for i, r in enumerate(n)], "part int, then int")
    nexts = edges.select(F.col("part").alias("then"), F.col("first_text").alias("next"))
    ends = edges.join(F.broadcast(follows), "part").join(nexts, "then").select(F.col("last_id").alias("doc_id"), F.col("last_text").alias("text"), "next")
    closed = K.arrow_map(ends, "starmart.llm.imatch:close_batches", RESULT, lexicon)
    return out.where("part is null").select(*_NAMES).unionByName(closed)
