"""Language identification by cross-parsing entropy (operator 10).

For each language a suffix automaton is built over labelled text. A text is cut greedily
into phrases, each the longest match in a language's text; the automaton is walked from
its root and a phrase ends where no transition is left. The language needing the fewest
phrases wins. Phrase counts are normalised by what the language's training length makes
a phrase worth: a phrase costs log2(training length) bits, so counts of languages with
unequal training text compare.

Texts are parsed whole, in windows of ``WINDOW`` characters whose phrases are counted
apart (a window edge adds at most one phrase, to every language alike); all windows and
languages of a slice take their steps together as one NumPy gather.

Training uses a bounded sample of whole rows, the same for every language: its labelled
texts of at most ``LONGEST`` characters, in the order of a hash of id and text, until
``TRAIN_CHARS`` characters are reached (``SAMPLE_DOCS`` texts at most). Equal rows of one
id count once. A language that has only longer texts is not learned, and more than
``MOST_LANGS`` languages are an error.

Every letter of the training text has its own code. Transitions on the blank and the
letters seen most are a dense table of 64 classes, fewer where there are more than
``MANY`` languages, so that it stays under ``TABLE_MB`` MB; those on all other letters are
sorted keys of state and letter, at most three a character of training text, which are
searched only at such letters. How many classes are dense does not change a result. A letter that no training text
has is a class without transitions.

Defined results: ``und`` and score 0 for a null text or one without a letter, or when
nothing was learned; equal phrase costs are won by the language first in order of name;
repeated rows repeat their result; long texts are scored whole, in windows; an empty table
gives an empty result. Columns other than doc_id, lang and text are not read, whatever
their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm import textkit as K

WINDOW = 2048
SAMPLE_DOCS = 400
LONGEST = 8_000                # characters of a text that may be learned; all are scored, whole
TRAIN_CHARS = 40_000
MANY, MOST_LANGS = 8, 1_000
ALPHABET = 64                  # dense classes: blank, the letters seen most, letters never seen
TABLE_MB = MANY * (TRAIN_CHARS + LONGEST) * 2 * ALPHABET * 4 // 2**20 + 1


def normalise(text: str) -> str:
    """Lower-cased letters; every run of other characters becomes one blank."""
    t = text.lower()
    if t.isascii():
        return " ".join("".join(c if c.isalpha() else " " for c in t).split()) if not t.isalpha() else t
    return " ".join("".join(c if c.isalpha() else " " for c in t).split())


def transitions(codes: np.ndarray) -> list[dict]:
    """Transitions {code: state} of each state of the suffix automaton of a code sequence.
    State 0 is the root. At most two states a code."""
    trans: list[dict] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes.tolist():
        cur = len(trans)
        trans.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in trans[p]:
            trans[p][c] = cur
            p = link[p]
        if p >= 0:
            q = trans[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(trans)
                trans.append(dict(trans[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and trans[p].get(c) == q:
                    trans[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return trans


def suffix_automaton(codes: np.ndarray, sparse: list | None = None, dense: int = ALPHABET) -> np.ndarray:
    """The suffix automaton as [states, dense]; -1 marks no transition. Transitions on
    codes from ``dense`` on are added to ``sparse`` as (state, code, next state)."""
    trans = transitions(codes)
    table = np.full((len(trans), dense), -1, np.int32)
    for s, t in enumerate(trans):
        for c, to in t.items():
            if c < dense:
                table[s, c] = to
            else:
                sparse.append((s, c, to))
    return table


class Model:
    """Automata of all languages in one table, states shifted by each language's root."""

    def __init__(self, samples: dict[str, list[str]]):
        self.langs = sorted(samples)
        self.dense = dense = max(2, ALPHABET * MANY // max(MANY, len(self.langs) or 1))
        texts = {k: " ".join(filter(None, map(normalise, samples[k]))) for k in self.langs}
        seen = np.bincount(np.frombuffer("".join(texts.values()).encode("utf-32-le"), "<u4"), minlength=128) if self.langs else np.zeros(128, int)
        seen[32] = 0
        order = np.argsort(-seen, kind="stable")
        order = order[seen[order] > 0]
        self.code = np.full(0x110000, dense - 1, np.int32)       # never seen
        self.code[order[:dense - 2]] = np.arange(1, min(len(order), dense - 2) + 1)
        self.code[order[dense - 2:]] = np.arange(dense, dense + max(0, len(order) - dense + 2))
        self.code[32] = 0
        self.size = dense + len(order)                           # above every code
        tables, at, self.cost = [], 0, []
        self.roots, found = [], [np.zeros((0, 2), np.int64)]
        for k in self.langs:
            sparse: list = []
            t = suffix_automaton(self.encode(texts[k]), sparse, dense)
            x = np.array(sparse, np.int64).reshape(-1, 3)
            found.append(np.column_stack([(x[:, 0] + at) * self.size + x[:, 1], x[:, 2] + at]))
            t[t >= 0] += at
            self.roots.append(at)
            at += len(t)
            tables.append(t)
            self.cost.append(np.log2(max(2, len(texts[k]))))
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        rare = np.concatenate(found)
        rare = rare[np.argsort(rare[:, 0])]
        self.keys, self.to = rare[:, 0].copy(), rare[:, 1].astype(np.int32)

    def encode(self, text: str) -> np.ndarray:
        return self.code[np.frombuffer(text.encode("utf-32-le"), "<u4")]

    def move(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Next states [language, window] on the codes c of the windows; -1 for none."""
        rare = np.flatnonzero(c >= self.dense)
        if not len(rare):
            return self.table.take(state * self.dense + c)
        out = self.table.take(state * self.dense + np.minimum(c, self.dense - 1))
        key = np.broadcast_to(state, out.shape)[:, rare].astype(np.int64) * self.size + c[rare]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        out[:, rare] = np.where(self.keys[at] == key, self.to[at], -1)
        return out

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrase counts [text, language] of normalised texts."""
        lens = np.array([len(t) for t in texts], np.int64)
        count = np.zeros((len(texts), len(self.langs)), np.int64)
        if not lens.sum() or not self.langs:
            return count
        codes = self.encode("".join(texts))
        starts = np.r_[0, np.cumsum(lens)[:-1]]
        parts = -(-lens // WINDOW)
        owner = np.repeat(np.arange(len(texts)), parts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        lo = starts[owner] + nth * WINDOW
        size = np.minimum(WINDOW, starts[owner] + lens[owner] - lo)
        order = np.argsort(-size, kind="stable")
        lo, size, owner = lo[order], size[order], owner[order]
        roots = np.array(self.roots, np.int32)[:, None]
        state = np.repeat(roots, len(lo), 1)
        got = np.zeros((len(self.langs), len(lo)), np.int32)     # phrases begun
        live = np.searchsorted(-size, -np.arange(WINDOW), "left")   # windows longer than step
        for step in range(int(size[0])):
            n = int(live[step])
            if n == 0:
                break
            c = codes[lo[:n] + step]
            now = state[:, :n]
            nxt = self.move(now, c)
            cut = nxt < 0
            got[:, :n] += cut | (now == roots)                     # no phrase is under way at a root
            if cut.any():
                again = self.move(roots, c)                        # the phrase starts anew here
                nxt = np.where(cut, np.where(again < 0, roots, again), nxt)   # a letter never seen stands alone
            state[:, :n] = nxt
        for k in range(len(self.langs)):
            count[:, k] = np.bincount(owner, got[k], len(texts)).astype(np.int64)
        return count

    def predict(self, texts: list) -> tuple[list[str], np.ndarray]:
        """(language, confidence) of raw texts; confidence is the winner's margin over the
        runner-up, relative to the runner-up's cost, raised from 0.5 to 1."""
        norm = [normalise(t) if t else "" for t in texts]
        blank = np.array([not n for n in norm], bool)
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        cost = self.phrases(norm) * np.array(self.cost)
        best = cost.argmin(1) if len(texts) else np.zeros(0, int)
        if len(self.langs) > 1:
            two = np.partition(cost, 1, axis=1)[:, :2] if len(texts) else np.zeros((0, 2))
            conf = 0.5 + 0.5 * (two[:, 1] - two[:, 0]) / np.maximum(two[:, 1], 1e-9)
        else:
            conf = np.ones(len(texts))
        return ["und" if b else self.langs[i] for i, b in zip(best, blank)], np.where(blank, 0.0, conf)


def predict_batches(batches, shared):
    """Worker: (doc_id, held_out, text) to predictions."""
    m = shared.value
    for b in batches:
        texts = b.column("text")
        lang, score = [], [np.zeros(0)]
        for lo, hi in K.slices(texts, 2 << 20):
            names, conf = m.predict(texts.slice(lo, hi - lo).to_pylist())
            lang += names
            score.append(conf)
        yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(np.concatenate(score))],
                              names=["doc_id", "held_out", "lang_pred", "score"])


def sample_rows(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, train_chars: int = TRAIN_CHARS) -> DataFrame:
    """(lang, text) of the rows learned from: per language the first by the hash of id and
    text, until ``train_chars`` are reached. The keys are chosen first (every task sends its
    first ``sample_docs`` of a language only), then their texts are met."""
    text = F.col("text").cast("string")
    usable = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (K.crc_mod(F.col("doc_id"), 4) != 2))
              .select(F.col("lang").cast("string").alias("lang"), F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text).alias("h"),
                      F.length(text).alias("size"), text.alias("text")).where(F.col("size") <= LONGEST))
    first = Window.partitionBy("lang").orderBy("h")
    keys = usable.select("lang", "h", "size").dropDuplicates(["lang", "h"])
    keys = keys.withColumn("n", F.row_number().over(first)).where(F.col("n") <= sample_docs)
    before = F.coalesce(F.sum("size").over(first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    keys = keys.withColumn("before", before).where(F.col("before") < train_chars).select("lang", "h")
    return usable.select("lang", "h", "text").join(F.broadcast(keys), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from the sampled rows of documents with crc32(doc_id) mod 4 not 2: at most
    TRAIN_CHARS + LONGEST characters a language reach the driver."""
    langs = docs.where("lang is not null").select("lang").distinct().limit(MOST_LANGS + 1).count()
    if langs > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    samples: dict[str, list[str]] = {}
    for r in sorted(sample_rows(docs, sample_docs).collect(), key=lambda r: (r.lang, r.h)):
        samples.setdefault(r.lang, []).append(r.text)
    return Model(samples)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per document held_out, lang_pred and score; one pass, no exchange."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (K.crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"),
                      F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return K.arrow_map(src, "starmart.llm.crossparse:predict_batches",
                       "doc_id long, held_out boolean, lang_pred string, score double", shared)
