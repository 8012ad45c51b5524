"""Byte-level BPE with forced-boundary splitting (operator 4).

A pair of adjacent bytes that occurs inside no vocabulary token can never end up in one
token, so every such pair is a certain cut. A text is cut into pre-tokens by the
tokenizer's own pattern, each pre-token into fragments at its certain cuts; fragments are
merged independently (lowest merge rank first) and their ids concatenated. A worker keeps
the ids of fragments and pre-tokens it has met, up to a fixed number of entries.

Defined results: a null or empty text has no ids and decodes to the empty text; the
string of an added token in a text becomes its one id, as the tokenizers library does;
repeated rows repeat their result; texts of any length are encoded whole; an empty table
gives an empty result; further columns are kept as they are.
"""

from __future__ import annotations

import functools
import hashlib
import json
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from starmart.llm.textkit import arrow_map

# Fixed value: the byte-level pre-tokenizer's pattern.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_ENTRIES = 250_000        # pre-tokens, and a third as many fragments, a worker keeps


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others for code points from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        model = spec["model"]
        to_bytes = lambda t: bytes(alphabet[c] for c in t)
        self.token = {i: to_bytes(t) for t, i in model["vocab"].items()}
        id_of = {t: i for i, t in self.token.items()}
        self.first = [id_of[bytes([b])] for b in range(256)]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, m in enumerate(model["merges"]):
            a, b = (m.split(" ") if isinstance(m, str) else m)
            a, b = to_bytes(a), to_bytes(b)
            self.rank.setdefault((id_of[a], id_of[b]), rank)
            self.made.append(id_of[a + b])
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for t, i in self.added.items():
            self.token[i] = t.encode()
        self.joint = np.zeros((256, 256), bool)     # pairs inside some token
        for t in id_of:
            for x, y in zip(t, t[1:]):
                self.joint[x, y] = True
        self.inside = {(int(x), int(y)) for x, y in zip(*np.nonzero(self.joint))}
        self.pretokens = regex.compile(PRETOKEN).findall
        self.splitter = (regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
                         if self.added else None)
        self.fragments: dict[bytes, tuple] = {}
        self.pieces: dict[str, bytes] = {}
        size = max(self.token) + 1
        parts = [self.token.get(i, b"") for i in range(size)]
        self.lens = np.array([len(p) for p in parts], np.int64)
        self.starts = np.r_[0, np.cumsum(self.lens)[:-1]]
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)

    def fragment(self, data: bytes) -> tuple:
        """Merge one fragment: the pair of lowest rank first, leftmost among equals."""
        ids = self.fragments.get(data)
        if ids is None:
            seq, rank, never = [self.first[b] for b in data], self.rank.get, len(self.made)
            ranks = [rank(pair, never) for pair in zip(seq, seq[1:])]
            while ranks:
                best = min(ranks)
                if best == never:
                    break
                at, new = ranks.index(best), self.made[best]
                if len(seq) > 256:      # a long run: apply the rank everywhere at once
                    seq = self._merge_all(seq, new, (seq[at], seq[at + 1]))
                    ranks = [rank(pair, never) for pair in zip(seq, seq[1:])]
                    continue
                seq[at:at + 2] = [new]
                del ranks[at]
                if at < len(ranks):
                    ranks[at] = rank((new, seq[at + 1]), never)
                if at:
                    ranks[at - 1] = rank((seq[at - 1], new), never)
            ids = tuple(seq)
            if len(data) <= 64:
                if len(self.fragments) >= CACHE_ENTRIES // 3:
                    self.fragments.clear()
                self.fragments[data] = ids
        return ids

    @staticmethod
    def _merge_all(seq, new, pair):
        """Replace the pair everywhere, left to right, which is what repeated leftmost
        merging of that rank does: a new token's own merges rank after its making."""
        out, i, n = [], 0, len(seq)
        while i < n:
            if i + 1 < n and (seq[i], seq[i + 1]) == pair:
                out.append(new)
                i += 2
            else:
                out.append(seq[i])
                i += 1
        return out

    def piece(self, text: str) -> bytes:
        """Ids of one pre-token as little-endian uint32 bytes: cut, merge, concatenate."""
        data, inside = text.encode(), self.inside
        ids, a = [], 0
        for z, pair in enumerate(zip(data, data[1:]), 1):
            if pair not in inside:
                ids += self.fragment(data[a:z])
                a = z
        ids += self.fragment(data[a:])
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(text) <= 64:
            if len(self.pieces) >= CACHE_ENTRIES:
                self.pieces.clear()
            self.pieces[text] = out
        return out

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.splitter and any(t in text for t in self.added):
            parts = self.splitter.split(text)
            return b"".join(np.array([self.added[p]], "<u4").tobytes() if k % 2 else self._plain(p)
                            for k, p in enumerate(parts) if p)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        known, piece = self.pieces.get, self.piece
        return b"".join([known(p) or piece(p) for p in self.pretokens(text)])

    def decode(self, ids: bytes) -> str:
        """Text of the ids; bytes that are no UTF-8 become U+FFFD."""
        t = np.frombuffer(ids, "<u4")
        if not len(t):
            return ""
        n = self.lens[t]
        ends = np.cumsum(n)
        at = np.repeat(self.starts[t] - (ends - n), n) + np.arange(ends[-1])
        return self.bytes[at].tobytes().decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One codec a worker and file."""
    return Codec(path)


def digest_batches(batches, path: str):
    """Worker: one row of counts and digests a document."""
    c = codec(path)
    for b in batches:
        rows = []
        for text in b.column("text").to_pylist():
            ids = c.encode(text)
            back = c.decode(ids).encode()
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()))
        cols = list(zip(*rows)) or [()] * 3
        yield pa.record_batch([b.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                               pa.array(cols[2], pa.string())],
                              names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def id_batches(batches, path: str):
    """Worker: the ids themselves beside each document's other columns."""
    c = codec(path)
    for b in batches:
        ids = [np.frombuffer(c.encode(t), "<u4") for t in b.column("text").to_pylist()]
        offs = np.r_[0, np.cumsum([len(i) for i in ids])].astype(np.int32)
        flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
        keep = [n for n in b.schema.names if n not in ("token_ids", "n_tokens")]
        yield pa.record_batch([b.column(n) for n in keep]
                              + [pa.ListArray.from_arrays(pa.array(offs), pa.array(flat)), pa.array(np.diff(offs).astype(np.int64))],
                              names=keep + ["token_ids", "n_tokens"])


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The documents with ``token_ids array<int>`` and ``n_tokens`` added (columns of
    those names that were there are replaced)."""
    keep = docs.drop("token_ids", "n_tokens")
    from pyspark.sql import types as T
    schema = T.StructType([*keep.schema.fields, T.StructField("token_ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_tokens", T.LongType())])
    return arrow_map(keep, "starmart.llm.forced_bpe:id_batches", schema, path or default_path())


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document the token count and the digests of its ids and of their decoding."""
    src = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return arrow_map(src, "starmart.llm.forced_bpe:digest_batches",
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", path or default_path())
