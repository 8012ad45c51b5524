import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starmart.llm import forced_bpe as B
from tests.llm.conftest import edge_rows

PATH = B.default_path()
LIB = Tokenizer.from_file(PATH)
OWN = B.codec(PATH)


def lib_ids(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


def own_ids(text):
    return np.frombuffer(OWN.encode(text), "<u4").tolist()


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    assert own_ids(text) == lib_ids(text)
    assert OWN.decode(OWN.encode(text)) == LIB.decode(lib_ids(text), skip_special_tokens=False) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "'s", "'", "t", " ", "  ", "\n", "é", "1", "!", "<|endoftext|>", "日", "'LL", "\t", "\r", "ing", " the"]), max_size=15))
def test_joined_pieces(parts):
    assert own_ids("".join(parts)) == lib_ids("".join(parts))


def test_certain_cuts_lie_in_no_token():
    tokens = set(OWN.token.values()) - {b"<|endoftext|>"}
    inside = {(a, b) for t in tokens for a, b in zip(t, t[1:])}
    assert inside == OWN.inside and 0 < len(inside) < 65_536


def test_long_runs_and_bounded_caches(monkeypatch):
    monkeypatch.setattr(B, "CACHE_ENTRIES", 50)
    c = B.Codec(PATH)
    for text in ("a" * 30_000, "abcab" * 4_000, " ".join(f"w{i}x" for i in range(500)), "\n" * 5_000):
        assert np.frombuffer(c.encode(text), "<u4").tolist() == lib_ids(text)
    assert len(c.pieces) <= 50 and len(c.fragments) <= 50


def test_broken_ids_decode_like_the_library():
    for ids in ([0xE9], [50256, 64], [19526, 254], [19526], [126, 126, 35]):
        assert OWN.decode(np.array(ids, "<u4").tobytes()) == LIB.decode(ids, skip_special_tokens=False)


def test_documents(small_docs, edge, clashing, empty):
    for docs in (small_docs, edge):
        ref = sorted((r.doc_id is not None, r.doc_id or 0, len(lib_ids(r.text)), hashlib.sha256(np.array(lib_ids(r.text), "<u4").tobytes()).hexdigest(),
                      hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.select("doc_id", "text").collect())
        got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in B.digests(docs).collect())
        assert got == ref
    out = B.encode_documents(clashing)
    assert out.columns == clashing.columns + ["token_ids", "n_tokens"]
    for r in out.collect():
        assert r.token_ids == lib_ids(r.text) and r.n_tokens == len(r.token_ids) and r.key == 1
    assert B.digests(empty).count() == 0 and B.encode_documents(empty).count() == 0
    assert len(edge_rows()) == out.count()
