import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from starmart.llm import pii
from tests.llm.conftest import CLASH_NAMES


def plain(text):
    """The contract's patterns as they are written."""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m.group() if c in "0123456789") <= 15]
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab0159.-+@ ()%é\n", max_size=60))
def test_base_spans_equal_the_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="0123456789 -", max_size=80))
def test_digit_runs_equal_the_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_every_document_against_the_plain_patterns(small_docs, edge, empty):
    for docs in (small_docs, edge):
        ref = {}
        for r in docs.collect():
            b = plain(r.text or "")
            row = tuple(sum(k == kind for k, *_ in b) for kind in pii.BASE_KINDS)
            ref.setdefault(r.doc_id, []).append((*row, hashlib.sha256(",".join(f"{k}:{a}:{z}" for k, a, z in b).encode()).hexdigest()))
        got = {}
        for r in pii.detect(docs).collect():
            got.setdefault(r.doc_id, []).append((r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256))
            assert all(s.split(":")[0] in pii.CONTEXT for s in r.spans.split(",") if s)
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in ref.items()}
    assert pii.detect(empty).count() == 0


def test_checksums_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB82 WEST 1234 5698 7654 33")
    assert "iban:5:32" in pii.joined(pii.find_spans("IBAN GB82 WEST 1234 5698 7654 32 ok")[1])
    assert pii.find_spans("nr GB82 WEST 1234 5698 7654 33")[1] == []
    # a number that looks like one needs a word nearby
    assert [k for k, *_ in pii.find_spans("ssn 123-45-6789")[1]] == ["ssn"]
    assert pii.find_spans("part 123-45-6789")[1] == [] and pii.find_spans("value 123-45-6789")[1] == []
    assert pii.span_score("card 4111111111111111", "card", 5, 21) > pii.span_score("isbn 4111111111111111", "card", 5, 21)
    assert [k for k, *_ in pii.find_spans('token = "24be64439e3e49cf46b2"')[1]] == ["secret"]


def test_long_texts_take_linear_time():
    import time
    t0 = time.time()
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" + "(" * 200_000, "AB12" * 50_000, "1 " * 100_000, "a." * 50_000 + "@"):
        pii.find_spans(text)
    assert time.time() - t0 < 20


def test_redaction_takes_the_data_and_leaves_the_rest(clashing, empty):
    out = pii.redacted(clashing)
    assert out.columns == clashing.columns
    rows = {(r.doc_id, r.n_chars): r for r in out.collect()}
    assert len(rows) <= clashing.count() == out.count()
    by = [r for r in out.collect() if r.doc_id == 9][0]
    assert by.text == "mail <EMAIL> or <PHONE>, card <CARD>, host <IP>" and by.n_chars == len(by.text)
    before = {(r.doc_id, r.text) for r in clashing.collect() if r.doc_id != 9}
    assert {(r.doc_id, r.text) for r in out.collect() if r.doc_id != 9} == before
    assert all(tuple(by[c] for c in CLASH_NAMES) == (0.5, 1, 2, 3, 4, 5, 6, 7, 8, "p", 9, "0:1", 1) for _ in [0])
    assert pii.redacted(empty).count() == 0
    assert pii.redact("ab cd", [("x", 0, 4), ("y", 3, 5)]) == "<X>"


def test_a_long_secret_is_matched_to_its_end():
    secret = "aB3" * 700
    assert secret[-4:] not in pii.redact(f"token={secret} end", pii.find_spans(f"token={secret} end")[1])


def test_ibans_end_where_their_country_says():
    text = "IBAN GB82 WEST 1234 5698 7654 32 IS VALID; DE89370400440532013000. NL91ABNA0417164300X GB82WEST1234569876543"
    assert [text[a:z] for a, z in pii.ibans(text)] == ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"]
    spans = [text[a:z] for k, a, z in pii.added_spans(text) if k == "iban"]
    assert spans == ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"]
    assert pii.ibans("ZZ00 1234") == [] and pii.ibans("GB82") == [] and pii.ibans("GB82 ") == []


def test_marked_credentials_need_no_key_word():
    secrets = ["AKIA" + "A1B2" * 4, "ghp_" + "aB3" * 12, "-----BEGIN RSA PRIVATE KEY-----"]
    text = " and ".join(secrets)
    assert [text[a:z] for k, a, z in pii.added_spans(text) if k == "secret"] == secrets
    once = "token = ghp_" + "aB3" * 12
    assert [once[a:z] for k, a, z in pii.added_spans(once) if k == "secret"] == ["ghp_" + "aB3" * 12]
