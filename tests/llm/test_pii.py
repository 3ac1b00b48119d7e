import hashlib
import re

from conftest import SF_DIR

from tradewatch.llm import pii
from tradewatch.llm.queries import QUERIES


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d // 10 + d % 10
    return total % 10 == 0


def plain_spans(text):
    """The four forms read off their definition."""
    only = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 16 <= len(only(m.group())) <= 19 and luhn(only(m.group())):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(only(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


CASES = [
    "", "a@b", "a@b.c", "x a.b+c@d-e.f.g. y@z.q", "@@a@b.c@d.e", "é1@x.y", "..@a.b..c",
    "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.255", "0001.2.3.0255", "1.2.3", "12.34.56.78.90",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111", "🙂 4111111111111111",
    "+1 (277) 555-1161", "+1", "+12345678)", "++49 30 1234567", "+1 2 3", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
]


def test_base_forms():
    for text in CASES:
        assert pii.base_spans(text) == plain_spans(text), text


def test_query_equals_plain_search(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op5_pii"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain_spans(texts[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) - {""} <= set(r.spans.split(","))
        counts = [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts


def test_context_discovers_unseen_identifiers(make_docs):
    known = [(i, f"please write to person{i}@mail.example.org today") for i in range(6)]
    hidden = (10, "please write to jürgen@intranet today")
    clean = (11, "version 4.0 was written to disk a@ 1.2.3.4.5")
    found = {r.doc_id: r for r in pii.find(make_docs(*known, hidden, clean)).collect()}
    assert [tuple(s) for s in found[10].spans] == [("email", 16, 31)] and found[10].base == []
    assert [s.kind for s in found[11].spans] == ["ip"]
    cut = {r.doc_id: r for r in pii.redact(make_docs(*known, hidden, clean)).collect()}
    assert cut[10].text == "please write to [EMAIL] today" and cut[10].n_chars == len(cut[10].text)


def carded(i):
    """A card number of four groups that passes the check sum."""
    body = f"4111 1111 1111 {i:03d}"
    return next(f"{body}{d}" for d in range(10) if luhn(f"{body}{d}".replace(" ", "")))


def test_context_discovers_identifiers_with_spaces_and_long_ones(make_docs):
    phones = [(100 + i, f"please call us under +49 30 12345{i:02d} after noon") for i in range(40)]
    cards = [(200 + i, f"my credit card {carded(i)} was stolen") for i in range(40)]
    mails = [(300 + i, f"kindly write to person{i}@mail.example.org today") for i in range(40)]
    long = "ü" * 120 + "@intranet"
    hidden = {
        30: ("please call us under {} after noon", "030 123 4567", "phone"),
        31: ("please call us under {} after noon", "0171 234 56 78", "phone"),
        32: ("please call us under {} after noon", "(407) 555-7710", "phone"),
        33: ("my credit card {} was stolen", "4111 1111 1111 1112", "card"),
        34: ("kindly write to {} today", long, "email"),
        # Beside a base span, and in brackets.
        35: ("1.2.3.4 please call us under {} 1.2.3.4 after noon", "030 123 4568", "phone"),
        36: ("please call us under ({}) after noon", "030-123-4569", "phone"),
    }
    rows = [(k, form.format(value)) for k, (form, value, _) in hidden.items()]
    other = [(40, "in 1999 2000 2001 it rained"), (41, "room 4 on floor 12 - 7")]
    docs = make_docs(*phones, *cards, *mails, *rows, *other)
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    cut = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    for k, (form, value, kind) in hidden.items():
        start = form.index("{}")
        assert (kind, start, start + len(value)) in {tuple(s) for s in found[k].spans}, value
        assert sum(s.kind == kind for s in found[k].spans) == 1
        assert cut[k] == form.format(f"[{kind.upper()}]").replace("1.2.3.4", "[IP]")
    assert [list(found[k].spans) for k in (40, 41)] == [[], []]


def test_awkward_and_empty(awkward, empty):
    rows = pii.find(awkward).collect()
    assert len(rows) == awkward.count()
    assert {len(r.spans) for r in rows if r.doc_id == 7} == {1}
    cut = pii.redact(awkward)
    assert cut.columns == awkward.columns
    assert [r.text for r in cut.collect() if r.doc_id == 7] == [
        "é ü 漢字 🙂 mail [EMAIL] now \x00 end"
    ]
    assert pii.find(empty).count() == 0 and pii.redact(empty).count() == 0


def test_every_copy_of_a_text_gains_its_spans(make_docs):
    known = [(i, f"please write to person{i}@mail.example.org today") for i in range(6)]
    copies = [(100 + i, "please write to jürgen@intranet today") for i in range(90)]
    rest = [(None, "please write to jürgen@intranet today"), (7, None), (8, ""), (9, "room 4"), (9, "room 4")]
    rows = pii.find(make_docs(*known, *copies, *rest)).collect()
    assert len(rows) == len(known) + len(copies) + len(rest)
    gained = [r.doc_id for r in rows if [tuple(s) for s in r.spans] == [("email", 16, 31)]]
    assert sorted(gained, key=str) == sorted([i for i, _ in copies] + [None], key=str)
    assert all(r.base == r.spans for r in rows if r.doc_id not in gained)
