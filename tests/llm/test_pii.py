import hashlib
import random
import re

from hirelens.llm import pii

PARTS = ["a@b.c", "_d", "@", "x.", "..", "1.2.3.4", "255.", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
         "+1 (406) 555-0909", "+", "12", "é", "😀", "\n", " ", "-", "(", "99999", "aaa", ".com", "5",
         "DE89 3704 0044 0532 0130 00", "ssn 123-45-6789", "call 406-555-1212"]


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(t):
    """The base rules with the plain patterns."""
    out = [("email", m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, ok in (("card", r"[0-9]([\x20-]?[0-9])+", lambda d: 16 <= len(d) <= 19 and luhn(d)),
                              ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda d: 8 <= len(d) <= 15)):
        out += [(kind, m.span()) for m in re.finditer(pattern, t) if ok(re.sub("[^0-9]", "", m[0]))]
    return out


def test_base_spans_against_plain_patterns(make_docs):
    rnd = random.Random(3)
    texts = ["".join(rnd.choices(PARTS, k=rnd.randint(0, 12))) for _ in range(4000)] + [None, ""]
    got = pii.report(make_docs(list(enumerate(texts)), extra=True)).collect()
    for r in got:
        want = base(texts[r.doc_id] or "")
        text = ",".join(f"{k}:{s}:{e}" for k, (s, e) in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _ in want) for k in pii.BASE]
        assert r.spans.startswith(text)


def spans(make_docs, text):
    return [(s.kind, s.text) for s in pii.find_pii(make_docs([(1, text)])).first().spans]


def test_added_kinds_need_validation_or_context(make_docs):
    assert spans(make_docs, "IBAN DE89 3704 0044 0532 0130 00.") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert spans(make_docs, "IBAN DE88 3704 0044 0532 0130 00.") == []
    assert spans(make_docs, "my ssn is 123-45-6789") == [("ssn", "123-45-6789")]
    assert spans(make_docs, "item 123-45-6789") == [] == spans(make_docs, "ssn 666-45-6789")
    assert spans(make_docs, "call 406-555-1212 now") == [("local", "406-555-1212")]
    assert spans(make_docs, "lot 406-555-1212 now") == []
    assert spans(make_docs, "clean words only, 3.14 and 2024-01-02") == []


def test_redaction(make_docs):
    docs = make_docs([(1, "x a@b.co y 4111 1111 1111 1111 z +1 406 555 0909. é q"), (2, None), (3, "plain"), (4, "a@b.co")], extra=True)
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {
        1: "x [EMAIL] y [CARD] z [PHONE]. é q", 2: None, 3: "plain", 4: "[EMAIL]"}


def test_long_texts_are_read_once(make_docs):
    rows = [(1, "a" * 200_000), (2, "1" * 200_000), (3, "a@b" + ".c" * 100_000), (4, "1 " * 100_000),
            (5, "+1" + " 2" * 100_000), (6, "1.2.3.4 " * 5_000), (7, "+1" * 100_000)]
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.report(make_docs(rows)).collect()}
    assert got == {1: (0,) * 4, 2: (0,) * 4, 3: (1, 0, 0, 0), 4: (0,) * 4, 5: (0,) * 4, 6: (0, 5000, 0, 0), 7: (0,) * 4}


def test_plan_is_native_and_empty_table(make_docs):
    df = pii.report(make_docs([]))
    assert df.collect() == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
