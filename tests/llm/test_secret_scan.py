"""Secret spans against plain patterns; linking of weak parts; redaction."""

import hashlib
import re

import pytest

from lakemart.llm.secret_scan import redact_secrets, redacted, secret_scan, spans_of

PATTERNS = {
    "assign": r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
KEY = "wJalrXUtnFEMI7K5MDENG2bPxRfiCYEXAMP1EKEY"
ID = "AKIA" + "ABCDEFGH12345678"


def base(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or "", re.I | re.A if kind == "assign" else 0):
            if len(m[2] if kind == "assign" else m[0]) >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [span for *_, span in sorted(out)]


def check(docs):
    texts = [row.text for row in docs.select("text").collect()]
    found = secret_scan(docs).collect()
    expected = []
    for row, text in zip(docs.select("doc_id").collect(), texts):
        spans = base(text)
        counts = [sum(s.startswith(kind) for s in spans) for kind in PATTERNS]
        expected.append((row.doc_id, *counts, hashlib.sha256(",".join(spans).encode()).hexdigest()))
    assert sorted(map(repr, (tuple(row)[:5] for row in found))) == sorted(map(repr, expected))
    for row in found:
        assert row.spans or row.n_assign + row.n_access + row.n_hex == 0
    return found


def test_given_documents(tiny_docs):
    check(tiny_docs[0])


def test_odd_documents(odd_docs):
    check(odd_docs)


def test_no_documents(no_docs):
    assert secret_scan(no_docs).collect() == []


def test_base_patterns(make_docs):
    hexes = "0123456789abcdef" * 2
    check(
        make_docs(
            (1, "Token: abcdef token='abcde' API_KEY = \"x.y=z/9\" apikey:12345 ſecret=abcdefgh"),
            (2, f"é🎉 {ID} AKIA123 {ID}x {hexes} {hexes[:23]} {hexes.upper()}"),
            (3, "password=token=secret=abcdefg passwd  :  hunter22 to" + "ken" * 5 + "=1234567"),
            (4, "Kpassword=ABCDEFG tokeN=abcdef1 secret\n=abcdefg secret =\nabcdefg"),
        )
    )


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        (KEY, []),  # a weak secret alone
        (f"see https://db.example.com/x {KEY}", ["secret"]),  # with an endpoint
        (f"{ID} {KEY}", ["access", "secret"]),  # with an access id
        (f"username: bob {KEY} https://a.example.com", ["identifier", "secret", "endpoint"]),
        ("username: bob at https://a.example.com", []),  # no secret at all
        (f"{ID} https://a.example.com", ["access"]),
        ("password = hunter22 db.example.com:5432", ["assign"]),  # an endpoint needs an id too
        ("user = bob password = hunter22 db.example.com:5432", ["identifier", "assign", "endpoint"]),
        (f"{ID}\n\n{KEY}", ["access"]),  # a blank line between
        (f"{ID}{' ' * 201}{KEY}", ["access"]),  # out of reach
        (f"{ID}{' ' * 200}{KEY}", ["access", "secret"]),
    ],
)
def test_weak_parts_need_their_complements(text, kinds):
    assert [kind for kind, _, _ in spans_of(text)[1]] == kinds


@pytest.mark.parametrize("n", [128, 129, 200, 5000])
def test_a_weak_secret_may_be_of_any_length(n):
    secret = (KEY * (n // len(KEY) + 1))[:n]
    text = f"{ID} {secret}== end"
    assert spans_of(text)[1] == [("access", 0, 20), ("secret", 21, 23 + n)]
    assert redacted(text) == "[redacted] [redacted] end"


def test_many_parts_in_one_text():
    text = f"{ID} {KEY} https://a.example.com " * 3000
    spans = spans_of(text)[1]
    assert len(spans) == 9000
    # and without company none of them
    assert spans_of(f"{KEY} " * 3000)[1] == []


def test_redaction_keeps_all_else(spark, make_docs):
    assert redacted("a token = abcdefgh b") == "a [redacted] b"
    assert redacted("nothing here") == "nothing here"
    docs = make_docs((1, "x token=abcdefgh y"), (2, None), (3, "plain"), (3, "plain"))
    out = redact_secrets(docs)
    assert out.columns == docs.columns
    assert sorted((row.doc_id, row.text or "") for row in out.collect()) == [
        (1, "x [redacted] y"), (2, ""), (3, "plain"), (3, "plain")
    ]
    assert out.where("doc_id = 2 and text is null").count() == 1
