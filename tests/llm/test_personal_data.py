from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from spendgrid.llm import personal_data as P
from tests.llm.conftest import words

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        k = int(c) * (1 + i % 2)
        total += k - 9 if k > 9 else k
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)) or kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(3)
    pieces = ["a.b", "@", "x-1", ".", "com", " ", "-", "+", "1", "255", "256", "0007", "4111111111111111", "4111 1111-1111 1111", "(", ")", "é", "\n",
              "1.2.3.4", "+49 (30) 1234-567", "%", "_"]
    for _ in range(6000):
        text = "".join(rng.choices(pieces, k=rng.randrange(1, 12)))
        assert P.base_spans(text) == plain_spans(text), text


def test_long_runs_take_time_in_proportion():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "1 " * 1_000_000, "a@" * 500_000, "+1" + " " * 1_000_000, "1." * 1_000_000,
                 "a@b." * 300_000, "at dot " * 200_000, "Mr " * 300_000, ".-" * 500_000 + "@x.de"):
        P.scan_text(text)


def corpus():
    """Personal data in base forms and in others, beside numbers that are none."""
    rng = random.Random(5)
    digits = lambda n: "".join(rng.choices("0123456789", k=n))

    def card(good):
        while True:
            d = "4" + digits(15)
            if luhn(d) == good:
                return d
    rows = []
    for i in range(240):
        prose = words(i, 30)
        kind = i % 12
        insert, wide = {
            0: (f"mail {words(i, 1)[0]}.{i}@mail{i % 9}.example.com", None),
            1: (f"call +49 (30) {digits(3)}-{digits(4)}", None),
            2: (f"card {card(True)}", None),
            3: (f"order {card(False)}", False),
            4: (f"{digits(11)}", False),
            5: (f"invoice {digits(9)}", False),
            6: (f"phone ({digits(3)}) {digits(3)}-{digits(4)}", True),
            7: (f"ssn {digits(3)}-{digits(2)}-{digits(4)}", True),
            8: (f"key=\"{digits(7)}ab{digits(8)}\"", False),
            9: (f"{digits(3)}.{digits(3)}.{digits(3)}", False),
            10: (f"contact {words(i, 1)[0]} (at) mail{i % 7} (dot) com", True),
            11: ("my name is Anna Weber" if i % 2 else "nothing", bool(i % 2) or None),
        }[kind]
        text = " ".join(prose[:15]) + " " + insert + " " + " ".join(prose[15:])
        rows.append((i, text, insert, wide))
    return rows


def test_added_spans_are_those_beyond_the_base_patterns(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id bigint, text string").repartition(4)
    found = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in P.personal_data(docs).collect()}
    right = wrong = 0
    for i, text, insert, wide in rows:
        base = plain_spans(text)
        assert found[i][:len(base)] == base
        added = found[i][len(base):]
        if wide:
            begin = text.index(insert)
            right += any(begin <= a and b <= begin + len(insert) for _, a, b in added)
        else:
            wrong += len(added)
    assert right >= 0.9 * sum(bool(w) for *_, w in rows)
    assert wrong == 0


def test_reliabilities_follow_the_votes():
    names = list(P.LABELERS)
    bit = lambda *x: sum(1 << names.index(n) for n in x)
    p = P.reliabilities([(1, bit("pattern", "calling code"), 500), (1, bit("pattern", "announced"), 200), (1, bit("failed checksum"), 3000),
                         (1, bit("announced", "failed checksum"), 20), (1, 0, 4000), (1, bit("pattern"), 100)])
    assert p[1, bit("pattern", "calling code")] > 0.99 and p[1, bit("pattern")] > 0.5
    assert p[1, bit("failed checksum")] < 0.01 and p[1, 0] < 0.05 and p[1, bit("announced", "failed checksum")] < 0.5


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = P.digest(P.personal_data(odd_docs)).collect()
    assert len(got) == len(odd_rows)
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r["base_sha256"] == empty and r["spans"] == "" for r in got)
    assert P.digest(P.personal_data(no_docs)).collect() == []
    rows = [(1, "x@y.de", 1, "a"), (1, "x@y.de", 1, "a"), (None, "é +1 23456789 x@y.de", 2, "b"), (2, None, 3, "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans int, found string")
    got = sorted((str(r["doc_id"]), r["n_email"], r["n_phone"], r["spans"]) for r in P.digest(P.personal_data(docs)).collect())
    assert got == [("1", 1, 0, "email:0:6"), ("1", 1, 0, "email:0:6"), ("2", 0, 0, ""), ("None", 1, 1, "email:14:20,phone:2:13")]


def test_sample_stands_for_all(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id bigint, text string")
    all_of = {r["doc_id"]: r["spans"] for r in P.digest(P.personal_data(docs)).collect()}
    few = {r["doc_id"]: r["spans"] for r in P.digest(P.personal_data(docs, sample_spans=100)).collect()}
    assert np.mean([all_of[i] == few[i] for i in all_of]) > 0.95
