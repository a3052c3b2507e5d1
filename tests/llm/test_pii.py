from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from ledgermill.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        twice = [d if n % 2 == 0 else d * 2 - 9 * (d > 4) for n, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def brute_force(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]


def written(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def texts():
    rng = random.Random(6)
    bits = [
        "a.b@c.de", "x@y.z.w", "@", "a@b@c.d", "1.2.3.4", "10.0.300.1", "1.2.3.4.5.6.7.8", "007.1.1.1", "4804024845641364",
        "4804-0248 4564 1364", "4804024845641365", "+1 (215) 555-8778", "+1", "+12345678901234567", "é日本", "😀", "\x01", "\n",
        "Password=hunter22x", 'token = "0641917ea4e9feb9cda8"', " ", "-", ".", "7", "_d@e.f", "%%", "+", "(", "Version 2.0.",
    ]
    made = ["".join(rng.choice(bits) + rng.choice(["", " ", ", "]) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    return [None, "", "1" * 20_000, "a" * 20_000, "1-" * 9_000, "+1" + "(" * 9_000, "a@b." * 2_000, *made]


def test_base_rules_equal_plain_patterns(docs):
    rows = [(n % 350 if n else None, t) for n, t in enumerate(texts())]
    got = pii.personal_data_report(docs(*rows)).collect()
    want = []
    for d, t in rows:
        spans = brute_force(t)
        counts = [sum(k == kind for k, _, _ in spans) for kind in PATTERNS]
        want.append((d, *counts, hashlib.sha256(written(spans).encode()).hexdigest()))
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    # Base spans stay, in their order, among all.
    base = {(d, written(brute_force(t))) for d, t in rows}
    listed = {(r.doc_id, ",".join(s for s in r.spans.split(",") if s)) for r in got}
    for d, spans in base:
        assert any(d == e and set(spans.split(",")) - {""} <= set(more.split(",")) for e, more in listed)


def test_trees_add_what_looks_like_the_seeds_and_leave_clean_texts(docs):
    rng = random.Random(3)
    rows = []
    for n in range(600):
        secret = "".join(rng.choice("0123456789abcdef") for _ in range(18))
        phone = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        wrong = f"{rng.randint(256, 999)}.1.1.{rng.randint(256, 999)}"
        rows.append((n, f"plain words here password={secret} and {phone} then {wrong} in version 2.0, line {n}"))
    rows += [(1000 + n, "only plain words, 12 of them, in 2024") for n in range(50)]
    got = {r.doc_id: r for r in pii.personal_data_report(docs(*rows)).collect()}
    assert all(got[1000 + n].spans == "" for n in range(50))
    assert sum("secret:" in got[n].spans for n in range(600)) > 590
    assert not any("ip:" in got[n].spans for n in range(600))


def test_redaction(docs):
    rows = [(1, "é mail a@b.cd, card 4804024845641364."), (2, None), (3, "clean"), (None, "1.2.3.4")]
    out = pii.redact(docs(*rows))
    assert out.columns == docs(*rows).columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(1, "é mail [EMAIL], card [CARD]."), (2, None), (3, "clean"), (None, "[IP]")], key=str
    )


def test_empty_table(docs):
    assert pii.personal_data_report(docs()).count() == 0


def test_only_columns_are_used(spark, docs):
    plan = pii.personal_data(docs((1, "a@b.cd")))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert isinstance(F.col("x"), type(pii.located(F.col("x"), "a")))


def test_texts_without_digits_have_candidates(docs):
    texts = {"say password: correcthorse": "secret", "secret=AbcdefGhij": "secret", "name @ host.org": "email",
             "ABCDEFGHIJKLMNOPQR": "secret", "ab:cd:ef:ab": "ip", "a quiet river": None}
    rows = docs(*enumerate(texts)).select("text", pii.candidates(F.col("text"))["kind"].alias("kinds")).collect()
    assert {r.text: next(iter(r.kinds), None) for r in rows} == texts


def test_a_seldom_kind_has_its_threshold(docs):
    rng = random.Random(4)
    rows = []
    for n in range(400):
        phone, wrong = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", f"{rng.randint(256, 999)}.1.1.7"
        own = f" password={rng.getrandbits(64):016x}" if n % 16 == 0 else ""
        rows.append((n, f"plain words and {phone} then {wrong}{own} line {n}"))
    spans = {r.doc_id: r.spans for r in pii.personal_data_report(docs(*rows)).collect()}
    assert all("secret:" in spans[n] for n in range(0, 400, 16))


def test_every_kind_is_learnt_from():
    assert pii._shares({"secret": 50, "card": 1_000_000, "phone": 10_000}) == {"secret": 1.0, "phone": 0.9975, "card": 0.009975}


def test_seeds_are_confirmed_by_their_own_kind(docs):
    texts = [
        "host 192.168.100.200 up", "pay 4804024845641364 now", "pay 4804024845641365 now", "password=hunter22x", "password: xxxxxxxx",
        "commit 0641917ea4e9feb9cda8", "at 12:30:45:10", "fe80:1:2:3:4:5:6:7", "on 2024-05-06 we", "mail a.b@c.de or x @ y.5", "+1 (215) 555-8778",
    ]
    rows = docs(*enumerate(texts)).select("text", F.explode(pii.seeds(F.col("text"))).alias("s")).collect()
    got = {(r.s.c.kind, r.s.c.value, r.s.label) for r in rows}
    assert got == {
        ("ip", "192.168.100.200", 1.0), ("phone", "192.168.100.200", 0.0),
        ("card", "4804024845641364", 1.0), ("phone", "4804024845641364", 0.0), ("secret", "4804024845641364", 0.0),
        ("card", "4804024845641365", 0.0), ("phone", "4804024845641365", 0.0), ("secret", "4804024845641365", 0.0),
        ("secret", "password=hunter22x", 1.0), ("secret", "password: xxxxxxxx", 0.0), ("secret", "0641917ea4e9feb9cda8", 0.0),
        ("ip", "12:30:45:10", 0.0), ("ip", "fe80:1:2:3:4:5:6:7", 1.0), ("phone", "2024-05-06", 0.0),
        ("email", "a.b@c.de", 1.0), ("email", "x @ y.5", 0.0), ("phone", "+1 (215) 555-8778", 1.0),
    }


def test_sums_and_meetings_equal_plain_python(spark):
    rng = random.Random(8)
    span = "array<struct<kind:string,start:int,end:int>>"
    rows = []
    for n in (0, 1, 2, 255, 256, 257, 600, 1_500):
        made = [[("k", a, a + rng.randint(1, 6)) for a in (rng.randint(0, 9 * n) for _ in range(n))] for _ in range(2)]
        rows.append((n, [rng.randint(0, 9) for _ in range(n)], *made))
    frame = spark.createDataFrame(rows, f"n int, v array<int>, spans {span}, others {span}")
    got = frame.select(
        "n", pii.running(F.col("v"), lambda a, b: a + b).alias("sums"), pii.touched(F.col("spans"), F.col("others")).alias("met")
    )
    by_n = {r.n: r for r in got.collect()}
    for n, v, spans, others in rows:
        assert by_n[n].sums == [sum(v[:i]) for i in range(n)]
        want = [(any(a < d and c < b for _, c, d in others), k, a, b) for k, a, b in spans]
        assert sorted((m.meets, *m.span) for m in by_n[n].met) == sorted(want)


def test_thresholds_need_no_least_number_of_seeds():
    many = {("phone", 90): (500.0, 500), ("phone", 10): (0.0, 500)}
    assert pii._thresholds(many) == {kind: 0.9 for kind in pii.KINDS}
    assert pii._thresholds({**many, ("card", 95): (400.0, 400), ("card", 90): (0.0, 300)})["card"] == 0.95
    assert pii._thresholds({}) == {}


def test_very_many_matches_in_one_text(docs):
    # Some 20,000 addresses and keys; the work must not grow with their square.
    text = " ".join(f"a{n}@b.cd 10.0.{n % 256}.1 password=pw{n:06d}z" for n in range(10_000))
    rows = docs((1, text), (2, "é a@b.cd"), *((n, f"password=hunt{n:05d} or 999.1.1.{n}") for n in range(3, 300)))
    got = {r.doc_id: r for r in pii.personal_data_report(rows).collect()}
    assert (got[1].n_email, got[1].n_ip) == (10_000, 10_000)
    assert got[1].spans.count("secret:") == 10_000
    clean = {r.doc_id: r.text for r in pii.redact(rows).collect()}
    assert clean[1] == " ".join(["[EMAIL] [IP] [SECRET]"] * 10_000)
    assert clean[2] == "é [EMAIL]"


def test_columns_named_like_helpers_are_kept(docs):
    names = ("_doc", "_whole", "_base", "_spans", "_found", "_hash", "s")
    frame = docs((1, "mail a@b.cd"), (2, None), (3, "")).selectExpr("*", *(f"concat('{name}', doc_id) AS {name}" for name in names))
    out = pii.redact(frame)
    assert out.columns == frame.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert {n: r.text for n, r in rows.items()} == {1: "mail [EMAIL]", 2: None, 3: ""}
    assert all(r[name] == f"{name}{r.doc_id}" for r in rows.values() for name in names)
