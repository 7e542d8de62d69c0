"""Personal data: the plain spans against the patterns as they are written down, disguises one by one."""

from __future__ import annotations

import hashlib
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skytally.llm import pii
from skytally.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def digits(text):
    return [int(c) for c in text if c in "0123456789"]


def card(text):
    d = digits(text)
    total = 0
    for k, x in enumerate(reversed(d)):
        total += x if k % 2 == 0 else x * 2 - 9 * (x > 4)
    return 16 <= len(d) <= 19 and total % 10 == 0


PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", card),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
}


def brute(text):
    return [(kind, *m.span()) for kind, (pattern, good) in PLAIN.items() for m in re.finditer(pattern, text or "") if good(m[0])]


def added(text):
    plain, spans = next(pii.scan(pa.array([text])))
    return [(kind, text[a:b]) for kind, a, b in spans if (kind, a, b) not in plain]


def test_plain_spans_equal_the_patterns():
    draw = random.Random(5)
    for alphabet in ("ab@.-1 +", "0123456789 -.", "+1234567890 ().-", "a1.@", "4 -0", "25.0+@x"):
        for _ in range(3000):
            text = "".join(draw.choices(alphabet, k=draw.randrange(40)))
            assert pii.plain_spans(text) == brute(text), text
    for text in ("a@b@c.com@d.e", "1.2.3.4.5.6.7.8.9", "1.2.3.256 1.2.3.004", "4111-1111 1111  1111", "4111 1111 1111 1111", "é@b.c", "+1" + "2" * 20):
        assert pii.plain_spans(text) == brute(text), text


@pytest.mark.parametrize(
    "text, kind, source",
    [
        ("write to john at mail5 dot example dot com.", "email", "john at mail5 dot example dot com"),
        ("19 (at) mail5.example.com", "email", "19 (at) mail5.example.com"),
        ("x john[dot]doe [AT] mail[dot]example[dot]com y", "email", "john[dot]doe [AT] mail[dot]example[dot]com"),
        ("john.doe at example.com, or", "email", "john.doe at example.com"),
        ("jоhn＠mаil．com", "email", "jоhn＠mаil．com"),
        ("ana arroba casa punto es", "email", "ana arroba casa punto es"),
        ("john&#64;mail.com", "email", "john&#64;mail.com"),
        ("john_at_mail_dot_com", "email", "john_at_mail_dot_com"),
        ("at 129[.]38[.]82[.]176 now", "ip", "129[.]38[.]82[.]176"),
        ("one two nine dot three eight dot eight two dot one", "ip", "one two nine dot three eight dot eight two dot one"),
        ("١٢٩.38.82.١٧٦", "ip", "١٢٩.38.82.١٧٦"),
        ("l29.38.82.I76", "ip", "l29.38.82.I76"),
        ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
        ("4111 1111‑1111 1111", "card", "4111 1111‑1111 1111"),
        ("four one double one 1111 1111 1111", "card", "four one double one 1111 1111 1111"),
        ("plus one four eight seven five five five seven two zero nine!", "phone", "plus one four eight seven five five five seven two zero nine"),
        ("+1 (vier acht sieben) 555-72O9", "phone", "+1 (vier acht sieben) 555-72O9"),
        ("\U0001f600 +1​ (487) 555–7209", "phone", "+1​ (487) 555–7209"),
    ],
)
def test_disguises_are_found_where_they_stand(text, kind, source):
    assert added(text) == [(kind, source)]


@pytest.mark.parametrize(
    "text",
    [
        "That at andthwhat. Anes", "looking at example.com or so", "5 @ 3.50 each", "to the point. One of them at home.",
        "+44 20 7946 0958 one", "un deux trois at quatre. Cinq", "version one.two.three", "a@b.com, 1.2.3.4", "", "été à l'étranger; größe",
        "chapter 4 at home.the", "4111 1111 1111 1112 and １", "ten to one at dot", "oh one",
    ],
)
def test_other_texts_are_left_alone(text):
    assert added(text) == []


def test_no_disguise_escapes_the_trigger():
    draw = random.Random(3)
    parts = ["at", "dot", "(at)", "[dot]", "one", "two", "1", "4", ".", "@", "a", "com", "plus", "+", "О", "l", "O", " ", " ", "-", "double", "&#46;", "​", "é"]
    for _ in range(20000):
        text = "".join(draw.choices(parts, k=draw.randrange(14)))
        plain = pii.plain_spans(text)
        assert next(pii.scan(pa.array([text]))) == (plain, sorted(plain + pii.disguised_spans(text, plain), key=lambda s: (pii.KINDS.index(s[0]), *s[1:]))), text


def test_rewritten_characters_map_back():
    tape = pii.rewrite("ab(at)c ​d", re.compile(r"\(at\)|​"), lambda m: "@" if m[0] == "(at)" else "")
    assert tape.text == "ab@c d"
    assert [tape.back(k, k + 1) for k in range(6)] == [(0, 1), (1, 2), (2, 6), (6, 7), (7, 8), (9, 10)]
    assert tape.back(1, 4) == (1, 7)


def test_edge_cases_as_rows(spark):
    long = "word " * 200_000 + "a@b.com " + "7" * 100_000 + "a" * 100_000 + "@" + "." * 100_000 + "+1" + " " * 100_000
    rows = [(1, None, "x"), (2, "", "x"), (3, "a@b.c 1.2.3.4", "x"), (3, "a@b.c 1.2.3.4", "x"), (None, "+12345678", "x"), (4, long, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string").withColumn("plain", F.lit(1))
    found = {(r["doc_id"], r["joined"]) for r in pii.find(docs).select("doc_id", pii.joined(F.col("spans")).alias("joined")).collect()}
    assert found == {(1, ""), (2, ""), (3, "email:0:5,ip:6:13"), (None, "phone:0:9"), (4, "email:1000000:1000007")}
    assert pii.find(docs).count() == 6
    assert pii.find(docs.limit(0)).count() == 0
    masked = {(r["doc_id"], r["text"]) for r in pii.redact(docs.filter("doc_id < 4")).collect()}
    assert masked == {(1, None), (2, ""), (3, "[email] [ip]")}


def test_query_equals_the_patterns(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op11_pii"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for doc_id, text in docs:
        spans = brute(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert [rows[doc_id][f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in spans) for k in PLAIN]
        assert rows[doc_id]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        # The sample tables hold no disguises.
        assert rows[doc_id]["spans"] == joined
