"""Candidates and the choice among added spans of personal data against plain versions, and long texts."""

import itertools
import random
import time

import pytest
import regex
from pyspark.sql import functions as F

from talkmill.llm import pii

HARD = [
    "write to josé@exämple.com.", "mail müller@beispiel.de!", "(a@b.c)?!", "x@y.z***", "@@ a@ b@.", "a@b.c@d.e...", "...@...", "a@b!c@d.",
    "ann (at) b.com ann [at] c [dot] org.", "call (212) 555-1234 or 212 555 1234.", "4111 1111 1111 1111 4111111111111111", "1.2.3.4 1.2.3.4.5.6.7.8",
    "+49 (0) 30 1234567", "1-2-3-4-5-6-7-8", "token=abcdefghij0123456789ABCDEF", "A" * 70, "", None, "ä" * 30 + "1234567890", "12 34\n56 78 9",
]


def spans_of(found):
    return {r.doc: [(x.s, x.e, x.m, x.a) for x in r.found] for r in found.collect()}


@pytest.mark.parametrize("pattern,final", [(pii.MAILBOXES[0], pii.FINAL), (pii.MAILBOXES[1], ""), *((p, "") for p in pii.NUMBERS), (pii.SECRET, ""), (pii.EMAIL, ""), (pii.CARD, "")])
def test_matches_equal_a_plain_search(spark, pattern, final):
    rng = random.Random(3)
    texts = HARD + ["".join(rng.choice("ab1@.+- ()é!\n2345") for _ in range(rng.choice([5, 40, 300]))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc long, text string").repartition(3)
    got = spans_of(docs.select("doc", pii.matches(F.coalesce("text", F.lit("")), pattern, final).alias("found")))
    for i, text in enumerate(texts):
        want, text = [], text or ""
        for m in regex.finditer(pattern, text):
            own = m.group().rstrip(final) if final else m.group()
            end = m.start() + len(own)
            want.append((m.start(), end, own, text[end : end + 1] if end < m.end() or end < len(text) else ""))
        ours = [(s, e, t) for s, e, t, _ in got[i]]
        assert ours == [(s, e, t) for s, e, t, _ in want], text
        for (_, e, _, a), (_, _, _, after) in zip(got[i], want):
            assert a == after or (a == "" and any(e == s for s, _, _ in ours)), text  # nothing lies between two matches


def test_mailboxes_before_final_marks(spark):
    texts = ["write to josé@exämple.com.", "mail müller@beispiel.de!", "is it a.b@c.de?", "plain josé@exämple.com here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc: {texts[r.doc][x.s : x.e] for x in r.added if x.kind == 0} for r in pii.candidates(docs).collect()}
    assert rows == {0: {"josé@exämple.com"}, 1: {"müller@beispiel.de"}, 2: {"a.b@c.de"}, 3: {"josé@exämple.com"}}


@pytest.mark.parametrize("join,plain", [(lambda a, b: a + b, lambda a, b: a + b), (F.greatest, max)])
def test_running_results(spark, join, plain):
    rng = random.Random(4)
    lists = [[rng.randrange(-5, 50) for _ in range(n)] for n in (0, 1, 2, 3, 4, 8, 9, 10, 99, 100, 101, 1000)]
    rows = spark.createDataFrame(list(enumerate(lists)), "i int, xs array<int>").select("i", pii.running(F.col("xs"), join).alias("r")).collect()
    for r in rows:
        assert r.r == list(itertools.accumulate(lists[r.i], plain))


def plain_choice(added, base):
    kept = []
    for x in sorted(added):
        if not any(s <= x[1] and e >= x[2] for s, e in base) and not any(k[1] < x[2] and k[2] > x[1] for k in kept):
            kept.append(x)
    return sorted(kept)


def test_choice_among_overlaps(spark):
    rng, rows = random.Random(5), []
    for i in range(300):
        reach = rng.choice([10, 60, 400])
        added = []
        for _ in range(rng.choice([0, 1, 5, 30])):
            s = rng.randrange(reach)
            added.append((rng.choice([-2.0, -1.0, -0.5]), s, s + rng.randrange(1, 9), rng.randrange(3)))
        base = [(s, s + rng.randrange(1, 12)) for s in (rng.randrange(reach) for _ in range(rng.choice([0, 2, 10])))]
        rows.append((i, added, base))
    frame = spark.createDataFrame(rows, "i int, added array<struct<under:double,s:int,e:int,kind:int>>, base array<struct<s:int,e:int>>")
    found = frame.select("i", pii.without_overlaps(pii.not_covered(F.col("added"), F.col("base"))).alias("kept"))
    for r in found.collect():
        assert sorted(map(tuple, r.kept)) == plain_choice(rows[r.i][1], rows[r.i][2])


def test_long_texts_take_time_in_proportion(spark):
    def seconds(size):
        text = " ".join("%04d-%05d-a%03d" % (i % 9999, i * 7 % 99999, i % 999) for i in range(size // 16))
        docs = spark.createDataFrame([(1, text), (2, text[: len(text) // 2] + " x@y.z. " * 2000)], "doc_id long, text string")
        began = time.monotonic()
        assert pii.find_private(docs).count() == 2
        return time.monotonic() - began

    seconds(1000)
    small, large = seconds(250_000), seconds(1_000_000)
    assert large < 60 and large < 8 * max(small, 4)
