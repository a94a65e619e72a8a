"""Windows of licence notices against a plain version, and long texts."""

import random
import re
import textwrap
import time

from talkmill.llm import license_scan
from tests.llm.fixtures import LOWER

SMALL = [("A", "one two three four five six"), ("A", "one two three four"), ("B", "two three four five seven eight nine"), ("C", "red red blue red blue green red blue"), ("D", "solo")]


def cut(text):
    """Words with the numbers of their lines."""
    return [(i, w) for i, line in enumerate(text.translate(LOWER).split("\n"), 1) for w in re.findall(license_scan.WORD, line)]


def grams(words):
    return set(zip(words, words[1:], strict=False))


def plain_matches(text, templates, percent):
    """{(unit, licence, dice)} as matches() has them."""
    kinds = []
    for name, t in templates:
        w = [x for _, x in cut(t)]
        kinds.append((name, grams(w), max(0, len(w) - 1)))
    lines, own = text.split("\n"), {}
    for unit, part in [(0, text), *(enumerate(lines, 1) if len(lines) > 1 else [])]:
        g = grams([x for _, x in cut(part)])
        found = [(-2 * len(g & t) / (len(g) + len(t)), name) for name, t, _ in kinds if g and 200 * len(g & t) >= percent * (len(g) + len(t)) and t]
        if found:
            own[unit] = min(found)
    out = {(unit, name, -minus) for unit, (minus, name) in own.items()}
    words = cut(text)
    pairs = [(a[0], b[0], (a[1], b[1])) for a, b in zip(words, words[1:])]
    windows = {}
    for name, t, size in kinds:
        hits = [p for p in pairs if p[2] in t]
        for start in {f for f, _, _ in hits}:
            met, ends = set(), set()
            for f, e, g in hits:
                if f >= start and g not in met:
                    met.add(g)
                    ends.add(e)
            for end in ends:
                inside = [g for f, e, g in pairs if f >= start and e <= end]
                common, n = len(set(inside) & t), len(set(inside))
                if end > start and 200 * common >= percent * (n + len(t)) and percent * len(inside) <= (200 - percent) * size and common * (200 - percent) >= percent * len(t):
                    windows.setdefault((name, start), []).append((-2 * common / (n + len(t)), end))
    by_end = {}
    for (name, start), found in windows.items():
        minus, end = min(found)
        by_end.setdefault((name, end), []).append((minus, -start))
    ranked = []
    for (name, end), found in by_end.items():
        minus, back = min(found)
        told = any(m <= minus and (unit == 0 or -back <= unit <= end) for unit, (m, _) in own.items())
        ranked.append((minus, name, -back, end, told))
    kept = []
    for w in sorted(ranked):
        if not any(k[2] <= w[3] and k[3] >= w[2] and (not k[4] or k[1] == w[1]) for k in kept):
            kept.append(w)
    return out | {(start, name, -minus) for minus, name, start, _, told in kept if not told}


def random_text(rng):
    vocabulary = "one two three four five six seven eight nine red blue green other word".split()
    lines = []
    for _ in range(rng.choice([1, 3, 8, 25])):
        lines.append(" ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 5]))))
        if rng.random() < 0.3:  # a wrapped notice, sometimes with a word changed
            words = rng.choice(SMALL)[1].split()
            if rng.random() < 0.3:
                words[rng.randrange(len(words))] = "other"
            lines += textwrap.wrap(" ".join(words), rng.choice([4, 9, 14, 40]))
    return "\n".join(lines)


def test_windows_equal_a_plain_version(spark):
    rng = random.Random(11)
    texts = [random_text(rng) for _ in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(3, texts[3])], "doc_id long, text string").repartition(3)
    for percent in (80, 60):
        found = {}
        for r in license_scan.matches(docs, SMALL, percent).collect():
            found.setdefault(r.doc, set()).add((r.unit, r.license, round(r.dice, 9)))
        n = 0
        for i, t in enumerate(texts):
            want = {(u, name, round(d, 9)) for u, name, d in plain_matches(t, SMALL, percent)}
            n += len(want)
            assert found.get(i, set()) == want, t
        assert n > 300


def test_long_texts_of_notices(spark):
    """Time goes with the length of a text of wrapped notices; each notice is found."""
    mit = next(t for n, t in license_scan.TEMPLATES if n == "MIT" and len(t) > 500)
    notice = "\n".join(textwrap.wrap(mit, 70))

    def seconds(copies):
        text = "\n".join(f"Copyright {i} holder number {i}\n{notice}\n" for i in range(copies))
        began = time.monotonic()
        row = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
        assert row["n_matches"] == copies and row["licenses"] == ["MIT"]
        return time.monotonic() - began

    seconds(50)
    small, large = seconds(100), seconds(400)
    assert large < 60 and large < 6 * max(small, 3)
