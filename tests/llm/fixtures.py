"""Small documents with every odd case: nulls, empty and long texts, copies, near copies, ties, repeated rows."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, word string, n_words long, score double, spans string, rule string"


def words(rng, n):
    return [rng.choice("alpha beta gamma delta öffnen straße niño the of and run walk house tree river stone cloud".split()) + str(rng.randrange(40)) for _ in range(n)]


def texts():
    rng = random.Random(5)
    base = words(rng, 120)
    out = [None, "", " ", "\n", "one", "two words here", "A-b C.d", "x\n\nx\n x \nX", " ".join(base), " ".join(base), " ".join(base).upper()]
    for k in (3, 60, 100):  # near copies, one word changed
        near = list(base)
        near[k] = "changed"
        out.append(" ".join(near))
    out.append("\n".join(" ".join(words(rng, 9)) for _ in range(400)))  # long
    shared = " ".join(words(rng, 12))
    out += [f"{' '.join(words(rng, 20))}\n{shared}\n{' '.join(words(rng, 30))}" for _ in range(6)]
    out += [f"  {shared.upper()} \nshort\nshort", "Ärger\nÄRGER\närger vor dem haus", "same same same same same same"]
    return out


def documents(spark):
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}", None if t is None else len(t), "w", 7, 0.5, "s", "r") for i, t in enumerate(texts())]
    rows += [rows[8], (None, "a row without an id that is long enough", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


BLANKS = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
