"""Conversation repair, language identification and fill-in-middle against plain versions."""

import binascii
import hashlib
import math
import random
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from talkmill.llm import conversation_repair, fill_middle, language_id, queries
from talkmill.llm.oracles import ORACLES
from tests.conftest import DATA
from tests.llm.fixtures import documents, empty

# Conversation repair

TURNS = "conv_id long, turn long, role string, text string"
BLANK = r"[^\x20\x09-\x0D]"
NEXT = {"": ("u", "user"), "s": ("u", "user"), "u": ("a", "assistant"), "a": ("u", "user")}


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))


def plain_repair(rows):
    """Summary of one conversation's rows (turn, role, text) by a DP row by row over whole audits."""
    seen, faults = set(), []
    for _, role, text in rows:
        last = re.findall(BLANK, text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))
    best = {"": (0, "", []), "a": (0, "", []), "u": (5, "I", ["assistant:"]), "s": (10, "II", ["user:", "assistant:"])}
    for (_, role, text), fault in zip(reversed(rows), reversed(faults)):

        def ways(state, ahead=best, role=role, text=text, fault=fault):
            cost, audit, lines = ahead[state]
            yield cost + 2, "D" + audit, lines
            if fault in ("", "truncated"):
                more, initial, (to, name) = 5 * (fault != ""), role[:1], NEXT[state]
                if initial and (initial == to or (initial == "s" and state == "")):
                    cost, audit, lines = ahead[initial]
                    yield cost + more, "K" + audit, [f"{role}:{text}", *lines]
                cost, audit, lines = ahead[to]
                yield cost + 1 + more, "R" + audit, [f"{name}:{text}", *lines]

        new = {}
        for state in best:
            found, at, inserted = [], state, []
            for k in range(4):
                found += [(5 * k + c, "I" * k + a, inserted + x) for c, a, x in ways(at)]
                inserted, at = [*inserted, NEXT[at][1] + ":"], NEXT[at][0]
            new[state] = min(found, key=lambda x: x[:2])
        best = new
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = best[""]
    return {"gaps": gaps, **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")}, "illegal": illegal, "cost": cost, "audit": audit, "sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def repaired_like_plain(conversations):
    summary, rows = conversation_repair.repair(conversations)
    hashes = {r.conv_id: r.sha256 for r in conversation_repair.digests(rows).collect()}
    found = {r.conv_id: r.asDict() | {"sha256": hashes.get(r.conv_id, hashlib.sha256(b"").hexdigest())} for r in summary.collect()}
    by_conv = defaultdict(list)
    for r in conversations.collect():
        by_conv[r.conv_id].append((r.turn, " " if r.role is None else r.role, " " if r.text is None else r.text))
    assert set(found) == set(by_conv)
    for conv, own in by_conv.items():
        assert found[conv] == {"conv_id": conv} | plain_repair(in_order(own)), conv


def odd_turns(n, seed=3):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for t in range(rng.choice([1, 2, 3, 5, 9, 14])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Hi.", "ok", "Well!", " ", None, "", f"a {t}.", f"b {t}?", f"c{t}", "c. \n", "é!"])
            rows.append((conv or None, rng.choice([t, t, t, t + 3, None, rng.randrange(4)]), role, text))
    return rows


def test_repair_of_odd_rows(spark):
    repaired_like_plain(spark.createDataFrame(odd_turns(150), TURNS).repartition(3))


def test_repair_of_conversations_over_several_parts(spark):
    """Two conversations hold nearly all rows, so boundaries of parts cut them; a third is one row many times."""
    rng, rows = random.Random(5), odd_turns(10)
    rows += [(7777, t // 2, rng.choice(["user", "assistant", "user", "assistant", "system"]), rng.choice(["Hi.", f"ok {t}", f"t {t}.", f"t {t}!"])) for t in range(900)]
    rows += [(8888, t, ("user", "assistant")[t % 2], f"t {t}.") for t in range(600)] + [(9999, None, "user", "same.")] * 300
    conversations = spark.createDataFrame(rows, TURNS)
    parts = conversation_repair.solved(conversation_repair.cleaned(conversations))
    assert {r.conv_id for r in parts.groupBy("conv_id").count().where("count > 1").collect()} >= {7777, 8888}
    repaired_like_plain(conversations)


def test_repair_of_nothing(spark):
    summary, rows = conversation_repair.repair(spark.createDataFrame([], TURNS))
    assert summary.count() == rows.count() == 0


def test_powers_equal_steps():
    for symbol in "suaoSUAOX":
        ahead = conversation_repair.END
        for n in range(1, 40):
            ahead = conversation_repair.before(conversation_repair.power(symbol, 0), ahead)
            far = conversation_repair.END
            for matrix in conversation_repair.powers(symbol, n):
                far = conversation_repair.before(matrix, far)
            assert far == ahead
            whole = conversation_repair.transition([(symbol, n)])
            assert conversation_repair.before(whole, conversation_repair.END) == ahead


def test_damage(spark):
    table = [(c, t, r, x) for c in (1, 2, None) for t in (*range(40), None) for r, x in (("user", "A. b!"), (None, None))]
    want = []
    for conv, turn, role, text in table:
        k = binascii.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text or " ")}.get(k, " " if text is None else text)
        want += [(conv, turn, "user" if k == 4 else role or " ", text)] * {0: 0, 3: 2}.get(k, 1)
    got = [tuple(r) for r in conversation_repair.damage(spark.createDataFrame(table, TURNS).withColumn("h", F.lit(1))).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_query_on_odd_conversations(spark, tmp_path):
    """The query's SQL holds for nulls, repeats and empty tables too."""
    import duckdb

    from tests.conftest import rows_of

    for i, rows in enumerate((odd_turns(60, 8), [])):
        folder = f"{tmp_path}/{i}"
        spark.createDataFrame(rows, TURNS).coalesce(1).write.parquet(f"{folder}/conversations.parquet")
        con = duckdb.connect()
        con.sql(f"create view conversations as select * from '{folder}/conversations.parquet/*.parquet'")
        assert rows_of(queries.op11_conversation_repair(spark, folder).toPandas()) == rows_of(con.sql(ORACLES["op11_conversation_repair"]).df())


# Language identification


class PlainModel:
    """Interpolated Kneser-Ney over strings."""

    def __init__(self, texts):
        counts = Counter(g for t in texts for g in self.grams(t))
        self.tables = {4: counts}
        for k in (3, 2, 1):
            self.tables[k] = Counter(g[1:] for g in self.tables[k + 1])
        self.discount = {}
        for k, table in self.tables.items():
            ones, twos = (sum(v == i for v in table.values()) for i in (1, 2))
            self.discount[k] = min(0.95, max(0.1, ones / (ones + 2 * twos) if ones + twos else 0.5))

    @staticmethod
    def line(text):
        kinds = [unicodedata.category(c)[0] for c in text.lower()]
        return "\x01" * 3 + re.sub(" +", " ", "".join(c if k in "LM" else " " for c, k in zip(text.lower(), kinds)))

    @classmethod
    def grams(cls, text):
        line = cls.line(text)
        return [line[i : i + 4] for i in range(len(line) - 3)]

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / (len(self.tables[1]) + 1)
        own = {g: n for g, n in self.tables[k].items() if g[:-1] == gram[:-1]}
        if not own:
            return self.p(gram[1:])
        d, total = self.discount[k], sum(own.values())
        return max(own.get(gram, 0) - d, 0) / total + d * len(own) / total * self.p(gram[1:])


SAMPLES = {"en": ["The cat sat on the mat.", "A dog, and 2 cats!", "the the the"], "de": ["Der Hund läuft über die Straße", "die Katze"], "xx": ["נָא a", "𝒜𝒷 c"]}


def test_probabilities_equal_a_plain_model(spark):
    rows = [(lang, t) for lang, texts in SAMPLES.items() for t in texts] + [(None, "unknown"), ("en", None), ("en", "")]
    model = language_id.fit(spark.createDataFrame(rows, "lang string, text string").repartition(3))
    assert model.langs == sorted(SAMPLES)
    plain = {lang: PlainModel(texts) for lang, texts in SAMPLES.items()}
    texts = ["the cat", "Straße zzz, the", "q", "נָ", "", "12", "a" * 50]
    entropies, letters = model.entropies(pa.array([t.lower() for t in texts]))
    for i, t in enumerate(texts):
        grams = PlainModel.grams(t)
        for j, lang in enumerate(model.langs):
            want = -sum(math.log2(plain[lang].p(g)) for g in grams) / max(1, len(grams))
            assert entropies[i, j] == pytest.approx(want, abs=1e-4), (t, lang)
        assert letters[i] == sum(unicodedata.category(c)[0] == "L" for c in t)


def test_stretches_do_not_change_entropies(spark, monkeypatch):
    model = language_id.fit(spark.createDataFrame([(lang, t) for lang, texts in SAMPLES.items() for t in texts], "lang string, text string"))
    texts = pa.array(["the cat sat", "", None, "x", "läuft " * 3000, "1 2 3", "the end"])
    whole = model.entropies(texts)[0]
    monkeypatch.setattr(language_id, "STRETCH", 3 << 12)
    assert np.allclose(model.entropies(texts)[0], whole) and len(list(language_id.lined_up(texts).stretches(1 << 12))) > 3


def test_tables_are_bounded(spark):
    rows = spark.range(3000).select(F.concat(F.lit("l"), (F.col("id") % 5).cast("string")).alias("lang"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("text"))
    model = language_id.fit(rows.withColumn("text", F.translate("text", "0123456789", "ghijklmnop")), slots=9)
    assert all(values.size <= 1 << 9 for tables in (model.grams, model.contexts) for _, values in tables.values())


def test_bounded_tables_change_no_result(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").limit(80).unionByName(spark.createDataFrame([(-1, None, None), (-2, "", "en"), (-3, "qéz 中文", None)], "doc_id long, text string, lang string"))
    got = []
    for slots in (21, 12, 2):
        model = language_id.fit(docs.where("doc_id % 2 = 0"), slots=slots)
        assert bool(model.partial) == (slots < 21)
        calibration = language_id.calibrate(model, docs.where("doc_id % 2 <> 0"))
        got.append({r.doc_id: r for r in language_id.predict(docs, model, calibration).collect()})
    for other in got[1:]:
        assert other.keys() == got[0].keys()
        for i, r in got[0].items():
            assert (r.text, r.lang, r.lang_pred, r.accepted) == (other[i].text, other[i].lang, other[i].lang_pred, other[i].accepted)
            assert r.entropy == pytest.approx(other[i].entropy, abs=1e-5) and r.score == pytest.approx(other[i].score, abs=1e-4)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas().set_index("doc_id")["lang"]
    found = queries.op12_language_id(spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    right = found["lang_pred"] == docs
    held = found["held_out"]
    assert held.sum() > 200 and right[held].mean() > 0.98 and found["accepted"][held].mean() > 0.95
    assert found["score"].between(0, 1).all() and found["score"][held & right].mean() > found["score"][~right].mean() if (~right).any() else True


def test_predictions_of_odd_rows(spark):
    known = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, texts in SAMPLES.items() for t in texts * 5)], "doc_id long, text string, lang string")
    docs = documents(spark)
    found = language_id.identify(docs, known)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "word", "n_words", "spans", "rule", "lang_pred", "score", "entropy", "accepted"]
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        letter = any(unicodedata.category(c)[0] == "L" for c in r.text or "")
        assert (r.lang_pred in SAMPLES) == letter and (r.entropy is None) == (not letter) and 0 <= r.score <= 1
        assert letter or (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
    assert language_id.identify(empty(spark), known).count() == 0
    nothing = language_id.identify(docs, known.where("lang is null"))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}
    one = language_id.identify(docs, known.where("lang = 'en'"))
    assert {r.lang_pred for r in one.collect()} == {"en", "und"}


def test_strange_text_is_not_accepted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where("doc_id % 2 = 0"))
    calibration = language_id.calibrate(model, docs.where("doc_id % 2 = 1"))
    odd = spark.createDataFrame([(1, "xqzjkv wqxzj kqvxz jjqkx zzxqv " * 20)], "doc_id long, text string")
    row = language_id.predict(odd, model, calibration).first()
    assert row.lang_pred in model.langs and not row.accepted


# Fill in the middle

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_middle(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", text, None, None
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return len(units), form, out, len(prefix), len(middle)


def test_middles(spark):
    texts = [None, "", "  ", "a", "a b ", "x<P>y", "<", "a <S", "<<P <S < M>", "\U0001f600 b\x0b c \n", " ä ö\nü ", "$1 \\1 $$ {2}", "w " * 40_000, "z" * 500_000, " " * 300_000 + "x", "x\x00y z\x85"]
    rows = [(20 * i + k, t, 5, "f") for i, t in enumerate(texts) for k in range(20)] + [(None, "no id here", 5, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long, form string").repartition(4)
    found = fill_middle.transform(docs)
    assert found.columns == ["doc_id", "text", "n", "form", "output", "prefix_chars", "middle_chars"]
    forms = Counter()
    for r in found.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect():
        assert (r.n, r.form, r.output, r.prefix_chars, r.middle_chars) == plain_middle(r.doc_id, r.text) and r.back == (r.text or "")
        forms[r.form] += 1
    assert len(forms) == 3
    assert fill_middle.transform(documents(spark)).count() == documents(spark).count() and fill_middle.transform(empty(spark)).count() == 0


def test_middles_take_one_match_and_no_shuffle(spark):
    found = fill_middle.transform(spark.read.parquet(f"{DATA}/documents.parquet"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") == 1 and "Exchange" not in plan and "Python" not in plan
