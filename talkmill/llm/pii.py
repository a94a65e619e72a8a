"""Find personal data: fixed rules, and boosted trees over further candidate spans.

Fixed rules find addresses, IPs, cards and phones. Generators of high recall propose mailboxes, numbers and secrets
that may overlap them and each other. Format and context of each candidate become a few small numbers; how often each
combination occurs, and with what weak label, is counted over all documents. Boosted trees are fitted to these counts
(at most as many rows as there are combinations), thresholds are calibrated on a fold left out, and the trees become
nested CASE expressions. Of chosen spans that overlap, the one with the highest score stays, then the first, then the
shortest; what a fixed rule's span covers adds nothing. Texts are read once and not shuffled. DataFrame functions only.

Weak labels are apart from the fixed rules: a mailbox has one of some common endings; a number has a plus sign, a
valid check digit at the length of a card, or four parts up to 255; a secret is assigned to a name such as token or
password. What a label is made of is no feature.

Defined results: a null text is empty; it has no spans. Positions are in code points, ends exclusive. Repeated rows are
searched one by one. A kind whose candidates reach the wanted precision at no threshold adds nothing. An empty table
gives an empty result; input columns other than the id are not carried.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.llm.shared import computed_once, materialise, running

#: Patterns in Java's syntax. Possessive, and tried at the start of a run or behind the last match only: the same
#: matches as the plain patterns, in linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_NAME = r"[^\s@<>(),;:\"\[\]]"
#: Generators: mailboxes with any characters and with a written "at"; runs of digits, solid numbers, numbers in groups of
#: four, numbers grouped like phones, and four parts.
MAILBOXES = [
    rf"(?:\G|(?<!{_NAME})){_NAME}++@{_NAME}*+",
    r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]++\x20?[\[(]at[\])]\x20?[\p{L}0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[\p{L}0-9-]++)*+",
]
#: Marks that end a sentence or decorate a word; the first generator's matches don't end with them.
FINAL = ".!?*#%&$|"
NUMBERS = [
    r"(?<![0-9])\+?[0-9](?:[\x20().-]{0,2}+[0-9])++",
    r"(?<![0-9])[0-9]{7,19}+(?![0-9])",
    r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])",
    r"(?<![0-9])(?:\+?[0-9]{1,3}[\x20.-]?)?+\(?[0-9]{2,4}\)?[\x20.-]{0,2}[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])",
    r"(?<![0-9])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?![0-9])",
]
SECRET = r"(?:\G|(?<![A-Za-z0-9_+/=-]))[A-Za-z0-9_+/=-]{20,}+"

VALID_IP = r"^(?:0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"
BASE, ADDED = ("email", "ip", "card", "phone"), ("mailbox", "number", "secret")
KEYWORDS = r"(?i)phone|tel|call|fax|mobil|mail|contact|card|visa|iban|account|konto|cuenta|compte|ssn|address"
ASSIGNED = r"(?i)(?:token|secret|key|passw(?:or)?d|pwd)\W{0,3}[=:]\W{0,3}$"
#: Common endings of mailboxes' domains.
ENDINGS = r"(?i)(?:\.|dot[\])]\x20?)(?:com|org|net|edu|gov|info|io|eu|de|fr|es|uk)$"
CONTEXT = 24
N_FEATURES = 10

#: Boosting: trees, their depth, step, penalty of leaves; the precision that a threshold must reach on the left-out fold (1 of FOLDS).
TREES, DEPTH, RATE, PENALTY, PRECISION, FOLDS = 40, 3, 0.3, 1.0, 0.9, 5

_SPAN = "array<struct<s:int,e:int,m:string,c:string,a:string>>"


def matches(text: Column, pattern: str, final: str = "") -> Column:
    """All matches of a text: start, end, the match, up to CONTEXT characters before it (behind the last match), and the one after it.

    final: characters that a match doesn't end with; they are cut off.
    """
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    n = F.size(found)
    after = F.zip_with(found, F.slice(between, 2, n), lambda m, a: F.struct(m.alias("m"), F.substring(a, 1, 1).alias("a")))
    pairs = F.zip_with(F.slice(between, 1, n), after, lambda p, x: F.struct(F.length(p).alias("before"), F.substring(p, -CONTEXT, CONTEXT).alias("c"), F.length(x["m"]).alias("n"), (F.rtrim(x["m"], F.lit(final)) if final else x["m"]).alias("m"), x["a"].alias("a"), (F.substring(x["m"], F.length(F.rtrim(x["m"], F.lit(final))) + 1, F.lit(1)) if final else F.lit("")).alias("cut")))

    def placed(x: Column, end: Column) -> Column:
        start = end - x["n"]
        return F.struct(start.alias("s"), (start + F.length(x["m"])).alias("e"), x["m"].alias("m"), x["c"].alias("c"), F.when(x["cut"] != "", x["cut"]).otherwise(x["a"]).alias("a"))

    return computed_once(pairs, lambda ps: F.zip_with(ps, running(F.transform(ps, lambda x: x["before"] + x["n"]), lambda a, b: a + b), placed))


def distinct_sorted(spans: Column) -> Column:
    """Different elements in order, by sorting."""
    return computed_once(F.array_sort(spans), lambda xs: F.filter(xs, lambda x, i: (i == 0) | (x != xs[F.greatest(i - 1, F.lit(0))])))


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check sum holds: every second digit from the right counts twice, as the sum of its digits."""
    n = F.length(digits)

    def worth(i):
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int") * (F.lit(1) + (i + 1) % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), worth), F.lit(0), lambda a, d: a + d) % 10 == 0


def between(n: Column, lo: int, hi: int) -> Column:
    return (n >= lo) & (n <= hi)


def base_spans(text: Column) -> dict[str, Column]:
    """The fixed rules' spans by kind; searched only in texts with an @ or a digit."""
    none = F.array().cast(_SPAN)
    with_digit, with_at = text.rlike("[0-9]"), F.instr(text, "@") > 0
    return {
        "email": F.when(with_at, matches(text, EMAIL)).otherwise(none),
        "ip": F.when(with_digit, F.filter(matches(text, IP), lambda x: x["m"].rlike(VALID_IP))).otherwise(none),
        "card": F.when(with_digit, F.filter(F.filter(matches(text, CARD), lambda x: between(F.length(digits_of(x["m"])), 14, 19)), lambda x: luhn(digits_of(x["m"])))).otherwise(none),
        "phone": F.when(F.instr(text, "+") > 0, F.filter(matches(text, PHONE), lambda x: between(F.length(digits_of(x["m"])), 10, 15))).otherwise(none),
    }


def added_candidates(text: Column) -> dict[str, Column]:
    none = F.array().cast(_SPAN)
    at = (F.instr(text, "@") > 0) | text.rlike(r"[\[(]at[\])]")
    return {
        "mailbox": F.when(at, F.concat(matches(text, MAILBOXES[0], FINAL), matches(text, MAILBOXES[1]))).otherwise(none),
        "number": F.when(text.rlike("[0-9].*[0-9]"), distinct_sorted(F.filter(F.concat(*(matches(text, p) for p in NUMBERS)), lambda x: F.length(digits_of(x["m"])) >= 7))).otherwise(none),
        "secret": F.when(text.rlike(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20}"), F.filter(matches(text, SECRET), lambda x: F.length(x["m"]) >= 20)).otherwise(none),
    }


def _binned(n: Column, edges: list[int]) -> Column:
    """How many of the ascending edges n reaches."""
    out = F.lit(0)
    for e in edges:
        out = out + (n >= e).cast("int")
    return out


def _count(m: Column, others: str) -> Column:
    """Characters of m outside the class others."""
    return F.length(F.regexp_replace(m, f"[{others}]", ""))


def _neighbour(char: Column) -> Column:
    """0: none, white space or a quote, 1: a letter or digit, 2: another."""
    return F.when((char == "") | char.rlike(r"""^[\s"'`]"""), 0).when(char.rlike(r"^[\p{L}0-9]"), 1).otherwise(2)


def _longest(m: Column) -> Column:
    """Digits of the longest group."""
    return F.array_max(F.transform(F.split(m, "[^0-9]+"), F.length))


def described(kind: str, spans: Column) -> Column:
    """Candidates with their kind's number, f (N_FEATURES small numbers) and weak label."""

    def describe(x):
        m, digits = x["m"], F.length(digits_of(x["m"]))
        before, after, told = _neighbour(F.substring(x["c"], -1, 1)), _neighbour(x["a"]), x["c"].rlike(KEYWORDS).cast("int")
        if kind == "mailbox":
            name, domain = F.regexp_replace(m, r"\x20?(?:@|[\[(]at).*$", ""), F.regexp_replace(m, r"^.*?(?:@|at[\])]\x20?)", "")
            f = [_binned(F.length(name), [2, 8, 20]), _binned(F.length(domain), [4, 8, 16, 30]), _binned(_count(domain, "^."), [1, 2, 3]), _binned(digits, [1, 3]), m.rlike(r"[^\x00-\x7F]").cast("int"), (F.instr(m, "@") == 0).cast("int"), F.instr(domain, "@").cast("boolean").cast("int"), before, after, told]
            label = m.rlike(ENDINGS)
        elif kind == "number":
            own = F.regexp_replace(m, r"^\+[0-9]{1,3}[\x20.-]", "")  # without the prefix of a country
            f = [_binned(F.length(digits_of(own)), [9, 10, 12, 13, 16, 17, 20]), _binned(F.size(F.regexp_extract_all(own, F.lit("[0-9]+"), F.lit(0))), [2, 3, 4, 5]), _binned(_longest(own), [4, 5, 9, 13, 17]), _binned(_count(own, "^."), [1, 3, 4]), F.contains(own, F.lit(")")).cast("int"), _binned(_count(own, r"^\x20"), [1, 3]), _binned(_count(own, "^-"), [1]), before, after, told]
            label = m.startswith("+") & between(digits, 10, 15) | between(digits, 13, 19) & ~m.rlike("[.()]") & luhn(digits_of(m)) | m.rlike(VALID_IP)
        else:
            f = [_binned(F.length(m), [24, 32, 40, 41, 64]), F.floor(8 * digits / F.length(m)).cast("int"), _binned(_count(m, "^A-Z"), [1, 4]), _binned(_count(m, "^a-z"), [1, 4]), m.rlike("^[0-9a-fA-F]+$").cast("int"), _binned(_count(m, "A-Za-z0-9"), [1, 2]), _binned(F.size(F.array_distinct(F.split(m, ""))), [8, 12, 16, 24]), after, told, F.lit(0)]
            label = x["c"].rlike(ASSIGNED)
        return F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(ADDED.index(kind)).alias("kind"), F.array(*f).alias("f"), label.cast("int").alias("label"))

    return F.transform(spans, describe)


@dataclass
class Trees:
    """Boosted trees over small whole numbers, fitted to counted combinations: points (a row of features each), rows and positive rows of each."""

    bias: float = 0.0
    trees: list = field(default_factory=list)

    def fit(self, points: np.ndarray, n: np.ndarray, p: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> "Trees":
        self.bias = math.log((p.sum() + 0.5) / (n.sum() - p.sum() + 0.5))
        scores = np.full(len(points), self.bias)
        for _ in range(trees if len(points) else 0):
            q = 1 / (1 + np.exp(-scores))
            values = np.zeros(len(points))
            self.trees.append(self.grow(np.arange(len(points)), points, p - n * q, n * q * (1 - q), depth, values))
            scores += values
        return self

    def grow(self, rows: np.ndarray, points: np.ndarray, slope: np.ndarray, bend: np.ndarray, depth: int, values: np.ndarray):
        """A leaf's value, or (feature, edge, below, from the edge on), by the gain in the second-order loss; values: of each point."""
        g, h = float(slope[rows].sum()), float(bend[rows].sum())
        best = (1e-6, None, None)
        for f in range(points.shape[1]) if depth and len(rows) > 1 else ():
            x = points[rows, f]
            gl, hl = (np.cumsum(np.bincount(x, weights=w[rows])) for w in (slope, bend))
            gain = gl * gl / (hl + PENALTY) + (g - gl) ** 2 / (h - hl + PENALTY) - g * g / (h + PENALTY)
            gain[-1] = 0.0
            if len(gain) and gain.max() > best[0]:
                best = (float(gain.max()), f, int(gain.argmax()) + 1)
        if best[1] is None:
            values[rows] = RATE * g / (h + PENALTY)
            return RATE * g / (h + PENALTY)
        _, f, edge = best
        low = points[rows, f] < edge
        return f, edge, *(self.grow(side, points, slope, bend, depth - 1, values) for side in (rows[low], rows[~low]))

    def score(self, x) -> float:
        out = self.bias
        for tree in self.trees:
            while isinstance(tree, tuple):
                tree = tree[3] if x[tree[0]] >= tree[1] else tree[2]
            out = out + tree
        return out

    def sql(self, f: str) -> str:
        """score() of an array, by its name in SQL, as nested CASE expressions."""

        def branch(tree) -> str:
            if not isinstance(tree, tuple):
                return f"{float(tree)!r}D"
            return f"CASE WHEN {f}[{tree[0]}] < {tree[1]} THEN {branch(tree[2])} ELSE {branch(tree[3])} END"

        return " + ".join([f"{float(self.bias)!r}D", *map(branch, self.trees)])


def fit(counts: list[tuple[int, int, tuple[int, ...], float, float]]) -> dict[int, tuple[Trees, float]]:
    """Trees and threshold of each kind that has one. counts: kind, fold (0 is left out), features, rows, positive ones."""
    out = {}
    for kind in sorted({c[0] for c in counts}):
        rows = [c for c in counts if c[0] == kind]
        learnt = [c for c in rows if c[1]]
        if not learnt:
            continue
        trees = Trees().fit(np.array([c[2] for c in learnt]), np.array([c[3] for c in learnt]), np.array([c[4] for c in learnt]))
        left_out = sorted(((trees.score(x), n, p) for _, fold, x, n, p in rows if not fold), reverse=True)
        n = p = 0.0
        for i, (s, more, right) in enumerate(left_out):
            n, p = n + more, p + right
            after = left_out[i + 1][0] if i + 1 < len(left_out) else s
            if p >= PRECISION * n and (after < s or i + 1 == len(left_out)):
                out[kind] = trees, (s + after) / 2  # halfway to the next score, as others than those left out lie between
    return out


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the four kinds of base spans, and added (described candidates): one row for each row of docs, without texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(F.col(id_col).alias("doc"), text.alias("text"))
    found = found.select("doc", *(c.alias(k) for k, c in base_spans(F.col("text")).items()), *(c.alias(k) for k, c in added_candidates(F.col("text")).items()))
    return found.select("doc", *(F.transform(k, lambda x: F.struct(x["s"], x["e"])).cast("array<struct<s:int,e:int>>").alias(k) for k in BASE), F.concat(*(described(k, F.col(k)) for k in ADDED)).alias("added"))


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, base and spans (all): arrays of (start, kind's number, end, kind), sorted."""
    seen = materialise(candidates(docs, id_col, text_col), "private")
    rows = seen.select(F.pmod(F.xxhash64("doc"), F.lit(FOLDS)).alias("fold"), F.explode("added").alias("x"))
    counted = rows.groupBy("x.kind", (F.col("fold") > 0).cast("int").alias("fold"), *(F.col("x.f")[i].alias(f"f{i}") for i in range(N_FEATURES))).agg(F.count("*").alias("n"), F.sum("x.label").alias("p"))
    # One row for each combination of features, of which the bins allow a fixed number.
    models = fit([(r["kind"], r["fold"], tuple(r[f"f{i}"] for i in range(N_FEATURES)), float(r["n"]), float(r["p"])) for r in counted.orderBy(*counted.columns).collect()])
    every = F.concat(*BASE)

    # What a candidate's score has above its kind's threshold; null for those of kinds without one.
    over = " ".join(f"WHEN {kind} THEN {trees.sql('x.f')} - {threshold!r}D" for kind, (trees, threshold) in models.items())
    under = f"-(CASE x.kind {over} END)" if over else "CAST(NULL AS DOUBLE)"
    chosen = F.filter(F.expr(f"transform(added, x -> named_struct('under', {under}, 's', x.s, 'e', x.e, 'kind', x.kind))"), lambda x: x["under"] <= 0)
    kept = without_overlaps(not_covered(chosen, every))

    def of_kind(spans: Column, kind: str) -> Column:
        return F.filter(spans, lambda x: x["kind"] == ADDED.index(kind))

    def named(spans: Column, kind: str) -> Column:
        k = (*BASE, *ADDED).index(kind)
        return F.transform(spans, lambda x: F.struct(x["s"].alias("start"), F.lit(k).alias("k"), x["e"].alias("end"), F.lit(kind).alias("kind")))

    base = F.concat(*(named(F.col(k), k) for k in BASE))
    both = seen.select("doc", *BASE, kept.alias("added"))
    more = [named(of_kind(F.col("added"), kind), kind) for kind in ADDED]
    return both.select(F.col("doc").alias(id_col), F.array_sort(base).alias("base"), F.array_sort(F.concat(base, *more)).alias("spans"))


_SCORED = "array<struct<under:double,s:int,e:int,kind:int>>"


def not_covered(chosen: Column, base: Column) -> Column:
    """Those of some scored spans that lie within none of the base spans: in order of starts, the farthest end of a base span so far tells."""
    of_base = F.transform(base, lambda b: F.struct(b["s"].alias("s"), F.lit(0).alias("added"), b["e"].alias("e"), F.lit(0.0).alias("under"), F.lit(0).alias("kind")))
    of_chosen = F.transform(chosen, lambda x: F.struct(x["s"].alias("s"), F.lit(1).alias("added"), x["e"].alias("e"), x["under"].alias("under"), x["kind"].alias("kind")))

    def open_ones(xs: Column) -> Column:
        far = running(F.transform(xs, lambda x: F.when(x["added"] == 0, x["e"]).otherwise(F.lit(-1))), F.greatest)
        both = F.zip_with(xs, far, lambda x, f: F.struct(x.alias("x"), f.alias("f")))
        return F.transform(F.filter(both, lambda y: (y["x"]["added"] == 1) & (y["f"] < y["x"]["e"])), lambda y: F.struct(y["x"]["under"].alias("under"), y["x"]["s"].alias("s"), y["x"]["e"].alias("e"), y["x"]["kind"].alias("kind")))

    return computed_once(F.array_sort(F.concat(of_base, of_chosen)), open_ones)


def without_overlaps(chosen: Column) -> Column:
    """Of spans that overlap the one with the highest score, then the first, then the shortest; each group of overlapping ones by itself."""

    def add(kept: Column, x: Column) -> Column:
        return F.when(F.exists(kept, lambda k: (k["s"] < x["e"]) & (k["e"] > x["s"])), kept).otherwise(F.concat(kept, F.array(x)))

    def best(group: Column) -> Column:
        return F.aggregate(F.array_sort(F.transform(group, lambda x: F.struct(x["under"].alias("under"), x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")))), F.array().cast(_SCORED), add)

    def groups(x: Column) -> Column:
        xs, far = x["xs"], x["far"]
        heads = F.filter(F.sequence(F.lit(1), F.size(xs)), lambda i: (i == 1) | (far[F.greatest(i - 2, F.lit(0))] <= xs[i - 1]["s"]))
        return computed_once(heads, lambda hs: F.flatten(F.transform(hs, lambda h, j: best(F.slice(xs, h, F.coalesce(F.get(hs, j + 1), F.size(xs) + 1) - h)))))

    def over(xs: Column) -> Column:
        far = running(F.transform(xs, lambda x: x["e"]), F.greatest)
        return F.when(F.size(xs) == 0, F.array().cast(_SCORED)).otherwise(computed_once(F.struct(xs.alias("xs"), far.alias("far")), groups))

    by_start = F.array_sort(F.transform(chosen, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["under"].alias("under"), x["kind"].alias("kind"))))
    return computed_once(by_start, over)


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    """How many of the spans are of a kind."""
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
