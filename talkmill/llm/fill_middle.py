"""Fill-in-middle transformation: a text's prefix, middle and suffix change places, cut by a counted-quantifier regex.

regexp_count gives a text's units n (a word with the blanks before it, or blanks at the end); two hashes of the id choose
the cuts a and b, and the pattern of the row, with one possessive group of a units and one of b - a, takes prefix, middle
and suffix in a single match. Possessive repetition is a loop in the regex engine, so long texts need no deep stack, and
all is done by DataFrame functions: one pass, nothing is shuffled.

Defined results: a null text is an empty one, and a null id counts as no digits. Empty texts, and texts that hold a mark,
stay plain. Equal rows have equal results; an empty table gives an empty one. Columns n, form, output, prefix_chars and
middle_chars of the input are replaced, all others are kept. A long text is one string, as it is in its column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)"
SEED = 42
#: Of a hundred texts so many are transformed, and of a hundred of these so many have the suffix first.
RATE, SUFFIX_FIRST = 50, 80


def draws(id_col: str, seed: int = SEED) -> list[Column]:
    """Four numbers of 32 bits from the id's hash."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """docs with n, form (plain, psm or spm), output, and prefix_chars and middle_chars (null if plain)."""
    h1, h2, h3, h4 = draws(id_col, seed)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.drop("n", "form", "output", "prefix_chars", "middle_chars").withColumns({"__text": text, "n": F.regexp_count(text, F.lit(UNIT)).cast("long"), "__h1": h1, "__h2": h2})
    marked = F.contains("__text", F.lit(PREFIX)) | F.contains("__text", F.lit(SUFFIX)) | F.contains("__text", F.lit(MIDDLE))
    form = F.when((F.col("__text") == "") | marked | (h3 % 100 >= rate), F.lit("plain")).when(h4 % 100 < suffix_first, F.lit("spm")).otherwise(F.lit("psm"))
    a, b = F.col("__h1") % (F.col("n") + 1), F.col("__h2") % (F.col("n") + 1)
    rows = rows.withColumns({"form": form, "__a": F.least(a, b), "__b": F.greatest(a, b)})
    pattern = F.format_string(rf"(?s)\A({UNIT}{{%d}}+)({UNIT}{{%d}}+)(.*+)\z", F.col("__a"), F.col("__b") - F.col("__a"))
    order = F.when(F.col("form") == "spm", F.lit(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")).otherwise(F.lit(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2"))
    output = F.when(F.col("form") == "plain", F.col("__text")).otherwise(F.regexp_replace("__text", pattern, order))
    rows = rows.withColumn("output", output).drop("__text", "__h1", "__h2", "__a", "__b")
    prefix, middle, _ = parts(F.col("output"), F.col("form"))
    changed = F.col("form") != "plain"
    return rows.withColumns({"prefix_chars": F.when(changed, F.length(prefix).cast("long")), "middle_chars": F.when(changed, F.length(middle).cast("long"))})


def parts(output: Column, form: Column) -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix of an output that isn't plain. The marks are found by themselves: no transformed text holds one."""

    def between(left: str, right: str) -> Column:
        return F.substring_index(F.substring_index(output, left, -1), right, 1)

    spm = form == "spm"
    prefix = F.when(spm, between(PREFIX, MIDDLE)).otherwise(between(PREFIX, SUFFIX))
    suffix = F.when(spm, between(SUFFIX, PREFIX)).otherwise(between(SUFFIX, MIDDLE))
    return prefix, F.substring_index(output, MIDDLE, -1), suffix


def restored(output: Column, form: Column) -> Column:
    """The text as it was, from its output and form alone."""
    prefix, middle, suffix = parts(output, form)
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))
