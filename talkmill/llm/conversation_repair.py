"""Conversation structure repair: the cheapest edits after which a conversation's roles alternate, by run-length dynamic programming.

Rows are judged without their texts, by an MD5 of each: blank, duplicate, truncated. Equal rows are one row with a count.
They are dealt out by ranges of (conversation, turn, role, hash), so one conversation may spread over many parts; what a
part has of a conversation becomes a string of symbols of role and fault. Equal symbols in a row are one run, and a run of
n is passed by the binary powers, which are kept, of its min-plus transition between the states of the role grammar. Most
conversations lie in one part and are solved there. Each boundary of parts cuts one conversation at most; the cut ones'
parts are first reduced to a transition each, from which come the cost to the end behind every part and the state before
it. Then every part unrolls its own choices, and the edits meet the texts by a join.

Edits: K keep (0), R give the role user or assistant (1), D delete (2, required for blank and duplicate rows), I insert an
empty text of either role (5); a truncated row that isn't deleted adds 5. The roles' initials then read (s?(ua)+)?. Of the
cheapest audits the least in ASCII order is taken; it also settles all roles.

Defined results: null roles and texts are one blank. Rows go by turn, nulls first; rows of one turn by role and MD5. Equal
rows follow each other, and all but the first are duplicates (or blank). Roles with other initials than s, u and a, and
empty ones, can't be kept. A null conv_id is a conversation of its own. An empty table gives empty results; other columns
are not looked at. Long texts are hashed and joined, and never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.llm.shared import BLANKS, in_small_batches, materialise

KEEP_TRUNCATED, INSERT, DELETE, REROLE = 5, 5, 2, 1
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

#: States: nothing yet, after s, after u, after a. What may be inserted in each, and the cost of ending there.
NEXT = (("u", 2), ("u", 2), ("a", 3), ("u", 2))
STATES = range(4)
END = (0, 2 * INSERT, INSERT, 0)
_FAR = 1 << 60

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


# One symbol: X must be deleted; else the role's initial (o: another), as a capital if the row is truncated


@lru_cache(maxsize=None)
def edits(symbol: str, state: int) -> tuple[tuple[str, int, int], ...]:
    """What may be done to a row in a state, in ASCII order: the edit with its role, its cost, and the state after it."""
    out = [("D", DELETE, state)]
    if symbol != "X":
        role, more = symbol.lower(), KEEP_TRUNCATED if symbol.isupper() else 0
        if role == "s" and state == 0:
            out.append(("K", more, 1))
        elif role == NEXT[state][0]:
            out.append(("K", more, NEXT[state][1]))
        out.append((f"R{NEXT[state][0]}", REROLE + more, NEXT[state][1]))
    return tuple(out)


@lru_cache(maxsize=None)
def power(symbol: str, k: int) -> Matrix:
    """The least costs between states over 2^k rows of a symbol, inserts before each included."""
    if k:
        half = power(symbol, k - 1)
        return product(half, half)
    rows = []
    for state in STATES:
        costs, at, inserted = [_FAR] * 4, state, 0
        for _ in STATES:  # more inserts come back to a state that fewer reach
            for _, cost, after in edits(symbol, at):
                costs[after] = min(costs[after], inserted + cost)
            at, inserted = NEXT[at][1], inserted + INSERT
        rows.append(tuple(costs))
    return tuple(rows)


def product(a: Matrix, b: Matrix) -> Matrix:
    """a, then b, in the min-plus sense."""
    return tuple(tuple(min(_FAR, *(a[i][k] + b[k][j] for k in STATES)) for j in STATES) for i in STATES)


def before(matrix: Matrix, ahead: Vector) -> Vector:
    """Costs to the end before rows, from those after them."""
    return tuple(min(row[j] + ahead[j] for j in STATES) for row in matrix)


def powers(symbol: str, n: int) -> Iterator[Matrix]:
    return (power(symbol, k) for k in range(n.bit_length()) if n >> k & 1)


def transition(runs: list[tuple[str, int]]) -> Matrix:
    """The least costs between states over all runs."""
    out: Matrix = tuple(tuple(0 if i == j else _FAR for j in STATES) for i in STATES)
    for symbol, n in runs:
        for matrix in powers(symbol, n):
            out = product(out, matrix)
    return out


def plain(ahead: Vector) -> Vector:
    """Costs above the least, which alone decide. There are few such vectors."""
    least = min(ahead)
    return tuple(x - least for x in ahead)


@lru_cache(maxsize=100_000)
def step(symbol: str, ahead: Vector) -> Vector:
    return plain(before(power(symbol, 0), ahead))


@lru_cache(maxsize=100_000)
def choice(symbol: str, ahead: Vector, state: int) -> tuple[str, int, int]:
    """The least in ASCII order of the cheapest ways over a row: its edits with their roles, the state after it, the cost."""
    best = before(power(symbol, 0), ahead)
    done, spent = "", 0
    while True:
        left = best[state]
        ways = {edit: (cost, after) for edit, cost, after in edits(symbol, state) if cost + ahead[after] == left}
        if "D" not in ways and INSERT + best[NEXT[state][1]] == left:
            role, state = NEXT[state]
            done, spent = f"{done}I{role}", spent + INSERT
            continue
        edit = min(ways)
        cost, state = ways[edit]
        return done + edit, state, spent + cost


def last_inserts(state: int) -> tuple[str, int]:
    """What is inserted at a conversation's end, and its cost."""
    done, spent = "", 0
    while END[state]:
        role, state = NEXT[state]
        done, spent = f"{done}I{role}", spent + INSERT
    return done, spent


def runs_of(symbols: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Neighbouring runs of a symbol as one."""
    out: list[tuple[str, int]] = []
    for symbol, n in symbols:
        if out and out[-1][0] == symbol:
            symbol, n = symbol, out.pop()[1] + n
        out.append((symbol, n))
    return out


def unroll(runs: list[tuple[str, int]], state: int, ahead: Vector) -> tuple[list[str], int, int]:
    """The edits of each row from a state on, the state after them, and their cost. ahead: costs to the end behind the runs."""
    behind = []
    for symbol, n in reversed(runs):
        behind.append(plain(ahead))
        for matrix in powers(symbol, n):
            ahead = before(matrix, ahead)
    done, spent = [], 0
    for (symbol, n), after in zip(runs, reversed(behind), strict=True):
        inside = [after]
        for _ in range(n - 1):
            inside.append(step(symbol, inside[-1]))
        for vector in reversed(inside):
            edit, state, cost = choice(symbol, vector, state)
            done.append(edit)
            spent += cost
    return done, state, spent


# Rows, parts and edits


def _key(*columns: str) -> Column:
    """Columns as one value, so that nulls in them meet."""
    return F.struct(*columns)


def judged(turns: DataFrame) -> DataFrame:
    """key (conv_id, turn, role, h), n equal rows, whether they are blank, and whether their text breaks off."""
    end = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    rows = turns.select(_key("conv_id", "turn", "role", "h").alias("key"), (end == "").alias("blank"), (~end.isin(".", "!", "?")).alias("open"))
    return rows.groupBy("key").agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("open").alias("open"))


def cleaned(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without nulls in the last two, and h, the text's MD5."""
    text = F.coalesce("text", F.lit(" "))
    return conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("h"))


def parted(rows: DataFrame) -> DataFrame:
    """conv_id, part and the part's rows of the conversation in order. Of rows with equal role and text the first turn's is no duplicate."""
    said = _key("key.conv_id", "key.role", "key.h")
    rows = materialise(rows, "turns")
    first = rows.groupBy(said.alias("said")).agg(F.min(_key("key.turn")).alias("first"), F.count("*").alias("c")).where("c > 1")
    rows = rows.withColumn("said", said).join(first, "said", "left")
    rows = rows.withColumn("seen", F.coalesce(_key("key.turn") > F.col("first"), F.lit(False)))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.select("key.*", "n", "blank", "open", "seen").repartitionByRange(n, "conv_id", "turn", "role", "h").withColumn("part", F.spark_partition_id())
    members = F.struct("turn", "role", "h", "n", "blank", "open", "seen")
    return materialise(ranged.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(members)).alias("rows")), "parts")  # of one part at most


_ROW = "turn long, role string, h binary, n long, blank boolean, open boolean, seen boolean"


def symbols_of(rows: list[dict]) -> list[tuple[str, int]]:
    """Symbols and counts of rows with equal ones: all blank, or the first row and its duplicates."""
    out = []
    for r in rows:
        if r["blank"] or r["seen"]:
            out.append(("X", r["n"]))
            continue
        initial = r["role"][:1] if r["role"][:1] in ("s", "u", "a") else "o"
        out.append((initial.upper() if r["open"] else initial, 1))
        if r["n"] > 1:
            out.append(("X", r["n"] - 1))
    return out


def counted(rows: list[dict]) -> dict:
    """Faults and places of a part's rows; what lies across its ends is added by summed()."""
    blank = sum(r["n"] for r in rows if r["blank"])
    duplicate = sum(r["n"] - (not r["seen"]) for r in rows if not r["blank"])
    truncated = sum(1 for r in rows if r["open"] and not r["blank"] and not r["seen"])
    illegal = sum(r["n"] - 1 for r in rows) + sum(a["role"][:1] + b["role"][:1] not in LEGAL for a, b in zip(rows, rows[1:]))
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    least, most = (turns[0], turns[-1]) if turns else (None, None)
    return {"blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": illegal, "low": least, "high": most, "turns": len(set(turns)), "initial": rows[0]["role"][:1], "last": rows[-1]["role"][:1]}


def cut_parts(parts: DataFrame) -> DataFrame:
    """conv_id, part, state before it and costs behind it (ahead), of the conversations that lie in several parts.

    A boundary between parts cuts one conversation at most, so these are less than twice as many rows as parts.
    """
    cut = parts.groupBy(_key("conv_id").alias("conv")).agg(F.count("*").alias("c")).where("c > 1").select("conv")
    own = parts.withColumn("conv", _key("conv_id")).join(F.broadcast(cut), "conv", "left_semi").select("conv_id", "part", "rows")

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sum(transition(runs_of(symbols_of(rows))), ()) for rows in batch.column("rows").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), pa.array(found, pa.list_(pa.int64()))], names=["conv_id", "part", "matrix"])

    def look_ahead(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        ahead, out = END, []
        for flat in reversed(table.column("matrix").to_pylist()):
            out.append(ahead)
            ahead = before(tuple(tuple(flat[4 * i : 4 * i + 4]) for i in STATES), ahead)
        return table.drop_columns("matrix").append_column("ahead", pa.array(out[::-1], pa.list_(pa.int64())))

    def go_through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [runs_of(symbols_of(rows)) for rows in batch.column("rows").to_pylist()]
            found = [[unroll(r, state, tuple(ahead))[1] for state in STATES] for r, ahead in zip(runs, batch.column("ahead").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "part", "ahead")), pa.array(found, pa.list_(pa.int32()))], names=["conv_id", "part", "ahead", "leads"])

    def follow(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        state, out = 0, []
        for leads in table.column("leads").to_pylist():
            out.append(state)
            state = leads[state]
        last = [False] * (len(out) - 1) + [True]
        return table.drop_columns("leads").append_column("state", pa.array(out, pa.int32())).append_column("last", pa.array(last))

    matrices = in_small_batches(own).mapInArrow(reduce, "conv_id long, part int, matrix array<long>")
    ahead = matrices.groupBy("conv_id").applyInArrow(look_ahead, "conv_id long, part int, ahead array<long>")
    place = _key("conv_id", "part")
    both = own.withColumn("at", place).join(F.broadcast(ahead.select(place.alias("at"), "ahead")), "at").drop("at")
    exits = both.mapInArrow(go_through, "conv_id long, part int, ahead array<long>, leads array<int>")
    return exits.groupBy("conv_id").applyInArrow(follow, "conv_id long, part int, ahead array<long>, state int, last boolean")


_COUNTS = "blank long, duplicate long, truncated long, illegal long, low long, high long, turns long, initial string, last string"


def solved(conversations: DataFrame) -> DataFrame:
    """A row for each conversation and part: faults, cost, and the edits of each of its rows (done), then those at the conversation's end."""
    parts = parted(judged(conversations))
    place = _key("conv_id", "part")
    entries = cut_parts(parts).select(place.alias("at"), "ahead", "state", F.col("last").alias("ends"))
    rows = parts.withColumn("at", place).join(F.broadcast(entries), "at", "left").drop("at")  # bounded by the number of parts
    names = [c.split()[0] for c in _COUNTS.split(", ")]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, costs, done, tails = [], [], [], []
            for r in batch.to_pylist():
                symbols = symbols_of(r["rows"])
                flat, state, cost = unroll(runs_of(symbols), r["state"] or 0, tuple(r["ahead"] or END))
                tail, more = last_inserts(state) if r["ends"] is not False else ("", 0)
                own, i = [], 0
                for row in r["rows"]:
                    own.append("".join(flat[i : i + row["n"]]))
                    i += row["n"]
                counts.append(counted(r["rows"]))
                costs.append(cost + more)
                done.append(own)
                tails.append(tail)
            columns = [pa.array([c[n] for c in counts], pa.string() if n in ("initial", "last") else pa.int64()) for n in names]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), batch.column("rows"), *columns, pa.array(costs, pa.int64()), pa.array(done, pa.list_(pa.string())), pa.array(tails, pa.string())], names=["conv_id", "part", "rows", *names, "cost", "done", "tail"])

    return materialise(in_small_batches(rows).mapInArrow(solve, f"conv_id long, part int, rows array<struct<{_ROW.replace(' ', ':').replace(',:', ',')}>>, {_COUNTS}, cost long, done array<string>, tail string"), "edits")


# Results


def summed(parts: DataFrame) -> DataFrame:
    """A row for each conversation that has rows: gaps, faults, illegal neighbours, cost and audit."""
    own = F.array_sort(F.collect_list(F.struct("part", "low", "high", "initial", "last", F.concat(F.array_join("done", ""), "tail").alias("edits"))))  # bounded by the number of parts
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost", "turns")]
    rows = parts.groupBy("conv_id").agg(*sums, F.min("low").alias("low"), F.max("high").alias("high"), own.alias("own"))
    pairs = F.arrays_zip(F.slice("own", 1, F.size("own") - 1).alias("a"), F.slice("own", 2, F.size("own")).alias("b"))
    across = F.size(F.filter(pairs, lambda p: ~F.concat(p["a"]["last"], p["b"]["initial"]).isin(*LEGAL)))
    again = F.size(F.filter(pairs, lambda p: p["a"]["high"] == p["b"]["low"]))  # a turn on both sides of a boundary counts once
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - (F.col("turns") - again), F.lit(0))
    audit = F.translate(F.array_join(F.transform("own", lambda x: x["edits"]), ""), "ua", "")
    return rows.select("conv_id", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", (F.col("illegal") + across).alias("illegal"), "cost", audit.alias("audit"))


def repaired(conversations: DataFrame, parts: DataFrame) -> DataFrame:
    """conv_id, place (part, row, edit: in this order), turn, role, text and edit of the rows that repaired conversations have."""
    done = F.concat("done", F.array("tail"))
    rows = parts.select("conv_id", "part", "rows", F.posexplode(done).alias("row", "own"))
    rows = rows.withColumn("r", F.get("rows", F.col("row"))).select("conv_id", "part", "row", "r.turn", "r.role", "r.h", F.posexplode(F.regexp_extract_all("own", F.lit("[IKR][ua]?"), F.lit(0))).alias("k", "edit"))
    place = F.struct("part", "row", "k").alias("place")
    new_role = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))[F.right("edit", F.lit(1))]
    inserted = rows.where(F.startswith("edit", F.lit("I"))).select("conv_id", place, F.lit(None).cast("long").alias("turn"), new_role.alias("role"), F.lit("").alias("text"), F.lit("I").alias("edit"))
    kept = rows.where(~F.startswith("edit", F.lit("I"))).select(_key("conv_id", "turn", "role", "h").alias("key"), place, F.when(F.col("edit") == "K", F.col("role")).otherwise(new_role).alias("new"), F.left("edit", F.lit(1)).alias("edit"))
    texts = conversations.select(_key("conv_id", "turn", "role", "h").alias("key"), "text").dropDuplicates(["key"])
    return kept.join(texts, "key").select("key.conv_id", "place", "key.turn", F.col("new").alias("role"), "text", "edit").unionByName(inserted)


def digests(rows: DataFrame) -> DataFrame:
    """conv_id and sha256 of its rows, `role:text` joined by line feeds. A conversation streams through one task, as its hash demands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            out = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if digest is None or conv != now:
                    if digest is not None:
                        out.append((now, digest.hexdigest()))
                    now, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in ((0, pa.int64()), (1, pa.string()))], names=["conv_id", "sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([digest.hexdigest()])], names=["conv_id", "sha256"])

    ordered = rows.select("conv_id", "place", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return in_small_batches(ordered).mapInArrow(run, "conv_id long, sha256 string")


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The summary of each conversation (see summed) and the repaired rows (see repaired)."""
    rows = cleaned(conversations)
    parts = solved(rows)
    return summed(parts), repaired(rows, parts)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults by the CRC-32 of `conv_id:turn` modulo 20: 0 is left out, 1 is emptied, 2 loses its marks, 3 comes twice, 4 is a user's."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20).alias("__k"))
    k = F.col("__k")
    rows = rows.where(k != 0).withColumns({"text": F.when(k == 1, F.lit("")).when(k == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")), "role": F.when(k == 4, F.lit("user")).otherwise(F.col("role"))})
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.when(k == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("__copy")).drop("__copy")
