"""Near-duplicate documents: fast similarity sketches of word shingles, banding, exact verification, components.

Sketching throws every shingle into hashed bins, round after round, until each bin is filled; late rounds go to one
bin each, so every coordinate fills, and matching coordinates estimate the Jaccard similarity with concentration
bounds. Copies with equal shingle sets are one class. Classes that agree on a band meet in a bucket. No bucket
emits all its pairs: in each round its members are compared with one pivot, and members that verified links have
joined into one component need no more comparison. What rounds leave apart is compared pair by pair in small buckets; in
larger ones it is looked up by some of what it has or lacks against a pivot, enough to meet each link. A pair is a link only when
the full shingle sets say so.

Defined results: texts without words have an empty set and no links. With fewer words than a shingle the whole
sequence is one shingle. Rows with equal doc_id are one document, which links to what any of its texts links to, and
all of them have its component; n_shingles is that of the row's own text. Rows with a null id take no part: their
component is null and they are kept. Other input columns are not carried by components(); an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.llm.kernels import NOT_BLANK, Block, blocks, mix, ngram_hashes, span_hashes, spans
from talkmill.llm.shared import in_small_batches, materialise

WORDS = 5
#: A pair of similarity 0.85 misses all bands with probability 3e-7, one of 0.8 with 6e-5.
BANDS, ROWS = 32, 6
#: Buckets are compared with one pivot more as long as so large a share of a round's pairs are links.
PAYS = 0.1
#: Of what rounds leave apart, buckets of at most so many members give all their pairs: (SMALL - 1) / 2 a member at most.
SMALL = 8
#: Standard deviations below the wanted similarity at which a sketch rules out a pair.
SIGMAS = 6.0
#: Bits of a set's parities.
BITS = 512

_U = np.uint64
_EMPTY = _U((1 << 64) - 1)


def shingle_sets(block: Block, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text of a block, sorted within texts, and where each text's begin (one more than texts)."""
    found = spans(block, NOT_BLANK)
    words = span_hashes(block, found.start, found.end, fold=True)
    grams, at = ngram_hashes(words, found.bounds, k)
    texts = found.text[at]
    counts = np.diff(found.bounds)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        own = np.zeros(len(short), _U)
        for i, t in enumerate(short):
            seq = words[found.bounds[t] : found.bounds[t + 1]]
            own[i] = ngram_hashes(seq, np.array([0, len(seq)]), len(seq))[0][0]
        grams, texts = np.concatenate((grams, own)), np.concatenate((texts, short))
    order = np.lexsort((grams, texts))
    grams, texts = grams[order], texts[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (texts[1:] != texts[:-1])
    return grams[new], np.searchsorted(texts[new], np.arange(block.n + 1))


def sketch(sets: np.ndarray, bounds: np.ndarray, t: int) -> np.ndarray:
    """A row of t coordinates for each set: the smallest (round, hash) thrown into each bin. Empty sets have no defined row."""
    n = len(bounds) - 1
    out = np.full(n * t, _EMPTY, _U)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    items = sets
    for i in range(2 * t):
        h = mix(items ^ mix(np.full(1, i + 1, _U)))
        bins = (h >> _U(32)) * _U(t) >> _U(32) if i < t else np.full(len(h), i - t, _U)
        np.minimum.at(out, owner * t + bins.astype(np.int64), _U(i) << _U(54) | mix(h) >> _U(10))
        open_sets = (out.reshape(n, t) == _EMPTY).any(axis=1)
        go = open_sets[owner]
        if not go.all():
            items, owner = items[go], owner[go]
        if not len(items):
            break
    return out.reshape(n, t)


def band_keys(rows: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    n, t = rows.shape
    parts = rows.reshape(n, bands, t // bands)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=_U), (n, bands)).copy()
        for j in range(parts.shape[2]):
            key = mix(key * _U(0x9E3779B97F4A7C15) + parts[:, :, j])
    return key


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, k: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, th (hash of the text), n (set size), d1 and d2 (128 bits that are equal for equal sets), keys (of bands), sketch (a byte of each coordinate)."""
    t = bands * rows
    slim = in_small_batches(docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                sets, bounds = shingle_sets(block, k)
                sizes = np.diff(bounds)
                sums = []
                for salt in (0x51ED270B, 0x2545F491):
                    total = np.concatenate((np.zeros(1, _U), np.cumsum(mix(sets ^ _U(salt)), dtype=_U)))
                    sums.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
                full = sketch(sets, bounds, t)
                keys = band_keys(full, bands)
                flat = pa.array(keys.reshape(-1).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc")[block.rows], batch.column("th")[block.rows], pa.array(sizes.astype(np.int64)), *(pa.array(s) for s in sums), pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands), pa.int32()), flat), pa.array([x.tobytes() for x in (full & _U(255)).astype(np.uint8)], pa.binary())],
                    names=["doc", "th", "n", "d1", "d2", "keys", "sketch"],
                )

    return slim.mapInArrow(run, "doc long, th long, n long, d1 long, d2 long, keys array<long>, sketch binary")


def _alike(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Share of equal coordinates of two columns of sketches."""
    x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(len(c), -1) for c in (a, b))
    return (x == y).mean(axis=1)


def plausible(pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) whose sketches don't rule the similarity out."""
    left, right = (sketches.select(F.col("node").alias(c), F.col("sketch").alias(f"s{c}")) for c in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                t = len(batch.column("sa")[0].as_py())
                least = similarity - SIGMAS * np.sqrt(similarity * (1 - similarity) / t)
                yield batch.select(["a", "b"]).filter(pa.array(_alike(batch.column("sa"), batch.column("sb")) >= least))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, percent: int, k: int = WORDS) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union of the full shingle sets. texts: node, text."""
    left, right = (texts.select(F.col("node").alias(c), F.col("text").alias(f"t{c}")) for c in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok: list[bool] = []
            sides = [((x, b) for blk in blocks(batch, c, 1 << 19) for s, bounds in [shingle_sets(blk, k)] for x, b in [(s, (lo, hi)) for lo, hi in zip(bounds, bounds[1:], strict=False)]) for c in ("ta", "tb")]
            for (x, (x0, x1)), (y, (y0, y1)) in zip(*sides, strict=True):
                own, other = x[x0:x1], y[y0:y1]
                if len(own) > len(other):
                    own, other = other, own
                at = np.searchsorted(other, own)
                both = int((other[np.minimum(at, len(other) - 1)] == own).sum()) if len(own) else 0
                ok.append(both > 0 and 100 * both >= percent * (len(own) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return in_small_batches(joined).mapInArrow(run, "a long, b long")


def connected(links: DataFrame) -> DataFrame:
    """node and root (its component's smallest node) for each node of links (a, b), by large-star and small-star rounds."""
    edges = materialise(links.select("a", "b").where("a <> b").distinct(), "edges")
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        # A hub may have very many edges. Its minimum is written first, so that the join's sides are plain and a large one can be split.
        least = materialise(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = materialise(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "large")
        small = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(small, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = materialise(moved.union(small.select("u", "m")).distinct(), "edges")
        # Stars are left: no node has two roots, and no root has one.
        twice = edges.groupBy("a").agg(F.count("*").alias("n")).join(edges.select(F.col("b").alias("a"), F.lit(True).alias("is_root")).distinct(), "a", "left")
        if twice.where("n > 1 or is_root").isEmpty():
            roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _with_roots(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return members.withColumn("comp", F.col("node"))
    return members.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")


def _pairs(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def parities(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of BITS bits for each set, as 64-bit numbers: whether it has an odd number of the elements that fall on a bit.

    Two sets differ in at least as many elements as their rows do in bits.
    """
    n = len(bounds) - 1
    at = np.repeat(np.arange(n), np.diff(bounds)) * BITS + (mix(sets) % _U(BITS)).astype(np.int64)
    odd = np.bincount(at, minlength=n * BITS) & 1
    return np.packbits(odd.astype(bool).reshape(n, BITS), axis=1).view(np.int64)


def text_sets(texts: DataFrame, k: int = WORDS) -> DataFrame:
    """node, n, own (the hashes of its distinct shingles) and bits (their parities) of texts (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                sets, bounds = shingle_sets(block, k)
                own = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(sets.view(np.int64)))
                rows = parities(sets, bounds)
                bits = pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, BITS // 64), pa.int32()), pa.array(rows.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column("node")[block.rows], pa.array(np.diff(bounds), pa.int64()), own, bits], names=["node", "n", "own", "bits"])

    return in_small_batches(texts.select("node", "text")).mapInArrow(run, "node long, n long, own array<long>, bits array<long>")


def _near(n: tuple[str, str], bits: tuple[str, str], percent: int) -> str:
    """SQL: the parities of two sets don't rule a link out. A link differs in (100 - percent) of (100 + percent) parts of both sizes at most."""
    apart = " + ".join(f"bit_count({bits[0]}[{i}] ^ {bits[1]}[{i}])" for i in range(BITS // 64))
    return f"{100 + percent} * ({apart}) <= {100 - percent} * ({n[0]} + {n[1]})"


def _centre_pairs(groups: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each group's centre with its members in other components. groups: p (the centre's node), node, n, comp."""
    centres = groups.where("node = p").select("p", F.col("n").alias("pn"), F.col("comp").alias("pc"))
    return groups.join(centres, "p").where(f"node <> p and comp <> pc and 100 * least(n, pn) >= {percent} * greatest(n, pn)").select(*_pairs("node", "p"))


def _all_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each bucket's members in different components whose sizes allow a link. buckets (few members each): key, node, n, comp."""
    left, right = (buckets.select("key", *(F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "comp"))) for x in "ab")
    met = left.join(right, "key").where(f"node_a < node_b and comp_a <> comp_b and 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    return met.select(*_pairs("node_a", "node_b"))


def merged_groups(groups: DataFrame) -> DataFrame:
    """groups with one centre for all whose centres are in one component, that of the largest; members of several are held once. groups: p, node, n, comp."""
    centres = groups.where("node = p").select("p", F.col("comp").alias("pc"))
    sizes = groups.groupBy("p").agg(F.count("*").alias("size")).join(centres, "p")
    chosen = sizes.groupBy("pc").agg(F.max_by("p", F.struct("size", "p")).alias("centre"))
    to = materialise(centres.join(chosen, "pc").select("p", "centre"), "centres")
    return groups.join(to, "p").select(F.col("centre").alias("p"), "node", "n", "comp").distinct()


def differences(groups: DataFrame, texts: DataFrame, percent: int, k: int = WORDS) -> DataFrame:
    """p, e, node, comp, n, bits, w and room: what the members of groups have or lack against their centre, as far as another component differs in it too.

    Sets x and y differ in as many elements as their differences dx and dy to the centre do: |dx| + |dy| less twice
    what dx and dy share. So x and y are a link if w(x) + w(y) + 2 (100 + percent) |dx and dy| >= 0, with
    w(x) = (100 - percent) |x| - (100 + percent) |dx|. The centre has the highest w and is compared with all, so members
    that differ from it in nothing alike are no link unless both are its own. Elements go in one order, those that the
    centre lacks first; if the first that two members share is the last but r - 1 of one of them, they share r at most:
    its room. A link of x lacks at most (100 - percent) / 100 of |x|, and both differ in (100 - percent) / percent of |x|
    at most, so so many of dx and one more hold the first that a link shares: no more of them are listed.
    groups: p, node, n, comp; texts: node, text.
    """
    others = groups.where("node <> p")
    several = others.groupBy("p").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1").select("p")
    others = materialise(others.join(several, "p"), "others")
    needed = others.select("node").union(several.select("p")).distinct()
    sets = materialise(text_sets(texts.join(needed, "node", "left_semi"), k).select("node", "own", "bits"), "sets")
    both = others.join(sets, "node").join(sets.select(F.col("node").alias("p"), F.col("own").alias("centre")), "p")
    more, less = (F.array_sort(F.array_except(*c)) for c in (("own", "centre"), ("centre", "own")))
    split = both.select("p", "node", "n", "comp", "bits", more.alias("more"), less.alias("less"))
    diff = split.select("p", "node", "n", "comp", "bits", F.size("more").alias("n_more"), F.concat("more", "less").alias("diff"))
    lacks, apart = (F.floor((100 - percent) * F.col("n") / share).cast("int") for share in (100, max(percent, 1)))
    first = F.slice("diff", 1, F.when(F.col("n_more") > lacks, lacks).otherwise(apart) + 1)
    weight = (100 - percent) * F.col("n") - (100 + percent) * F.size("diff")
    listed = diff.select("p", "node", "comp", "n", "bits", weight.alias("w"), F.size("diff").alias("d"), F.posexplode(first).alias("at", "e"))
    posts = materialise(listed.select("p", "node", "comp", "n", "bits", "w", "e", (F.col("d") - F.col("at")).alias("room")), "differences")
    shared = posts.groupBy("p", "e").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1").select("p", "e")
    return posts.join(shared, ["p", "e"]).select("p", "e", "node", "comp", "n", "bits", "w", "room")


def _with_best(posts: DataFrame, percent: int) -> DataFrame:
    """posts with best, the holder of the element with the highest w, as far as one of such w could be a link."""
    best = posts.groupBy("p", "e").agg(F.max(F.struct("w", "node", "comp", "room", "n", "bits")).alias("best"))
    return posts.join(best, ["p", "e"]).where(f"w + best.w + {2 * (100 + percent)} * room >= 0")


def pairs_with_best(posts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) across components that may be links, of each element's holders with the one of the highest w. posts: see differences()."""
    near = _near(("n", "best.n"), ("bits", "best.bits"), percent)
    met = _with_best(posts, percent).where(f"comp <> best.comp and w + best.w + {2 * (100 + percent)} * best.room >= 0 and {near}")
    return met.select(*_pairs("node", "best.node"))


def pairs_by_differences(posts: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) across components that may be links. posts: see differences().

    Of two holders of an element in different components one is not in that of the best holder. It looks others up,
    if even the best could be a link of it.
    """
    some = materialise(_with_best(posts, percent), "open")
    lookups = some.where("comp <> best.comp").select("p", "e", F.col("node").alias("x"), F.col("comp").alias("xc"), F.col("w").alias("xw"), F.col("room").alias("xr"), F.col("n").alias("xn"), F.col("bits").alias("xb"))
    near = _near(("xn", "n"), ("xb", "bits"), percent)
    met = lookups.join(some.drop("best"), ["p", "e"]).where(f"xc <> comp and xw + w + {2 * (100 + percent)} * least(xr, room) >= 0 and {near}")
    return met.select(*_pairs("x", "node"))


def joined_classes(heads: DataFrame, docs: DataFrame, percent: int, k: int = WORDS, known: DataFrame | None = None) -> DataFrame | None:
    """node and root for each of heads (node, doc, th, n, keys, sketch) that links join to another; None without links.

    docs: doc, th, text. known: links (a, b) that hold without a look at texts. In each round buckets are compared with
    the member that meets most others; it has then met its whole bucket and takes no part there any more. When rounds
    find few links, buckets of at most SMALL members give all their pairs. Members of larger ones are held by their
    differences to the next pivot: first against the best holder of each element, which joins the groups within a bucket,
    then all that are still apart and may be links.
    """
    keyed = heads.select("node", "n", F.explode("keys").alias("key"))
    buckets = materialise(keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    met = materialise(keyed.join(buckets, "key"), "met")
    weights = materialise(met.groupBy("node").agg(F.sum("size").alias("weight")), "weights")
    members = materialise(met.join(weights, "node").drop("size"), "members")
    some = heads.join(weights, "node", "left_semi")
    sketches = materialise(some.select("node", "sketch"), "sketches")
    texts = materialise(some.select("node", "doc", "th").join(docs, ["doc", "th"]).select("node", "text").dropDuplicates(["node"]), "texts")
    links = known
    roots = None if known is None else materialise(connected(known), "roots")
    tested, step, posts = None, "pivot", None
    while True:
        if step == "rest":
            now = posts.drop("comp")
            pairs = pairs_by_differences(_with_roots(now, roots), percent)
        else:
            now = _with_roots(members, None) if roots is None else materialise(_with_roots(members, roots), "now")
            split = now.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.max_by("node", F.struct("weight", "node")).alias("p"), F.count("*").alias("held")).where("c0 < c1").drop("c0", "c1")
            now = materialise(now.join(materialise(split, "split"), "key"), "open-buckets")
            if now.isEmpty():
                return roots
            large = now if step == "pivot" else now.where(F.col("held") > SMALL)
            groups = large.select("p", "node", "n", "comp").distinct()
            if step == "pivot":
                pairs = _centre_pairs(groups, percent)
                members = now.where("node <> p").select("node", "n", "key", "weight")
            else:
                pairs = _all_pairs(now.where(F.col("held") <= SMALL), percent)
                groups = materialise(merged_groups(materialise(groups, "groups")), "merged")
                if not groups.isEmpty():
                    posts = materialise(differences(groups, texts, percent, k), "posts")
                    pairs = pairs.union(_centre_pairs(groups, percent)).union(pairs_with_best(posts, percent))
        pairs = pairs.distinct()
        pairs = materialise(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        likely = materialise(plausible(pairs, sketches, percent / 100), "likely")  # a task holds one Python worker
        new = materialise(verified(likely, texts, percent, k), "links")
        n_new = new.count()
        if n_new:
            links = new if links is None else links.union(new)
            roots = materialise(connected(links), "roots")
        if step == "rest" or step == "best" and posts is None:
            return roots
        tested = pairs if tested is None else tested.union(pairs)
        if step == "best":
            step = "rest"
        elif n_new <= PAYS * pairs.count():
            step = "best"


def components(docs: DataFrame, percent: int = 80, k: int = WORDS, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id_col, n_shingles, component_id (the smallest id reachable over links) and kept."""
    alike = ["n", "d1", "d2"]
    seen = materialise(signatures(docs, bands, rows, k, id_col, text_col), "signatures")
    some = seen.where("n > 0 and doc is not null")
    # Equal sets are a class. Its number holds from here on, as the table is written.
    classes = materialise(some.groupBy(*alike).agg(F.min("doc").alias("rep")).withColumn("node", F.monotonically_increasing_id()), "classes")
    heads = materialise(some.join(classes, alike).where("doc = rep").dropDuplicates(["node"]).select("node", "doc", "th", "n", "keys", "sketch"), "heads")
    of = materialise(some.select("doc", *alike).join(classes, alike).select("doc", "node", "rep"), "classes-of")
    several = of.groupBy("doc").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z")
    known = None if several.isEmpty() else of.join(several, "doc").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    roots = joined_classes(heads, texts, percent, k, known)
    if roots is not None:
        linked = materialise(classes.select("node", "rep").join(roots, "node"), "linked")
        least = materialise(linked.groupBy("root").agg(F.min("rep").alias("least")), "least")
        of = of.join(linked.join(least, "root").select("node", "least"), "node", "left").withColumn("rep", F.coalesce("least", "rep"))
    by_doc = of.groupBy("doc").agg(F.min("rep").alias("rep"))
    out = seen.select("doc", "n").join(by_doc, "doc", "left").withColumn("rep", F.coalesce("rep", "doc"))
    kept = F.coalesce(F.col("doc") == F.col("rep"), F.lit(True))
    return out.select(F.col("doc").cast(docs.schema[id_col].dataType).alias(id_col), F.col("n").alias("n_shingles"), F.col("rep").alias("component_id"), kept.alias("kept"))
