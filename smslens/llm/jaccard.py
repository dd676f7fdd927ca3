"""Similarity join of word-shingle sets by Jaccard, from runs and prefixes under several global token orders.

Lay the union of two sets out as a ring in a global order.  With t of it common and the rest not, the tokens that only
one set has cut the common ones into as many stretches, and the longest has t / (1 - t) tokens at least.  So two
sets at Jaccard t or more share a run: so many tokens (9 at 0.9, 4 at 0.8) that follow each other in both.  Each run is
posted under its anchor, the few neighbouring tokens in it of the smallest hash, which many runs of a set share.  Pairs
are looked for among sets that share an anchor and, where those are many, among sets that share the whole run.

A set's prefix under an order is its first size - ceil(t * size) + 1 tokens; two sets at Jaccard t or more share a
prefix token under every order.  Pairs away from a group's head whose prefixes do not meet under the other orders
are not counted out.

A set's sketch is a bit map in which every token turns one bit over.  Tokens that two sets have in common cancel out, so the
bits in which their sketches differ are no more than the tokens in which they do: pairs that this settles need no text.

Equal sets are one class.  Inside a group of classes that share an anchor not all pairs are listed: see
run_links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smslens.llm.common import LOWER, Block, RollingHash, attach, blocks, components, lists, mixed, once, shingles, stored, tidy, words

#: Members from which an anchor is frequent, so that its open pairs have to share a whole run.
FREQUENT_FROM = 16
#: A run longer than any set: sets that must not differ at all.
NO_RUN = 1 << 40
#: Bits of a sketch for each token at least.
SKETCH_BITS = 2
#: Orders besides the first.
OTHER_ORDERS = 2
HASH = RollingHash(9)
#: Stands for a missing id beside a mark.
NO_ID = -1


def token_sets(block: Block, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending within a text, and one count per text.

    A text of fewer words has its whole word sequence as its only shingle, one without words has none.
    """
    starts, ends, doc = words(block)
    hashed = HASH.spans(HASH.sums(block.data, LOWER), starts, ends)
    token, of = shingles(hashed, doc, length)
    n_words = np.bincount(doc, minlength=block.size)
    short = np.flatnonzero((n_words > 0) & (n_words < length))
    if len(short):
        first = np.searchsorted(doc, short)
        acc = np.zeros(len(short), np.uint64)
        for k in range(length - 1):  # longer sequences differ in their last step from shorter ones
            at = np.minimum(first + k, len(doc) - 1)
            acc = np.where(k < n_words[short], mixed(acc * np.uint64(0x9E3779B97F4A7C15) + hashed[at]), acc)
        token, of = np.r_[token, mixed(acc + np.uint64(1))], np.r_[of, short]
    order = np.lexsort((token, of))
    token, of = token[order], of[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (of[1:] != of[:-1])
    return token[new], np.bincount(of[new], minlength=block.size)


def prefix_lengths(sizes: np.ndarray, percent: int) -> np.ndarray:
    return np.where(sizes > 0, sizes - -(-sizes * percent // 100) + 1, 0)


def run_length(percent: int) -> int:
    """Tokens in a row, on the ring of a global order, that two different sets of the threshold share at least."""
    return -(-percent // (100 - percent)) if percent < 100 else NO_RUN


def runs(token: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every token of each set the run that starts there: its anchor, its hash, and whether the set has so many tokens.

    token: the sets' tokens ascending, one set after the other.  Runs go on at a set's first token after its last.
    """
    length = run_length(percent)
    long = counts >= length
    valid = np.repeat(long, counts)
    if not valid.any():
        return token, token, valid
    gram = max(1, length // 2)
    starts = (np.cumsum(counts) - counts)[long]
    n = counts[long]
    size = n + length - 1
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    ring = token[np.repeat(starts, size) + place % np.repeat(n, size)]
    first = place < np.repeat(n, size)
    acc = np.zeros(len(ring) - gram + 1, np.uint64)
    for k in range(gram):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + ring[k : k + len(acc)]
    grams = mixed(acc)
    many = len(ring) - length + 1
    anchor, whole = grams[:many].copy(), np.zeros(many, np.uint64)
    for k in range(1, length - gram + 1):
        np.minimum(anchor, grams[k : k + many], out=anchor)
    for k in sorted({*range(0, length - gram + 1, gram), length - gram}):
        whole = whole * np.uint64(0x9E3779B97F4A7C15) + grams[k : k + many]
    out = []
    for found in (anchor, mixed(whole)):
        full = np.zeros(len(token), np.uint64)
        full[valid] = found[first[:many]]
        out.append(full)
    return out[0], out[1], valid


def anchors(token: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of each set's runs, those of neighbouring runs once, and their number."""
    anchor, _, valid = runs(token, counts, percent)
    of = np.repeat(np.arange(len(counts)), counts)
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])
    return anchor[new], np.bincount(of[new], minlength=len(counts))


def sketches(token: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sketch of each set as 64-bit words, a power of two of them, and their number; none for an empty set."""
    words_of = np.where(counts > 0, 1 << np.ceil(np.log2(np.maximum(counts * SKETCH_BITS, 64) / 64)).astype(np.int64), 0)
    starts = (np.cumsum(words_of) - words_of) * 64
    last = np.repeat(np.maximum(words_of * 64, 1) - 1, counts).astype(np.uint64)
    at = np.repeat(starts, counts) + (token & last).astype(np.int64)
    odd = np.bincount(at, minlength=int(words_of.sum()) * 64).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.uint64), words_of


def surely_apart(x: str, y: str) -> Column:
    """Bits in which two sketches differ, the longer one folded: the sets differ in as many tokens at least."""
    ones = lambda bits: F.aggregate(bits, F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w))
    size = F.least(F.size(x), F.size(y))
    folded = lambda c, i: F.aggregate(F.sequence(i, F.size(c) - 1, size), F.lit(0).cast("long"), lambda w, k: w.bitwiseXOR(F.get(F.col(c), k)))
    unlike = F.transform(F.sequence(F.lit(0), size - 1), lambda i: folded(x, i).bitwiseXOR(folded(y, i)))
    alike = F.zip_with(x, y, lambda a, b: a.bitwiseXOR(b))
    return F.when(F.size(x) == F.size(y), ones(alike)).otherwise(ones(unlike))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def map_texts(docs: DataFrame, keep: list[str], schema: str, make) -> DataFrame:
    """docs' columns `keep`, then what make(block) returns as Arrow arrays; `text` has to be the last column of docs."""
    names = [*keep, *[f.strip().split(" ")[0] for f in schema.split(",")]]
    kinds = [f"{c} {t}" for c, t in docs.select(*keep).dtypes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(len(keep))):
                kept = [c.slice(block.first, block.size) for c in batch.columns[: len(keep)]]
                yield pa.RecordBatch.from_arrays([*kept, *make(block)], names)

    return docs.select(*keep, "text").mapInArrow(run, ", ".join([*kinds, schema]))


def set_names(token: np.ndarray, counts: np.ndarray) -> list[str | None]:
    """A 128-bit name of each set, none for an empty one."""
    data, ends = token.tobytes(), np.cumsum(counts)
    return [hashlib.md5(data[8 * (e - c) : 8 * e]).hexdigest() if c else None for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]


def described(docs: DataFrame, length: int, percent: int) -> DataFrame:
    """docs (doc_id, th, th2, text) with the size and name of the set, the anchors of its runs and its sketch."""

    def make(block: Block) -> list[pa.Array]:
        token, counts = token_sets(block, length)
        anchor, most = anchors(token, counts, percent)
        bits, n_words = sketches(token, counts)
        return [pa.array(counts, pa.int64()), pa.array(set_names(token, counts), pa.string()), lists(signed(anchor), most, pa.int64()), lists(signed(bits), n_words, pa.int64())]

    return map_texts(docs, ["doc_id", "th", "th2"], "n long, class string, anchors array<long>, sketch array<long>", make)


def whole_runs(docs: DataFrame, length: int, percent: int) -> DataFrame:
    """(node, token, run) of every run of docs (node, text), token being its anchor."""

    def make(block: Block) -> list[pa.Array]:
        token, counts = token_sets(block, length)
        anchor, run, valid = runs(token, counts, percent)
        most = np.where(counts >= run_length(percent), counts, 0)
        return [lists(signed(x[valid]), most, pa.int64()) for x in (anchor, run)]

    found = map_texts(docs, ["node"], "token array<long>, run array<long>", make)
    return found.select("node", F.inline(F.arrays_zip("token", "run")))


def size_fits(a: Column, b: Column, percent: int) -> Column:
    """Sizes that can reach the threshold: the smaller is at least that share of the larger."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def meet(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets' prefixes share a token under each of the other orders."""
    a, b = prefix_lengths(np.array([len(x), len(y)]), percent)
    for k in range(OTHER_ORDERS):
        rank_x, rank_y = mixed(x + np.uint64(k + 1)), mixed(y + np.uint64(k + 1))
        if not np.isin(np.partition(rank_x, a - 1)[:a], np.partition(rank_y, b - 1)[:b]).any():
            return False
    return True


def held(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, length: int, percent: int, every: bool) -> DataFrame:
    """Pairs (a, b) of fitting sizes with `apart`, the tokens that one of the two sets has alone, and those tokens.

    With every=False only pairs that reach the threshold stay, and pairs whose prefixes do not meet under the other
    orders are not counted out; with every=True all stay, and differences beyond three times what a link allows
    are null.  Pairs that the sketches settle (no link; with every=True beyond three times) are not looked up, `apart` being
    what the sketches show.  For the others whole texts are fetched and their sets are built where a pair is
    decided: texts shuffle in a third of the bytes that sets of 64-bit tokens take.  nodes: (node, doc_id, th, n, sketch).
    """
    size = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"{x}_n"), F.col("sketch").alias(f"{x}_sketch"))
    pairs = pairs.join(size("a"), "a").join(size("b"), "b").where(size_fits(F.col("a_n"), F.col("b_n"), percent))
    pairs = stored(once(pairs, ["a", "b", "a_n", "b_n"], apart=surely_apart("a_sketch", "b_sketch")))
    settled = F.col("apart") > 3 * most_apart(F.col("a_n"), percent) if every else ~links_at(F.col("apart"), F.col("a_n"), F.col("b_n"), percent)
    far = pairs.where(settled).withColumn("diff", F.lit(None).cast("array<long>"))
    pairs = pairs.where(~settled).drop("apart")
    nodes = nodes.drop("sketch")
    involved = stored(nodes.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node"))
    texts = stored(attach(docs, involved, ["doc_id", "th"], "inner").select("node", "text").dropDuplicates(["node"]))
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))

    names = ["a", "b", "a_n", "b_n", "apart", "diff"]

    def sets(column: pa.Array) -> Iterator[np.ndarray]:
        for block in blocks(column):
            token, counts = token_sets(block, length)
            yield from np.split(token, np.cumsum(counts)[:-1])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart, diff = [], []
            for x, y in zip(sets(batch.column(4)), sets(batch.column(5)), strict=True):
                if not every and not meet(x, y, percent):
                    apart.append(len(x) + len(y))
                    diff.append(None)
                    continue
                d = np.setxor1d(x, y, assume_unique=True)
                apart.append(len(d))
                diff.append(signed(d) if every and len(d) <= 3 * most_apart(len(x), percent) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(apart, pa.int64()), pa.array(diff, pa.list_(pa.int64()))], names)

    tidy(docs.sparkSession)
    both = pairs.join(left, "a").join(right, "b").select(*names[:4], "a_text", "b_text")
    found = both.mapInArrow(count, "a long, b long, a_n long, b_n long, apart long, diff array<long>")
    return stored(found.unionByName(far) if every else found.where(links_at(F.col("apart"), F.col("a_n"), F.col("b_n"), percent)))


def links_at(apart: Column, a: Column, b: Column, percent: int) -> Column:
    """common * 100 >= union * percent, in terms of sizes and of the tokens that one set has alone."""
    return (a + b - apart) * 100 >= (a + b + apart) * percent


def most_apart(n: int | Column, percent: int) -> int | Column:
    """Tokens in which a set of n tokens differs at most from any that it links with: sizes differ by the same share."""
    most = n * (1 + 100 / percent) * (100 - percent) / (100 + percent)
    return F.floor(most).cast("long") + 1 if isinstance(n, Column) else int(most) + 1


def met_by_difference(differing: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between nodes of one head in different components, whose differences from it share a token.

    differing: (head, node, component, x, apart, diff), near: the same pairs without diff.  Each token of a difference becomes
    a row of fixed width; that two nodes share so many of them is a count, so no difference is carried along with its tokens.

    A token that no other difference of the head has sets its node apart from all others, so `spare`, what a link allows
    beyond those, bounds how many of the other tokens a partner may lack: it has one of the spare + 1 rarest.  Nodes meet on
    those alone, and only if what follows in both can still be enough; copies of a head that each have edits of their
    own do not meet.
    """
    node = ["head", "node"]
    keyed = differing.select(*node, F.explode("diff").alias("d"))
    held_by = keyed.groupBy("head", "d").agg(F.count("*").alias("holders")).where("holders > 1")
    common = stored(keyed.join(held_by, ["head", "d"]))
    side = near.select(*node, "component", "x", "apart").join(common.groupBy(*node).agg(F.count("*").alias("u")), node)
    side = side.withColumn("spare", most_apart(F.col("x"), percent) - (F.col("apart") - F.col("u"))).where("spare >= 0")
    order = Window.partitionBy(*node).orderBy("holders", "d")
    first = common.withColumn("at", F.row_number().over(order)).join(side, node).where("at <= spare + 1").drop("holders", "spare")
    other = first.withColumnsRenamed({c: f"{c}2" for c in first.columns if c not in ("head", "d")})
    rest = F.least(F.col("u") - F.col("at"), F.col("u2") - F.col("at2"))  # tokens that both may have after this one
    apart = F.col("apart") + F.col("apart2") - 2 * (rest + 1)
    met = first.join(other, ["head", "d"]).where((F.col("component") != F.col("component2")) & (F.col("node") < F.col("node2")) & links_at(apart, F.col("x"), F.col("x2"), percent))
    met = stored(met.select(*node, "node2", "x", "x2", "apart", "apart2").distinct())
    shared = met.join(common.select(*node, "d"), node).join(common.select("head", F.col("node").alias("node2"), "d"), ["head", "node2", "d"])
    shared = shared.groupBy(*node, "node2", "x", "x2", "apart", "apart2").agg(F.count("*").alias("n"))
    apart = F.col("apart") + F.col("apart2") - 2 * F.col("n")
    return shared.where(links_at(apart, F.col("x"), F.col("x2"), percent)).select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()


def run_links(posted: DataFrame, nodes: DataFrame, docs: DataFrame, length: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) and their components among the nodes of posted (token, node), which share an anchor.

    Each node is held against the smallest node of its groups, its heads.  What is left are pairs of a group in
    different components.  Sets that differ little from the same head are compared by their differences: two sets
    differ where exactly one of the differences has the token.  Two that share no such token link only if both link
    with the head, so they meet on these tokens, and a group of many copies just below the threshold is not
    paired up.  A set close to the head and one far from it cannot link.  Of a frequent anchor's other pairs only those
    that share a whole run are listed: sets that have nothing but the anchor in common are very many, and those
    that link share a run whose anchor it is, or another run.  Other pairs are decided on their texts.
    """
    spread = posted.repartition("token")  # shuffled once, for the heads and for their members
    heads = spread.groupBy("token").agg(F.min("node").alias("head"), F.max("node").alias("other")).where("head < other").drop("other")
    shared = stored(spread.join(heads.hint("shuffle_hash"), "token").distinct())
    tidy(posted.sparkSession)
    star = stored(shared.where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct())
    measured = held(star, nodes, docs, length, percent, True)
    links = stored(measured.where(links_at(F.col("apart"), F.col("a_n"), F.col("b_n"), percent)).select("a", "b"))
    tidy(posted.sparkSession)
    found = components(links)
    place = lambda df: df.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))

    ends = lambda df: df.withColumnsRenamed({"a": "head", "b": "node", "b_n": "x"})
    near = place(ends(measured.where("diff is not null").select("a", "b", "b_n", "apart")))
    near = stored(near)
    mixed_heads = near.groupBy("head").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("head")
    near = stored(near.join(mixed_heads, "head"))  # the others have nothing left to decide
    differing = ends(measured.select("a", "b", "diff"))
    close = stored(met_by_difference(attach(differing, near, ["head", "node"], "inner"), near, percent))

    # 0 unknown (sizes too unlike to be held against the head), 1 close, 2 near, 3 far
    limit = F.col("b_n") * (1 + 100 / percent) * (100 - percent) / (100 + percent) + 1
    rank = F.when(F.col("diff").isNull(), 3).when(F.col("apart") <= limit, 1).otherwise(2)
    ranks = stored(measured.select(F.col("a").alias("head"), F.col("b").alias("node"), rank.alias("rank")))
    tidy(posted.sparkSession)
    split = place(shared.select("token", "node")).groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("token")
    split = stored(split)  # few groups are left, so that the other joins move little
    tidy(posted.sparkSession)
    ranked = place(attach(shared, split, ["token"], "left_semi")).join(ranks, ["head", "node"], "left")
    ranked = ranked.join(nodes.select("node", F.col("n").alias("x")), "node")
    open_ = stored(ranked.withColumn("rank", F.when(F.col("node") == F.col("head"), 1).otherwise(F.coalesce("rank", F.lit(0)))))
    frequent = stored(open_.groupBy("token").agg(F.count("*").alias("members")).where(F.col("members") >= FREQUENT_FROM).select("token"))
    in_runs = by_runs(attach(open_, frequent, ["token"], "left_semi"), nodes, docs, length, percent)
    open_ = stored(attach(open_, frequent, ["token"], "left_anti").unionByName(in_runs))
    tidy(posted.sparkSession)
    other = open_.select("token", *[F.col(c).alias(f"{c}2") for c in ("node", "x", "component", "rank")])
    decided = (F.col("rank").isin(1, 2) & F.col("rank2").isin(1, 2)) | ((F.col("rank") == 1) & (F.col("rank2") == 3)) | ((F.col("rank") == 3) & (F.col("rank2") == 1))
    cross = open_.join(other, "token").where((F.col("component") != F.col("component2")) & (F.col("node") < F.col("node2")) & ~decided & size_fits(F.col("x"), F.col("x2"), percent))
    cross = stored(cross.select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct())
    tidy(posted.sparkSession)
    more = close if cross.isEmpty() else stored(close.unionByName(held(cross, nodes, docs, length, percent, False).select("a", "b")))
    if not more.isEmpty():
        links = stored(links.unionByName(more))
        found = components(links)
    return links, found


def by_runs(crowded: DataFrame, nodes: DataFrame, docs: DataFrame, length: int, percent: int) -> DataFrame:
    """crowded's rows (token, node, ...) once for every whole run of the node that has the token as its anchor, by the run.

    Runs that no nodes of different components share are left out.
    """
    crowded = stored(crowded)
    if crowded.isEmpty():
        return crowded
    involved = stored(nodes.drop("sketch").join(crowded.select("node").distinct(), "node"))
    texts = attach(docs, involved, ["doc_id", "th"], "inner").select("node", "text").dropDuplicates(["node"])
    tokens = stored(crowded.select("token").distinct())
    found = stored(attach(whole_runs(texts, length, percent), tokens, ["token"], "left_semi").distinct())
    keyed = stored(found.join(crowded, ["token", "node"]).drop("token").withColumnRenamed("run", "token"))
    split = keyed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("token")
    return stored(attach(keyed, stored(split), ["token"], "left_semi").select(*crowded.columns))


def jaccard_components(docs: DataFrame, length: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class, links.

    Documents link where 100 * common >= percent * union of their distinct `length`-word shingles (A-Z lower-cased,
    words between ASCII white space); component_id is the smallest id reachable by links, itself included.  class
    names the set (null for an empty one), links counts the verified links of the class that were needed.
    Texts without words, and null texts, have empty sets, link with nothing and keep their own id.  A row without
    id takes the component of the equal sets that have one; a set that only such rows have is not compared.
    Repeated rows are equal sets.  An empty table gives no rows; other columns are not read.
    """
    return placed_rows(docs, length, percent, id_col, text_col).drop("th", "th2")


def row_key(id_col: str, text_col: str) -> dict[str, Column]:
    """What tells rows apart: the id and two hashes of the text."""
    return {"doc_id": F.col(id_col).cast("long"), "th": F.xxhash64(F.col(text_col)), "th2": F.xxhash64(F.lit("b"), F.col(text_col))}


def placed_rows(docs: DataFrame, length: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """jaccard_components with th and th2, two hashes of the row's text."""
    base = docs.select(*[c.alias(name) for name, c in row_key(id_col, text_col).items()], F.col(text_col).alias("text"))
    rows = stored(described(base, length, percent))
    classes = stored(rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least")))
    named = classes.where("least is not null").select("class", F.xxhash64("class").alias("node"), F.col("least").alias("doc_id"))
    nodes = stored(rows.select("class", "doc_id", "th", "n", "sketch").join(named, ["class", "doc_id"]).dropDuplicates(["class"]))
    posted = rows.where("class is not null and doc_id is not null").select(F.xxhash64("class").alias("node"), F.explode("anchors").alias("token"))
    links, found = run_links(posted, nodes, base, length, percent)

    ends = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    linked = nodes.select("node", "class", "doc_id").join(found, "node").join(ends, "node", "left")
    least = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = linked.join(least, "component").select("class", "component_id", "links")
    known = stored(classes.join(linked, "class", "left").select("class", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("links", F.lit(0)).alias("links")))
    placed = rows.select("doc_id", "n", "class", "th", "th2").join(known, "class", "left")
    return placed.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "class", F.coalesce("links", F.lit(0)).alias("links"), "th", "th2")


def keep_one_of_each(docs: DataFrame, length: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component; all columns stay, whatever their names.

    The row with the smallest id stays; of several with that id the one whose text has the smallest hash.  Rows without id stay
    only if no row with an id is in their component, one for each set.  Rows are told apart by id and
    text: another text under the same id is decided by its own component, and repeated rows (same id and text) stay
    once, any one of them.  Null texts and texts without words are in no component and all stay.  An empty table stays empty.
    """
    mine = {"doc_id": "__near_id", "th": "__near_1", "th2": "__near_2"}
    found = stored(placed_rows(docs, length, percent, id_col, text_col).where("class is not null").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.col("doc_id").isNull().alias("none"), "th", "th2",
        F.coalesce(F.col("component_id").cast("string"), "class").alias("component"),
    ))
    keys = ["component", "none", "doc_id", "th", "th2"]
    each = stored(found.groupBy(*keys).agg(F.count("*").alias("n")))
    least = each.where("not none").groupBy("component").agg(F.min("doc_id").alias("least"))
    led = each.join(least, "component", "left").where("least is null or (not none and doc_id = least)")
    first = led.groupBy("component").agg(F.min("th").alias("th"))
    kept = led.join(first, ["component", "th"], "left_semi").groupBy("component", "none", "doc_id", "th").agg(F.min("th2").alias("th2"))
    named = lambda df: df.select("none", *[F.col(c).alias(new) for c, new in mine.items()])
    gone = stored(named(each.join(kept, keys, "left_anti")))
    again = stored(named(each.join(kept, keys, "left_semi").where("n > 1")))

    marked = docs.withColumns({mine[name]: c for name, c in row_key(id_col, text_col).items()})
    marked = marked.withColumn("__near_none", F.col("__near_id").isNull()).withColumn("__near_id", F.coalesce("__near_id", F.lit(NO_ID)))
    on = ["__near_none", *mine.values()]
    left = attach(marked, gone.withColumnRenamed("none", "__near_none"), on, "left_anti")
    again = again.withColumnRenamed("none", "__near_none")
    once = attach(left, again, on, "left_semi").dropDuplicates(on)
    whole = attach(left, again, on, "left_anti").unionByName(once)
    return whole.select(*[F.col(f"`{c}`") for c in docs.columns])
