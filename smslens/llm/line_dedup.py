"""Fuzzy line deduplication on DataFrame functions alone.

Lines are normalised (lower case, runs of anything but letters and digits as one space); equal normal forms are one
line.  Each distinct line of five words or more, or as long in a script or code without spaces, gets a 64-bit SimHash of its distinct words (a mark that stands between all words of a table's rows would
otherwise give them all one hash).  Lines within three bits of each other agree on at least three of six blocks
of the hash, so lines are joined on every three blocks (31 to 33 bits of the hash: two of five blocks, 25 bits, meet by
chance too often in large tables), and what is within three bits and also close by edit distance is linked.  Of each connected group the first occurrence in
the table stays.

SimHash on the JVM: a word's hash is split into bits, and bits that are sixteen apart share a 64-bit sum as lanes of
sixteen bits.  So 16,383 distinct words need sixteen sums, whose lanes are held against half of the words all at once; a longer line is counted bit by bit within its row.
Lines go by their hashes from there on; only those that may link nearly are read again.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smslens.llm.common import attach, group_links, once, stored, text_or_empty, tidy

MIN_WORDS = 5
#: A line of fewer words counts too if it is one word of so many characters, or has so many of a script without spaces.
MIN_CHARS, MIN_SPACELESS = 25, 10
SPACELESS = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
SIMILARITY = 0.8
#: Characters from which the ends that two lines share are cut off before their distance is counted.
CUT_FROM = 100
#: Distances that are tried before the one allowed: time grows with the distance tried.
TRIED = (16, 64)
#: Bits that may differ; one more than this may share no block, so blocks number DISTANCE + BLOCKS_JOINED.
DISTANCE, BLOCKS_JOINED = 3, 3
BLOCK_BITS = (11, 11, 11, 11, 10, 10)
#: Lanes of a sum, the lowest bit of each, and the most words that a lane counts (a lane's two upper bits stay free).
LANE_BITS, LANES, LANE_WORDS = 16, 0x0001000100010001, 0x3FFF


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and the key of a row: its id and a hash of the whole, so that an absent or repeated id is no matter."""
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return out.withColumn("id0", F.coalesce("doc_id", F.lit(0))).withColumn("rk", row_hash(F.col("doc_id"), F.col("text")))


def occurrences(rows: DataFrame) -> DataFrame:
    """Each line: doc_id, id0, rk, pos, norm, node, node2."""
    lines = rows.select("doc_id", "id0", "rk", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = once(lines, ["doc_id", "id0", "rk", "pos"], norm=normal_line(F.col("line"))).where("norm <> ''")
    return lines.withColumn("node", F.xxhash64("norm")).withColumn("node2", F.xxhash64(F.lit(1), "norm"))


def n_words() -> Column:
    """Words of a normal line, by its single spaces."""
    return F.char_length("norm") - F.char_length(F.replace(F.col("norm"), F.lit(" "), F.lit(""))) + 1


def long_enough() -> Column:
    """Whether a normal line (norm, words) is compared at all."""
    in_one = (F.col("words") == 1) & (F.char_length("norm") >= MIN_CHARS)
    return (F.col("words") >= MIN_WORDS) | in_one | (F.regexp_count("norm", F.lit(SPACELESS)) >= MIN_SPACELESS)


def huge_hash(hashes: Column) -> Column:
    """The SimHash of a line by counting bit after bit, for the rare lines of more words than a lane holds."""
    ones = lambda k: F.size(F.filter(hashes, lambda h: F.bit_get(h, k) == 1))
    bit = lambda k: F.when(ones(k) * 2 > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), k)).otherwise(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda bits, k: bits.bitwiseOR(bit(k)))


def hashed_lines(rows: DataFrame) -> DataFrame:
    """(doc_id, id0, rk, pos, node, node2, simhash) of every line that is compared.

    Words become rows beside their line's keys and collapse to one row per line before the shuffle; no text is shuffled.
    """
    lines = occurrences(rows).withColumn("words", n_words()).where(long_enough())
    keys = ["doc_id", "id0", "rk", "pos", "node", "node2"]
    hashed = once(lines, keys, hashes=F.array_distinct(F.transform(F.split("norm", " "), lambda w: F.xxhash64(w))))
    huge = F.size("hashes") > LANE_WORDS
    hashed = hashed.select(*keys, F.monotonically_increasing_id().alias("line"), F.when(huge, huge_hash(F.col("hashes"))).alias("huge"), F.when(huge, F.slice("hashes", 1, 1)).otherwise(F.col("hashes")).alias("hashes"))
    words = hashed.select("line", *keys, "huge", F.explode("hashes").alias("h"))
    sums = [F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(LANES))).alias(f"s{k}") for k in range(LANE_BITS)]
    summed = words.groupBy("line", *keys, "huge").agg(*sums, F.count("*").alias("words"))
    over = (F.lit(0x3FFF).cast("long") - F.shiftright("words", 1)) * F.lit(LANES)  # lifts a lane to its bit 14 if it counts over half of the words
    bits = F.lit(0).cast("long")
    for k in range(LANE_BITS):
        lifted = (F.col(f"s{k}") + over).bitwiseAND(F.lit(LANES << 14))
        bits = bits.bitwiseOR(F.shiftrightunsigned(lifted, 14 - k) if k < LANE_BITS - 1 else F.shiftleft(lifted, 1))
    return summed.select(*keys, F.coalesce("huge", bits).alias("simhash"))


def place() -> Column:
    """A line's place in the table's order: by id, absent ids last, then position."""
    at = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit("9223372036854775808").cast("decimal(20,0)"))
    return (at * F.lit(4294967296).cast("decimal(12,0)") + F.col("pos")).cast("decimal(38,0)")


def block_keys() -> Column:
    """One key for every three blocks: which ones, and their bits."""
    starts = [sum(BLOCK_BITS[:i]) for i in range(len(BLOCK_BITS))]
    block = [F.shiftrightunsigned("simhash", s).bitwiseAND(F.lit((1 << b) - 1)) for s, b in zip(starts, BLOCK_BITS, strict=True)]
    keys = []
    for n, chosen in enumerate(combinations(range(len(block)), BLOCKS_JOINED)):
        key = F.lit(n).cast("long")
        for i in chosen:
            key = F.shiftleft(key, BLOCK_BITS[i]).bitwiseOR(block[i])
        keys.append(key)
    return F.array(*keys)


def shared_length(a: str, b: str, side: str) -> Column:
    """Characters that two strings share at their left or right end, found by halving steps."""
    steps = F.array(*[F.lit(1 << k) for k in range(24, -1, -1)])
    end = F.left if side == "left" else F.right
    most = F.least(F.char_length(a), F.char_length(b))
    return F.aggregate(steps, F.lit(0), lambda p, s: F.when((p + s <= most) & (end(F.col(a), p + s) == end(F.col(b), p + s)), p + s).otherwise(p))


def words_apart(a: str, b: str) -> Column:
    """At least the Levenshtein distance of two lines of as many words: the characters of the words that differ; null for other lines."""
    differ = F.zip_with(a, b, lambda x, y: F.when(x == y, 0).otherwise(F.greatest(F.char_length(x), F.char_length(y))))
    return F.when(F.size(a) == F.size(b), F.aggregate(differ, F.lit(0), lambda n, d: n + d))


def edit_similar(pairs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs (a, b, a_norm, b_norm) whose Levenshtein distance leaves the similarity.

    Pairs whose words differ place by place in no more than the distance allowed need no comparing.  Of the others the ends
    that long lines share are cut off first; short ones are compared sooner than their ends are found.  What is left needs no
    comparing if it is not longer than the distance allowed; small distances are tried first.
    """
    longest = F.greatest(F.char_length("a_norm"), F.char_length("b_norm"))
    cut = pairs.withColumn("allowed", F.floor(longest * (1 - similarity) + 1e-9).cast("int")).where(F.abs(F.char_length("a_norm") - F.char_length("b_norm")) <= F.col("allowed"))
    cut = once(cut, ["a", "b", "allowed", "a_norm", "b_norm"], a_words=F.split("a_norm", " "), b_words=F.split("b_norm", " "))
    cut = once(cut, ["a", "b", "allowed", "a_norm", "b_norm"], near=F.coalesce(words_apart("a_words", "b_words") <= F.col("allowed"), F.lit(False)))
    undecided = lambda x: F.when(F.col("near"), F.lit("")).otherwise(F.col(x))
    cut = once(cut, ["a", "b", "allowed", "near"], a_norm=undecided("a_norm"), b_norm=undecided("b_norm"))
    cut = once(cut, ["a", "b", "allowed", "near", "a_norm", "b_norm"], p=F.when(longest > CUT_FROM, shared_length("a_norm", "b_norm", "left")).otherwise(0))
    cut = once(cut, ["a", "b", "allowed", "near"], a_rest=F.expr("substring(a_norm, p + 1)"), b_rest=F.expr("substring(b_norm, p + 1)"))
    cut = once(cut, ["a", "b", "allowed", "near", "a_rest", "b_rest"], q=F.when(F.greatest(F.char_length("a_rest"), F.char_length("b_rest")) > CUT_FROM, shared_length("a_rest", "b_rest", "right")).otherwise(0))
    middle = lambda x: F.expr(f"left({x}, char_length({x}) - q)")
    cut = once(cut, ["a", "b", "allowed", "near"], a_mid=middle("a_rest"), b_mid=middle("b_rest"))
    tried = " or ".join(f"levenshtein(a_mid, b_mid, {d}) >= 0" for d in (*[f"least(allowed, {t})" for t in TRIED], "allowed"))
    return cut.where(F.expr(f"near or greatest(char_length(a_mid), char_length(b_mid)) <= allowed or {tried}")).select("a", "b")


def texts_of(nodes: DataFrame, lines: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, norm) of some of the lines: one occurrence of each is looked up in its row."""
    at = stored(attach(lines.select("node", "id0", "rk", "pos"), nodes, ["node"], "left_semi").dropDuplicates(["node"]))
    wanted = stored(at.groupBy("id0", "rk").agg(F.collect_list(F.struct("pos", "node")).alias("wanted")))
    held = once(attach(rows.select("id0", "rk", "text"), wanted, ["id0", "rk"], "inner"), ["wanted"], parts=F.split("text", "\n"))
    found = held.select("parts", F.inline("wanted")).select("node", normal_line(F.get("parts", F.col("pos"))).alias("norm"))
    return stored(found.dropDuplicates(["node"]))


def line_groups(rows: DataFrame, found_lines: DataFrame) -> DataFrame:
    """(node, node2, keep_ord) of lines that occur again, exactly or nearly; keep_ord is the occurrence that stays.

    found_lines: hashed_lines(rows), stored.
    """
    lines = stored(found_lines.groupBy("node", "node2").agg(F.min(place()).alias("first"), F.count("*").alias("n"), F.min("simhash").alias("simhash")))
    tidy(rows.sparkSession)
    posted = lines.select("node", F.col("simhash").alias("x"), F.explode(block_keys()).alias("token"))

    def check(pairs: DataFrame) -> DataFrame:
        if pairs.isEmpty():
            return pairs
        involved = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        texts = texts_of(involved, found_lines, rows)
        text = lambda x: texts.select(F.col("node").alias(x), F.col("norm").alias(f"{x}_norm")).hint("shuffle_merge")
        return stored(edit_similar(pairs.join(text("a"), "a").join(text("b"), "b")))

    _, found = group_links(posted, lambda x, y: bits_apart(x, y) <= DISTANCE, check)
    placed = lines.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    linked = placed.join(found.select("component").distinct(), "component", "left_semi")
    best = linked.groupBy("component").agg(F.min("first").alias("keep_ord"))
    near = linked.join(best, "component").select("node", "node2", "keep_ord")
    exact = lines.join(found, "node", "left_anti").where("n > 1").select("node", "node2", F.col("first").alias("keep_ord"))
    return stored(near.unionByName(exact))


def bits_apart(x: Column, y: Column) -> Column:
    return F.bit_count(x.bitwiseXOR(y))


def removed_lines(rows: DataFrame) -> DataFrame:
    """(id0, rk, gone): positions of the lines that go, for each row that loses some."""
    lines = stored(hashed_lines(rows))
    tidy(rows.sparkSession)
    groups = line_groups(rows, lines)
    tidy(rows.sparkSession)
    found = attach(lines.select("id0", "rk", "pos", place().alias("ord"), "node", "node2"), groups, ["node", "node2"], "inner")
    gone = stored(found.where("ord > keep_ord").groupBy("id0", "rk").agg(F.collect_set("pos").alias("gone")))
    tidy(rows.sparkSession)
    return gone


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, text (what is left), emptied.

    Lines end at \\\\n.  Lines of fewer than five words, blank ones among them, always stay, but for one word of 25
    characters or more and lines with ten characters or more of a script without spaces.  Of a group of equal or
    linked lines the occurrence with the smallest id, then place, stays; absent ids come last.  A null text counts
    as empty: one line, none removed.  Rows that agree in id and text are treated as one and get the same text; where
    rows share an id but not the text, equal lines at equal places of them all stay.  emptied: lines went and only
    blanks are left.  An empty table gives no rows; other columns are not read.
    """
    rows = keyed(docs, id_col, text_col)
    out = once(rows.join(removed_lines(rows), ["id0", "rk"], "left"), ["doc_id", "text", "gone"], lines=F.split("text", "\n"))
    n_removed = F.coalesce(F.array_size("gone"), F.lit(0))
    out = once(out, ["doc_id"], n_lines=F.size("lines"), n_removed=n_removed, text=what_is_left("text", "lines", "gone"))
    return out.withColumn("emptied", (F.col("n_removed") > 0) & blank("text"))


def what_is_left(text_col: str, lines_col: str, gone_col: str) -> Column:
    """The text without the lines at the given places, itself where there are none.

    lines_col holds the text's lines as a value: split inside the function over places, the text would be cut once for every line.
    """
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines_col) - 1), F.col(gone_col))
    return F.when(F.col(gone_col).isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(stay, lambda i: F.get(F.col(lines_col), i)), "\n"))


def blank(text_col: str) -> Column:
    return F.trim(F.translate(text_col, "\n\r\t\u000b\f", "")) == ""


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """docs with all its columns, without lines that occur before and without documents of which only blanks are left.

    length_col, where docs has it, becomes the length of what is left.
    """
    rows = keyed(docs, id_col, text_col)
    gone = removed_lines(rows).select(F.col("id0").alias("_line_id0"), F.col("rk").alias("_line_rk"), F.col("gone").alias("_line_gone"))
    text = text_or_empty(text_col)
    own = docs.select("*", F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("_line_id0"), row_hash(F.col(id_col).cast("long"), text).alias("_line_rk"))
    own = own.join(gone, ["_line_id0", "_line_rk"], "left")
    own = once(own, [*docs.columns, "_line_gone"], _line_parts=F.when(F.col("_line_gone").isNotNull(), F.split(text, "\n")))
    left = once(own, [*[c for c in docs.columns if c != text_col], "_line_gone"], **{text_col: what_is_left(text_col, "_line_parts", "_line_gone")})
    left = left.where(F.col("_line_gone").isNull() | ~blank(text_col))
    if length_col in docs.columns:
        length = F.char_length(text_col).cast(docs.schema[length_col].dataType)
        left = left.withColumn(length_col, F.when(F.col("_line_gone").isNull(), F.col(length_col)).otherwise(length))
    return left.select(*docs.columns)


def row_hash(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, doc_id.isNull(), text)
