"""Aligning the tokens of two tokenizers by products of sparse token-byte matrices.

A tokenizer's tokens of a text are the rows of an incidence matrix over the text's bytes, in CSR form.  The row
products of A with the transpose of B (Gustavson's order: each row of A gathers the rows of B' that its bytes name)
give the overlap links of tokens with the bytes they share.  Where tokens of both end the text is cut into
groups; the same product of the two group-token incidence matrices gives the links inside groups.

Both tokenizers work the same on a text and on its units, which begin with a space after a character that is
none: neither has a token across such a place.  So each distinct unit is tokenised and multiplied once, and a
text's results are sums over its units.  The texts are read once; their links are stored as sorted and packed pairs
of ids, in which a second step looks up the pairs' counts in the corpus.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smslens.llm.common import blocks, lists, stored

#: Pairs of ids sent to all tasks (17 bytes each); rarer ones meet the texts by a join.
PAIRS = 2_000_000
#: Bytes of units a worker remembers, counting this much for each besides its text.
KEPT_BYTES, UNIT_COST = 96 << 20, 150
#: Bytes of units that are tokenised as one string.
RUN_BYTES = 4 << 10
#: Text bytes whose matrices are multiplied at once.
ROW_BYTES = 1 << 20


@dataclass
class CSR:
    """A matrix of ones: row i has the columns indices[indptr[i]:indptr[i + 1]]."""

    indptr: np.ndarray
    indices: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1


def incidence(counts: np.ndarray) -> CSR:
    """Rows of `counts` consecutive columns each: tokens by bytes, or groups by tokens."""
    ends = np.cumsum(counts)
    return CSR(np.r_[0, ends], np.arange(int(counts.sum())), int(counts.sum()))


def transpose(m: CSR) -> CSR:
    row = np.repeat(np.arange(m.rows), np.diff(m.indptr))
    counts = np.bincount(m.indices, minlength=m.columns)
    return CSR(np.r_[0, np.cumsum(counts)], row[np.argsort(m.indices, kind="stable")], m.rows)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of the ranges starting at `starts`, one after the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


def product(a: CSR, b: CSR, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows first to last of a times b, as (row, column, value) in order.

    Every nonzero of a row of a brings in a row of b; what falls on one place is added up.
    """
    last = a.rows if last is None else last
    inner = a.indices[a.indptr[first] : a.indptr[last]]
    of = np.repeat(np.arange(first, last), np.diff(a.indptr[first : last + 1]))
    width = np.diff(b.indptr)[inner]
    row, column = np.repeat(of, width), b.indices[ranges(b.indptr[inner], width)]
    place = row * b.columns + column
    if len(place) and (np.diff(place) < 0).any():
        place = np.sort(place)
    new = np.flatnonzero(np.diff(place, prepend=-1))
    return place[new] // b.columns, place[new] % b.columns, np.diff(np.r_[new, len(place)])


def row_blocks(m: CSR, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `most` nonzeros, or one row."""
    at = 0
    while at < m.rows:
        to = max(at + 1, int(np.searchsorted(m.indptr, m.indptr[at] + most, "right")) - 1)
        yield at, to
        at = to


@dataclass
class Alignment:
    """Tokens of some texts one after the other, their links and their groups.

    a, b: ids; text_a, text_b: number of tokens of each text; link_a, link_b, shared: token places that overlap and
    in how many bytes; group_a, group_b: group of each token, counted on; exact: whether the tokens' bytes are the text.
    """

    a: np.ndarray
    b: np.ndarray
    text_a: np.ndarray
    text_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    shared: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    exact: np.ndarray

    def group_links(self, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Token places of a group in common: the product of the group-token matrices, in blocks of rows."""
        n = 1 + max(int(self.group_a.max(initial=-1)), int(self.group_b.max(initial=-1)))
        of_a = transpose(incidence(np.bincount(self.group_a, minlength=n)))
        of_b = incidence(np.bincount(self.group_b, minlength=n))
        width = np.diff(of_b.indptr)[of_a.indices]
        for first, last in row_blocks(CSR(np.r_[0, np.cumsum(width)], width, n), most):
            row, column, _ = product(of_a, of_b, first, last)
            yield row, column


class Tokenizers:
    """A byte-level tokenizer and a sentence-piece one, and the bytes of their ids."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = byte_of_letter()
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [bytes(byte[c] for c in names.get(i, "")) if all(c in byte for c in names.get(i, "")) else names[i].encode() for i in range(1 + max(names))]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece goes on across a space: texts can't be cut into units")
        self.length_a = np.array([len(t) for t in self.bytes_a])
        self.length_b = np.array([len(t) for t in self.bytes_b])

    def encoded(self, texts: list[str], runs: list[tuple[int, int]]) -> tuple[list, list, list[bool]]:
        """Ids of both tokenizers of runs of texts, each run one string, and whether their bytes are the string's."""
        runs_b = [" ".join(texts[first:last]) for first, last in runs]
        runs_a = [" " + t for t in runs_b]
        ids_a = [e.ids for e in self.a.encode_batch_fast(runs_a, add_special_tokens=False)]
        ids_b = self.b.encode(runs_b, num_threads=1)
        exact = []
        for t, x, y in zip(runs_a, ids_a, ids_b, strict=True):
            data = t.encode()
            exact.append(len(data) > 1 and b"".join(map(self.bytes_a.__getitem__, x)) == data == b"".join(map(self.bytes_b.__getitem__, y)))
        return ids_a, ids_b, exact

    def align(self, texts: list[str], units: bool = False) -> Alignment:
        """Tokens, links and groups of texts, each read after a space.  A text whose bytes the tokens don't give has none.

        units: no token crosses from one text to the next, so many are read as one string.
        """
        size = np.array([1 + len(t.encode()) for t in texts], np.int64)
        most = max(1, RUN_BYTES // max(1, int(size.max(initial=1)))) if units else 1
        runs = [(i, min(i + most, len(texts))) for i in range(0, len(texts), most)]
        ids_a, ids_b, exact = self.encoded(texts, runs)
        again = [r for r, ok in zip(runs, exact, strict=True) if not ok and r[1] - r[0] > 1]
        if again:  # some text of these is not exact: each for itself
            single = [(i, i + 1) for first, last in again for i in range(first, last)]
            by = dict(zip(single, zip(*self.encoded(texts, single), strict=True), strict=True))
            by |= {r: x for r, x in zip(runs, zip(ids_a, ids_b, exact, strict=True), strict=True) if r not in set(again)}
            runs = sorted(by)
            ids_a, ids_b, exact = zip(*[by[r] for r in runs], strict=True)
        kept = [(x, y) for x, y, ok in zip(ids_a, ids_b, exact, strict=True) if ok]
        whole = np.zeros(len(texts), bool)
        for (first, last), ok in zip(runs, exact, strict=True):
            whole[first:last] = ok
        a, b = (np.array(list(chain.from_iterable(k[side] for k in kept)), np.int64) for side in (0, 1))
        width_a, width_b = self.length_a[a], self.length_b[b]
        end_a, end_b, end_text = np.cumsum(width_a), np.cumsum(width_b), np.cumsum(np.where(whole, size, 0))
        text_a, text_b = (np.bincount(np.searchsorted(end_text, end), minlength=len(texts)) for end in (end_a, end_b))
        by_byte, to_tokens = incidence(width_a), transpose(incidence(width_b))
        parts = [product(by_byte, to_tokens, *r) for r in row_blocks(by_byte, ROW_BYTES)] or [product(by_byte, to_tokens)]
        link_a, link_b, shared = (np.concatenate([p[k] for p in parts]) for k in range(3))
        cuts = end_a[end_b[np.searchsorted(end_b, end_a)] == end_a] if len(a) else end_a
        group_a, group_b = (np.searchsorted(cuts, end - width, "right") for end, width in ((end_a, width_a), (end_b, width_b)))
        return Alignment(a, b, text_a, text_b, link_a, link_b, shared, group_a, group_b, whole)


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: visible Latin-1 characters for themselves, the
    others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def closes(text: str) -> bool:
    """Whether a unit may end here: the last character is surely no white space and no mark of a space."""
    c = ord(text[-1]) if text else 0
    return 0x21 <= c <= 0x7E or 0xC0 <= c <= 0x7FF or 0x900 <= c <= 0xFFF or 0x3041 <= c <= 0xD7FF


def units_of(parts: list[str]) -> list[str]:
    """Units, without their leading space, from a text's parts between spaces."""
    out, unit = [], parts[0]
    for p in parts[1:]:
        if p and p[0] > " " and closes(unit):
            out.append(unit)
            unit = p
        else:
            unit = f"{unit} {p}"
    return [*out, unit]


class Units:
    """The units a worker has met: numbers, and for each the tokens' counts, pairs of ids and groups as text."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        ids = [str(i) for i in range(max(len(tokenizers.bytes_a), len(tokenizers.bytes_b)))]
        self.digits = np.array([len(i) for i in ids])
        self.decimal = [(mark + i).encode() for mark in ",;|" for i in ids]
        self.clear()

    def clear(self) -> None:
        self.parts: dict[str, int] = {}  # that are units wherever they stand
        self.others: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.numbers = np.zeros((0, 6), np.int64)  # exact, n_a, n_b, n_groups, n_links, n_shared
        self.keys, self.times, self.first = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.size = 0

    def numbered(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The units of each text (none for a null or empty one) as one array, and how many each text has."""
        if self.size > KEPT_BYTES:
            self.clear()
        split = [t.split(" ") if t else [] for t in texts]
        found = [list(map(self.parts.get, parts, repeat(-1))) for parts in split]
        open_ = [i for i, f in enumerate(found) if -1 in f]
        new = set().union(*(split[i] for i in open_)).difference(self.parts)
        self.add(self.parts, sorted([p for p in new if p and p[0] > " " and closes(p)], key=len), True)
        for i in open_:
            found[i] = list(map(self.parts.get, split[i], repeat(-1)))
        glued = {i: units_of(split[i]) for i in open_ if -1 in found[i]}
        self.add(self.others, sorted({u for units in glued.values() for u in units if u not in self.parts and u not in self.others}), False)
        for i, units in glued.items():
            found[i] = [self.parts[u] if u in self.parts else self.others[u] for u in units]
        counts = np.array([len(f) for f in found], np.int64)
        return np.array(list(chain.from_iterable(found)), np.int64), counts

    def add(self, known: dict[str, int], units: list[str], alike: bool) -> None:
        if not units:
            return
        start = len(self.groups)
        known.update({u: start + k for k, u in enumerate(units)})
        al = self.tokenizers.align(units, alike)
        n = len(units)
        of_a, of_b = np.repeat(np.arange(n), al.text_a), np.repeat(np.arange(n), al.text_b)
        n_groups = 1 + int(al.group_a.max(initial=-1))
        in_a, in_b = np.bincount(al.group_a, minlength=n_groups), np.bincount(al.group_b, minlength=n_groups)
        of_group = np.zeros(n_groups, np.int64)
        of_group[al.group_a] = of_a
        link_of = of_a[al.link_a]
        per = lambda of, weights=None: np.bincount(of, weights, n).astype(np.int64)
        numbers = np.stack([al.exact.astype(np.int64), al.text_a, al.text_b, per(of_group), per(link_of), per(of_group, in_a * in_b)], 1)
        key = (al.a[al.link_a] << 32) | al.b[al.link_b]
        order = np.lexsort((key, link_of))
        key, link_of = key[order], link_of[order]
        new = np.flatnonzero((np.diff(key, prepend=-1) != 0) | (np.diff(link_of, prepend=-1) != 0))
        self.numbers = np.concatenate([self.numbers, numbers])
        self.keys = np.r_[self.keys, key[new]]
        self.times = np.r_[self.times, np.diff(np.r_[new, len(key)])]
        self.first = np.r_[self.first, self.first[-1] + np.cumsum(np.bincount(link_of[new], minlength=n))]
        self.groups += self.written(al, of_a, of_b, n)
        self.size += sum(map(len, units)) * 4 + UNIT_COST * n

    def written(self, al: Alignment, of_a: np.ndarray, of_b: np.ndarray, n: int) -> list[bytes]:
        """Each unit's groups as `a,a|b;a|b,b`."""
        new_a, new_b = np.diff(al.group_a, prepend=-1) != 0, np.diff(al.group_b, prepend=-1) != 0
        ids = np.r_[al.a, al.b]
        kind = np.r_[np.where(new_a, 1, 0), np.where(new_b, 2, 0)]
        order = np.lexsort((np.r_[np.zeros(len(al.a)), np.ones(len(al.b))], np.r_[al.group_a, al.group_b]))
        ids, kind, of = ids[order], kind[order], np.r_[of_a, of_b][order]
        joined = b"".join(map(self.decimal.__getitem__, (kind * len(self.digits) + ids).tolist()))
        ends = np.cumsum(np.bincount(of, self.digits[ids] + 1, n)).astype(np.int64).tolist()
        return [joined[s + 1 : e] for s, e in zip([0, *ends[:-1]], ends, strict=True)]


KNOWN: dict[tuple[str, str], Units] = {}


def known_units(path_a: str, path_b: str) -> Units:
    """The worker's units, kept from task to task."""
    if (path_a, path_b) not in KNOWN:
        KNOWN[path_a, path_b] = Units(Tokenizers(path_a, path_b))
    return KNOWN[path_a, path_b]


def run_sums(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows, `counts` rows each."""
    sums = np.concatenate([np.zeros((1, rows.shape[1]), rows.dtype), np.cumsum(rows, axis=0)])
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]


def text_totals(units: Units, unit: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the units' numbers of each text, and whether the text has tokens at all: all its units are exact."""
    sums = run_sums(units.numbers[unit], counts)
    exact = (counts > 0) & (sums[:, 0] == counts)
    return np.where(exact[:, None], sums, 0), exact


def packed(keys: np.ndarray) -> bytes:
    """Ascending keys as compressed differences, byte place by byte place."""
    return zstandard.compress(np.diff(keys, prepend=0).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i8").ravel())


#: What the first pass gives: a document's results and links, or some counted pairs of a task.
FIELDS = ["doc_id long", "n_a long", "n_b long", "n_groups long", "n_links long", "n_shared long", "groups_sha256 string", "links binary", "pairs array<struct<key:long,links:long>>"]
NAMES = [f.split(" ")[0] for f in FIELDS]
PAIR = pa.list_(pa.struct([("key", pa.int64()), ("links", pa.int64())]))
#: Packed links looked up at once.
PACKED_BYTES = 1 << 19
#: Counted pairs in one row.
PAIR_ROWS = 10_000


def measured(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The first pass over docs (doc_id, text): FIELDS, with links where the row is a document's and pairs where it is not."""

    def counted(units: Units, seen: np.ndarray) -> Iterator[pa.RecordBatch]:
        of = np.repeat(np.arange(len(seen)), np.diff(units.first[: len(seen) + 1]))
        key, at = np.unique(units.keys[: len(of)], return_inverse=True)
        n = np.zeros(len(key), np.int64)
        np.add.at(n, at, units.times[: len(of)] * seen[of])
        key, n = key[n > 0], n[n > 0]
        for k in range(0, len(key), PAIR_ROWS):
            part = pa.StructArray.from_arrays([pa.array(key[k : k + PAIR_ROWS]), pa.array(n[k : k + PAIR_ROWS])], ["key", "links"])
            pairs = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part).cast(PAIR)
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, pa.int64()) for _ in range(6)), pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), pairs], NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = known_units(path_a, path_b)
        seen = np.zeros(0, np.int64)
        for batch in batches:
            for block in blocks(batch.column(1)):
                if units.size > KEPT_BYTES:  # they are about to be forgotten
                    yield from counted(units, seen)
                    seen = np.zeros(0, np.int64)
                unit, counts = units.numbered(batch.column(1).slice(block.first, block.size).to_pylist())
                totals, exact = text_totals(units, unit, counts)
                unit, counts = unit[np.repeat(exact, counts)], np.where(exact, counts, 0)
                seen = np.r_[seen, np.zeros(len(units.groups) - len(seen), np.int64)]
                seen += np.bincount(unit, minlength=len(seen))
                width = units.first[unit + 1] - units.first[unit]
                at = ranges(units.first[unit], width)
                key = np.repeat(units.keys[at], units.times[at])
                of = np.repeat(np.arange(len(counts)), totals[:, 4])
                key = key[np.lexsort((key, of))]
                cut = np.r_[0, np.cumsum(totals[:, 4])].tolist()
                links = [packed(key[s:e]) for s, e in zip(cut, cut[1:], strict=False)]
                ends = np.cumsum(counts).tolist()
                mine = [unit[e - n : e].tolist() for e, n in zip(ends, counts.tolist(), strict=True)]
                digest = [hashlib.sha256(b";".join(map(units.groups.__getitem__, m))).hexdigest() if m else "" for m in mine]
                numbers = [pa.array(np.ascontiguousarray(totals[:, k])) for k in range(1, 6)]
                n = len(counts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, n), *numbers, pa.array(digest, pa.string()), pa.array(links, pa.binary()), pa.nulls(n, PAIR)], NAMES)
        yield from counted(units, seen)

    return stored(docs.mapInArrow(run, ", ".join(FIELDS)))


def counted_pairs(found: DataFrame) -> DataFrame:
    pairs = found.where("pairs is not null").select(F.inline("pairs")).groupBy("key").agg(F.sum("links").alias("links"))
    counted = stored(pairs.select(F.expr("shiftright(key, 32)").alias("a_id"), F.expr("key & 4294967295").alias("b_id"), "links"))
    most = counted.groupBy("b_id").agg(F.max("links").alias("most"))  # one row for each id of a vocabulary
    return stored(counted.join(F.broadcast(most), "b_id").select("a_id", "b_id", "links", (F.col("links") == F.col("most")).alias("best")))


def pair_counts(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text") -> DataFrame:
    """(a_id, b_id, links, best): how many links of all texts hold a pair of ids, and whether none of its b id has more.

    Texts that are null or empty, or whose bytes the tokens don't give, have no links.  Repeated rows count each time.
    An empty table has no pairs.
    """
    return counted_pairs(measured(docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text_col).alias("text")), path_a, path_b))


def frequent_pairs(counted: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Keys, counts and marks of the pairs of the highest counts, at most `most`, and whether these are all."""
    level = F.floor(F.log2("links"))
    levels = {r.level: r.pairs for r in counted.groupBy(level.alias("level")).agg(F.count("*").alias("pairs")).collect()}
    least, room = 64, most
    for k in sorted(levels, reverse=True):
        if levels[k] > room:
            break
        least, room = k, room - levels[k]
    found = counted.where(level >= least).select(F.expr("shiftleft(a_id, 32) | b_id").alias("key"), "links", "best").toPandas().sort_values("key")
    return found["key"].to_numpy("int64"), found["links"].to_numpy("int64"), found["best"].to_numpy(bool), min(levels, default=64) >= least


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", pairs: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_shared.

    A reads a space and the text, B the text.  Null and empty texts, and texts whose joined token bytes of A or B are
    not a space and the text, have no tokens: zeros and ''.  n_links counts overlaps, n_shared the token pairs of a
    group, count_sum adds each link's count in the corpus, n_best counts links whose count is the highest of their
    B id, ties included.  groups_sha256 hashes the ids by group.  Null and repeated ids are rows of their own; a
    repeated row counts each time.  An empty table gives no rows.  Other columns are not read.
    """
    found = measured(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), path_a, path_b)
    counted = counted_pairs(found)
    *table, complete = frequent_pairs(counted, PAIRS if pairs is None else pairs)
    sent = docs.sparkSession.sparkContext.broadcast(tuple(table))
    whole = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, links, best = sent.value
        for part in (b.slice(x.first, x.size) for b in batches for x in blocks(b.column(len(whole)), PACKED_BYTES)):
            keys = [unpacked(d) for d in part.column(len(whole)).to_pylist()]
            key, n = np.concatenate(keys) if keys else np.zeros(0, np.int64), np.array([len(k) for k in keys], np.int64)
            at = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
            there = known[at] == key if len(known) else np.zeros(len(key), bool)
            costs = np.zeros((len(key), 2), np.int64)
            costs[there] = np.stack([best[at[there]], links[at[there]]], 1)
            sums = run_sums(costs, n)
            rare = lists(key[~there], run_sums((~there)[:, None].astype(np.int64), n)[:, 0], pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns[: len(whole)], pa.array(np.ascontiguousarray(sums[:, 0])), pa.array(np.ascontiguousarray(sums[:, 1])), rare], [*whole, "n_best", "count_sum", "rare"])

    rows = found.where("links is not null").select(*whole, "links")
    priced = rows.mapInArrow(run, ", ".join([*FIELDS[: len(whole)], "n_best long, count_sum long, rare array<long>"]))
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"]
    if complete:
        return priced.select(*out)
    priced = stored(priced.withColumn("row", F.monotonically_increasing_id()))
    rare = priced.select("row", F.explode("rare").alias("key")).groupBy("row", "key").agg(F.count("*").alias("n"))
    rare = rare.join(counted.select(F.expr("shiftleft(a_id, 32) | b_id").alias("key"), "links", "best"), "key")
    more = rare.groupBy("row").agg(F.sum(F.col("n") * F.col("links")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("more_best"))
    added = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
    priced = priced.join(more, "row", "left")
    return priced.withColumns({c: added(c, m) for c, m in (("n_best", "more_best"), ("count_sum", "more_sum"))}).select(*out)
