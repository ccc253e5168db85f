"""Line dedup by an exact set-similarity join.

A line is the set of its words (A-Z lower-cased, by white space).  Words are
ordered by rarity: a level of their count over all documents, in a table of
fixed size that hashes words to 2^18 slots, then their hash (any fixed order
keeps the join exact; rare words first keeps groups small).  A line that can
reach the similarity with another shares a word of its prefix with it.  Prefix
words are dealt out by hash; within a word, sets are compared by length,
position and odd sketches, which differ in at most as many bits as the sets in
words.  What passes is verified on the full sets.

A word whose slot counts more than ``HOT`` occurrences does not make a group.
Two linked sets with no rarer word in common share two such words, if each
prefix is one word longer, so pairs of them make the groups.

A line goes if an earlier line, in order of document id, hash of the text and
line number, is equal as a set or similar enough.  One earlier line is enough,
so pairs are not listed in full: a set meets the ``FIRST_MET`` earliest sets of
a group that pass, and only sets that do not match these meet ever more of
their group, until they have met all earlier ones.

Equal lines are found by a 96-bit hash of the set.  Of equal lines in one
buffer of a task only the earliest is shuffled; the others are lost for
certain.

Lines without words always stay; null texts have no lines and stay null; null
ids come first; rows equal in id and text are one document and get the same
result.  Long texts and long lines are compared whole.  An empty table gives an
empty result.  Other columns, whatever their names, are left as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_rows
from .jaccard_join import Similarity, confirmed
from .kernels import LOWER, SPACE, U, let_go, mix64, span_hashes, spans, text_chunks
from .scratch import discard, small, stored

SLOTS, PARTS = 1 << 18, 64
SIM = Similarity(4, 5, 1)
#: Occurrences beyond which a word is split by a second word.
HOT = 1 << 16
#: Sets of a group that a set meets at first, and how many times as many in each further round.
FIRST_MET, MORE_MET = 2, 32
#: Bytes of records that a task gathers before it deals them out, and that a part should hold.
BUFFER_BYTES, PART_BYTES = 8 << 20, 16 << 20

#: The 96-bit hash of a set.
KEY = np.dtype([("a", "<u8"), ("b", "<u4")])
#: A prefix word of a set: the word (or pair of words), the set (a, b), its size, place in the prefix, first document
#: (in the order of ids, as a number of 24 bits), and sketch of 128 bits.
TOKEN = np.dtype([("word", "<u4"), ("a", "<u8"), ("b", "<u4"), ("n", "<u4"), ("at", "<u2"), ("doc", "<u4"), ("sketch", "<u8", (2,))])
#: An occurrence of a set (a, b): whether the document has an id, the id, hash of the text, and line number.
SPOT = np.dtype([("a", "<u8"), ("b", "<u4"), ("named", "?"), ("doc_id", "<i8"), ("mark", "<i8"), ("at", "<u4")])
_DEALT = "part int, kind byte, records binary"
#: Rows of the join: 0 a candidate pair, 1 the first place of a set, 2 a lost line, 3 a set that has more to meet, 4 its group.
_FOUND = "kind byte, part int, key binary, other binary, doc_id long, mark long, at int, records binary"
_FOUND_TYPES = {"part": pa.int32(), "key": pa.binary(), "other": pa.binary(), "doc_id": pa.int64(), "mark": pa.int64(), "at": pa.int32(), "records": pa.binary()}


def line_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, the line of each word (counted over the chunk), and the first line of each row."""
    feeds = np.flatnonzero(data == 10)
    starts, ends = spans(~SPACE[data], offsets[1:-1])
    # Lines before a byte: line feeds before it, and one more for each row begun.
    line = np.searchsorted(feeds, starts) + np.searchsorted(offsets, starts, "right") - 1
    first = np.searchsorted(feeds, offsets[:-1]) + np.arange(len(offsets) - 1)
    return span_hashes(LOWER[data], starts, ends), line, first


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    table = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column(0)):
            starts, ends = spans(~SPACE[data], offsets[1:-1])
            table += np.bincount(span_hashes(LOWER[data], starts, ends) & U(SLOTS - 1), minlength=SLOTS)
    counts = [np.minimum(x, 0xFFFFFFFF).astype("<u4").tobytes() for x in np.split(table, PARTS)]
    yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(counts, pa.binary())], ["part", "counts"])


def _sum(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            got = np.frombuffer(counts, "<u4").astype(np.int64)
            total[part] = total[part] + got if part in total else got
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["part", "counts"])


def rarity(rows: DataFrame) -> np.ndarray:
    """Counts of the hashed words of the column ``text``: 2 MB whatever the input."""
    summed = rows.select("text").mapInArrow(_count, "part int, counts binary").repartition(PARTS, "part").mapInArrow(_sum, "part int, counts binary").collect()
    parts = {r["part"]: np.frombuffer(r["counts"], np.int64) for r in summed}
    return np.concatenate([parts.get(k, np.zeros(SLOTS // PARTS, np.int64)) for k in range(PARTS)])


def count_levels(counts: np.ndarray) -> np.ndarray:
    """One byte per slot, in order of the counts; hot slots have the highest levels."""
    level = np.round(4 * np.log2(counts + 1)).astype(np.int64)
    return np.where(counts > HOT, np.clip(level, 128, 255), np.minimum(level, 127)).astype(np.uint8)


def ordered_sets(words: np.ndarray, line: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words by line, level and hash, where lines start, and which lines they are."""
    level = levels[(words & U(SLOTS - 1)).astype(np.int64)].astype(U)
    order = None
    if not len(line) or line[-1] < 1 << 20:  # one sort of line, level and the high bits of the hash
        rank = line.astype(U) << U(44) | level << U(36) | words >> U(28)
        order = np.argsort(rank)
        sorted_rank, sorted_words = rank[order], words[order]
        if np.any((sorted_rank[1:] == sorted_rank[:-1]) & (sorted_words[1:] != sorted_words[:-1])):
            order = None
    if order is None:
        order = np.lexsort((words, level, line))
    words, line = words[order], line[order]
    fresh = np.ones(len(words), bool)
    fresh[1:] = (words[1:] != words[:-1]) | (line[1:] != line[:-1])
    words, line = words[fresh], line[fresh]
    starts = np.flatnonzero(np.append(True, line[1:] != line[:-1])) if len(line) else np.zeros(0, np.int64)
    return words, starts, line[starts]


def set_keys(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of each set."""
    keys = np.zeros(len(starts), KEY)
    if len(starts):
        mixed = mix64(words)
        keys["a"] = mix64(np.add.reduceat(mixed, starts) ^ sizes.astype(U))
        keys["b"] = (mix64(np.add.reduceat(mix64(mixed + U(0x51)), starts) + sizes.astype(U)) >> U(32)).astype(np.uint32)
    return keys


def _key(records: np.ndarray) -> np.ndarray:
    """The sets of records as strings of 12 bytes, which compare fast."""
    keys = np.empty(len(records), KEY)
    keys["a"], keys["b"] = records["a"], records["b"]
    return keys.view("S12")


def _places_in_order(spots: np.ndarray) -> np.ndarray:
    """Distinct occurrences by set and place; rows equal in id and text are one document."""
    spots = spots[np.lexsort([spots[f] for f in reversed(SPOT.names)])]
    return spots[np.append(True, spots[1:] != spots[:-1])] if len(spots) else spots


def _fresh(records: np.ndarray) -> np.ndarray:
    """Which sorted records are the first of their set."""
    first = np.ones(len(records), bool)
    first[1:] = (records["a"][1:] != records["a"][:-1]) | (records["b"][1:] != records["b"][:-1])
    return first


def _parts(high: np.ndarray, parts: int) -> np.ndarray:
    """The part of each hash, by its high half."""
    return (((high >> U(32)) * U(parts)) >> U(32)).astype(np.int64)


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def prefix_tokens(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray, docs: np.ndarray, sketches: np.ndarray, levels: np.ndarray, sim: Similarity, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The prefix words of the sets as records of ``TOKEN``, and the part of each."""
    least = -(-sizes * sim.num // sim.den)  # words that a set shares with any set it links with
    prefix = sizes - least + 1
    longer = np.minimum(prefix + 1, sizes)
    owner = np.repeat(np.arange(len(sizes)), longer)
    at = _ranges(np.zeros(len(sizes), np.int64), longer)
    token = words[starts[owner] + at]
    hot = levels[(token & U(SLOTS - 1)).astype(np.int64)] >= 128
    single = (at < prefix[owner]) & (~hot | (least[owner] < 2))
    found = [(owner[single], at[single], mix64(token[single]))]
    of, place, word = owner[hot], at[hot], token[hot]
    gap = 1
    while gap < len(of) and np.any(same := of[gap:] == of[:-gap]):  # pairs of the hot words of a set
        first = np.flatnonzero(same)
        found.append((of[first], place[first], mix64(word[first] * U(31) + word[first + gap])))
        gap += 1
    owner, at, word = (np.concatenate(x) for x in zip(*found))
    records = np.zeros(len(owner), TOKEN)
    records["word"], records["a"], records["b"], records["n"] = word.astype(np.uint32), keys["a"][owner], keys["b"][owner], sizes[owner]
    records["at"], records["doc"], records["sketch"] = np.minimum(at, 0xFFFF), docs[owner], sketches[owner]  # a place too low only prunes less
    return records, _parts(word, parts)


class _Buffer:
    """Records of one task, dealt out by part."""

    def __init__(self, parts: int, own: int) -> None:
        self.parts, self.own, self.tokens, self.spots, self.bytes = parts, own % parts, [], [], 0

    def add(self, tokens: tuple[np.ndarray, np.ndarray], spots: np.ndarray) -> None:
        self.tokens.append(tokens)
        self.spots.append(spots)
        self.bytes += tokens[0].nbytes + spots.nbytes

    def dealt(self) -> Iterator[pa.RecordBatch]:
        if not self.spots:
            return
        tokens, part = (np.concatenate(x) for x in zip(*self.tokens))
        spots = _places_in_order(np.concatenate(self.spots))
        first = _fresh(spots)
        rows = [*self._cut(tokens, part, 0), *self._cut(spots[first], _parts(spots["a"][first], self.parts), 1)]
        if not first.all():
            rows.append((self.own, 2, spots[~first].tobytes()))
        part, kind, records = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int8()), pa.array(records, pa.binary())], ["part", "kind", "records"])
        self.tokens, self.spots, self.bytes = [], [], 0

    @staticmethod
    def _cut(records: np.ndarray, part: np.ndarray, kind: int) -> Iterator[tuple[int, int, bytes]]:
        order = np.argsort(part, kind="stable")
        records, part = records[order], part[order]
        edges = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
        for a, b in zip(edges, np.append(edges[1:], len(part))):
            yield int(part[a]), kind, records[a:b].tobytes()


def _codes(ids: np.ndarray, named: np.ndarray, least: int, most: int) -> np.ndarray:
    """Numbers of 24 bits in the order of the ids, null first; near ids may share one."""
    share = (ids.astype(np.float64) - float(least)) / max(1.0, float(most) - float(least))
    return np.where(named, 1 + (np.clip(share, 0, 1) * 0xFFFFF0).astype(np.int64), 0)


def _emit(levels: np.ndarray, sim: Similarity, parts: int, ends: tuple[int, int]) -> Callable:
    """From ``doc_id, text, mark`` the records of all lines, by part; ``ends``: the least and the greatest id."""

    def chunk(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, named: np.ndarray, marks: np.ndarray) -> tuple | None:
        words, line, first_line = line_words(data, offsets)
        words, starts, lines = ordered_sets(words, line, levels)
        if not len(starts):
            return None
        sizes = np.diff(np.append(starts, len(words)))
        keys = set_keys(words, starts, sizes)
        row = np.searchsorted(first_line, lines, "right") - 1
        spots = np.zeros(len(keys), SPOT)
        spots["a"], spots["b"], spots["named"], spots["doc_id"], spots["mark"], spots["at"] = keys["a"], keys["b"], named[row], ids[row], marks[row], lines - first_line[row]
        docs = _codes(spots["doc_id"], spots["named"], *ends)
        order = np.lexsort((docs, keys["b"], keys["a"]))
        once = order[_fresh(keys[order])]
        pick = once[sizes[once] * sim.den // sim.num > sizes[once]]  # smaller sets meet only their equals
        bit = mix64(words) >> U(57)
        halves = [np.where(bit >> U(6) == U(half), U(1) << (bit & U(63)), U(0)) for half in (0, 1)]
        sketches = np.stack([np.bitwise_xor.reduceat(x, starts) for x in halves], axis=1)
        return prefix_tokens(words, starts[pick], sizes[pick], keys[pick], docs[pick], sketches[pick], levels, sim, parts), spots

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        let_go()
        buffer = _Buffer(parts, TaskContext.get().partitionId())
        for batch in batches:
            ids, marks = batch.column(0), batch.column(2).to_numpy(zero_copy_only=False)
            named = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for a, b, data, offsets in text_chunks(batch.column(1)):
                if found := chunk(data, offsets, ids[a:b], named[a:b], marks[a:b]):
                    buffer.add(*found)
                if buffer.bytes > BUFFER_BYTES:
                    yield from buffer.dealt()
        yield from buffer.dealt()

    return run


class _Groups:
    """The tokens of one part, each set once a word, sorted by word, band of sizes, and first document.

    Bands are so wide that sets which can link are in one band or in
    neighbouring ones.
    """

    def __init__(self, records: np.ndarray, sim: Similarity) -> None:
        width = np.log(1.001 * sim.den / sim.num)
        band = (np.log(np.maximum(records["n"], 1)) / width).astype(U) + U(1)
        rank = records["word"].astype(U) << U(32) | np.minimum(band, 254) << U(24) | records["doc"]
        order = np.lexsort((rank, records["a"]))
        a, b, word = records["a"][order], records["b"][order], rank[order] >> U(32)
        fresh = np.ones(len(order), bool)  # of a set's tokens of one word, that of the first document
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (word[1:] != word[:-1])
        order = order[fresh]
        order = order[np.argsort(rank[order])]
        self.records, self.rank, self.sim = records[order], rank[order], sim
        self.n = self.records["n"].astype(np.int64)
        self.ahead = self.n - self.records["at"]  # words from the token on
        self.sketch = [np.ascontiguousarray(self.records["sketch"][:, half]) for half in (0, 1)]

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether sets of one word may link, by size, by what can be shared from it on, and by sketches."""
        num, den, n = self.sim.num, self.sim.den, self.n
        ok = (n[i] * den >= n[j] * num) & (n[j] * den >= n[i] * num)
        at = np.flatnonzero(ok)
        i, j = i[at], j[at]
        both = n[i] + n[j]
        fits = np.minimum(self.ahead[i], self.ahead[j]) * (num + den) >= both * num
        differ = sum(np.bitwise_count(half[i] ^ half[j]).astype(np.int64) for half in self.sketch)
        ok[at] = fits & (differ * (num + den) <= both * (den - num))
        return ok

    def meet(self, most: int, sets: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs that may link, of each set (or of ``sets``) with the ``most`` earliest ones; and which have more to meet.

        Sets whose first documents share a number meet either way.
        """
        every = np.arange(len(self.n)) if sets is None else np.flatnonzero(np.isin(_key(self.records), sets))
        met, pairs, cut = np.zeros(len(self.n), np.int64), [], np.zeros(len(self.n), bool)
        for shift in (0, -1, 1):  # the set's own band, then its neighbours
            band = (self.rank >> U(24)).astype(np.int64) + shift
            begin = np.searchsorted(self.rank, (band[every] << 24).astype(U), "left")
            end = np.searchsorted(self.rank, (band[every] << 24).astype(U) | self.records["doc"][every], "right")
            active, at, end = every[begin < end], begin[begin < end], end[begin < end]
            while len(active):
                full = met[active] >= most
                cut[active[full]] = True
                active, at, end = active[~full], at[~full], end[~full]
                ok = self.near(active, at) & (active != at)
                pairs.append((active[ok], at[ok]))
                met[active[ok]] += 1
                at = at + 1
                more = at < end
                active, at, end = active[more], at[more], end[more]
        return *self._joined(pairs), cut

    @staticmethod
    def _joined(pairs: list) -> tuple[np.ndarray, np.ndarray]:
        if not pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])

    def rows(self, part: int, one: np.ndarray, two: np.ndarray, cut: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows of kind 0, 3 and 4."""
        for a in range(0, len(one), 200_000):
            keys = [_key(self.records[x[a : a + 200_000]]) for x in (one, two)]
            pair = _pairs(*keys)
            yield _found(0, len(pair), key=_binary(pair[:, 0]), other=_binary(pair[:, 1]))
        if cut.any():
            probes = np.unique(_key(self.records[cut]))
            yield _found(3, len(probes), part=pa.array(np.full(len(probes), part, np.int32)), key=_binary(probes))
            group = self.records[np.isin(self.records["word"], np.unique(self.records["word"][cut]))]
            yield _found(4, 1, part=pa.array([part], pa.int32()), records=pa.array([group.tobytes()], pa.binary()))


def _pairs(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Pairs of different sets."""
    differ = one != two
    return np.stack([one[differ], two[differ]], axis=1)


def _binary(keys: np.ndarray) -> pa.Array:
    """Sets as an Arrow column."""
    ends = np.arange(len(keys) + 1, dtype=np.int32) * 12
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(keys).tobytes())])


def _found(kind: int, count: int, **given: pa.Array) -> pa.RecordBatch:
    arrays = [pa.array(np.full(count, kind, np.int8)), *(given.get(name, pa.nulls(count, t)) for name, t in _FOUND_TYPES.items())]
    return pa.RecordBatch.from_arrays(arrays, ["kind", *_FOUND_TYPES])


def _places(kind: int, spots: np.ndarray) -> pa.RecordBatch:
    return _found(kind, len(spots), key=_binary(_key(spots)), doc_id=pa.array(spots["doc_id"], mask=~spots["named"]), mark=pa.array(np.ascontiguousarray(spots["mark"])), at=pa.array(spots["at"].astype(np.int32)))


def _join(sim: Similarity) -> Callable:
    """From all records of a part the rows of ``_FOUND``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        tokens: dict[int, list[bytes]] = {}
        spots: list[bytes] = []
        for batch in batches:
            for part, kind, records in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    tokens.setdefault(part, []).append(records)
                elif kind == 1:
                    spots.append(records)
                else:
                    yield _places(2, np.frombuffer(records, SPOT))
        for part in sorted(tokens):
            groups = _Groups(np.frombuffer(b"".join(tokens.pop(part)), TOKEN), sim)
            yield from groups.rows(part, *groups.meet(FIRST_MET))
            del groups
        places = _places_in_order(np.frombuffer(b"".join(spots), SPOT))
        first = _fresh(places)
        for kind, chosen in ((1, places[first]), (2, places[~first])):
            for a in range(0, len(chosen), 100_000):
                yield _places(kind, chosen[a : a + 100_000])

    return run


def _meet_more(sim: Similarity, most: int) -> Callable:
    """From ``part, records, probes`` the rows of ``_FOUND`` of the next round."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, records, probes in zip(*(c.to_pylist() for c in batch.columns)):
                groups = _Groups(np.frombuffer(records, TOKEN), sim)
                yield from groups.rows(part, *groups.meet(most, np.frombuffer(b"".join(probes), "S12")))

    return run


def _sets() -> Callable:
    """From ``text, ask`` (line numbers) the sets of these lines."""
    flat = np.zeros(SLOTS, np.uint8)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            wanted = batch.column(1)
            for row, _, data, offsets in text_chunks(batch.column(0)):
                words, line, first = line_words(data, offsets)
                words, starts, lines = ordered_sets(words, line, flat)
                sizes = np.diff(np.append(starts, len(words)))
                keys = set_keys(words, starts, sizes)
                ask = np.concatenate([np.array(wanted[row + i].as_py(), np.int64) + f for i, f in enumerate(first)]) if len(first) else np.zeros(0, np.int64)
                pick = np.flatnonzero(np.isin(lines, ask))
                for a in range(0, len(pick), 1000):
                    p = pick[a : a + 1000]
                    ends = np.append(0, np.cumsum(sizes[p])).astype(np.int32)
                    own = words[_ranges(starts[p], sizes[p])]
                    yield pa.RecordBatch.from_arrays([_binary(_key(keys[p])), pa.ListArray.from_arrays(pa.array(ends), pa.array(own.view(np.int64)))], ["key", "shingles"])

    return run


def _later(rows: DataFrame, firsts: DataFrame, pairs: DataFrame, sim: Similarity) -> DataFrame:
    """The later set of each pair that links: ``key``."""
    pairs = stored(pairs.select(F.col("key").alias("a"), F.col("other").alias("b")).distinct(), "pairs")
    keys = stored(pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct(), "keys")
    order = stored(firsts.join(small(keys), "key", "left_semi").select("key", F.struct("doc_id", "mark", "at").alias("first")), "order")
    spots = stored(order.groupBy(F.col("first.doc_id").alias("d"), F.col("first.mark").alias("m")).agg(F.collect_set(F.col("first.at")).alias("ask")), "spots")
    asked = rows.join(small(spots), (F.col("mark") == F.col("m")) & F.col("doc_id").eqNullSafe(F.col("d")))
    sets = stored(asked.select("text", "ask").mapInArrow(_sets(), "key binary, shingles array<long>"), "sets", texts=True)
    if sets.count() > sets.select("key").distinct().count():  # of rows equal in id and text
        sets = stored(sets.dropDuplicates(["key"]), "sets")
    met = stored(confirmed(pairs, sets, sim), "matches")
    both = met
    for side in ("a", "b"):
        both = both.join(small(order.select(F.col("key").alias(side), F.col("first").alias("first_" + side))), side)
    later = stored(both.select(F.when(F.col("first_a") < F.col("first_b"), F.col("b")).otherwise(F.col("a")).alias("key")).distinct(), "later")
    del both, asked
    discard(rows.sparkSession, pairs, keys, order, spots, sets, met)
    return later


def removed_lines(docs: DataFrame, sim: Similarity = SIM, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document that loses lines: ``doc_id, mark`` (hash of the text), ``gone`` (line numbers from 0)."""
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("mark"))
    counts = rarity(rows)
    ends = tuple(x or 0 for x in rows.agg(F.min("doc_id"), F.max("doc_id")).first())
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(counts.sum()) * TOKEN.itemsize // 5 // PART_BYTES)
    found = stored(rows.mapInArrow(_emit(count_levels(counts), sim, parts, ends), _DEALT).repartitionById(parts, "part").mapInArrow(_join(sim), _FOUND), "lines", by="kind", texts=True)
    discard(rows.sparkSession)
    kind = lambda df, k: df.where(F.col("kind") == k)
    firsts = kind(found, 1).select("key", "doc_id", "mark", "at")
    later = _later(rows, firsts, kind(found, 0), sim)
    groups, probes, most = kind(found, 4).select("part", "records"), kind(found, 3).select("part", "key"), FIRST_MET
    while True:
        probes = stored(probes.distinct().join(later, "key", "left_anti"), "probes")
        if probes.isEmpty():
            break
        most *= MORE_MET
        asked = groups.join(probes.groupBy("part").agg(F.collect_list("key").alias("probes")), "part").select("part", "records", "probes")
        more = stored(asked.mapInArrow(_meet_more(sim, most), _FOUND), "lines", by="kind")
        later = stored(later.unionByName(_later(rows, firsts, kind(more, 0), sim)).distinct(), "later")
        probes = kind(more, 3).select("part", "key")
    similar = firsts.join(small(later), "key", "left_semi").select("doc_id", "mark", "at")
    lost = kind(found, 2).select("doc_id", "mark", "at").unionByName(similar)
    return stored(lost.groupBy("doc_id", "mark").agg(F.collect_set("at").alias("gone")), "removed")


def _lost(docs: DataFrame, sim: Similarity, text: str, key: str) -> tuple[DataFrame, Column, Column]:
    """``docs`` as the column ``row``, its lines, and those that stay."""
    gone = removed_lines(docs, sim, text, key).select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("gone").alias("_gone"))
    own = as_rows(docs)
    body = F.col("row")[text]
    met = own.join(small(gone), F.col("row")[key].cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(body) == F.col("_mark")), "left")
    lines = F.split(body, "\n")
    stay = F.when(F.col("_gone").isNull(), lines).otherwise(F.filter(lines, lambda x, i: ~F.array_contains("_gone", i)))
    return met, lines, stay


def line_report(docs: DataFrame, sim: Similarity = SIM, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_removed, kept_sha256``."""
    met, lines, stay = _lost(docs, sim, text, key)
    n = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    return met.select(
        F.col("row")[key].alias("doc_id"), F.when(F.col("row")[text].isNull(), F.lit(0)).otherwise(n).cast("long").alias("n_lines"),
        F.when(F.col("_gone").isNull(), F.lit(0)).otherwise(F.size("_gone")).cast("long").alias("n_removed"),
        F.sha2(F.coalesce(F.array_join(stay, "\n"), F.lit("")), 256).alias("kept_sha256"),
    )


def dedup_lines(docs: DataFrame, sim: Similarity = SIM, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with the later matches gone from the text."""
    met, _, stay = _lost(docs, sim, text, key)
    return met.select("row", F.array_join(stay, "\n").alias("_text")).select(*(F.col("_text").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))
