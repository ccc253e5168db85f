"""N-gram Jaccard join by PartEnum signatures, with one level of partitions.

Sets of 5-word shingles are grouped into bands of near-equal size.  For a
band, similar sets differ in at most k shingles; the domain of shingle hashes
is split into n = k + 1 + slack partitions, so similar sets agree on at least
slack + 1 partitions.  A signature is a set's content in one partition: of the
subsets of partitions that the method enumerates only those of one partition
are used, and the count of shared ones does what larger subsets would do.
Neighbouring bands meet in an instance of their own, so all pairs that can
reach the similarity share a signature.

Signatures are shuffled and sorted; only those that two sets share are kept.
Groups are then solved in two rounds, with no listing of all pairs:

0. a set that shares too few signatures of an instance with any others is
   left out of it;
1. every set is compared with one head of each of its groups, the set that
   shares the most, then heads at random, and the links found make components;
2. only sets whose groups still span components are looked at again, with
   partitions so fine that each holds one shingle: there a set may leave out
   all but its rarest shingles (1 - similarity of its size, and one), so hot
   passages bring no pairs.

Equal sets are one node throughout.  Links are confirmed on the full sets.

Null texts and texts without words have no set and link with nothing.  Short
texts are one shingle.  Long texts are compared whole.  Repeated rows are
copies; of copies equal in id and text any one stays.  An empty table gives an
empty result.  Other columns, whatever their names, are left as they are.  Sets
are named by 64-bit sums of mixed shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_rows
from .components import components
from .kernels import U, let_go, mix64, shingle_sets, text_chunks
from .scratch import fits, small, stored

#: Ratio of a band's largest to its smallest size, or more where linked sets can differ more in size.
BAND = (3, 2)
#: Bits of an odd sketch: each element flips one.  Sketches differ in at most as many bits as their sets in elements.
SKETCH = 2048
_MIXED = "c1 long, key long, meta long, extra binary"


@dataclass(frozen=True)
class Similarity:
    """Jaccard similarity of at least ``num / den`` on shingles of ``size`` words."""

    num: int = 4
    den: int = 5
    size: int = 5

    def largest(self, a: int) -> int:
        """Largest size that a set of size ``a`` can link with."""
        return a * self.den // self.num

    def differ(self, a: int, b: int) -> int:
        """Most elements that linked sets of sizes a and b do not share."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)


def band_end(low: int, sim: Similarity) -> int:
    """Largest size of the band that begins at ``low``; linked sets lie in one band or in neighbouring ones."""
    return max(low, low * BAND[0] // BAND[1], sim.largest(low))


@cache
def instances(n: int, sim: Similarity) -> tuple[tuple[int, int, int], ...]:
    """(seed, partitions, slack) of each instance that a set of size ``n`` takes part in."""
    low, band, bands = 1, 0, []
    while True:
        high = band_end(low, sim)
        bands.append((low, high))
        if n <= high:
            break
        low, band = high + 1, band + 1
    low, high = bands[-1]
    following = band_end(high + 1, sim)
    todo = [(2 * band, sim.differ(high, high))]
    if sim.largest(n) > high:
        todo.append((2 * band + 1, sim.differ(high, min(following, sim.largest(high)))))
    if band and n <= sim.largest(bands[-2][1]):
        under = bands[-2][1]
        todo.append((2 * band - 1, sim.differ(under, min(high, sim.largest(under)))))
    out = []
    for seed, k in todo:
        if k:  # else only equal sets link
            slack = max(-(-15 * k // 100), min(3 * (k + 1), 12))
            out.append((seed, k + 1 + slack, slack))
    return tuple(out)


def set_key(h: np.ndarray) -> np.uint64:
    return mix64(np.array([np.sum(mix64(h))], U) ^ U(len(h)))[0]


def signatures(h: np.ndarray, sim: Similarity) -> Iterator[tuple[np.ndarray, int, int]]:
    """Signatures of a sorted set, how many of them are to spare, and the seed, per instance."""
    mixed = mix64(h)
    for seed, parts, slack in instances(len(h), sim):
        at = ((h >> U(32)) * U(parts)) >> U(32)
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        found = at[starts]
        name = mix64(found + U(seed << 32))
        out = mix64(np.add.reduceat(mixed, starts) ^ name)
        spare = slack - (parts - len(found))
        if spare < 0:
            empty = np.setdiff1d(np.arange(parts, dtype=U), found)
            out, spare = np.append(out, mix64(mix64(empty + U(seed << 32)) + U(1))), 0
        yield out, spare, seed


def _emit(sim: Similarity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        seen: set[int] = set()
        for batch in batches:
            ids, marks = batch.column(0), batch.column(2)
            ids_np, null = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
            marks_np = marks.to_numpy(zero_copy_only=False)
            spread = mix64(marks_np.view(U) + ids_np.astype(np.int64).view(U) * U(31))
            for first, _, data, offsets in text_chunks(batch.column(1)):
                sigs, owners, metas, docs, extras = [], [], [], [], []
                for i, h in enumerate(shingle_sets(data, offsets, sim.size), first):
                    n, key = len(h), set_key(h) if len(h) else U(0)
                    docs.append((spread[i], key, n))
                    extras.append(np.int64(ids_np[i]).tobytes() + np.int64(marks_np[i]).tobytes() + (b"\x01" if null[i] else b""))
                    if not n or int(key) in seen:
                        continue
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(int(key))
                    for out, spare, seed in signatures(h, sim):
                        sigs.append(out)
                        owners.append(np.full(len(out), key, U))
                        metas.append(np.full(len(out), n | min(spare, 4095) << 32 | seed << 44, np.int64))
                d = np.array([x[:2] for x in docs], U).reshape(-1, 2)
                c1 = np.concatenate([*sigs, d[:, 0]]).view(np.int64)
                key = np.concatenate([*owners, d[:, 1]]).view(np.int64)
                meta = np.concatenate([*metas, np.array([x[2] for x in docs], np.int64)])
                extra = pa.array([None] * (len(c1) - len(d)) + extras, pa.binary()) if len(c1) == len(d) else pa.concat_arrays([pa.nulls(len(c1) - len(d), pa.binary()), pa.array(extras, pa.binary())])
                for a in range(0, len(c1), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c1[a : a + 100_000]), pa.array(key[a : a + 100_000]), pa.array(meta[a : a + 100_000]), extra.slice(a, 100_000)], ["c1", "key", "meta", "extra"])
        seen.clear()
        let_go()

    return run


_SHARED = "kind byte, sig long, key long, n int, spare int, instance int, doc_id long, mark long"
_TYPES = [pa.int8(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by signature and set: document rows, and signatures that two sets share."""
    names = [x.split()[0] for x in _SHARED.split(", ")]
    held, met = None, False  # the last signature row, and whether the row before it had its signature

    def rows(count: int, kind: int, **given) -> pa.RecordBatch:
        full = {"kind": pa.array(np.full(count, kind, np.int8))} | given
        return pa.RecordBatch.from_arrays([full[x].cast(t) if x in full else pa.nulls(count, t) for x, t in zip(names, _TYPES)], names)

    def links(sig: np.ndarray, key: np.ndarray, meta: np.ndarray) -> pa.RecordBatch:
        return rows(len(sig), 0, sig=pa.array(sig), key=pa.array(key), n=pa.array(meta & 0xFFFFFFFF), spare=pa.array(meta >> 32 & 4095), instance=pa.array(meta >> 44))

    for batch in batches:
        extra = batch.column(3)
        is_doc = extra.is_valid().to_numpy(zero_copy_only=False)
        sig, key, meta = (batch.column(i).to_numpy() for i in range(3))
        if is_doc.any():
            raw = extra.filter(pa.array(is_doc)).to_pylist()
            pairs = np.frombuffer(b"".join(x[:16] for x in raw), np.int64).reshape(-1, 2)
            gone = np.array([len(x) > 16 for x in raw])
            yield rows(len(raw), 1, key=pa.array(key[is_doc]), n=pa.array(meta[is_doc]), doc_id=pa.array(pairs[:, 0], mask=gone), mark=pa.array(pairs[:, 1]))
        sig, key, meta = sig[~is_doc], key[~is_doc], meta[~is_doc]
        if held:
            sig, key, meta = (np.append(np.int64(h), x) for h, x in zip(held, (sig, key, meta)))
        if not len(sig):
            continue
        fresh = np.append(True, (sig[1:] != sig[:-1]) | (key[1:] != key[:-1]))
        sig, key, meta = sig[fresh], key[fresh], meta[fresh]
        same = sig[1:] == sig[:-1]
        shared = np.append(False, same) | np.append(same, False)
        shared[0] |= met
        held, met = (sig[-1], key[-1], meta[-1]), bool(shared[-1])
        keep = np.flatnonzero(shared[:-1])
        if len(keep):
            yield links(sig[keep], key[keep], meta[keep])
    if held and met:
        yield links(*(np.array([x], np.int64) for x in held))


def _sets(sim: Similarity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                sets = list(shingle_sets(data, offsets, sim.size))
                keys = np.array([set_key(h) if len(h) else 0 for h in sets], U).view(np.int64)
                for a in range(0, len(sets), 500):
                    part = sets[a : a + 500]
                    ends = np.cumsum([0] + [len(h) for h in part]).astype(np.int32)
                    flat = np.concatenate(part)
                    yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + 500]), pa.array(np.diff(ends)), odd_sketches(flat, ends, SKETCH), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))], ["key", "n", "sketch", "shingles"])

    return run


def _beside(pairs: DataFrame, sets: DataFrame, column: str, chunk: int = 256) -> DataFrame:
    """``pairs`` (a table) with a column of both sets, ``xa`` and ``xb``.  A set paired very often is given out in several copies."""
    often = pairs.groupBy("b").agg(F.ceil(F.count("*") / chunk).cast("int").alias("copies")).where("copies > 1")
    often = small(stored(often.select(F.col("b").alias("hot"), "copies"), "often"))
    copies = F.coalesce("copies", F.lit(1))
    right = sets.join(often, sets["key"] == F.col("hot"), "left").select(F.col("key").alias("b"), F.explode_outer(F.sequence(F.lit(0), copies - 1)).alias("salt"), F.col(column).alias("xb"))
    salted = pairs.join(often, pairs["b"] == F.col("hot"), "left").select(*pairs.columns, F.pmod(F.xxhash64("a"), copies).cast("int").alias("salt"))
    return salted.join(right, ["b", "salt"]).join(sets.select(F.col("key").alias("a"), F.col(column).alias("xa")), "a")


def odd_sketches(flat: np.ndarray, ends: np.ndarray, bits: int) -> pa.Array:
    """One sketch per set, as a list of 64-bit words: each element flips a bit.  ``flat`` holds the sets one after another."""
    count = len(ends) - 1
    at = np.repeat(np.arange(count), np.diff(ends)) * bits + (mix64(flat) % U(bits)).astype(np.int64)
    odd = np.packbits(np.bincount(at, minlength=count * bits) & 1).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(count + 1, dtype=np.int32) * (bits // 64)), pa.array(odd))


def confirmed(pairs: DataFrame, sets: DataFrame, sim: Similarity) -> DataFrame:
    """Of ``pairs`` (a, b; a table) those whose sets link.

    With columns ``sketch`` and ``n`` in ``sets``, pairs whose sketches differ
    too much are ruled out first, so that only the sets of the others move.
    """
    if "sketch" in sets.columns:
        brief = sets.select("key", F.struct("n", "sketch").alias("brief"))
        differ = F.aggregate(F.zip_with("xa.sketch", "xb.sketch", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
        near = _beside(pairs, brief, "brief").where(differ * (sim.den + sim.num) <= (F.col("xa.n") + F.col("xb.n")) * (sim.den - sim.num))
        pairs = stored(near.select("a", "b").distinct(), "close")
        keys = stored(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "keys")
        if fits(keys):
            sets = sets.join(F.broadcast(keys), "key", "left_semi")
    both = F.size(F.array_intersect("xa", "xb"))
    return _beside(pairs, sets.select("key", "shingles"), "shingles").where(both * sim.den >= (F.size("xa") + F.size("xb") - both) * sim.num).select("a", "b")


def grouped(docs: DataFrame, sim: Similarity, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, mark, n, key), and for sets that are not alone: key, root, component_id."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"), F.xxhash64(text).alias("mark"))
    table = rows.mapInArrow(_emit(sim), _MIXED).repartition("c1").sortWithinPartitions("c1", "key").mapInArrow(_shared, _SHARED)
    table = stored(table, "signatures", by="kind", texts=True)
    nodes = table.where("kind = 1").select("key", "n", "doc_id", "mark")
    shared = table.where("kind = 0").select("sig", "key", "n", "spare", "instance")
    # Linked sets share more signatures of an instance than either has to spare; a set with fewer shared ones has no link there.
    enough = shared.groupBy("key", "instance").agg(F.count("*").cast("int").alias("c"), F.max("spare").alias("s")).where("c > s").select("key", "instance", "c")
    shared = stored(shared.join(small(stored(enough, "enough")), ["key", "instance"]), "shared")
    fits = lambda a, b: F.expr(f"{sim.num} * {a} <= {sim.den} * {b} and {sim.num} * {b} <= {sim.den} * {a}")

    def stars(rows: DataFrame, order: Column) -> DataFrame:
        """Each set of a group with the group's head, the greatest by ``order``, if they lie in different components."""
        heads = rows.groupBy("sig").agg(F.max(F.struct(order.alias("o"), "key", "n", "root")).alias("head"), F.count("*").alias("c")).where("c > 1")
        met = rows.join(heads.select("sig", F.col("head.key").alias("b"), F.col("head.n").alias("nb"), F.col("head.root").alias("rb")), "sig").where("root != rb")
        return stored(met.where(fits("n", "nb")).select(F.col("key").alias("a"), "b").distinct(), "pairs")

    def rooted(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Components, and the signatures of groups that span several, with the group's size."""
        roots = stored(components(edges), "roots")
        own = shared.join(small(roots.select(F.col("node").alias("key"), "root")), "key", "left").withColumn("root", F.coalesce("root", "key"))
        groups = own.groupBy("sig").agg(F.count("*").alias("often"), (F.min("root") != F.max("root")).alias("open"))
        return roots, stored(own.join(groups, "sig"), "groups")

    wanted = stored(shared.select("key").distinct(), "wanted")
    marks = stored(nodes.join(small(wanted), "key", "left_semi").groupBy("key").agg(F.min(F.struct("mark", "doc_id")).alias("one")).select("one.*"), "marks").select(F.col("mark").alias("m"), F.col("doc_id").alias("d"))
    sets = rows.join(small(marks), (F.col("mark") == F.col("m")) & F.col("doc_id").eqNullSafe(F.col("d")), "left_semi").select("body").mapInArrow(_sets(sim), "key long, n int, sketch array<long>, shingles array<long>")
    sets = stored(sets, "sets", texts=True)
    if sets.count() > sets.select("key").distinct().count():  # rows equal in id and text
        sets = stored(sets.dropDuplicates(["key"]), "sets")
    def unsettled(rows: DataFrame, rounds: int = 3) -> DataFrame:
        """Rows of groups that span components, of sets that share enough signatures with other components to link there."""
        for _ in range(rounds):
            rows = rows.where("open")
            more = rows.groupBy("key", "instance").agg(F.count("*").alias("c"), F.max("spare").alias("s")).where("c > s").select("key", "instance")
            rows = rows.join(small(stored(more, "enough")), ["key", "instance"], "left_semi").drop("open")
            spans = rows.groupBy("sig").agg((F.min("root") != F.max("root")).alias("open"))
            rows = stored(rows.join(spans, "sig"), "unsettled")
        return rows

    # Round 1: the head shares the most signatures.  Then heads at random, another one in each group.
    edges = stored(confirmed(stars(shared.withColumn("root", F.col("key")), F.col("c")), sets, sim), "links")
    _, mixed = rooted(edges)
    edges = stored(edges.unionByName(confirmed(stars(mixed.where("open"), F.xxhash64("sig", "key")), sets, sim)), "links")

    # Round 2: what still spans components.
    _, mixed = rooted(edges)
    left = stored(unsettled(mixed).where("open").select("key", "root").distinct(), "open")
    every = sets.join(small(left), "key").select("key", "root", F.size("shingles").alias("n"), F.explode_outer("shingles").alias("shingle"))
    often = every.groupBy("shingle").agg(F.count("*").alias("often"))
    rarest = Window.partitionBy("key").orderBy("often", "shingle")
    prefix = every.join(often, "shingle").withColumn("place", F.row_number().over(rarest)).where(F.expr(f"place <= n - ceil(n * {sim.num} / {sim.den}) + 1 and often > 1"))
    prefix = stored(prefix.select("key", "root", "n", "shingle", "place"), "prefix")
    one, two = (prefix.select("shingle", *(F.col(c).alias(c + side) for c in ("key", "n", "root", "place"))) for side in ("1", "2"))
    # At the first shingle that two linked sets share, what follows in both must suffice.
    reach = F.expr(f"(least(n1 - place1, n2 - place2) + 1) * {sim.num + sim.den} >= (n1 + n2) * {sim.num}")
    more = one.join(two, "shingle").where("root1 < root2").where(fits("n1", "n2")).where(reach).select(F.col("key1").alias("a"), F.col("key2").alias("b")).distinct()
    edges = stored(edges.unionByName(confirmed(stored(more, "pairs"), sets, sim)), "links")
    roots = stored(components(edges), "roots")

    # The least document of each component; sets with one document and no link need none.
    owners = nodes.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("doc"), F.count("*").alias("docs"))
    met = owners.join(roots.select(F.col("node").alias("key"), "root"), "key", "left").where("docs > 1 or root is not null").withColumn("root", F.coalesce("root", "key"))
    met = stored(met, "owners")
    least = met.groupBy("root").agg(F.min("doc").alias("component_id"))
    return nodes, stored(met.join(least, "root").select("key", "root", "component_id"), "named")


def near_groups(docs: DataFrame, sim: Similarity = Similarity(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``."""
    nodes, named = grouped(docs, sim, text, key)
    found = nodes.join(small(named.select("key", "component_id")), "key", "left")
    return found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, sim: Similarity = Similarity(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns: of each group of linked documents that of least id (null last)."""
    nodes, named = grouped(docs, sim, text, key)
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")
    members = stored(nodes.join(small(named.select("key", "root")), "key").select("root", rank.alias("rank")), "members")
    heads = stored(members.groupBy("root").agg(F.min("rank").alias("head")), "heads")
    judged = members.join(small(heads), "root").withColumn("stays", F.col("rank") == F.col("head"))
    drop = stored(judged.where(~F.col("stays")).select(F.col("rank.doc_id").alias("_id"), F.col("rank.mark").alias("_mark")).distinct(), "drop")
    twice = stored(judged.where("stays").groupBy(F.col("rank.doc_id").alias("_id"), F.col("rank.mark").alias("_mark")).count().where("count > 1").select("_id", "_mark"), "twice")
    own = as_rows(docs)
    same = F.col("row")[key].cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col("row")[text]) == F.col("_mark"))
    kept = own.join(small(drop), same, "left_anti")
    if not twice.isEmpty():  # rows equal in id and text: one of each stays
        first = F.row_number().over(Window.partitionBy("_id", "_mark").orderBy(F.lit(1)))
        again = kept.join(small(twice), same).withColumn("_nth", first).where("_nth = 1").select("row")
        kept = kept.join(small(twice), same, "left_anti").unionByName(again)
    return kept.select("row.*")
