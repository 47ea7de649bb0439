"""Near-duplicates by bottom-k sketches of word shingles.

A document's set holds the hashes of its distinct shingles of ``words`` words. Its sketch is the ``SKETCH`` least of
them, so one hash function serves all. Documents with equal sets are one from the start; one of each, the
representative, goes on:

1. Inverted lists: the ``KEYS`` least values of each representative point to it. Two sets of similarity J share none
   of them with probability (1-J)**KEYS, 6e-9 at 0.85.
2. Within each list, the least member is paired with the others. The union of two sketches estimates J; pairs more
   than ``MARGIN`` (six standard deviations) below the threshold go. The rest are verified on the full sets, and the
   verified links give components.
3. Lists whose members are still in several components are looked at again: members that have a possible partner of
   another component stay. Their full sets are compared within the list, growing components from member to member, so
   only links that connect are returned, never all pairs of a group. Together with the links of step 2 they connect
   exactly what all links would.

A list longer than ``BLOCK`` members is cut into blocks, and each task holds two blocks.

Rules for odd input: words are split at the ASCII space characters and A-Z lower-cased; fewer words than a shingle are
one shingle as a whole; a text without words, or null, has the empty set and is linked with nothing; rows that repeat a
doc_id are one document linked by all of them; a row without doc_id takes no part: its component is null and it is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.llm.common import Hashes, lower, mix, slices, words_of, written
from riskengine.llm.components import components

SKETCH, KEYS, MARGIN = 16, 10, 0.55
BLOCK = 2_048
#: Up to so many ids of documents to be verified are sent to every task; beyond that they are joined.
BROADCAST_IDS = 500_000
_SALT = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The sets of a slice's documents one after another, each in ascending order, and their sizes."""
    small = lower(data)
    starts, ends, docs = words_of(small, offsets)
    hashes, n = Hashes(small).spans(starts, ends), len(offsets) - 1
    count = np.bincount(docs, minlength=n)
    first = np.cumsum(count) - count
    # A document with fewer words than a shingle has one, of all its words.
    width = np.minimum(count, words)
    begins = np.arange(len(hashes)) - first[docs] <= count[docs] - width[docs]
    at, owner = np.flatnonzero(begins), docs[begins]
    value = width[owner].astype(np.uint64) * _SALT[0]
    for k in range(words):
        inside = k < width[owner]
        word = hashes[np.minimum(at + k, len(hashes) - 1)] if len(hashes) else hashes
        value = np.where(inside, mix(value * _SALT[1] + word), value)
    order = np.argsort(value, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.bincount(owner, minlength=n)


def _digest(values: np.ndarray, counts: np.ndarray, salt: np.uint64) -> np.ndarray:
    """A number for each set that depends on all of it."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ salt), dtype=np.uint64)])
    ends = np.cumsum(counts)
    return mix(sums[ends] - sums[ends - counts]).view(np.int64)


def sketches(docs: DataFrame, words: int, full: bool = False) -> DataFrame:
    """doc_id, size of the set, two digests of it, and the sketch (or the full set) as 64-bit integers."""
    names = ["doc_id", "n_shingles", "d1", "d2", "values"]

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for start, end, data, offsets in slices(batch.column(1)):
                values, counts = shingle_sets(data, offsets, words)
                ends = np.cumsum(counts)
                stop = ends if full else np.minimum(ends, ends - counts + SKETCH)
                held = [values[a:b].tobytes() for a, b in zip((ends - counts).tolist(), stop.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, end - start), pa.array(counts), *(pa.array(_digest(values, counts, s)) for s in _SALT[1:]), pa.array(held, pa.binary())],
                    names=names,
                )

    schema = "doc_id long, n_shingles long, d1 long, d2 long, values binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def _rows(column, width: int = SKETCH) -> np.ndarray:
    """Sketches as rows of a matrix, filled up with the largest value."""
    out = np.full((len(column), width), np.iinfo(np.uint64).max, np.uint64)
    for i, v in enumerate(column):
        own = np.frombuffer(v, np.uint64)[:width]
        out[i, : len(own)] = own
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarities row by row: the share of the least ``SKETCH`` values of the union that both sketches hold."""
    top = np.iinfo(np.uint64).max
    both = np.sort(np.concatenate([a, b], 1), 1)
    twin = np.zeros(both.shape, bool)
    twin[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != top)
    distinct = (both != top) & ~twin
    rank = np.cumsum(distinct, 1)
    k = np.minimum(SKETCH, rank[:, -1])
    return (twin & (rank <= SKETCH)).sum(1) / np.maximum(k, 1)


def _possible(sketch: np.ndarray, size: np.ndarray, i: int, others: np.ndarray, similarity: float) -> np.ndarray:
    """Which of the members ``others`` may be as similar to member ``i`` as asked for."""
    low, high = np.minimum(size[i], size[others]), np.maximum(size[i], size[others])
    others = others[low >= similarity * high - 1e-9]
    found = estimate(np.broadcast_to(sketch[i], (len(others), sketch.shape[1])), sketch[others])
    return others[found >= similarity - MARGIN]


def _blocks(lists: DataFrame) -> DataFrame:
    """Gives members of long lists block pairs, so that each two meet in one group of (key, i, j)."""
    sizes = lists.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    blocks = F.ceil(F.col("_n") / BLOCK).cast("int")
    cut = lists.join(sizes, "key").withColumn("_blocks", blocks).withColumn("_own", F.pmod(F.xxhash64("rep"), F.col("_blocks")).cast("int"))
    cut = cut.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cut = cut.withColumns({"i": F.least("_own", "_other"), "j": F.greatest("_own", "_other")})
    return cut.drop("_n", "_blocks", "_own", "_other")


def _beside(size: np.ndarray, comp: np.ndarray, who: np.ndarray, others: np.ndarray, similarity: float) -> np.ndarray:
    """For each of the members ``who``, whether one of ``others`` is of another component and near enough in size."""
    if not len(others):
        return np.zeros(len(who), bool)
    others = others[np.argsort(size[others], kind="stable")]
    sizes, named = size[others], comp[others]
    first = np.searchsorted(sizes, similarity * size[who] - 1e-9, "left")
    end = np.searchsorted(sizes, size[who] / similarity + 1e-9, "right")
    # Where the run of one component ends that a place lies in.
    edge = np.flatnonzero(named[1:] != named[:-1]) + 1
    stop = np.append(edge, len(named))[np.searchsorted(edge, np.arange(len(named)), "right")]
    at = np.minimum(first, len(named) - 1)
    return (first < end) & ((named[at] != comp[who]) | (stop[at] < end))


def _open_members(similarity: float):
    def run(table: pa.Table) -> pa.Table:
        rep, comp = table.column("rep").to_numpy(), table.column("component").to_numpy()
        size = table.column("n_shingles").to_numpy()
        sketch = _rows(table.column("values").to_pylist())
        keep = np.zeros(len(rep), bool)
        if len(np.unique(comp)) > 1:
            # A possible partner shares retained values: members are met by value, not each with each.
            flat = sketch.ravel()
            order = np.flatnonzero(flat != np.iinfo(np.uint64).max)
            order = order[np.argsort(flat[order], kind="stable")]
            holders = np.split(order // sketch.shape[1], np.flatnonzero(np.diff(flat[order])) + 1)
            values = np.unique(flat[order])
            need = np.maximum(1, np.ceil((similarity - MARGIN) * np.minimum(SKETCH, size) - 1e-9)).astype(np.int64)
            # What all members hold is not met but counted. Two that share nothing else are as near as asked for only
            # if the value that makes up the count is among the least of their union: its place there is the sum of
            # its places in both, less what is counted twice.
            common = values[[len(own) == len(rep) for own in holders]]
            for m in np.unique(need[need <= len(common)]):
                place = (sketch <= common[m - 1]).sum(1)
                for p in np.unique(place[need == m]):
                    who, others = np.flatnonzero((need == m) & (place == p)), np.flatnonzero(place <= SKETCH + m - p)
                    keep[who] |= _beside(size, comp, who, others, similarity)
            met: dict[int, list[np.ndarray]] = {}
            for own in holders:
                if 1 < len(own) < len(rep) and len(np.unique(comp[own])) > 1:
                    for i in own:
                        met.setdefault(int(i), []).append(own)
            for i, owns in met.items():
                if keep[i]:
                    continue
                others, shared = np.unique(np.concatenate(owns), return_counts=True)
                others = others[(comp[others] != comp[i]) & (shared + len(common) >= need[i])]
                if len(others):
                    found = _possible(sketch, size, i, others, similarity)
                    if len(found):
                        keep[i] = True
                        keep[found] = True
        return table.select(["key", "i", "j", "rep", "component"]).filter(pa.array(keep))

    return run


def _links(percent: int):
    def run(table: pa.Table) -> pa.Table:
        rep, comp = table.column("rep").to_numpy(), table.column("component").to_numpy()
        sets = [np.frombuffer(v.as_py(), np.uint64) for v in table.column("values")]
        size = np.array([len(s) for s in sets])
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), size)
        _, number = np.unique(flat, return_inverse=True)
        order = np.argsort(number, kind="stable")
        starts = np.append(0, np.cumsum(np.bincount(number))) if len(flat) else np.zeros(1, np.int64)
        holders, number = owner[order], np.split(number, np.cumsum(size)[:-1])
        left, pairs = np.ones(len(sets), bool), []
        for seed in range(len(sets)):
            if not left[seed]:
                continue
            left[seed], front = False, [seed]
            # What is in the seed's component already is reached without a comparison.
            for i in front:
                known = np.flatnonzero(left & (comp == comp[i]))
                shared = np.zeros(len(sets), np.int64)
                np.add.at(shared, np.concatenate([holders[starts[k] : starts[k + 1]] for k in number[i]]), 1)
                union = size[i] + size - shared
                linked = np.flatnonzero(left & (comp != comp[i]) & (100 * shared >= percent * union))
                pairs += [(rep[i], rep[j]) for j in linked]
                front += [*known, *linked]
                left[known] = left[linked] = False
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per document. Documents are linked when
    100 * intersection >= ``percent`` * union; ``component_id`` is the least doc_id reachable."""
    similarity = percent / 100
    every = written(sketches(docs, words), "sketches")
    held = every.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = written(
        held.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("values").alias("values")), "representatives"
    )

    def keys(batches):
        for batch in batches:
            sketch = _rows(batch.column(1).to_pylist(), KEYS)
            who, at = np.nonzero(sketch != np.iinfo(np.uint64).max)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sketch[who, at].view(np.int64)), batch.column(0).take(pa.array(who)), *(batch.column(i).take(pa.array(who)) for i in (2, 3, 4))],
                names=["key", "rep", "n_shingles", "d1", "d2"],
            )

    entries = reps.select("rep", "values", "n_shingles", "d1", "d2").mapInArrow(keys, "key long, rep long, n_shingles long, d1 long, d2 long")
    entries = written(entries, "entries")
    # The leader of a list, with what is needed to find its set.
    leaders = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rep", "n_shingles", "d1", "d2")).alias("leader"))
    lists = written(entries.join(leaders.filter("n > 1").select("key", "leader"), "key"), "lists")

    # Step 2: each list's least member with the others.
    member, leader = F.struct("rep", "n_shingles", "d1", "d2"), F.col("leader")
    pairs = lists.select(leader.alias("a"), member.alias("b")).filter("a <> b").filter(
        "least(a.n_shingles, b.n_shingles) * 100 >= " + str(percent) + " * greatest(a.n_shingles, b.n_shingles)"
    ).distinct()
    side = lambda name: reps.select(F.struct("rep", "n_shingles", "d1", "d2").alias(name), F.col("values").alias(f"{name}_values"))

    def likely(batches):
        for batch in batches:
            a, b = (_rows(batch.column(batch.schema.get_field_index(f"{x}_values")).to_pylist()) for x in "ab")
            keep = pa.array(estimate(a, b) >= similarity - MARGIN) if batch.num_rows else pa.array([], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(x)) for x in "ab"], names=["a", "b"]).filter(keep)

    likely_pairs = written(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_values", "b_values").mapInArrow(likely, pairs.schema), "likely-pairs")
    sets = written(_sets(docs, words, likely_pairs.select("a.rep").union(likely_pairs.select("b.rep")).distinct()), "sets")
    by = lambda name: sets.select(F.struct(F.col("doc_id").alias("rep"), "n_shingles", "d1", "d2").alias(name), F.col("values").alias(f"{name}_values"))

    def verify(batches):
        for batch in batches:
            a, b = (batch.column(batch.schema.get_field_index(f"{x}_values")) for x in "ab")
            keep = []
            for x, y in zip(a, b):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in (0, 1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    checked = likely_pairs.join(by("a"), "a").join(by("b"), "b").select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b"), "a_values", "b_values")
    links = written(checked.mapInArrow(verify, "a long, b long"), "links")
    found = written(components(links), "components")

    # Step 3: lists that still hold several components.
    named = lists.drop("leader").join(found.withColumnRenamed("vertex", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    several = named.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).filter("_low < _high").select("key")
    rest = _blocks(named.join(several, "key")).join(reps.select("rep", "d1", "d2", "values"), ["rep", "d1", "d2"])
    open_rows = written(
        rest.select("key", "i", "j", "rep", "component", "n_shingles", "values")
        .groupBy("key", "i", "j")
        .applyInArrow(_open_members(similarity), "key long, i int, j int, rep long, component long"),
        "open-members",
    ).distinct()
    more = _sets(docs, words, open_rows.select("rep").distinct()).withColumnRenamed("doc_id", "rep")
    more = more.join(reps.select("rep", "d1", "d2"), ["rep", "d1", "d2"], "left_semi").drop("d1", "d2", "n_shingles")
    new = open_rows.join(more, "rep").groupBy("key", "i", "j").applyInArrow(_links(percent), "a long, b long")
    new = written(new, "more-links")
    if new.limit(1).count():
        found = written(components(links.union(new)), "all-components")

    rep_of = reps.select("n_shingles", "d1", "d2", "rep").join(found.withColumnRenamed("vertex", "rep"), "rep", "left")
    rep_of = rep_of.select("n_shingles", "d1", "d2", F.coalesce("component", "rep").alias("_component"))
    out = every.drop("values").join(rep_of, ["n_shingles", "d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("_component"))
    out = out.select("doc_id", "n_shingles", component.cast("long").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _sets(docs: DataFrame, words: int, ids: DataFrame) -> DataFrame:
    """Full sets of the documents ``ids`` (column rep)."""
    ids = written(ids, "ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    return sketches(wanted, words, full=True)
