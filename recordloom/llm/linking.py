"""Components of linked sets, from buckets of candidates.

A bucket names sets that may be linked; a link counts only if the full sets confirm it. Sets
that share buckets, directly or over others, form a candidate group. All links lie within groups, so
every set moves once, to the task of its group: there the buckets are formed again from the
sets, and pairs of a bucket that are not in one component yet are compared. Of a component,
only links that join something become rows.

Sets that meet by chance chain groups together, ever more of them the more sets there are. `alike`
keeps these apart: of the members of a bucket, it pairs those whose parity bits do not rule a link out.
Parity bits count a set's elements in each place, modulo 2; where those of two sets differ, an element
is in one of them only. So no linked pair is ruled out, and a sketch takes at most a thirtieth of a large set.

Many small groups share a task. The sets of groups of more than `limit` shingles are stored on the way, so
that texts are read and moved once, whatever the groups. Such a group is first thinned: each set
is compared with one other, the first of a bucket, and what this joins needs no comparison any more.
If sets outside of the largest component are left, they (in parts of `limit`) meet all sets
of the group (in parts of `limit`). Every pair that shares a bucket is in one component at
the end, or was compared in full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm import arrays
from recordloom.llm.ship import stored

LIMIT = 1 << 19
GATHERED = 1 << 20
FOREST = 1 << 17
FEW = 48

Keys = Callable[[np.ndarray], np.ndarray]


def class_id(shingles: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        total = arrays.mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))
        return int(arrays.mix(np.array([total]))[0].astype(np.int64))


# --- components ----------------------------------------------------------------


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one task as stars: each node with the smallest one it is connected to."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := above.get(top, top)) != top:
            top = up
        while (up := above.get(x, x)) != top:
            above[x] = top
            x = up
        return top

    for batch in batches:
        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
            low, high = sorted((root(a), root(b)))
            above.setdefault(low, low)
            above[high] = low
    pairs = np.array([(root(x), x) for x in above if root(x) != x], np.int64).reshape(-1, 2)
    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def components(edges: DataFrame, tag: str) -> DataFrame:
    """(`node`, `label`): the smallest node reachable over the edges (`a`, `b`), a stored table.

    Stretches of `FOREST` edges are contracted in tasks first. Then labels take the smallest
    label among the neighbours, then the label of their label; every round is a stored table, and
    rounds go on until nothing changes.
    """
    tasks = -(-max(1, edges.count()) // FOREST)
    edges = edges.select("a", "b").repartition(tasks).mapInArrow(_forest, "a long, b long")
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.distinct(), f"{tag}-edges")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("n")).select(
            "node", F.least("node", "n").alias("label")
        ),
        f"{tag}-labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        hooked = labels.join(near, "node").select(
            "node", F.least("label", "near").alias("new"), F.col("label").alias("old")
        )
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("far"))
        step = stored(
            hooked.join(jump, "new", "left").select(
                "node", F.coalesce(F.least("new", "far"), F.col("new")).alias("label"), "old"
            ),
            f"{tag}-labels",
        )
        labels = step.select("node", "label")
        if step.filter(F.col("label") != F.col("old")).isEmpty():
            return labels


# --- buckets -------------------------------------------------------------------


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of buckets of two or more beside the bucket's first member.

    Rows come sorted by (key, cid), maybe repeated; a bucket may run over many batches.
    """
    key, last, first = None, None, 0
    for batch in batches:
        keys, cids = batch["key"].to_numpy(), batch["cid"].to_numpy()
        if not len(keys):
            continue
        fresh = np.ones(len(keys), bool)
        fresh[1:] = keys[1:] != keys[:-1]
        fresh[0] = keys[0] != key
        again = np.zeros(len(keys), bool)
        again[1:] = cids[1:] == cids[:-1]
        again[0] = cids[0] == last
        pivot = np.concatenate([[first], cids[fresh]])[np.cumsum(fresh)]
        member = ~fresh & ~again
        yield pa.RecordBatch.from_arrays([pa.array(pivot[member]), pa.array(cids[member])], ["a", "b"])
        key, last, first = keys[-1], cids[-1], int(pivot[-1])


def stars(keyed: DataFrame, tag: str) -> DataFrame:
    """Pairs (`a`, `b`) of each bucket's first set with its others, from rows (`key`, `cid`)."""
    met = keyed.repartition("key").sortWithinPartitions("key", "cid").mapInArrow(_shared, "a long, b long")
    return stored(met.distinct(), f"{tag}-stars")


# --- buckets without chance meetings -------------------------------------------


def parity(shingles: np.ndarray) -> np.ndarray:
    """Parity bits of a set, a power of two of them (64 to 65,536), as words of 64."""
    n = 1 << min(16, max(6, len(shingles).bit_length()))
    odd = np.bincount((shingles & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _folded(sketches: list[np.ndarray]) -> np.ndarray:
    """Sketches as rows of as many words as the shortest has: halves added modulo 2 are the shorter sketch."""
    least = min(map(len, sketches))
    rows = []
    for bits in sketches:
        while len(bits) > least:
            bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
        rows.append(bits)
    return np.stack(rows)


def _forest_of_few(sizes: np.ndarray, rows: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """`forest` of so few sets that each is held against all at once."""
    apart = np.bitwise_count(rows[:, None] ^ rows).sum(axis=2, dtype=np.int64)
    near = apart * (100 + percent) <= (100 - percent) * (sizes[:, None] + sizes)
    near &= 100 * np.minimum(sizes[:, None], sizes) >= percent * np.maximum(sizes[:, None], sizes)
    root = list(range(len(sizes)))
    edges = []
    for x, y in zip(*(i.tolist() for i in np.nonzero(np.triu(near, 1))), strict=True):
        if (low := root[x]) != (high := root[y]):
            edges.append((x, y))
            root = [low if r == high else r for r in root]
    return edges


def forest(sizes: np.ndarray, sketches: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Pairs of places that connect all sets whose sizes and sketches allow a link, and no others."""
    rows, n = _folded(sketches), len(sizes)
    if n <= FEW and n * rows.size <= GATHERED:
        return _forest_of_few(sizes, rows, percent)
    root = np.arange(n)
    edges: list[tuple[int, int]] = []

    def meet(x: int) -> None:
        others = np.flatnonzero(root != root[x])
        low, high = np.minimum(sizes[others], sizes[x]), np.maximum(sizes[others], sizes[x])
        others = others[100 * low >= percent * high]
        near = [others[:0]]
        step = max(1, GATHERED // rows.shape[1])
        for lo in range(0, len(others), step):
            part = others[lo : lo + step]
            apart = np.bitwise_count(rows[part] ^ rows[x]).sum(axis=1, dtype=np.int64)
            near.append(part[apart * (100 + percent) <= (100 - percent) * (sizes[part] + sizes[x])])
        roots, first = np.unique(root[found := np.concatenate(near)], return_index=True)
        if len(roots):
            edges.extend((x, y) for y in found[first].tolist())
            root[np.isin(root, roots)] = root[x]

    # A few sets, far from those before, join most copies. What they leave out meets all.
    for _ in range(min(n, 4)):
        alone = np.flatnonzero(np.bincount(root, minlength=n)[root] == 1)
        if len(alone):
            meet(int(alone[0]))
    for x in np.flatnonzero(root != np.bincount(root).argmax()).tolist():
        meet(x)
    return edges


def _runs(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.Table]:
    """Rows sorted by the number `by`, in tables that hold all rows of a number."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch[by].to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if held and (cut or held[0][by][0].as_py() != keys[-1]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(`bucket`, `cid`) of buckets of two or more, named by their members: buckets of the same sets are one."""
    for table in _runs(batches, "key"):
        keys, cids = table["key"].to_numpy(), table["cid"].to_numpy()
        again = np.zeros(len(keys), bool)
        again[1:] = (keys[1:] == keys[:-1]) & (cids[1:] == cids[:-1])
        keys, cids = keys[~again], cids[~again]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.diff(np.append(starts, len(keys)))
        names = arrays.mix(np.add.reduceat(arrays.mix(cids.view(np.uint64)), starts)).view(np.int64)
        shared = np.repeat(counts > 1, counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(names, counts)[shared]), pa.array(cids[shared])], ["bucket", "cid"]
        )


def alike(keyed: DataFrame, sketches: DataFrame, percent: int, tag: str) -> DataFrame:
    """Pairs (`a`, `b`) that connect the sets of each bucket that may be linked, from rows (`key`, `cid`).

    `sketches`: `cid`, size `n_shingles` and parity `bits` of each set.
    """

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, "bucket"):
            buckets, cids, sizes = (table[c].to_numpy() for c in ("bucket", "cid", "n_shingles"))
            bits = [np.frombuffer(b, np.uint64) for b in table["bits"].to_pylist()]
            starts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]])).tolist()
            pairs = [
                (lo + x, lo + y)
                for lo, hi in zip(starts, [*starts[1:], len(buckets)], strict=True)
                for x, y in forest(sizes[lo:hi], bits[lo:hi], percent)
            ]
            at = np.array(pairs, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(cids[at[:, 0]]), pa.array(cids[at[:, 1]])], ["a", "b"])

    members = (
        keyed.repartition("key").sortWithinPartitions("key", "cid").mapInArrow(_members, "bucket long, cid long").distinct()
    )
    rows = members.join(sketches.hint("merge"), "cid").select("bucket", "cid", "n_shingles", "bits")
    met = rows.repartition("bucket").sortWithinPartitions("bucket", "cid").mapInArrow(paired, "a long, b long")
    return stored(met.distinct(), f"{tag}-pairs")


# --- comparisons in a task -----------------------------------------------------


class Sets:
    """Sorted sets side by side, with the components found so far."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.flat = np.concatenate(sets)
        self.root = np.arange(len(sets))

    def linked(self, x: int, others: np.ndarray) -> np.ndarray:
        """Those of `others` that are linked with x, by their full sets."""
        size = self.sizes[x]
        small, large = np.minimum(self.sizes[others], size), np.maximum(self.sizes[others], size)
        others = others[100 * small >= self.percent * large]
        found = [others[:0]]
        ends = np.cumsum(self.sizes[others])
        lo = 0
        while lo < len(others):
            done = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, done + GATHERED, "right")))
            part = others[lo:hi]
            sizes = self.sizes[part]
            at = np.cumsum(sizes) - sizes
            values = self.flat[np.repeat(self.starts[part] - at, sizes) + np.arange(int(sizes.sum()))]
            mine = self.sets[x]
            place = np.searchsorted(mine, values)
            place[place == len(mine)] = 0
            both = np.add.reduceat((mine[place] == values).astype(np.int64), at)
            found.append(part[100 * both >= self.percent * (size + sizes - both)])
            lo = hi
        return np.concatenate(found)

    def join(self, x: int, others: np.ndarray) -> list[int]:
        """Bring x and the linked `others` to one component; those that were in another one."""
        joined = []
        for y in others.tolist():
            a, b = self.root[x], self.root[y]
            if a != b:
                self.root[self.root == max(a, b)] = min(a, b)
                joined.append(y)
        return joined


def _buckets(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Members of the buckets of two or more, one bucket after the other, and each one's bucket number."""
    owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    every = np.concatenate(keys)
    order = np.lexsort((owner, every))
    every, owner = every[order], owner[order]
    fresh = np.concatenate([[True], every[1:] != every[:-1]])
    number = np.cumsum(fresh) - 1
    shared = np.bincount(number)[number] > 1
    return owner[shared], np.unique(number[shared], return_inverse=True)[1]


class Lists:
    """`values` split by `by` (0 to n - 1), side by side in one array."""

    def __init__(self, values: np.ndarray, by: np.ndarray, n: int):
        order = np.argsort(by, kind="stable")
        self.values = values[order]
        self.edges = np.searchsorted(by[order], np.arange(n + 1))

    def __getitem__(self, i: int) -> np.ndarray:
        return self.values[self.edges[i] : self.edges[i + 1]]


def joining_links(
    sets: list[np.ndarray], groups: np.ndarray, labels: np.ndarray, asks: np.ndarray, keys: Keys, percent: int
) -> list[tuple[int, int]]:
    """Links, as places in `sets`, that join different components of `labels`.

    Pairs are compared that share a bucket, are in different components, and of which one `asks`
    or is the first of the bucket.
    """
    known = Sets(sets, percent)
    _, known.root = np.unique(labels, return_inverse=True)
    links: list[tuple[int, int]] = []
    member, bucket = _buckets([keys(s) for s in sets])
    if not len(member):
        return links
    n_buckets = int(bucket[-1]) + 1
    in_bucket = Lists(member, bucket, n_buckets)
    flag = np.zeros(len(sets), bool)

    def compare(x: int, buckets: np.ndarray) -> None:
        for b in buckets.tolist():
            flag[in_bucket[b]] = True
        others = np.flatnonzero(flag)
        flag[others] = False
        others = others[known.root[others] != known.root[x]]
        links.extend((x, y) for y in known.join(x, known.linked(x, others)))

    heads, of_head = np.unique(member[in_bucket.edges[:-1]], return_inverse=True)
    headed = Lists(np.arange(n_buckets), of_head, len(heads))
    for i, x in enumerate(heads.tolist()):
        compare(x, headed[i])
    # What is left lies outside of the largest component of a group: all others there are one.
    pairs, back, count = np.unique(np.stack([groups, known.root], 1), axis=0, return_inverse=True, return_counts=True)
    largest = np.zeros(len(pairs), bool)
    order = np.lexsort((count, pairs[:, 0]))
    last = np.concatenate([pairs[order][1:, 0] != pairs[order][:-1, 0], [True]])
    largest[order[last]] = True
    rest = asks & ~largest[back.ravel()]
    of_member = Lists(bucket, member, len(sets))
    for x in np.flatnonzero(rest).tolist():
        compare(x, of_member[x])
    return links


def _joined(table: pa.Table, keys: Keys, percent: int) -> pa.Table:
    """(`a`, `b`): the links found among the sets of one task."""
    cids, first, back = np.unique(table["cid"].to_numpy(), return_index=True, return_inverse=True)
    asks = np.zeros(len(cids), bool)
    np.logical_or.at(asks, back, table["asks"].to_numpy(zero_copy_only=False))
    rows = table["shingles"]
    sets = [np.frombuffer(rows[int(i)].as_py(), np.uint64) for i in first]
    groups, labels = table["grp"].to_numpy()[first], table["label"].to_numpy()[first]
    found = joining_links(sets, groups, labels, asks, keys, percent)
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.table({"a": cids[pairs[:, 0]], "b": cids[pairs[:, 1]]})


def _joined_or_kept(table: pa.Table, keys: Keys, percent: int) -> pa.Table:
    """Rows (`a`, `b`) of links of small groups, or (`cid`, `shingles`) as they came of large ones."""
    if table["large"][0].as_py():
        return table.select(["cid", "shingles"]).add_column(0, "b", pa.nulls(len(table), pa.int64())).add_column(
            0, "a", pa.nulls(len(table), pa.int64())
        )
    found = _joined(table, keys, percent)
    return found.append_column("cid", pa.nulls(len(found), pa.int64())).append_column(
        "shingles", pa.nulls(len(found), table["shingles"].type)
    )


# --- the whole -----------------------------------------------------------------


def _shingles(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    return arrays.shingle_sets(*arrays.text_buffer(column), width)


def sets_of(docs: DataFrame, seats: DataFrame, width: int) -> DataFrame:
    """`seats` (rows of (`cid`, `rep`) and more), each with its set's `shingles`.

    Each class is read from the text of its smallest doc_id. The id is part of the join's
    key: many copies of one text with ids of their own are many keys.
    """

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [class_id(s) if len(s) else None for s in _shingles(batch["text"], width)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text"], pa.array(ids, pa.int64())], ["doc_id", "text", "cid"]
            )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [s.tobytes() for s in _shingles(batch["text"], width)]
            kept = [batch[c] for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(data, pa.binary())], [*names, "shingles"])

    names = [c for c in seats.columns if c != "rep"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in seats.schema.fields if f.name != "rep")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        classed, "doc_id long, text string, cid long"
    )
    by = [F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col("doc_id").isNull().alias("__none")]
    rows = rows.filter("cid IS NOT NULL").select("cid", *by, "text")
    wanted = seats.select(
        *names, F.coalesce("rep", F.lit(0)).alias("__id"), F.col("rep").isNull().alias("__none")
    )
    # Rows repeated with one id and one set are one row before their texts move on. Texts are merged at
    # every size: the same plan on small tables as on large ones.
    key = ["cid", "__id", "__none"]
    one = wanted.select(*key).distinct().hint("merge")
    texts = rows.join(one, key, "left_semi").groupBy(*key).agg(F.min("text").alias("text"))
    return texts.join(wanted.hint("merge"), key).select(*names, "text").mapInArrow(
        sets, f"{schema}, shingles binary"
    )


def _thinned(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """(`a`, `b`): links found by comparing each set of a large group (`cid`, `shingles`) with one other set."""
    one = pairs.groupBy("b").agg(F.min("a").alias("a"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch["left"].to_pylist(), batch["right"].to_pylist(), strict=True):
                two = Sets([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)], percent)
                linked.append(len(two.linked(0, np.array([1]))) > 0)
            kept = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(kept), batch["b"].filter(kept)], ["a", "b"])

    left = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("right"))
    return one.join(right, "b").join(left, "a").mapInArrow(measured, "a long, b long")


def _seats(large: DataFrame, links: DataFrame, limit: int) -> DataFrame:
    """Seats of large groups (`cid, n, grp, total`): what the links leave over meets all, in parts."""
    found = components(links, "thin")
    state = large.join(found, large["cid"] == found["node"], "left").select(
        "cid", "n", "grp", "total", F.coalesce("label", "cid").alias("label")
    )
    state = stored(state, "state")
    sizes = state.groupBy("grp", "label").agg(F.sum("n").alias("size"))
    main = sizes.groupBy("grp").agg(
        F.max_by("label", F.struct("size", "label")).alias("main"),
        (F.sum("size") - F.max("size")).alias("rest"),
    )

    def parts(total: Column) -> Column:
        return F.ceil(total / F.lit(limit)).cast("int")

    placed = state.join(main.filter("rest > 0"), "grp").select(
        "*", parts(F.col("rest")).alias("rows"), parts(F.col("total")).alias("columns"),
        (F.col("label") != F.col("main")).alias("asks"),
    )
    spot = F.xxhash64("cid")
    seats = ["cid", "grp", "label"]
    every = placed.select(
        *seats, F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("r"),
        F.pmod(spot, "columns").cast("int").alias("c"),
    )
    rest = placed.filter("asks").select(
        *seats, "asks", F.pmod(spot, "rows").cast("int").alias("r"),
        F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("c"),
    )
    return every.unionByName(rest)


def linked_components(
    docs: DataFrame, pairs: DataFrame, classes: DataFrame, keys: Keys, width: int, percent: int, limit: int | None = None
) -> DataFrame:
    """(`node`, `label`) of every set that is linked with another one.

    `docs`: `doc_id, text`; `pairs` (`a`, `b`): connect the linked sets of each bucket;
    `classes`: `cid`, smallest doc_id `rep` and size `n_shingles` of each set; `keys`: the buckets of
    a set, as they led to `pairs`; `width`: words of a shingle.
    """
    limit = limit or LIMIT
    groups = components(pairs, "candidates")
    members = stored(
        groups.join(classes.withColumnRenamed("cid", "node"), "node").select(
            F.col("node").alias("cid"), "rep", F.col("n_shingles").alias("n"), F.col("label").alias("grp")
        ),
        "members",
    )
    totals = members.groupBy("grp").agg(F.sum("n").alias("total"))
    members = members.join(totals, "grp").withColumn("large", F.col("total") > limit)
    weights = {r["large"]: r["n"] for r in members.groupBy("large").agg(F.sum("n").alias("n")).collect()}

    def bins(large: bool) -> Column:
        return F.lit(max(1, -(-4 * weights.get(large, 0) // limit)))

    # Small groups share the task of their number; sets of large ones are dealt evenly and kept.
    place = F.when(F.col("large"), F.pmod(F.xxhash64("cid"), bins(True))).otherwise(F.pmod(F.xxhash64("grp"), bins(False)))
    seats = stored(
        members.select("cid", "rep", "grp", F.col("cid").alias("label"), F.lit(True).alias("asks"), "large", place.alias("c")),
        "seats",
    )
    first = stored(
        sets_of(docs, seats, width).groupBy("large", "c").applyInArrow(
            lambda table: _joined_or_kept(table, keys, percent), "a long, b long, cid long, shingles binary"
        ),
        "first",
    )
    found = first.filter(F.col("cid").isNull()).select("a", "b")
    if weights.get(True):
        sets = first.filter(F.col("cid").isNotNull()).select("cid", "shingles")
        large = stored(members.filter("large").select("cid", "n", "grp", "total"), "large")
        theirs = pairs.join(large.select(F.col("cid").alias("b")), "b", "left_semi")
        links = stored(_thinned(sets, theirs, percent), "thin")
        rest = _seats(large, links, limit).join(sets.hint("merge"), "cid")
        late = rest.groupBy("grp", "r", "c").applyInArrow(lambda table: _joined(table, keys, percent), "a long, b long")
        found = found.unionByName(links).unionByName(late)
    return components(stored(found, "links"), "linked")
