"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set is its distinct word shingles (words ``[^\\x20\\x09-\\x0D]+``
after A-Z became lower case; fewer words than a shingle: the whole sequence as
one; no words: empty, linked with nothing). Two documents are linked when
``100 * intersection >= percent * union``.

1. One pass makes each document's set key (a 128-bit digest of the set, by
   hashes of its own), set size and 128 minimum hashes. Equal sets form a
   class; only its smallest doc_id goes on, so copies never meet in pairs.
2. Forest: the 128 hashes are ``TREES`` signatures of ``DEPTH`` numbers. In
   the sorted order of one tree, the documents whose longest common prefix is
   at least ``FIRST_DEPTH`` form a region, and are candidates of one another.
   Regions of up to ``BLOCK`` documents are searched there and then: pairs
   whose hashes agree so rarely that a link's chance is below 1e-8 go, and a
   spanning forest of the rest joins them to families. A larger region is one
   family as a whole; inside it depth grows, region by region, while a part is
   over a block, and parts are dealt whole to the blocks that are compared first.
3. A family is compared on the full sets, made from the whole texts: counts of
   common shingles of all pairs of a block at once, as a matrix product. Only
   the links of a spanning forest leave a task, one per document at most.
4. Families of over ``BLOCK`` documents or ``SHINGLES`` shingles: each block
   meets itself and the family's ``PIVOTS`` documents that are in most
   regions. Components follow; then the blocks outside a family's largest
   component meet one another and those inside it, and pairs of different
   components are compared on the full sets.

Nothing is capped: every pair of a family is confirmed, refuted or inside one
component. A pair of similarity 0.8 is missed with a chance of
(1 - 0.8 ** 3) ** 16, about 1e-5. Rows between the steps are in proportion to
the documents, but where a large family has few links: its sets are then
copied once for each block that they meet.

Defined results: null text as empty; repeated rows each get their row, with
the same ids; equal doc_ids count as one document (the smaller text); a null
doc_id is linked with nothing and kept; an empty table gives an empty result;
other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm import kernels as K
from cadenza.llm.common import byte_buffer, fresh, map_blocks, ship, texts
from cadenza.llm.components import connected_components
from cadenza.session import materialize, release

SHINGLE_WORDS = 5
PERCENT = 80
TREES, DEPTH, FIRST_DEPTH = 16, 8, 3
HASHES = TREES * DEPTH
#: Documents, and distinct shingles of them, that one task compares at once.
BLOCK, SHINGLES = 1024, 1 << 22
#: Documents of a larger family that meet every block of it.
PIVOTS = 8
#: Columns of a block's matrix held at once.
COLUMNS = 4096

_rng = np.random.default_rng(77)
_A = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)

SIGNED = "doc_id bigint, n_shingles bigint, set_key binary, signature binary, prefixes array<bigint>"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each row, sorted, end to end, and n + 1 row offsets."""
    data = K.LOWER[data]
    starts, ends, rows = K.word_spans(data, offsets, K.NOT_SPACE)
    h, at = K.shingle_hashes(K.slice_hashes(data, starts, ends, seed), rows, size)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((h, row)) if len(at) < 9 else np.concatenate([a + np.argsort(h[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())])
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(at)))


def signatures(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The ``HASHES`` minimum hashes of each non-empty set."""
    full = np.diff(at) > 0
    out = np.zeros((int(full.sum()), HASHES), np.uint32)
    if len(out):
        x, starts = (h >> np.uint64(32)).astype(np.uint32), at[:-1][full]
        for k in range(HASHES):
            out[:, k] = np.minimum.reduceat(x * _A[k] + _B[k], starts)
    return out


def set_keys(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 128-bit digest of each set, as two numbers: sums of independently mixed hashes."""
    total = [np.append(np.uint64(0), np.cumsum(K.mix(h ^ np.uint64(c)))) for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return np.stack([t[at[1:]] - t[at[:-1]] for t in total], axis=1)


def tree_prefixes(sig: np.ndarray) -> np.ndarray:
    """A hash of the first ``FIRST_DEPTH`` numbers of each tree, and of the tree."""
    trees = sig.reshape(len(sig), TREES, DEPTH).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64) << np.uint64(32), trees.shape[:2])
    for d in range(FIRST_DEPTH):
        h = K.mix(K.mix(h) ^ trees[:, :, d])
    return h


def signed(docs: DataFrame, size: int) -> DataFrame:
    """Set key, size and hashes per document: the lowest byte of each minimum hash, and each tree's prefix."""

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = byte_buffer(batch.column("text"))
        h, at = shingle_sets(data, offsets, size)
        other, other_at = shingle_sets(data, offsets, size, seed=1)
        # The keys are sums over hashes of another seed, so they don't share the sets' accidents.
        keys = np.concatenate([set_keys(h, at)[:, :1], set_keys(other, other_at)[:, 1:]], axis=1)
        n = np.diff(at)
        sig = signatures(h, at)
        low, prefixes = iter((sig & np.uint32(255)).astype(np.uint8)), tree_prefixes(sig)
        at_prefix = np.append(0, np.cumsum(np.where(n > 0, TREES, 0))).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(n, pa.int64()), pa.array([k.tobytes() for k in keys], pa.binary()),
                pa.array([next(low).tobytes() if k else b"" for k in n.tolist()], pa.binary()),
                pa.ListArray.from_arrays(pa.array(at_prefix), pa.array(prefixes.reshape(-1).view(np.int64))),
            ],
            ["doc_id", "n_shingles", "set_key", "signature", "prefixes"],
        )

    return map_blocks(texts(docs), block, SIGNED)


def _least_agreement(percent: int) -> int:
    """Agreements that a link's hashes have but for a chance below 1e-8; low bytes only add some."""
    j = percent / 100
    return int(HASHES * j - 6 * (HASHES * j * (1 - j)) ** 0.5)


def spanning_forest(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Edges of a spanning forest over 0 .. n-1; ``near(i, others)`` tells which of ``others`` are linked with i."""
    left, out = np.ones(n, bool), []
    for start in range(n):
        if not left[start]:
            continue
        left[start] = False
        queue = [start]
        while queue:
            i = queue.pop()
            others = np.flatnonzero(left)
            if not len(others):
                return out
            found = others[near(i, others)]
            left[found] = False
            out += [(i, j) for j in found.tolist()]
            queue += found.tolist()
    return out


def common_counts(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of all ``sets`` with all ``others`` (none: with one another)."""
    both = sets + (others or [])
    if len(both) == 2:
        c = len(np.intersect1d(both[0], both[1], assume_unique=True))
        return np.array([[c]]) if others else np.array([[len(both[0]), c], [c, len(both[1])]])
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    values, column, times = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    shared = times > 1
    place = (np.cumsum(shared) - 1)[column]
    keep = shared[column]
    owner, place = owner[keep], place[keep]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    k, m = len(sets), len(both)
    out = np.zeros((k, m - k if others else k), np.float64)
    for a in range(0, int(shared.sum()), COLUMNS):
        i, j = np.searchsorted(place, [a, a + COLUMNS])
        x = np.zeros((m, COLUMNS), np.float32)
        x[owner[i:j], place[i:j] - a] = 1
        out += x[:k] @ (x[k:] if others else x).T
    out = out.astype(np.int64)
    if not others:
        out[np.arange(k), np.arange(k)] = [len(s) for s in sets]
    return out


def linked_pairs(sets: list[np.ndarray], percent: int, others: list[np.ndarray] | None = None) -> np.ndarray:
    """Which of all ``sets`` and ``others`` (none: one another) are linked."""
    common = common_counts(sets, others)
    n = np.array([len(s) for s in sets])
    m = np.array([len(s) for s in others]) if others else n
    return (common > 0) & (100 * common >= percent * (n[:, None] + m[None, :] - common))


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a partition that is sorted by ``keys``, one at a time (a group is bounded by its maker)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(n, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        new[0] = last is not None and first != last
        cuts = np.flatnonzero(new).tolist()
        begin = 0
        for cut in cuts:
            if cut > begin:
                held.append(batch.slice(begin, cut - begin))
            yield pa.Table.from_batches(held)
            held, begin = [], cut
        held.append(batch.slice(begin))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


EDGES = "a bigint, b bigint"


def _edges(rep: np.ndarray, pairs: list[tuple[int, int]]) -> np.ndarray:
    return rep[np.array(pairs, np.int64).reshape(-1, 2)]


def _edge_batches(found: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for e in found:
        if len(e):
            held.append(e)
            n += len(e)
        if n >= 1 << 16:
            rows = np.concatenate(held)
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["a", "b"])
            held, n = [], 0
    if held:
        rows = np.concatenate(held)
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["a", "b"])


def _dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys)


def regions(classes: DataFrame) -> DataFrame:
    """``p, t, rep, n``: the region of each tree t that a representative shares with others, and its size."""
    rows = classes.select("rep", F.posexplode("prefixes").alias("t", "p"))
    sizes = rows.groupBy("p").agg(F.count("*").alias("n")).where("n > 1")
    return materialize(rows.join(sizes, "p"))


def sub_regions(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rep, q``: the part of one of its larger regions in which a representative is met first.

    Depth grows region by region, by one more number for each part that is over a block.
    """
    own = rows.where(F.col("n") > BLOCK).groupBy("rep").agg(F.min(F.struct("p", "t")).alias("r")).select("rep", "r.*")
    depths = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.substring("signature", F.col("t") * DEPTH + 1, F.lit(d)).alias("s")) for d in range(FIRST_DEPTH + 1, DEPTH + 1)]))
    parts = own.join(classes.select("rep", "signature"), "rep").select("rep", "p", depths.alias("at")).select("rep", "at.d", F.xxhash64("p", "at.s").alias("q"))
    sizes = parts.groupBy("q").agg(F.count("*").alias("n"))
    # The first depth at which the part fits a block, else the last depth.
    return parts.join(sizes, "q").groupBy("rep").agg(F.min(F.struct(((F.col("n") > BLOCK) & (F.col("d") < DEPTH)).alias("over"), "d", "q"))["q"].alias("q"))


def family_edges(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that join the representatives of each region to families."""
    least = _least_agreement(percent)

    def run(batches):
        def found():
            for g in grouped(batches, ["p"]):
                rep, n = g.column("rep").to_numpy(), g.column("n_shingles").to_numpy()
                sig = np.frombuffer(b"".join(g.column("signature").to_pylist()), np.uint8).reshape(-1, HASHES)

                def near(i, others):
                    near_ = 100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i])
                    near_[near_] = (sig[others[near_]] == sig[i]).sum(axis=1) >= least
                    return near_

                yield _edges(rep, spanning_forest(len(rep), near))

        yield from _edge_batches(found())

    ship(rows.sparkSession)
    small = rows.where(F.col("n") <= BLOCK).select("p", "rep").join(classes.select("rep", "n_shingles", "signature"), "rep")
    small = _dealt(small.select("p", "rep", "n_shingles", "signature"), ["p"]).mapInArrow(run, EDGES)
    large = rows.where(F.col("n") > BLOCK)
    first = large.groupBy("p").agg(F.min("rep").alias("a"))
    whole = large.join(first, "p").where("rep <> a").select("a", F.col("rep").alias("b"))
    return small.unionByName(whole)


def sets_of(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """The columns of ``members`` and the sorted shingle hashes of each one's whole text."""
    names = [f.name for f in members.schema.fields]
    wanted = texts(docs).join(members.hint("shuffle_hash"), F.col("doc_id") == F.col("rep")).groupBy(*names).agg(F.min("text").alias("text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema.fields) + ", hashes binary"

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        h, at = shingle_sets(*byte_buffer(batch.column("text")), size)
        raw = h.astype("<u8").tobytes()
        out = [raw[8 * i : 8 * j] for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(out, pa.binary())], [*names, "hashes"])

    return map_blocks(wanted, block, schema)


def _sets(g: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u8") for x in g.column("hashes").to_pylist()]


def block_links(rows: DataFrame, percent: int) -> DataFrame:
    """Links of a spanning forest of each (family, block)."""

    def run(batches):
        def found():
            for g in grouped(batches, ["family", "k"]):
                linked = linked_pairs(_sets(g), percent)
                yield _edges(g.column("rep").to_numpy(), spanning_forest(len(linked), lambda i, others: linked[i, others]))

        yield from _edge_batches(found())

    ship(rows.sparkSession)
    return _dealt(rows.select("family", "k", "rep", "hashes"), ["family", "k"]).mapInArrow(run, EDGES)


def cross_links(rows: DataFrame, percent: int) -> DataFrame:
    """Links of a spanning forest between different components ``c`` of the two blocks of each (family, i, j)."""

    def run(batches):
        def found():
            for g in grouped(batches, ["family", "i", "j"]):
                rep, c, k = (g.column(x).to_numpy() for x in ("rep", "c", "k"))
                own = k == g.column("i").to_numpy()
                sets = _sets(g)
                one, two = np.flatnonzero(own), np.flatnonzero(~own)
                linked = np.zeros((len(rep), len(rep)), bool)
                if len(two):
                    linked[np.ix_(one, two)] = linked_pairs([sets[x] for x in one], percent, [sets[x] for x in two])
                    linked |= linked.T
                elif len(one) > 1:
                    linked = linked_pairs(sets, percent)
                linked &= c[:, None] != c[None, :]
                yield _edges(rep, spanning_forest(len(rep), lambda i, others: linked[i, others]))

        yield from _edge_batches(found())

    ship(rows.sparkSession)
    return _dealt(rows.select("family", "i", "j", "rep", "c", "k", "hashes"), ["family", "i", "j"]).mapInArrow(run, EDGES)


def _blocks(n, shingles) -> F.Column:
    return F.greatest(F.ceil(n / BLOCK), F.ceil(shingles / SHINGLES)).cast("int")


def large_family_links(sets: DataFrame, links: DataFrame, percent: int) -> DataFrame | None:
    """What links different components of families of several blocks, over all their pairs (none: each is one component)."""
    joined = connected_components(links)
    rows = sets.where("m > 1").select("family", "rep", F.octet_length("hashes").alias("bytes"))
    rows = rows.join(joined.select(F.col("node").alias("rep"), F.col("component").alias("c")), "rep", "left").withColumn("c", F.coalesce("c", "rep"))
    rows = materialize(rows)
    release(joined)
    parts = rows.groupBy("family", "c").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    main = F.max(F.struct("n", "c", "bytes")).alias("main")
    whole = parts.groupBy("family").agg(main, F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).where("n > main.n")
    blocks = whole.select(
        "family", F.col("main.c").alias("main"),
        _blocks(F.col("n") - F.col("main.n"), (F.col("bytes") - F.col("main.bytes")) / 8).alias("m_rest"),
        _blocks(F.col("main.n"), F.col("main.bytes") / 8).alias("m_main"),
    )
    blocks = materialize(blocks)
    if blocks.isEmpty():
        release(rows, blocks)
        return None
    rows = rows.join(blocks, "family")
    dealt = lambda m: F.pmod(F.xxhash64("rep"), m).cast("int")
    rows = rows.withColumn("k", F.when(F.col("c") == F.col("main"), F.col("m_rest") + dealt(F.col("m_main"))).otherwise(dealt(F.col("m_rest"))))
    meets = F.expr("transform(sequence(0, if(k < m_rest, m_rest + m_main, m_rest) - 1), x -> struct(least(k, x) as i, greatest(k, x) as j))")
    rows = rows.join(sets.select("rep", "hashes"), "rep").select("family", "rep", "c", "k", "hashes", F.explode(meets).alias("at"))
    return cross_links(rows.select("family", "rep", "c", "k", "hashes", "at.*"), percent)


def first_blocks(sets: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``family, k, rep, hashes``: the documents of larger families in blocks, each with the family's pivots."""
    large = sets.where("m > 1")
    scores = rows.groupBy("rep").agg(F.sum("n").alias("score"))
    order = Window.partitionBy("family").orderBy(F.col("score").desc(), "rep")
    pivots = large.select("family", "rep").join(scores, "rep").withColumn("place", F.row_number().over(order)).where(F.col("place") <= PIVOTS).select("family", "rep")
    own = large.select("family", "rep", "m", F.octet_length("hashes").alias("bytes")).join(sub_regions(rows, classes), "rep", "left")
    own = own.withColumn("k", F.pmod(F.coalesce("q", F.xxhash64("rep")), F.col("m")).cast("int"))
    # Parts that fell into one block, or a part that depth can't split, are dealt on by their doc_ids.
    parts = own.groupBy("family", "k").agg(F.ceil(_blocks(F.count("*"), F.sum("bytes") / 8) / 2).cast("int").alias("parts"))
    own = own.join(parts, ["family", "k"])
    own = materialize(own.select("family", "rep", (F.col("k") + F.col("m") * F.pmod(F.xxhash64("rep"), F.col("parts"))).cast("bigint").alias("k")))
    meets = own.select("family", "k").distinct().join(pivots, "family")
    placed = own.unionByName(meets.select("family", "rep", "k")).distinct()
    return placed.join(sets.select("rep", "hashes"), "rep").select("family", "k", "rep", "hashes")


def all_links(classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame | None:
    """Links (a, b) that join the representatives to their components (none: no two are alike)."""
    rows = regions(classes)
    edges = materialize(family_edges(rows, classes, percent))
    families = connected_components(edges).withColumnsRenamed({"node": "rep", "component": "family"})
    release(edges)
    if families.isEmpty():
        return None
    weight = families.join(classes.select("rep", "n_shingles"), "rep")
    sizes = weight.groupBy("family").agg(_blocks(F.count("*"), F.sum("n_shingles")).alias("m"))
    sets = materialize(sets_of(docs, families.join(sizes, "family"), size))
    dealt = sets.where("m = 1").select("family", F.lit(0).cast("bigint").alias("k"), "rep", "hashes")
    large = not sets.where("m > 1").isEmpty()
    if large:
        dealt = dealt.unionByName(first_blocks(sets, rows, classes))
    links = materialize(block_links(dealt, percent))
    more = large_family_links(sets, links, percent) if large else None
    if more is not None:
        links = materialize(links.unionByName(more))
    release(rows, sets)
    return links


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per document."""
    base = materialize(signed(docs, size))
    one = lambda c: F.min_by(c, "doc_id").alias(c)
    classes = base.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("rep"), *[one(c) for c in ("n_shingles", "signature", "prefixes")])
    classes = materialize(classes.where("rep is not null"))
    links = all_links(classes, docs, size, percent)
    out = base.select("doc_id", "n_shingles", "set_key")
    label = classes.select("set_key", "rep")
    joined = None
    if links is None:
        label = label.withColumn("component_id", F.col("rep"))
    else:
        joined = connected_components(links)
        label = label.join(joined.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component_id", F.coalesce("component", "rep"))
    out = out.join(label.select("set_key", "component_id"), "set_key", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.coalesce(component, F.col("doc_id"))
    out = materialize(out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")))
    release(base, classes, links, joined)
    return out


def deduplicate(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates (the smallest doc_id); all its columns."""
    name = fresh(docs, "kept_id")
    kept = near_duplicates(docs, size, percent).where("kept").select(F.col("doc_id").alias(name)).distinct()
    one = docs.join(kept.hint("shuffle_hash"), docs["doc_id"] == kept[name], "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.where(F.col("doc_id").isNull()))
