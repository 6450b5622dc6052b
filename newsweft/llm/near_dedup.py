"""Near-duplicate documents by a chosen-path set similarity join.

Documents of one word sequence are one class. In each of ``TREES`` independent
trees a class follows its minwise tokens: at the root it goes to the child of
its minwise shingle under the tree's first coordinate; a child of more than
``NODE`` classes branches again, under coordinates chosen by its path: under one
the first time, which shows whether it shrinks, then under one or two (1.5 on
average, so a pair at the threshold is expected to share 1.2 children a level).
Nodes of at most ``NODE`` classes are compared exhaustively by their signatures; each
group of likely neighbours is then linked on full shingle sets. A large node
that keeps STUCK of its parent, or is still large at the last level, holds near
copies of each other: its members are linked to its first one, and those that
do not link are compared with all the others, block by block. So no pair that
shares a node is lost.

Branching must not lose pairs as it goes deeper: of 4000 simulated pairs at 0.8
all 24 trees miss 1 at the last level, LEVELS + 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .components import connected_components
from .scratch import free, persist, sweep
from . import units as un
from .units import trim
from .words import Words, mix, window_starts, windows

SHINGLE = 4
PERCENT = 80
TREES = 24
#: Minwise coordinates of a signature; a tree starts at a coordinate of its own.
COORDINATES = 64
NODE = 2000
LEVELS = 8
#: A large node with more than this share of its parent is not branched again: near copies follow each other down any path.
STUCK = 0.75
#: Rows of one node or class are dealt over so many tasks where they meet their size or label.
SALTS = 8
#: Equal coordinates of a likely pair: a pair at 0.8 has fewer with probability 2e-7.
LIKELY = 34
_COEFFICIENTS = np.random.Generator(np.random.PCG64(97)).integers(1, 1 << 31, (2, COORDINATES), dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(texts: list[bytes | None], k: int = SHINGLE) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words; distinct shingle hashes of all texts, sorted within each; where each text's start."""
    w = Words(texts, lower=True)
    at = window_starts(w.bounds, k)
    text = np.searchsorted(w.bounds, at, "right") - 1
    h = mix(windows(w.hashes, k)[at]) if len(at) else np.empty(0, np.uint64)
    few = np.flatnonzero((w.counts > 0) & (w.counts < k))
    if len(few):  # the whole sequence is the shingle
        h = np.concatenate([h, np.array([_sequence(w.hashes[w.bounds[i] : w.bounds[i + 1]]) for i in few], np.uint64)])
        text = np.concatenate([text, few])
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    h, text = h[new], text[new]
    return w, h, np.searchsorted(text, np.arange(len(texts) + 1))


def _sequence(h: np.ndarray) -> int:
    out = len(h)
    for x in h.tolist():
        out = (out * 0x9E3779B97F4A7C15 + x) & 0xFFFFFFFFFFFFFFFF
    return int(mix(np.array([out ^ 0x5851F42D4C957F2D], np.uint64))[0])


def _class_keys(w: Words) -> np.ndarray:
    """64 bits of each text's word sequence."""
    power = np.multiply.accumulate(np.append(np.uint64(1), np.full(max(0, int(w.counts.max(initial=1)) - 1), 0xD1342543DE82EF95, np.uint64)))
    at = np.arange(len(w.hashes)) - np.repeat(w.bounds[:-1], w.counts)
    sums = np.append(np.uint64(0), np.cumsum(mix(w.hashes ^ np.uint64(0xAF251AF3B0F025B5)) * power[at]))
    return mix(sums[w.bounds[1:]] - sums[w.bounds[:-1]] + w.counts.astype(np.uint64)).view(np.int64)


def signatures(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """COORDINATES minwise values of each text's set; all ones for an empty set."""
    out = np.full((len(bounds) - 1, COORDINATES), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        low = (h >> np.uint64(32)).astype(np.uint32)
        for c in range(COORDINATES):
            v = (low ^ _COEFFICIENTS[0, c]) * _COEFFICIENTS[1, c]
            v ^= v >> np.uint32(15)
            v *= np.uint32(0x2C1B3C6D)
            out[some, c] = np.minimum.reduceat(v, bounds[:-1][some])
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def classes(units: DataFrame, shingle: int) -> DataFrame:
    """``row, id, cls, n_shingles, signature`` of every row, written once; ``row`` is the row's unit and place, ``cls`` hashes the word sequence."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, rows, _ in un.each_unit(batches):
            first = (unit >> 32 << 44) | ((unit & 0xFFFFFFFF) << 24)
            ids, texts = rows.field("id"), un.texts_of(rows, "text")
            for at in range(0, len(texts), 1000):
                w, h, bounds = shingle_sets(texts[at : at + 1000], shingle)
                n = len(w.counts)
                yield pa.RecordBatch.from_arrays([pa.array(first + at + np.arange(n)), ids.slice(at, n), pa.array(_class_keys(w)), pa.array(np.diff(bounds), pa.int64()), _binary(signatures(h, bounds))],
                                                 names=["row", "id", "cls", "n_shingles", "signature"])

    return persist(units.mapInArrow(work, "row long, id long, cls long, n_shingles long, signature binary"), "classes")


def _salt(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SALTS)).cast("int").alias("salt")


def _roots(reps: DataFrame, trees: int) -> DataFrame:
    """``path, rep, was`` of the first level."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(-1, COORDINATES)
            for t in range(trees):
                path = mix(sig[:, t % COORDINATES].astype(np.uint64) + (np.uint64(t + 1) << np.uint64(32))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(path), b.column(0), pa.nulls(b.num_rows, pa.int64())], names=["path", "rep", "was"])
        trim()

    return reps.select("rep", "signature").mapInArrow(work, NODE_ROW)


def _branch(big: DataFrame, level: int) -> DataFrame:
    """Children of nodes: the minwise token under a coordinate chosen by the node's path; from level 1 on, in half of the nodes also under a second one."""
    also = 0 if level == 0 else 4

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint32).reshape(-1, COORDINATES)
            path = b.column(0).to_numpy().view(np.uint64)
            pick = mix(path)
            c = (pick % np.uint64(COORDINATES)).astype(np.int64)
            second = (c + 1 + ((pick >> np.uint64(16)) % np.uint64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
            for k, at in enumerate((c, second)):
                use = np.flatnonzero((pick >> np.uint64(40)) % np.uint64(8) < also) if k else np.arange(len(path))
                child = mix((path ^ mix(sig[np.arange(len(path)), at] + np.uint64(1))) + np.uint64(k))[use].view(np.int64)
                rows = pa.array(use)
                yield pa.RecordBatch.from_arrays([pa.array(child), b.column(1).take(rows), b.column(2).take(rows)], names=["path", "rep", "was"])
        trim()

    return big.select("path", "rep", F.col("n").alias("was"), "signature").mapInArrow(work, NODE_ROW)


NODE_ROW = "path long, rep long, was long"


def _sized(nodes: DataFrame) -> DataFrame:
    """Nodes of two and more with their size ``n``; a large node's rows meet it in SALTS tasks."""
    salted = nodes.withColumn("salt", _salt("rep"))
    parts = salted.groupBy("path", "salt").agg(F.count(F.lit(1)).alias("n"))
    sizes = parts.groupBy("path").agg(F.sum("n").alias("n"), F.collect_list("salt").alias("salts")).filter("n > 1")
    return salted.join(sizes.select("path", "n", F.explode("salts").alias("salt")), ["path", "salt"]).drop("salt")


def _by_group(df: DataFrame, schema: str, one) -> DataFrame:
    """Apply ``one(columns of a group)`` to groups of ``path``, each whole in one task; groups are at most 2 * NODE rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            paths = b.column(0).to_numpy()
            cut = [0, *(np.flatnonzero(paths[1:] != paths[:-1]) + 1).tolist(), len(paths)]
            for a, z in zip(cut, cut[1:]):
                if a == z:
                    continue
                if held and paths[a] != last:
                    yield from one(pa.Table.from_batches(held))
                    held = []
                last = paths[a]
                held.append(b.slice(a, z - a))
        if held:
            yield from one(pa.Table.from_batches(held))
        trim()

    return df.repartition(F.col("path")).sortWithinPartitions("path").mapInArrow(work, schema)


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each of n places is linked to."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
    return label


GROUP = "path long, members array<long>"


def _likely(t: pa.Table, least: int = LIKELY) -> Iterator[pa.RecordBatch]:
    """Groups of a node's classes that are linked by likely pairs, each once whatever its node."""
    reps, place = np.unique(t.column("rep").to_numpy(), return_index=True)
    sig = np.frombuffer(b"".join(t.column("signature").take(pa.array(place)).to_pylist()), np.uint32).reshape(-1, COORDINATES)
    n, a, b = len(reps), [], []
    for i in range(0, n, 128):
        same = np.zeros((min(128, n - i), n - i), np.int16)
        for c in range(COORDINATES):
            same += sig[i : i + 128, c, None] == sig[None, i:, c]
        x, y = np.nonzero(same >= least)
        a.append(x[x < y] + i)
        b.append(y[x < y] + i)
    label = _components(n, np.concatenate(a), np.concatenate(b))
    order = np.argsort(label, kind="stable")
    groups = [g for g in np.split(order, np.flatnonzero(np.diff(label[order])) + 1) if len(g) > 1]
    if groups:
        members = [np.sort(reps[g]) for g in groups]
        keys = [int(np.bitwise_xor.reduce(mix(m.view(np.uint64) + np.uint64(len(m)))).view(np.int64)) for m in members]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(members, pa.list_(pa.int64()))], names=["path", "members"])


def linked(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    """The exact rule on two sorted sets."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return len(x) > 0 and len(y) > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _links(percent: int):
    def one(t: pa.Table) -> Iterator[pa.RecordBatch]:
        """Spanning links of a group on full sets, counted over an inverted index; equal pairs are not all written."""
        reps, place = np.unique(t.column("rep").to_numpy(), return_index=True)
        sets = [np.frombuffer(x, np.uint64) for x in t.column("shingles").take(pa.array(place)).to_pylist()]
        n, size = len(reps), np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(n), size)
        tokens = np.unique(np.concatenate(sets), return_inverse=True)[1]
        order = np.argsort(tokens, kind="stable")
        posting = owner[order]
        first = np.searchsorted(tokens[order], np.arange(tokens.max() + 2))
        at = np.concatenate([[0], np.cumsum(size)])
        parent = list(range(n))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        a, b = [], []
        for i in range(n):
            own = tokens[at[i] : at[i + 1]]
            count = first[own + 1] - first[own]
            total = np.cumsum(count)
            hits = posting[np.repeat(first[own] - total + count, count) + np.arange(total[-1] if len(total) else 0)]
            both = np.bincount(hits, minlength=n)
            for j in np.flatnonzero(100 * both >= percent * (size[i] + size - both)):
                j = int(j)
                if j > i and root(i) != root(j):
                    parent[root(j)] = root(i)
                    a.append(reps[i])
                    b.append(reps[j])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return one


def _by_unit(rows: DataFrame, pick: Column) -> DataFrame:
    """``unit_id, picks`` of rows numbered by ``row``; at most a unit's rows in one."""
    unit = F.shiftleft(F.shiftright("row", 44), 32) + F.shiftright("row", 24).bitwiseAND((1 << 20) - 1)
    return rows.select(unit.alias("unit_id"), pick.alias("p")).groupBy("unit_id").agg(F.collect_list("p").alias("picks"))


def _sets_of(units: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``rep, shingles`` of the wanted ``rep, row``, from whole texts; written once. Only the wanted rows' numbers move, units are bucketed."""
    picks = _by_unit(wanted, F.struct(F.col("row").bitwiseAND((1 << 24) - 1).cast("int").alias("nth"), "rep"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, more in un.each_unit(batches):
            at = pa.array([p["nth"] for p in more["picks"]], pa.int64())
            _, h, bounds = shingle_sets(rows.field("text").take(at).cast(pa.binary()).to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([pa.array([p["rep"] for p in more["picks"]], pa.int64()), pa.array([h[x:y].tobytes() for x, y in zip(bounds, bounds[1:])], pa.binary())], names=["rep", "shingles"])

    return persist(units.join(picks, "unit_id").select("unit_id", "rows", "picks").mapInArrow(work, "rep long, shingles binary"), "sets")


def _groups(likely: DataFrame, node: int) -> DataFrame:
    """``path, rep``: classes to compare with each other.

    All that likely pairs of any node connect is one group, so a class's set
    moves once; where that is more than ``node`` classes, the nodes' own groups are kept.
    """
    star = likely.select(F.col("members")[0].alias("a"), F.explode("members").alias("b"))
    comp = persist(connected_components(star), "likely-components")
    sizes = comp.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    whole = comp.join(sizes.filter(F.col("n") <= node), "component").select(F.col("component").alias("path"), F.col("node").alias("rep"))
    large = comp.join(sizes.filter(F.col("n") > node), "component").select("node")
    parts = likely.join(large, F.col("members")[0] == F.col("node"), "left_semi").select("path", F.explode("members").alias("rep"))
    return persist(whole.unionByName(parts), "groups")


def _labels(units: DataFrame, cls: DataFrame, shingle: int, percent: int, trees: int, node: int, levels: int) -> DataFrame:
    """``cls, row, salts, least``: of each class its first row (by id), the salts of its rows, and the first ``struct<id, row>`` of its component."""
    spark = units.sparkSession
    usable = cls.filter("n_shingles > 0 AND id IS NOT NULL")
    lows = usable.groupBy("cls").agg(F.min(F.struct("id", "row")).alias("low"), F.collect_set(_salt("row")).alias("salts"))
    lows = persist(lows.select("cls", "low", F.col("low.row").alias("row"), "salts"), "class-lows")
    sigs = persist(lows.select("cls", "row").join(usable.select("row", "signature"), "row").select(F.col("cls").alias("rep"), "signature"), "signatures")

    nodes = persist(_sized(_roots(sigs, trees)), "nodes")
    written, leaves, stuck = [nodes], [nodes.filter(F.col("n") <= node)], []
    for level in range(levels + 1):
        large = nodes.filter(F.col("n") > node)
        held = F.coalesce(F.col("n") > STUCK * F.col("was"), F.lit(False)) if level < levels else F.lit(True)
        stuck.append(large.filter(held))
        big = large.filter(~held)
        if level == levels or big.isEmpty():
            break
        nodes = persist(_sized(_branch(big.join(sigs, "rep"), level)), "nodes")
        written.append(nodes)
        leaves.append(nodes.filter(F.col("n") <= node))
    small, rest = leaves[0], stuck[0]
    for x in leaves[1:]:
        small = small.unionByName(x)
    for x in stuck[1:]:
        rest = rest.unionByName(x)
    rest = persist(rest.select("path", "rep", "n"), "large-nodes")
    small = small.select("path", "rep").join(sigs, "rep").select("path", "rep", "signature")
    likely = persist(_by_group(small, GROUP, _likely).dropDuplicates(["path"]), "likely")
    free(sigs, *written)
    sweep(spark)
    members = _groups(likely, node)

    oversize = not rest.isEmpty()
    wanted = members.select("rep").unionByName(rest.select("rep")).distinct() if oversize else members.select("rep").distinct()
    sets = _sets_of(units, wanted.join(lows, F.col("rep") == F.col("cls")).select("rep", "row"), shingle)

    def link(m: DataFrame) -> DataFrame:
        return persist(_by_group(m.select("path", "rep").join(sets, "rep").select("path", "rep", "shingles"), "a long, b long", _links(percent)).distinct(), "links")

    links = link(members)
    if oversize:
        links = links.unionByName(_link_oversize(rest, links, link, node))
    found = connected_components(links)
    free(sets)
    sweep(spark)
    named = found.join(lows.select(F.col("cls").alias("node"), "low"), "node")
    least = named.groupBy("component").agg(F.min("low").alias("least"))
    label = named.join(least, "component").select(F.col("node").alias("cls"), "least")
    return lows.join(label, "cls", "left").select("cls", "row", "salts", F.coalesce("least", "low").alias("least"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
                    trees: int = TREES, node: int = NODE, levels: int = LEVELS) -> DataFrame:
    """Group documents linked by 100 * common shingles >= percent * all shingles of both.

    Returns ``id_col, n_shingles, component_id, kept``, a row for each row;
    other columns, whatever their names, are not read. Null or wordless text has
    no shingles and is linked with nothing. Repeated rows are one class and get
    the same values. Two texts under one id are grouped apart. A row without an
    id is kept, in no component. Ties need no rule: a component's id is its
    smallest. Texts of any length are compared whole, as one set each. An empty
    table gives an empty one. Ids are integers.
    """
    ship(docs.sparkSession)
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    units = un.stage(named, "text")
    cls = classes(units, shingle)
    label = _labels(units, cls, shingle, percent, trees, node, levels).select("cls", F.explode("salts").alias("salt"), F.col("least.id").alias("label"))
    out = cls.select("id", "cls", "n_shingles", _salt("row")).join(label, ["cls", "salt"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("label")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), (F.col("id").isNull() | (F.col("id") == component)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
                         trees: int = TREES, node: int = NODE, levels: int = LEVELS) -> DataFrame:
    """All columns of the first row, by id, of each group of near duplicates; the other rows go.

    Rows count one by one: of repeated rows one stays, and of two texts under
    one id either may stay. Rows without an id or without words are in no group
    and stay. Only row numbers move; texts are read where they were staged.
    """
    ship(docs.sparkSession)
    units = un.stage(docs, text_col)
    plain = F.transform("rows", lambda r: F.struct(r[id_col].cast("long").alias("id"), r[text_col].cast("string").alias("text")))
    narrow = units.select("unit_id", plain.alias("rows"))
    cls = classes(narrow, shingle)
    label = _labels(narrow, cls, shingle, percent, trees, node, levels)
    first = label.filter(F.col("row") == F.col("least.row")).select("row")
    alone = cls.filter("n_shingles = 0 OR id IS NULL").select("row")
    picks = _by_unit(first.unionByName(alone), F.col("row").bitwiseAND((1 << 24) - 1).cast("int"))

    names = docs.columns

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, more in un.each_unit(batches):
            kept = rows.take(pa.array(sorted(more["picks"]), pa.int64()))
            yield pa.RecordBatch.from_arrays(kept.flatten(), names=names)

    return units.join(picks, "unit_id").select("unit_id", "rows", "picks").mapInArrow(take, docs.schema)


def _link_oversize(rest: DataFrame, links: DataFrame, link, node: int) -> DataFrame:
    """Links within nodes that no branching made small, without comparing all their pairs.

    Members are dealt into blocks and compared there and with the node's first
    member, which every block has: a row a member. Those that then are not in the
    first member's component are compared with every block.
    """
    block = lambda c, n: F.pmod(F.xxhash64(c, F.lit(7)), F.ceil(n / node))
    nodes = rest.groupBy("path").agg(F.min("rep").alias("first"), F.max("n").alias("n"))
    blocks = nodes.select(F.col("path").alias("p"), F.col("first").alias("rep"), F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / node) - 1)).alias("block"))
    dealt = rest.select(F.col("path").alias("p"), "rep", block(F.col("rep"), F.col("n")).alias("block"))
    once = link(dealt.unionByName(blocks).select(F.xxhash64("p", "block").alias("path"), "rep").distinct())
    all_links = links.unionByName(once)
    comp = persist(connected_components(all_links), "components")
    of = comp.select(F.col("node").alias("rep"), "component")
    heads = nodes.join(of.withColumnRenamed("rep", "first").withColumnRenamed("component", "head"), "first", "left").select("path", F.coalesce("head", "first").alias("head"))
    left = rest.join(of, "rep", "left").join(heads, "path").filter(F.coalesce("component", "rep") != F.col("head")).select("path", "rep", "n")
    left = persist(left, "residual")
    sizes = left.groupBy("path").agg(F.count(F.lit(1)).alias("k"))
    many = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(n / node) - 1))
    one = left.join(sizes, "path").select(F.col("path").alias("p"), "rep", block(F.col("rep"), F.col("k")).alias("i"), many(F.col("n")).alias("j"))
    other = rest.join(sizes, "path").select(F.col("path").alias("p"), "rep", many(F.col("k")).alias("i"), block(F.col("rep"), F.col("n")).alias("j"))
    return once.unionByName(link(one.unionByName(other).select(F.xxhash64("p", "i", "j").alias("path"), "rep").distinct()))
