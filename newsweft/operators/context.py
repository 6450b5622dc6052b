"""Scored context: for each article the few others of its day, or of the archive, that may tell the same event.

Rows of a group are dealt into few spans; a task compares two spans, so that a text is copied once a span of its group.
Spans travel as texts, whose grams are hashed and numbered in the task, as eight bytes for each of three grams a character are
some twenty times the text. Shared grams of all pairs are counted by bits: a gram is a row of bits, one for each of
64 * WORDS texts, and the rows of a text's grams are added up in binary, 64 texts a step. Of two texts, the rows are those of
the one with fewer grams, or of near as few. Pairs leave a task as they are found; where only the best partners count, no others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_key, truncate

BLOCK = 256
#: A group is one span, unless it has more than twice these rows or bytes; then spans have these at most. Of two tables the left one's spans have BLOCK * SPANS rows at most.
SPANS, SPAN_ROWS, SPAN_BYTES = 4, 10240, 28 << 20
#: Words of a gram's bits, texts added up at once, and the grams, bytes of bits and grams of added texts that a task may hold.
WORDS, ADDED, GRAMS, BITS, CELLS = 16, 512, 1 << 23, 80 << 20, 8 << 20
#: Grams looked up at once.
CHUNK = 1 << 15
#: Partners found before the best are picked.
POOL = 400_000
#: What a similarity in single precision may be off by, at most.
SLACK, MILLION = 1e-5, 1_000_000
#: Points of what is equal, of similarity, the least similarity that counts, items and characters of a context.
POINTS = {"url": 100.0, "dup": 80.0, "title": 60.0}
REASONS = {"url": "url_exact", "dup": "duplicate_key_exact", "title": "title_exact"}
FACTOR, LEAST, ITEMS, CHARACTERS = 40.0, 0.18, 6, 2600
#: Characters kept of an item's fields.
HEADLINE, SUMMARY, DUP, URL = 180, 320, 160, 220


def hashed_grams(s: str | None, sizes: tuple[int, ...] = (3, 4, 5)) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct character grams."""
    codes = np.frombuffer((s or "").encode("utf-32-le"), np.uint32).astype(np.uint64)
    out, h = [], np.full(len(codes), 1, np.uint64)
    for k in range(min(max(sizes), len(codes))):
        h = h[: len(codes) - k] ^ codes[k:]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if k + 1 in sizes:
            out.append(h)
    return _distinct(np.concatenate(out)) if out else np.empty(0, np.uint64)


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def _packed(codes: np.ndarray) -> np.ndarray:
    """A text's distinct grams of 3, 4 and 5 characters, of 12 bits each; ``codes`` of characters are from 1 to 4095."""
    if len(codes) < 3:
        return np.empty(0, np.uint64)
    c = np.concatenate([codes, np.zeros(2, np.uint64)])
    two = c[:-1] << np.uint64(12) | c[1:]
    five = _distinct((two[:-3] << np.uint64(24) | two[2:-1]) << np.uint64(12) | c[4:])
    out = [five[five & np.uint64(0xFFF) > 0]]
    for ends in (12, 24):  # those in front of the last characters, in the same order
        x = five >> np.uint64(ends)
        new = np.ones(len(x), bool)
        np.not_equal(x[1:], x[:-1], out=new[1:])
        x = x[new & (x & np.uint64(0xFFF) > 0)]
        out.append(x << np.uint64(ends))
    return np.concatenate(out) * np.uint64(0x9E3779B97F4A7C15)  # each a number of its own, spread over 64 bits


def _numbers(texts: list[str], most: int) -> list[np.ndarray] | None:
    """Numbers from 1 of each text's distinct grams, equal for equal grams; None if there are more than ``most``."""
    seen = np.zeros(0x110000, bool)
    for t in texts:
        seen[np.frombuffer(t.encode("utf-32-le"), np.uint32)] = True
    code = np.cumsum(seen).astype(np.uint64)
    of = hashed_grams if code[-1] > 4095 else lambda t: _packed(code[np.frombuffer(t.encode("utf-32-le"), np.uint32)])
    known, number, out = np.empty(0, np.uint64), np.empty(0, np.int32), []
    start, shift = np.zeros(1, np.int32), np.uint64(63)
    for first in range(0, len(texts), 2 * BLOCK):
        grams = [of(t) for t in texts[first : first + 2 * BLOCK]]
        flat = np.concatenate(grams)
        own = np.zeros(len(flat), np.int32)
        for k in range(0, len(flat) if len(known) else 0, CHUNK):  # a table on first bits says where to begin
            each = flat[k : k + CHUNK]
            place = np.minimum(start[(each >> shift).astype(np.int64)], len(known) - 1)
            at = known[place]
            own[k : k + CHUNK] = np.where(at == each, number[place], 0)
            left = np.flatnonzero((at < each) & (place < len(known) - 1))
            while len(left):
                place[left] += 1
                at = known[place[left]]
                hit = left[at == each[left]]
                own[k + hit] = number[place[hit]]
                left = left[(at < each[left]) & (place[left] < len(known) - 1)]
        left = np.flatnonzero(own == 0)
        if len(left):
            found = _distinct(flat[left])
            new = np.arange(len(known) + 1, len(known) + 1 + len(found), dtype=np.int32)
            own[left] = new[np.searchsorted(found, flat[left])]
            at = np.searchsorted(known, found)
            known, number = np.insert(known, at, found), np.insert(number, at, new)
            if len(known) > most:
                return None
            width = min(22, len(known).bit_length() + 2)
            shift = np.uint64(64 - width)
            start = np.concatenate([[0], np.cumsum(np.bincount((known >> shift).astype(np.int64), minlength=1 << width))]).astype(np.int32)
        out += np.split(own, np.cumsum([len(g) for g in grams])[:-1])
    return out


def _ranked(grams: list[np.ndarray]) -> int:
    """Gives ``grams`` new numbers, the commonest first, so that texts use the same rows of bits at the same time; how many rows these are."""
    times = np.zeros(1 + max((int(g.max()) for g in grams if len(g)), default=0), np.int64)
    for g in grams:
        times[g] += 1
    rank = np.empty(len(times), np.int32)
    rank[1 + np.argsort(-times[1:])] = np.arange(1, len(times))
    for g in grams:
        g[:] = np.sort(rank[g])
    return len(times)


def _added(bits: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """For each column of ``steps``, how many of the rows of ``bits`` that it names have each bit set."""
    shape = steps.shape[1], bits.shape[1]
    free: list[np.ndarray] = []
    one: list[np.ndarray] = []
    two: list[np.ndarray | None] = []

    def add(x: np.ndarray, level: int) -> None:
        """``x`` counts 2 ** ``level`` in each bit; three of a level become one there and one above."""
        while True:
            if level == len(one):
                one.append(x)
                two.append(None)
                return
            if two[level] is None:
                two[level] = x
                return
            a, b, low = one[level], two[level], free.pop() if free else np.empty(shape, np.uint64)
            np.bitwise_xor(a, b, out=low)
            np.bitwise_and(a, b, out=a)
            np.bitwise_and(low, x, out=b)
            np.bitwise_or(a, b, out=a)
            np.bitwise_xor(low, x, out=low)
            one[level], two[level] = low, None
            free.extend((b, x))
            x, level = a, level + 1

    for step in steps:
        x = free.pop() if free else np.empty(shape, np.uint64)
        np.take(bits, step, axis=0, out=x, mode="clip")
        add(x, 0)
    level = 0
    while level < len(one):
        if two[level] is not None:
            add(np.zeros(shape, np.uint64), level)
        level += 1
    out = np.zeros((shape[0], shape[1] * 64), np.int32)
    for first in range(0, len(one), 8):
        byte = np.zeros(out.shape, np.uint8)
        for k, x in enumerate(one[first : first + 8]):
            each = np.unpackbits(x.view(np.uint8), axis=1, bitorder="little")
            each <<= np.uint8(k)
            byte |= each
        out |= byte.astype(np.int32) << first
    return out


def _spread(bits: np.ndarray, columns: list[np.ndarray]) -> None:
    """Bits of texts: a row for each gram by its number, a bit for each text; row 0 is empty."""
    bits.fill(0)
    flat, words = bits.reshape(-1), bits.shape[1]
    for k in range(min(64, len(columns))):
        part = columns[k::64]
        at = np.concatenate(part).astype(np.int64) * words + np.repeat(np.arange(len(part)), [len(c) for c in part])
        flat[at] |= np.uint64(1 << k)


def _cut(size: np.ndarray, order: np.ndarray, most: int) -> list[np.ndarray]:
    """``order``, which is by size, in blocks of at most ``most`` rows whose sizes are not too far apart, or too large together."""
    out, first = [], 0
    while first < len(order):
        n = min(most, len(order) - first)
        while n > 64 and (size[order[first + n - 1]] > 1.5 * size[order[first]] + 64 or n * size[order[first + n - 1]] > CELLS):
            n //= 2
        out.append(order[first : first + n])
        first += n
    return out


def _tiles(key: np.ndarray, a: np.ndarray, b: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]]:
    """Rows, other rows, the numbers of grams they share and have, and whether both are of one block: for all pairs of ``a`` and ``b``, or within ``a``.

    Each pair comes once, but in one block, where each row meets itself and a pair comes in both directions.
    """
    both = a if b is None else np.concatenate([a, b])
    grams = _numbers([key[i] for i in both], GRAMS)
    if grams is None and len(both) > 2:
        halves = [[x[: len(x) // 2], x[len(x) // 2 :]] if x is not None else None for x in (a, b)]
        if b is None:
            tasks = [(halves[0][0], None), (halves[0][1], None), tuple(halves[0])]
        else:
            tasks = [(x, y) for x in halves[0] for y in halves[1]]
        for x, y in tasks:
            if len(x) and (y is None or len(y)):
                yield from _tiles(key, x, y)
        return
    if grams is None:
        grams = _numbers([key[i] for i in both], 1 << 62)
    size = np.array([len(g) for g in grams])
    total = _ranked(grams)
    bits = np.zeros((total, max(1, min(WORDS, BITS // (8 * total)))), np.uint64)
    width = 64 * bits.shape[1]
    by_size = lambda x: x[np.argsort(size[x], kind="stable")]
    sides = [by_size(np.arange(len(a)))] + ([by_size(np.arange(len(a), len(both)))] if b is not None else [])
    sides = [[x[k : k + width] for k in range(0, len(x), width)] for x in sides]
    for s, blocks in enumerate(sides):
        for k, block in enumerate(blocks):
            least = size[block[0]]
            adders = blocks[: k + 1] if b is None else [x for x in sides[1 - s] if size[x[0]] < least or (size[x[0]] == least and not s)]
            if adders:
                _spread(bits, [grams[i] for i in block])
            for more in adders:
                for rows in _cut(size, more, ADDED):
                    steps = np.zeros((len(rows), int(size[rows].max())), np.int32)
                    for i, row in enumerate(rows):
                        steps[i, : size[row]] = grams[row]
                    shared = _added(bits, np.ascontiguousarray(steps.T))[:, : len(block)]
                    yield both[rows], both[block], shared, size[rows], size[block], b is None and more is block


PAIR = "id long, other long, sim double, points double, reasons string"
SIDE = ["id", "key", "title", "url", "dup"]


def _blocks(df: DataFrame, group: str, name: str, spans: bool) -> DataFrame:
    """``df`` with its span and its group's number of them, without ``spans`` more and smaller ones; sizes are summed up before the shuffle."""
    n, size = F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("key") + F.octet_length("title")), F.lit(0))
    most = F.greatest(F.ceil(n / SPAN_ROWS), F.ceil(size / SPAN_BYTES))
    few = F.when((n <= 2 * SPAN_ROWS) & (size <= 2 * SPAN_BYTES), 1).otherwise(most)
    sizes = df.groupBy(group).agg((few if spans else F.greatest(F.ceil(n / (SPANS * BLOCK)), most)).cast("int").alias(f"{name}s"))
    return df.join(sizes, group).withColumn(name, F.pmod(F.xxhash64("id", F.lit(3)), F.col(f"{name}s")).cast("int"))
def _tasks(left: DataFrame, right: DataFrame | None, group: str) -> DataFrame:
    """``group, lo, hi``, ``SIDE`` and ``side``: the rows of each two spans, ``side`` being their own span's number, or 0 and 1 for two tables."""
    own = _blocks(left.select(group, *SIDE), group, "i", right is None)
    if right is None:
        tiles = own.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("is") - 1)))
        rows = tiles.select(group, F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), *SIDE, F.col("i").alias("side"))
    else:
        other = _blocks(right.select(group, *SIDE), group, "j", True)
        counts = lambda df, n: df.groupBy(group).agg(F.max(n).alias(n))
        one = own.join(counts(other, "js"), group).select(group, F.col("i").alias("lo"), F.explode(F.sequence(F.lit(0), F.col("js") - 1)).alias("hi"), *SIDE, F.lit(0).alias("side"))
        two = other.join(counts(own, "is"), group).select(group, F.explode(F.sequence(F.lit(0), F.col("is") - 1)).alias("lo"), F.col("j").alias("hi"), *SIDE, F.lit(1).alias("side"))
        rows = one.unionByName(two)
    # Tasks are long for their bytes, so they must not be put together by these.
    return rows.repartition(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), group, "lo", "hi")


def _read(batches: Iterator[pa.RecordBatch], same_table: bool) -> tuple[pa.Table, np.ndarray, np.ndarray | None]:
    """Rows of a task, and which of them are of the one side and of the other, which is None if they are of one span."""
    t = pa.Table.from_batches(list(batches))
    lo, hi, side = t["lo"][0].as_py(), t["hi"][0].as_py(), t["side"].to_numpy()
    first = side == (lo if same_table else 0)
    return t, np.flatnonzero(first), None if same_table and lo == hi else np.flatnonzero(~first)


def _near(shared: np.ndarray, size_i: np.ndarray, size_j: np.ndarray) -> np.ndarray:
    """Similarities, but for their last digits."""
    i, j = ((1 / np.maximum(s, 1)).astype(np.float32) for s in (size_i, size_j))
    out = np.maximum(i[:, None], j[None, :])
    out *= shared
    return out


def similar(left: DataFrame, group: str, least: float = LEAST) -> DataFrame:
    """``id, other, sim`` of rows of one group whose similarity is at least ``least``; smaller ids first, similarities to six digits, halves up."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, a, b = _read(batches, True)
        ids, key = t["id"].to_numpy(), t["key"].to_pylist()
        if b is not None and not (len(a) and len(b)):
            return
        for i, j, shared, size_i, size_j, within in _tiles(key, a, b):
            want = _near(shared, size_i, size_j) >= np.float32(least - SLACK)
            if within:
                want &= i[:, None] < j[None, :]
            p, q = np.nonzero(want)
            both, low = shared[p, q].astype(np.int64), np.minimum(size_i[p], size_j[q]).astype(np.int64)
            x, y = ids[i[p]], ids[j[q]]
            keep = (low > 0) & (both >= least * low - SLACK * low) & (x != y)
            keep[keep] = both[keep] / low[keep] >= least
            x, y, both, low = x[keep], y[keep], both[keep], low[keep]
            sim = (2 * MILLION * both + low) // (2 * low) / MILLION
            yield pa.record_batch([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(sim)], names=["id", "other", "sim"])

    rows = _tasks(left.withColumns({c: F.lit("") for c in ("title", "url", "dup")}), None, group)
    return rows.groupBy(group, "lo", "hi").applyInArrow(work, "id long, other long, sim double")


def _codes(t: pa.Table) -> dict[str, np.ndarray]:
    """Numbers that are equal for equal texts, however long; -1 for blank ones."""
    out = {}
    for name in POINTS:
        x = t[name].to_pandas()
        out[name] = np.where(x == "", -1, pd.factorize(x)[0])
    return out


def _equal(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal numbers that are not -1."""
    x_at, y_at = np.flatnonzero((x >= 0) & np.isin(x, y)), np.flatnonzero((y >= 0) & np.isin(y, x))
    i, j = np.nonzero(x[x_at][:, None] == y[y_at][None, :])
    return x_at[i], y_at[j]


def _best(x: pd.DataFrame, ids: np.ndarray, most: int) -> pd.DataFrame:
    """The ``most`` best partners of each row, by score and then smallest id."""
    x = x.iloc[np.lexsort((ids[x["other"]], -x["score"], x["row"]))]
    return x[x.groupby("row").cumcount() < most]


def pairs(left: DataFrame, right: DataFrame | None, group: str, least: float = LEAST, most: int | None = None) -> DataFrame:
    """``PAIR`` of rows of one group that are similar or equal in title, url or duplicate key.

    Sides have ``group`` and ``SIDE``; without ``right``, pairs of different rows
    of ``left`` in both directions. With ``most``, a task gives no more than so
    many best partners of a row, by score and then smallest id: the best of all
    are among them.
    """
    same_table = right is None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, a, b = _read(batches, same_table)
        if b is not None and not (len(a) and len(b)):
            return
        ids, key, codes = t["id"].to_numpy(), t["key"].to_pylist(), _codes(t)
        of_left = np.zeros(len(ids), bool)
        of_left[a if b is not None else slice(None)] = True
        # A row that has its best partners needs none below the last of them; rows of ``right`` need none.
        floor = np.where(of_left | same_table, -np.inf, np.inf)
        once = len(np.unique(ids[a])) == len(a) and (b is None or len(np.unique(ids[b if not same_table else slice(None)])) == (len(ids) if same_table else len(b)))
        pool: list[pd.DataFrame] = []

        def raised(rows: np.ndarray, near: np.ndarray) -> None:
            """Floors of rows that have none yet, by their similarities to others."""
            new = np.flatnonzero(floor[rows] == -np.inf)
            if once and len(new) and near.shape[1] >= most:
                last = np.partition(near[new], -most, axis=1)[:, -most].astype(float)
                floor[rows[new]] = np.where(last >= least + SLACK, (last - SLACK) * FACTOR, -np.inf)

        def picked() -> None:
            pool[:] = [_best(pd.concat(pool, ignore_index=True), ids, most)]
            last = pool[0].groupby("row")["score"].agg(["size", "min"])
            last = last[last["size"] == most]["min"]
            floor[last.index.to_numpy()] = np.maximum(floor[last.index.to_numpy()], last.to_numpy())

        def batch(x: pd.DataFrame) -> pa.RecordBatch:
            # Python rounds the similarity as it is in binary; format_string() rounds its shortest decimal form.
            row, other, sim = x["row"].to_numpy(), x["other"].to_numpy(), x["sim"].to_numpy()
            why = {n: codes[n][row] == codes[n][other] for n in codes}
            same = [(REASONS[n], (w & (codes[n][row] >= 0)).tolist()) for n, w in why.items()]
            reasons = [",".join([r for r, w in same if w[k]] + ([f"text_similarity={v:.2f}"] if v >= least else [])) for k, v in enumerate(sim.tolist())]
            return pa.record_batch([pa.array(ids[row]), pa.array(ids[other]), pa.array(sim), pa.array(x["points"].to_numpy()), pa.array(reasons, pa.string())], names=["id", "other", "sim", "points", "reasons"])

        for i, j, shared, size_i, size_j, within in _tiles(key, a, b):
            near = _near(shared, size_i, size_j)
            if most is not None:
                if within:
                    near[i[:, None] == j[None, :]] = -1
                raised(i, near)
                raised(j, near.T)
            at, to = ((np.maximum(floor[r] / FACTOR, least) - SLACK).astype(np.float32) for r in (i, j))
            want = near >= (np.minimum(at[:, None], to[None, :]) if most is not None else np.float32(least - SLACK))
            points_of = {n: _equal(codes[n][i], codes[n][j]) for n in POINTS}
            for p, q in points_of.values():
                want[p, q] = True
            if within:
                want &= i[:, None] < j[None, :]
            p, q = np.nonzero(want)
            x, y, low = i[p], j[q], np.minimum(size_i[p], size_j[q])
            sim = np.divide(shared[p, q].astype(float), low, out=np.zeros(len(p)), where=low > 0)
            points = np.zeros(len(p))
            for n, (e, _) in points_of.items():
                if len(e):
                    points += ((codes[n][x] == codes[n][y]) & (codes[n][x] >= 0)) * POINTS[n]
            score = points + np.where(sim >= least, sim * FACTOR, 0.0)
            keep = (score > 0) & ((ids[x] != ids[y]) if same_table else True)
            found = pd.DataFrame({"row": x, "other": y, "score": np.round(score, 6), "sim": sim, "points": points})[keep]
            if not same_table and not of_left[i[0]]:
                found = found.rename(columns={"row": "other", "other": "row"})
            for each in (found, found.rename(columns={"row": "other", "other": "row"}))[: 1 + same_table]:
                if most is None:
                    yield batch(each)
                else:
                    pool.append(each[each["score"].to_numpy() >= floor[each["row"].to_numpy()]])
            if sum(map(len, pool)) > POOL:
                picked()
        if pool:
            picked()
            yield batch(pool[0])

    return _tasks(left, right, group).groupBy(group, "lo", "hi").applyInArrow(work, PAIR)


def context(found: DataFrame, others: DataFrame, fields: dict[str, Column], most: int = ITEMS, characters: int = CHARACTERS) -> DataFrame:
    """``id, other, score, reason, rn``: the best partners, as long as their items' JSON adds up to ``characters``; the first always.

    ``fields`` are an item's further fields, of ``others`` (``other`` and columns).
    """
    similar = F.col("sim") >= LEAST
    score = F.col("points") + F.when(similar, F.col("sim") * FACTOR).otherwise(0.0)
    w = Window.partitionBy("id").orderBy(F.desc(F.round("score", 6)), "other")
    top = found.select("id", "other", score.alias("score"), F.col("reasons").alias("reason")).withColumn("rn", F.row_number().over(w).cast("long")).filter(F.col("rn") <= most)
    item = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()], F.col("reason").alias("match_reason"), F.round("score", 2).alias("match_score")), {"ignoreNullFields": "false"})
    # The budget counts a blank behind each colon and comma.
    sized = top.join(others, "other").withColumn("size", F.length(item) + 2 * (len(fields) + 2) - 1)
    run = F.sum("size").over(Window.partitionBy("id").orderBy("rn").rowsBetween(Window.unboundedPreceding, 0))
    kept = sized.withColumn("run", run).filter((F.col("rn") == 1) | (F.col("run") <= characters))
    return kept.select("id", "other", "score", "reason", "rn")


def article_text(headline_a: Column, headline_final: Column, headline_body: Column, summary: Column, dup: Column) -> Column:
    """The text by which articles are compared: five fields, a line each."""
    return F.concat_ws("\n", *[F.coalesce(c, F.lit("")) for c in (headline_a, headline_final, headline_body, summary, dup)])


def sides(df: DataFrame, group: Column, row: Column, title: Column, summary: Column, url: Column, dup: Column, fold: bool = True) -> DataFrame:
    """``grp`` and ``SIDE`` of articles with one headline: what ``pairs`` compares."""
    blank = F.lit("")
    key = lambda c: normalize_key(c, fold=fold)
    return df.select(group.alias("grp"), row.cast("long").alias("id"), key(title).alias("title"), url.alias("url"), dup.alias("dup"), F.coalesce(key(article_text(title, blank, blank, summary, dup)), blank).alias("key"))


def short(c: Column, size: int) -> Column:
    return truncate(F.coalesce(c, F.lit("")), size)
