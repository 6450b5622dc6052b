"""Joins of the record pipeline."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import automaton
from ..functions.terminology import apply_entries
from ..session import written

#: Bytes up to which a side that is checked may be broadcast.
BROADCAST_BYTES = 8 << 20
#: Characters of needles up to which a glossary is broadcast.
NEEDLE_CHARACTERS = 2_000_000


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a side if the optimizer's own size estimate proves it small; else leave the choice to it."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(df) if size <= limit else df


def new_items(items: DataFrame, existing: DataFrame, key: str, existing_key: str) -> DataFrame:
    """Items whose non-blank key isn't stored yet."""
    return items.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").join(
        existing.select(F.col(existing_key).alias("_e")), F.col(key) == F.col("_e"), "left_anti")


def keep_or_all(df: DataFrame, kept: DataFrame, key: str, exempt: Column) -> DataFrame:
    """Rows whose key was kept, and exempt ones; if nothing was kept, everything stays."""
    ids = kept.select(F.col(key).alias("_k")).distinct()
    any_kept = kept.agg((F.count(F.lit(1)) > 0).alias("_any"))  # one row
    joined = df.join(ids, F.col(key) == F.col("_k"), "left").crossJoin(F.broadcast(any_kept))
    return joined.filter(F.col("_k").isNotNull() | exempt | ~F.col("_any")).drop("_k", "_any")


def two_key_lookup(df: DataFrame, by_id: DataFrame, by_url: DataFrame, id_col: str, url_col: str, value: str) -> DataFrame:
    """A value by id, else by url; both sides have unique keys."""
    a = by_id.select(F.col(id_col).alias("_i"), F.col(value).alias("_a"))
    b = by_url.select(F.col(url_col).alias("_u"), F.col(value).alias("_b"))
    j = df.join(a, F.col(id_col) == F.col("_i"), "left").join(b, F.col(url_col) == F.col("_u"), "left")
    return j.withColumn(value, F.coalesce(F.nullif(F.col("_a"), F.lit("")), F.col("_b"))).drop("_i", "_a", "_u", "_b")


def pick(df: DataFrame, key: str, order: str, last: bool = True) -> DataFrame:
    """One row a key: the last or the first by ``order``; aggregated before the shuffle."""
    f = F.max_by if last else F.min_by
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(f(F.struct(*rest), F.col(order)).alias("r")).select(key, *[F.col("r")[c].alias(c) for c in rest])


def overlay(old: DataFrame, new: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """New values over existing ones by key; rows of either side stay."""
    n = new.select(key, *[F.col(c).alias(f"_n_{c}") for c in cols])
    return old.join(n, key, "full").select(key, *[F.coalesce(f"_n_{c}", c).alias(c) for c in cols])


def _needles(glossary: DataFrame, local: str, latin: str) -> DataFrame:
    """``glossary`` with what is looked for: ``_mm`` literally, ``_en`` in lower case; rows with neither find nothing."""
    named = glossary.withColumn("_mm", F.coalesce(F.col(local), F.lit(""))).withColumn("_en", F.lower(F.coalesce(F.col(latin), F.lit(""))))
    return named.filter("_mm <> '' OR _en <> ''")


#: Characters that (?iu) takes for others than lower() does; texts with them are looked at whole.
_FOLDED = {c for c in range(128, 0x110000) if len(u := chr(c).upper()) == 1 and u.lower() != chr(c).lower()} | {0x130}
_FOLDS = "[" + "".join(f"\\x{{{c:X}}}" for c in sorted(_FOLDED)) + "]"
_MARKS = {c for c in range(0x300, 0x20000) if unicodedata.category(chr(c)) == "Mn"}


def _near(t: str, at: int, n: int) -> tuple[str, int]:
    """A window with the characters that decide on word ends: one behind, and one before with the marks on it; and how many stand before."""
    k = at - 1
    while k > 0 and ord(t[k]) in _MARKS:
        k -= 1
    k = max(k, 0)
    return t[k : at + n + 1], at - k


def _bitmap(needles: DataFrame, lengths: list, bits: int) -> bytes:
    """The bitmap of the needles' hashes, put together in parts: 2**MOST bits at most, whatever there are."""
    @F.pandas_udf("array<long>")
    def marked(needle: pd.Series) -> pd.Series:
        return pd.Series(list(automaton.marks(needle.tolist(), lengths, bits).reshape(-1, 3)))

    places = needles.select(F.explode(marked("needle")).alias("p"))
    parts = places.groupBy(F.expr("p div 32768").alias("part")).agg(F.bitmap_construct_agg(F.pmod("p", F.lit(32768))).alias("b"))
    out = bytearray((1 << bits) // 8)
    for r in parts.toLocalIterator():
        size = min(len(r["b"]), len(out) - 4096 * r["part"])
        out[4096 * r["part"] : 4096 * r["part"] + size] = r["b"][:size]
    return bytes(out)


_FOUND = "array<struct<kind: int, needle: string, near: array<struct<s: string, k: int>>>>"


def _windows(named: DataFrame, text: Column, near: bool) -> Column:
    """Windows of a text (0) and of it in lower case (1) that may be needles, with what is around each if it is asked for."""
    spark, finders = named.sparkSession, []
    for c in ("_mm", "_en"):
        needles = named.filter(F.col(c) != "").select(F.col(c).alias("needle"))
        sizes = needles.groupBy(F.length("needle").alias("n")).agg(F.count(F.lit(1)).alias("c")).collect()  # a row a length
        lengths, bits = automaton.classes(r["n"] for r in sizes), automaton.size_of(sum(r["c"] for r in sizes))
        finders.append((lengths, bits, _bitmap(needles, lengths, bits) if lengths else b""))
    sent = spark.sparkContext.broadcast(finders)

    @F.pandas_udf(_FOUND)
    def found(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        windows = [automaton.Windows(*x) for x in sent.value]
        for columns in batches:
            out: list[list] = [[] for _ in columns[0]]
            for kind, (w, column) in enumerate(zip(windows, columns)):
                texts, one = column.tolist(), {}
                for t, at, n, h in zip(*(x.tolist() for x in w.find(texts))):
                    if near:
                        one.setdefault((t, texts[t][at : at + n]), set()).add(_near(texts[t], at, n))
                    elif (t, n, h) not in one:
                        one[t, n, h] = t, texts[t][at : at + n]
                for t, s in one if near else set(one.values()):
                    out[t].append({"kind": kind, "needle": s, "near": [{"s": x, "k": k} for x, k in one[t, s]] if near else None})
            if near:
                for t, s in enumerate(columns[0].tolist()):
                    if s and not s.isascii() and not _FOLDED.isdisjoint(map(ord, set(s))):
                        for x in out[t]:
                            x["near"].append({"s": s, "k": -1})
            yield pd.Series(out)

    # Without needles that are looked for literally, only texts that are looked at whole are sent as they are.
    literal = text if finders[0][0] else F.when(F.rlike(text, F.lit(_FOLDS)), text).otherwise("") if near else F.lit("")
    return found(literal, F.lower(text) if finders[1][0] else F.lit(""))


def occurrences(texts: DataFrame, glossary: DataFrame, text_col: str, local: str, latin: str, limit: int = NEEDLE_CHARACTERS, rule: Callable[[Column], Column] | None = None) -> DataFrame:
    """Texts beside each glossary row whose ``local`` occurs in them literally, or ``latin`` without regard to case.

    Texts are read once for windows that may be needles, by a bitmap of bounded
    size, and these are joined with the needles. A glossary of up to ``limit``
    characters and as many bytes of other columns is broadcast; beyond that,
    numbers of texts and rows are shuffled. Never all pairs. Null and blank needles
    find nothing, null texts hold nothing; repeated rows of either side stay.
    ``rule`` says which count by what is around: of ``kind`` and ``near``, which
    has pieces of text and how many of their characters stand before the needle
    (-1: the whole text, which is to be searched).
    """
    named = _needles(glossary, local, latin)
    both = F.count_if((F.col("_mm") != "") & (F.col("_en") != ""))
    size = named.agg(F.sum(F.length("_mm") + F.length("_en") + F.lit(8)).alias("n"), F.sum(F.octet_length(F.to_json(F.struct(*glossary.columns)))).alias("bytes"), both.alias("both")).first()
    few = (size["n"] or 0) <= limit and (size["bytes"] or 0) <= 4 * limit
    named, texts = written(named.withColumn("_i", F.monotonically_increasing_id()), "glossary"), texts.withColumn("_t", F.monotonically_increasing_id())
    texts = texts if few else written(texts, "texts")
    kept = [c for c in texts.columns if few or c == "_t"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    seen = texts.withColumn("_w", F.explode(_windows(named, text, rule is not None))).select(*kept, F.col("_w.kind").alias("_kind"), F.col("_w.needle").alias("_needle"), F.col("_w.near").alias("_near"))
    side = lambda kind, c: named.filter(F.col(c) != "").select(F.lit(kind).alias("_kind"), F.col(c).alias("_needle"), "_i", *[F.col(x).alias(f"_g_{x}") for x in glossary.columns])
    needles = side(0, "_mm").unionByName(side(1, "_en"))
    found = seen.join(F.broadcast(needles) if few else needles, ["_kind", "_needle"])
    if rule is not None:
        found = found.filter(rule(F.col("_near")))
    found = found.dropDuplicates(["_t", "_i"]) if size["both"] else found
    given = [F.col(f"_g_{x}").alias(x) for x in glossary.columns]
    if few:
        return found.select(*[c for c in texts.columns if c != "_t"], *given)
    return texts.join(found.select("_t", *given), "_t").drop("_t")


def glossary_matches(texts: DataFrame, glossary: DataFrame, text_col: str, local: str = "mm", latin: str = "en", limit: int = NEEDLE_CHARACTERS) -> DataFrame:
    """Texts and the glossary rows that occur in them: ``mm`` literally, ``en`` without regard to case."""
    return occurrences(texts, glossary, text_col, local, latin, limit)


def region_matches(texts: DataFrame, regions: DataFrame, text_col: str, local: str = "mm", latin: str = "en", limit: int = NEEDLE_CHARACTERS) -> DataFrame:
    """As glossary_matches on whole names: no Burmese letter beside ``mm``, word ends around ``en``. Only what stands around a name is looked at by pattern."""
    quote = lambda c: F.concat(F.lit("\\Q"), F.col(f"_g_{c}"), F.lit("\\E"))
    mm = F.concat(F.lit(r"(?<![\x{1000}-\x{109F}])"), quote(local), F.lit(r"(?![\x{1000}-\x{109F}])"))
    en = F.concat(F.lit(r"(?iu)\b"), quote(latin), F.lit(r"\b"))
    before = lambda k: F.when(k >= 0, F.concat(F.lit("(?s)^.{"), k.cast("string"), F.lit("}"))).otherwise("")
    rule = lambda near: F.exists(near, lambda x: F.rlike(x["s"], F.concat(before(x["k"]), F.when(F.col("_kind") == 0, mm).otherwise(en))))
    return occurrences(texts, regions.dropDuplicates([local, latin]), text_col, local, latin, limit, rule)


def with_glossary(rows: DataFrame, glossary: DataFrame, out_col: str, source_col: str, order: str, prefer: str = "body_ja", limit: int = NEEDLE_CHARACTERS) -> DataFrame:
    """``rows`` with the glossary's terms put into ``out_col``, of those entries that occur in ``source_col``, one after another by ``order``.

    ``glossary`` is a table of any size with mm, en and ``prefer``. What one row's
    entries are together is bounded by its own text.
    """
    rows = written(rows.withColumn("_k", F.monotonically_increasing_id()), "rows")
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    terms = glossary.select(F.col(order).alias("_o"), blank("mm").alias("mm"), blank("en").alias("en"), blank(prefer).alias("ja")).filter("ja <> ''")
    found = occurrences(rows.select("_k", F.col(source_col).alias("_s")), terms, "_s", "mm", "en", limit)
    entries = found.groupBy("_k").agg(F.sort_array(F.collect_list(F.struct("_o", "mm", "en", "ja"))).alias("_e"))
    joined = rows.join(entries, "_k", "left")
    return joined.withColumn(out_col, apply_entries(F.col(out_col), F.col("_e"))).drop("_k", "_e")


def unmatched(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: ``key, side``."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.join(y, key, "left_anti").withColumn("side", F.lit("left")).unionByName(y.join(x, key, "left_anti").withColumn("side", F.lit("right")))
