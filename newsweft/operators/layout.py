"""PDF lines: reading order, title islands, column regions, noise, continuations; and greedy one-to-one matching."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.amounts import title_score
from ..functions.text import latin_title_key, nfc
from ..session import written
from .windows import islands, take_while_not

#: Pairs of a group that one task matches in order.
ALONE = 200_000

#: Words, parts and patterns that show a line to be no text of an article.
NOISE_WORDS = ["national", "business", "opinion", "delicacy", "public notice", "write for us", "weather"]
NOISE_PARTS = ["www.gnlm.com.mm", "the global new light of myanmar", "circulation & distribution", "advertising & marketing", "printed and published", "subscription@gnlm.com.mm",
               "we appreciate your feedback", "letter to the editor", "hotline", "advertise"]
NOISE_PATTERNS = [r"^page\s+\d+$", r"^\d{1,2}\s+[a-z]+\s+\d{4}$", r"\bphoto\s*:", r"^(?:this|the|these)?\s*(?:photo|photos|image|images|picture|facade)\b", r"^images?\s+show\b", r"^photos?\s+show\b",
                  r"^footballers in action\b", r"^new signing midfielder\b", r"^female workers are attentively\b", r"^myanmar showcases seintalone mangoes",
                  r"^daily newspapers available online", r"^the people are urged to receive vaccination", r"^(?:this illustration|a handover|house inspections|an outpatient|outstanding students are seen"
                  r"|ancient pagodas|yrtc vice-chairman|the office building|the head of)\b"]
BYLINE = r"—\s*[A-Za-z][A-Za-z .()/-]{1,90}\s*$"
#: Widths of columns in points, what counts as a wide title, margins, sizes and overlaps of a title's region.
COLUMN, WIDE, TOP = 90.0, 0.42, 290.0
BODY_SIZE, OVERLAP, NEXT_OVERLAP, GAP, ABOVE_NEXT, FOOT = 12.8, 0.08, 0.12, 20.0, 6.0, 60.0


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Overlap of two spans over the shorter one, which counts as a point at least."""
    return F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0)) / F.greatest(F.lit(1.0), F.least(a1 - a0, b1 - b0))


def clean_line(c: Column) -> Column:
    c = F.replace(F.replace(nfc(F.coalesce(c, F.lit(""))), F.lit("￾"), F.lit("")), F.lit(" "), F.lit(" "))
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def is_noise(c: Column) -> Column:
    """Headings of sections, page and date lines, imprint, captions."""
    t = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    hit = (t == "") | t.isin(*NOISE_WORDS)
    for x in NOISE_PARTS:
        hit = hit | F.contains(t, F.lit(x))
    return hit | t.rlike("|".join(NOISE_PATTERNS))


def is_byline(c: Column) -> Column:
    return clean_line(c).rlike(BYLINE)


def page_reference(c: Column, prefix: str) -> Column:
    """The number in SEE PAGE 10 and FROM PAGE 9; null without one."""
    return F.regexp_extract(F.coalesce(c, F.lit("")), rf"(?i)\b\Q{prefix}\E\s+(\d{{1,2}})\b", 1).try_cast("int")


def pdf_key(day: Column, title: Column, page: Column, x0: Column, y0: Column) -> Column:
    """Stable key of an article on a page."""
    whole = F.concat_ws("|", F.date_format(day, "yyyy-MM-dd"), title, page.cast("string"), F.format_string("%.1f", x0), F.format_string("%.1f", y0))
    return F.concat(F.lit("gnlm-pdf:"), F.date_format(day, "yyyy-MM-dd"), F.lit(":"), F.substring(F.sha1(whole), 1, 16))


def reading_order(lines: DataFrame, by: list[str], width: float = COLUMN) -> DataFrame:
    """``rn``: columns of ``width`` points from left to right, each from above; half-even rounding."""
    w = Window.partitionBy(*by).orderBy(F.bround(F.col("x0") / width), "y0", "x0", "order")
    return lines.withColumn("rn", F.row_number().over(w).cast("long"))


def title_groups(lines: DataFrame, by: list[str], size_step: float = 1.0, gap: float = 1.8) -> DataFrame:
    """``island``: neighbours in one block, of like size, close below each other and above one another."""
    w = Window.partitionBy(*by).orderBy("rn")
    before = lambda c: F.lag(c).over(w)
    same = ((F.col("block_no") == before("block_no")) & (F.abs(F.col("max_size") - before("max_size")) <= size_step)
            & (F.col("y0") - before("y1") <= gap * F.col("max_size")) & (overlap(F.col("x0"), F.col("x1"), before("x0"), before("x1")) > 0))
    return islands(lines, by, ["rn"], same)


def boxes(lines: DataFrame, by: list[str]) -> DataFrame:
    """The box around each group of lines."""
    return lines.groupBy(*by).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def join_wrapped(lines: Column) -> Column:
    """Lines to text: a blank between, none behind a line that ends with a hyphen or a soft one, which go."""
    step = F.aggregate(
        lines, F.struct(F.lit("").alias("out"), F.lit(False).alias("wrapped")),
        lambda a, raw: _joined(a, F.coalesce(raw, F.lit(""))), lambda a: F.trim(a["out"]))
    return step


def _joined(a: Column, raw: Column) -> Column:
    hard = raw.rlike("[­-]\\s*$")
    line = F.trim(F.regexp_replace(F.replace(raw, F.lit("­"), F.lit("")), r"\s+", " "))
    out = F.when(a["out"] == "", line).when(a["wrapped"], F.concat(F.regexp_replace(a["out"], "-+$", ""), line)).otherwise(F.concat(a["out"], F.lit(" "), line))
    return F.when(line == "", a).otherwise(F.struct(out.alias("out"), hard.alias("wrapped")))


def region_lines(lines: DataFrame, titles: DataFrame, by: list[str], width: float, height: float) -> DataFrame:
    """Text lines under each title, in reading order, up to a byline: of the region below it, above the next title there.

    A wide or high title's region reaches to the right edge, another's a little
    beyond the title. ``titles`` has ``title_id, x0, x1, y0, y1``.
    """
    wide = (F.col("x1") - F.col("x0") >= width * WIDE) | (F.col("y0") < TOP)
    t = titles.select(*by, "title_id", F.greatest(F.lit(20.0), F.col("x0") - 25).alias("r0"), F.when(wide, F.lit(width - 25)).otherwise(F.least(F.lit(width - 20), F.col("x1") + 35)).alias("r1"), F.col("y1").alias("t_y1"))
    o = titles.select(*by, F.col("title_id").alias("o_id"), F.col("x0").alias("o_x0"), F.col("x1").alias("o_x1"), F.col("y0").alias("o_y0"))
    below = t.join(o, by).filter((F.col("o_id") != F.col("title_id")) & (F.col("o_y0") > F.col("t_y1") + GAP) & (overlap(F.col("r0"), F.col("r1"), F.col("o_x0"), F.col("o_x1")) > NEXT_OVERLAP))
    end = below.groupBy(*by, "title_id").agg((F.min("o_y0") - ABOVE_NEXT).alias("end"))
    t = t.join(end, [*by, "title_id"], "left").withColumn("end", F.coalesce("end", F.lit(height - FOOT)))
    j = lines.join(t, by).filter((F.col("max_size") < BODY_SIZE) & (F.col("y0") >= F.col("t_y1") + 2) & (F.col("y0") < F.col("end")) & (overlap(F.col("r0"), F.col("r1"), F.col("x0"), F.col("x1")) >= OVERLAP))
    j = j.filter(~F.lower(F.trim("text")).rlike("^(see|from) page") & ~is_noise(F.col("text")) & (F.length(F.trim("text")) >= 2))
    ordered = reading_order(j, [*by, "title_id"])
    return take_while_not(ordered, [*by, "title_id"], ["rn"], is_byline(F.col("text")), keep_stop=True)


def longest_by_title(articles: DataFrame, title: str, body: str, order: str) -> DataFrame:
    """One article a title key, the one with the longest body, of equals the first; titles without letters or digits go."""
    keyed = articles.withColumn("_k", latin_title_key(F.col(title))).filter("_k <> ''")
    best = F.max(F.struct(F.length(body).alias("n"), (-F.col(order)).alias("o"), F.struct(*articles.columns).alias("r"))).alias("b")
    return keyed.groupBy("_k").agg(best).select("b.r.*")


def merge_continuations(articles: DataFrame, by: str) -> DataFrame:
    """Fragments from another page are put behind the article of that page that refers to them, once; other fragments go.

    ``articles`` has ``page, y0, x0, body, see_page, from_page``. A fragment takes
    the last article before it, in page order, that refers on from its source page.
    """
    w = Window.partitionBy(by).orderBy("page", "y0", "x0")
    a = articles.withColumn("_n", F.row_number().over(w))
    bases = a.filter("see_page IS NOT NULL AND from_page IS NULL").select(by, F.col("_n").alias("_b"), F.col("page").alias("from_page"))
    parts = a.filter("from_page IS NOT NULL").select(by, "from_page", F.col("_n").alias("_f"), F.trim(F.regexp_replace("body", r"(?is)^\s*from\s+page\s+\d+\s*", "")).alias("_more"))
    pairs = parts.join(bases, [by, "from_page"]).filter("_b < _f").groupBy(by, "_f", "_more").agg(F.max("_b").alias("_b"))
    once = pairs.groupBy(by, F.col("_b").alias("_n")).agg(F.min_by("_more", "_f").alias("_more"), F.min("_f").alias("_f"))
    whole = a.join(once.select(by, "_n", "_more"), [by, "_n"], "left")
    add = (F.coalesce("_more", F.lit("")) != "") & ~F.contains("body", F.coalesce("_more", F.lit("")))
    joined = whole.withColumn("body", F.when(add, clean_line(F.concat("body", F.lit("\n\n"), "_more"))).otherwise(F.col("body")))
    used = once.select(by, F.col("_f").alias("_n"))
    return joined.join(used, [by, "_n"], "left_anti").select(*articles.columns)


def greedy_match(pairs: DataFrame, group: str, left: str, right: str, score: str, least: float = 0.76, alone: int = ALONE) -> DataFrame:
    """Each left row, in order, takes the best right row still free, of equals the first: ``group, left, right, score``.

    In rounds: every left row asks for the best right row that may still be its
    own, and a right row refuses all left rows behind the first that asks for it,
    now and later. When nothing is refused any more, each has what it would get in
    order, as all right rows prefer the same left rows. A group is spread over
    tasks; once no group has more than ``alone`` pairs left, each is finished in one.
    """
    rows = written(pairs.filter(F.col(score) >= least).select(group, left, right, score).dropDuplicates([group, left, right]), "pairs")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def in_order(pdf: pd.DataFrame) -> pd.DataFrame:
        used, last, out = set(), None, []
        for row in pdf.sort_values([left, score, right], ascending=[True, False, True]).itertuples(index=False, name=None):
            if row[1] != last and row[2] not in used:
                used.add(row[2])
                last = row[1]
                out.append(row)
        return pd.DataFrame(out, columns=[group, left, right, score])

    while True:
        most = rows.groupBy(group).count().agg(F.max("count")).first()[0] or 0
        if most <= alone:
            return rows.groupBy(group).applyInPandas(in_order, schema)
        best = rows.groupBy(group, left).agg(F.min(F.struct((-F.col(score)).alias("s"), F.col(right).alias("r"))).alias("_b")).select(group, left, F.col("_b.r").alias(right), (-F.col("_b.s")).alias(score))
        asked = best.groupBy(group, right).agg(F.min(left).alias("_first"))
        fewer = written(rows.join(asked, [group, right], "left").filter(F.col("_first").isNull() | (F.col(left) <= F.col("_first"))).select(group, left, right, score), "pairs")
        if fewer.count() == rows.count():
            return best
        rows = fewer


def attach_bodies(items: DataFrame, found: DataFrame, day: str) -> DataFrame:
    """Items without a body take that of the best-titled article of the day, each article once; titles are compared on their keys.

    Candidates share a word of their title keys, as a score of 0.76 needs common text.
    """
    empty = items.filter(F.trim(F.coalesce("body", F.lit(""))) == "").select(day, F.col("id").alias("item"), latin_title_key(F.col("title")).alias("a"))
    other = found.select(day, F.col("id").alias("article"), latin_title_key(F.col("title")).alias("b"), F.col("body").alias("found_body"))
    words = lambda df, k: df.withColumn("word", F.explode(F.array_distinct(F.split(k, " "))))
    near = words(empty, "a").join(words(other.drop("found_body"), "b"), [day, "word"]).select(day, "item", "article", "a", "b").distinct()
    best = greedy_match(near.withColumn("score", title_score("a", "b")), day, "item", "article", "score")
    bodies = best.join(other.select(day, "article", "found_body"), [day, "article"]).select(day, F.col("item").alias("id"), "found_body")
    return items.join(bodies, [day, "id"], "left").withColumn("body", F.coalesce("found_body", "body")).select(*items.columns)
