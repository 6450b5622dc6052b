"""Second scores: responses of a model, which arrive as a table, to results, final scores and duplicate groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import responses
from ..functions.numbers import clamp_score, final_score, safe_int
from ..operators.similarity import components, duplicate_labels
from .context import short

#: Articles sent at most, the least first score, batch size, tries of a batch after the first.
MOST, LEAST_SCORE, BATCH, RETRIES = 150, 20, 20, 2
#: Note on a group's score.
RAISED = "%sの同日重複グループ%d件の最高最終スコア%d点にAA列を揃えました。元スコア: %d点。"
TAKEN = "%sの同日重複グループ%d件の最高最終スコアとして使用。"
NOTE_LIMIT, MEMBERS = 220, 12
#: Characters kept of the fields of a payload.
PAYLOAD = {"headline": 140, "summary": 850, "note": 260, "dup": 180, "url": 240}


def candidates(rows: DataFrame, score: str, topic: Column, dup: Column, order: str, most: int = MOST, least: int = LEAST_SCORE) -> DataFrame:
    """Rows to be scored again, with ``turn``: all in order if they are no more than ``most``, else the best by priority, score and order."""
    n = rows.count()
    s = clamp_score(F.col(score))
    if n <= most:
        return rows.withColumn("priority", F.lit(None).cast("int"))
    priority = F.when(s >= 80, 5).when(topic, 4).when(dup, 3).when(s >= 40, 2).otherwise(1)
    kept = rows.filter((s >= least) | topic | dup).withColumn("priority", priority)
    return kept.orderBy(F.desc("priority"), F.desc(s), order).limit(most)


def payloads(rows: DataFrame, contexts: DataFrame, key: str) -> DataFrame:
    """``key, payload``: what is sent of an article, with the context of its day or an empty list."""
    items = contexts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rn", "other", "reason"))).alias("_c"))
    j = rows.join(items, key, "left")
    context = F.transform(F.coalesce("_c", F.array().cast("array<struct<rn:bigint,other:bigint,reason:string>>")), lambda x: F.struct(x["other"].alias("row_index"), x["reason"].alias("match_reason")))
    fields = [F.col(key).alias("row_index"), clamp_score(F.col("score")).alias("ml_score"), *[short(F.col(c), n).alias(c) for c, n in PAYLOAD.items() if c in rows.columns], context.alias("same_day_context")]
    return j.select(key, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("payload"))


def results(tries: DataFrame, retries: int = RETRIES) -> DataFrame:
    """``row_index, r``: of each batch the first try that parses, up to ``retries`` after the first; of a row's results the last batch's.

    ``tries`` has ``batch, attempt, body``. A list is taken as the articles; a
    batch without a parsable try gives nothing.
    """
    good = tries.filter(F.col("attempt") <= retries + 1).withColumn("j", responses.extract_json("body")).filter("j IS NOT NULL")
    first = good.groupBy("batch").agg(F.min_by("j", "attempt").alias("j"))
    whole = F.when(F.startswith(F.trim("j"), F.lit("[")), F.col("j")).otherwise(F.get_json_object("j", "$.articles"))
    items = first.select("batch", F.posexplode(F.from_json(whole, "array<string>")).alias("pos", "item"))
    row = safe_int(F.get_json_object("item", "$.row_index"), -1)
    return items.withColumn("row_index", row).filter("row_index > 0").groupBy("row_index").agg(F.max_by("item", F.struct("batch", "pos")).alias("item")).select("row_index", responses.second_score(F.col("item")).alias("r"))


def model_usage(tries: DataFrame) -> DataFrame:
    """``model, n``: articles by the model that answered their batch."""
    ok = tries.filter(F.col("body").isNotNull()).groupBy("batch").agg(F.min_by(F.struct("model", "size"), "attempt").alias("u"))
    return ok.groupBy(F.col("u.model").alias("model")).agg(F.sum("u.size").alias("n"))


def answered(tries: DataFrame) -> DataFrame:
    """``call, model, body``: the first answer of the first model; where its errors call for the second model, that one's; other calls stay unanswered.

    ``tries`` has ``call, model, second, attempt, error, body``; ``second`` says that a try was the second model's.
    """
    first = F.min_by(F.struct("model", "body"), F.when(~F.col("second") & F.col("body").isNotNull(), F.col("attempt")))
    other = F.min_by(F.struct("model", "body"), F.when(F.col("second") & F.col("body").isNotNull(), F.col("attempt")))
    due = F.bool_or(~F.col("second") & responses.second_model(F.col("error")))
    has = lambda second: F.count_if((F.col("second") == second) & F.col("body").isNotNull()) > 0
    g = tries.groupBy("call").agg(first.alias("a"), other.alias("b"), due.alias("due"), has(False).alias("one"), has(True).alias("two"))
    return g.select("call", F.when(F.col("one"), F.col("a")).when(F.col("due") & F.col("two"), F.col("b")).alias("r")).filter("r IS NOT NULL").select("call", "r.model", "r.body")


def finals(rows: DataFrame, scored: DataFrame, key: str = "row_index") -> DataFrame:
    """``key, ml, llm, final, source, reason`` of every row; rows without result keep their first score."""
    j = rows.join(scored, key, "left")
    llm = F.col("r.score")
    return j.select(key, clamp_score(F.col("ml")).alias("ml"), llm.alias("llm"), final_score(F.col("ml"), llm).alias("final"), responses.score_label(F.col("ml"), llm).alias("source"),
                    F.when(F.col("r").isNotNull(), responses.reason_text(F.col("r"))).otherwise("").alias("reason"))


def duplicate_groups(rows: DataFrame, scored: DataFrame) -> DataFrame:
    """``row_index, label, final, note`` of rows that a model calls duplicates of one event.

    ``rows`` has ``row_index, date_key, final``. Links go to the source rows that
    a result names, if they are rows of the same day, and between rows of one
    event key. Labels are numbered by the smallest row; a group's rows all take
    its highest score.
    """
    j = rows.join(scored, "row_index").withColumn("k", responses.event_key(F.col("r"), F.coalesce("date_key", F.lit("")))).filter("k <> ''")
    other = rows.select(F.col("row_index").cast("long").alias("b"), F.col("date_key").alias("other_day"))
    named = j.select(F.col("row_index").cast("long").alias("a"), "date_key", F.explode("r.same_day_score_source_rows").alias("b")).join(other, "b").filter(F.col("date_key").eqNullSafe(F.col("other_day")) & (F.col("a") != F.col("b")))
    first = j.groupBy("k").agg(F.min(F.col("row_index").cast("long")).alias("b"))
    same = j.select(F.col("row_index").cast("long").alias("a"), "k").join(first, "k").filter("a <> b")
    links = named.select("a", "b").unionByName(same.select("a", "b"))
    group = duplicate_labels(components(links, "a", "b"))
    g = group.select(F.col("node").alias("row_index"), "component", "label").join(rows.select(F.col("row_index").cast("long").alias("row_index"), clamp_score(F.col("final")).alias("own")), "row_index")
    top = g.groupBy("component").agg(F.max("own").alias("top"), F.count(F.lit(1)).alias("n"))
    g = g.join(top, "component")
    raised = F.format_string(RAISED, "label", "n", "top", "own")
    return g.select("row_index", "label", F.col("top").alias("final"), F.substring(F.when(F.col("own") < F.col("top"), raised).otherwise(F.format_string(TAKEN, "label", "n")), 1, NOTE_LIMIT).alias("note"))


def kept_rows(rows: DataFrame, answer: DataFrame, exempt: Column, key: str = "id") -> DataFrame:
    """Rows that a model's dedupe keeps and exempt ones; all rows if it keeps none of them.

    ``answer`` has ``kind`` (kept, removed), ``id`` and ``duplicate_of``; ids
    are compared without trailing slashes.
    """
    norm = lambda c: F.regexp_replace(c, "/+$", "")
    kept = answer.filter("kind = 'kept'").select(norm(F.col("id")).alias("_k")).distinct()
    known = kept.join(rows.select(norm(F.col(key)).alias("_k")), "_k", "left_semi")
    any_known = known.agg((F.count(F.lit(1)) > 0).alias("_any"))  # one row
    j = rows.withColumn("_k", norm(F.col(key))).join(known.withColumn("_hit", F.lit(True)), "_k", "left").crossJoin(F.broadcast(any_known))
    return j.filter(F.coalesce("_hit", F.lit(False)) | exempt | ~F.col("_any")).drop("_k", "_hit", "_any")


def dedupe_report(rows: DataFrame, answer: DataFrame, key: str = "id") -> DataFrame:
    """``id, status, duplicate_of, flags``: each input and answer id once: kept, removed (as told), dropped (untold), or unknown to the input."""
    ids = rows.select(F.col(key).alias("id")).distinct().withColumn("known", F.lit(True))
    told = answer.groupBy("id").agg(F.bool_or(F.col("kind") == "kept").alias("kept"), F.max(F.when(F.col("kind") == "removed", F.col("duplicate_of"))).alias("duplicate_of"))
    j = ids.join(told, "id", "full").join(ids.select(F.col("id").alias("duplicate_of"), F.lit(True).alias("target")), "duplicate_of", "left")
    status = F.when(F.col("kept"), "kept").when(F.col("kept").isNotNull(), "removed").otherwise("dropped")
    flags = F.concat_ws(",", F.when(F.col("known").isNull(), "id_not_in_input"), F.when(F.col("duplicate_of").isNotNull() & F.col("target").isNull(), "target_not_in_input"))
    return j.select("id", status.alias("status"), "duplicate_of", flags.alias("flags"))


def clusters(answer: DataFrame, members: DataFrame) -> DataFrame:
    """``cluster, n, kept``: members of each cluster and the one that is kept."""
    kept = answer.filter("kind = 'kept'").groupBy("cluster").agg(F.min("id").alias("kept"))
    return members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).join(kept, "cluster", "left")


def translated(items: DataFrame, batch: DataFrame, single: DataFrame, value: str) -> DataFrame:
    """A translation by id, else by address, else from a single retry, else the original; ``fallback`` where it is the original."""
    by_id = batch.filter("coalesce(id, '') <> ''").groupBy("id").agg(F.max_by(value, "seq").alias("_a"))
    by_url = batch.filter("coalesce(url, '') <> ''").groupBy(F.regexp_replace(F.substring_index(F.trim("url"), "#", 1), "/+$", "").alias("_u")).agg(F.max_by(value, "seq").alias("_b"))
    j = items.withColumn("_u", F.regexp_replace(F.substring_index(F.trim("url"), "#", 1), "/+$", "")).join(by_id, "id", "left").join(by_url, "_u", "left").join(single.select("id", F.col(value).alias("_c")), "id", "left")
    blank = lambda c: F.when(F.trim(c) != "", c)
    got = F.coalesce(blank(F.col("_a")), blank(F.col("_b")), blank(F.col("_c")))
    return j.withColumn("out", F.coalesce(got, F.col("original"))).withColumn("fallback", got.isNull()).drop("_u", "_a", "_b", "_c")


def pairs_of_short(rows: DataFrame, by: list[str], order: str, size: Column, limit: int = 5000) -> DataFrame:
    """``batch``: two neighbouring short rows together, a long one alone."""
    w = Window.partitionBy(*by).orderBy(order)
    d = rows.withColumn("_long", size > limit).withColumn("_start", F.when(F.col("_long") | F.coalesce(F.lag("_long").over(w), F.lit(True)), 1).otherwise(0))
    d = d.withColumn("_run", F.sum("_start").over(w))
    nth = F.row_number().over(Window.partitionBy(*by, "_run").orderBy(order)) - 1
    d = d.withColumn("_pair", F.floor(nth / 2))
    return d.withColumn("batch", (F.dense_rank().over(Window.partitionBy(*by).orderBy("_run", "_pair")) - 1).cast("long")).drop("_long", "_start", "_run", "_pair")

