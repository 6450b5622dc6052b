"""Commands: ``python -m newsweft.jobs COMMAND``; each reads tables from folders and writes a table to a folder."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import get_session, ship


def _table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def run_query(spark: SparkSession, a: argparse.Namespace) -> None:
    """A query of the catalogue over a folder of tables."""
    from . import plans

    plans.QUERIES[a.name](spark, a.tables).write.mode("overwrite").parquet(a.out)


def collect(spark: SparkSession, a: argparse.Namespace) -> None:
    """List and page payloads of a day to articles; with ``--store``, those that are not stored yet are appended there."""
    from .operators.joins import new_items
    from .sources import collectors

    gated = {s: set(filter(None, slots.split(";"))) for s, _, slots in (g.partition("=") for g in a.gate)}
    rows = collectors.collect(_table(spark, a.lists, collectors.LIST_SCHEMA), _table(spark, a.fetches, collectors.FETCH_SCHEMA), a.day, collectors.plan(a.cron, a.only, gated))
    if a.store:
        rows = new_items(rows, _table(spark, a.store).select("row_key"), "row_key", "row_key")
    rows.write.mode("append" if a.append else "overwrite").parquet(a.out)


def export(spark: SparkSession, a: argparse.Namespace) -> None:
    """Articles to CSV, under the headings of the daily or the full export."""
    from .sources import sinks

    sinks.write_csv(sinks.export(_table(spark, a.articles), sinks.DAILY_EXPORT if a.daily else sinks.EXPORT), a.out)


def bundle(spark: SparkSession, a: argparse.Namespace) -> None:
    """Adopted rows of a sheet to a bundle of summaries and bodies, numbered in order."""
    from .operators.windows import numbered
    from .sources import sinks

    rows = numbered(_table(spark, a.rows).filter("k = 'a'"), [], ["row"]).withColumn("item_id", F.format_string("sheet-%04d", "rn"))
    sinks.write_bundle({"summaries": rows.select("item_id", "source", "url", "title", "summary"), "bodies": rows.select("item_id", "source", "url", "title", "body")}, a.out)


def score(spark: SparkSession, a: argparse.Namespace) -> None:
    """Train on labelled records and score the pending ones; every record keeps its place, and outputs it has already.

    Vocabularies, document frequencies and coefficients come from the training
    rows alone. A record is pending if it has a text, a day (``--day``) and no final
    score (``--final``); without these columns, if it has a text. Row numbers tell
    records apart in the output only: sheets may repeat them.
    """
    from .operators import joins, ml
    from .session import written
    from .sources.archives import pending, usable

    numbered = lambda df, name: written(df.withColumn("_row", F.monotonically_increasing_id()), name)
    past = numbered(_table(spark, a.training).filter("label IS NOT NULL"), "training")
    now = numbered(_table(spark, a.records), "records")
    texts = [F.coalesce(F.col(c), F.lit("")) for c in ml.BRANCHES if c in now.columns]
    todo = now.filter(usable(F.concat_ws("\n", *texts)))
    if a.day in now.columns and a.final in now.columns:
        todo = todo.filter(pending(F.col(a.day), F.col(a.final)))
    outputs = {"score": "int", "probability": "double"}
    space = ml.Space.of(past, ml.fit(ml.counts(past, "_row"), past.count()))
    model = ml.train(written(ml.vectors(past, "_row", space, ("label", "weight")), "values"), space, "label", "weight")
    old = now.select("_row", a.key, *[(F.col(c) if c in now.columns else F.lit(None)).cast(t).alias(c) for c, t in outputs.items()])
    new = ml.decisions(ml.vectors(todo, "_row", space), space, model, "_row").select("_row", *outputs)
    out = joins.overlay(old.drop(a.key), new, "_row", list(outputs)).join(old.select("_row", a.key), "_row")
    out.select(a.key, *outputs).write.mode("overwrite").parquet(a.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="newsweft", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(f, *args: tuple[str, dict]) -> None:
        c = sub.add_parser(f.__name__.removeprefix("run_"), help=f.__doc__)
        c.set_defaults(run=f)
        for name, kw in (*args, ("--out", {"required": True})):
            c.add_argument(name, **kw)

    need, many, yes = {"required": True}, {"action": "append", "default": []}, {"action": "store_true"}
    command(run_query, ("name", {}), ("--tables", need))
    command(collect, ("--lists", need), ("--fetches", need), ("--day", need), ("--cron", {}), ("--only", {}), ("--gate", many | {"help": "SOURCE=SLOT;SLOT"}), ("--store", {}), ("--append", yes))
    command(export, ("--articles", need), ("--daily", yes))
    command(bundle, ("--rows", need))
    command(score, ("--training", need), ("--records", need), ("--key", {"default": "row_index"}), ("--day", {"default": "date_key"}), ("--final", {"default": "final_score"}))
    return p


def main(argv: Sequence[str] | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(ship(get_session("newsweft-" + a.command)), a)


if __name__ == "__main__":
    main()
