"""Commands end to end on small tables."""

import pytest

from newsweft import jobs
from newsweft.plans import collection


def run(spark, *argv):
    a = jobs.parser().parse_args([*map(str, argv)])
    a.run(spark, a)


def test_collect_export_bundle(spark, tmp_path):
    lists, fetches = collection.payloads(spark)
    lists.write.parquet(str(tmp_path / "lists"))
    fetches.write.parquet(str(tmp_path / "fetches"))
    args = ("collect", "--lists", tmp_path / "lists", "--fetches", tmp_path / "fetches", "--day", collection.DAY, "--only", "DVB")
    run(spark, *args, "--out", tmp_path / "articles")
    got = spark.read.parquet(str(tmp_path / "articles"))
    assert [r.title for r in got.collect()] == ["D one"]
    run(spark, *args, "--store", tmp_path / "articles", "--out", tmp_path / "again")
    assert spark.read.parquet(str(tmp_path / "again")).count() == 0
    got.selectExpr("source", "title", "CAST(NULL AS string) AS title_ja", "CAST(date AS string) AS date", "url").write.parquet(str(tmp_path / "rows"))
    run(spark, "export", "--articles", tmp_path / "rows", "--daily", "--out", tmp_path / "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 1
    spark.createDataFrame([(i, k, "s", f"u{i}", "t", "x", "b") for i, k in enumerate("aAa")], "row int, k string, source string, url string, title string, summary string, body string").write.parquet(str(tmp_path / "sheet"))
    run(spark, "bundle", "--rows", tmp_path / "sheet", "--out", tmp_path / "bundle")
    assert sorted(r.item_id + r.url for r in spark.read.json(str(tmp_path / "bundle" / "summaries")).collect()) == ["sheet-0001u0", "sheet-0002u2"]


def test_score_and_query(spark, tmp_path, sf_dir):
    fields = "headline_a string, headline_final string, headline_body string, summary string, url string, duplicate_key string"
    good, bad = ("army talks in the north", "a plain day"), ("sport results", "scores and scores")
    past = [(i, *(good if i % 2 else bad)[:1], "", "", (good if i % 2 else bad)[1], "u", "", float(i % 2), 1.0) for i in range(20)]
    spark.createDataFrame(past, f"row_index int, {fields}, label double, weight double").write.parquet(str(tmp_path / "past"))
    spark.createDataFrame([(100, good[0], "", "", good[1], "u", ""), (101, bad[0], "", "", bad[1], "u", ""), (102, "", "", "", "", "", "")], f"row_index int, {fields}").write.parquet(str(tmp_path / "now"))
    run(spark, "score", "--training", tmp_path / "past", "--records", tmp_path / "now", "--out", tmp_path / "scores")
    got = {r.row_index: r.score for r in spark.read.parquet(str(tmp_path / "scores")).collect()}
    assert set(got) == {100, 101, 102} and got[100] > 60 > 40 > got[101]
    run(spark, "query", "selected_per_group", "--tables", sf_dir, "--out", tmp_path / "q")
    assert spark.read.parquet(str(tmp_path / "q")).count() > 0
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["nothing"])


def test_score_keeps_tables_apart(spark, tmp_path):
    """Row numbers that both tables use, grams that only pending rows have, outputs that are there already."""
    fields = "row_index int, headline_a string, headline_final string, headline_body string, summary string, url string, duplicate_key string"
    good, bad = ("army talks in the north", "a plain day"), ("sport results", "scores and scores")
    past = [(i % 7, (good if i % 2 else bad)[0], "", "", (good if i % 2 else bad)[1], "u", "", float(i % 2), 1.0) for i in range(20)]  # several sheets
    unlabelled = [(50, "zebra zebra", "", "", "zebra", "u", "", None, 1.0)]
    now = [(0, good[0], "", "", good[1], "u", "", "20240101", "", None, None), (1, bad[0], "", "", bad[1], "u", "", "20240101", "", None, None), (1, bad[0] + " quagga quagga", "", "", bad[1], "u", "", "20240101", "", None, None),
           (2, good[0], "", "", good[1], "u", "", "20240101", "80", 80, 0.8), (3, good[0], "", "", good[1], "u", "", "", "", None, None), (4, "", " ", "", "", "u", "", "20240101", "", None, None), (5, None, None, None, None, None, None, None, None, 7, 0.07)]
    more = fields + ", date_key string, final_score string, score int, probability double"
    scores = []
    for name, rows in (("all", now), ("fewer", now[:2] + now[3:])):
        folder = tmp_path / name
        spark.createDataFrame(past + unlabelled, fields + ", label double, weight double").write.parquet(str(folder / "past"))
        spark.createDataFrame(rows, more).write.parquet(str(folder / "now"))
        run(spark, "score", "--training", folder / "past", "--records", folder / "now", "--out", folder / "scores")
        scores.append(sorted(((r.row_index, r.score, r.probability) for r in spark.read.parquet(str(folder / "scores")).collect()), key=str))
    got = scores[0]
    assert [r[0] for r in got] == [0, 1, 1, 2, 3, 4, 5]
    by = {r[0]: r for r in got}
    assert by[2][1:] == (80, 0.8) and by[3][1:] == (None, None) and by[4][1:] == (None, None) and by[5][1:] == (7, 0.07)
    assert by[0][1] > 60 > 40 > by[1][1]
    # What is scored beside a record changes nothing about it.
    assert [round(r[2], 9) for r in scores[1] if r[0] < 2] == [round(x, 9) for x in ([r[2] for r in got if r[0] == 0] + [r[2] for r in got if r[0] == 1 and any(abs(r[2] - o[2]) < 1e-12 for o in scores[1] if o[0] == 1)])[:2]]
    # The model is that of the training rows alone.
    from newsweft.operators import ml

    train = spark.createDataFrame([(i, *p) for i, p in enumerate(past)], "k long, " + fields + ", label double, weight double")
    fitted = ml.fit(ml.counts(train, "k"), train.count()).collect()
    grams = {(r.branch, r.gram) for r in fitted}
    assert ("headline_a", "army") in grams and not any("quag" in g or "zeb" in g for _, g in grams)
    assert {r.rows for r in fitted} == {20}
