import json

import pytest
from pyspark.sql import functions as F

from themeweave import schemas
from themeweave.operators import report, selection
from themeweave.sources import readers, writers
from themeweave.streaming import stream
from themeweave.plans import fixtures as fx

SF_DIR = "/root/testdata/sf0.001"


def test_csv_keeps_quotes_newlines_nulls_and_edges(spark, tmp_path):
    rows = [(1, 'a "quoted", x', "line\nbreak \\ back", None), (2, "", None, ["x", 'y"']), (3, " edge ", "NA", []), (4, "null", "\ttab", None)]
    schema = "doc_id long, title string, text string, tags array<string>"
    path = str(tmp_path / "t.csv")
    writers.sink_table(spark.createDataFrame(rows, schema), path, fmt="csv")
    back = readers.scan_csv(spark, path, spark.createDataFrame([], "doc_id long, title string, text string, tags string").schema)
    got = {r["doc_id"]: (r["title"], r["text"], json.loads(r["tags"]) if r["tags"] else None) for r in back.collect()}
    assert got == {r[0]: r[1:] for r in rows}


def test_empty_label_table_is_written_with_its_schema(spark, tmp_path):
    path = str(tmp_path / "labels")
    writers.sink_table(spark.createDataFrame([], schemas.LABEL), path)
    back = spark.read.parquet(path)
    assert back.count() == 0 and back.schema.simpleString() == schemas.LABEL.simpleString()


def test_year_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "corpus")
    writers.sink_corpus_by_year(fx.corpus(spark, SF_DIR), path)
    rows = selection.filter_period(spark.read.parquet(path))
    assert rows.count() == selection.filter_period(fx.corpus(spark, SF_DIR)).count()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_json_documents_objects_arrays_and_nulls(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps({"tokens_entrada": 3, "chamadas": 1}, indent=2))
    (tmp_path / "many.json").write_text(json.dumps([{"cluster_id": 1, "erro": "a\nb"}, {"cluster_id": 2, "erro": None}], indent=2))
    one = readers.scan_json_document(spark, str(tmp_path / "one.json"), schemas.USAGE_REPORT).first()
    assert (one["tokens_entrada"], one["tokens_saida"], one["chamadas"]) == (3, None, 1)
    many = readers.scan_json_document(spark, str(tmp_path / "many.json"), schemas.DEAD_LETTER)
    assert sorted((r["cluster_id"], r["erro"]) for r in many.collect()) == [(1, "a\nb"), (2, None)]
    writers.sink_json_document(spark.createDataFrame([(1, None)], "a int, b int"), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.json"))
    assert json.loads(text) == {"a": 1, "b": None}


def test_template_is_one_string(spark, tmp_path):
    (tmp_path / "t.txt").write_text("a\n{x}\nç\n", encoding="utf-8")
    assert [tuple(r) for r in readers.scan_template(spark, str(tmp_path / "t.txt")).collect()] == [("a\n{x}\nç\n",)]


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_optional_source_forgives_only_absence(spark, tmp_path, fmt):
    empty = readers.optional_source(spark, str(tmp_path / "absent"), schemas.LABEL if fmt != "csv" else schemas.PRICES, fmt)
    assert empty.count() == 0
    (tmp_path / "bad.parquet").write_text("this is not parquet")
    if fmt == "parquet":
        with pytest.raises(Exception):
            readers.optional_source(spark, str(tmp_path / "bad.parquet"), schemas.LABEL).count()


def test_dead_letters_accumulate(spark, tmp_path):
    path = str(tmp_path / "dead")
    rows = spark.createDataFrame([(1, "x", "e", 1.5)], schemas.DEAD_LETTER)
    for _ in range(3):
        writers.sink_dead_letters(rows, path)
    assert spark.read.parquet(path).count() == 3


def test_dead_letters_of_a_run_are_written_once(spark, tmp_path):
    path = str(tmp_path / "dead")
    first = spark.createDataFrame([(1, "x", "e", 1.5), (2, "y", "e", 1.5)], schemas.DEAD_LETTER)
    again = spark.createDataFrame([(1, "x", "e", 9.5), (2, "y", "e", 9.5)], schemas.DEAD_LETTER)
    for rows, run in ((first, "a"), (again, "a"), (first, "b")):
        writers.sink_dead_letters(rows, path, run=run)
    got = [(r["run"], r["cluster_id"], r["timestamp"]) for r in spark.read.parquet(path).orderBy("run", "cluster_id").collect()]
    assert got == [("a", 1, 9.5), ("a", 2, 9.5), ("b", 1, 1.5), ("b", 2, 1.5)]

    failing = first.withColumn("erro", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        writers.sink_dead_letters(failing, path, run="b")
    assert spark.read.parquet(path).count() == 4

    writers.sink_dead_letters(first.limit(0), path, run="a")  # the attempt that counts had none
    assert [r["run"] for r in spark.read.parquet(path).collect()] == ["b", "b"]
    writers.sink_dead_letters(first.limit(0), str(tmp_path / "none"), run="a")
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        writers.sink_dead_letters(first, path, run="../b")


def test_period_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "landed")
    fx.corpus(spark, SF_DIR).write.parquet(path)
    df = selection.filter_period(readers.scan_corpus(spark, path)).select("doc_id", "category")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,2020-01-01), LessThan(date,2021-01-01)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,date:date,category:string>" in plan


def test_streams_give_the_batch_results(spark, tmp_path):
    landing = str(tmp_path / "landing")
    raw = fx.corpus(spark, SF_DIR).select(*schemas.RAW_CORPUS.names)
    raw.repartition(4).write.parquet(landing)
    cleaned = stream.clean_stream(stream.read_landing(spark, landing, files_per_trigger=1))
    stream.drain_to(cleaned, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = selection.preprocess_corpus(raw)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0

    responses = str(tmp_path / "responses")
    fx.responses(spark, SF_DIR).repartition(3).write.parquet(responses)
    checked = stream.check_label_stream(stream.read_landing(spark, responses, fx.responses(spark, SF_DIR).schema))
    stream.drain_to(checked, str(tmp_path / "out2"), str(tmp_path / "cp2")).awaitTermination()
    done = spark.read.parquet(str(tmp_path / "out2"))
    assert done.count() == 200 and 0 < done.where(F.size("reasons") == 0).count() < 200


def test_report_of_unlabelled_and_noise(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, -1)], "doc_id long, c int")
    labels = spark.createDataFrame([(0, "Copa", ["gol", "time"], "Resumo do grupo", 0.5, False)], schemas.LABEL)
    cards = {r["cluster_id"]: r for r in report.cluster_card(df, "c", labels).collect()}
    assert cards[0]["keywords"] == "gol, time" and cards[0]["n_docs"] == 2
    assert cards[-1]["display_name"] == "Ruído (-1)" and cards[-1]["nome_topico"] == report.NOT_LABELLED
    empty = report.cluster_label_lookup(df.selectExpr("c as cluster_id").distinct(), labels.limit(0))
    assert {r["nome_topico"] for r in empty.collect()} == {report.NOT_LABELLED}
