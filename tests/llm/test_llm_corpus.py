"""Decontamination, mixing and the whole pipeline."""

import random
from collections import defaultdict

import pytest
from llm_cases import empty, odd, odd_rows, prose, words

import corpus_pipeline
from themeweave.llm import decontamination, mixing
from themeweave.llm.oracles import ORACLES

QUESTION = "A farmer named, say, Alice has 12 apples and sells 5 kg of them to Robert before she counts 12 apples again at noon."


def leaked(spark, docs, items):
    got = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    return {(r["doc_id"], r["item_id"]): r["verbatim"] for r in got.collect()}


def test_questions_are_found_with_other_numbers_and_names(spark):
    other = QUESTION.replace("12", "71").replace(" 5 ", " 8 ").replace("Robert", "Simon")
    mixed_up = QUESTION.replace("12 apples and", "71 apples and")  # one value became two
    docs = [(1, prose(1, 50) + " " + QUESTION + " " + prose(2, 50)), (2, prose(3, 50) + " " + other), (3, prose(4, 80)), (4, None), (5, ""), (6, QUESTION.upper())]
    got = leaked(spark, docs, [(9, QUESTION), (10, "too short"), (11, None)])
    assert got[1, 9] is True and got[2, 9] is False
    assert (3, 9) not in got and {item for _, item in got} == {9}
    tail = [(1, "12 apples 12 apples 12 apples 12 apples")]
    assert leaked(spark, tail, [(1, "5 apples 6 apples 7 apples 8 apples")]) == {}
    # 12 would stand for two numbers on the whole, but long runs are as they were
    assert leaked(spark, [(1, mixed_up)], [(9, QUESTION)]) == {(1, 9): False}


def test_runs_of_inconsistent_diagonals_are_dropped(spark):
    item = [(9, QUESTION)]
    coincide = QUESTION.replace("12", "7").replace(" 5 ", " 7 ")  # two values became one
    texts = [QUESTION.replace("12 apples and", "71 apples and"), coincide, prose(4, 80), "12 apples 12 apples 12 apples 12 apples"]
    docs = spark.createDataFrame([(i, prose(5, 30) + " " + t) for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame([*item, (10, "5 apples 6 apples 7 apples 8 apples")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["windows"] for r in decontamination.leaks(docs, items).collect()}
    assert set(got) == {(0, 9), (1, 9)} and got[0, 9] >= 10
    assert {r["doc_id"] for r in decontamination.drop_leaks(docs, items).collect()} == {2, 3}


def test_word_problems_with_other_names_and_amounts_are_dropped(spark):
    item = "Tom buys 4 pens for $3 each. Tom then sells 2 pens to Anna for $5 each. How much money does Tom have left if he began with $20 today?"
    other = item.replace("$20", "$75").replace("Tom", "Lena").replace("Anna", "Paul").replace(" 4 ", " 9 ").replace(" 2 ", " 6 ").replace("$3", "$8").replace("$5", "$7")
    owned = "Tom's shop has 14 red boxes. Anna's shop has 30 red boxes at €5 each, how many do they hold?"
    texts = [other, owned.replace("Tom", "Lena").replace("Anna", "Paul").replace("14", "17").replace("30", "41").replace("€5", "€6"), item.upper(), prose(4, 60)]
    docs = spark.createDataFrame([(i, f"{t} {prose(6, 20)}") for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, owned)], "item_id long, text string")
    assert {r["doc_id"] for r in decontamination.drop_leaks(docs, items).collect()} == {3}
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, items).collect()} >= {(0, 1), (1, 2), (2, 1)}


def test_tables_of_numbers_meet_by_their_values(spark):
    numbers = lambda k: " ".join(str(1000 * k + 7 * j) for j in range(40))
    docs = [(i, numbers(i)) for i in range(30)] + [(99, f"{prose(1, 9)} {numbers(3)}")]
    assert leaked(spark, docs, [(1, numbers(3))]) == {(3, 1): True, (99, 1): True}


def test_rows_without_leaked_ids_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, QUESTION if i in (3, None) else prose(i or 0, 30)) for i in [*range(40), None]], "doc_id long, text string")
    kept = decontamination.drop_leaks(docs, spark.createDataFrame([(9, QUESTION)], "item_id long, text string"))
    assert {r["doc_id"] for r in kept.collect()} == set(range(40)) - {3}


def test_short_items_are_found_word_for_word(spark):
    ask = "What is the capital of France?"
    docs = [(1, f"{prose(1, 20)} {ask} {prose(2, 20)}"), (2, ask.replace("France", "Spain")), (3, "what is the capital of France"), (4, prose(3, 40) + " what is the capital"), (None, "Add 2 and 5"), (5, "Add 2 and 6 !")]
    items = [(1, ask), (2, "add 2 and 5"), (3, "?!"), (4, ""), (5, None), (6, QUESTION)]
    assert leaked(spark, docs, items) == {(1, 1): True, (3, 1): True, (None, 2): True}


def test_decontamination_of_odd_documents(spark):
    docs = odd(spark)
    items = spark.createDataFrame([(1, odd_rows()[0][1]), (1, odd_rows()[0][1])], "item_id long, text string")
    got = {r["doc_id"] for r in decontamination.leaks(docs, items).collect()}
    assert got == {1, 2, 6, 10, 11}
    kept = decontamination.drop_leaks(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 5
    assert decontamination.leaks(docs, items.limit(0)).count() == 0
    assert decontamination.leaks(empty(spark), items).count() == 0


def quotas(sizes, share=1.5, limit=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > limit * sizes[s]]
        if not full:
            return target | {s: left * weight[s] / total for s in open_}
        for s in full:
            target[s] = float(limit * sizes[s])
            open_.remove(s)
        left -= sum(target[s] for s in full)
    return target


def test_mixing_of_odd_documents(spark):
    sizes = defaultdict(int)
    for r in odd_rows():
        sizes[r[3]] += len(words(r[1]))
    want = quotas(dict(sizes))
    got = mixing.mix(odd(spark)).collect()
    assert len(got) == len(odd_rows())
    taken = defaultdict(int)
    for r in got:
        taken[r["source"]] += r["taken"]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, r["target"])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert all(0 <= p <= 1 for p in r["positions"])
    for source, n in taken.items():
        assert n == int(want[source])
    again = mixing.mix(odd(spark).repartition(5)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert mixing.mix(empty(spark)).count() == 0


def test_positions_follow_the_schedule(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "s") for i in range(400)], "doc_id long, text string, source string")
    rows = mixing.mix(docs, weights=(1,), share=1.0, curves=(((0.0, 3.0), (0.5, 1.0), (1.0, 0.0)),)).collect()
    times = sorted(p for r in rows for p in r["positions"])
    # The curve's integral up to t, scaled to 1, is the share of words before t.
    for t, share in ((0.25, (3 + 2) / 2 * 0.25 / 1.25), (0.5, 0.8), (0.75, 0.8 + 0.75 * 0.25 / 1.25)):
        assert abs(sum(x < t for x in times) / len(times) - share) < 0.01
    placed = [r["position"] for r in mixing.ordered(mixing.mix(docs)).collect()]
    assert [p for p in placed if p is not None] == sorted(p for p in placed if p is not None)


def test_the_mix_gives_a_position_for_every_pass(spark):
    docs = spark.createDataFrame([(i, "w " * 10, f"s{i % 2}") for i in range(40)], "doc_id long, text string, source string")
    rows = corpus_pipeline.mix_sources(spark, docs, "").collect()
    assert len(rows) == 40 and any(r["taken"] == 20 for r in rows)
    for r in rows:
        assert len(r["positions"]) == -(-r["taken"] // 10)
        assert r["position"] == (int(r["positions"][0] * 1e6) if r["positions"] else None)


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, spark.createDataFrame(stage(spark, kept, folder).collect(), docs.schema)
        assert kept.columns == columns, name
        assert kept.join(before, columns, "left_anti").count() == 0, name
    texts = [" ".join(words(r["text"])) for r in kept.collect()]
    assert len(texts) == len(set(texts))
    want = sorted(r["doc_id"] for r in kept.collect())
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r["doc_id"] for r in got) == want
    assert decontamination.leaks(kept, spark.read.parquet(f"{folder}/benchmark.parquet")).count() == 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "mixing"]


def test_pipeline_stages_take_odd_and_empty_documents(spark):
    folder = "/root/testdata/sf0.001"
    for docs in (odd(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, folder).collect()


def test_leaks_equal_their_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    item = "Tom buys 4 pens for $3 each. Tom then sells 2 pens to Anna for $5 each. How much money does Tom have left if he began with $20 today?"
    other = item.replace("$20", "$75").replace("Tom", "Lena").replace("Anna", "Paul").replace(" 4 ", " 9 ").replace(" 2 ", " 6 ").replace("$3", "$8").replace("$5", "$7")
    texts = [QUESTION, QUESTION.replace("12 apples and", "71 apples and"), QUESTION.replace("12", "7").replace(" 5 ", " 7 "), other, item.upper(), None, "", "What is 2 + 2 ?!"]
    texts += [" ".join(str(j) for j in range(30)), "5 apples 6 apples 7 apples 8 apples", item[:70] + other[70:], "Tom's pens. " + other]
    docs = [(k, f"{prose(k, 20)} {t} {prose(k + 50, 9)}" if k % 2 and t else t) for k, t in enumerate(texts * 2)]
    items = [(1, QUESTION), (2, item), (3, "what is 2 + 2"), (4, None), (5, "..."), (6, " ".join(str(j) for j in range(3, 19))), (7, "12 apples 13 apples 14 apples 15 apples")]
    got = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        con.execute(f"create table {name} ({key} bigint, text varchar)")
        con.executemany(f"insert into {name} values (?, ?)", rows)
    want = con.execute(f"select doc_id, item_id, windows, item_windows, verbatim from ({ORACLES['op2_decontamination']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 15


def test_targets_of_many_sources(spark):
    for seed in (1, 2, 3):
        rng = random.Random(seed)
        sizes = {f"src{k}": rng.choice([3, 50, 60, 70, 900]) + rng.randrange(40) for k in range(23)}
        sized = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r["source"]: r["target"] for r in mixing.targets(sized).collect()}
        want = quotas(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * want[s] for s in want)
        assert all(0 < got[s] <= 2 * sizes[s] for s in sizes) and abs(sum(got.values()) - 1.5 * sum(sizes.values())) < 1e-3


def test_templates_of_odd_words_come_from_passes_over_whole_texts(spark):
    told = "He said,  Tom's 5 Km run\tcost $5k or -3.5€; (Ann) walked ... 12kg 7 ?! kg. ended. Bob\nsaw 1/2 Ké <NUM> ΑΣ"
    df = spark.createDataFrame([(1, told), (2, None), (3, " \n"), (4, "... Tom"), (5, "a Tom  4 Kg")], "doc_id long, text string")
    spelled = decontamination._spelled(df, "doc_id", decontamination.FORMS)
    rows = {r["doc_id"]: r for r in spelled.collect()}
    narrow = "he said tom's <num> <unit> run cost $5k or -35€ <name> walked  <num><unit> <num>  kg ended bob saw <num> ké <num> ας"
    broad = "<name> said <name's> <num> <unit> run cost <money> or <money> <name> walked  <num><unit> <num>  kg ended <name> saw <num> <name> <num> ας"
    assert rows[1]["words"] == told.split()
    assert rows[1]["t1"] == broad.split(" ")
    assert rows[1]["t0"] == narrow.split(" ")
    assert rows[2]["words"] == rows[3]["words"] == rows[2]["t0"] == rows[3]["t1"] == []
    assert rows[4]["t0"] == ["", "tom"] and rows[4]["t1"] == ["", "<name>"]
    assert rows[5]["t0"] == rows[5]["t1"] == ["a", "<name>", "<num>", "<unit>"]
    # word by word only the hashes are left to do
    plan = spelled._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction(") == 2
