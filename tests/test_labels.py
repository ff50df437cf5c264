import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from themeweave import schemas
from themeweave.functions.templates import DEFAULT_TEMPLATE
from themeweave.operators import labeling, terms
from themeweave.plans.queries import echo_client

GOOD = {
    "cluster_id": 0,
    "nome_topico": "Vacinas e hospitais",
    "palavras_chave": ["vacina", "hospital", "leito"],
    "resumo": "Cobertura de saude publica.",
    "nivel_confianca": 0.9,
}

# Labels of a recorded run; all of them passed.
RECORDED = [
    (0, "Pandemia de Coronavírus e Seus Impactos", 7, 0.9, False),
    (1, "Notícias Variadas de Cultura, Esporte e Obituários", 6, 0.2, True),
    (2, "Ações e Impactos Governamentais", 6, 0.4, True),
    (3, "Governo Bolsonaro e Polêmicas", 7, 0.9, False),
]


def variant(**changes):
    record = {**GOOD, **changes}
    return json.dumps({k: v for k, v in record.items() if v is not ...}, ensure_ascii=False)


def reasons(spark, raws, lenient=False):
    df = spark.createDataFrame([(0, i, r) for i, r in enumerate(raws)], "cluster_id int, i int, raw string")
    checked = labeling.validate_labels(labeling.parse_labels(df, lenient=lenient))
    return [sorted(r["reasons"]) for r in checked.orderBy("i").collect()]


CASES = [
    (variant(), []),
    (variant(possivel_ruido=True), []),
    (variant(extra={"a": [1]}), []),
    (variant(nivel_confianca=1), []),
    (variant(nivel_confianca=0), []),
    (variant(cluster_id=...), ["cluster_id"]),
    (variant(cluster_id="0"), ["cluster_id"]),
    (variant(cluster_id=0.5), ["cluster_id"]),
    (variant(cluster_id=None), ["cluster_id"]),
    (variant(cluster_id=4), ["cluster_mismatch"]),
    (variant(nome_topico="ab"), ["nome_topico"]),
    (variant(nome_topico="abc"), []),
    (variant(nome_topico="x" * 60), []),
    (variant(nome_topico="x" * 61), ["nome_topico"]),
    (variant(nome_topico=" " * 61 + "abc"), ["nome_topico"]),
    (variant(nome_topico=12345), ["nome_topico"]),
    (variant(nome_topico=...), ["nome_topico"]),
    (variant(nome_topico="  OuTRos "), ["nome_generico"]),
    (variant(nome_topico="VÁRIOS"), ["nome_generico"]),
    (variant(nome_topico="Outros temas"), []),
    (variant(palavras_chave=["a", "b"]), ["palavras_chave"]),
    (variant(palavras_chave=list("abcdefgh")), []),
    (variant(palavras_chave=list("abcdefghi")), ["palavras_chave"]),
    (variant(palavras_chave=[]), ["palavras_chave"]),
    (variant(palavras_chave=["a", 2, "c"]), ["palavras_chave"]),
    (variant(palavras_chave=["a", None, "c"]), ["palavras_chave"]),
    (variant(palavras_chave=[None, None, None]), ["palavras_chave"]),
    (variant(palavras_chave="a, b, c"), ["palavras_chave"]),
    (variant(resumo="x" * 9), ["resumo"]),
    (variant(resumo="x" * 10), []),
    (variant(resumo="x" * 400), []),
    (variant(resumo="x" * 401), ["resumo"]),
    (variant(nivel_confianca=1.0001), ["nivel_confianca"]),
    (variant(nivel_confianca=-0.1), ["nivel_confianca"]),
    (variant(nivel_confianca="0.5"), ["nivel_confianca"]),
    (variant(nivel_confianca="NaN"), ["nivel_confianca"]),
    (variant(nivel_confianca=float("nan")), sorted(["parse", "cluster_id", "nome_topico", "palavras_chave", "resumo", "nivel_confianca", "possivel_ruido"])),
    (variant(possivel_ruido=None), ["possivel_ruido"]),
    (variant(possivel_ruido="yes"), ["possivel_ruido"]),
    ("not json", sorted(["parse", "cluster_id", "nome_topico", "palavras_chave", "resumo", "nivel_confianca", "possivel_ruido"])),
    (None, sorted(["parse", "cluster_id", "nome_topico", "palavras_chave", "resumo", "nivel_confianca", "possivel_ruido"])),
    ("[1, 2]", sorted(["cluster_id", "nome_topico", "palavras_chave", "resumo", "nivel_confianca"])),
]


def test_each_rule(spark):
    got = reasons(spark, [raw for raw, _ in CASES])
    wrong = [(raw, g, want) for (raw, want), g in zip(CASES, got) if g != want]
    assert wrong == []


def test_lenient_coercions(spark):
    raws = [
        variant(cluster_id="0"), variant(cluster_id=0.0), variant(cluster_id=False), variant(possivel_ruido="yes"),
        variant(possivel_ruido=0), variant(nivel_confianca="0.5"), variant(cluster_id=3.5), variant(nome_topico=12345),
        variant(possivel_ruido="maybe"), variant(),
    ]
    assert reasons(spark, raws, lenient=True) == [[], [], [], [], [], [], ["cluster_id"], ["nome_topico"], ["possivel_ruido"], []]


def test_recorded_labels_pass(spark):
    rows = [
        (i, json.dumps({"cluster_id": i, "nome_topico": n, "palavras_chave": ["termo"] * k, "resumo": "Um resumo do grupo.", "nivel_confianca": c, "possivel_ruido": r}))
        for i, n, k, c, r in RECORDED
    ]
    df = spark.createDataFrame(rows, "cluster_id int, raw string")
    labels = labeling.valid_labels(labeling.validate_labels(labeling.parse_labels(df))).orderBy("cluster_id")
    assert labels.schema.simpleString() == schemas.LABEL.simpleString()
    assert [(r["cluster_id"], r["nome_topico"], len(r["palavras_chave"]), r["nivel_confianca"], r["possivel_ruido"]) for r in labels.collect()] == RECORDED


def test_names_are_trimmed_and_hints_given(spark):
    raw = variant(nome_topico="  Copa  ", possivel_ruido=True, nivel_confianca=0.8)
    df = spark.createDataFrame([(0, raw)], "cluster_id int, raw string")
    row = labeling.validate_labels(labeling.parse_labels(df)).first()
    assert row["nome_topico"] == "Copa" and row["reasons"] == []
    assert sorted(row["warnings"]) == ["name_words", "noise_with_confidence"]


def test_template_values_may_contain_braces(spark):
    template = "{{x}} {cluster_id}|{palavras_chave}|{exemplos} {{}}"
    keywords = spark.createDataFrame([(3, "{exemplos}, }}")], "cluster_id int, palavras_chave string")
    examples = spark.createDataFrame([(3, "{cluster_id} {{")], "cluster_id int, exemplos string")
    got = labeling.render_prompts(keywords, examples, template).first()["prompt"]
    assert got == template.format(cluster_id=3, palavras_chave="{exemplos}, }}", exemplos="{cluster_id} {{")


def test_default_template_renders_like_format(spark):
    keywords = spark.createDataFrame([(3, "a, b")], "cluster_id int, palavras_chave string")
    examples = spark.createDataFrame([(3, "- x")], "cluster_id int, exemplos string")
    got = labeling.render_prompts(keywords, examples).first()["prompt"]
    assert got == DEFAULT_TEMPLATE.format(cluster_id=3, palavras_chave="a, b", exemplos="- x")


def test_examples_in_order_and_chosen(spark):
    rows = [(i, f"t{i}", f"corpo {i}", 0) for i in range(6)] + [(9, None, None, 1), (10, "n", "n", -1)]
    df = spark.createDataFrame(rows, "doc_id long, title string, text string, c int")
    got = {r["cluster_id"]: r["exemplos"] for r in labeling.example_blocks(df, "c").collect()}
    assert got[0] == "\n".join(f"- Título: t{i}\n  Início: corpo {i}..." for i in range(4))
    assert got[1] == "- Título: \n  Início: ..." and -1 not in got
    chosen = spark.createDataFrame([(0, 5, 1), (0, 2, 2)], "cluster_id int, doc_id long, rk int")
    picked = labeling.example_blocks(df, "c", chosen=chosen).collect()
    assert [r["exemplos"].count("t5") and r["exemplos"].index("t5") < r["exemplos"].index("t2") for r in picked] == [True]


def prompts(spark, n):
    return spark.range(n).selectExpr("cast(id as int) as cluster_id", "concat('p', id) as prompt")


def test_retries_and_final_failure(spark, tmp_path):
    log = tmp_path / "waits"

    def wait(seconds):
        with log.open("a") as f:
            f.write(f"{seconds} ")

    def make():
        seen = {}

        def ask(cluster_id, prompt):
            seen[cluster_id] = seen.get(cluster_id, 0) + 1
            if cluster_id == 2 or (cluster_id == 1 and seen[1] < 3):
                raise labeling.ServiceError("busy")
            return "{}", 5, 1

        return ask

    rows = sorted(labeling.infer_batches(prompts(spark, 3), make, concurrency=1, wait=wait).collect(), key=lambda r: r["cluster_id"])
    assert [(r["attempts"], r["tokens_in"], r["error"] is None) for r in rows] == [(1, 5, True), (3, 5, True), (3, 0, False)]
    assert log.read_text().split() == ["2.0", "4.0", "2.0", "4.0"]


def test_requests_in_flight_change_no_row(spark, tmp_path):
    log = tmp_path / "open"

    def make():
        lock, state = threading.Lock(), {"open": 0}

        def ask(cluster_id, prompt):
            with lock:
                state["open"] += 1
                with log.open("a") as f:
                    f.write(f"{state['open']} ")
            time.sleep(0.02 * (1 + cluster_id % 3))
            with lock:
                state["open"] -= 1
            if cluster_id % 5 == 0:
                raise KeyError(cluster_id)
            return prompt.upper(), cluster_id, 1

        return ask

    def run(**options):
        log.write_text("")
        rows = labeling.infer_batches(prompts(spark, 24), make, concurrency=2, **options).collect()
        return sorted(map(tuple, rows)), max(map(int, log.read_text().split()))

    (one, alone), (many, together) = run(), run(in_flight=4)
    assert one == many and len(one) == 24
    assert alone == 1 and 1 < together <= 4


def test_pace_keeps_the_budget(spark, tmp_path):
    now, waited = [0.0], []

    def wait(seconds):
        waited.append(seconds)
        now[0] += seconds

    pace = labeling.Pace(0.5, wait, lambda: now[0])
    starts = []
    for pause in (0, 0, 0.2, 3.0, 0):
        now[0] += pause
        pace.turn()
        starts.append(now[0])
    assert starts == pytest.approx([0, 0.5, 1.0, 4.0, 4.5]) and len(waited) == 3

    log = tmp_path / "starts"

    def make():
        def ask(cluster_id, prompt):
            with log.open("a") as f:
                f.write(f"{time.monotonic()} ")
            return "{}", 1, 1

        return ask

    labeling.infer_batches(prompts(spark, 12), make, concurrency=1, in_flight=6, per_second=20).collect()
    at = sorted(map(float, log.read_text().split()))
    assert len(at) == 12 and at[-1] - at[0] > 0.5


def test_no_prompts_make_no_client(spark):
    def make():
        raise AssertionError("no call, no client")

    assert labeling.infer_batches(prompts(spark, 3).limit(0), make, in_flight=3).count() == 0
    with pytest.raises(ValueError):
        labeling.infer_batches(prompts(spark, 1), make, in_flight=0)


def test_answers_are_not_asked_for_twice(spark, tmp_path):
    calls, path = tmp_path / "calls", str(tmp_path / "responses")

    def make():
        def ask(cluster_id, prompt):
            with calls.open("a") as f:
                f.write(f"{cluster_id} ")
            if cluster_id == 1 and calls.read_text().split().count("1") <= 3:
                raise labeling.ServiceError("down")
            return "{}", 1, 1

        return ask

    def run(n):
        rows = labeling.answered(prompts(spark, n), make, path, wait=lambda s: None).orderBy("cluster_id").collect()
        return [r["error"] is None for r in rows]

    assert run(2) == [True, False]
    assert run(3) == [True, True, True]
    assert sorted(calls.read_text().split()) == ["0", "1", "1", "1", "1", "2"]


def test_other_errors_become_rows(spark):
    def make():
        def ask(cluster_id, prompt):
            if cluster_id == 0:
                raise KeyError("bug")
            return "{}", 1, 1

        return ask

    rows = sorted(labeling.infer_batches(prompts(spark, 2), make).collect(), key=lambda r: r["cluster_id"])
    assert [(r["error"], r["attempts"]) for r in rows] == [("KeyError: 'bug'", 1), (None, 1)]


def test_other_prompts_are_asked_anew(spark, tmp_path):
    def make():
        return lambda cluster_id, prompt: (prompt.upper(), 1, 1)

    path = str(tmp_path / "responses")
    first = labeling.answered(prompts(spark, 2), make, path).orderBy("cluster_id").collect()
    changed = prompts(spark, 2).selectExpr("cluster_id", "concat(prompt, '!') as prompt")
    second = labeling.answered(changed, make, path).orderBy("cluster_id").collect()
    assert [r["raw"] for r in first] == ["P0", "P1"] and [r["raw"] for r in second] == ["P0!", "P1!"]


def test_a_crash_keeps_the_slices_before_it(spark, tmp_path):
    calls, path = tmp_path / "calls", str(tmp_path / "responses")

    def make_with(limit):
        def make():
            def ask(cluster_id, prompt):
                with calls.open("a") as f:
                    f.write(f"{cluster_id} ")
                if len(calls.read_text().split()) > limit:
                    raise SystemExit("lost")
                return "{}", 1, 1

            return ask

        return make

    with pytest.raises(Exception):
        labeling.answered(prompts(spark, 40), make_with(25), path, slice_rows=5, concurrency=1)
    kept = spark.read.parquet(path).count()
    assert 0 < kept < 40
    calls.write_text("")
    assert labeling.answered(prompts(spark, 40), make_with(1000), path, slice_rows=5).count() == 40
    assert len(calls.read_text().split()) == 40 - kept


def test_calls_are_spread_over_tasks(spark):
    many = prompts(spark, 500).coalesce(1)
    assert labeling.infer_batches(many, lambda: lambda c, p: ("{}", 1, 1)).select(F.spark_partition_id()).distinct().count() > 1


def test_cluster_without_vocabulary_terms_is_labelled(spark, tmp_path):
    rows = [(i, "t", w, w, i % 2) for i, w in enumerate(["bola gol", "voto urna"] * 4)] + [(9, "t", "unico", "unico", 7)]
    df = spark.createDataFrame(rows, "doc_id long, title string, text string, texto_modelo string, c int")
    terms_ = terms.ctfidf_top_terms(df, "c", n=2, pad_zero=True)
    assert terms_.where("cluster_id = 7").count() == 2 and terms_.where("cluster_id = 7 and score > 0").count() == 0
    asked = labeling.label_clusters(df, "c", lambda: lambda c, p: ("{}", 1, 1), str(tmp_path / "r"))[2]
    assert sorted(r["cluster_id"] for r in asked.collect()) == [0, 1, 7]


def test_lenient_labels_can_be_asked_for(spark, tmp_path):
    df = spark.createDataFrame([(i, "t", w, w, 0) for i, w in enumerate(["bola gol", "bola gol", "time", "time"])], "doc_id long, title string, text string, texto_modelo string, c int")

    def make():
        return lambda c, p: (json.dumps({**GOOD, "cluster_id": str(c), "nivel_confianca": "0.5"}), 1, 1)

    strict = labeling.label_clusters(df, "c", make, str(tmp_path / "a"))[0]
    lenient = labeling.label_clusters(df, "c", make, str(tmp_path / "b"), lenient=True)[0]
    assert strict.count() == 0 and [r["nivel_confianca"] for r in lenient.collect()] == [0.5]


def test_full_flow_with_service_failure(spark, tmp_path):
    words = {0: "bola gol time", 1: "voto urna lei", 2: "chuva sol vento"}
    rows = [(i, f"t{i}", words[i % 3], words[i % 3], i % 3) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, title string, text string, texto_modelo string, c int")

    def make():
        echo = echo_client()

        def ask(cluster_id, prompt):
            if cluster_id == 2:
                raise labeling.ServiceError("down")
            return echo(cluster_id, prompt)

        return ask

    labels, dead, responses = labeling.label_clusters(df, "c", make, str(tmp_path / "r"), wait=lambda s: None)
    assert {r["cluster_id"]: set(r["palavras_chave"]) for r in labels.collect()} == {0: set(words[0].split()), 1: set(words[1].split())}
    letters = dead.collect()
    assert [r["cluster_id"] for r in letters] == [2] and "down" in letters[0]["erro"] and letters[0]["resposta_crua"] == ""
    assert dead.schema.simpleString() == schemas.DEAD_LETTER.simpleString() and responses.count() == 3
    assert terms.ctfidf_top_terms(df, "c").select("cluster_id").distinct().count() == 3


def test_batches_explode_and_bad_ones_vanish(spark):
    rows = [(0, json.dumps({"rotulos": [GOOD, {**GOOD, "cluster_id": 1}]})), (1, "nope"), (2, '{"rotulos": 3}'), (3, '{"rotulos": []}')]
    items = labeling.explode_label_batch(spark.createDataFrame(rows, "batch_id int, raw string"))
    parsed = labeling.parse_labels(items).orderBy("pos").collect()
    assert [(r["batch_id"], r["pos"], r["label_id"], r["nome_topico"]) for r in parsed] == [(0, 0, 0, GOOD["nome_topico"]), (0, 1, 1, GOOD["nome_topico"])]


def test_strict_parse_defaults_only_the_absent_flag(spark):
    df = spark.createDataFrame([(0, variant()), (1, variant(possivel_ruido=None))], "cluster_id int, raw string")
    got = labeling.parse_labels(df).orderBy("cluster_id").select(F.col("possivel_ruido")).collect()
    assert [r[0] for r in got] == [False, None]
