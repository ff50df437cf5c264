import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from themeweave.functions import text as tx
from themeweave.operators import selection

# Texts and what cleaning has to leave of them, written out by hand.
CLEANED = [
    ('a href="http://x.y/z">text</a> tail', 'a href=" tail'),
    ("xhttp://glued www.site.org/a b", "x b"),
    ("1 < 2 > 0", "1 0"),
    ("<b\nclass='x'>bold</b>\x1c\x85end", "bold end"),
    ("  thin\u2009 and\u3000 wide ", "thin and wide"),
    ("<script>var x=1</script>", "var x=1"),
    ("no markup", "no markup"),
    ("", ""),
]
PROBES = [before for before, _ in CLEANED]


def apply(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("s")).cast(kind)).collect()]


def test_clean_text_of_known_texts(spark):
    assert apply(spark, PROBES, tx.clean_text) == [after for _, after in CLEANED]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_characters="\x00"), max_size=40), min_size=20, max_size=40))
def test_properties_of_cleaned_text(spark, values):
    values = [v + " http://a b <i>" + v for v in values]
    cleaned = apply(spark, values, tx.clean_text)
    again = apply(spark, cleaned, lambda c: tx.clean_text(tx.clean_text(c)))
    for text, twice in zip(cleaned, again):
        assert text == " ".join(text.split()) and "http://" not in text and "<i>" not in text
        assert twice == " ".join(twice.split()) and len(twice) <= len(text)


def test_tokens_equal_python_word_runs(spark):
    probes = PROBES + ["Não é_um 2º teste, árvore-alta x y2 covid-19", "ÀÉÎ õü"]
    got = apply(spark, probes, tx.tokenize, "array<string>")
    assert got == [re.findall(r"\b\w\w+\b", p.lower()) for p in probes]


def test_stopwords_are_removed_after_lowercasing(spark):
    assert apply(spark, ["A casa e Também o JARDIM"], lambda c: tx.remove_stopwords(tx.tokenize(c)), "array<string>") == [["casa", "jardim"]]


def test_model_text_of_empty_parts(spark):
    rows = [(1, None, "x" * 60), (2, "t", None), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id int, title string, text string")
    got = {r["doc_id"]: r["texto_modelo"] for r in selection.clean_corpus(df).collect()}
    assert got == {1: ". " + "x" * 60, 2: "t.", 3: "."}


def test_length_filter_keeps_fifty(spark):
    rows = [(1, "a" * 48, ""), (2, "a" * 49, ""), (3, "é" * 49, None)]
    df = spark.createDataFrame(rows, "doc_id int, title string, text string")
    assert sorted(r["doc_id"] for r in selection.preprocess_corpus(df).collect()) == [2, 3]


def test_excerpt_always_ends_in_dots(spark):
    assert apply(spark, ["short", "y" * 400], tx.excerpt) == ["short...", "y" * 300 + "..."]


def test_keyword_list_is_matched_not_evaluated(spark):
    values = ["['coronavírus', 'covid-19']", "['a', \"it's\"]", "[]", "__import__('os')"]
    got = apply(spark, values, tx.parse_keyword_list, "array<string>")
    assert got == [["coronavírus", "covid-19"], ["a", "it's"], [], ["os"]]


def test_dates_parse_or_fail(spark):
    import pytest

    df = spark.createDataFrame([("2020-02-01T10:20:30Z",), ("2020-02-01",), ("soon",)], "s string")
    lenient = [r[0] for r in df.select(selection.parse_iso_date(F.col("s"), lenient=True).cast("string")).collect()]
    assert lenient == ["2020-02-01 10:20:30", "2020-02-01 00:00:00", None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(selection.parse_iso_date(F.col("s"))).collect()


def test_length_filter_does_not_clean_twice(spark):
    df = spark.createDataFrame([(1, "t", "x")], "doc_id int, title string, text string")
    plan = selection.preprocess_corpus(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(") == plan.split("Generate inline")[1].count("regexp_replace(")
