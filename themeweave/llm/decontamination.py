"""Benchmark decontamination by template windows, in DataFrame operations only.

Words become templates: numbers, units and names are typed placeholders, all else is
lower-cased without punctuation. There are two forms. In the narrow one a capitalised
word is a name where it does not begin a sentence; the broad one takes names at any
place, and knows possessives and amounts of money. Windows of ``WINDOW`` template words
of items and documents are joined by hash, form by form; a window of placeholders
only, which every table of numbers holds, is joined by its values instead.

Along one diagonal (document place minus item place) the values behind the placeholders
must correspond one to one; if they do, the question was copied, perhaps with other
numbers and names. If they do not, those windows count that hold the item's own values,
and those of runs that are one to one in themselves and long enough for a leak.

A document leaks an item if ``RUN`` windows of one diagonal count (13 words in a row
make 6), or half of the item's windows do, in either form.

Of the documents' windows only those that may be in the benchmark leave the row: some
of their words are looked up in a bitmap of the benchmark's words (128 KiB), then their
hash in one of its windows (128 KiB to 8 MiB, by their number). These and the bitmap of
leaked ids, 2 MiB, are all that is broadcast.

An item of fewer than ``WINDOW`` words is one window of its own length, and is leaked
where a document holds its words as they are, but for case and punctuation.

Defined results: null and empty texts leak nothing, nor do items without a word of
more than punctuation. Rows that repeat a doc_id are one document; a null doc_id
is a document. Items that repeat a text are reported each. Columns other than doc_id
and text, item_id and text are ignored by ``leaks``; ``drop_leaks`` keeps them.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

WINDOW = 8
RUN = 6
SHARE = 0.5
BITS, MOST_BITS = 20, 26  # binary logarithms of the bitmap's least and greatest size
ID_BITS = 24
FORMS = (False, True)  # narrow, broad

WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"  # but for one space, which may stay
PUNCTUATION = ".,;:!?\"()[]"
CURRENCIES = "$\u20ac\u00a3\u00a5"
UNITS = "% mm cm m km in ft mi g kg mg t lb oz s ms min h hours minutes seconds days years l ml usd eur dollars euros cents degrees percent".split()

# Patterns of whole words of a text ``_joined`` by spaces. The class at the end of END is what ``$`` passes over.
_TAIL = r"[\x85\u2028\u2029]?"
_END = _TAIL + r"(?= )"
_DIGITS = r"[0-9]+([.,/:-][0-9]+)*"
NUMBER = rf" [+-]?{_DIGITS}{_END}"
MEASURE = rf" [+-]?{_DIGITS}[A-Za-z%]+{_END}"
UNIT = "( \tnum>) \x0b?(" + "|".join("".join(f"[{c}{c.upper()}\u212a]" if c == "k" else f"[{c}{c.upper()}]" for c in u) for u in UNITS) + ")(?= )"
MONEY = rf" ([+-]?[{CURRENCIES}]{_DIGITS}[A-Za-z]?{_END}|[+-]{_DIGITS}[{CURRENCIES}]{_END}|{_DIGITS}[{CURRENCIES}](?= ))"
# a capital letter that has a small one
_CAPITAL = r"[\p{Lu}&&[^\u03d2-\u03d4\u2102-\u2125\u2127-\u2129\u212c-\u2131\u2133-\u2145\x{1D400}-\x{1D7FF}]]"
NAME = rf"{_CAPITAL}\p{{Ll}}+{_END}"
POSSESSIVE = rf" \x0b?\p{{Lu}}\p{{Ll}}+['\u2019]s?{_END}"
OWNER = r"^(\p{Lu}\p{Ll}+)['\u2019]s?$"
# a capital after a word at whose end a sentence does not begin
RUNS_ON = rf" (?<=[\p{{Ll}},;]{_TAIL} )(?=[.,;:!?\"()\[\]]*\p{{Lu}})"


def _joined(text: Column) -> Column:
    """The words with one space before, between and after them."""
    return F.regexp_replace(F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" ")), SEPARATORS, " ")


def _parted(joined: Column) -> Column:
    every = F.split(joined, " ")
    return F.slice(every, 2, F.size(every) - 2)


def _template(joined: Column, broad: bool | None) -> Column:
    """All words' templates, still joined.

    Patterns run over whole texts, not word by word. Two separators, which no word holds,
    are the marks: a tab begins a placeholder, a vertical tab a capital that may be a name
    in the narrow form. Other words stay, so words and templates have the same places.
    """
    marked = joined if broad is None else F.regexp_replace(joined, RUNS_ON, " \x0b")
    t = F.regexp_replace(marked, r"[.,;:!?\"()\[\]]+", "")
    if broad is not None:
        t = F.regexp_replace(F.regexp_replace(t, MEASURE, " \tnum>\tunit>"), NUMBER, " \tnum>")
        t = F.regexp_replace(t, UNIT, "$1 \tunit>")
        if broad:
            t = F.regexp_replace(F.regexp_replace(t, MONEY, " \tmoney>"), POSSESSIVE, " \tname's>")
        t = F.regexp_replace(t, rf" \x0b{'?' if broad else ''}{NAME}", " \tname>")
        t = F.replace(F.replace(t, F.lit("\t"), F.lit("<")), F.lit("\x0b"), F.lit(""))
    return F.lower(t)


def _places(width: int) -> Column:
    n = F.size("words")
    return F.when(n >= width, F.sequence(F.lit(1), n - width + 1)).otherwise(F.array().cast("array<int>"))


def _spelled(df: DataFrame, key: str, forms: tuple[bool | None, ...]) -> DataFrame:
    """key, words, for every form a template and its words' hashes (t0, h0, t1, h1); of the form None all words are literal."""
    rows = df.select(F.col(key).cast("long").alias(key), _joined(F.col("text")).alias("joined"))
    templates = [_parted(_template(F.col("joined"), broad)).alias(f"t{k}") for k, broad in enumerate(forms)]
    spelled = rows.select(key, _parted(F.col("joined")).alias("words"), *templates)
    return spelled.select("*", *[F.transform(f"t{k}", lambda t: F.xxhash64(t)).alias(f"h{k}") for k in range(len(forms))])


def _value(word: Column, broad: bool | None) -> Column:
    bare = F.translate(word, PUNCTUATION, "")
    return F.regexp_replace(bare, OWNER, "$1") if broad else bare


def _slots(words: Column, template: Column, broad: bool | None) -> Column:
    """Values of the places of a window that hold placeholders."""
    both = F.zip_with(template, words, lambda t, w: F.struct(t.alias("t"), _value(w, broad).alias("value")))
    return F.transform(F.filter(both, lambda x: x["t"].startswith("<")), lambda x: x["value"])


def _hash(words: Column, template: Column, form: int) -> Column:
    """Of a window, to join by; one of placeholders only goes by its words."""
    bare = F.transform(words, lambda w: F.translate(w, PUNCTUATION, ""))
    only = F.forall(template, lambda t: t.startswith("<"))
    return F.when(only, F.xxhash64(F.lit(form), F.lit("values"), bare)).otherwise(F.xxhash64(F.lit(form), template))


def _look(form: int, place: Column, width: int) -> Column:
    return F.xxhash64(F.lit(form), F.slice(f"h{form}", place, width))


def item_windows(benchmark: DataFrame, width: int, forms: tuple[bool | None, ...] = FORMS) -> DataFrame:
    """item_id, form, item_place, look, codes, h, item_slots, item_windows; ``look`` and ``codes`` are what the bitmaps know."""
    rows = _spelled(benchmark, "item_id", forms)
    placed = rows.withColumn("item_place", F.explode(_places(width))).withColumn("w", F.slice("words", F.col("item_place"), width))
    found = None
    for form, broad in enumerate(forms):
        t = F.slice(f"t{form}", F.col("item_place"), width)
        some = placed.select(
            "item_id",
            F.lit(form).alias("form"),
            "item_place",
            _look(form, F.col("item_place"), width).alias("look"),
            F.slice(f"h{form}", F.col("item_place"), width).alias("codes"),
            _hash(F.col("w"), t, form).alias("h"),
            _slots(F.col("w"), t, broad).alias("item_slots"),
            (F.size("words") - width + 1).alias("item_windows"),
        )
        found = some if found is None else found.union(some)
    return found


def bitmap(hashes: DataFrame, bits: int = BITS) -> DataFrame:
    """One row, one array ``bits``: the bits at the low ends of all hashes h. Its size does not depend on theirs."""
    low = F.col("h").bitwiseAND((1 << bits) - 1)
    words = hashes.select(F.shiftright(low, 6).alias("word"), low.bitwiseAND(63).cast("int").alias("bit"))
    set_ = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("set"))
    every = hashes.sparkSession.range(1 << (bits - 6)).withColumnRenamed("id", "word")
    filled = every.join(set_, "word", "left").select("word", F.coalesce("set", F.lit(0)).alias("set"))
    return filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "set"))), lambda x: x["set"]).alias("bits"))


def document_windows(docs: DataFrame, items: DataFrame, width: int, forms: tuple[bool | None, ...] = FORMS) -> DataFrame:
    """doc_id, form, place, h, slots of the windows that may be in the benchmark."""
    bits = min(MOST_BITS, max(BITS, (16 * items.count()).bit_length()))
    known = F.broadcast(bitmap(items.select(F.col("look").alias("h")), bits))  # 2**bits bits
    words = bitmap(items.select(F.explode("codes").alias("h")), BITS).withColumnRenamed("bits", "word_bits")
    rows = _spelled(docs, "doc_id", forms).crossJoin(known).crossJoin(F.broadcast(words))  # with one row each
    # All words of a window must be words of the benchmark: a few are looked at before the window is hashed.
    listed = [F.transform(f"h{k}", lambda h: _has("word_bits", h, BITS)).alias(f"in{k}") for k in range(len(forms))]
    rows = rows.select("*", *listed)
    looked_at = sorted({0, width - 1, width // 2, width // 4, 3 * width // 4})

    def maybe(x: Column) -> Column:
        return _has("bits", x["look"], bits)

    def found(form: int, broad: bool | None) -> Column:
        def hashed(i: Column) -> Column:
            return F.struct(i.alias("place"), _look(form, i, width).alias("look"))

        def with_slots(x: Column) -> Column:
            w, t = F.slice("words", x["place"], width), F.slice(f"t{form}", x["place"], width)
            return F.struct(F.lit(form).alias("form"), x["place"].alias("place"), _hash(w, t, form).alias("h"), _slots(w, t, broad).alias("slots"))

        def possible(i: Column) -> Column:
            return functools.reduce(lambda a, b: a & b, [F.get(f"in{form}", i - 1 + k) for k in looked_at])

        places = F.filter(_places(width), possible)
        return F.transform(F.filter(F.transform(places, hashed), maybe), with_slots)

    every = F.concat(*[found(form, broad) for form, broad in enumerate(forms)])
    return rows.select("doc_id", F.inline(every))


def _has(bits: str, h: Column, n: int) -> Column:
    at = h.bitwiseAND((1 << n) - 1)
    return F.bit_get(F.get(bits, F.shiftright(at, 6).cast("int")), at.bitwiseAND(63).cast("int")) == 1


def short_leaks(docs: DataFrame, benchmark: DataFrame, width: int) -> list[DataFrame]:
    """Documents that hold an item of fewer than ``width`` words as it is, as ``leaks`` gives them; a frame per length."""
    n = F.regexp_count("text", F.lit(WORD))
    worded = F.translate("text", PUNCTUATION + " \t\n\x0b\f\r", "") != ""
    short = benchmark.where((n < width) & worded).withColumn("n_words", n)
    out = []
    for length in sorted(r[0] for r in short.select("n_words").distinct().collect()):  # fewer than width
        items = materialize(item_windows(short.where(F.col("n_words") == length), length, (None,)), "short-items")
        held = document_windows(docs, items, length, (None,)).select("doc_id", "h").distinct()
        met = held.join(items, "h").select("doc_id", "item_id").distinct()
        one = F.lit(1).cast("long")
        out.append(met.select("doc_id", "item_id", one.alias("windows"), one.alias("item_windows"), F.lit(True).alias("verbatim")))
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, run: int = RUN, share: float = SHARE) -> DataFrame:
    """One row per leaked pair: doc_id, item_id, windows, item_windows, verbatim.

    ``windows`` is the number of the item's windows that count, in the form that has
    more, and ``verbatim`` says that all values behind their placeholders are the item's own.
    """
    items = materialize(item_windows(benchmark, width), "item-windows")
    met = document_windows(docs, items, width).join(items, ["form", "h"])
    pairs = F.arrays_zip(F.col("item_slots").alias("a"), F.col("slots").alias("b"))
    diagonals = met.groupBy("doc_id", "item_id", "form", (F.col("place") - F.col("item_place")).alias("diagonal")).agg(
        F.max("item_windows").alias("item_windows"),
        F.collect_set("item_place").alias("places"),  # at most as many as the item has windows
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"),
        F.array_sort(F.collect_set(F.struct("item_place", pairs.alias("pairs")))).alias("met"),
    )

    def one_to_one(pairs: Column) -> Column:
        sides = [F.size(F.array_distinct(F.transform(pairs, lambda p: p[side]))) for side in ("a", "b")]
        return (sides[0] == F.size(pairs)) & (sides[1] == F.size(pairs))

    def consistent() -> Column:
        """Places of the windows with the item's own values, and of runs that are one to one in themselves."""
        needed = F.least(F.lit(run), F.ceil(share * F.col("item_windows")).cast("int"))
        own = F.transform(F.filter("met", lambda m: F.forall(m["pairs"], lambda p: p["a"] == p["b"])), lambda m: m["item_place"])

        def places(m: Column, i: Column) -> Column:
            near = F.slice("met", i + 1, needed)
            place = m["item_place"]
            whole = F.get(near, needed - 1)["item_place"] == place + needed - 1
            fits = one_to_one(F.array_distinct(F.flatten(F.transform(near, lambda x: x["pairs"]))))
            return F.when(whole & fits, F.sequence(place, place + needed - 1)).otherwise(F.array().cast("array<int>"))

        return F.array_union(own, F.flatten(F.transform("met", places)))

    judged = diagonals.select(
        "doc_id",
        "item_id",
        "form",
        "item_windows",
        F.when(one_to_one(F.col("pairs")), F.col("places")).otherwise(consistent()).alias("places"),
        F.forall("pairs", lambda p: p["a"] == p["b"]).alias("same"),
    )
    both = judged.groupBy("doc_id", "item_id", "form").agg(
        F.max("item_windows").cast("long").alias("item_windows"),
        F.size(F.array_distinct(F.flatten(F.collect_set("places")))).cast("long").alias("windows"),
        F.max(F.size("places")).alias("best"),
        F.bool_and("same").alias("verbatim"),
    )
    enough = (F.col("best") >= run) | (F.col("windows") >= share * F.col("item_windows"))
    found = both.where(enough & (F.col("windows") > 0)).select("doc_id", "item_id", "windows", "item_windows", "verbatim")
    # A pair may be found in both forms, and an id may stand for short and long texts.
    every = functools.reduce(DataFrame.union, short_leaks(docs, benchmark, width), found).groupBy("doc_id", "item_id")
    return every.agg(*(F.max(c).alias(c) for c in ("windows", "item_windows")), F.bool_and("verbatim").alias("verbatim"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that leak an item.

    A row whose id is not in the bitmap of leaked ids stays where it is; only the others
    meet the ids themselves.
    """
    found = materialize(leaks(docs, benchmark).select(F.col("doc_id").alias("leaked_id")).distinct(), "leaked-ids")
    code = F.xxhash64(docs["doc_id"].cast("long"))
    known = F.broadcast(bitmap(found.select(F.xxhash64("leaked_id").alias("h")), ID_BITS).withColumnRenamed("bits", "__leaked_bits"))
    marked = docs.crossJoin(known).withColumn("__leaked", _has("__leaked_bits", code, ID_BITS)).drop("__leaked_bits")  # with one row
    sure = marked.where(~F.col("__leaked")).drop("__leaked")
    doubtful = marked.where("__leaked").drop("__leaked")
    return sure.union(doubtful.join(found, doubtful["doc_id"].eqNullSafe(found["leaked_id"]), "left_anti"))
