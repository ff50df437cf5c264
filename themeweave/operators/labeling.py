"""Cluster labels: prompts, model calls, validation, quarantine."""

from __future__ import annotations

import itertools
import re
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import fixed_values as fv
from ..functions import text as tx
from ..functions.templates import DEFAULT_TEMPLATE
from ..session import materialize
from ..sources.readers import optional_source
from .sampling import first_n_per_cluster
from .terms import ctfidf_top_terms

MAX_TRIES = 3

# --- fixed values: words and numbers a lenient reader takes for booleans ------
TRUE_WORDS = ["true", "t", "yes", "y", "on", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "off", "0"]


class ServiceError(Exception):
    """A failure of the model service that is worth another try."""


def example_blocks(df: DataFrame, cluster_col: str, n: int = fv.EXAMPLES_PER_CLUSTER, chosen: DataFrame | None = None) -> DataFrame:
    """(cluster_id, exemplos): titles and excerpts of a cluster's example rows.

    By default the first rows in document order; ``chosen`` (cluster_id, doc_id,
    rk) names others, such as those nearest to the centroid. Text is cut to the
    excerpt before rows are ranked, so only short strings are sorted.
    """
    rows = df.where(F.col(cluster_col) != fv.NOISE).select(
        F.col(cluster_col).alias("cluster_id"),
        "doc_id",
        tx.null_to_empty(F.col("title")).alias("title"),
        tx.excerpt(F.col("text")).alias("opening"),
    )
    if chosen is None:
        picked = first_n_per_cluster(rows, "cluster_id", n)
    else:
        picked = rows.join(chosen.where(F.col("rk") <= n).select("cluster_id", "doc_id", "rk"), ["cluster_id", "doc_id"])
    block = F.concat(F.lit("- Título: "), F.col("title"), F.lit("\n  Início: "), F.col("opening"))
    return picked.groupBy("cluster_id").agg(tx.join_ranked(F.col("rk"), block, "\n").alias("exemplos"))


def keyword_lines(terms: DataFrame) -> DataFrame:
    """(cluster_id, palavras_chave): the ranked terms of each cluster on one line."""
    return terms.groupBy("cluster_id").agg(tx.join_ranked(F.col("rank"), F.col("term")).alias("palavras_chave"))


def cluster_list(df: DataFrame, cluster_col: str) -> DataFrame:
    """(cluster_id): the clusters that hold rows, noise left out."""
    return df.where(F.col(cluster_col) != fv.NOISE).select(F.col(cluster_col).alias("cluster_id")).distinct()


def render_template(template: str, values: dict[str, Column]) -> Column:
    """The template as one concatenation, split at its placeholders beforehand.

    Values are never scanned for braces, so they may contain any text.
    """
    parts = []
    for piece in re.split(r"(\{\{|\}\}|\{\w+\})", template):
        if piece in ("{{", "}}"):
            parts.append(F.lit(piece[0]))
        elif piece.startswith("{") and piece.endswith("}") and len(piece) > 2:
            parts.append(values[piece[1:-1]])
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def render_prompts(
    keywords: DataFrame, examples: DataFrame, template: str = DEFAULT_TEMPLATE, clusters: DataFrame | None = None
) -> DataFrame:
    """(cluster_id, prompt), one row per cluster.

    ``clusters`` (cluster_id) lists them; without it, those with keywords count.
    """
    listed = keywords if clusters is None else clusters.select("cluster_id").join(keywords, "cluster_id", "left")
    joined = listed.join(examples, "cluster_id", "left")
    prompt = render_template(template, {
        "cluster_id": F.col("cluster_id").cast("string"),
        "palavras_chave": tx.null_to_empty(F.col("palavras_chave")),
        "exemplos": tx.null_to_empty(F.col("exemplos")),
    })
    return joined.select(F.col("cluster_id").cast("int").alias("cluster_id"), prompt.alias("prompt"))


Client = Callable[[int, str], tuple[str, int, int]]


class Pace:
    """Starts calls at least ``gap`` seconds apart, from whichever thread they come."""

    def __init__(self, gap: float, wait: Callable[[float], None], clock: Callable[[], float] = time.monotonic):
        self.gap, self.wait, self.clock = gap, wait, clock
        self.lock, self.free = threading.Lock(), float("-inf")

    def turn(self) -> None:
        if self.gap <= 0:
            return
        with self.lock:
            now = self.clock()
            start = max(now, self.free)
            self.free = start + self.gap
        if start > now:
            self.wait(start - now)


def _asked(client: Client, cluster_id: int, prompt: str, pace: Pace, wait: Callable[[float], None]) -> tuple:
    """One row of answers; failures of the service are tried again."""
    for attempt in range(1, MAX_TRIES + 1):
        pace.turn()
        try:
            raw, used_in, used_out = client(cluster_id, prompt)
            return cluster_id, raw, None, attempt, used_in, used_out
        except ServiceError as error:
            failure = f"service error after {attempt} tries: {error}"
            if attempt < MAX_TRIES:
                wait(2.0**attempt)
        except Exception as error:
            return cluster_id, "", f"{type(error).__name__}: {error}", attempt, 0, 0
    return cluster_id, "", failure, MAX_TRIES, 0, 0


def infer_batches(
    prompts: DataFrame,
    make_client: Callable[[], Client],
    concurrency: int | None = None,
    wait: Callable[[float], None] = time.sleep,
    in_flight: int = 1,
    per_second: float | None = None,
) -> DataFrame:
    """(cluster_id, raw, error, attempts, tokens_in, tokens_out): one request per prompt.

    ``make_client`` runs once per task; the client takes (cluster_id, prompt)
    and returns (raw text, tokens in, tokens out). A ``ServiceError`` is tried
    again up to three times in all, after 2 and 4 seconds; the last failure is a
    row with an error and no usage, and so is any other exception of a call, which
    is not tried again. ``concurrency`` is the number of tasks that call at the same
    time, by default as many as there are cores.

    A task has up to ``in_flight`` requests open, each in a thread of its own, so with
    more than one the client must bear calls from several threads. ``per_second`` is a
    budget of calls for the whole job, further tries included; every task keeps to its
    equal share of it. Neither changes the rows.

    The result is lazy: write it out before using it twice, or calls are paid
    twice. ``answered`` does that.
    """
    if in_flight < 1 or (per_second is not None and per_second <= 0):
        raise ValueError("in_flight and per_second must be positive")
    tasks = concurrency or prompts.sparkSession.sparkContext.defaultParallelism
    prompts = prompts.repartition(tasks)
    gap = tasks / per_second if per_second else 0.0

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = ((int(c), p) for batch in batches for c, p in zip(batch["cluster_id"], batch["prompt"]))
        first = next(asked, None)
        if first is None:
            return
        client, pace, open_calls = make_client(), Pace(gap, wait), deque()
        threads = ThreadPoolExecutor(in_flight)
        try:
            for cluster_id, prompt in itertools.chain([first], asked):
                if len(open_calls) == in_flight:
                    yield pd.DataFrame([open_calls.popleft().result()], columns=schemas.RESPONSE.names)
                open_calls.append(threads.submit(_asked, client, cluster_id, prompt, pace, wait))
            # One row at a time, so that a lost task repeats few calls.
            while open_calls:
                yield pd.DataFrame([open_calls.popleft().result()], columns=schemas.RESPONSE.names)
        finally:
            threads.shutdown(cancel_futures=True)

    return prompts.select("cluster_id", "prompt").mapInPandas(ask, schemas.RESPONSE)


SLICE = 256  # prompts whose answers are committed together


def answered(prompts: DataFrame, make_client: Callable[[], Client], path: str, slice_rows: int = SLICE, **options) -> DataFrame:
    """Responses for all prompts, asking only what ``path`` holds no answer to yet.

    An answer belongs to its prompt: it is stored with the prompt's hash, so
    other prompts for the same clusters are asked anew. Prompts are asked in slices
    of about ``slice_rows``, each appended before the next is asked; a job that is
    run again after a failure pays only for what is missing.
    """
    spark = prompts.sparkSession
    keyed = prompts.withColumn("prompt_hash", F.sha2("prompt", 256))
    prompts = materialize(keyed, "prompts")  # used several times, one row per cluster
    stored_schema = T.StructType([*schemas.RESPONSE.fields, T.StructField("prompt_hash", T.StringType())])
    key = ["cluster_id", "prompt_hash"]
    known = optional_source(spark, path, stored_schema).where(F.col("error").isNull()).select(*key)
    missing = materialize(prompts.join(known, key, "left_anti"), "unanswered")
    slices = -(-missing.count() // slice_rows)
    for k in range(slices):
        part = missing.where(F.pmod(F.xxhash64(*key), F.lit(slices)) == k)
        replies = infer_batches(part, make_client, **options)
        replies.join(part.select(*key), "cluster_id").write.mode("append").parquet(path)
    stored = optional_source(spark, path, stored_schema)
    # An earlier failure gives way to a later answer.
    best = F.min_by(F.struct(*[c for c in schemas.RESPONSE.names if c != "cluster_id"]), F.col("error").isNotNull())
    mine = stored.join(prompts.select(*key), key, "left_semi")
    return mine.groupBy("cluster_id").agg(best.alias("r")).select("cluster_id", "r.*")


# --- reading responses --------------------------------------------------------


def _kind(variant: Column, field: str) -> Column:
    """JSON type of a field: null if absent, VOID for a JSON null."""
    return F.schema_of_variant(F.try_variant_get(variant, f"$.{field}", "variant"))


def _is_integer(kind: Column) -> Column:
    return kind == "BIGINT"


def _is_number(kind: Column) -> Column:
    return (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")


def _lenient_boolean(text: Column) -> Column:
    word = F.lower(F.trim(text))
    number = word.try_cast("double")
    return (
        F.when(word.isin(TRUE_WORDS) | (number == 1), F.lit(True))
        .when(word.isin(FALSE_WORDS) | (number == 0), F.lit(False))
    )


def _once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns behind a one-row ``inline``.

    Plain projections are merged and pushed into filters, which would parse the
    same text again for every field and rule.
    """
    others = [c for c in df.columns if c not in columns]
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*others, F.inline(F.array(values)))


def parse_labels(responses: DataFrame, raw_col: str = "raw", lenient: bool = False) -> DataFrame:
    """Typed label columns from response text, plus ``parsed``.

    ``parsed`` says whether the text is JSON at all. A field that is missing or
    of the wrong JSON type is null; ``possivel_ruido`` alone defaults to false
    when absent. Names are kept as received, since their length is checked
    before they are trimmed.

    Strict typing is the contract. ``lenient`` also takes numbers written as
    text, whole decimals and booleans for integers, and words for booleans; it
    still refuses 3.5 as an integer and numbers as text.
    """
    v = F.col("_v")
    with_variant = _once(responses, {"_v": F.try_parse_json(raw_col)})

    def get(field: str, kind: str) -> Column:
        return F.try_variant_get(v, f"$.{field}", kind)

    id_kind, confidence_kind, noise_kind = (_kind(v, f) for f in ("cluster_id", "nivel_confianca", "possivel_ruido"))
    id_ok, confidence_ok = _is_integer(id_kind), _is_number(confidence_kind)
    cluster_id = F.when(id_ok, get("cluster_id", "bigint"))
    confidence = F.when(confidence_ok, get("nivel_confianca", "double"))
    noise = F.when(noise_kind == "BOOLEAN", get("possivel_ruido", "boolean"))
    if lenient:
        as_number = F.trim(get("cluster_id", "string")).try_cast("double")
        whole = F.when(as_number == F.floor(as_number), as_number.cast("bigint"))
        id_text = (id_kind == "STRING") | id_kind.startswith("DECIMAL") | (id_kind == "DOUBLE")
        cluster_id = (
            cluster_id.when(id_kind == "BOOLEAN", get("cluster_id", "boolean").cast("bigint")).when(id_text, whole)
        )
        confidence = (
            confidence.when(confidence_kind == "BOOLEAN", get("nivel_confianca", "boolean").cast("double"))
            .when(confidence_kind == "STRING", F.trim(get("nivel_confianca", "string")).try_cast("double"))
        )
        noise = noise.when((noise_kind == "STRING") | _is_number(noise_kind), _lenient_boolean(get("possivel_ruido", "string")))

    def text(field: str) -> Column:
        return F.when(_kind(v, field) == "STRING", get(field, "string"))

    keywords_kind = _kind(v, "palavras_chave")
    keywords = F.when(keywords_kind.isin("ARRAY<STRING>", "ARRAY<VOID>"), get("palavras_chave", "array<string>"))
    # An array of JSON nulls has the element type VOID as well; nulls are no strings.
    keywords = F.when(~F.exists(keywords, lambda k: k.isNull()), keywords)
    return _once(with_variant, {
        "parsed": v.isNotNull(),
        "label_id": cluster_id,
        "nome_topico": text("nome_topico"),
        "palavras_chave": keywords,
        "resumo": text("resumo"),
        "nivel_confianca": confidence,
        "possivel_ruido": F.when(v.isNotNull() & noise_kind.isNull(), F.lit(False)).otherwise(noise),
    }).drop("_v")


def _between(value: Column, bounds: tuple[int, int]) -> Column:
    return F.coalesce((value >= bounds[0]) & (value <= bounds[1]), F.lit(False))


def validate_labels(parsed: DataFrame, sent_id: str = "cluster_id") -> DataFrame:
    """Add ``reasons``, the names of the rules a parsed label breaks; none means valid.

    Also adds ``warnings`` for what the prompt asks but no rule enforces. The
    name is trimmed after its length was checked.
    """
    name = F.col("nome_topico")
    confidence = F.col("nivel_confianca")
    rules = {
        "parse": F.col("parsed"),
        "cluster_id": F.col("label_id").isNotNull(),
        "nome_topico": _between(F.char_length(name), fv.NAME_CHARS),
        "nome_generico": ~F.coalesce(F.lower(tx.normalize_whitespace(name)).isin(fv.GENERIC_NAMES), F.lit(False)),
        "palavras_chave": _between(F.size("palavras_chave"), fv.KEYWORD_COUNT),
        "resumo": _between(F.char_length("resumo"), fv.SUMMARY_CHARS),
        # NaN sorts above every number, so the upper bound refuses it.
        "nivel_confianca": F.coalesce((confidence >= 0) & (confidence <= 1), F.lit(False)),
        "possivel_ruido": F.col("possivel_ruido").isNotNull(),
        "cluster_mismatch": F.coalesce(F.col("label_id") == F.col(sent_id), F.lit(True)),
    }
    broken = F.array(*[F.when(~holds, F.lit(rule)) for rule, holds in rules.items()])
    words = F.size(F.split(F.trim(name), " +"))
    asked = {
        "noise_with_confidence": F.col("possivel_ruido") & (confidence >= 0.5),
        "name_words": (words < 3) | (words > 6),
    }
    hints = F.array(*[F.when(unmet, F.lit(hint)) for hint, unmet in asked.items()])
    return parsed.withColumns({
        "reasons": F.filter(broken, lambda x: x.isNotNull()),
        "warnings": F.filter(hints, lambda x: x.isNotNull()),
        "nome_topico": F.regexp_replace(name, rf"^{fv.SPACE_CLASS}+|{fv.SPACE_CLASS}+$", ""),
    })


def valid_labels(validated: DataFrame) -> DataFrame:
    """The label table: rows without a broken rule."""
    fields = [F.col(f.name).cast(f.dataType) for f in schemas.LABEL.fields]
    return validated.where(F.size("reasons") == 0).select(*fields)


def quarantine_labels(validated: DataFrame, raw_col: str = "raw") -> DataFrame:
    """Dead letters: invalid responses with the id they were asked for and what was wrong."""
    return validated.where(F.size("reasons") > 0).select(
        F.col("cluster_id").cast("int").alias("cluster_id"),
        F.col(raw_col).alias("resposta_crua"),
        F.array_join("reasons", ", ").alias("erro"),
        F.unix_micros(F.current_timestamp()).cast("double").__truediv__(1e6).alias("timestamp"),
    )


def explode_label_batch(responses: DataFrame, raw_col: str = "raw", key: str = "batch_id") -> DataFrame:
    """One row per label of responses of the form ``{"rotulos": [...]}``: (key, pos, raw).

    Each ``raw`` is a label as JSON text, ready for ``parse_labels``. Strict like
    the rest: anything but a list yields no rows.
    """
    items = F.try_variant_get(F.try_parse_json(raw_col), "$.rotulos", "array<variant>")
    return responses.select(key, F.posexplode(items).alias("pos", "item")).select(
        key, "pos", F.to_json("item").alias("raw")
    )


def label_clusters(
    df: DataFrame,
    cluster_col: str,
    make_client: Callable[[], Client],
    responses_path: str,
    template: str = DEFAULT_TEMPLATE,
    language: str = "pt",
    chosen: DataFrame | None = None,
    lenient: bool = False,
    **options,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Terms, examples, prompts, calls, validation: (labels, dead letters, responses)."""
    # Read three times from here on: texts are made ready for it once.
    opening = F.substring(tx.null_to_empty(F.col("text")), 1, fv.EXCERPT_CHARS).alias("text")
    df = materialize(df.where(F.col(cluster_col) != fv.NOISE).select("doc_id", cluster_col, "title", opening, "texto_modelo"), "label-rows")
    terms = ctfidf_top_terms(df, cluster_col, language=language, pad_zero=True)
    prompts = render_prompts(
        keyword_lines(terms), example_blocks(df, cluster_col, chosen=chosen), template, cluster_list(df, cluster_col)
    )
    responses = answered(prompts, make_client, responses_path, **options)
    checked = validate_labels(parse_labels(responses, lenient=lenient))
    # A service failure is reported as such, not as unreadable text.
    failed = F.when(F.col("error").isNotNull(), F.array("error")).otherwise(F.col("reasons"))
    checked = checked.withColumn("reasons", failed)
    return valid_labels(checked), quarantine_labels(checked), responses
