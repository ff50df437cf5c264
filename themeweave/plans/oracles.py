"""The queries of ``queries.py`` as DuckDB SQL over the same tables."""

from __future__ import annotations

from ..functions import fixed_values as fv
from ..functions.templates import DEFAULT_TEMPLATE
from . import fixtures as fx
from .queries import AUTO, DENSITY, EPS, KNN, LETTERS, SAMPLE

ORACLES: dict[str, str] = {}


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


# --- expressions --------------------------------------------------------------


def urls(e: str) -> str:
    return f"regexp_replace({e}, {text(fv.URL_PATTERN)}, ' ', 'g')"


def tags(e: str) -> str:
    return f"regexp_replace({e}, {text(fv.TAG_PATTERN)}, ' ', 'g')"


def spaces(e: str) -> str:
    return f"trim(regexp_replace({e}, {text(fv.SPACE_RUN)}, ' ', 'g'))"


def clean(e: str) -> str:
    return spaces(tags(urls(f"coalesce({e}, '')")))


def tokens(e: str) -> str:
    return f"regexp_extract_all(lower({e}), {text(fv.TOKEN_PATTERN)})"


STOP = "[" + ", ".join(text(w) for w in fv.STOPWORDS["pt"]) + "]"
PERIOD = f"date >= date '{fv.PERIOD_START}' and date < date '{fv.PERIOD_END}'"
HASH = f"md5(concat_ws('|', '{fv.SAMPLE_SEED}', cast(doc_id as varchar)))"


def dbl(e: str) -> str:
    return f"cast({e} as double[])"


def r6(e: str) -> str:
    return f"round(cast({e} as double), 6) + cast(0 as double)"


def distance(a: str, b: str) -> str:
    return f"list_distance({a}, {b})"


# --- common table expressions, by name, with what they build on ---------------

CTES: dict[str, tuple[list[str], str]] = {
    "corpus": ([], fx.CORPUS.format(documents="documents")),
    "clustered": (["corpus"], fx.CLUSTERED.format(corpus="corpus", embeddings="embeddings", n_vectors="(select count(*) from embeddings)")),
    "vectors": ([], "select vec_id as doc_id, cast(embedding as double[]) as embedding, label from embeddings"),
    "usage": ([], fx.USAGE.format(conversations="conversations")),
    "responses": ([], fx.RESPONSES.format(documents="documents")),
    "batches": (["responses"], fx.BATCHES.format(responses="responses")),
    "cleaned": (
        ["corpus"],
        f"""select doc_id, t as title, x as text, date, category, link, trim(concat(t, '. ', x)) as texto_modelo
        from (select *, {clean('title')} as t, {clean('text')} as x from corpus)""",
    ),
    "prepared": (
        ["clustered"],
        f"""select * from (select doc_id, t as title, x as text, date, category, cluster_kmeans, cluster_hdbscan,
        trim(concat(t, '. ', x)) as texto_modelo
        from (select *, {clean('title')} as t, {clean('text')} as x from clustered)) where length(texto_modelo) >= {fv.MIN_CHARS}""",
    ),
    "price": (
        [],
        "select model, cast(price_in as double) as price_in, cast(price_out as double) as price_out from (values "
        + ", ".join(f"('{m}', {i}, {o})" for m, i, o in fv.PRICES)
        + ") as t(model, price_in, price_out)",
    ),
    "totals": (
        ["usage"],
        "select cast(sum(tokens_in) as bigint) as tokens_entrada, cast(sum(tokens_out) as bigint) as tokens_saida, count(*) as chamadas from usage",
    ),
    "means": (
        ["totals"],
        "select tokens_entrada / greatest(chamadas, 1) as mean_in, tokens_saida / greatest(chamadas, 1) as mean_out from totals",
    ),
    "centroid": (
        ["vectors"],
        """select label, list(m order by pos) as centroid, any_value(n) as n_docs from (
        select label, pos, avg(x) as m, count(*) as n from (
        select label, unnest(embedding) as x, generate_subscripts(embedding, 1) as pos from vectors) group by 1, 2) group by 1""",
    ),
    "pair": (
        ["vectors"],
        f"""select a.doc_id as i, b.doc_id as j, a.label as li, b.label as lj, {distance('a.embedding', 'b.embedding')} as d
        from vectors a join vectors b on a.doc_id <> b.doc_id""",
    ),
}


def term_ctes(cluster_col: str) -> dict[str, tuple[list[str], str]]:
    """c-TF-IDF step by step: tokens, vocabulary, counts, mean size, scores, ranks."""
    return {
        "doc": (["prepared"], f"select doc_id, {cluster_col} as cluster_id, texto_modelo from prepared where {cluster_col} <> -1"),
        "tok": (
            ["doc"],
            f"select * from (select doc_id, cluster_id, unnest({tokens('texto_modelo')}) as term from doc) where not list_contains({STOP}, term)",
        ),
        "vocab": (
            ["tok"],
            f"""select term, count(distinct doc_id) as doc_freq from tok group by term
            having count(distinct doc_id) >= {fv.MIN_DF} and count(distinct doc_id) <= cast({fv.MAX_DF} as double) * (select count(*) from doc)""",
        ),
        "tf": (["vocab"], "select cluster_id, term, count(*) as tf from tok where term in (select term from vocab) group by 1, 2"),
        "total": (["tf"], "select term, cast(sum(tf) as bigint) as total from tf group by term"),
        "mean_words": (
            ["tf"],
            "select (select sum(tf) from tf) / (select cast(count(distinct cluster_id) as double) from doc) as a",
        ),
        "scored": (
            ["total", "mean_words"],
            """select cluster_id, term, tf, total, tf * ln(1 + (select a from mean_words) / (total + 1)) as score
            from tf join total using (term)""",
        ),
        "ranked": (
            ["scored"],
            """select *, cast(row_number() over (partition by cluster_id order by score desc, term desc) as int) as rank from scored""",
        ),
        "keywords": (
            ["ranked"],
            f"select cast(cluster_id as int) as cluster_id, string_agg(term, ', ' order by rank) as palavras_chave from ranked where rank <= {fv.TOP_TERMS} group by 1",
        ),
    }


def example_ctes(cluster_col: str) -> dict[str, tuple[list[str], str]]:
    return {
        "examples": (
            ["prepared"],
            f"""select cast(c as int) as cluster_id, string_agg(block, chr(10) order by rk) as exemplos from (
            select {cluster_col} as c, row_number() over (partition by {cluster_col} order by doc_id) as rk,
            concat('- Título: ', title, chr(10), '  Início: ', substring(text, 1, {fv.EXCERPT_CHARS}), '...') as block
            from prepared where {cluster_col} <> -1) where rk <= {fv.EXAMPLES_PER_CLUSTER} group by 1""",
        ),
        "prompts": (["keywords", "examples"], f"select k.cluster_id, {prompt_text()} as prompt from keywords k join examples e using (cluster_id)"),
    }


def prompt_text() -> str:
    """The default template as a concat; its placeholders occur once, in this order."""
    rest, parts = DEFAULT_TEMPLATE, []
    for name, column in (("cluster_id", "cast(k.cluster_id as varchar)"), ("palavras_chave", "palavras_chave"), ("exemplos", "exemplos")):
        before, rest = rest.split("{" + name + "}", 1)
        parts += [text(single(before)), column]
    return f"concat({', '.join([*parts, text(single(rest))])})"


def single(template: str) -> str:
    return template.replace("{{", "{").replace("}}", "}")


# What the stand-in model answers to a prompt.
ECHO = """concat('{"cluster_id": ', cast(cluster_id as varchar), ', "nome_topico": "Tema do grupo ', cast(cluster_id as varchar),
 '", "palavras_chave": ["', array_to_string(words, '", "'), '"], "resumo": "Resposta de teste.", "nivel_confianca": 0.75}')"""

# Fields of a response by JSON type. Text that is not JSON has none.
PARSED = """
select *,
 case when t_id in ('BIGINT', 'UBIGINT') then try_cast(json_extract_string(j, '$.cluster_id') as bigint) end as label_id,
 case when t_name = 'VARCHAR' then json_extract_string(j, '$.nome_topico') end as name,
 case when t_words = 'ARRAY' and len(list_filter(word_types, lambda x: x <> 'VARCHAR')) = 0
      then list_transform(cast(json_extract(j, '$.palavras_chave') as json[]), lambda x: json_extract_string(x, '$')) end as words,
 case when t_summary = 'VARCHAR' then json_extract_string(j, '$.resumo') end as summary,
 case when t_conf in ('BIGINT', 'UBIGINT', 'DOUBLE') then try_cast(json_extract_string(j, '$.nivel_confianca') as double) end as conf,
 case when t_noise = 'BOOLEAN' then cast(json_extract_string(j, '$.possivel_ruido') as boolean)
      when j is not null and t_noise is null then false end as noise
from (select *, json_type(j, '$.cluster_id') as t_id, json_type(j, '$.nome_topico') as t_name,
 json_type(j, '$.palavras_chave') as t_words, json_type(j, '$.resumo') as t_summary,
 json_type(j, '$.nivel_confianca') as t_conf, json_type(j, '$.possivel_ruido') as t_noise,
 case when json_type(j, '$.palavras_chave') = 'ARRAY'
      then list_transform(cast(json_extract(j, '$.palavras_chave') as json[]), lambda x: json_type(x)) end as word_types
 from (select *, case when json_valid(raw) then cast(raw as json) end as j from {source}))
"""

GENERIC = ", ".join(text(g) for g in fv.GENERIC_NAMES)


def _span(e: str, bounds: tuple[int, int]) -> str:
    return f"coalesce({e} between {bounds[0]} and {bounds[1]}, false)"


RULES = [
    ("parse", "j is not null"),
    ("cluster_id", "label_id is not null"),
    ("nome_topico", _span("length(name)", fv.NAME_CHARS)),
    ("nome_generico", f"not coalesce(lower({spaces('name')}) in ({GENERIC}), false)"),
    ("palavras_chave", _span("len(words)", fv.KEYWORD_COUNT)),
    ("resumo", _span("length(summary)", fv.SUMMARY_CHARS)),
    ("nivel_confianca", "coalesce(conf between 0 and 1, false)"),
    ("possivel_ruido", "noise is not null"),
    ("cluster_mismatch", "coalesce(label_id = cluster_id, true)"),
]
REASONS = "concat_ws(', ', " + ", ".join(f"case when not ({rule}) then '{name}' end" for name, rule in RULES) + ")"

CTES["parsed"] = (["responses"], PARSED.format(source="responses"))
CTES["checked"] = (["parsed"], f"select *, trim(name) as nome_topico, {REASONS} as reasons from parsed")
CTES["label"] = (
    ["checked"],
    """select cast(label_id as int) as cluster_id, nome_topico, words, summary as resumo, conf as nivel_confianca, noise as possivel_ruido
    from checked where reasons = ''""",
)


def purity(cluster_col: str) -> str:
    """Share of rows in their cluster's majority category."""
    return f"""(select coalesce(sum(hits) / nullif(sum(n), 0), 0) from (
    select c, max(m) as hits, sum(n) as n from (
    select {cluster_col} as c, category, count(*) as n, case when category is null then 0 else count(*) end as m
    from clustered where {cluster_col} <> -1 group by 1, 2) group by 1))"""


def cosine_score(label: str, rows: str) -> str:
    """Mean cosine silhouette of ``rows`` (doc_id, embedding, ...) by pairs."""
    return _score(label, rows, "1 - list_cosine_similarity(a.embedding, b.embedding)")


def euclidean_score(label: str, rows: str) -> str:
    return _score(label, rows, distance("a.embedding", "b.embedding"))


def _score(label: str, rows: str, gap: str) -> str:
    return f"""(select avg(case when a is null then 0 when greatest(a, b) > 0 then (b - a) / greatest(a, b) else 0 end) from (
    select i, max(case when li = lj then m end) as a, min(case when li <> lj then m end) as b from (
    select i, li, lj, avg(case when i <> j then d end) as m from (
    select a.doc_id as i, b.doc_id as j, a.{label} as li, b.{label} as lj, {gap} as d from {rows} a, {rows} b)
    group by 1, 2, 3) group by 1))"""


CTES["placed"] = (["clustered", "vectors"], "select c.doc_id, cluster_kmeans, cluster_hdbscan, embedding from clustered c join vectors v on c.doc_id = v.doc_id")
CTES["placed_dense"] = (["placed"], "select * from placed where cluster_hdbscan <> -1")
CTES["record"] = (
    ["placed_dense"],
    f"""select count(distinct cluster_kmeans) as k, {cosine_score('cluster_kmeans', 'placed')} as kmeans_silhouette,
    {purity('cluster_kmeans')} as kmeans_purity, count(distinct case when cluster_hdbscan <> -1 then cluster_hdbscan end) as n_found,
    {euclidean_score('cluster_hdbscan', 'placed_dense')} as density_silhouette, {purity('cluster_hdbscan')} as density_purity,
    avg(cast(cluster_hdbscan <> -1 as double)) as density_coverage from clustered""",
)


def build(select: str, *needs: str, extra: dict | None = None, recursive: bool = False) -> str:
    """The query with the common table expressions it needs, each after its own needs."""
    known = {**CTES, **(extra or {})}
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in known[name][0]:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    if not ordered:
        return select
    head = "with recursive " if recursive else "with "
    return head + ",\n".join(f"{n} as ({known[n][1]})" for n in ordered) + "\n" + select


def oracle(name: str, select: str, *needs: str, **options) -> None:
    ORACLES[name] = build(select, *needs, **options)


DENSE = term_ctes("cluster_hdbscan")
FLAT = {**term_ctes("cluster_kmeans"), **example_ctes("cluster_kmeans")}

# --- sources and sinks --------------------------------------------------------
oracle("scan_corpus", "select doc_id, text, lang, source from documents")
oracle("scan_csv", "select * from corpus", "corpus")
for _name in ("scan_vectors", "sink_vectors"):
    oracle(_name, f"select doc_id, cast(len(embedding) as int) as dims, {r6('list_dot_product(embedding, embedding)')} as norm2 from vectors", "vectors")
USAGE_MEANS = f"""select tokens_entrada, tokens_saida, chamadas, {r6('tokens_entrada / greatest(chamadas, 1)')} as mean_in,
 {r6('tokens_saida / greatest(chamadas, 1)')} as mean_out from totals"""
oracle("scan_json_document", USAGE_MEANS, "totals")
_head, _rest = DEFAULT_TEMPLATE.split("{cluster_id}")
_mid, _tail = _rest.replace("{palavras_chave}", "").split("{exemplos}")
oracle(
    "scan_template",
    f"""select label as cluster_id, concat({text(single(_head))}, cast(label as varchar), {text(single(_mid))}, cast(count(*) as varchar), {text(single(_tail))}) as filled
    from embeddings group by label""",
)
oracle("optional_source", f"select count(*) as calls, cast({fv.DEFAULT_TOKENS_IN} as double) as mean_in, cast({fv.DEFAULT_TOKENS_OUT} as double) as mean_out from usage", "usage")
oracle("sink_table", f"select *, cast(year(date) as int) as year from cleaned where length(texto_modelo) >= {fv.MIN_CHARS}", "cleaned")
oracle(
    "sink_json_document",
    f"""select count(distinct cluster_kmeans) as k, {r6(purity('cluster_kmeans'))} as kmeans_purity, {r6(purity('cluster_hdbscan'))} as density_purity,
    {r6("avg(cast(cluster_hdbscan <> -1 as double))")} as density_coverage, cast({fv.REDUCED_DIMS} as int) as umap_n_components, {text(fv.METRICS_WARNING)} as aviso from clustered""",
    "clustered",
)
for _name in ("sink_dead_letters", "quarantine_labels"):
    oracle(_name, "select cluster_id, raw as resposta_crua, reasons as erro from checked where reasons <> ''", "checked")

# --- projections, filters, predicates ----------------------------------------
oracle(
    "parse_iso_date",
    """select doc_id, cast(ts as date) as day, cast(hour(ts) as int) as hour, strftime(ts, '%Y-%m-%d %H:%M:%S') as stamp from (
    select doc_id, cast(case when date is not null then concat(cast(date as varchar), 'T', lpad(cast(doc_id % 24 as varchar), 2, '0'), ':15:30') end as timestamp) as ts from corpus)""",
    "corpus",
)
oracle("filter_period", f"select doc_id, date, category from corpus where {PERIOD}", "corpus")
oracle("project_columns", "select doc_id, title, category, date from corpus", "corpus")
oracle("null_to_empty", "select doc_id, coalesce(title, '') as title, length(coalesce(text, '')) as text_chars from corpus", "corpus")
oracle("build_model_text", "select doc_id, texto_modelo from cleaned", "cleaned")
oracle(
    "embed_documents_encoder",
    f"""select doc_id, cast(26 as int) as dims, cast(i - 1 as int) as pos,
    {r6("cast(case when norm > 0 then counts[i] / norm else 0 end as float)")} as x
    from (select doc_id, counts, sqrt(list_sum([c * c for c in counts])) as norm from (
     select doc_id, [length(texto_modelo) - length(replace(texto_modelo, l, '')) for l in string_split('{",".join(LETTERS)}', ',')] as counts
     from cleaned where length(texto_modelo) >= {fv.MIN_CHARS})), range(1, 27) as r(i)""",
    "cleaned",
)
oracle("filter_min_length", f"select doc_id, length(texto_modelo) as chars from cleaned where length(texto_modelo) >= {fv.MIN_CHARS}", "cleaned")
oracle("drop_noise", "select doc_id, cluster_hdbscan from clustered where cluster_hdbscan <> -1", "clustered")
oracle("dense_doc_id", f"select doc_id, row_number() over (order by {HASH}, doc_id) - 1 as dense_id from corpus where {PERIOD}", "corpus")
oracle("attach_assignments", "select c.doc_id, c.category, k.cluster_kmeans, k.cluster_hdbscan from corpus c left join clustered k on c.doc_id = k.doc_id", "clustered")
oracle("filter_cluster", "select doc_id, category, date from clustered where cluster_kmeans = 3", "clustered")
oracle("excerpt", f"select doc_id, concat(substring(coalesce(text, ''), 1, {fv.EXCERPT_CHARS}), '...') as excerpt from corpus", "corpus")

# --- text ---------------------------------------------------------------------
oracle("strip_urls", f"select doc_id, {urls('text')} as text from corpus", "corpus")
oracle("strip_tags", f"select page_id, {tags('html')} as text from pages")
oracle("normalize_whitespace", f"select doc_id, {spaces('text')} as text from corpus", "corpus")
oracle("clean_text", f"select page_id, {clean('html')} as text from pages")
oracle("preprocess_corpus", f"select * from cleaned where length(texto_modelo) >= {fv.MIN_CHARS}", "cleaned")
oracle(
    "tokenize",
    f"""select doc_id, len(t) as n_tokens, md5(array_to_string(t, ' ')) as tokens_md5 from (
    select doc_id, {tokens('texto_modelo')} as t from cleaned where length(texto_modelo) >= {fv.MIN_CHARS})""",
    "cleaned",
)
oracle(
    "remove_stopwords",
    f"""select doc_id, len(t) as n_kept, md5(array_to_string(t, ' ')) as tokens_md5 from (
    select doc_id, list_filter({tokens('texto_modelo')}, lambda x: not list_contains({STOP}, x)) as t
    from cleaned where length(texto_modelo) >= {fv.MIN_CHARS})""",
    "cleaned",
)
oracle("join_keywords", "select cluster_id, palavras_chave from keywords", "keywords", extra=FLAT)
oracle("parse_keyword_list", "select doc_id, cast(2 as int) as n, concat(lang, '|d''', source) as joined from documents")

# --- sampling, sorting, limits ------------------------------------------------
oracle("sample_exact_n", f"select doc_id, title, date, category from corpus where {PERIOD} order by {HASH}, doc_id limit {SAMPLE}", "corpus")
oracle("require_min_rows", f"select cast(year(date) as int) as year, count(*) as n_docs from corpus where {PERIOD} group by 1", "corpus")
oracle(
    "first_n_per_cluster",
    f"""select * from (select doc_id, cluster_kmeans, title, cast(row_number() over (partition by cluster_kmeans order by doc_id) as int) as rk
    from clustered) where rk <= {fv.EXAMPLES_PER_CLUSTER}""",
    "clustered",
)
oracle(
    "nearest_to_centroid",
    f"""select cluster_id, doc_id, rk, {r6('d')} as distance from (
    select *, cast(row_number() over (partition by cluster_id order by round(d, 9), doc_id) as int) as rk from (
    select v.label as cluster_id, doc_id, 1 - list_cosine_similarity(embedding, centroid) as d
    from vectors v join centroid c on v.label = c.label)) where rk <= 5""",
    "centroid",
)
oracle("top_terms", f"select cluster_id, rank, term, {r6('score')} as score from ranked where rank <= 5", "ranked", extra=DENSE)
oracle(
    "select_best_k",
    f"""select cast(pos + 3 as int) as k, {r6('s')} as silhouette from (
    select pos, round(avg(x), 3) as s from (select unnest(embedding) as x, generate_subscripts(embedding, 1) as pos from vectors) group by 1)
    where s > -1 order by s desc, pos limit 1""",
    "vectors",
)
oracle("cluster_sample", "select doc_id, title, category, date from clustered where cluster_kmeans = 3 order by doc_id limit 10", "clustered")
oracle("sorted_clusters", "select distinct cluster_hdbscan as cluster_id from clustered order by 1", "clustered")

# --- aggregations -------------------------------------------------------------
oracle("docs_per_year", "select cast(year(date) as int) as year, count(*) as n_docs from corpus where date is not null group by 1", "corpus")
oracle("category_counts", "select category, count(*) as n_docs from corpus where category is not null group by 1", "corpus")
oracle("cluster_distribution", "select cluster_hdbscan as cluster_id, count(*) as n_docs from clustered group by 1", "clustered")
oracle(
    "stage_counts",
    f"""select count(*) as rows_before, count(*) filter (length(texto_modelo) >= {fv.MIN_CHARS}) as rows_after,
    count(*) filter (length(texto_modelo) < {fv.MIN_CHARS}) as rows_removed, count(*) filter ({PERIOD}) as rows_in_period from cleaned""",
    "cleaned",
)
oracle(
    "majority_category",
    """select cluster_id, cast(sum(n) as bigint) as cluster_rows, first(category order by category is null, n desc, category) as majority_category,
    coalesce(max(case when category is not null then n end), 0) as majority_count
    from (select cluster_hdbscan as cluster_id, category, count(*) as n from clustered where cluster_hdbscan <> -1 group by 1, 2) group by 1""",
    "clustered",
)
oracle("cluster_purity", f"select {r6(purity('cluster_hdbscan'))} as purity", "clustered")
oracle("coverage", f"select {r6('avg(cast(cluster_hdbscan <> -1 as double))')} as coverage from clustered", "clustered")
oracle("n_clusters", "select count(distinct cluster_hdbscan) as n_clusters from clustered where cluster_hdbscan <> -1", "clustered")
oracle(
    "cluster_documents",
    """select cluster_id, chunk, length(body) as chars, md5(body) as document_md5 from (
    select cluster_kmeans as cluster_id, doc_id // 256 as chunk, string_agg(texto_modelo, ' ' order by doc_id) as body
    from prepared where cluster_kmeans <> -1 group by 1, 2)""",
    "prepared",
)
oracle("usage_totals", "select * from totals", "totals")
oracle("usage_means", USAGE_MEANS, "totals")
oracle(
    "clustering_metrics",
    f"""select k, {r6('kmeans_silhouette')} as kmeans_silhouette, {r6('kmeans_purity')} as kmeans_purity, cast(1 as double) as kmeans_coverage,
    n_found, {r6('density_silhouette')} as density_silhouette, {r6('density_purity')} as density_purity, {r6('density_coverage')} as density_coverage,
    '{fv.METRIC_CENTROID}' as kmeans_metric, '{fv.METRIC_DENSITY.format(reducer="PCA")}' as density_metric, cast({fv.REDUCED_DIMS} as int) as dims, {text(fv.METRICS_WARNING)} as aviso from record""",
    "record",
)

# --- distinctive terms --------------------------------------------------------
oracle("document_frequency", "select term, doc_freq from vocab", "vocab", extra=DENSE)
oracle("cluster_term_counts", "select cluster_id, term, tf from tf", "tf", extra=DENSE)
oracle("term_totals", "select term, total from total", "total", extra=DENSE)
oracle("mean_cluster_words", f"select {r6('a')} as mean_words from mean_words", "mean_words", extra=DENSE)
oracle("ctfidf_scores", f"select cluster_id, term, tf, total, {r6('score')} as score from scored", "scored", extra=DENSE)
oracle("ctfidf_top_terms", f"select cluster_id, rank, term, {r6('score')} as score from ranked where rank <= {fv.TOP_TERMS}", "ranked", extra=DENSE)

# --- vectors and clustering ---------------------------------------------------
oracle(
    "l2_normalize",
    f"""select doc_id, cast(pos - 1 as int) as pos, {r6('case when norm > 0 then x / norm else 0 end')} as x from (
    select doc_id, sqrt(list_dot_product(embedding, embedding)) as norm, unnest(embedding) as x, generate_subscripts(embedding, 1) as pos from vectors)""",
    "vectors",
)
oracle("cosine_similarity", f"select doc_id, v.label, {r6('list_cosine_similarity(embedding, centroid)')} as cosine from vectors v join centroid c on v.label = c.label", "centroid")
oracle(
    "cluster_centroids",
    f"""select cast(label as int) as cluster_id, n_docs, cast(pos - 1 as int) as pos, {r6('x')} as x from (
    select label, n_docs, unnest(centroid) as x, generate_subscripts(centroid, 1) as pos from centroid)""",
    "centroid",
)
oracle(
    "nearest_centroid_assign",
    f"""select doc_id, label, nearest, {r6('d')} as distance from (
    select doc_id, v.label, c.label as nearest, {distance('embedding', 'centroid')} as d,
    row_number() over (partition by doc_id order by {distance('embedding', 'centroid')}, c.label) as rn from vectors v, centroid c) where rn = 1""",
    "centroid",
)
oracle("silhouette_cosine", f"select (select count(*) from vectors) as n_rows, {r6(cosine_score('label', 'vectors'))} as silhouette", "vectors")
oracle(
    "silhouette_euclidean",
    f"select {r6(euclidean_score('label', 'kept'))} as silhouette",
    "kept",
    extra={"kept": (["vectors"], "select * from vectors where label <> 9")},
)
oracle(
    "silhouette_sample",
    f"""select {r6('sum(n * r) / sum(n)')} as silhouette, {r6('sqrt(sum(n * n * coalesce(spread, 0))) / sum(n)')} as standard_error, cast(sum(m) as bigint) as asked from (
    select s.c, any_value(n) as n, count(*) as m, avg(s) as r, (1 - count(*) / any_value(n)) * var_samp(s) / count(*) as spread from scored s join sized z on z.c = s.c group by 1)""",
    "scored",
    extra={
        "kept": (["pair"], "select * from vectors where label <> 9"),
        "sized": (["kept"], "select label as c, count(*) as n from kept group by 1"),
        "means": (
            ["sized"],
            """select i, li as c, lj as other, sum(d) / if(li = lj, any_value(n) - 1, any_value(n)) as m from pair join sized z on z.c = lj
            where li <> 9 and ('0x' || md5(cast(i as varchar))[1:8])::bigint / 4294967296 < greatest(0.2, 30 / (select y.n from sized y where y.c = li)) group by 1, 2, 3""",
        ),
        "scored": (
            ["means"],
            """select i, c, (b - a) / greatest(a, b) as s from (
            select i, c, max(case when other = c then m end) as a, min(case when other <> c then m end) as b from means group by 1, 2)""",
        ),
    },
)
NEAR = {
    "near": (
        ["pair"],
        f"select * from (select i, j, d, row_number() over (partition by i order by d, j) as rk from pair) where rk <= {KNN}",
    )
}
oracle("knn_graph", f"select i as doc_id, j as neighbor_id, cast(rk as int) as rank, {r6('d')} as distance from near", "near", extra=NEAR)
oracle("core_distance", f"select i as doc_id, {r6('max(d)')} as core_distance from near group by 1", "near", extra=NEAR)


def CORE(min_samples: int) -> tuple[list[str], str]:
    return ["pair"], f"select i, d as core from (select i, d, row_number() over (partition by i order by d, j) as rk from pair) where rk = {min_samples}"


oracle(
    "density_cluster",
    f"""select v.doc_id, cast(coalesce(k.component, -1) as bigint) as cluster_hdbscan from vectors v left join (
    select u, component from part join (select component, count(*) as n from part group by 1) using (component) where n >= {DENSITY['min_cluster_size']}) k
    on v.doc_id = k.u""",
    "part",
    recursive=True,
    extra={
        "core": CORE(DENSITY["min_samples"]),
        "edge": (["core"], f"select p.i, p.j from pair p join core a on p.i = a.i join core b on p.j = b.i where greatest(a.core, b.core, d) <= {EPS}"),
        "walk": (["edge"], "select i as u, i as r from edge union select w.u, e.j from walk w join edge e on w.r = e.i"),
        "part": (["walk"], "select u, min(r) as component from walk group by 1"),
    },
)
# The whole hierarchy: a tree grown by Prim, components at each weight of its edges, and the clusters' lives over these levels.
oracle(
    "density_cluster_auto",
    """select p.doc_id, cast(coalesce(n.doc_id, -1) as bigint) as cluster_hdbscan from place p
    left join (select k, arg_max(c, lvl) as c from member join head using (lvl, c) group by 1) x on x.k = p.k left join place n on n.k = x.c""",
    "head",
    recursive=True,
    extra={
        "core": CORE(AUTO["min_samples"]),
        "place": (["core"], "select doc_id, row_number() over (order by doc_id) as k from vectors"),
        "reach": (
            ["place"],
            """select i, list(r order by j) as r from (
            select a.k as i, b.k as j, greatest(x.core, y.core, d) as r from pair p join core x on x.i = p.i join core y on y.i = p.j
            join place a on a.doc_id = p.i join place b on b.doc_id = p.j union all select k, k, 1e300 from place) group by 1""",
        ),
        "prim": (
            ["reach"],
            """select 1 as step, 1 as here, 0 as link, 0.0::double as w, [if(z = 1, -1.0::double, 1e300) for z in range(1, (select count(*) from place) + 1)] as best,
            [0 for z in range(1, (select count(*) from place) + 1)] as links
            union all select step + 1, list_position(b, least_), l[list_position(b, least_)], least_,
            [if(z = list_position(b, least_), -1.0::double, b[z]) for z in range(1, len(b) + 1)], l
            from (select *, list_min([y for y in b if y >= 0]) as least_ from (
            select step, [if(best[z] < 0, -1.0::double, least(best[z], r[z])) for z in range(1, len(r) + 1)] as b,
            [if(best[z] >= 0 and r[z] < best[z], cast(here as int), links[z]) for z in range(1, len(r) + 1)] as l
            from prim join reach on reach.i = prim.here where step < len(r)))""",
        ),
        "tree": (
            ["prim"],
            """select here as a, link as b, w, row_number() over (order by w, step) as o
            from (select step, here, link, greatest(w, (select min(w) from prim where step > 1 and w > 0)) as w from prim where step > 1)""",
        ),
        "merged": (
            ["tree"],
            """select 0::bigint as o, 0.0::double as w, range(1, (select count(*) from place) + 1) as c
            union all select t.o, t.w, [if(y = greatest(m.c[t.a], m.c[t.b]), least(m.c[t.a], m.c[t.b]), y) for y in m.c] from merged m join tree t on t.o = m.o + 1""",
        ),
        "level": (
            ["merged"],
            """select w, c, row_number() over (order by w) as lvl, 1 / w - coalesce(1 / lead(w) over (order by w), 0) as life, lead(w) over (order by w) is null as last
            from (select w, arg_max(c, o) as c from merged where o > 0 group by 1)""",
        ),
        "member": (["level"], "select lvl, unnest(range(1, len(c) + 1)) as k, unnest(c) as c from level"),
        "big": (
            ["member"],
            f"""select b.lvl, b.c, n * life as gain, m.c as up from (select lvl, c, count(*) as n from member group by all having n >= {AUTO['min_cluster_size']}) b
            join level using (lvl) left join member m on m.lvl = b.lvl + 1 and m.k = b.c union all select lvl, 0, 0, 0 from level""",
        ),
        "life": (
            ["big"],
            """select lvl, c, up, gain as own, 0.0::double as inside, 0::bigint as kids from big where lvl = 1
            union all select b.lvl, b.c, b.up, b.gain + if(s.kids = 1, s.own, 0), case when s.kids = 1 then s.inside when s.kids > 1 then s.best else 0 end, coalesce(s.kids, 0)
            from (select distinct lvl from life) now join big b on b.lvl = now.lvl + 1
            left join (select up, count(*) as kids, sum(own) as own, sum(inside) as inside, sum(greatest(own, inside)) as best from life group by 1) s on s.up = b.c""",
        ),
        "head": (
            ["life"],
            """select x.lvl, x.c from life x join life y on y.lvl = x.lvl + 1 and y.c = x.up where y.kids > 1 and x.own > 0 and x.own >= x.inside * (1 - 1e-12)""",
        ),
    },
)

# --- labels -------------------------------------------------------------------
oracle("example_blocks", "select cluster_id, exemplos from examples", "examples", extra=FLAT)
oracle("render_prompts", "select cluster_id, prompt from prompts", "prompts", extra=FLAT)
FIRST_WORDS = {
    "words": (
        ["prompts"],
        "select p.cluster_id, p.prompt, string_split(palavras_chave, ', ')[1:3] as words from prompts p join keywords k on p.cluster_id = k.cluster_id",
    )
}
oracle(
    "infer_batches",
    f"""select cluster_id, cast(1 as int) as attempts, length(prompt) - length(replace(prompt, ' ', '')) + 1 as tokens_in,
    length(raw) - length(replace(raw, ' ', '')) + 1 as tokens_out from (select *, {ECHO} as raw from words)""",
    "words",
    extra={**FLAT, **FIRST_WORDS},
)
oracle(
    "label_clusters",
    f"""select cluster_id, concat('Tema do grupo ', cast(cluster_id as varchar)) as nome_topico, array_to_string(words, ', ') as keywords,
    'Resposta de teste.' as resumo, cast(0.75 as double) as nivel_confianca, false as possivel_ruido from words""",
    "words",
    extra={**FLAT, **FIRST_WORDS},
)
oracle(
    "parse_labels",
    f"""select cluster_id, j is not null as parsed, label_id, name as nome_topico, array_to_string(words, '|') as keywords, summary as resumo,
    {r6('conf')} as nivel_confianca, noise as possivel_ruido from parsed""",
    "parsed",
)
oracle("validate_labels", "select cluster_id, nome_topico, reasons from checked", "checked")
oracle(
    "explode_label_batch",
    "select batch_id, pos, label_id, name as nome_topico, array_to_string(words, '|') as keywords from read_items",
    "read_items",
    extra={
        "items": (
            ["batches"],
            """select batch_id, cast(pos - 1 as int) as pos, cast(item as varchar) as raw from (
            select batch_id, unnest(l) as item, generate_subscripts(l, 1) as pos from (
            select batch_id, cast(json_extract(cast(raw as json), '$.rotulos') as json[]) as l from batches where json_valid(raw)))""",
        ),
        "read_items": (["items"], PARSED.format(source="items")),
    },
)

# --- costs --------------------------------------------------------------------
oracle(
    "price_dimension",
    f"select model, price_in, price_out, {r6('tokens_entrada / 1000000 * price_in + tokens_saida / 1000000 * price_out')} as spent_usd from totals, price",
    "totals",
    "price",
)
# Printing rounds the exact value of a double; round() does not.
COSTS = f"""select model, cast(printf('%.4f', i) as double) as custo_entrada_usd, cast(printf('%.4f', o) as double) as custo_saida_usd,
 cast(printf('%.4f', i + o) as double) as custo_total_usd
 {{more}} from (select model, mean_in, mean_out, mean_in * {fv.PROJECTED_ELEMENTS} / 1000000 * price_in as i,
 mean_out * {fv.PROJECTED_ELEMENTS} / 1000000 * price_out as o from means, price)"""
oracle("project_costs", COSTS.format(more=""), "means", "price")
oracle(
    "cost_report",
    COSTS.format(more=f", {r6('mean_in')} as tokens_entrada_por_chamada, {r6('mean_out')} as tokens_saida_por_chamada, cast({fv.PROJECTED_ELEMENTS} as bigint) as n_elementos"),
    "means",
    "price",
)

# --- report -------------------------------------------------------------------
oracle(
    "cluster_label_lookup",
    f"""select c.cluster_id, coalesce(nome_topico, 'not labelled') as nome_topico, resumo, {r6('nivel_confianca')} as nivel_confianca, possivel_ruido
    from (select distinct cluster_kmeans as cluster_id from clustered) c left join label l on c.cluster_id = l.cluster_id""",
    "clustered",
    "label",
)
oracle(
    "cluster_card",
    f"""select c.cluster_id, case when c.cluster_id = -1 then 'Ruído (-1)' else concat('Cluster ', cast(c.cluster_id as varchar)) end as display_name,
    n_docs, coalesce(nome_topico, 'not labelled') as nome_topico, coalesce(array_to_string(words, ', '), '') as keywords, resumo,
    {r6('nivel_confianca')} as nivel_confianca, possivel_ruido
    from (select cluster_hdbscan as cluster_id, count(*) as n_docs from clustered group by 1) c left join label l on c.cluster_id = l.cluster_id""",
    "clustered",
    "label",
)
oracle(
    "metrics_card",
    f"""select k as k_chosen, coalesce(printf('%.3f', kmeans_silhouette), 'N/A') as kmeans_silhouette, {r6('kmeans_purity')} as kmeans_purity,
    n_found, coalesce(printf('%.3f', density_silhouette), 'N/A') as density_silhouette, {r6('density_coverage')} as density_coverage,
    {text(fv.METRICS_WARNING)} as warning from record""",
    "record",
)
