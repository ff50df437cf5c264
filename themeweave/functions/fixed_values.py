"""Lists, patterns and constants that results depend on."""

# --- fixed values: Unicode whitespace as a regex class -----------------------
# Written out because the regex engines disagree on what \s covers.
SPACE = (
    r"\t\n\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The same characters for Spark's regex engine, arranged so that most characters
# are told apart by one table lookup and one range check.
SPACE_CLASS = (
    r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x{85}\x{a0}[\x{1680}-\x{3000}&&"
    r"[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]]"
)
URL_PATTERN = rf"http[^{SPACE}]+|www\.[^{SPACE}]+"
TAG_PATTERN = "<[^>]+>"
SPACE_RUN = rf"[{SPACE}]+"
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# --- fixed values: sampling and cleaning -------------------------------------
SAMPLE_SIZE = 1000
SAMPLE_SEED = 42
PERIOD_START = "2020-01-01"
PERIOD_END = "2021-01-01"
MIN_CHARS = 50

# --- fixed values: clustering ------------------------------------------------
K_MIN, K_MAX = 4, 14
N_INIT = 10
REDUCED_DIMS = 15
MIN_CLUSTER_SIZE = 25
NOISE = -1

# --- fixed values: term extraction and examples ------------------------------
MIN_DF = 2
MAX_DF = 0.95
TOP_TERMS = 10
EXAMPLES_PER_CLUSTER = 4
EXCERPT_CHARS = 300

# --- fixed values: stop words by language ------------------------------------
STOPWORDS = {
    "pt": [
        "de", "do", "da", "dos", "das", "em", "no", "na", "nos", "nas", "um", "uma", "uns", "umas", "o", "a",
        "os", "as", "e", "é", "que", "se", "com", "para", "por", "mais", "mas", "ao", "à", "às", "aos", "ou",
        "não", "sua", "seu", "suas", "seus", "ele", "ela", "eles", "elas", "isso", "este", "esta", "esse",
        "essa", "aqui", "já", "foi", "ser", "tem", "ter", "são", "como", "sobre", "também", "quando", "muito",
        "até", "depois", "ainda", "entre", "mesmo", "então", "porque", "pelo", "pela", "pelos", "pelas",
        "num", "numa", "aquele",
    ],
}

# --- fixed values: label rules -----------------------------------------------
GENERIC_NAMES = ["geral", "outros", "diversos", "variado", "vários"]
NAME_CHARS = (3, 60)
KEYWORD_COUNT = (3, 8)
SUMMARY_CHARS = (10, 400)

# --- fixed values: model prices, USD per million tokens (in, out) ------------
PRICES = [
    ("gemini-2.5-flash", 0.30, 2.50),
    ("gemini-3-flash-preview", 0.50, 3.00),
    ("gemini-3.1-pro-preview", 2.00, 12.00),
]
PRICE_SOURCE = "https://ai.google.dev/gemini-api/docs/pricing"
PROJECTED_ELEMENTS = 1000
DEFAULT_TOKENS_IN = 600.0
DEFAULT_TOKENS_OUT = 150.0

# --- fixed values: wording of the metrics report -----------------------------
METRIC_CENTROID = "cosine"
METRIC_DENSITY = "euclidean (apos {reducer})"
METRICS_WARNING = (
    "Silhouettes nao sao diretamente comparaveis entre os dois algoritmos: "
    "espacos/metricas diferentes. Pureza eh comparavel pois usa a mesma "
    "referencia externa (category)."
)
