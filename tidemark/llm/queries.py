"""The operators as queries over the whole table of documents, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import quality, toxicity
from ..session import fresh_path, ship_package
from .alignment import align_tokenizers
from .bpe import round_trip_digests
from .centroids import CLUSTERS, DIMENSIONS, ROUNDS, SCALE, SEED, centroid_digests
from .exact_dedup import exact_duplicates
from .jaccard import jaccard_components
from .licenses import license_notices
from .packing import pack_documents
from .rules import judge
from .secrets import ALLOWED, CANDIDATE, KINDS, LEAST_BITS, MOST, SHORTEST_VALUE, WINDOW, _TERMS, secret_digests
from .token_files import read_token_files, write_token_files
from .winnowing import WINDOW, contaminated_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_byte_bpe")
def byte_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip_digests(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


#: translate() lower-cases A-Z only, as the operator does.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op2_exact_dedup", f"""
    WITH hashed AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, text_sha256
    FROM hashed WINDOW same AS (PARTITION BY text_sha256)
""")
def exact_dedup(spark, sf_dir):
    return exact_duplicates(documents(spark, sf_dir))


@query("op3_best_fit_packing")
def best_fit_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op4_token_files")
def token_files(spark, sf_dir):
    folder = fresh_path(spark, "tokens")
    write_token_files(documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, folder, with_ids=False)


def _places(matches: str, pattern: str) -> str:
    """SQL for [{m, s, e}]: each match with its place."""
    gaps = f"string_split_regex(text, '{pattern}')"
    return (f"list_transform(range(1, len({matches}) + 1), lambda i: {{'m': {matches}[i], "
            f"'s': CAST(list_sum(list_transform({gaps}[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform({matches}[1:i - 1], lambda g: length(g))), 0) AS BIGINT)}})")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_SQL_PATTERNS = {k: p.replace("'", "''") for k, p in KINDS.items()}
_WORDS = ["password", "passwd", "secret", "token", "api_?key"]
_SQL_PATTERNS["assign"] = _SQL_PATTERNS["assign"].replace("(?i)(" + "|".join(_WORDS) + ")", "(" + "|".join(map(_either_case, _WORDS)) + ")")
_NAMED = "list_transform({}, lambda x: ['assign', 'access', 'hex', 'entropy'][x.k + 1] || ':' || x.s || ':' || x.e)"
_TERM_LIST = "[" + ", ".join(f"CAST({t} AS BIGINT)" for t in _TERMS) + "]"


@query("op7_secrets", f"""
    WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    matched AS (SELECT *, {", ".join(f"regexp_extract_all(text, '{p}') AS m_{k}" for k, p in _SQL_PATTERNS.items())},
        regexp_extract_all(text, '{CANDIDATE}') AS m_candidate FROM texts),
    placed AS (SELECT r, doc_id, {", ".join(f"{_places(f'm_{k}', p)} AS p_{k}" for k, p in [*_SQL_PATTERNS.items(), ("candidate", CANDIDATE)])} FROM matched),
    based AS (SELECT r, doc_id, p_candidate, list_sort(list_concat(
        list_transform(list_filter(p_assign, lambda x: length(regexp_extract(x.m, '{_SQL_PATTERNS["assign"]}', 2)) >= {SHORTEST_VALUE}), lambda x: {{'s': x.s, 'k': 0, 'e': x.s + length(x.m)}}),
        list_transform(p_access, lambda x: {{'s': x.s, 'k': 1, 'e': x.s + length(x.m)}}),
        list_transform(p_hex, lambda x: {{'s': x.s, 'k': 2, 'e': x.s + length(x.m)}}))) AS base FROM placed),
    candidates AS (SELECT r, base, unnest(p_candidate) AS c FROM based),
    likely AS (SELECT r, base, c.s AS s, c.m AS m FROM candidates
        WHERE regexp_matches(c.m, '[0-9]') AND regexp_matches(c.m, '[A-Za-z]') AND NOT regexp_matches(c.m, '{"|".join(ALLOWED)}')),
    windows AS (SELECT r, base, s, m, unnest(range(0, length(m) - {WINDOW} + 1)) AS w FROM likely),
    counted AS (SELECT *, substr(m, w + 1, {WINDOW}) AS t, list_transform(list_distinct(string_split(substr(m, w + 1, {WINDOW}), '')),
        lambda c: {WINDOW} - length(replace(substr(m, w + 1, {WINDOW}), c, ''))) AS n FROM windows),
    summed AS (SELECT *, list_sum(list_transform(n, lambda c: {_TERM_LIST}[c + 1])) AS total,
        {WINDOW} - length(regexp_replace(t, '[0-9]', '', 'g')) AS digits, {WINDOW} - length(regexp_replace(t, '[A-Z]', '', 'g')) AS uppers,
        {WINDOW} - length(regexp_replace(t, '[a-z]', '', 'g')) AS lowers FROM counted),
    passing AS (SELECT r, base, s, min(w) AS first, max(w) AS last FROM summed
        WHERE (regexp_full_match(t, '[0-9a-f]+') AND digits > 0 AND lowers > 0 AND total <= {MOST["hex"]})
           OR (uppers > 0 AND lowers > 0 AND digits > 0 AND total <= {MOST["mixed"]})
           OR ((uppers = 0 OR lowers = 0) AND digits >= 4 AND uppers + lowers >= 4 AND total <= {MOST["single"]})
        GROUP BY r, base, s),
    random AS (SELECT r, list({{'s': s + first, 'k': 3, 'e': s + last + {WINDOW}}}) AS more FROM passing
        WHERE len(list_filter(base, lambda b: b.s < s + last + {WINDOW} AND s + first < b.e)) = 0 GROUP BY r)
    SELECT doc_id, CAST(len(list_filter(base, lambda x: x.k = 0)) AS BIGINT) AS n_assign, CAST(len(list_filter(base, lambda x: x.k = 1)) AS BIGINT) AS n_access,
        CAST(len(list_filter(base, lambda x: x.k = 2)) AS BIGINT) AS n_hex,
        sha256(coalesce(array_to_string({_NAMED.format("base")}, ','), '')) AS base_sha256,
        coalesce(array_to_string({_NAMED.format("list_sort(list_concat(base, coalesce(more, [])))")}, ','), '') AS spans
    FROM based LEFT JOIN random USING (r)
""")
def secrets(spark, sf_dir):
    return secret_digests(documents(spark, sf_dir))


_SPACE = "[\\x20\\x09-\\x0D]+"


@query("op9_jaccard_join", f"""
    WITH RECURSIVE worded AS (SELECT doc_id, list_filter(string_split_regex({_LOWER}, '{_SPACE}'), lambda x: x <> '') AS w FROM documents),
    shingled AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM worded),
    single AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM shingled),
    links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM single a JOIN single b ON a.x = b.x AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
    reached AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a)
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, (SELECT min(b) FROM reached WHERE a = doc_id) AS component_id FROM shingled
""")
def jaccard_join(spark, sf_dir):
    return jaccard_components(documents(spark, sf_dir))


@query("op8_quality_rules")
def quality_rules(spark, sf_dir):
    return judge(documents(spark, sf_dir), labels(spark, sf_dir))


@query("op5_quality")
def graded_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.fit(docs, quality.grades_of(labels(spark, sf_dir))))


@query("op6_toxicity")
def toxic_categories(spark, sf_dir):
    return toxicity.toxic_documents(documents(spark, sf_dir), labels(spark, sf_dir))


@query("op10_licenses")
def licenses(spark, sf_dir):
    found = license_notices(documents(spark, sf_dir))
    return found.select("doc_id", F.array_join("families", ",").alias("families"), "unknown_lines",
                        F.array_join(F.transform("notices", lambda x: F.concat_ws(":", x["line"], x["family"])), ",").alias("notices"))


_PLACES = f"range(1, {DIMENSIONS + 1})"
_KEPT = f"len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0"


def _round_sql(number: int) -> str:
    """Assignment to the centroids of round ``number``, and those of the next."""
    apart = f"list_sum(list_transform({_PLACES}, lambda i: (v.v[i] - c.c[i]) * (v.v[i] - c.c[i])))"
    return f""",
    d{number} AS MATERIALIZED (SELECT v.r, c.k, CAST({apart} AS BIGINT) AS d FROM v, c{number} c),
    a{number} AS MATERIALIZED (SELECT r, arg_min(k, d * {CLUSTERS} + k) AS k, min(d) AS d FROM d{number} GROUP BY r),
    e{number} AS (SELECT a.k, i, CAST(floor_div AS BIGINT) AS x FROM (SELECT a.k, i, sum(v.v[i]) AS s, count(*) AS n,
        (sum(v.v[i]) - ((sum(v.v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS floor_div
        FROM a{number} a JOIN v USING (r), (SELECT unnest({_PLACES}) AS i) GROUP BY a.k, i) a),
    c{number + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.c, c.c) AS c FROM c{number} c LEFT JOIN (SELECT k, list(x ORDER BY i) AS c FROM e{number} GROUP BY k) m ON m.k = c.k)"""


@query("op11_centroid_clustering", f"""
    WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE {_KEPT}),
    c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS k, v AS c FROM (SELECT sha256('{SEED}:' || vec_id) AS h, v FROM v ORDER BY h NULLS LAST, v LIMIT {CLUSTERS}))
    {"".join(map(_round_sql, range(ROUNDS + 1)))},
    final AS (SELECT vec_id, a.k, d FROM a{ROUNDS} a JOIN v USING (r))
    SELECT vec_id, CAST(f.k AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY f.k) AS BIGINT) AS cluster_inertia,
        CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
    FROM final f JOIN c{ROUNDS} c ON c.k = f.k
""")
def centroid_clustering(spark, sf_dir):
    ship_package(spark)
    return centroid_digests(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op12_token_alignment")
def token_alignment(spark, sf_dir):
    return align_tokenizers(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


_WORD_LIST = f"list_filter(string_split_regex({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"


@query("op13_decontamination", f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORD_LIST} AS w FROM documents),
    i AS (SELECT item_id, {_WORD_LIST} AS w FROM benchmark),
    windows AS (SELECT DISTINCT item_id, m, unnest(list_transform(range(1, len(w) - m + 2), lambda p: array_to_string(w[p:p + m - 1], ' '))) AS t
        FROM (SELECT *, least(len(w), {WINDOW}) AS m FROM i) WHERE m > 0),
    spans AS (SELECT r, m, unnest(range(1, len(w) - m + 2)) AS p, unnest(list_transform(range(1, len(w) - m + 2), lambda p: array_to_string(w[p:p + m - 1], ' '))) AS t
        FROM d, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m),
    hits AS (SELECT DISTINCT r, m, p FROM spans SEMI JOIN windows USING (m, t)),
    hit_words AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(p, p + m)) AS p FROM hits) GROUP BY r),
    found AS (SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS names
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM spans JOIN windows USING (m, t) WHERE item_id IS NOT NULL) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(f.n, 0) AS BIGINT) AS n_items,
        sha256(coalesce(names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit_words h USING (r) LEFT JOIN found f USING (r)
""")
def decontamination(spark, sf_dir):
    return contaminated_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
