"""The registered queries of the subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaargraph.llm import (
    embedding_dedup,
    hamming_search,
    hard_negatives,
    language,
    license_scan,
    mixing,
    ngram_join,
    pieces,
    quality,
    quality_rules,
    source_divergence,
    toxicity,
    url_filter,
)
from bazaargraph.session import apply_conf

QUERIES = {}


def _query(run):
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_conf(spark)
        return run(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

    QUERIES[run.__name__] = configured
    return run


@_query
def op1_sentencepiece(read) -> DataFrame:
    coded = pieces.encode_texts(read("documents"))
    return coded.withColumn("n_ids", F.coalesce(F.size("ids"), F.lit(0)))


@_query
def op2_source_mix(read) -> DataFrame:
    mixed = mixing.mix_sources(read("documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@_query
def op3_toxicity(read) -> DataFrame:
    docs = read("documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, read("labels")))


@_query
def op4_language_id(read) -> DataFrame:
    docs = read("documents")
    return language.predict_languages(docs, language.train(docs))


@_query
def op5_ngram_join(read) -> DataFrame:
    return ngram_join.jaccard_components(read("documents"))


@_query
def op6_quality(read) -> DataFrame:
    docs = read("documents")
    return quality.score_quality(docs, quality.train(docs, read("labels")))


@_query
def op7_url_filter(read) -> DataFrame:
    return url_filter.filter_urls(read("pages"))


@_query
def op8_embedding_dedup(read) -> DataFrame:
    return embedding_dedup.near_duplicates(read("embeddings"))


@_query
def op9_license_scan(read) -> DataFrame:
    return license_scan.scan_licenses(read("documents"))


@_query
def op10_hamming_search(read) -> DataFrame:
    return hamming_search.nearest_codes(read("embeddings"))


@_query
def op11_source_divergence(read) -> DataFrame:
    return source_divergence.audit_sources(read("documents"))


@_query
def op12_hard_negatives(read) -> DataFrame:
    return hard_negatives.mine_negatives(read("embeddings"))


@_query
def op13_quality_rules(read) -> DataFrame:
    return quality_rules.check_quality(read("documents"))


def _lowered(column: str) -> str:
    return f"translate({column}, '{url_filter.UPPER}', '{url_filter.LOWER}')"


def _fits(host: str, path: str) -> str:
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


def _by_length(value: str) -> str:
    ranked = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    cases = " ".join(
        f"WHEN {_fits(host, path)} THEN '{host + path if value == 'rule' else verdict}'"
        for verdict, host, path in ranked
    )
    bad = " OR ".join(f"contains(host || path, '{g.strip('*')}')" for g in url_filter.BLOCKED)
    return f"CASE {cases} " + (
        "END" if value == "rule" else f"WHEN {bad} THEN 'block' ELSE 'allow' END"
    )


_URL_SQL = f"""
WITH parts AS (
  SELECT page_id,
    coalesce({_lowered("regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')")}, '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages)
SELECT page_id, host, path, {_by_length("rule")} AS rule, {_by_length("verdict")} AS verdict
FROM parts
"""


def _template_rows() -> str:
    rows = []
    for number, (phrase, label) in enumerate(license_scan.BASE + license_scan.NOTICES):
        words = phrase.split()
        for at, (a, b) in enumerate(zip(words, words[1:], strict=False)):
            base = str(number < len(license_scan.BASE)).lower()
            rows.append(f"({number}, '{label}', {base}, {len(words) - 1}, {at}, '{a}', '{b}')")
    return ", ".join(rows)


_LICENSE_SQL = f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all({_lowered("coalesce(text, '')")}, '{license_scan.WORD}') AS w
  FROM documents),
templates(template, label, base, pairs, spot, first, second) AS (VALUES {_template_rows()}),
grams AS (
  SELECT doc_id, unnest(w) AS a, unnest(w[2:]) AS b, unnest(range(len(w))) AS place FROM texts),
votes AS (
  SELECT doc_id, template, label, base, pairs, place - spot AS diagonal,
    bit_or(1::BIGINT << spot) AS votes, min(place) AS low, max(place) AS high
  FROM grams JOIN templates ON a = first AND b = second GROUP BY ALL),
opened AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER o <= {license_scan.NEIGHBOURS}
    THEN 0 ELSE 1 END AS opens
  FROM votes WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)),
clustered AS (
  SELECT *, sum(opens) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS cluster
  FROM opened),
merged AS (
  SELECT doc_id, template, label, base, pairs, cluster, bit_count(bit_or(votes)) AS covered,
    count(*) FILTER (bit_count(votes) = pairs) AS exact,
    min(diagonal) FILTER (bit_count(votes) = pairs) AS first,
    max(diagonal) FILTER (bit_count(votes) = pairs) AS last,
    max(high) - min(low) + 1 AS span
  FROM clustered GROUP BY ALL),
judged AS (
  SELECT *, exact > 0 OR (NOT base AND covered / pairs >= {license_scan.COVERED}
    AND span <= {license_scan.STRETCH} * pairs) AS fits
  FROM merged),
found AS (
  SELECT doc_id, sum(exact) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word,
    max(last) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND fits) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (fits) AS labels,
    max(CASE WHEN fits THEN 1.0::DOUBLE ELSE covered / pairs / 2 END) AS score
  FROM judged GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  round(coalesce(score, 0.0), 6)::DOUBLE AS score
FROM texts LEFT JOIN found USING (doc_id)
"""

_HAMMING_SQL = f"""
WITH codes AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x >= 0) AS code
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    list_sum(list_transform(list_zip(q.code, v.code),
      lambda z: CASE WHEN z[1] = z[2] THEN 0 ELSE 1 END))::BIGINT AS distance
  FROM codes q, codes v WHERE q.vec_id % {hamming_search.QUERY_STEP} = 0 AND q.vec_id <> v.vec_id),
ranked AS (
  SELECT query_id, vec_id, distance,
    row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INTEGER AS rank
  FROM pairs)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= {hamming_search.NEAREST}
"""

_DIVERGENCE_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_lowered("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
found AS (SELECT r, lang, source, unnest(w) AS term FROM texts),
terms AS (
  SELECT lang, term, count(*) AS total FROM found GROUP BY ALL
  HAVING count(DISTINCT r) >= {source_divergence.LEAST_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(total)::BIGINT AS of_lang FROM terms GROUP BY lang),
cells AS (
  SELECT lang, source, term, count(*) AS n FROM found JOIN terms USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, sum(n)::BIGINT AS of_group FROM cells GROUP BY ALL),
groups AS (
  SELECT DISTINCT lang, source, coalesce(of_group, 0) AS of_group
  FROM texts LEFT JOIN sizes USING (lang, source)),
rated AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + {source_divergence.SCALE} * (coalesce(n, 0) + 1) // (of_group + v) AS p,
    1 + {source_divergence.SCALE} * (total + 1) // (of_lang + v) AS q
  FROM groups JOIN langs USING (lang) JOIN terms USING (lang)
  LEFT JOIN cells USING (lang, source, term)),
sums AS (
  SELECT a.lang, a.source, b.source AS item,
    sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM rated a JOIN rated b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
tops AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value
  FROM rated WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' FROM tops)
SELECT lang, source, part, item, value::BIGINT AS value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= {source_divergence.RANKS}
"""

_NEGATIVES_SQL = f"""
WITH vectors AS (
  SELECT DISTINCT vec_id,
    CASE WHEN vec_id % {hard_negatives.MOVED_STEP} = 0
      THEN (label + 1) % {hard_negatives.LABELS} ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
    list_sum(list_transform(list_zip(a.vector, b.vector), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.vector) = len(b.vector)
  WHERE a.vec_id % {hard_negatives.ANCHOR_STEP} = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id)
    <= {hard_negatives.NEAREST})
SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
  row_number() OVER (
    PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= {hard_negatives.NEAREST}
"""

_PHRASES = " OR ".join(f"contains(x.low, '{phrase}')" for phrase in quality_rules.BOILERPLATE)

_RULES_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '{quality_rules.WORDY}+') AS w,
    len(regexp_extract_all(coalesce(text, ''), '{quality_rules.SYMBOLS}')) AS n_symbols,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '{quality_rules.WORDY}')) AS lines
  FROM documents),
windows AS (
  SELECT r, unnest(w) AS a, unnest(w[2:]) AS b, unnest(w[3:]) AS c, unnest(range(len(w))) AS place
  FROM texts),
repeated AS (
  SELECT r, place, count(*) OVER (PARTITION BY r, a, b, c) AS times FROM windows WHERE c IS NOT NULL),
covered AS (
  SELECT r, count(DISTINCT place + step) AS n FROM repeated, (VALUES (0), (1), (2)) s(step)
  WHERE times > 1 GROUP BY r),
measured AS (
  SELECT r, list_transform(list_distinct(lines), lambda x: {{
    'line': x, 'low': lower(x), 'words': regexp_extract_all(x, '{quality_rules.WORDY}+'),
    'symbols': len(regexp_extract_all(x, '{quality_rules.SYMBOLS}+')),
    'shouts': len(regexp_extract_all(x, '{quality_rules.SHOUT}'))}}) AS lines
  FROM texts),
cleaned AS (
  SELECT r, list_filter(lines, lambda x: NOT (
    x.symbols * {quality_rules.SHARE} > len(x.words) OR x.shouts * {quality_rules.SHARE} > len(x.words)
    OR NOT regexp_matches(x.line, '{quality_rules.MARK}')
    OR (len(list_filter(x.words, lambda y: y IN {quality_rules.SEPARATORS})) > 0
      AND len(list_filter(x.words, lambda y: y IN {quality_rules.SEPARATORS})) * {quality_rules.ITEMS}
        >= len(x.words))
    OR (len(x.words) <= {quality_rules.ENTRY_WORDS} AND regexp_matches(x.low, '{quality_rules.ENTRY}'))
    OR {_PHRASES})) AS lines
  FROM measured),
counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    n_symbols::BIGINT AS n_symbols,
    (len(texts.lines) - len(list_distinct(texts.lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words, len(texts.lines)::BIGINT AS n_lines,
    len(cleaned.lines)::BIGINT AS n_lines_left,
    length(array_to_string(flatten(list_transform(cleaned.lines, lambda x: x.words)), '')) AS chars
  FROM texts JOIN cleaned USING (r) LEFT JOIN covered USING (r)),
judged AS (
  SELECT *, n_words < {quality_rules.LEAST_WORDS}
    OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED} * n_words AS base_failed
  FROM counted)
SELECT * EXCLUDE (chars),
  NOT base_failed AND 100 * coalesce(chars, 0) >= {quality_rules.LEAST_LEFT} * word_chars AS kept
FROM judged
"""

ORACLE = {
    "op7_url_filter": _URL_SQL,
    "op9_license_scan": _LICENSE_SQL,
    "op10_hamming_search": _HAMMING_SQL,
    "op11_source_divergence": _DIVERGENCE_SQL,
    "op12_hard_negatives": _NEGATIVES_SQL,
    "op13_quality_rules": _RULES_SQL,
}
