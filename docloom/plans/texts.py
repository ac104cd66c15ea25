"""Registered queries: tokenizers over whole texts, term statistics, ranking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import analysis as A
from docloom.functions.rows import explode_rows
from docloom.operators import index as I
from docloom.operators import terms as T
from docloom.plans.registry import ORACLES, query
from docloom.session import scratch_path
from docloom.sources.tables import table


def _documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def _corpus(source: str, key: str, tokens: str) -> str:
    """SQL: occurrences and sum of positions per term, for a list expression of tokens."""
    return f"""WITH lists AS (
      SELECT {key} AS id, list_filter({tokens}, lambda t: t <> '') AS toks FROM {source}),
    found AS (SELECT id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM lists)
    SELECT term, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum FROM found GROUP BY 1"""


_WORDS_SQL = r"regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')"
_LETTERS_SQL = r"regexp_split_to_array(lower(text), '[^\p{L}]+')"


def _register_corpus(name, source, key, text, analyzer, tokens_sql):
    @query(name, _corpus(source, key, tokens_sql))
    def corpus(spark, sf):
        docs = table(spark, sf, source).select(key, text)
        return T.corpus_terms(docs, key, text, analyzer)


# The languages of the corpus and the names of their stop word lists.
NAMES = {"en": "english_short", "fr": "french_short", "de": "german_short", "es": "spanish_short"}
STOP = {lang: A.NAMED_STOP_WORDS[name] for lang, name in NAMES.items()}


def _sql_list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


_register_corpus(
    "tok_standard", "documents", "doc_id", "text", lambda x: A.standard_lower(x, 8),
    f"""flatten(list_transform({_WORDS_SQL}, lambda t:
        list_transform(range(0, CAST(ceil(length(t) / 8.0) AS BIGINT)), lambda i: substr(t, i * 8 + 1, 8))))""",
)
# Names are plain words, on which the rules of Unicode and the word pattern agree.
_register_corpus(
    "tok_unicode", "part", "p_partkey", "p_name", A.unicode_words,
    r"regexp_split_to_array(lower(p_name), '[^\p{L}\p{N}]+')",
)
_register_corpus("tok_simple", "documents", "doc_id", "text", A.simple, _LETTERS_SQL)
_register_corpus(
    "tok_whitespace", "documents", "doc_id", "text", A.whitespace,
    r"regexp_split_to_array(text, '[\t\n\x0B\f\r ]+')",
)
_register_corpus(
    "tok_keyword", "part", "p_partkey", "p_name", A.keyword, "[p_name]",
)
_register_corpus(
    "tok_pattern", "pages", "page_id", "url",
    lambda x: F.concat(
        A.pattern(x, r"[/:.?=&#]+", lowercase=True),
        A.pattern(x, r"([A-Z]+)=([^&#]*)", 2, flags="CASE_INSENSITIVE"),
    ),
    r"""list_concat(list_filter(regexp_split_to_array(lower(url), '[/:.?=&#]+'), lambda t: t <> ''),
        regexp_extract_all(url, '(?i)([A-Z]+)=([^&#]*)', 2))""",
)
_register_corpus(
    "tok_simple_pattern", "pages", "page_id", "html",
    lambda x: F.concat(A.simple_pattern(x, "[0-9]{3}"), A.simple_pattern_split(x, "<[^>]*>")),
    "list_concat(regexp_extract_all(html, '[0-9]{3}'),"
    " list_filter(regexp_split_to_array(html, '<[^>]*>'), lambda t: t <> ''))",
)
_register_corpus(
    "tok_char_group", "documents", "doc_id", "text",
    lambda x: A.char_group(x, ["whitespace", "-", ".", ",", "punctuation"]),
    r"regexp_split_to_array(text, '[\s\-\.,\p{P}]+')",
)
_register_corpus(
    "tok_url_email", "pages", "page_id", "html",
    A.url_email,
    r"""regexp_extract_all(html, 'https?://[^\s<>"'']+|[\p{L}\p{N}._%+\-]+@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)+|[\p{L}\p{N}]+')""",
)
_register_corpus(
    "tok_classic", "documents", "doc_id", "text",
    A.classic,
    r"""regexp_extract_all(text, '[\p{L}\p{N}._%+\-]+@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)+|[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)+|[\p{L}\p{N}]+')""",
)
_register_corpus(
    "tok_path_hierarchy", "pages", "page_id", "url",
    lambda x: F.concat(
        A.path_hierarchy(x, "/", skip=2), A.path_hierarchy(x, "/", "|", skip=1, reverse=True)
    ),
    """list_concat(
      list_filter(list_transform(range(1, len(string_split(url, '/')) - 1),
        lambda i: array_to_string(string_split(url, '/')[3 : 2 + i], '/')), lambda t: t <> ''),
      list_filter(list_transform(range(1, len(string_split(url, '/'))),
        lambda i: array_to_string(string_split(url, '/')[i : len(string_split(url, '/')) - 1], '|')),
        lambda t: t <> ''))""",
)
CUSTOM = {
    "tokenizer": ("standard", {}),
    "char_filters": [("pattern_replace", {"regex": "[0-9]+", "to": "#"})],
    "filters": [
        ("lowercase", {}), ("stop", {"words": STOP["en"]}), ("length", {"least": 3, "most": 12}),
        ("pattern_replace", {"regex": "(.)ing$", "to": "$1"}), ("unique", {}),
    ],
}


@query(
    "an_custom",
    rf"""WITH found AS (SELECT doc_id, unnest(
        regexp_split_to_array(lower(regexp_replace(text, '[0-9]+', '#', 'g')), '[^\p{{L}}\p{{N}}]+')) AS t
      FROM documents)
    SELECT term, count(DISTINCT doc_id) AS n FROM (
      SELECT doc_id, regexp_replace(t, '(.)ing$', '\1') AS term FROM found
      WHERE length(t) BETWEEN 3 AND 12 AND t NOT IN ({_sql_list(STOP["en"])})) GROUP BY 1""",
)
def an_custom(spark, sf):
    """The filters end with unique, so counts are documents."""
    return T.run_counts(_documents(spark, sf), "text", A.custom(**CUSTOM))


@query(
    "tok_stop",
    _corpus("documents", "doc_id", f"list_filter({_LETTERS_SQL}, lambda t: t NOT IN ({_sql_list(STOP['en'])}))"),
)
def tok_stop(spark, sf):
    words = A.stop_words(STOP["en"])
    return T.corpus_terms(_documents(spark, sf), "doc_id", "text", lambda x: A.stop(x, words))


@query(
    "tok_stop_path",
    f"""WITH found AS (SELECT unnest({_LETTERS_SQL}) AS term FROM documents),
    words AS (SELECT DISTINCT lower(trim(r_name)) AS term FROM region
              UNION SELECT unnest([{_sql_list(STOP["fr"])}]))
    SELECT term, count(*) AS n FROM found WHERE term <> '' AND term NOT IN (SELECT term FROM words)
    GROUP BY 1""",
)
def tok_stop_path(spark, sf):
    """Stop words from a text file, written here from region names and a short list."""
    path = scratch_path(spark, "stop")
    names = table(spark, sf, "region").select(F.lower(F.trim("r_name")).alias("value"))
    listed = names.limit(1).select(F.explode(F.array(*map(F.lit, STOP["fr"]))).alias("value"))
    names.unionByName(listed).write.text(path)
    words = spark.read.text(path).withColumnRenamed("value", "term")
    found = T.tokens(_documents(spark, sf), "doc_id", "text", A.simple)
    kept = T.stop_terms(found, words)
    return kept.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@query(
    "tok_ngram",
    """WITH words AS (
      SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{Nd}]+')) AS w FROM documents),
    starts AS (SELECT w, unnest(range(1, length(w) + 1)) AS s FROM words WHERE w <> ''),
    found AS (SELECT w, s, unnest([2, 3]) AS n FROM starts)
    SELECT substr(w, s, n) AS gram, count(*) AS n FROM found WHERE s + n - 1 <= length(w) GROUP BY 1""",
)
def tok_ngram(spark, sf):
    docs = _documents(spark, sf).select(F.lower("text").alias("text"))
    runs = T.run_counts(docs, "text", lambda x: A.split_tokens(x, r"[^\p{L}\p{Nd}]+"))
    return T.gram_counts(runs, 2, 3)


_register_corpus(
    "tok_ngram_titles", "part", "p_partkey", "p_name",
    lambda x: A.ngram(x, 2, 3, ["letter", "whitespace"]),
    r"""flatten(list_transform(list_filter(regexp_split_to_array(p_name, '[^\p{L}\s]+'), lambda r: r <> ''),
        lambda r: flatten(list_transform(range(1, length(r)), lambda s: list_transform(
          range(2, least(3, length(r) - s + 1) + 1), lambda n: substr(r, s, n))))))""",
)
_register_corpus(
    "tok_edge_ngram", "documents", "doc_id", "text",
    lambda x: A.edge_ngram(x, 1, 4, ["letter"]),
    r"""flatten(list_transform(list_filter(regexp_split_to_array(text, '[^\p{L}]+'), lambda r: r <> ''),
        lambda r: list_transform(range(1, least(4, length(r)) + 1), lambda n: substr(r, 1, n))))""",
)


@query(
    "an_fingerprint",
    f"""SELECT sha256(f) AS digest, count(*) AS documents, min(doc_id) AS first_doc FROM (
      SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter({_WORDS_SQL}, lambda t: t <> ''))), ' ') AS f
      FROM documents) WHERE f <> '' AND length(f) <= 1000000 GROUP BY 1 HAVING count(*) > 1""",
)
def an_fingerprint(spark, sf):
    mark = A.fingerprint(F.col("text"), " ", 1_000_000)
    return T.fingerprint_groups(_documents(spark, sf), "doc_id", mark)


_LANGUAGE_CASE = " ".join(
    f"WHEN '{lang}' THEN term IN ({_sql_list(words)})" for lang, words in STOP.items()
)


@query(
    "an_language",
    f"""WITH found AS (SELECT lang, unnest({_WORDS_SQL}) AS term FROM documents)
    SELECT lang, term, count(*) AS n FROM found
    WHERE term <> '' AND NOT CASE lang {_LANGUAGE_CASE} ELSE false END GROUP BY 1, 2""",
)
def an_language(spark, sf):
    docs = table(spark, sf, "documents").select("lang", "text")
    found = A.standard_lower(F.col("text"))
    by_language = F.when(F.lit(False), found)
    for lang, words in STOP.items():
        by_language = by_language.when(
            F.col("lang") == lang, A.language(F.col("text"), A.stop_words(words))
        )
    terms = explode_rows(docs, by_language.otherwise(found), "term", "lang")
    return terms.groupBy("lang", "term").agg(F.count(F.lit(1)).alias("n"))


@query(
    "an_language_named",
    f"""WITH found AS (SELECT doc_id, lang, unnest({_WORDS_SQL}) AS term FROM documents)
    SELECT doc_id, count(*) AS terms, count(DISTINCT term) AS words FROM found
    WHERE term <> '' AND NOT CASE lang {_LANGUAGE_CASE} ELSE false END GROUP BY 1""",
)
def an_language_named(spark, sf):
    """Words of every document without the list named after its language."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    found = A.standard_lower(F.col("text"))
    for lang, name in NAMES.items():
        words = A.stop_words(named=name)
        found = F.when(F.col("lang") == lang, A.language(F.col("text"), words)).otherwise(found)
    counted = docs.select("doc_id", found.alias("found")).select(
        "doc_id", F.size("found").cast("bigint").alias("terms"),
        F.size(F.array_distinct("found")).cast("bigint").alias("words"),
    )
    return counted.where("terms > 0")


_FOUND = f"""WITH found AS (
  SELECT doc_id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM (
    SELECT doc_id, list_filter({_WORDS_SQL}, lambda t: t <> '') AS toks FROM documents)),
  freqs AS (SELECT doc_id, term, count(*) AS freq FROM found GROUP BY 1, 2),
  stats AS (SELECT term, count(*) AS doc_freq, CAST(sum(freq) AS BIGINT) AS total_freq FROM freqs GROUP BY 1)"""


@query(
    "token_count",
    f"""SELECT doc_id, len(list_filter({_WORDS_SQL}, lambda t: t <> '')) AS tokens FROM documents""",
)
def token_count(spark, sf):
    return T.token_count(_documents(spark, sf), "doc_id", "text", A.standard_lower)


@query("term_stats", _FOUND + " SELECT term, doc_freq, total_freq FROM stats")
def term_stats(spark, sf):
    return T.term_stats(_documents(spark, sf), "doc_id", "text", A.standard_lower)


@query(
    "postings",
    _FOUND + """ SELECT term, doc_id, count(*) AS freq, string_agg(pos, ',' ORDER BY pos) AS positions
    FROM found GROUP BY 1, 2""",
)
def postings(spark, sf):
    rows = T.postings(_documents(spark, sf), "doc_id", "text", A.standard_lower)
    positions = F.array_join(F.col("positions").cast("array<string>"), ",")
    return rows.withColumn("positions", positions)


@query("postings_docs", _FOUND + " SELECT DISTINCT term, doc_id FROM found")
def postings_docs(spark, sf):
    return T.postings(_documents(spark, sf), "doc_id", "text", A.standard_lower, "docs")


@query("postings_freqs", _FOUND + " SELECT term, doc_id, CAST(freq AS INT) AS freq FROM freqs")
def postings_freqs(spark, sf):
    return T.postings(_documents(spark, sf), "doc_id", "text", A.standard_lower, "freqs")


@query(
    "term_vector",
    _FOUND + """ SELECT doc_id, string_agg(term || '=' || freq, ' ' ORDER BY term) AS vector
    FROM freqs GROUP BY 1""",
)
def term_vector(spark, sf):
    rows = T.term_vector(_documents(spark, sf), "doc_id", "text", A.standard_lower)
    entries = F.transform(
        F.map_entries("vector"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    )
    return rows.select("doc_id", F.array_join(entries, " ").alias("vector"))


@query(
    "phrase_pairs",
    _FOUND + """ SELECT term AS first, after AS second, count(*) AS n FROM (
      SELECT term, lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS after FROM found)
    WHERE after IS NOT NULL GROUP BY 1, 2""",
)
def phrase_pairs(spark, sf):
    return T.phrase_pairs(_documents(spark, sf), "text", A.standard_lower)


@query(
    "prefix_terms",
    _FOUND + """ SELECT substr(term, 1, n) AS prefix, CAST(sum(total_freq) AS BIGINT) AS n FROM (
      SELECT *, unnest(range(2, least(5, length(term)) + 1)) AS n FROM stats WHERE length(term) >= 2)
    GROUP BY 1""",
)
def prefix_terms(spark, sf):
    counts = T.run_counts(_documents(spark, sf), "text", A.standard_lower)
    return T.prefix_terms(counts, 2, 5)


@query(
    "frequency_filter",
    _FOUND + """ SELECT doc_id, count(*) AS terms, CAST(sum(freq) AS BIGINT) AS tokens
    FROM freqs JOIN stats USING (term)
    WHERE CAST(doc_freq AS DOUBLE) / (SELECT count(*) FROM documents) BETWEEN 0.02 AND 0.3
    GROUP BY 1""",
)
def frequency_filter(spark, sf):
    rows = T.frequency_filter(
        _documents(spark, sf), "doc_id", "text", A.standard_lower, 0.02, 0.3
    )
    return rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("terms"), F.sum(F.col("freq").cast("bigint")).alias("tokens")
    )


# Query terms of the rankings: frequent and rare words of the corpus, one of them twice.
ASKED = ["the", "and", "license", "email", "the", "wherever"]
_ASKED_SQL = _sql_list(dict.fromkeys(ASKED))


@query(
    "rank_bm25",
    _FOUND + f""", lengths AS (
      SELECT doc_id, len(list_filter({_WORDS_SQL}, lambda t: t <> '')) AS dl FROM documents),
    corpus AS (SELECT count(*) AS n, avg(dl) AS mean FROM lengths)
    SELECT doc_id, round(sum(2 * ln(1 + (n - doc_freq + 0.5) / (doc_freq + 0.5)) * freq * 2.2
      / (freq + 1.2 * (0.25 + 0.75 * dl / mean))), 6) AS score
    FROM freqs JOIN stats USING (term) JOIN lengths USING (doc_id) CROSS JOIN corpus
    WHERE term IN ({_ASKED_SQL}) GROUP BY 1 ORDER BY score DESC, doc_id LIMIT 50""",
)
def rank_bm25(spark, sf):
    return T.rank_bm25(
        _documents(spark, sf), "doc_id", "text", A.standard_lower, ASKED, 50, boost=2.0
    )


@query(
    "rank_classic",
    _FOUND + f""", weights AS (
      SELECT doc_id, term, freq * ln((SELECT count(*) FROM documents) / CAST(doc_freq AS DOUBLE)) AS w
      FROM freqs JOIN stats USING (term))
    SELECT doc_id, round(sum(CASE WHEN term IN ({_ASKED_SQL}) THEN w ELSE 0 END) / sqrt(sum(w * w)), 6) AS score
    FROM weights GROUP BY 1 HAVING bool_or(term IN ({_ASKED_SQL})) ORDER BY score DESC, doc_id LIMIT 50""",
)
def rank_classic(spark, sf):
    return T.rank_classic(_documents(spark, sf), "doc_id", "text", A.standard_lower, ASKED, 50)


@query(
    "rank_boolean",
    _FOUND + f""" SELECT doc_id, CAST(count(*) AS DOUBLE) AS score FROM freqs
    WHERE term IN ({_ASKED_SQL}) GROUP BY 1 ORDER BY score DESC, doc_id LIMIT 50""",
)
def rank_boolean(spark, sf):
    return T.rank_boolean(_documents(spark, sf), "doc_id", "text", A.standard_lower, ASKED, 50)


def _index(spark, sf):
    """The documents' text and source, indexed."""
    path = scratch_path(spark, "index")
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    fields = {"text": ("text", A.standard_lower), "source": ("source", A.standard_lower)}
    I.build_index(docs, "doc_id", fields, path)
    return path


def _register_stored(model, boost, k):
    @query(f"stored_{model}", ORACLES[f"rank_{model}"])
    def stored(spark, sf):
        return I.search(spark, _index(spark, sf), {"text": ASKED}, k, model, {"text": boost}, "doc_id")


for _model, _boost in (("bm25", 2.0), ("classic", 1.0), ("boolean", 1.0)):
    _register_stored(_model, _boost, 50)


_SOURCE_SQL = r"list_filter(regexp_split_to_array(lower(source), '[^\p{L}\p{N}]+'), lambda t: t <> '')"
# Terms asked for in the source, one of many documents.
ASKED_SOURCES = ["src1", "src3", "nowhere"]


@query(
    "stored_fields",
    _FOUND + f""", lengths AS (
      SELECT doc_id, len(list_filter({_WORDS_SQL}, lambda t: t <> '')) AS dl FROM documents),
    corpus AS (SELECT count(*) AS n, avg(dl) AS mean FROM lengths),
    by_text AS (
      SELECT doc_id, sum(ln(1 + (n - doc_freq + 0.5) / (doc_freq + 0.5)) * freq * 2.2
        / (freq + 1.2 * (0.25 + 0.75 * dl / mean))) AS score
      FROM freqs JOIN stats USING (term) JOIN lengths USING (doc_id) CROSS JOIN corpus
      WHERE term IN ({_ASKED_SQL}) GROUP BY 1),
    source_lists AS (SELECT doc_id, {_SOURCE_SQL} AS toks FROM documents),
    source_corpus AS (SELECT count(*) AS n, avg(len(toks)) AS mean FROM source_lists),
    source_freqs AS (
      SELECT doc_id, term, count(*) AS freq, any_value(dl) AS dl
      FROM (SELECT doc_id, unnest(toks) AS term, len(toks) AS dl FROM source_lists) GROUP BY 1, 2),
    source_stats AS (SELECT term, count(*) AS doc_freq FROM source_freqs GROUP BY 1),
    by_source AS (
      SELECT doc_id, sum(3.5 * ln(1 + (n - doc_freq + 0.5) / (doc_freq + 0.5)) * freq * 2.2
        / (freq + 1.2 * (0.25 + 0.75 * dl / mean))) AS score
      FROM source_freqs JOIN source_stats USING (term) CROSS JOIN source_corpus
      WHERE term IN ({_sql_list(ASKED_SOURCES)}) GROUP BY 1)
    SELECT doc_id, round(sum(score), 6) AS score
    FROM (SELECT * FROM by_text UNION ALL SELECT * FROM by_source)
    GROUP BY 1 ORDER BY score DESC, doc_id LIMIT 40""",
)
def stored_fields(spark, sf):
    asked = {"text": ASKED, "source": ASKED_SOURCES}
    return I.search(spark, _index(spark, sf), asked, 40, "bm25", {"source": 3.5}, "doc_id")


_COMPLETE_SQL = """SELECT '{start}' AS prefix, input, weight FROM (
      SELECT input, max(p_size) AS weight FROM (
        SELECT substr(array_to_string(list_filter(regexp_split_to_array(lower(p_name), '[^\\p{{L}}]+'),
          lambda t: t <> ''), ' '), 1, 20) AS input, p_size FROM part)
      WHERE starts_with(input, '{start}') GROUP BY 1 ORDER BY weight DESC, input LIMIT {k})"""
STARTS = {"": 7, "r": 10, "re": 120, "red": 10, "red s": 10}


@query(
    "complete_stored",
    " UNION ALL ".join(f"SELECT * FROM ({_COMPLETE_SQL.format(start=p, k=k)})" for p, k in STARTS.items()),
)
def complete_stored(spark, sf):
    path = scratch_path(spark, "completions")
    I.build_completions(table(spark, sf, "part"), "p_name", "p_size", path, 20)
    found = [
        I.complete(spark, path, start.upper(), k).select(F.lit(start).alias("prefix"), "input", "weight")
        for start, k in STARTS.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    "complete_prefix",
    """SELECT input, max(p_size) AS weight FROM (
      SELECT substr(array_to_string(list_filter(regexp_split_to_array(lower(p_name), '[^\\p{L}]+'),
        lambda t: t <> ''), ' '), 1, 9) AS input, p_size FROM part)
    WHERE starts_with(input, 're') GROUP BY 1 ORDER BY weight DESC, input LIMIT 10""",
)
def complete_prefix(spark, sf):
    return T.complete_prefix(table(spark, sf, "part"), "p_name", "p_size", "Re", 10, 9)


@query(
    "hashed_cardinality",
    "SELECT count(DISTINCT text) AS exact, true AS estimate_is_close FROM documents",
)
def hashed_cardinality(spark, sf):
    counted = T.hashed_cardinality(table(spark, sf, "documents"), "text")
    close = F.abs(F.col("estimate") - F.col("exact")) <= F.col("exact") * 0.05
    return counted.select("exact", close.alias("estimate_is_close"))
