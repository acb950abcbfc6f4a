"""One query per operator over its whole table, with check SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddockflow.llm import (
    bpe, conversations, html_text, langid, licenses, lines, packing, phrases, quality, simhash, topk, toxicity,
    whitening,
)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_simhash_near_duplicates")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; three-word shingles, two bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=2)


def _sql_list(characters: str) -> str:
    return "[" + "".join("\\" + c if c in "#*$%&|<>!~^=_" else c for c in characters) + "]"


def _solid_sql(text: str) -> str:
    return f"length(regexp_replace({text}, '[\\x20\\x09-\\x0D]+', '', 'g'))"


def _count_sql(text: str, characters: str) -> str:
    return f"length(regexp_replace({text}, '[^{_sql_list(characters)[1:-1]}]', '', 'g'))"


_FAILED_SQL = f"""
(solid > 0 AND ({_count_sql('line', quality.DECORATION)} * 100 > solid * 10
  OR {_count_sql('line', quality.SEPARATORS)} * 100 > solid * 5
  OR (length(line) <= 120 AND regexp_matches(lower(line), '{"|".join(quality.PHRASES)}'))))
"""

QUALITY_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
),
u AS (SELECT r, unnest(words) AS w, unnest(range(len(words))) AS i FROM d),
w AS (
  SELECT r, i, w, lead(w, 1) OVER (PARTITION BY r ORDER BY i) AS w1, lead(w, 2) OVER (PARTITION BY r ORDER BY i) AS w2
  FROM u
),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, w, w1, w2) AS n FROM w WHERE w2 IS NOT NULL),
c AS (SELECT r, count(DISTINCT p) AS n_repeat FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY r),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
m AS (SELECT r, line, {_solid_sql('line')} AS solid FROM l),
f AS (
  SELECT r, count(*) FILTER (solid > 0) - count(DISTINCT line) FILTER (solid > 0) AS dup,
         coalesce(sum(solid) FILTER ({_FAILED_SQL}), 0) AS lost
  FROM m GROUP BY r
),
q AS (
  SELECT doc_id, len(words) AS n_words, {_solid_sql('t')} AS word_chars,
         {_count_sql('t', quality.SYMBOLS)} AS n_symbols, dup AS n_dup_lines,
         coalesce(n_repeat, 0) AS n_repeat_words, lost
  FROM d JOIN f USING (r) LEFT JOIN c USING (r)
),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM q)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND lost * 100 <= word_chars * 30 AS kept,
       CAST(lost AS BIGINT) AS n_failed_chars
FROM b
"""


@_query("op2_quality_rules", QUALITY_SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the line-first verdict of every document."""
    return quality.measured(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "n_failed_chars",
    )


@_query("op3_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces in sequences of at most 4096 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), tokenizers.path("word_bpe_49k.json"), 4096, 1)


@_query("op4_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    told = langid.identified(docs.select("doc_id", "text"), langid.train(docs))
    return told.select("row.doc_id", "lang_pred", "score").select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score"
    )


@_query("op8_byte_bpe_round_trip")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the bytes decoded from them."""
    path = tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encoded(table(spark, sf_dir, "documents"), path, tokenizers.PATTERN, digest=True)


@_query("op9_toxicity")
def toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, machine).select(
        "doc_id", langid.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


TOP_K_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
s AS (
  SELECT a.n, a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.n <> b.n AND len(a.q) = len(b.q)
),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@_query("op7_bit_sliced_top_k", TOP_K_SQL)
def bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products for every twentieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=20, k=20, scale=64, nameless=True)


def _phrase_sql(position: int, phrase: str, label: str) -> str:
    words = phrase.split()
    leads = " AND ".join(
        f"{'w' if k == 0 else f'lead(w, {k}) OVER o'} = '{word}'" for k, word in enumerate(words)
    )
    return f"SELECT r, i, '{label}' AS label, {leads} AS hit FROM u WINDOW o AS (PARTITION BY r ORDER BY i)"


LICENSES_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, text,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
u AS (SELECT r, unnest(words) AS w, unnest(range(len(words))) AS i FROM d),
h AS ({" UNION ALL ".join(_phrase_sql(i, p, x) for i, (p, x) in enumerate(licenses.PHRASES))}),
b AS (
  SELECT r, count(*) AS n, min(i) AS lo, max(i) AS hi, list_sort(list(DISTINCT label)) AS names
  FROM h WHERE hit GROUP BY r
),
t(label, words) AS (
  VALUES {", ".join(f"('{x}', {words!r})" for x, words in licenses.template_words(licenses.TEMPLATES))}
),
s AS (SELECT r, string_split(text, chr(10)) AS lines FROM d WHERE text IS NOT NULL),
k AS (
  SELECT r, long, list_distinct(regexp_extract_all(
           translate(array_to_string(lines[i + 1 : i + CASE WHEN long THEN {licenses.LONG_LINES} ELSE {licenses.SHORT_LINES} END], chr(10)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS words
  FROM (SELECT r, lines, unnest(range(len(lines))) AS i FROM s), (VALUES (false), (true)) v(long)
),
c AS (
  SELECT r, label, len(list_intersect(k.words, t.words)) / len(t.words) AS held, len(t.words) AS n
  FROM k JOIN t ON k.long = (len(t.words) > {licenses.SHORT})
),
m AS (
  SELECT r, list(DISTINCT label) AS more, max(held) AS most FROM c
  WHERE held * n >= ceil(0.9 * n - 1e-9) - 1e-6 GROUP BY r
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base,
       CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
       coalesce(array_to_string(names, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(names, []), coalesce(more, [])))), ','), '') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(most, 0.0) END AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN m USING (r)
"""


@_query("op10_license_scan", LICENSES_SQL)
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and template labels of every document."""
    return licenses.scanned(table(spark, sf_dir, "documents"))


@_query("op6_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later copies of runs of 50 words or more."""
    done = lines.deduplicated(table(spark, sf_dir, "documents"), min_words=50)
    return done.select(
        F.col("row.doc_id").alias("doc_id"), "n_removed", "removed", F.col("clean_text").alias("text")
    )


@_query("op5_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    told = html_text.extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return told.select(
        "row.page_id", "row.url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars")
    )


def _words_sql(text: str) -> str:
    return (
        f"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    )


DECONTAMINATION_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words_sql('text')} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_words_sql('text')} AS w FROM benchmark),
p AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[s + 1 : s + least(10, len(w))], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(greatest(1, len(w) - 9))) AS s FROM i WHERE len(w) > 0)
),
u AS (
  SELECT r, n, s, array_to_string(w[s + 1 : s + n], ' ') AS phrase
  FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)
),
h AS (SELECT u.r, u.s, u.n, p.item FROM u JOIN p USING (n, phrase)),
hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS place FROM h) GROUP BY r),
held AS (
  SELECT r, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS ids FROM h GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN held USING (r)
"""


@_query("op13_benchmark_decontamination", DECONTAMINATION_SQL)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside any ten words of a test item, and those items."""
    found = phrases.decontaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), words=10)
    hit = F.aggregate(F.zip_with("span_starts", "span_ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda a, b: a + b)
    return found.select(
        F.col("id").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("items") > 0).alias("contaminated"),
    )


@_query("op12_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sound vector along the four strongest components of all distinct ones."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"), scale=256, components=4)


#: Unsigned CRC-32 of a number's decimal text, bit by bit.
_CRC32_SQL = """
xor(list_reduce(
  list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, b: list_reduce(
    list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)
  )
), 4294967295)
"""

TRIE_SQL = f"""
WITH t AS (
  SELECT conv_id, length(coalesce(text, '')) AS size,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS token,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
o AS (SELECT conv_id, list(token ORDER BY pos) AS tokens, list(size ORDER BY pos) AS sizes FROM t GROUP BY conv_id),
h AS (SELECT *, conv_id - conv_id % 100 AS origin, CAST({_CRC32_SQL} % 6 AS INT) AS h FROM o),
b AS (
  SELECT h.conv_id, list_concat(coalesce(o.tokens[1 : h], []), h.tokens[h + 1 :]) AS tokens,
         list_concat(coalesce(o.sizes[1 : h], []), h.sizes[h + 1 :]) AS sizes
  FROM h LEFT JOIN o ON o.conv_id = h.origin
),
m AS (
  SELECT conv_id, depth, len(tokens) AS n, array_to_string(tokens[1 : depth], ',') AS node,
         CASE WHEN depth > 0 THEN array_to_string(tokens[1 : depth - 1], ',') END AS parent,
         CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END AS size, tokens
  FROM (SELECT *, unnest(range(len(tokens) + 1)) AS depth FROM b)
),
g AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(size) AS size, any_value(tokens) AS tokens,
         min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(array_to_string(list(conv_id ORDER BY conv_id) FILTER (n = depth), ','), '')) AS ends_sha256
  FROM m GROUP BY node
),
k AS (SELECT parent AS node, count(*) AS n_children FROM g WHERE parent IS NOT NULL GROUP BY parent),
a AS (
  SELECT array_to_string(g.tokens[1 : up], ',') AS node, (g.n_convs - 1) * g.size AS saved,
         CASE WHEN k.node IS NULL THEN 1 ELSE 0 END AS leaf
  FROM (SELECT *, unnest(range(depth + 1)) AS up FROM g) g LEFT JOIN k ON k.node = g.node
),
s AS (SELECT node, sum(saved) AS saved, sum(leaf) AS leaves FROM a GROUP BY node)
SELECT g.conv_id, CAST(g.depth AS BIGINT) AS depth, above.conv_id AS parent_conv_id, CAST(g.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, g.ends_sha256
FROM g JOIN s USING (node) LEFT JOIN k USING (node) LEFT JOIN g above ON above.node = g.parent
"""


@_query("op11_conversation_prefix_trie", TRIE_SQL)
def conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations with its members and subtree figures."""
    return conversations.trie(table(spark, sf_dir, "conversations"), every=100, most=6).drop("digest")
