"""The registered queries of the corpus operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclear.llm import chat_format, conversation_repair, fertility, fingerprints, jaccard_groups, language_id, license_scan, mixing, packing, spelling, token_counts, toxicity, url_filter
from gridclear.llm.common import table
from gridclear.llm.tokenizer_files import path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

FERTILITY_VOCABULARY = "piece_bpe_32k.model"
PACKING_VOCABULARY = "word_bpe_49k.json"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    confirmed = F.filter("findings", lambda f: f["confirmed"])
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_paragraphs", F.array_join("families", ",").alias("families"), F.size(confirmed).cast("long").alias("n_confirmed"),
        (F.size("findings") - F.size(confirmed)).cast("long").alias("n_unconfirmed"),
        F.try_element_at(confirmed, F.lit(1))["start"].alias("first_start"), F.try_element_at(confirmed, F.lit(1))["end"].alias("first_end"),
    )


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"))


@query
def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_neighbours(table(spark, sf_dir, "documents"))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = fertility.quality_rules(table(spark, sf_dir, "documents"), path(FERTILITY_VOCABULARY))
    return judged.drop("text_key")


@query
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups.similar_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


#: Fixed by the contract: the longest fitting rule decides.
URL_RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]


@query
def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(table(spark, sf_dir, "documents")).decisions()


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents")).drop("text_key")


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), path(PACKING_VOCABULARY))


@query
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = [(-7, k, role, "\\### Assistant: </turn> ok") for k, role in enumerate(("user", "assistant"))]
    rows = conversations.unionByName(spark.createDataFrame(probe, "conv_id long, turn long, role string, text string"))
    return chat_format.read_back(chat_format.format_conversations(rows, chat_format.marked_turns))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))


@query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# ---------------------------------------------------------------------------------------------------------------------
# SQL with the same rows, for the queries that it can express.

SQL_URL = f"""
WITH RECURSIVE pages_ AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
targets AS (
  SELECT url, replace(unnest([
    regexp_extract(html, $r${url_filter.REFRESH}$r$, 1),
    regexp_extract(html, $r${url_filter.CANONICAL}$r$, 1),
    regexp_extract(html, $r${url_filter.CANONICAL_LATER}$r$, 1)]), '&amp;', '&') AS target
  FROM pages_),
whole AS (
  SELECT url, CASE WHEN contains(target, '://') THEN target
    WHEN starts_with(target, '//') THEN {{scheme}} || ':' || target
    WHEN starts_with(target, '/') THEN {{scheme}} || '://' || {{host}} || target
    ELSE {{scheme}} || '://' || {{host}} || CASE WHEN regexp_replace({{path}}, '[^/]*$', '') = '' THEN '/'
      ELSE regexp_replace({{path}}, '[^/]*$', '') END || target END AS target
  FROM targets WHERE target <> '' AND contains(url, '://')),
ends AS (SELECT {{node}} AS a, target AS url FROM whole),
links AS (SELECT a, {{node}} AS b FROM ends),
both_ways AS (SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b),
reach AS (SELECT a AS node, a AS url FROM both_ways UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.url = e.a),
found AS (SELECT node, {{rule}} AS rule FROM reach),
aliases AS (
  SELECT node, CASE WHEN bool_or(rule IN ('example.net/en/', 'org/fr/')) THEN 'allow' WHEN bool_or(rule IS NOT NULL) THEN 'block' END AS verdict
  FROM found GROUP BY node),
judged AS (
  SELECT page_id, {{host}} AS host, {{path}} AS path, {{rule}} AS rule, CASE WHEN contains(url, '://') THEN {{node}} END AS node FROM pages_)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' ELSE coalesce(verdict, 'allow') END AS verdict,
  CASE WHEN rule IS NOT NULL THEN 'rule' WHEN verdict IS NOT NULL THEN 'alias' ELSE 'default' END AS by
FROM judged LEFT JOIN aliases USING (node)
"""


def url_sql() -> str:
    part = [f"regexp_extract(url, $r${url_filter.PARTS}$r$, {k})" for k in range(5)]
    scheme, host = (f"translate({part[k]}, '{url_filter.UPPER}', '{url_filter.LOWER}')" for k in (1, 2))
    node = f"{scheme} || '://' || {host} || CASE WHEN {part[3]} = '' THEN '/' ELSE {part[3]} END || {part[4]}"
    fits = " ".join(
        f"WHEN ({host} = '{r.host}' OR ends_with({host}, '.{r.host}')) AND starts_with({part[3]}, '{r.path}') THEN '{r.name}'"
        for r in sorted(URL_RULES, key=lambda r: -len(r.name))
    )
    return SQL_URL.format(scheme=scheme, host=host, path=part[3], node=node, rule=f"CASE {fits} END")


SQL_MIX = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS place FROM documents),
docs AS (
  SELECT doc_id, place, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS size,
    -ln((('0x' || substr(md5('0|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(text)), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE)
      / 4503599627370496::DOUBLE)
    / greatest(0.05::DOUBLE, 1::DOUBLE - 10::DOUBLE * (length(text) - length(translate(text, '#*$%&|<>!', ''))) / greatest(length(text), 1)) AS key
  FROM texts),
sums AS (SELECT place, sum(size)::BIGINT AS source_size FROM docs GROUP BY place),
weights AS (
  SELECT place, source_size, ([5, 2, 1])[(row_number() OVER (ORDER BY place) - 1) % 3 + 1]::DOUBLE AS weight, 2::DOUBLE * source_size AS cap
  FROM sums),
ranked AS (SELECT *, cap / weight AS ratio, row_number() OVER (ORDER BY cap / weight, place) AS i FROM weights),
levels AS (
  SELECT i, ratio, (1.5::DOUBLE * (SELECT sum(source_size) FROM sums)
      - coalesce(sum(cap) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
chosen AS (SELECT level FROM levels WHERE level <= ratio ORDER BY i LIMIT 1),
targets AS (
  SELECT place, source_size, least(weight * level, cap) AS target,
    CASE WHEN source_size > 0 THEN floor(least(weight * level, cap) / source_size) ELSE 0 END::BIGINT AS epochs
  FROM weights, chosen),
placed AS (
  SELECT doc_id, size, source_size, target, epochs, floor(target - epochs * source_size)::BIGINT
    - coalesce(sum(size) OVER (PARTITION BY place ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM docs JOIN targets USING (place))
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, room)))::BIGINT AS taken FROM placed
"""

SQL_JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * both_ >= 80 * (x.n + y.n - both_)),
reach AS (SELECT a AS doc_id, a AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(other, doc_id) AS component_id
FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""

SQL_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('### : </turn>') + 1 + 2 * (length(role) + length(text)) - length(translate(role, '\#<:', '')) - length(translate(text, '\#<', '')))::BIGINT
    AS formatted_chars,
  false AS rewrites_history
FROM turns GROUP BY conv_id
"""

#: The checksum is computed byte by byte from a table that its polynomial gives.
SQL_SPELLING = f"""
WITH RECURSIVE polynomial AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    unnest(regexp_extract_all(translate(coalesce(text, ''), '{spelling.UPPER}', '{spelling.LOWER}'), '[a-zÀ-ÿ]{{{spelling.LEAST_LENGTH},}}')) AS run
  FROM documents),
counted AS (SELECT run, hex(encode(id || ':' || run)) AS digits, count(*) AS k FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(digits), 2), lambda i: CAST('0x' || substr(digits, i, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1]))) AS h
  FROM counted, polynomial),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, CAST(sum(k) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= {spelling.LEAST_LENGTH} AND sum(k) >= {spelling.LEAST_COUNT}),
cuts AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near FROM cuts a JOIN cuts b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
  UNION SELECT cuts.word, words.word FROM cuts JOIN words ON cut = words.word
  UNION SELECT words.word, cuts.word FROM cuts JOIN words ON cut = words.word),
ranked AS (
  SELECT near.word, near, v.n AS near_n, count(*) OVER (PARTITION BY near.word) AS n_near,
    row_number() OVER (PARTITION BY near.word ORDER BY v.n DESC, near) AS place
  FROM near JOIN words v ON near = v.word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {spelling.DOMINANCE} * w.n THEN near END AS form,
    CASE WHEN near_n >= {spelling.DOMINANCE} * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND place = 1),
chain AS (
  SELECT word, word AS root, form AS next_form FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON c.next_form = f.word)
SELECT formed.word, form, root, n, n_near, form_n FROM formed JOIN chain ON formed.word = chain.word AND next_form IS NULL
"""

ORACLE["op11_spelling_variants"] = SQL_SPELLING
ORACLE["op6_ngram_jaccard_join"] = SQL_JACCARD
ORACLE["op10_chat_formatting"] = SQL_CHAT
ORACLE["op5_url_filters"] = url_sql()
ORACLE["op7_mixing"] = SQL_MIX


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def comparison_sql() -> dict[str, str]:
    return dict(ORACLE)
