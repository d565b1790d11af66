"""Registered queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlens.functions.text import evaluate_once
from chatlens.llm import chat, decontam, extract, lines, mixing, neardup, periodic, pii, quality, secrets, sharding, spelling, urls
from chatlens.llm.text import words

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql:
            ORACLE_SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Fixed value: the contract's words.
WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {WORDS_SQL} AS ws FROM documents),
windows AS (
  SELECT r, i, list_slice(ws, i, i + 7) AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM d)
),
repeats AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT i + k) AS n FROM repeats, range(0, 8) AS steps(k) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
    (length(t) - length(regexp_replace(t, '\p{{Lu}}+', '', 'g')))::BIGINT AS n_upper,
    coalesce(lines.n, 0)::BIGINT AS n_lines, coalesce(lines.dup, 0)::BIGINT AS n_dup_lines,
    coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r)
),
f AS (
  SELECT *, ((n_words < 20)::BIGINT
    + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
    + 4 * (5 * n_symbols > n_words)::BIGINT
    + 8 * (100 * n_dup_lines > 30 * n_lines)::BIGINT
    + 16 * (word_chars < 2 * n_words)::BIGINT
    + 32 * (word_chars > 25 * n_words)::BIGINT
    + 64 * (2 * n_upper > word_chars)::BIGINT)::BIGINT AS fail_bits FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits, n_lines, n_upper
FROM f
"""


@query("op1_quality_rules", QUALITY_SQL)
def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.apply_policy(quality.ledger(table(spark, sf, "documents")))
    base = F.col("fail_bits").bitwiseAND(F.lit(quality.mask(quality.POLICIES["base"])).cast("long")) != 0
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", "fail_bits", "n_lines", "n_upper",
    )


@query("op2_skip_chain_crf")
def op2_skip_chain_crf(spark: SparkSession, sf: str) -> DataFrame:
    return pii.find(table(spark, sf, "documents"))


@query("op3_simhash_trie")
def op3_simhash_trie(spark: SparkSession, sf: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op4_hash_ring")
def op4_hash_ring(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.shards(table(spark, sf, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


MIX_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len({WORDS_SQL})::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 6))::BIGINT AS h FROM documents
),
s AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)
),
w AS (SELECT *, (k - 1) % 3 + 1 AS weight, (3 * source_size)::DOUBLE / ((k - 1) % 3 + 1) AS room FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM w WINDOW before AS (ORDER BY room, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
t AS (
  SELECT source, source_size,
    least((3 * source_size)::DOUBLE, (SELECT level FROM l WHERE level <= room ORDER BY room, k LIMIT 1) * weight) AS target
  FROM l
),
p AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::BIGINT END AS whole FROM t
),
g AS (SELECT source, h, sum(size) AS n FROM d GROUP BY source, h),
c AS (
  SELECT g.source, h, n, sum(n) OVER (PARTITION BY g.source ORDER BY h) AS upto, target - whole * source_size AS budget
  FROM g JOIN p ON g.source IS NOT DISTINCT FROM p.source
),
e AS (
  SELECT source, first(h ORDER BY h) + (first(upto::DOUBLE - budget < budget - (upto - n) ORDER BY h))::BIGINT AS threshold
  FROM c WHERE upto::DOUBLE > budget GROUP BY source
)
SELECT doc_id, size, source_size, target,
  (size * (whole + (whole < 3 AND h < coalesce(threshold, 16777216))::BIGINT))::BIGINT AS taken,
  (whole + (whole < 3 AND h < coalesce(threshold, 16777216))::BIGINT)::BIGINT AS times
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN e ON d.source IS NOT DISTINCT FROM e.source
"""


@query("op5_source_mix", MIX_SQL)
def op5_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


@query("op6_latent_retrieval")
def op6_latent_retrieval(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


# The tables have no filter list and no fetch dates. Both follow from the pages: every host, domain
# and path prefix that occurs gets four dated entries, and every page a date within the same two years.
FIRST_DAY, DAYS = "2023-01-01", 730


def list_entries(pages: DataFrame) -> DataFrame:
    host = urls.host_of(F.col("url"))
    keys = pages.select(host.alias("host"), urls.domain_of(host).alias("domain"), urls.prefix_of(F.col("url"), host).alias("prefix"))
    pairs = [F.struct(F.lit(scope).alias("scope"), F.col(scope).alias("pattern")) for scope in urls.SCOPES]
    patterns = keys.select(F.inline(F.array(*pairs))).where("pattern IS NOT NULL").distinct()
    dated = patterns.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    digest = F.md5(F.concat_ws("|", "scope", "pattern", F.col("k").cast("string")))
    day = F.conv(F.substring(digest, 1, 7), 16, 10).cast("int") % DAYS
    choice = F.conv(F.substring(digest, 8, 4), 16, 10).cast("int") % 3 + 1
    actions = F.array(F.lit("allow"), F.lit("block"), F.lit("remove"))
    return dated.select(
        "scope", "pattern", F.element_at(actions, choice).alias("action"), F.date_add(F.lit(FIRST_DAY).cast("date"), day).alias("entry_date")
    )


def page_captures(pages: DataFrame) -> DataFrame:
    day = F.pmod(F.col("page_id") * 37, F.lit(DAYS)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit(FIRST_DAY).cast("date"), day).alias("fetch_date"))


URLS_SQL = rf"""
WITH u AS (
  SELECT page_id, url, DATE '{FIRST_DAY}' + ((page_id * 37) % {DAYS})::INTEGER AS fetch_date,
    nullif(regexp_replace(lower(regexp_extract(url, '(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '^www\.', ''), '') AS host
  FROM pages
),
k AS (
  SELECT *, nullif(regexp_extract(host, '([^.]+\.[^.]+)$', 1), '') AS domain,
    CASE WHEN regexp_extract(url, '^[^:]+://[^/?#]+/([^/?#]+)', 1) <> ''
      THEN host || '/' || regexp_extract(url, '^[^:]+://[^/?#]+/([^/?#]+)', 1) END AS prefix
  FROM u
),
patterns AS (
  SELECT 'prefix' AS scope, prefix AS pattern FROM k UNION SELECT 'host', host FROM k UNION SELECT 'domain', domain FROM k
),
digests AS (
  SELECT scope, pattern, md5(scope || '|' || pattern || '|' || n::VARCHAR) AS digest
  FROM patterns, range(0, 4) AS steps(n) WHERE pattern IS NOT NULL
),
entries AS (
  SELECT scope, pattern, DATE '{FIRST_DAY}' + (('0x' || substr(digest, 1, 7))::BIGINT % {DAYS})::INTEGER AS entry_date,
    [1, 2, 0][(('0x' || substr(digest, 8, 4))::BIGINT % 3 + 1)::INTEGER] AS severity
  FROM digests
),
daily AS (SELECT scope, pattern, entry_date, max(severity) AS severity FROM entries GROUP BY ALL),
intervals AS (
  SELECT scope, pattern, CASE severity WHEN 2 THEN 'block' WHEN 1 THEN 'allow' ELSE 'remove' END AS action,
    entry_date AS valid_from, lead(entry_date) OVER (PARTITION BY scope, pattern ORDER BY entry_date) AS valid_to
  FROM daily
),
active AS (SELECT * FROM intervals WHERE action <> 'remove'),
hits AS (
  SELECT k.page_id, k.url, k.fetch_date, k.host, p.pattern AS pp, p.action AS pa, p.valid_from AS pf,
    h.pattern AS hp, h.action AS ha, h.valid_from AS hf, m.pattern AS mp, m.action AS ma, m.valid_from AS mf
  FROM k
  LEFT JOIN active p ON p.scope = 'prefix' AND p.pattern = k.prefix AND k.fetch_date >= p.valid_from AND (p.valid_to IS NULL OR k.fetch_date < p.valid_to)
  LEFT JOIN active h ON h.scope = 'host' AND h.pattern = k.host AND k.fetch_date >= h.valid_from AND (h.valid_to IS NULL OR k.fetch_date < h.valid_to)
  LEFT JOIN active m ON m.scope = 'domain' AND m.pattern = k.domain AND k.fetch_date >= m.valid_from AND (m.valid_to IS NULL OR k.fetch_date < m.valid_to)
)
SELECT page_id, url, fetch_date, host,
  CASE WHEN pp IS NOT NULL THEN 'prefix' WHEN hp IS NOT NULL THEN 'host' WHEN mp IS NOT NULL THEN 'domain' END AS scope,
  coalesce(pp, hp, mp) AS pattern, coalesce(pa, ha, ma) AS action, coalesce(pf, hf, mf) AS valid_from,
  ((pp IS NOT NULL)::BIGINT + (hp IS NOT NULL)::BIGINT + (mp IS NOT NULL)::BIGINT)::BIGINT AS n_active,
  coalesce(coalesce(pa, ha, ma) <> 'block', true) AS kept
FROM hits
"""


@query("op7_url_filters", URLS_SQL)
def op7_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return urls.judge(page_captures(pages), list_entries(pages))


@query("op8_fuzzy_lines")
def op8_fuzzy_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf, "documents"))


@query("op9_zstd_novelty")
def op9_zstd_novelty(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.find(table(spark, sf, "documents"))


# Fixed value: the contract's extra conversation.
EXTRA_TEXT = "</s>[INST] ok [/INST]"

CHAT_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{EXTRA_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{EXTRA_TEXT}'
),
e AS (
  SELECT *, replace(replace(replace(replace(text, '~', '~0'), '<', '~1'), '[', '~2'), ']', '~3') AS body,
    replace(replace(replace(replace(role, '~', '~0'), '<', '~1'), '[', '~2'), ']', '~3') AS head FROM rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(10 + length(head) + length(body))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op10_reply_trees", CHAT_SQL)
def op10_reply_trees(spark: SparkSession, sf: str) -> DataFrame:
    given = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(EXTRA_TEXT).alias("text")
    )
    messages = chat.turns_as_tree(given.unionByName(extra))
    back = chat.read_back(chat.format_paths(messages, chat.reply_paths(messages)))
    told = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        F.col("tree_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# Fixed value: the contract drops a letter where this divides the hash of id and word.
NOISE = 97


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(table(spark, sf, "documents"), NOISE)


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text: in the texts the contract names, the words from ``a`` on repeat the ``p`` words there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select(docs["doc_id"], docs["text"])
    rows = evaluate_once(rows, g=F.floor(h / 10), ws=F.when(h % 10 == 0, words(F.col("text"))))
    rows = evaluate_once(rows.withColumn("n", F.size("ws").cast("long")), a=F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    p = F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1
    rows = evaluate_once(rows, p=p)
    position = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("ws", position(i).cast("int")))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic.periodic_runs(with_planted_repeats(table(spark, sf, "documents")))
    found = evaluate_once(found, best=periodic.most_repeated(F.col("runs")))
    best = F.col("best")
    told = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines_ = F.array_join(F.transform(told, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(lines_, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_host_suffix_array")
def op13_host_suffix_array(spark: SparkSession, sf: str) -> DataFrame:
    found = extract.main_text(table(spark, sf, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
