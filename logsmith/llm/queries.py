"""Registered queries over the operators of this subpackage, with DuckDB texts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsmith.llm.common import WORD_PATTERN, crc_of_id, let, read_table
from logsmith.session import apply_defaults

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = oracle
        return fn
    return wrap


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logsmith.llm.toxicity import FOLDS, HELD_OUT, score_documents, train_toxicity_model
    docs = read_table(spark, sf_dir, "documents")
    model = train_toxicity_model(docs, read_table(spark, sf_dir, "labels"))
    held = docs.select("doc_id", "text", (F.pmod(crc_of_id(), F.lit(FOLDS)) == HELD_OUT).alias("held_out"))
    return score_documents(held, model, keep=["doc_id", "held_out"])


@query("op2_substring_dedup")
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text after the cut, the words removed and their spans."""
    from logsmith.llm.substring_dedup import remove_repeats
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "removed_words", "removed_spans", "text")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _address_sql(url: str) -> str:
    """A url without its fragment, scheme and host in lower case."""
    bare, head = f"regexp_extract({url}, '(?s)^([^#]*)', 1)", f"regexp_extract({url}, '(?s)^([^#]*?://[^/?#]*)', 1)"
    return f"(translate({head}, '{_UPPER}', '{_LOWER}') || substr({bare}, length({head}) + 1))"


def _rule_sql(host: str, path: str, what: str) -> str:
    from logsmith.llm.url_filter import RULES
    whens = [f"WHEN ({host} = '{h}' OR ends_with({host}, '.{h}')) AND starts_with({path}, '{p}') THEN '{h + p if what == 'rule' else action}'"
             for action, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
    return f"CASE {' '.join(whens)} END"


def _host_sql(url: str) -> str:
    return f"translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}')"


def _path_sql(url: str) -> str:
    return f"regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


URL_FILTER_SQL = f"""
WITH RECURSIVE tags AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\\b[^>]*>')) AS tag FROM pages WHERE url IS NOT NULL),
targets AS (
  SELECT url, regexp_extract(tag, '(?is)\\bhref\\s*=\\s*["'']?([^"''>\\s]+)', 1) AS target FROM tags
  WHERE regexp_matches(tag, '(?is)^<link') AND regexp_matches(tag, '(?is)\\brel\\s*=\\s*["'']?canonical\\b')
  UNION
  SELECT url, regexp_extract(tag, '(?is)\\burl\\s*=\\s*''?([^"''>\\s]+)', 1) AS target FROM tags
  WHERE regexp_matches(tag, '(?is)^<meta') AND regexp_matches(tag, '(?is)\\bhttp-equiv\\s*=\\s*["'']?refresh\\b')),
split AS (
  SELECT url, replace(target, '&amp;', '&') AS t, regexp_extract(url, '(?s)^([^#]*)', 1) AS page,
         regexp_extract(url, '(?s)^([^#]*?://[^/?#]*)', 1) AS site,
         regexp_extract(url, '(?s)^[^#]*?://[^/?#]*([^?#]*)', 1) AS page_path FROM targets WHERE target <> ''),
placed AS (
  SELECT url, t, page, site, page_path, CASE
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN 'whole'
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') OR site = '' THEN 'none'
    WHEN starts_with(t, '//') THEN 'host' WHEN starts_with(t, '?') THEN 'query' WHEN starts_with(t, '#') THEN 'page'
    ELSE 'path' END AS form,
    CASE WHEN starts_with(t, '/') THEN '' WHEN page_path = '' THEN '/'
         ELSE regexp_extract(page_path, '(?s)^(.*/)', 1) END || regexp_extract(t, '(?s)^([^?#]*)', 1) AS walk,
    regexp_extract(t, '(?s)^[^?#]*(.*)', 1) AS rest FROM split),
walked(url, t, walk, done) AS (
  SELECT DISTINCT url, t, substr(walk, 2), '' FROM placed WHERE form = 'path'
  UNION
  SELECT url, t, CASE WHEN contains(walk, '/') THEN regexp_extract(walk, '(?s)^[^/]*/(.*)', 1) END,
    CASE regexp_extract(walk, '(?s)^([^/]*)', 1)
      WHEN '.' THEN CASE WHEN contains(walk, '/') OR done = '' THEN done ELSE done || '/' END
      WHEN '..' THEN regexp_replace(done, '(?s)/[^/]*$', '') || CASE WHEN contains(walk, '/') OR NOT contains(substr(done, 2), '/') THEN '' ELSE '/' END
      ELSE done || '/' || regexp_extract(walk, '(?s)^([^/]*)', 1) END
  FROM walked WHERE walk IS NOT NULL),
links AS (
  SELECT DISTINCT {_address_sql('url')} AS a, {_address_sql('full_url')} AS b FROM (
    SELECT placed.url, CASE form WHEN 'whole' THEN placed.t
      WHEN 'host' THEN regexp_extract(site, '(?s)^(.*?:)//', 1) || placed.t
      WHEN 'query' THEN site || page_path || placed.t WHEN 'page' THEN page
      WHEN 'path' THEN site || CASE WHEN done = '' THEN '/' ELSE done END || rest END AS full_url
    FROM placed LEFT JOIN walked ON placed.url = walked.url AND placed.t = walked.t AND walked.walk IS NULL)
  WHERE full_url IS NOT NULL),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, a FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
aliases AS (
  SELECT a, CASE WHEN bool_or({_rule_sql(_host_sql('b'), _path_sql('b'), 'action')} = 'allow') THEN 'allow'
                 WHEN bool_or({_rule_sql(_host_sql('b'), _path_sql('b'), 'action')} = 'block') THEN 'block' END AS verdict
  FROM reach GROUP BY a),
judged AS (
  SELECT page_id, coalesce({_host_sql('url')}, '') AS host, coalesce({_path_sql('url')}, '') AS path,
         {_address_sql('url')} AS address FROM pages)
SELECT page_id, host, path, {_rule_sql('host', 'path', 'rule')} AS rule,
       coalesce({_rule_sql('host', 'path', 'action')}, aliases.verdict, 'allow') AS verdict
FROM judged LEFT JOIN aliases ON judged.address = aliases.a"""


@query("op3_url_filters", URL_FILTER_SQL)
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logsmith.llm.url_filter import judge_urls
    return judge_urls(read_table(spark, sf_dir, "pages"))


@query("op4_ngram_join")
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logsmith.llm.ngram_join import ngram_jaccard_join
    return ngram_jaccard_join(read_table(spark, sf_dir, "documents"))


@query("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logsmith.llm.sentencepiece_wfst import encode_documents
    return encode_documents(read_table(spark, sf_dir, "documents"))


@query("op6_mixing")
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logsmith.llm.mixing import mix_plan
    plan = mix_plan(read_table(spark, sf_dir, "documents"))
    return plan.select(F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"), "*").select(
        "doc_id", "size", "source_size", "target", "taken", "source", "shards")


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logsmith.llm.language_crf import FOLDS, HELD_OUT, predict_languages, train_language_model
    docs = read_table(spark, sf_dir, "documents")
    held = docs.select("doc_id", "text", (F.pmod(crc_of_id(), F.lit(FOLDS)) == HELD_OUT).alias("held_out"))
    return predict_languages(held, train_language_model(docs), keep=["doc_id", "held_out"])


@query("op8_fingerprints")
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logsmith.llm.fingerprint import fingerprints_with_next
    return fingerprints_with_next(read_table(spark, sf_dir, "documents"))


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logsmith.llm.quality_kn import classify_quality
    return classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op10_nearest_neighbours")
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logsmith.llm.cross_polytope import nearest_neighbours
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"))


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _marked_sql(pattern: str) -> str:
    """A text's pieces between and inside the matches of a pattern, in turn."""
    quoted = pattern.replace("'", "''")
    return f"string_split(regexp_replace(body, '{quoted}', chr(1) || '\\0' || chr(1), 'g'), chr(1))"


_ASSIGN_SQL = ("(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
               + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")

SECRET_SCAN_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, source,
                     translate(coalesce(text, ''), chr(1), chr(2)) AS body FROM documents),
parts AS (
  SELECT row_no, 0 AS kind, {_marked_sql(_ASSIGN_SQL)} AS pieces FROM docs
  UNION ALL SELECT row_no, 1, {_marked_sql('AKIA[A-Z0-9]+')} FROM docs
  UNION ALL SELECT row_no, 2, {_marked_sql('[0-9a-f]+')} FROM docs WHERE regexp_matches(body, '[0-9a-f]{{32}}')
  UNION ALL SELECT row_no, 3, {_marked_sql('[A-Za-z0-9+/_-]{16,}')} FROM docs),
pieces AS (
  SELECT row_no, kind, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS no FROM parts WHERE len(pieces) > 1),
placed AS (
  SELECT row_no, kind, no, piece,
         sum(length(piece)) OVER (PARTITION BY row_no, kind ORDER BY no) AS stop FROM pieces),
found AS (
  SELECT row_no, kind, stop - length(piece) AS start, stop,
         CASE WHEN kind = 0 THEN regexp_extract(piece, '{_ASSIGN_SQL.replace("'", "''")}', 2) ELSE piece END AS secret
  FROM placed WHERE no % 2 = 0),
spans AS (
  SELECT *, regexp_matches(secret, '[A-Za-z]') AND regexp_matches(secret, '[0-9]')
            AND len(list_distinct(string_split(secret, ''))) >= 8 AS looks_live
  FROM found WHERE length(secret) >= CASE kind WHEN 0 THEN 8 WHEN 1 THEN 16 WHEN 2 THEN 32 ELSE 16 END),
candidates AS (SELECT * FROM spans WHERE kind < 3 OR looks_live),
owners AS (
  SELECT secret, count(DISTINCT coalesce('=' || source, '')) AS owners,
         count(DISTINCT (coalesce('=' || source, ''), coalesce(CAST(doc_id AS VARCHAR), ''))) AS repositories
  FROM candidates JOIN docs USING (row_no) GROUP BY secret),
judged AS (
  SELECT c.*, owners < 4 AND repositories < 10 AND owners = 1 AND looks_live AS live, owners >= 4 OR repositories >= 10 AS example
  FROM candidates c JOIN owners USING (secret)),
shown AS (
  SELECT DISTINCT row_no, start, kind, stop FROM judged WHERE kind < 3
  UNION SELECT DISTINCT row_no, stop - length(secret), 3, stop FROM judged WHERE live),
texts AS (
  SELECT row_no, string_agg(named, ',' ORDER BY start, kind, stop) FILTER (kind < 3) AS base,
         string_agg(named, ',' ORDER BY start, kind, stop) AS spans,
         count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex, count(*) FILTER (kind = 3) AS n_live
  FROM (SELECT *, (['assign', 'access', 'hex', 'live'])[kind + 1] || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT)
               AS named FROM shown) GROUP BY row_no),
examples AS (SELECT row_no, count(*) AS n_example FROM judged WHERE kind < 3 AND example GROUP BY row_no)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
       coalesce(n_example, 0) AS n_example
FROM docs LEFT JOIN texts USING (row_no) LEFT JOIN examples USING (row_no)"""


@query("op11_secret_scans", SECRET_SCAN_SQL)
def op11_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logsmith.llm.secret_scan import scan_secrets, spans_text
    scanned = scan_secrets(read_table(spark, sf_dir, "documents"))

    def count(test):
        return F.size(F.filter("findings", test)).cast("long")

    def of_kind(kind):
        return count(lambda f: f["kind"] == kind).alias(f"n_{kind}")
    base = F.filter("findings", lambda f: f["kind"] != "live")
    return scanned.select(
        "doc_id", of_kind("assign"), of_kind("access"), of_kind("hex"),
        F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("findings")).alias("spans"),
        of_kind("live"),
        count(lambda f: (f["kind"] != "live") & (f["verdict"] == "example")).alias("n_example"))


def plant_period(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The text, or for one id in ten its words with a period from a place on (a null id changes nothing)."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.col(text), WORD_PATTERN.replace("[^", "[", 1)), lambda w: w != "")

    def repeated(all_words: Column) -> Column:
        n = F.size(all_words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.transform(all_words, lambda w, i: F.when(i < a, w).otherwise(
            F.get(all_words, a + (i - a) % p))), " ")
    planted = let(words, lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(""))
    return F.when(h % 10 == 0, planted).otherwise(F.col(text))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logsmith.llm.periodic_runs import collapse_runs
    docs = read_table(spark, sf_dir, "documents").select("doc_id", plant_period().alias("text"))
    # exact comparison of length / period; the runs come by start and period, so the first of equals stays
    best = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda top, r: F.when(
        top.isNull() | (r["length"] * top["period"] > top["length"] * r["period"]), r).otherwise(top))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = collapse_runs(docs).withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))


FILTER_AUDIT_SQL = """
WITH read AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
judged AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 2 * length(body) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY body) THEN 16 ELSE 0 END AS mask
  FROM read),
tags AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
         FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(bad, 0)) AS bad
  FROM judged LEFT JOIN tags USING (doc_id) GROUP BY part, mask),
filters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS flag),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.flag, b.flag, c.flag, d.flag, e.flag] AS flags
  FROM filters a, filters b, filters c, filters d, filters e
  WHERE a.flag + b.flag + c.flag + d.flag + e.flag = 31 AND a.flag | b.flag | c.flag | d.flag | e.flag = 31),
steps AS (
  SELECT filter_order, step, flags[step] AS flag, list_sum(flags[1:step - 1]) AS before
  FROM (SELECT *, unnest(range(1, 6)) AS step FROM orders)),
counted AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, flag,
         sum(CASE WHEN mask & (coalesce(before, 0) | flag) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & coalesce(before, 0) = 0 AND mask & flag > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & coalesce(before, 0) > 0 AND mask & flag > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = flag THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & coalesce(before, 0) = 0 AND mask & flag > 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & coalesce(before, 0) = 0 AND mask & flag > 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, flag, before)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, flag) AS BIGINT) AS shapley
FROM counted"""


@query("op13_filter_audit", FILTER_AUDIT_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logsmith.llm.filter_audit import audit_filters
    return audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
