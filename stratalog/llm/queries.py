"""Queries over the test tables, one for each operator, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.llm import toxicity
from stratalog.llm.collocations import collocations
from stratalog.llm.common import new_folder
from stratalog.llm.divergence import divergence
from stratalog.llm.exact_dedup import exact_dedup
from stratalog.llm.line_dedup import line_dedup
from stratalog.llm.mixing import mixed
from stratalog.llm.near_dedup import OP_SETTINGS, near_dedup
from stratalog.llm.neighbours import nearest
from stratalog.llm.packing import packed
from stratalog.llm.private_data import KINDS, private_data, span_text
from stratalog.llm.sharding import shard_documents
from stratalog.llm.url_filters import judge_urls, rule_table
from stratalog.llm.warc import parsed, read_archive, write_archive

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op3_warc", r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages),
bits AS (
  SELECT p.*, list_reduce(list_transform(string_split(sha1(html), ''),
      lambda c: lpad(bin(instr('0123456789abcdef', c) - 1), 4, '0')), lambda a, b: a || b) AS b FROM p)
SELECT page_id, payload_bytes,
       list_reduce(list_transform(generate_series(0, 31), lambda i: substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         16 * substr(b, i * 5 + 1, 1)::INT + 8 * substr(b, i * 5 + 2, 1)::INT
         + 4 * substr(b, i * 5 + 3, 1)::INT + 2 * substr(b, i * 5 + 4, 1)::INT
         + substr(b, i * 5 + 5, 1)::INT + 1, 1)), lambda x, y: x || y) AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM bits""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "archive")
    write_archive(table(spark, sf_dir, "pages"), path)
    return parsed(read_archive(spark, path))


#: The rules of the query: host, path, verdict.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query("op9_url_filters", r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3)
                       ELSE '' END AS rest FROM pages),
s AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS v
  FROM s JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id)
SELECT s.page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM s LEFT JOIN m ON s.page_id = m.page_id""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


@query("op2_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), OP_SETTINGS)


@query("op10_line_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "removed_lines", "text")


@query("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


@query("op6_private_data")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: ~s["disguised"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint")
              .alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts,
                        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))


@query("op7_neighbours")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def domain_labels(labels: DataFrame) -> DataFrame:
    """The domain of each labelled document: toxic, else low or good by its quality."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(
        F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain"))


#: Target weights of the domains.
WEIGHTS = {"good": 0.8, "low": 0.15, "toxic": 0.05}


@query("op8_mixing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = mixed(table(spark, sf_dir, "documents"),
                  domain_labels(table(spark, sf_dir, "labels")), WEIGHTS)
    shares = [F.get("p", F.lit(i)).alias(f"p_{name}") for i, name in enumerate(WEIGHTS)]
    return rates.select("doc_id", "tokens", *shares, "rate", "copies")


@query("op11_sharding")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


@query("op12_divergence", r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
w AS (SELECT lang, source, unnest(words) AS term FROM d),
df AS (SELECT lang, term, count(*) AS docs
       FROM (SELECT lang, unnest(list_distinct(words)) AS term FROM d) GROUP BY lang, term),
kept AS (SELECT lang, term FROM df WHERE docs >= 30),
ls AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, (SELECT count(*) FROM kept k WHERE k.lang = l.lang) AS v
      FROM (SELECT DISTINCT lang FROM ls) l),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, term, coalesce(n, 0) AS n
      FROM ls JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
gp AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5))
         // (sum(n) OVER (PARTITION BY lang, source)::HUGEINT + 5 * v) AS p
       FROM g JOIN v USING (lang)),
lt AS (SELECT lang, term, sum(n) AS n FROM g GROUP BY ALL),
lp AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5))
         // (sum(n) OVER (PARTITION BY lang)::HUGEINT + 5 * v) AS q
       FROM lt JOIN v USING (lang)),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f
        FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0)::BIGINT AS value
          FROM ls a JOIN ls b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value
          FROM gp JOIN lp USING (lang, term) WHERE n > 0 AND p > q),
every AS (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
SELECT * FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part
                                ORDER BY value DESC, item))::INTEGER AS rank FROM every)
WHERE part = 'pair' OR rank <= 50""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


@query("op13_collocations", r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece_id, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
words AS (SELECT lang, piece_id, unnest(ws) AS w1, unnest(range(len(ws))) AS i FROM (
  SELECT lang, piece_id, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'),
                                     lambda x: x <> '') AS ws FROM pieces)),
three AS (SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM words
          WINDOW p AS (PARTITION BY piece_id ORDER BY i)),
grams AS (SELECT lang, w1 AS phrase, 1 AS len FROM three
          UNION ALL SELECT lang, w1 || ' ' || w2, 2 FROM three WHERE w2 IS NOT NULL
          UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3 FROM three WHERE w3 IS NOT NULL),
f AS (SELECT lang, phrase, len, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, len, f AS a, string_split(phrase, ' ') AS words
         FROM f WHERE len >= 2 AND f >= 10),
cuts AS (
  SELECT lang, phrase, len, a, k, array_to_string(words[1:k], ' ') AS head,
         array_to_string(words[k + 1:len], ' ') AS tail
  FROM cand, (VALUES (1), (2)) AS ks(k) WHERE k < len),
scored AS (
  SELECT c.lang, c.phrase, c.len, c.a, c.k, x.f AS l, y.f AS r,
         ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head
  JOIN f y ON y.lang = c.lang AND y.phrase = c.tail),
least AS (SELECT * FROM scored
          QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, phrase, max(a) AS within FROM (
    SELECT lang, a, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase
    FROM cand WHERE len = 3) GROUP BY ALL),
kept AS (SELECT l.* FROM least l LEFT JOIN inner_ i USING (lang, phrase)
         WHERE within IS NULL OR len = 3 OR 100 * within < 50 * a)
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
         phrase, a, l, r, n, score FROM kept JOIN n USING (lang)) WHERE rank <= 2000""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
