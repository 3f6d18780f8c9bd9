"""One query per operator, over the whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import anngraph, divergence, langid, lattice, linededup, packing, quality, secrets, simhash, syncmers, tokencount, urlfilter, variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(read(spark, sf_dir, "documents"), with_ids=False))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, quality.train(docs, read(spark, sf_dir, "labels")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id", *quality.BASE, failed.alias("base_failed"), (~failed & F.col("accepted")).alias("kept")
    )


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return linededup.remove_boilerplate(docs).select("doc_id", "text", "removed_lines")


# Lines are compared trimmed; the first occurrence in the smallest doc_id stays.
ORACLES["op5_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, source, i, line, trim(translate(line, chr(9) || chr(13) || chr(11) || chr(12), '    '), ' ') AS k
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM documents)
), spread AS (
  SELECT k, min(doc_id) AS first_id FROM lines WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= 8
), kept AS (
  SELECT l.*, s.k IS NULL OR (l.doc_id = s.first_id AND row_number() OVER (PARTITION BY l.doc_id, l.k ORDER BY l.i) = 1) AS stays
  FROM lines l LEFT JOIN spread s ON l.k = s.k
), texts AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE stays), '') AS text,
         CAST(count(*) FILTER (WHERE NOT stays) AS INTEGER) AS removed_lines
  FROM kept GROUP BY doc_id
)
SELECT d.doc_id, t.text, coalesce(t.removed_lines, 0) AS removed_lines FROM documents d LEFT JOIN texts t ON d.doc_id = t.doc_id
"""


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages).select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokencount.with_token_counts(docs)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return counted.select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@query
def op6_neighbour_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anngraph.neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def encoded_and_back(texts: DataFrame, *keys: str) -> DataFrame:
    pieces = lattice.Pieces.load()
    both = lattice.decode(lattice.encode(texts, pieces), pieces)
    return both.select(*keys, "ids", F.size("ids").alias("n_ids"), (F.col("decoded") == F.col("text")).alias("round_trip"))


@query
def op8_document_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_and_back(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


@query
def op8_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_and_back(read(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "conv_id", "turn")


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents").select("lang", "source", "text"))


ORACLES["op12_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT d, lang, source, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM docs)
), kept AS (
  SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 10
), lang_sizes AS (
  SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
), counts AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL
), sizes AS (
  SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.total,
         CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(s.n, 0) + 2 * l.v) AS HUGEINT) AS p,
         CAST(1 + (1000000000::HUGEINT * (k.total + 2)) // (l.n + 2 * l.v) AS HUGEINT) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN lang_sizes l ON g.lang = l.lang
  LEFT JOIN sizes s ON g.lang = s.lang AND g.source = s.source
  LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term
), pair_sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= 10
"""


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = syncmers.edited_pairs(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return pairs.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        syncmers.written(F.col("print")).alias("fingerprint"), syncmers.written(F.col("edited_print")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )
