"""The operators as queries over the given tables, and the SQL that checks them."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlode.llm import secret_scan
from shiftlode.llm.blocks import nearest
from shiftlode.llm.bpe import bpe_digest
from shiftlode.llm.collocations import collocations
from shiftlode.llm.common import table
from shiftlode.llm.entropy import mix
from shiftlode.llm.evidence import identify, page_evidence
from shiftlode.llm.forest import fit as fit_forest
from shiftlode.llm.forest import judge
from shiftlode.llm.masked import pseudo_likelihood
from shiftlode.llm.merkle import audit, row_id, shard_records, write_replicas
from shiftlode.llm.paths import classes
from shiftlode.llm.pfor import blocks_round_trip
from shiftlode.llm.resample import resample
from shiftlode.llm.template import extract
from shiftlode.session import new_path

END_ID = 2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@query
def op1_bpe_transducer(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digest(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_merkle_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """Two replicas of all pages, the second with one byte changed in every 97th page, and their audit."""
    records = shard_records(table(spark, folder, "pages"))
    changed = F.regexp_replace("record", r"^(?s)(.*?\r\n\r\n)<", "$1?")
    damaged = F.when(F.col("_order") % 97 == 3, changed).otherwise(F.col("record"))
    folders = write_replicas(records, new_path(spark, "warc"), {"a": F.col("record"), "b": damaged})
    found = audit(spark, *folders)
    return found.select(row_id("record").alias("page_id"), "status")


ORACLES["op2_merkle_fixity"] = """
    SELECT page_id, CASE WHEN page_id % 97 = 3 AND html LIKE '<%' THEN 'damaged in b' ELSE 'same' END AS status FROM pages"""


@query
def op3_chosen_path_join(spark: SparkSession, folder: str) -> DataFrame:
    return classes(table(spark, folder, "documents"))


# Hashes of shingles would be shorter, but lists of words need no proof.
ORACLES["op3_chosen_path_join"] = r"""
    WITH RECURSIVE
    words AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^ \t\n\x0B\x0C\r]+') AS w FROM documents),
    grams AS (SELECT doc_id, w, list_distinct(list_transform(range(1, GREATEST(len(w) - 4, 1) + 1),
                     lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM words WHERE len(w) > 0),
    tokens AS (SELECT doc_id, len(g) AS n, unnest(g) AS t FROM grams),
    pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
              GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING COUNT(*) >= 0.8 * (a.n + b.n - COUNT(*)) - 1e-9),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
    class AS (SELECT a AS doc_id, MIN(b) AS class_id FROM reach GROUP BY a),
    links AS (SELECT p.a AS doc_id, COUNT(DISTINCT d.text) FILTER (WHERE d.text <> s.text) AS n
              FROM pairs p JOIN documents d ON d.doc_id = p.b JOIN documents s ON s.doc_id = p.a GROUP BY p.a)
    SELECT c.doc_id, c.class_id, COALESCE(l.n, 0) AS n_links FROM class c LEFT JOIN links l ON l.doc_id = c.doc_id"""


@query
def op4_site_templates(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))


@query
def op5_masked_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo_likelihood(table(spark, folder, "documents"))


@query
def op6_isolation_forest(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    judged = judge(documents, fit_forest(documents, table(spark, folder, "labels")))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(*base, *[name for name in judged.columns if name not in base])


@query
def op7_language_evidence(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by their text, ``lang`` and source, and pages by their text, markup language, host and address suffix."""
    documents = identify(table(spark, folder, "documents"))
    pages = identify(page_evidence(table(spark, folder, "pages")), "page_id", "text", "declared", "host", "suffix")
    return documents.unionByName(pages, allowMissingColumns=True)


@query
def op8_token_blocks(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return blocks_round_trip(table(spark, folder, "documents"), path, END_ID)


@query
def op9_block_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLES["op9_block_nearest"] = """
    WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
         pairs AS (SELECT q.vec_id AS query_id, c.vec_id,
                          list_inner_product(q.v, c.v)
                            / (sqrt(list_inner_product(q.v, q.v)) * sqrt(list_inner_product(c.v, c.v))) AS score
                   FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
         ranked AS (SELECT query_id, vec_id, score,
                           CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
                    FROM pairs)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query
def op10_entropy_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"))


@query
def op11_rollup_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


ORACLES["op11_rollup_phrases"] = r"""
    WITH pieces AS (SELECT COALESCE(lang, 'und') AS lang,
                           unnest(regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
         words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
         total AS (SELECT lang, SUM(len(w)) AS n FROM words GROUP BY lang),
         found AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS p
                   FROM words, range(1, 6) AS sizes(k) WHERE len(w) >= k),
         f AS (SELECT lang, p, len(p) AS k, COUNT(*) AS f FROM found GROUP BY lang, p HAVING COUNT(*) >= 100),
         cuts AS (SELECT c.lang, c.p, c.f AS a, cut, l.f AS l, r.f AS r, n,
                         CAST(1000 * CAST(c.f AS HUGEINT) * CAST(n AS HUGEINT) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
                  FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k > 1) c
                  JOIN total USING (lang)
                  JOIN f l ON l.lang = c.lang AND l.p = c.p[1:cut] JOIN f r ON r.lang = c.lang AND r.p = c.p[cut + 1:]),
         lowest AS (SELECT * FROM cuts QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
         inner_phrases AS (SELECT lang, f, k, unnest(range(1, k)) AS first, p FROM f WHERE k > 2),
         spans AS (SELECT lang, f, k, first, unnest(range(first + 1, k + 1)) AS last, p FROM inner_phrases),
         longer AS (SELECT lang, p[first:last] AS p, MAX(f) AS f FROM spans WHERE last - first + 1 < k GROUP BY ALL),
         kept AS (SELECT c.* FROM lowest c LEFT JOIN longer USING (lang, p) WHERE longer.f IS NULL OR 100 * longer.f < 100 * a),
         ranked AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM kept)
    SELECT lang, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
    FROM ranked QUALIFY rank <= 2000"""


@query
def op12_importance_draw(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


# CRC-32 by its table of 256 steps: the rest of a byte after eight shifts by the polynomial 0xEDB88320.
ORACLES["op12_importance_draw"] = r"""
    WITH RECURSIVE
    texts AS (SELECT 's' AS kind, doc_id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark),
    words AS (SELECT ROW_NUMBER() OVER () AS row, kind, doc_id,
                     regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
    features AS (SELECT row, kind, unnest(w) AS f FROM words
                 UNION ALL SELECT row, kind, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
    names AS (SELECT DISTINCT f FROM features),
    steps AS (SELECT i AS first, i AS rest, 0 AS shift FROM range(256) AS r(i)
              UNION ALL SELECT first, xor(rest >> 1, CASE WHEN rest & 1 = 1 THEN 3988292384 ELSE 0 END), shift + 1 FROM steps WHERE shift < 8),
    lookup AS (SELECT list(CAST(rest AS BIGINT) ORDER BY first) AS t FROM steps WHERE shift = 8),
    bytes AS (SELECT f, list_transform(range(1, octet_length(encode(f)) + 1),
                     lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i - 1, 2) AS BIGINT)) AS b FROM names),
    checked AS (SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b),
                       lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, lookup),
    placed AS (SELECT row, kind, bucket FROM features JOIN checked USING (f)),
    counts AS (SELECT bucket, COUNT(*) FILTER (WHERE kind = 's') AS s, COUNT(*) FILTER (WHERE kind = 't') AS t FROM placed GROUP BY bucket),
    sums AS (SELECT COALESCE(SUM(s), 0) + 10000 AS s_all, COALESCE(SUM(t), 0) + 10000 AS t_all FROM counts),
    gains AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * s_all AS DOUBLE) / CAST((s + 1) * t_all AS DOUBLE))) AS BIGINT) AS gain
              FROM counts, sums),
    weights AS (SELECT row, COUNT(*) AS n_features, CAST(SUM(gain) AS BIGINT) AS total FROM placed JOIN gains USING (bucket)
                WHERE kind = 's' GROUP BY row),
    scores AS (SELECT doc_id, len(w) AS n_words, COALESCE(n_features, 0) AS n_features,
                      CASE WHEN n_features > 0 THEN CAST(floor(total / n_features) AS BIGINT) ELSE 0 END AS weight,
                      CAST('0x' || substr(sha256('7:' || COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
               FROM words LEFT JOIN weights USING (row) WHERE kind = 's'),
    noisy AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM scores),
    ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
                      COUNT(*) OVER (PARTITION BY n_words >= 20) AS n FROM noisy)
    SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank, n_words FROM ranked"""


@query
def op13_secret_network(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return secret_scan.digest(secret_scan.scan(documents, secret_scan.fit(documents)))
