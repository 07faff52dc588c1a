"""The registered queries of this subpackage, with the parameters they run with, and their SQL twins."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger.llm import centroids, embeddings, hmm, html, mixing, phrases, pieces, quality, simhash, substrings, topk, toxicity, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken, and the rate and copies behind it, of every document."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), keep=["doc_id"], weights=(3, 1, 2), share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "rate", "copies")


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"), window=35)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the base counts, base_failed, kept of every document."""
    return quality.judge(_table(spark, sf_dir, "documents"))


def piece_model() -> str:
    """The public SentencePiece model on this machine (the environment variable PIECE_MODEL names another)."""
    named = os.environ.get("PIECE_MODEL")
    return named or "/opt/tokenizers/piece_bpe_32k.model"


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_pieces, score, nbest_scores (3), decoded_ok of every document."""
    return pieces.encode(_table(spark, sf_dir, "documents"), piece_model(), nbest=3)


#: (verdict, host and beginning of the path) of op6.
URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]

OP6_SQL = r"""
WITH rules(rule, verdict, rh, rp) AS (VALUES ('com/en/', 'block', 'com', '/en/'), ('example.com/en/7', 'allow', 'example.com', '/en/7'),
  ('net/de/', 'allow', 'net', '/de/'), ('example.net/de/8', 'block', 'example.net', '/de/8'), ('org/es/', 'block', 'org', '/es/')),
p AS (SELECT page_id, url,
  coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
best AS (SELECT url, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT url, host, path FROM p) q JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY url)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM p LEFT JOIN best USING (url)
"""


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    judged = urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), urls.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    return hmm.score_documents(_table(spark, sf_dir, "documents"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return html.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


OP11_SQL = r"""
WITH pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM (SELECT coalesce(lang, 'und') AS lang,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS ph, count(*) AS a
  FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w) x, (VALUES (1), (2), (3), (4), (5)) ks(k) WHERE i + k - 1 <= len(ws) GROUP BY ALL),
n AS (SELECT lang, sum(a) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, ph, a, string_split(ph, ' ') AS ws FROM g WHERE k > 1 AND a >= 100),
cuts AS (SELECT c.lang, c.ph, c.a, j, f.a AS l, s.a AS r, n.n, cast((1000::hugeint * c.a * n.n) // (f.a::hugeint * s.a) AS bigint) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c JOIN n USING (lang)
  JOIN g f ON f.lang = c.lang AND f.ph = array_to_string(c.ws[1:j], ' ') JOIN g s ON s.lang = c.lang AND s.ph = array_to_string(c.ws[j + 1:c.k], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, j) = 1),
inside AS (SELECT lang, array_to_string(ws[i:i + size - 1], ' ') AS ph, max(a) AS b
  FROM (SELECT *, unnest(range(1, k - size + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS size FROM c WHERE k > 2)) GROUP BY ALL),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(ph)) AS rank, ph AS phrase, a, l, r, n, score
  FROM best LEFT JOIN inside USING (lang, ph) WHERE b IS NULL OR 100 * b < 100 * a)
SELECT lang, rank, phrase, a, l, r, cast(n AS bigint) AS n, score FROM ranked WHERE rank <= 2000
"""


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the 2000 best phrases of each language."""
    return phrases.best_phrases(_table(spark, sf_dir, "documents"), most=2000, longest=5, least=100, share=100)


def _op12_sql() -> str:
    """Each round's assignment and means as common tables."""
    distance = "list_sum(list_transform(range(1, 65), lambda i: (k.g[i] - c.g[i]) * (k.g[i] - c.g[i])))"
    steps = [
        "k AS (SELECT vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x AS double)) AS bigint)) AS g FROM embeddings"
        " WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)",
        "c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS j, g FROM (SELECT sha256('2:' || vec_id) AS h, g FROM k ORDER BY h LIMIT 40))",
    ]
    for n in range(6):
        steps.append(f"a{n} AS MATERIALIZED (SELECT vec_id, g, unnest(arg_min(struct_pack(cluster := j, distance := d), (d, j)), recursive := true) FROM (SELECT k.vec_id, k.g, c.j, {distance} AS d FROM k, c{n} c) GROUP BY vec_id, g)")
        if n < 5:
            means = f"SELECT cluster AS j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS g FROM (SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(g) AS x, unnest(range(64)) AS i FROM a{n}) GROUP BY cluster, i) GROUP BY cluster"
            steps.append(f"c{n + 1} AS MATERIALIZED (SELECT j, coalesce(m.g, c.g) AS g FROM c{n} c LEFT JOIN ({means}) m USING (j))")
    return (
        "WITH " + ", ".join(steps) + " SELECT vec_id, cast(cluster AS integer) AS cluster, cast(distance AS bigint) AS distance, cast(sum(distance) OVER (PARTITION BY cluster) AS bigint) AS cluster_inertia,"
        " cast(sum(distance) OVER () AS bigint) AS inertia, sha256(array_to_string(list_transform(c5.g, lambda x: cast(x AS varchar)), ',')) AS centroid_sha256 FROM a5 JOIN c5 ON j = cluster"
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector of 64 components."""
    return centroids.cluster(_table(spark, sf_dir, "embeddings"), dim=64, k=40, rounds=5, scale=256)


OP13_SQL = """
WITH g AS (SELECT row_number() OVER () AS u, vec_id, list_transform(embedding, lambda x: floor(256 * cast(x AS double))) AS g FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.u, q.vec_id AS query_id, c.vec_id, cast(coalesce(list_inner_product(q.g, c.g), 0) AS bigint) AS score FROM g q JOIN g c ON len(q.g) = len(c.g) AND q.u <> c.u WHERE q.vec_id % 50 = 0)
SELECT query_id, cast(row_number() OVER (PARTITION BY u ORDER BY score DESC, vec_id NULLS LAST) AS integer) AS rank, vec_id, score FROM s QUALIFY rank <= 5
"""


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 5 rows of greatest integer product with each row whose id is divisible by 50."""
    return topk.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over the whole table of documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": pipeline, "op1_simhash": op1_simhash, "op2_mixing": op2_mixing, "op3_substrings": op3_substrings, "op4_quality": op4_quality, "op5_pieces": op5_pieces, "op6_url_rules": op6_url_rules, "op7_toxicity": op7_toxicity, "op8_hmm": op8_hmm, "op9_embeddings": op9_embeddings, "op10_main_text": op10_main_text, "op11_phrases": op11_phrases, "op12_centroids": op12_centroids, "op13_topk": op13_topk}


def oracle_sql() -> dict[str, str]:
    return {"op6_url_rules": OP6_SQL, "op11_phrases": OP11_SQL, "op12_centroids": _op12_sql(), "op13_topk": OP13_SQL}
