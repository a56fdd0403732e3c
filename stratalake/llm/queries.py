"""The registered queries of this package: each applies one operator to whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import scratch_path

from . import centroids, language, licenses, neighbours, ngram_join, packing, pieces, prefix_trie, quality_model, repeats, sharding, similar_vectors, token_file
from .store import reachable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: What SQL can say. Tokens, compression and sampled boundaries are tested against brute force; a search that may miss
#: neighbours has a recall.
ORACLE: dict[str, str] = {
    "op3_repeated_phrases": r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
p AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS pos FROM w),
win AS (SELECT doc_id, pos, CASE WHEN pos + 49 <= len(words) THEN array_to_string(words[pos:pos + 49], ' ') END AS win, words[pos] AS word FROM p),
own AS (SELECT win, min(doc_id) AS owner FROM win WHERE win IS NOT NULL GROUP BY win),
hit AS (SELECT a.doc_id, a.pos, a.word, CASE WHEN own.owner < a.doc_id THEN 1 ELSE 0 END AS hit FROM win a LEFT JOIN own ON a.win = own.win),
cov AS (SELECT doc_id, pos, word, max(hit) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM hit),
done AS (SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (gone = 0) AS kept FROM cov GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN done USING (doc_id)""",
    "op8_rotated_codes": r"""WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (SELECT DISTINCT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id < b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n FROM edges GROUP BY x)
SELECT t.vec_id, coalesce(n.n, 0) AS n_links, least(t.vec_id, coalesce(low.y, t.vec_id)) AS component_id,
       t.vec_id = least(t.vec_id, coalesce(low.y, t.vec_id)) AS kept
FROM (SELECT DISTINCT vec_id FROM embeddings) t LEFT JOIN n ON n.x = t.vec_id LEFT JOIN low ON low.x = t.vec_id""",
    "op9_ngram_jaccard": r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[pos:pos + 4], ' ') AS gram
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS pos FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * shared >= 75 * (p.size + q.size - shared)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(size, 0) AS n_shingles, least(d.doc_id, coalesce(low.y, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.x = d.doc_id""",
}


def _clusters_sql(k: int = 16, rounds: int = 3) -> str:
    """The clustering query unrolled: one pair of steps a round."""
    steps = [
        r"""v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)""",
        f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), q) - 1 AS c, q FROM v ORDER BY sha256('1:' || vec_id), q LIMIT {k})",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, best % {k} AS cluster, best // {k} AS distance FROM (
      SELECT r, min(CAST(list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * {k} + c) AS best FROM v, c{i} c GROUP BY r))""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.q, c.q) AS q FROM c{i} c LEFT JOIN (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS q FROM (
      SELECT cluster, pos, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(q) AS x, unnest(range(1, 65)) AS pos FROM a{i} JOIN v USING (r)) GROUP BY cluster, pos) GROUP BY cluster) m ON m.cluster = c.c)""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.q, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} ON c{rounds}.c = cluster"""


ORACLE["op11_simplex_clusters"] = _clusters_sql()

ORACLE["op13_prefix_trie"] = r"""WITH RECURSIVE
src AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos,
        coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
len AS (SELECT c, count(*) AS n FROM src GROUP BY c),
crc(c, s, i, v) AS (SELECT c, CAST(c AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM len
  UNION ALL SELECT c, s, i + 1, CASE WHEN (u & 1) = 1 THEN xor(u >> 1, CAST(3988292384 AS BIGINT)) ELSE u >> 1 END
  FROM (SELECT c, s, i, CASE WHEN i % 8 = 0 THEN xor(v, CAST(ascii(s[i // 8 + 1]) AS BIGINT)) ELSE v END AS u FROM crc WHERE i < 8 * length(s))),
head AS (SELECT c, xor(v, CAST(4294967295 AS BIGINT)) % 9 AS h FROM crc WHERE i = 8 * length(s)),
conv AS (SELECT len.c AS c, h, len.c - len.c % 5 AS base, least(h, coalesce(b.n, 0)) AS kept FROM len JOIN head ON head.c = len.c LEFT JOIN len b ON b.c = len.c - len.c % 5),
turns AS (SELECT conv.c AS c, s.pos AS d, s.role, s.text FROM conv JOIN src s ON s.c = base AND s.pos <= kept
  UNION ALL SELECT conv.c, s.pos - h + kept, s.role, s.text FROM conv JOIN src s ON s.c = conv.c AND s.pos > h),
path AS (SELECT c, d, string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY d) AS p, octet_length(encode(text)) AS size FROM turns
  UNION ALL SELECT c, 0, '', 0 FROM conv),
node AS (SELECT p, d, min(c) AS conv, count(*) AS n, max(size) AS size FROM path GROUP BY p, d),
last AS (SELECT c, max(d) AS d FROM path GROUP BY c),
ends AS (SELECT p, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS e FROM path JOIN last USING (c, d) GROUP BY p),
link AS (SELECT node.p, node.d, node.conv, n, node.size, u.p AS up FROM node LEFT JOIN path u ON u.c = node.conv AND u.d = node.d - 1),
kids AS (SELECT up AS p, count(*) AS k FROM link WHERE up IS NOT NULL GROUP BY up),
sub AS (SELECT a.p, sum((n - 1) * v.size) AS saved, count(*) FILTER (WHERE k IS NULL) AS leaves
  FROM link v LEFT JOIN kids ON kids.p = v.p JOIN path a ON a.c = v.conv AND a.d <= v.d GROUP BY a.p)
SELECT link.conv AS conv_id, link.d AS depth, parent.conv AS parent_conv_id, link.n AS n_convs, coalesce(k, 0) AS n_children, leaves AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, coalesce(e, sha256('')) AS ends_sha256
FROM link LEFT JOIN node parent ON parent.p = link.up LEFT JOIN kids ON kids.p = link.p JOIN sub ON sub.p = link.p LEFT JOIN ends ON ends.p = link.p"""


def query(fn):
    """Register a query; its SQL, where there is one, is that of the same name in ``ORACLE``."""

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reachable(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-file")
    token_file.write(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return token_file.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op2_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.search(rows, rows.where("vec_id % 20 = 0"), k=20)


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = pieces.encode(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.array_max("ends"), F.lit(0)).cast("long").alias("n_bytes"),
    )


@query
def op7_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "text", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharding.shard(docs, 16, F.col("size"), F.xxhash64("text"), F.col("doc_id"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors.near_duplicates(table(spark, sf_dir, "embeddings"), 0.9)


@query
def op10_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = language.classify(docs, language.fit(docs), carry=["doc_id"])
    return judged.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "second", "rejected")


@query
def op3_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.find(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op11_simplex_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@query
def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = quality_model.train(docs, table(spark, sf_dir, "labels").where(~language.held_out()))
    scored = quality_model.score(docs, weights, carry=["doc_id"])
    return scored.select("doc_id", language.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefixes(table(spark, sf_dir, "conversations"))
