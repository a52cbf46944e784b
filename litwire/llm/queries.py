"""The dealt operators over the given tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litwire.llm import jaccard, langid, licenses, lines, lm, mixing, pieces, pii, quality, resample, shards, topk, trie


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_quality_rules(spark, sf):
    rated = quality.apply_rules(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return rated.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op2_lm_scoring(spark, sf):
    return lm.pseudo_likelihood(table(spark, sf, "documents"))


def op3_ngram_jaccard(spark, sf):
    found = jaccard.jaccard_components(table(spark, sf, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op4_language_id(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    rows = langid.train_and_identify(docs)
    return rows.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op5_personal_data(spark, sf):
    found = pii.find_personal_data(table(spark, sf, "documents"))

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in pii.BASE]
    base = F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, pii.span_text(F.concat("base", "added")).alias("spans"))


def label_domains(labels: DataFrame) -> DataFrame:
    """doc_id, domain of labelled documents: toxic, else good or poor by quality."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", domain.alias("domain"))


#: Shares of tokens that the mixture is to have.
TARGETS = {"good": 0.97, "poor": 0.02, "toxic": 0.01}


def op6_source_mixing(spark, sf):
    labelled = label_domains(table(spark, sf, "labels"))
    return mixing.document_rates(table(spark, sf, "documents"), labelled, TARGETS)


def op7_exact_topk(spark, sf):
    return topk.top_inner_products(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


#: A vocabulary file of a public tokenizer; never part of this repository.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op8_sentencepiece(spark, sf, model: str = PIECE_MODEL):
    rows = pieces.encode_and_decode(table(spark, sf, "documents").select("doc_id", "text"), model)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    digest = F.sha2(F.array_join(F.col("piece_ids").cast("array<string>"), " "), 256)
    return rows.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), digest.alias("ids_sha256"), same.alias("round_trip"))


def op10_license_scan(spark, sf):
    return licenses.scan_licenses(table(spark, sf, "documents"))


def op9_line_dedup(spark, sf):
    kept = lines.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_conversation_trie(spark, sf):
    conv = F.col("conv_id")
    ordered = trie.ordered_turns(table(spark, sf, "conversations"))
    found = trie.prefix_trie(trie.with_openings(ordered, conv - conv % 5, F.crc32(conv.cast("string")) % 9))
    rows = found.nodes.join(trie.end_digests(found.ends), trie.KEY, "left")
    ends = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    counts = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    return rows.select("conv_id", "depth", "parent_conv_id", *counts, ends)


def op12_sharding(spark, sf):
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf, "documents").select("doc_id", text.alias("text"))
    size = (F.octet_length("text") + 1).cast("long")
    rows = docs.select("doc_id", F.sha2("text", 256).alias("copies"), size.alias("size"), F.crc32("text").alias("text_crc32"))
    dealt = shards.shard_rows(rows, [F.col("copies")], F.col("size"), shards=16)
    grown = F.lit(None).cast("int").alias("grown_shard")
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", grown)


def op13_importance_resampling(spark, sf):
    return resample.importance_draw(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


OP3_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
  FROM words WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.r = links.x
)
SELECT d.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(r) AS component_id
FROM documents d JOIN reach ON reach.doc_id = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id GROUP BY d.doc_id
"""

OP7_SQL = r"""
WITH v AS (
  SELECT DISTINCT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum([a.q[i] * b.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

OP9_SQL = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), lines AS (
  SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), shared AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT doc_id, i, line, first IS NOT NULL AND doc_id <> first AS gone FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


#: CRC-32 of a list of bytes, by its table.
CRC_SQL = """
crc_table AS (
  SELECT [list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n) FOR n IN range(256)] AS t
)"""


def crc_sql(text: str) -> str:
    """CRC-32 of a text expression; crc_table has to be joined."""
    digits = f"hex(encode({text}))"
    parts = f"[CAST('0x' || substr({digits}, 2 * i + 1, 2) AS BIGINT) FOR i IN range(length({digits}) // 2)]"
    return f"xor(4294967295, list_reduce({parts}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295))"


OP11_SQL = f"""
WITH {CRC_SQL}, turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, strlen(coalesce(text, '')) AS n_bytes
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, {crc_sql("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc_table
), rebuilt AS (
  SELECT c.conv_id, t.pos AS place, digest, n_bytes FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, t.pos, digest, n_bytes FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), chained AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(digest, ',') OVER w AS path, n_bytes,
    count(*) OVER (PARTITION BY conv_id) AS length
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY place)
), members AS (
  SELECT * FROM chained
  UNION ALL
  SELECT c.conv_id, 0, '', 0, coalesce(any_value(length), 0) FROM convs c LEFT JOIN chained USING (conv_id) GROUP BY c.conv_id
), nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n_bytes) AS n_bytes,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = length), '') AS ends
  FROM members GROUP BY depth, path
), kin AS (
  SELECT c.depth, c.path, p.conv_id AS parent_conv_id, p.path AS parent_path
  FROM nodes c JOIN nodes p ON p.depth = c.depth - 1 AND p.path = CASE WHEN c.depth = 1 THEN '' ELSE substr(c.path, 1, length(c.path) - 65) END
), children AS (
  SELECT depth - 1 AS depth, parent_path AS path, count(*) AS n_children FROM kin GROUP BY ALL
), ancestry AS (
  -- a node lies in the subtree of every prefix of its smallest member
  SELECT a.depth, a.path, n.n_bytes * (n.n_convs - 1) AS saved, CASE WHEN c.n_children IS NULL THEN 1 ELSE 0 END AS leaf
  FROM nodes n JOIN members a ON a.conv_id = n.conv_id AND a.depth <= n.depth LEFT JOIN children c ON c.depth = n.depth AND c.path = n.path
), sums AS (
  SELECT depth, path, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves FROM ancestry GROUP BY ALL
)
SELECT n.conv_id, n.depth, k.parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n LEFT JOIN kin k ON k.depth = n.depth AND k.path = n.path LEFT JOIN children c ON c.depth = n.depth AND c.path = n.path
JOIN sums s ON s.depth = n.depth AND s.path = n.path
"""


OP13_SQL = f"""
WITH {CRC_SQL}, texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS row, doc_id, text FROM documents
  UNION ALL
  SELECT 'b', row_number() OVER (), NULL, text FROM benchmark
), words AS (
  SELECT kind, row, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM texts
), places AS (
  SELECT kind, row, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
  SELECT kind, row, w[i] AS g FROM places
  UNION ALL
  SELECT kind, row, w[i] || ' ' || w[i + 1] FROM places WHERE i < len(w)
  UNION ALL
  SELECT kind, row, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM places WHERE i + 1 < len(w)
), counted AS (
  SELECT kind, row, g, count(*) AS n FROM grams GROUP BY ALL
), hashed AS (
  SELECT g, {crc_sql("g")} % 10000 AS bucket FROM (SELECT DISTINCT g FROM counted), crc_table
), held AS (
  SELECT kind, row, bucket, CAST(sum(n) AS BIGINT) AS n FROM counted JOIN hashed USING (g) GROUP BY ALL
), sums AS (
  SELECT coalesce(sum(n) FILTER (kind = 'd'), 0) AS s_all, coalesce(sum(n) FILTER (kind = 'b'), 0) AS t_all FROM held
), gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(sum(n) FILTER (kind = 'b'), 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE
    / ((coalesce(sum(n) FILTER (kind = 'd'), 0) + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
  FROM held, sums GROUP BY bucket, s_all, t_all
), weights AS (
  SELECT row, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
  FROM held JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY row
), scored AS (
  SELECT doc_id, row, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (row) WHERE kind = 'd'
), ranked AS (
  SELECT row, row_number() OVER (ORDER BY score DESC, doc_id, row) AS r, count(*) OVER () AS n FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 5 * n // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (row)
"""


def llm_queries() -> dict:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_lm_scoring": op2_lm_scoring,
        "op3_ngram_jaccard": op3_ngram_jaccard,
        "op4_language_id": op4_language_id,
        "op5_personal_data": op5_personal_data,
        "op6_source_mixing": op6_source_mixing,
        "op7_exact_topk": op7_exact_topk,
        "op8_sentencepiece": op8_sentencepiece,
        "op10_license_scan": op10_license_scan,
        "op9_line_dedup": op9_line_dedup,
        "op11_conversation_trie": op11_conversation_trie,
        "op12_sharding": op12_sharding,
        "op13_importance_resampling": op13_importance_resampling,
    }


def llm_oracles() -> dict[str, str]:
    return {"op3_ngram_jaccard": OP3_SQL, "op7_exact_topk": OP7_SQL, "op9_line_dedup": OP9_SQL, "op11_conversation_trie": OP11_SQL, "op13_importance_resampling": OP13_SQL}
