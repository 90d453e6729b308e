"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voltstream.llm.decontaminate import op7_decontaminate
from voltstream.llm.exact_dedup import op11_exact_dedup
from voltstream.llm.language import op5_language
from voltstream.llm.merkle import op13_merkle_manifest
from voltstream.llm.mix import op6_mix_sources
from voltstream.llm.projection_forest import op4_embedding_neighbours
from voltstream.llm.quality import op2_quality
from voltstream.llm.simhash import op9_simhash
from voltstream.llm.suffix_dedup import op10_suffix_dedup
from voltstream.llm.token_counts import op1_token_counts
from voltstream.llm.token_files import op3_token_files
from voltstream.llm.toxicity import op8_toxicity
from voltstream.llm.whitening import op12_whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_quality": op2_quality,
        "op3_token_files": op3_token_files,
        "op4_embedding_neighbours": op4_embedding_neighbours,
        "op5_language": op5_language,
        "op6_mix_sources": op6_mix_sources,
        "op7_decontaminate": op7_decontaminate,
        "op8_toxicity": op8_toxicity,
        "op9_simhash": op9_simhash,
        "op10_suffix_dedup": op10_suffix_dedup,
        "op11_exact_dedup": op11_exact_dedup,
        "op12_whitening": op12_whitening,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


_OP4 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x <> 0)) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x
),
n AS (SELECT x, COUNT(*) AS n_links FROM link GROUP BY x),
c AS (SELECT x, MIN(y) AS component_id FROM reach GROUP BY x)
SELECT vec_id, COALESCE(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN n ON n.x = vec_id JOIN c ON c.x = vec_id"""

_OP10 = """
WITH d AS (SELECT doc_id, hex(encode(COALESCE(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) AS s FROM d, range(0, CAST(length(h) // 2 - 99 AS BIGINT)) AS r(i)),
gone AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM w) WHERE n > 1),
run AS (
  SELECT doc_id, i, SUM(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM gone)
),
span AS (SELECT doc_id, MIN(i) AS b, MAX(i) + 100 AS e FROM run GROUP BY doc_id, run),
gap AS (SELECT doc_id, b, e, COALESCE(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS from_ FROM span),
cut AS (
  SELECT doc_id, COUNT(*) AS n_spans, SUM(e - b) AS n_removed, MAX(e) AS last,
         string_agg(substr(h, 2 * from_ + 1, 2 * (b - from_)), '' ORDER BY b) AS kept
  FROM gap JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, COALESCE(n_spans, 0) AS n_spans,
       sha256(unhex(COALESCE(kept, '') || substr(h, 2 * COALESCE(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)"""

_OP11 = """
SELECT doc_id, MAX(doc_id) OVER g AS keep_id, COUNT(*) OVER g AS group_size, doc_id = MAX(doc_id) OVER g AS kept, sha256(COALESCE(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY COALESCE(text, ''))"""

# CRC-32 by its bitwise definition, as DuckDB has no such function
_OP13 = """
WITH RECURSIVE base AS (
  SELECT doc_id, lang, n_chars,
         COALESCE(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || COALESCE(strlen(source) || ':' || source, '-') || COALESCE(strlen(lang) || ':' || lang, '-') AS head,
         COALESCE(strlen(text) || ':' || text, '-') AS tail,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda crc, c: list_reduce(list_prepend(xor(crc, c), list_transform(range(8), lambda k: CAST(0 AS BIGINT))), lambda v, k: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) AS crc
  FROM documents
),
leaf AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, COUNT(*) OVER (PARTITION BY lang) AS n,
         sha256(head || COALESCE(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || COALESCE(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) AS changed, crc % 7 = 0 AS tampered
  FROM base
),
up AS (
  SELECT lang, pos, n, 0 AS level, leaf AS h FROM leaf
  UNION ALL SELECT lang, pos // 2, (n + 1) // 2, level + 1, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY lang, pos // 2, n, level
),
subroot AS (SELECT lang, h AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, COUNT(*) OVER () AS langs FROM up WHERE n = 1),
top AS (
  SELECT place AS pos, langs AS n, 0 AS level, subroot AS h FROM subroot
  UNION ALL SELECT pos // 2, (n + 1) // 2, level + 1, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY pos // 2, n, level
),
root AS (SELECT h AS root, level AS high FROM top WHERE n = 1),
place AS (SELECT leaf.*, height, high, place, subroot, root FROM leaf JOIN subroot ON subroot.lang IS NOT DISTINCT FROM leaf.lang CROSS JOIN root),
way AS (
  SELECT doc_id, lang, level, pos >> level AS p FROM (SELECT doc_id, lang, pos, UNNEST(range(height)) AS level FROM place)
),
way_top AS (
  SELECT doc_id, height + level AS level, level AS k, place >> level AS p FROM (SELECT doc_id, height, place, UNNEST(range(high)) AS level FROM place)
),
side AS (
  SELECT doc_id, way.level, p % 2 AS slot, h AS sibling FROM way LEFT JOIN up ON up.lang IS NOT DISTINCT FROM way.lang AND up.level = way.level AND up.pos = xor(p, 1)
  UNION ALL SELECT doc_id, way_top.level, p % 2, h FROM way_top LEFT JOIN top ON top.level = k AND top.pos = xor(p, 1)
),
proof AS (SELECT doc_id, sha256(COALESCE(string_agg(sibling, '' ORDER BY level), '')) AS proof_sha256 FROM side GROUP BY doc_id),
fold AS (
  SELECT doc_id, 0 AS level, CASE WHEN tampered THEN changed ELSE leaf END AS h FROM leaf
  UNION ALL SELECT fold.doc_id, fold.level + 1, sha256(CASE WHEN slot = 1 THEN sibling || h ELSE h || COALESCE(sibling, '') END) FROM fold JOIN side ON side.doc_id = fold.doc_id AND side.level = fold.level
)
SELECT place.doc_id, leaf, subroot, root, COALESCE(proof_sha256, sha256('')) AS proof_sha256, fold.h AS folded_root, fold.h = root AS verified
FROM place JOIN fold ON fold.doc_id = place.doc_id AND fold.level = height + high LEFT JOIN proof ON proof.doc_id = place.doc_id"""


def oracle_sql() -> dict[str, str]:
    """The others use tokenizers, trained models or XXH64, which SQL has not; tests hold them against brute force."""
    return {"op4_embedding_neighbours": _OP4, "op10_suffix_dedup": _OP10, "op11_exact_dedup": _OP11, "op13_merkle_manifest": _OP13}
