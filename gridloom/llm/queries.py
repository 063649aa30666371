"""The registered queries of the training-data operators, one per operator, over whole tables.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``ORACLE_SQL`` has
DuckDB SQL with the same rows where SQL can express the operator.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontamination import contained_items
from .fingerprint import edited_fingerprints
from .language_id import identify
from .license_scan import scan_licenses
from .merkle import manifest
from .mixing import mix
from .ngram_join import near_duplicates
from .packing import pack_documents
from .prefix_trie import trie
from .quality import quality
from .substring_dedup import remove_repeated
from .token_counts import LIMIT, token_counts
from .toxicity import toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("_id").alias("doc_id"), "n_shingles", "component_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(_table(spark, sf_dir, "conversations"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).drop("repeats", "cut")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    every_fifth = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return manifest(_table(spark, sf_dir, "documents"), tampered=every_fifth).drop("source")


#: DuckDB has no crc32: the reflected polynomial, bit by bit over the bytes of a decimal number.
CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST({} AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _field(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_license_scan": op3_license_scan,
    "op4_fingerprint": op4_fingerprint,
    "op5_packing": op5_packing,
    "op6_language_id": op6_language_id,
    "op7_ngram_join": op7_ngram_join,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_mixing": op12_mixing,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL = {
    "op1_substring_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35),
        hashed AS (SELECT r, i, sha256(array_to_string(w[i:i + 34], ' ')) AS h FROM win),
        hit AS (SELECT r, i FROM hashed JOIN (SELECT h FROM hashed GROUP BY h HAVING count(*) > 1) USING (h)),
        gone AS (SELECT DISTINCT r, i + k AS p FROM hit, range(35) AS t(k)),
        word AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
        kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (r, p) GROUP BY r),
        lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r) LEFT JOIN lost USING (r)""",
    "op7_ngram_join": r"""
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        cut AS (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0),
        sh AS (SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS s FROM cut),
        n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
        common AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.r <> b.r GROUP BY ALL),
        link AS (SELECT x, y FROM common JOIN n p ON p.r = x JOIN n q ON q.r = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
        reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x)
        SELECT a.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(b.doc_id) AS component_id
        FROM reach JOIN d a ON a.r = reach.x JOIN d b ON b.r = reach.y LEFT JOIN n ON n.r = reach.x GROUP BY reach.x, a.doc_id""",
    "op10_decontamination": r"""
        WITH word AS (
            SELECT 'd' AS side, row_number() OVER () AS r, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
            UNION ALL
            SELECT 'b', row_number() OVER (), item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark),
        cut AS (SELECT side, r, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM word WHERE len(w) > 0),
        sh AS (SELECT DISTINCT side, r, id, array_to_string(w[i:i + 4], ' ') AS s FROM cut),
        n AS (SELECT r, count(*) AS n_item FROM sh WHERE side = 'b' GROUP BY r),
        pair AS (SELECT a.r AS ar, b.r AS br, a.id AS doc_id, b.id AS item_id, count(*) AS n_shared FROM sh a JOIN sh b ON a.s = b.s AND a.side = 'd' AND b.side = 'b' GROUP BY ALL)
        SELECT doc_id, item_id, n_item, n_shared, CAST(n_shared AS DOUBLE) / n_item AS containment FROM pair JOIN n ON br = n.r WHERE 10 * n_shared >= 8 * n_item""",
    "op11_prefix_trie": rf"""
        WITH said AS (
            SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS i,
                sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS item, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
            FROM conversations WHERE conv_id IS NOT NULL),
        conv AS (SELECT c, c - c % 20 AS base, {CRC32.format("c")} % 4 AS h FROM (SELECT DISTINCT c FROM said)),
        joined AS (
            SELECT conv.c, 0 AS part, said.i, item, words FROM conv JOIN said ON said.c = base AND i < h
            UNION ALL SELECT conv.c, 1, said.i, item, words FROM conv JOIN said ON said.c = conv.c AND i >= h),
        talk AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d FROM joined),
        line AS (
            SELECT c, d, words, string_agg(item, '') OVER (PARTITION BY c ORDER BY d) AS k FROM talk
            UNION ALL SELECT c, 0, 0, '' FROM conv),
        size AS (SELECT c, max(d) AS n FROM line GROUP BY c),
        node AS (SELECT k, d, min(c) AS m, count(*) AS convs, any_value(words) AS words FROM line GROUP BY k, d),
        kid AS (SELECT left(k, len(k) - 64) AS k, count(*) AS kids FROM node WHERE d > 0 GROUP BY 1),
        own AS (SELECT node.*, coalesce(kids, 0) AS kids, (convs - 1) * words AS saved FROM node LEFT JOIN kid USING (k)),
        rolled AS (
            SELECT line.k, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved
            FROM own JOIN line ON line.c = own.m AND line.d <= own.d GROUP BY line.k),
        ends AS (SELECT k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM line JOIN size USING (c) WHERE d = n GROUP BY k)
        SELECT own.m AS conv_id, CAST(own.d AS BIGINT) AS depth, up.m AS parent_conv_id, own.convs AS n_convs, own.kids AS n_children,
            CAST(leaves AS BIGINT) AS n_leaves, CAST(rolled.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
        FROM own JOIN rolled USING (k) LEFT JOIN ends USING (k) LEFT JOIN own AS up ON own.d > 0 AND up.k = left(own.k, len(own.k) - 64)""",
    "op12_mixing": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
            FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS most FROM s),
        f AS (
            SELECT *, sum(source_size) OVER () AS words, coalesce(sum(most) OVER before, 0) AS below, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS heavier
            FROM w WINDOW before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        l AS (SELECT *, most * heavier <= (words - below) * weight AS held FROM f),
        rest AS (SELECT CAST(max(words) - coalesce(sum(most) FILTER (held), 0) AS DOUBLE) AS words, CAST(coalesce(sum(weight) FILTER (NOT held), 1) AS DOUBLE) AS weight FROM l),
        t AS (SELECT source, source_size, most, CASE WHEN held THEN CAST(most AS DOUBLE) ELSE rest.words * l.weight / rest.weight END AS target FROM l, rest),
        b AS (SELECT *, least(most, CAST(floor(target + 0.5) AS BIGINT)) AS budget FROM t),
        p AS (
            SELECT doc_id, size, source_size, target, budget, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS passes,
                coalesce(CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS FIRST, size, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS ahead
            FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
        SELECT doc_id, size, source_size, target, passes * size + greatest(0, least(size, budget - passes * source_size - ahead)) AS taken FROM p""",
    "op13_merkle_manifest": rf"""
        WITH RECURSIVE d AS (
            SELECT *, row_number() OVER () AS r, {_leaf("text")} AS leaf,
                CASE WHEN {CRC32.format("doc_id")} % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_leaf("text")} END AS used
            FROM documents),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d),
        up AS (
            SELECT 0 AS level, source, pos, n, leaf AS digest FROM ranked
            UNION ALL SELECT level + 1, source, pos // 16, (max(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY level, source, pos // 16),
        subroot AS (SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
        top AS (
            SELECT 0 AS level, pos, n, digest FROM subroot
            UNION ALL SELECT level + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 16),
        fold AS (
            SELECT r, source, 0 AS level, pos, n, used AS own, '' AS proof FROM ranked
            UNION ALL SELECT r, fold.source, fold.level + 1, fold.pos // 16, (max(fold.n) + 15) // 16, sha256(string_agg(CASE WHEN up.pos = fold.pos THEN own ELSE digest END, '' ORDER BY up.pos)),
                any_value(proof) || coalesce(string_agg(digest, '' ORDER BY up.pos) FILTER (up.pos <> fold.pos), '')
            FROM fold JOIN up ON up.level = fold.level AND up.source IS NOT DISTINCT FROM fold.source AND up.pos // 16 = fold.pos // 16 WHERE fold.n > 1 GROUP BY r, fold.source, fold.level, fold.pos),
        fold_top AS (
            SELECT r, fold.source, 0 AS level, subroot.pos, subroot.n, own, proof FROM fold JOIN subroot ON fold.source IS NOT DISTINCT FROM subroot.source WHERE fold.n = 1
            UNION ALL SELECT r, fold_top.source, fold_top.level + 1, fold_top.pos // 16, (max(fold_top.n) + 15) // 16, sha256(string_agg(CASE WHEN top.pos = fold_top.pos THEN own ELSE digest END, '' ORDER BY top.pos)),
                any_value(proof) || coalesce(string_agg(digest, '' ORDER BY top.pos) FILTER (top.pos <> fold_top.pos), '')
            FROM fold_top JOIN top ON top.level = fold_top.level AND top.pos // 16 = fold_top.pos // 16 WHERE fold_top.n > 1 GROUP BY r, fold_top.source, fold_top.level, fold_top.pos)
        SELECT doc_id, leaf, subroot.digest AS subroot, top.digest AS root, sha256(proof) AS proof_sha256, own AS folded_root, own = top.digest AS verified
        FROM ranked JOIN fold_top USING (r) JOIN subroot ON ranked.source IS NOT DISTINCT FROM subroot.source, top WHERE fold_top.n = 1 AND top.n = 1""",
}
