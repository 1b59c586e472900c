"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebars.llm import cotraining, language_id
from lakebars.llm.alignment import align
from lakebars.llm.collision_ann import nearest
from lakebars.llm.common import crc_bucket, table
from lakebars.llm.exact_dedup import exact_dedup
from lakebars.llm.fill_middle import fill_in_middle, restored
from lakebars.llm.id_files import read_ids, write_ids
from lakebars.llm.line_runs import line_dedup
from lakebars.llm.merge_replay import decode, encode
from lakebars.llm.packing import pack
from lakebars.llm.shingle_join import similar_groups
from lakebars.llm.toxicity import fit_toxicity, score_toxicity, training_rows
from lakebars.llm.warc import read_archive, write_archive
from lakebars.operators.scratch import scratch_path


def op1_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op4_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"), words=3, similarity=(9, 10)).drop("text_hash")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    page = lambda name: F.col(name).cast("bigint").alias(name)
    return read_archive(spark, path).select(
        page("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to")
    )


def op6_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = decode(encode(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of a quarter of the ids are not learned, so that they can test the scores."""
    held_out = crc_bucket("doc_id", 4) == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", *cotraining.METADATA)
    model = cotraining.fit_quality(cotraining.training_rows(docs, table(spark, sf_dir, "labels"), ~held_out))
    scored = cotraining.score_quality(docs.withColumn("held_out", held_out), model)
    return scored.drop("text", *cotraining.METADATA)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = training_rows(docs, table(spark, sf_dir, "labels"), crc_bucket("doc_id", 3) != 1)
    held_out = docs.withColumn("held_out", crc_bucket("doc_id", 3) == 1)
    return score_toxicity(held_out, fit_toxicity(rows)).drop("text")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_bucket("doc_id", 5) == 0
    model = language_id.fit_languages(language_id.training_rows(docs, ~held_out))
    texts = docs.select("doc_id", "text", held_out.alias("held_out"))
    return language_id.predict_language(texts, model).drop("text")


def op10_mixing_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_ids(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align(table(spark, sf_dir, "documents"), *paths).documents


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return cut.select(
        *("doc_id", "n", "form", "prefix_chars", "middle_chars"),
        sha(F.col("output")).alias("output_sha256"),
        sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


def op13_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_collision_ann": op1_collision_ann,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_packing": op3_packing,
        "op4_signature_trees": op4_signature_trees,
        "op5_warc": op5_warc,
        "op6_merge_replay": op6_merge_replay,
        "op7_cotraining": op7_cotraining,
        "op8_toxicity": op8_toxicity,
        "op9_language_id": op9_language_id,
        "op10_mixing_coder": op10_mixing_coder,
        "op11_alignment": op11_alignment,
        "op12_fill_middle": op12_fill_middle,
        "op13_line_runs": op13_line_runs,
    }


_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"


def _near(rows: str, words: int, whole: int, part: int) -> str:
    """Tables `sizes` (`doc_id, n`) and `lowest` (`doc_id, low`: smallest id reached) of `rows`.

    Linked when `whole` times the overlap is at least `part` times the union.
    """
    return rf"""WITH RECURSIVE w AS (SELECT doc_id, [x for x in regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+') if x <> ''] AS w FROM {rows}),
              sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [w]
                ELSE [w[i:i + {words - 1}] for i in range(1, len(w) - {words - 2})] END) AS s FROM w),
              sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
              ov AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
                GROUP BY 1, 2),
              links AS (SELECT a, b FROM ov o JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
                WHERE {whole} * o.n >= {part} * (x.n + y.n - o.n)),
              reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
              lowest AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
            """


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_dedup": f"""WITH d AS (SELECT doc_id, {_NORMAL} AS t FROM documents)
            SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
              doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
            FROM d WINDOW g AS (PARTITION BY t)""",
        "op4_signature_trees": _near("documents", 3, 100, 90)
        + """SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
            FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)""",
        "op5_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
              s AS (SELECT page_id, octet_length(encode(h)) AS n, sha256(h) AS digest,
                min(page_id) OVER (PARTITION BY h) AS first FROM p)
            SELECT page_id, n AS payload_bytes, digest AS payload_digest,
              CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
              CASE WHEN n >= 100 AND page_id > first THEN first END AS refers_to FROM s""",
            "op12_fill_middle": r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h FROM documents),
              u AS (SELECT *, [len(x) for x in regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+')] AS u,
                [CAST('0x' || substr(h, i, 8) AS BIGINT) for i in [1, 9, 17, 25]] AS d FROM t),
              c AS (SELECT *, len(u) AS n, least(d[1] % (len(u) + 1), d[2] % (len(u) + 1)) AS a,
                greatest(d[1] % (len(u) + 1), d[2] % (len(u) + 1)) AS b FROM u),
              f AS (SELECT *, CAST(coalesce(list_sum(u[1:a]), 0) AS BIGINT) AS p, CAST(coalesce(list_sum(u[a + 1:b]), 0) AS BIGINT) AS m,
                CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR d[3] % 100 >= 50 THEN 'plain'
                  WHEN d[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM c),
              x AS (SELECT *, '<P>' || substr(t, 1, p) AS tp, '<M>' || substr(t, p + 1, m) AS tm, '<S>' || substr(t, p + m + 1) AS ts FROM f)
            SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars,
              CASE WHEN form <> 'plain' THEN m END AS middle_chars,
              sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN ts || tp || tm ELSE tp || ts || tm END) AS output_sha256,
              sha256(t) AS restored_sha256 FROM x""",
        "op13_line_runs": r"""WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
              k AS (SELECT *, [translate(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') for x in lines] AS keys FROM l),
              often AS (SELECT key FROM (SELECT DISTINCT doc_id, unnest(keys) AS key FROM k) WHERE key <> '' GROUP BY key
                HAVING count(*) >= 10),
              o AS (SELECT doc_id, unnest(lines) AS line, unnest(keys) AS key, generate_subscripts(lines, 1) AS place FROM k),
              s AS (SELECT doc_id, count(*) AS n, count(often.key) AS d,
                coalesce(string_agg(CASE WHEN often.key IS NULL THEN line END, chr(10) ORDER BY place), '') AS kept
                FROM o LEFT JOIN often USING (key) GROUP BY doc_id)
            SELECT doc_id, n AS n_lines, d AS n_dropped, sha256(kept) AS kept_sha256 FROM s""",
    }
