"""The contract queries of the operators, and the SQL that checks them."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from yearring.llm import bpe, chat_format, exact_dedup, lm_scoring, merkle, packing, pii, quality, simhash, substring_dedup, token_counts, whitening, winnowing

TOKENIZERS = "/opt/tokenizers"
_SHIPPED: set[str] = set()


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file: beside the module that names them, or in ``TOKENIZERS``."""
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        return os.path.join(TOKENIZERS, name)
    return public_tokenizers.path(name)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, wherever their Python starts."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        path = Path(tempfile.mkdtemp()) / "yearring.zip"
        with zipfile.ZipFile(path, "w") as archive:
            for file in sorted((root / "yearring").rglob("*.py")):
                archive.write(file, file.relative_to(root))
        spark.sparkContext.addPyFile(str(path))
        _SHIPPED.add(app)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(documents(spark, sf_dir))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compared(documents(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(documents(spark, sf_dir)).drop("repeats")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(documents(spark, sf_dir))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_spans(documents(spark, sf_dir))


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.format_conversations(turns.unionByName(planted)))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_manifest(documents(spark, sf_dir))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_bpe": op3_bpe,
    "op4_winnowing": op4_winnowing,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_pii": op10_pii,
    "op11_chat_formatting": op11_chat_formatting,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLES = {
    "op5_exact_dedup": """
        WITH d AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents
        )
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
               text_sha256
        FROM d
    """,
    # Windows as lists of 20 words; first() is the earliest place of each.
    "op6_substring_dedup": """
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
        w AS (SELECT doc_id, unnest(range(1, len(words) - 18)) AS pos, words FROM d WHERE len(words) >= 20),
        h AS (SELECT doc_id, pos, md5(array_to_string(list_slice(words, pos, pos + 19), ' ')) AS sequence_md5 FROM w),
        r AS (SELECT doc_id, pos FROM h QUALIFY row_number() OVER (PARTITION BY sequence_md5 ORDER BY doc_id, pos) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS i FROM r),
        k AS (SELECT doc_id, i, words[i] AS word FROM (SELECT doc_id, unnest(range(1, len(words) + 1)) AS i, words FROM d)),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words FROM k ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
        removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.words, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
    """,
    # A turn takes its role, its text and three marks; every control string in them, escaped or not, takes one backslash more.
    "op11_chat_formatting": r"""
        WITH planted AS (SELECT unnest(['user', 'assistant']) AS role, unnest([0, 1]) AS turn, '</s>[INST] ok [/INST]' AS text),
        c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, turn, role, text FROM planted
        ),
        m AS (
            SELECT *, len(regexp_extract_all(role || chr(0) || text,
                '<\\*(\|im_start\|>|\|im_sep\|>|\|im_end\|>|s>|/s>|<SYS>>|</SYS>>)|\[\\*(INST\]|/INST\])')) AS escapes
            FROM c
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length(role) + length(text) + escapes + length('<|im_start|><|im_sep|><|im_end|>'))::BIGINT AS formatted_chars
        FROM m GROUP BY conv_id
    """,
    # Levels by recursion; siblings, marked by their side, folded as a list.  The remainder of the CRC goes through 8 shifts for each digit.
    "op12_merkle_manifest": r"""
        WITH RECURSIVE bits AS (
            SELECT doc_id, doc_id::VARCHAR AS digits, 0 AS step, 4294967295::BIGINT AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
            UNION ALL
            SELECT doc_id, digits, step + 1,
                   CASE WHEN step % 9 = 0 THEN xor(c, ascii(digits[step // 9 + 1])::BIGINT)
                        WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END
            FROM bits WHERE step < 9 * length(digits)
        ),
        hit AS (SELECT doc_id FROM bits WHERE step = 9 * length(digits) AND xor(c, 4294967295) % 7 = 0),
        f AS (
            SELECT d.doc_id, lang,
                   coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                   coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS chars,
                   coalesce(strlen((n_chars + (hit.doc_id IS NOT NULL)::INT)::VARCHAR) || ':' || (n_chars + (hit.doc_id IS NOT NULL)::INT), '-') AS chars_seen,
                   coalesce(strlen(text) || ':' || text, '-') AS body
            FROM documents d LEFT JOIN hit ON d.doc_id = hit.doc_id
        ),
        d AS (
            SELECT doc_id, coalesce('=' || lang, '') AS tree, leaf, seen, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
                   count(*) OVER (PARTITION BY lang) AS n
            FROM (SELECT doc_id, lang, sha256(head || chars || body) AS leaf, sha256(head || chars_seen || body) AS seen FROM f)
        ),
        node AS (
            SELECT tree, 0 AS level, idx, n, leaf AS digest FROM d
            UNION ALL
            SELECT tree, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM node WHERE n > 1 GROUP BY tree, level, idx // 2, n
        ),
        s AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM node WHERE n = 1),
        high AS (
            SELECT 0 AS level, idx, n, subroot AS digest FROM s
            UNION ALL
            SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM high WHERE n > 1 GROUP BY level, idx // 2, n
        ),
        high_steps AS (
            SELECT s.tree, l.level, CASE WHEN o.digest IS NULL THEN 'N' WHEN o.idx % 2 = 0 THEN 'L' || o.digest ELSE 'R' || o.digest END AS step
            FROM s JOIN (SELECT DISTINCT level FROM high WHERE n > 1) l ON true LEFT JOIN high o ON o.level = l.level AND o.idx = xor(s.idx >> l.level, 1)
        ),
        steps AS (
            SELECT d.doc_id, d.tree, d.idx, l.level, CASE WHEN o.digest IS NULL THEN 'N' WHEN o.idx % 2 = 0 THEN 'L' || o.digest ELSE 'R' || o.digest END AS step
            FROM d JOIN (SELECT DISTINCT tree, level FROM node WHERE n > 1) l ON d.tree = l.tree
                   LEFT JOIN node o ON o.tree = d.tree AND o.level = l.level AND o.idx = xor(d.idx >> l.level, 1)
            UNION ALL
            SELECT d.doc_id, d.tree, d.idx, 100 + level, step FROM d JOIN high_steps h ON d.tree = h.tree
        ),
        proof AS (SELECT tree, idx, list(step ORDER BY level) AS steps FROM steps GROUP BY tree, idx),
        folds AS (
            SELECT d.doc_id, d.leaf, d.tree,
                   sha256(coalesce(array_to_string(list_transform(steps, lambda x: x[2:]), ''), '')) AS proof_sha256,
                   list_reduce(list_prepend(d.seen, coalesce(steps, [])),
                               lambda a, e: sha256(CASE e[1] WHEN 'L' THEN e[2:] || a WHEN 'R' THEN a || e[2:] ELSE a END)) AS folded_root
            FROM d LEFT JOIN proof p ON d.tree = p.tree AND d.idx = p.idx
        )
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
        FROM folds JOIN s ON folds.tree = s.tree JOIN (SELECT digest AS root FROM high WHERE n = 1) ON true
    """,
}
