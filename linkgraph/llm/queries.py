"""The queries of this subpackage's operators, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkgraph.llm import decontaminate, embeddings, minhash, ngrams, pii, sentencepiece, substring_dedup, suffix_dedup, toxicity, warc
from linkgraph.llm.common import table


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"), digests=True)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.9)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"), digests=True)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), like=minhash.Likeness(words=3, percent=85))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(table(spark, sf_dir, "documents"), piece_model(), digests=True)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ngrams.score(docs, ngrams.train(docs))


def lm_score_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op8 that SQL can say."""
    return op8_lm_score(spark, sf_dir).drop("score").withColumn("base_score", F.round("base_score", 6))


def pii_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op7 that SQL can say."""
    return op7_pii(spark, sf_dir).drop("base_sha256", "spans")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.measure(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_embedding_dedup": op2_embedding_dedup,
        "op3_warc": op3_warc,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_minhash": op5_minhash,
        "op6_sentencepiece": op6_sentencepiece,
        "op7_pii": op7_pii,
        "op8_lm_score": op8_lm_score,
        "op9_decontaminate": op9_decontaminate,
        "op10_toxicity": op10_toxicity,
        "lm_score_base": lm_score_base,
        "pii_counts": pii_counts,
    }


WORDS = "list_filter(regexp_split_to_array({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Components of edges e (a, b), both ways: smallest node that each reaches.
REACH = "reach AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b), comp AS (SELECT a AS node, least(a, min(b)) AS c FROM reach GROUP BY a)"


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": f"""
            WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
            win AS (SELECT doc_id, i, md5_number(array_to_string(w[i : i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
            m AS (SELECT h, min(doc_id) AS first FROM win GROUP BY h),
            hit AS (SELECT doc_id, i FROM win JOIN m USING (h) WHERE first < doc_id),
            word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM d),
            seen AS (SELECT word.*, max(i) OVER (PARTITION BY word.doc_id ORDER BY j) AS last FROM word LEFT JOIN hit ON hit.doc_id = word.doc_id AND i = j),
            left_ AS (SELECT doc_id, count(*) FILTER (WHERE last IS NOT NULL AND j - last < 50) AS gone, string_agg(x, ' ' ORDER BY j) FILTER (WHERE last IS NULL OR j - last >= 50) AS kept,
                      count(*) FILTER (WHERE last IS NOT NULL AND j - last < 50 AND (before IS NULL OR j - 1 - before >= 50)) AS runs FROM (SELECT *, lag(last) OVER (PARTITION BY doc_id ORDER BY j) AS before FROM seen) GROUP BY doc_id)
            SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(runs, 0)::BIGINT AS n_spans, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN left_ USING (doc_id)""",
        "op2_embedding_dedup": f"""
            WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings),
            e AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id <> q.vec_id AND list_cosine_similarity(p.x, q.x) >= 0.9), {REACH}
            SELECT vec_id, (SELECT count(*) FROM e WHERE a = vec_id) AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept FROM v LEFT JOIN comp ON node = vec_id""",
        "op3_warc": """
            WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
            d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
            f AS (SELECT h, min(page_id) AS m FROM d WHERE n >= 100 GROUP BY h)
            SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d.h AS payload_digest,
                   CASE WHEN m <> page_id AND n >= 100 THEN 'revisit' ELSE 'response' END AS record_type,
                   CASE WHEN m <> page_id AND n >= 100 THEN m END AS refers_to
            FROM d LEFT JOIN f ON d.h = f.h""",
        "op4_suffix_dedup": """
            WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
            win AS (SELECT doc_id, i, md5_number(substr(x, 2 * i + 1, 400)) AS h FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 199)) AS i FROM d WHERE len(x) >= 400)),
            m AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
            hit AS (SELECT doc_id, i FROM win SEMI JOIN m USING (h)),
            byte AS (SELECT doc_id, x, unnest(range(0, len(x) // 2)) AS j FROM d SEMI JOIN hit USING (doc_id)),
            seen AS (SELECT byte.doc_id, substr(x, 2 * j + 1, 2) AS b, j, max(i) OVER (PARTITION BY byte.doc_id ORDER BY j) AS last FROM byte LEFT JOIN hit ON hit.doc_id = byte.doc_id AND i = j),
            left_ AS (SELECT doc_id, count(*) FILTER (WHERE last IS NOT NULL AND j - last < 200) AS gone, string_agg(b, '' ORDER BY j) FILTER (WHERE last IS NULL OR j - last >= 200) AS kept,
                      count(*) FILTER (WHERE last IS NOT NULL AND j - last < 200 AND (before IS NULL OR j - 1 - before >= 200)) AS runs FROM (SELECT *, lag(last) OVER (PARTITION BY doc_id ORDER BY j) AS before FROM seen) GROUP BY doc_id)
            SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(runs, 0)::BIGINT AS n_spans,
                   sha256(CASE WHEN left_.doc_id IS NULL THEN unhex(x) ELSE unhex(coalesce(kept, '')) END) AS kept_sha256 FROM d LEFT JOIN left_ USING (doc_id)""",
        "op5_minhash": f"""
            WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(LOWER)} AS w FROM documents),
            s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
            n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
            both_ AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS k FROM s p JOIN s q ON p.x = q.x AND p.doc_id <> q.doc_id GROUP BY 1, 2),
            e AS (SELECT a, b FROM both_ JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)), {REACH}
            SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp ON node = doc_id""",
        "op9_decontaminate": _decontaminate_sql(),
        "lm_score_base": _base_score_sql(),
        "pii_counts": _pii_sql(),
    }


def _base_score_sql() -> str:
    # CRC-32 of a text's bytes, four bits at a time; DuckDB has no function for it.
    table = []
    for k in range(16):
        for _ in range(4):
            k = k >> 1 ^ 0xEDB88320 if k & 1 else k >> 1
        table.append(k)
    four = "xor({table}[({c} & 15) + 1], {c} >> 4)"
    one = four.format(table="t", c=four.format(table="t", c="xor(c, b)"))
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: {one.replace('t[', f'({table}::BIGINT[])[')}), 4294967295::BIGINT)"
    return f"""
        WITH d AS (SELECT doc_id, list_append(list_transform({WORDS.format(LOWER)}, lambda x: 'w' || x), 'end') AS w, coalesce({crc} % 5 = 1, false) AS held_out FROM documents),
        tok AS (SELECT doc_id, held_out, unnest(w) AS x FROM d), c AS (SELECT x, count(*) AS c FROM tok WHERE NOT held_out GROUP BY 1), t AS (SELECT sum(c) AS n, count(*) AS v FROM c)
        SELECT doc_id, held_out, count(*) AS n_tokens, count(c.c) AS n_known, any_value(n)::BIGINT AS train_tokens, round(sum(log10((coalesce(c.c, 0) + 0.5) / (n + 0.5 * (v + 1)))), 6) AS base_score FROM tok LEFT JOIN c USING (x), t GROUP BY ALL"""


def _pii_sql() -> str:
    # Of each kind the matches, and what a match must pass; '§' stands for it.
    digits = "regexp_replace(§, '[^0-9]', '', 'g')"
    luhn = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda k: CASE WHEN (length({digits}) - k) % 2 = 0 THEN substr({digits}, k, 1)::INT ELSE (substr({digits}, k, 1)::INT * 2) // 10 + (substr({digits}, k, 1)::INT * 2) % 10 END)) % 10 = 0"
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "list_max(list_transform(string_split(§, '.'), lambda p: p::HUGEINT)) <= 255"),
        "card": (r"[0-9]([\x20-]?[0-9])+", f"length({digits}) BETWEEN 12 AND 19 AND {luhn}"),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({digits}) BETWEEN 9 AND 15"),
    }
    return "SELECT doc_id, " + ", ".join(f"len(list_filter(regexp_extract_all(coalesce(text, ''), '{pattern}'), lambda m: {test.replace('§', 'm')})) AS n_{kind}" for kind, (pattern, test) in kinds.items()) + " FROM documents"


def _decontaminate_sql() -> str:
    words = f"regexp_extract_all({LOWER}, '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+')"
    return f"""
        WITH d AS (SELECT doc_id, {words} AS w FROM documents), b AS (SELECT item_id, {words} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
        win AS (SELECT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS x FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT *, least(len(w), 10) AS n FROM b) WHERE n > 0)),
        spot AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS x FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
        hit AS (SELECT doc_id, i, spot.n, item_id FROM spot JOIN win ON spot.x = win.x AND spot.n = win.n),
        covered AS (SELECT doc_id, count(DISTINCT j) AS k FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY 1),
        items AS (SELECT doc_id, count(DISTINCT item_id) AS k, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM hit GROUP BY 1)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(covered.k, 0)::BIGINT AS n_hit, coalesce(items.k, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(covered.k, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""
