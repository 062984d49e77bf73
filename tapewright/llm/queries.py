"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.llm.decontaminate import decontamination_report
from tapewright.llm.exact_dedup import exact_dedup
from tapewright.llm.jaccard_join import component_report
from tapewright.llm.lexical_search import ranked_documents
from tapewright.llm.mixing import mix
from tapewright.llm.personal_data import personal_data_report
from tapewright.llm.quality import KEEP, score
from tapewright.llm.span_dedup import removed_sentences
from tapewright.llm.spelling import spelling_variants
from tapewright.llm.token_files import token_report, write_tokens
from tapewright.llm.toxicity import toxicity_report
from tapewright.llm.vector_lsh import vector_report
from tapewright.llm.warc import derivatives, read_warc, responses, write_records
from tapewright.llm.util import scratch, table


def tokenizer_path() -> str:
    """The tokenizer file that op3 and the pipeline use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        F.col("id").alias("doc_id"), "host", "path", "evidence", "host_mean", "path_mean", "score", (F.col("score") >= KEEP).alias("keep")
    )


def op2_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = removed_sentences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_sentences", F.size("removed").cast("long").alias("n_removed"), "removed", "text")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_report(spark, path)


def op4_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as WARC files, and the derivatives of what is read from these."""
    path = scratch(spark, "warc")
    write_records(responses(table(spark, sf_dir, "pages")), path)
    return derivatives(read_warc(spark, path))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return component_report(table(spark, sf_dir, "documents"), k=4, percent=85)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_report(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


REPETITION_LIMIT = 2.0


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), repetition_limit=REPETITION_LIMIT)
    return drawn.select(
        "doc_id", "source", "mix_copy", "mix_block", "mix_tokens", F.round("mix_weight", 6).alias("mix_weight"), "mix_order"
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_span_dedup": op2_span_dedup,
    "op3_token_files": op3_token_files,
    "op4_warc_records": op4_warc_records,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_toxicity": op6_toxicity,
    "op7_personal_data": op7_personal_data,
    "op8_decontamination": op8_decontamination,
    "op9_mixing": op9_mixing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_lexical_search": op12_lexical_search,
    "op13_vector_near_dedup": op13_vector_near_dedup,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL: dict[str, str] = {
    "op8_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        win AS (
            SELECT item_id, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i, w
            FROM b WHERE len(w) > 0
        ),
        items AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS t FROM win),
        places AS (
            SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i
            FROM d, (SELECT DISTINCT k FROM items) WHERE len(w) >= k
        ),
        runs AS (SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS t FROM places),
        met AS (SELECT doc_id, i, k, item_id FROM runs JOIN items USING (k, t)),
        hit AS (
            SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM met) GROUP BY 1
        ),
        named AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM met),
        lists AS (SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names FROM named GROUP BY 1)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(lists.n, 0) AS BIGINT) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN lists USING (doc_id)
    """,
    # the bisection's result in closed form: the least source is passed REPETITION_LIMIT times as often as the largest
    "op9_mixing": rf"""
        WITH d AS (
            SELECT doc_id, source, coalesce(source, '') AS s, coalesce(CAST(doc_id AS VARCHAR), '') AS k,
                   CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS BIGINT) AS t
            FROM documents
        ),
        src AS (SELECT s, CAST(sum(t) AS DOUBLE) AS total, CAST(ceil(sqrt(count(*))) AS BIGINT) AS blocks FROM d GROUP BY s),
        e AS (
            SELECT sum(total) AS every, max(total) AS hi,
                   CASE WHEN max(total) <= {REPETITION_LIMIT} * min(total) THEN 0.0
                        ELSE 1 - ln({REPETITION_LIMIT}) / ln(max(total) / min(total)) END AS x
            FROM src WHERE total > 0
        ),
        z AS (SELECT sum(pow(total / every, x)) AS z FROM src, e WHERE total > 0),
        p AS (
            SELECT s, total, blocks,
                   CASE WHEN total > 0 THEN pow(total / every, x) / z ELSE 0.0 END AS weight,
                   CASE WHEN total > 0 THEN pow(total / every, x - 1) / pow(hi / every, x - 1) ELSE 1.0 END AS passes
            FROM src, e, z
        ),
        b AS (
            SELECT d.*, weight, CAST(floor(passes) AS BIGINT) AS whole,
                   CAST(ceil((passes - floor(passes)) * total) AS BIGINT) AS part,
                   CAST('0x' || substr(md5('0:block:' || k), 1, 8) AS BIGINT) % blocks AS block
            FROM d JOIN p USING (s)
        ),
        o AS (
            SELECT *, md5('0:' || whole || ':' || s || ':' || block) AS bo, md5('0:' || whole || ':' || k) AS ro FROM b
        ),
        c AS (
            SELECT *, sum(t) OVER (PARTITION BY s ORDER BY bo, block, ro, t ROWS UNBOUNDED PRECEDING) - t AS before FROM o
        ),
        n AS (SELECT *, whole + CASE WHEN before < part THEN 1 ELSE 0 END AS copies FROM c),
        r AS (SELECT *, unnest(range(0, copies)) AS copy FROM n)
        SELECT doc_id, source, CAST(copy AS BIGINT) AS mix_copy, block AS mix_block, t AS mix_tokens,
               round(weight, 6) AS mix_weight,
               md5('0:' || copy || ':' || s || ':' || block) || md5('0:' || copy || ':' || k) AS mix_order
        FROM r
    """,
    "op10_exact_dedup": f"""
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents
        )
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM d
    """,
    # crc32 from its polynomial; near words meet in what is left when a letter goes from one or both
    "op11_spelling_variants": rf"""
        WITH RECURSIVE table_of(crc) AS (
            SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, y: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))
        ),
        runs AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run
            FROM documents
        ),
        per_doc AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
        bytes AS (
            SELECT *, list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda c: unicode(c)) AS points
            FROM per_doc
        ),
        hashed AS (
            SELECT run, n, xor(list_reduce(
                list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(points, lambda p: CASE WHEN p < 128 THEN [CAST(p AS BIGINT)] ELSE [195, p - 64] END))),
                lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS h
            FROM bytes, table_of
        ),
        typed AS (
            SELECT n, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
            FROM hashed
        ),
        words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
        shorter AS (
            SELECT word, word AS less, 0 AS at FROM words
            UNION ALL
            SELECT word, left(word, i) || substr(word, i + 2), i + 1 FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)
        ),
        near AS (
            SELECT DISTINCT a.word, b.word AS other
            FROM shorter a JOIN shorter b ON a.less = b.less AND a.word <> b.word AND (a.at = b.at OR a.at = 0 OR b.at = 0)
        ),
        ranked AS (
            SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
                   row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS place
            FROM near JOIN words o ON o.word = other
        ),
        forms AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
            FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1
        ),
        chain AS (
            SELECT word, word AS root FROM forms
            UNION ALL
            SELECT chain.word, form FROM chain JOIN forms ON forms.word = chain.root WHERE form IS NOT NULL
        ),
        ends AS (SELECT chain.word, root FROM chain JOIN forms ON forms.word = chain.root WHERE form IS NULL)
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
    """,
    "op12_lexical_search": rf"""
        WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
        size AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d WHERE len(w) > 0),
        asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
        tf AS (
            SELECT doc_id, n, t, count(*) AS f FROM (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM d)
            WHERE t IN (SELECT t FROM asked) GROUP BY ALL
        ),
        weights AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, size GROUP BY t),
        scored AS (
            SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * f) // (1000 * f + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
            FROM tf JOIN weights USING (t) JOIN asked USING (t), size GROUP BY ALL
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 10
    """,
    # the tables of the SQL check have no pair near the threshold, where hashing could miss one
    "op13_vector_near_dedup": """
        WITH RECURSIVE raw AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        usable AS (
            SELECT vec_id, v FROM raw
            WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0
        ),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            WHERE list_cosine_similarity(a.v, b.v) >= 0.9
        ),
        reached AS (SELECT vec_id, vec_id AS other FROM raw UNION SELECT reached.vec_id, b FROM reached JOIN links ON other = a),
        lowest AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
        counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
        FROM lowest LEFT JOIN counted ON a = vec_id
    """,
}
