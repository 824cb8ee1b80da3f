"""The registered queries of the training-data operators.

Each applies one operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cartwheel.llm import (
    infill,
    laesa,
    minhash,
    multi_index,
    packing,
    preference,
    quality,
    relative_lz,
    secrets,
    toxicity,
    viterbi,
    warc,
    wrappers,
)
from cartwheel.llm.scratch import table, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


@register(
    "op10_minhash_near_dedup",
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
        FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                   ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
                                                     lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
        FROM words
    ), items AS (
        SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
    ), links AS (
        SELECT a.doc_id AS u, b.doc_id AS v
        FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n
        HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
    ), reach(u, v) AS (
        SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
    ), least_reached AS (
        SELECT u, min(v) AS m FROM reach GROUP BY u
    )
    SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles,
           least(s.doc_id, coalesce(r.m, s.doc_id)) AS component_id,
           s.doc_id = least(s.doc_id, coalesce(r.m, s.doc_id)) AS kept
    FROM sets s LEFT JOIN least_reached r ON r.u = s.doc_id
    """,
)
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op5_quality_divergence")
def op5_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@register("op8_toxicity_gru")
def op8_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(
        table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic")
    )


@register("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op3_shortest_pack_first")
def op3_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path("word_bpe_49k.json"))


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@register(
    "op2_warc_bundles",
    """
    WITH pays AS (
        SELECT page_id, encode(coalesce(html, '')) AS p, sha1(coalesce(html, '')) AS h FROM pages
    ), firsts AS (
        SELECT h, min(page_id) AS first FROM pays GROUP BY h
    )
    SELECT page_id, octet_length(p)::BIGINT AS payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i:
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(1 + ((('0x' || h[5 * (i // 4) + 1:5 * (i // 4) + 5])::BIGINT
                   >> (5 * (3 - i % 4)::INTEGER)) & 31))::BIGINT]), '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM pays JOIN firsts USING (h)
    """,
)
def op2_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write(table(spark, sf_dir, "pages", "page_id", "url", "html"), warc.archive_folder(spark))
    return warc.read(index, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@register("op9_wrapper_text")
def op9_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


@register(
    "op1_inverted_multi_index",
    """
    WITH e AS (
        SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score
        FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
)
def op1_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return multi_index.search(vectors, vectors.where("vec_id % 20 = 0"))


@register(
    "op6_preference_pairs",
    r"""
    WITH t AS (
        SELECT conv_id // 2 AS pair_id, conv_id % 2 = 0 AS c, role AS own_role, text AS own_text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i,
               '<|im_start|>' || replace(coalesce(role, 'unknown'), '<|', '< |') || chr(10) AS head,
               replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10) AS body,
               coalesce(role, 'unknown') = 'assistant' AS train
        FROM conversations WHERE conv_id IS NOT NULL
    ), sizes AS (
        SELECT pair_id, count(*) FILTER (WHERE c) AS nc, count(*) FILTER (WHERE NOT c) AS nr FROM t GROUP BY pair_id
    ), differ AS (
        SELECT a.pair_id, min(a.i) AS i FROM t a JOIN t b ON a.pair_id = b.pair_id AND a.i = b.i AND a.c AND NOT b.c
        WHERE a.own_role IS DISTINCT FROM b.own_role OR a.own_text IS DISTINCT FROM b.own_text
        GROUP BY a.pair_id
    ), cut AS (
        SELECT pair_id, coalesce(i - 1, least(nc, nr)) AS n
        FROM sizes LEFT JOIN differ USING (pair_id) WHERE nc > 0 AND nr > 0
    )
    SELECT pair_id, any_value(n)::BIGINT AS n_prompt_turns,
           coalesce(string_agg(head || body, '' ORDER BY i) FILTER (WHERE c AND i <= n), '') AS prompt,
           coalesce(string_agg(head || body, '' ORDER BY i) FILTER (WHERE c AND i > n), '') AS chosen,
           coalesce(string_agg(head || body, '' ORDER BY i) FILTER (WHERE NOT c AND i > n), '') AS rejected,
           coalesce(sum(length(body)) FILTER (WHERE c AND i > n AND train), 0)::BIGINT AS chosen_trained_chars,
           coalesce(sum(length(body)) FILTER (WHERE NOT c AND i > n AND train), 0)::BIGINT AS rejected_trained_chars
    FROM cut JOIN t USING (pair_id) GROUP BY pair_id
    """,
)
def op6_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # conversations 2k and 2k + 1 are a pair, the even one is chosen
    turns = table(spark, sf_dir, "conversations").select(
        F.floor(F.col("conv_id") / 2).alias("pair_id"), (F.col("conv_id") % 2 == 0).alias("is_chosen"), "turn", "role", "text"
    )
    return _pair_columns(preference.format_pairs(turns))


def _pair_columns(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "pair_id",
        "n_prompt_turns",
        "prompt",
        "chosen",
        "rejected",
        F.expr(preference.trained_chars("chosen_segments")).alias("chosen_trained_chars"),
        F.expr(preference.trained_chars("rejected_segments")).alias("rejected_trained_chars"),
    )


# The pairs above are unrelated conversations, so their prompts are empty.  Here
# every conversation is preferred to itself with another answer in the end.
_SWAPPED = """
    WITH ends AS (
        SELECT conv_id, max(turn) AS turn FROM conversations WHERE role = 'assistant' GROUP BY conv_id
    ), answers AS (
        SELECT conv_id, turn, max(text) AS answer FROM conversations JOIN ends USING (conv_id, turn)
        WHERE role = 'assistant' GROUP BY conv_id, turn
    ), sides AS (
        SELECT conv_id AS pair_id, true AS c, turn, role, text FROM conversations
        UNION ALL
        SELECT v.conv_id, false, v.turn, v.role,
               CASE WHEN v.role = 'assistant' AND v.turn = a.turn THEN coalesce(b.answer, '') ELSE v.text END
        FROM conversations v LEFT JOIN answers a ON a.conv_id = v.conv_id
        LEFT JOIN answers b ON b.conv_id = v.conv_id + 1 - 2 * (v.conv_id % 2)
    ), t AS (
        SELECT pair_id, c, role AS own_role, text AS own_text,
               row_number() OVER (PARTITION BY pair_id, c ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i,"""


def _answer_swapped(turns: DataFrame) -> DataFrame:
    """``pair_id, is_chosen, turn, role, text``: every conversation, and as the
    rejected one its copy whose last assistant turn has the text of its
    neighbour's (ids 2k and 2k + 1; empty without one)."""
    last = F.max(F.when(F.col("role") == "assistant", F.struct("turn", "text")))
    ends = turns.groupBy("conv_id").agg(last.alias("end")).where("end.turn is not null")
    swap = ends.join(
        ends.select((F.col("conv_id") + 1 - 2 * (F.col("conv_id") % 2)).alias("conv_id"), F.col("end.text").alias("answer")),
        "conv_id",
        "left",
    ).select("conv_id", F.col("end.turn").alias("at"), "answer")
    here = (F.col("role") == "assistant") & (F.col("turn") == F.col("at"))
    text = F.when(here, F.coalesce("answer", F.lit(""))).otherwise(F.col("text"))
    side = lambda df, chosen, t: df.select(
        F.col("conv_id").alias("pair_id"), F.lit(chosen).alias("is_chosen"), "turn", "role", t.alias("text")
    )
    return side(turns, True, F.col("text")).unionByName(side(turns.join(swap, "conv_id", "left"), False, text))


_PAIRS_SQL = ORACLE_SQL["op6_preference_pairs"]


@register(
    "preference_answers_swapped",
    _SWAPPED
    + _PAIRS_SQL[_PAIRS_SQL.index("\n               '<|im_start|>'") :].replace(
        "FROM conversations WHERE conv_id IS NOT NULL", "FROM sides WHERE pair_id IS NOT NULL", 1
    ),
)
def preference_answers_swapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pair_columns(preference.format_pairs(_answer_swapped(table(spark, sf_dir, "conversations"))))


@register("op7_sentencepiece_viterbi")
def op7_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return viterbi.round_trip(docs, tokenizer_path("piece_bpe_32k.model"))


def _clustering_sql(rounds: int = laesa.ROUNDS) -> str:
    """One pair of steps per round: vectors to the nearest centroid, centroids
    to the floor of the mean."""
    steps = [
        """v AS MATERIALIZED (
        SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings WHERE len(embedding) = 64
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ), c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v
        FROM v ORDER BY 1 LIMIT 8
    )"""
    ]
    near = """a{i} AS MATERIALIZED (
        SELECT r, min(d) AS d, arg_min(c, d * 8 + c) AS c FROM (
            SELECT v.r, c.c, list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
            FROM v, c{i} c) GROUP BY r
    )"""
    move = """c{j} AS MATERIALIZED (
        SELECT c{i}.c, coalesce(m.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
            SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY k) AS v FROM (
                SELECT c, k, sum(x)::BIGINT AS s, count(*) AS n FROM (
                    SELECT a{i}.c, unnest(v.v) AS x, unnest(range(64)) AS k FROM v JOIN a{i} USING (r))
                GROUP BY c, k) GROUP BY c) m ON m.c = c{i}.c
    )"""
    for i in range(rounds):
        steps += [near.format(i=i), move.format(i=i, j=i + 1)]
    steps.append(near.format(i=rounds))
    return f"""
    WITH {", ".join(steps)}
    SELECT v.vec_id, a.c::INTEGER AS cluster, a.d AS distance,
           (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia,
           sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM v JOIN a{rounds} a USING (r) JOIN c{rounds} c ON c.c = a.c
    """


@register("op11_laesa_clusters", _clustering_sql())
def op11_laesa_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return laesa.report(laesa.cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding")))


@register(
    "op12_fenwick_infill",
    r"""
    WITH units AS (
        SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
               regexp_extract_all(coalesce(text, ''), '[ 	-
]*[^ 	-
]+|[ 	-
]+') AS u
        FROM documents
    ), draws AS (
        SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
               ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM units
    ), cuts AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50
                    THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
        FROM draws
    ), parts AS (
        SELECT doc_id, n, form, t, coalesce(array_to_string(u[1:a], ''), '') AS p,
               coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:], ''), '') AS s
        FROM cuts
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                            ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM parts
    """,
)
def op12_fenwick_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.transform(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restore(), 256).alias("restored_sha256"),
    )


@register(
    "op13_relative_lz_dedup",
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id,
               list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-
]+'), lambda x: x <> '') AS w
        FROM documents
    ), win AS (
        SELECT r, doc_id, i, sha256(array_to_string(w[i:i + 12], ' ')) AS x
        FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)
    ), firsts AS (
        SELECT x, min(doc_id) AS first FROM win GROUP BY x HAVING min(doc_id) < max(doc_id)
    ), spans AS (
        SELECT r, list(DISTINCT i + j) AS gone FROM win JOIN firsts USING (x), range(13) AS t(j)
        WHERE first < doc_id GROUP BY r
    ), left_over AS (
        SELECT r, doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
               list_filter(w, lambda x, i: NOT list_contains(coalesce(gone, []), i)) AS kept
        FROM d LEFT JOIN spans USING (r)
    )
    SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM left_over
    """,
)
def op13_relative_lz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = relative_lz.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return rest.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
