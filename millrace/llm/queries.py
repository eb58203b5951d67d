"""Queries of the language-model operators; ``ORACLE`` has DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    bpe,
    fuzzy,
    langid,
    licenses,
    merkle,
    packing,
    pieces,
    repeats,
    shards,
    simhash,
    suffixtree,
    topk,
    whitening,
    workers,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]):
    @wraps(run)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers.find_package(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = query
    return query


def _with_sql(sql: str):
    """Register a query together with DuckDB SQL for the same rows."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        ORACLE[run.__name__] = sql
        return _query(run)

    return register


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@_query
def op1_simhash_groups(spark, sf_dir):
    return simhash.near_groups(_documents(spark, sf_dir))


@_query
def op2_language(spark, sf_dir):
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", langid.held_out("doc_id", 4, 2))
    model = langid.fit(docs.where("not held_out"))
    return langid.identify(docs, model).select("doc_id", "held_out", "lang_pred", "score")


@_with_sql(
    """
    WITH vectors AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scores AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
        FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
        FROM scores
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """
)
def op3_maxscore(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where(topk.usable("embedding"))
    vectors = table.select("vec_id", topk.scaled("embedding").alias("vector"))
    return topk.top_k(vectors.where("vec_id % 50 = 0"), vectors)


@_query
def op4_fuzzy_hash(spark, sf_dir):
    return fuzzy.describe_documents(_documents(spark, sf_dir))


@_query
def op5_rendezvous_shards(spark, sf_dir):
    return shards.shard_documents(_documents(spark, sf_dir), [1.0] * 16)


@_query
def op6_stream_pieces(spark, sf_dir):
    return pieces.encode_documents(_documents(spark, sf_dir))


@_query
def op7_bwt_repeats(spark, sf_dir):
    found = repeats.remove_repeats(_documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@_query
def op8_suffix_tree(spark, sf_dir):
    docs = _documents(spark, sf_dir).withColumn("held_out", langid.held_out("doc_id", 5, 1))
    return suffixtree.score_documents(docs)


@_query
def op9_concat_pack(spark, sf_dir):
    return packing.pack_documents(_documents(spark, sf_dir))


_TEMPLATES = [(text, label, True) for text, label in licenses.BASE_PHRASES.items()]
_TEMPLATES += [(text, label, False) for label, own in licenses.TEMPLATES.items() for text in own]
_TEMPLATE_ROWS = ", ".join(
    f"({number}, '{text}', '{label}', {base})"
    for number, (text, label, base) in enumerate(_TEMPLATES)
)


@_with_sql(
    f"""
    WITH templates(tmpl, body, label, base) AS (VALUES {_TEMPLATE_ROWS}),
    pieces AS (SELECT *, string_split(body, ' ') AS own FROM templates),
    grams AS (
        SELECT tmpl, label, base, len(own) - {licenses.K} + 1 AS grams, tpos - 1 AS tpos, own[tpos] AS t0, own[tpos + 1] AS t1
        FROM (SELECT *, unnest(range(1, len(own))) AS tpos FROM pieces)
    ), texts AS (
        SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
        FROM documents
    ), words AS (SELECT rid, unnest(range(1, len(w))) AS p, w FROM texts),
    pairs AS (SELECT rid, p - 1 AS pos, w[p] AS a, w[p + 1] AS b FROM words),
    votes AS (
        SELECT DISTINCT rid, tmpl, label, base, grams, pos - tpos AS diag, tpos
        FROM pairs JOIN grams ON a = t0 AND b = t1
    ), diagonals AS (SELECT DISTINCT rid, tmpl, base, diag FROM votes),
    starts AS (
        SELECT *, CASE WHEN base OR coalesce(diag - lag(diag) OVER d > {licenses.SLACK}, true) THEN 1 ELSE 0 END AS s
        FROM diagonals WINDOW d AS (PARTITION BY rid, tmpl ORDER BY diag)
    ), numbered AS (
        SELECT rid, tmpl, diag, sum(s) OVER (PARTITION BY rid, tmpl ORDER BY diag) AS span FROM starts
    ), spans AS (
        SELECT v.rid, v.label, v.base, v.grams, span, min(v.diag) AS place,
            count(DISTINCT tpos)::DOUBLE / v.grams AS share
        FROM votes v JOIN numbered n ON v.rid = n.rid AND v.tmpl = n.tmpl AND v.diag = n.diag
        GROUP BY v.rid, v.tmpl, v.label, v.base, v.grams, span
    ), found AS (
        SELECT * FROM spans WHERE CASE WHEN base THEN share = 1 ELSE share >= {licenses.COVER} END
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, count(place) FILTER (base) AS n_base,
        min(place) FILTER (base) AS first_word, max(place) FILTER (base) AS last_word,
        coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
        coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
        coalesce(max(share), 0) AS score
    FROM texts LEFT JOIN found ON texts.rid = found.rid GROUP BY texts.rid, doc_id, w
    """
)
def op10_license_scan(spark, sf_dir):
    return licenses.scan_licenses(_documents(spark, sf_dir))


#: Levels that the SQL of op11 closes for documents (8 ** 10 rows of a language) and for languages.
_DOC_LEVELS, _LANG_LEVELS = 10, 5


def _part_sql(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(map(_part_sql, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


# CRC-32 of the decimal digits: each byte is added, then eight shifts are made.
_CRC_SQL = """xor(4294967295, list_reduce(
    flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0])),
    lambda a, b: CASE WHEN xor(a, b) & 1 = 1 THEN xor(xor(a, b) >> 1, 3988292384) ELSE xor(a, b) >> 1 END,
    4294967295))"""


def _levels_sql(name: str, levels: int) -> str:
    """For a table {name}0 (tree, pos, d, m): {name}K, one level further up each, and the siblings {name}sK."""
    parts = []
    for k in range(levels):
        parts.append(
            f"""{name}s{k} AS (
                SELECT tree, pos, m, array_to_string(l[1:(pos % 8)], '') AS lft,
                    array_to_string(l[(pos % 8 + 2):], '') AS rgt
                FROM (SELECT *, list(d) OVER (PARTITION BY tree, pos // 8 ORDER BY pos
                    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l FROM {name}{k})
            ), {name}{k + 1} AS (
                SELECT tree, pos // 8 AS pos, (m + 7) // 8 AS m,
                    CASE WHEN m > 1 THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE min(d) END AS d
                FROM {name}{k} GROUP BY tree, pos // 8, m
            )"""
        )
    return ", ".join(parts)


def _fold_sql(start: str, rows: str, name: str, tree: str, place: str, levels: int) -> str:
    """From {start}, with id, fold and proof, tables that add one level of {name}s each; the last is {rows}."""
    parts, last = [], start
    for k in range(levels):
        own = rows if k == levels - 1 else f"{rows}{k}"
        parts.append(
            f"""{own} AS (
                SELECT f.* EXCLUDE (fold, proof),
                    CASE WHEN s.m > 1 THEN sha256(lft || fold || rgt) ELSE fold END AS fold,
                    CASE WHEN s.m > 1 THEN proof || lft || rgt ELSE proof END AS proof
                FROM {last} f JOIN {name}s{k} s ON s.tree = f.{tree} AND s.pos = f.{place} // {8**k}
            )"""
        )
        last = own
    return ", ".join(parts)


@_with_sql(
    f"""
    WITH leaves AS (
        SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql('text')} AS leaf,
            CASE WHEN {_CRC_SQL} % 3 = 0 THEN {_leaf_sql(
                "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
            )} END AS changed
        FROM documents
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
            count(*) OVER (PARTITION BY tree) AS m
        FROM leaves
    ), d0 AS (SELECT tree, place AS pos, leaf AS d, m FROM placed),
    {_levels_sql('d', _DOC_LEVELS)},
    trees AS (
        SELECT tree, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS lang_place, count(*) OVER () AS m
        FROM d{_DOC_LEVELS}
    ), h0 AS (SELECT '' AS tree, lang_place AS pos, subroot AS d, m FROM trees),
    {_levels_sql('h', _LANG_LEVELS)},
    start AS (
        SELECT doc_id, leaf, tree, place, subroot, lang_place, '' AS top, coalesce(changed, leaf) AS fold, '' AS proof
        FROM placed JOIN trees USING (tree)
    ),
    {_fold_sql('start', 'below', 'd', 'tree', 'place', _DOC_LEVELS)},
    {_fold_sql('below', 'folded', 'h', 'top', 'lang_place', _LANG_LEVELS)}
    SELECT doc_id, leaf, subroot, r.d AS root, sha256(proof) AS proof_sha256, fold AS folded_root,
        fold = r.d AS verified
    FROM folded CROSS JOIN h{_LANG_LEVELS} r
    """
)
def op11_merkle_manifest(spark, sf_dir):
    return merkle.check_documents(_documents(spark, sf_dir))


@_query
def op12_forced_bpe(spark, sf_dir):
    return bpe.digest_documents(_documents(spark, sf_dir))


@_query
def op13_exact_whitening(spark, sf_dir):
    return whitening.whiten_table(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
