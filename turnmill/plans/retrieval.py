"""Chunk, embedding and nearest-neighbour queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill import fixed
from turnmill.operators import ivf, models, vectors
from turnmill.plans import stubs
from turnmill.plans.inputs import table
from turnmill.session import run_dir
from turnmill.sources import collections

CELLS = 16
PROBES = 8
COLLECTION_BUCKETS = 32


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as chunks; the quality label, where there is one, is part of the metadata."""
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    entries = ("lang", "source", "n_chars", "quality")
    pairs = [part for name in entries for part in (F.lit(name), F.col(name).cast("string"))]
    return docs.select(F.col("doc_id").alias("chunk_id"), "text", F.create_map(*pairs).alias("metadata"))


def _vectors(spark: SparkSession, folder: str, key: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias(key), "embedding")


def _shown(found: DataFrame, *others: str) -> DataFrame:
    return found.select(
        "query_id", F.col("rank").cast("long").alias("rank"), "chunk_id", F.round("distance", 6).alias("distance"), *others
    )


def chunk_metadata_clean(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = _chunks(spark, folder).withColumn("metadata", vectors.clean_metadata(F.col("metadata")))
    return cleaned.select(
        "chunk_id",
        F.size("metadata").cast("long").alias("n_entries"),
        *[F.try_element_at("metadata", F.lit(k)).alias(k) for k in ("lang", "source", "n_chars", "quality")],
    )


def batch_embed(spark: SparkSession, folder: str) -> DataFrame:
    embedded = models.embed(table(spark, folder, "documents").select("doc_id", "text"), stubs.EMBEDDERS)
    return embedded.select("doc_id", *[F.round(F.get("embedding", F.lit(i)), 6).alias(f"e{i}") for i in range(4)])


def l2_normalize(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors scaled by their number first, since the given ones have unit length."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("vec_id") + 1))
    unit = table(spark, folder, "embeddings").select("vec_id", vectors.l2_normalize(scaled).alias("v"))
    return unit.select("vec_id", F.posexplode("v").alias("pos", "x")).select(
        "vec_id", F.col("pos").cast("long").alias("pos"), F.round("x", 6).alias("x")
    )


def topk_exact(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(vectors.top_k(_vectors(spark, folder, "query_id"), _vectors(spark, folder, "chunk_id")))


def topk_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The exact search for query sets too large to broadcast."""
    found = vectors.top_k_cells(
        _vectors(spark, folder, "query_id"), _vectors(spark, folder, "chunk_id"), cells=CELLS
    )
    return _shown(found)


def topk_approx(spark: SparkSession, folder: str) -> DataFrame:
    found = vectors.top_k_approx(
        _vectors(spark, folder, "query_id"), _vectors(spark, folder, "chunk_id"), cells=CELLS, probes=PROBES
    )
    return _shown(found)


def topk_retrieve(spark: SparkSession, folder: str) -> DataFrame:
    found = vectors.top_k(_vectors(spark, folder, "query_id"), _vectors(spark, folder, "chunk_id"))
    answered = vectors.retrieve(found, _chunks(spark, folder))
    return _shown(answered, "preview", F.try_element_at("metadata", F.lit("lang")).alias("lang"))


def _collection(spark: SparkSession, folder: str) -> str:
    """A collection of all documents, upserted with the labelled ones (replaced) and all pages (new)."""
    def chunk(df: DataFrame, key, text: str, version: str) -> DataFrame:
        return df.select(key.alias("chunk_id"), F.col(text).alias("text"), F.lit(version).alias("version"))

    docs = table(spark, folder, "documents")
    labelled = docs.join(table(spark, folder, "labels"), "doc_id", "left_semi")
    doc_key = F.concat(F.lit("doc"), F.col("doc_id").cast("string"))
    page_key = F.concat(F.lit("page"), F.col("page_id").cast("string"))
    batch = chunk(labelled, doc_key, "text", "new").unionByName(
        chunk(table(spark, folder, "pages"), page_key, "html", "new")
    )
    path = run_dir(spark, "collection")
    collections.upsert_collection(spark, path, chunk(docs, doc_key, "text", "old"), buckets=COLLECTION_BUCKETS)
    collections.upsert_collection(spark, path, batch)
    return path


def collection_upsert(spark: SparkSession, folder: str) -> DataFrame:
    rows = collections.read_collection(spark, _collection(spark, folder))
    return rows.select("chunk_id", "version", F.length("text").cast("long").alias("chars"))


def collection_count(spark: SparkSession, folder: str) -> DataFrame:
    rows = collections.read_collection(spark, _collection(spark, folder))
    return rows.groupBy("version").agg(F.count(F.lit(1)).alias("n"))


def topk_ivf(spark: SparkSession, folder: str) -> DataFrame:
    """The approximate search by inverted lists and quantised residuals; it has no SQL."""
    collection = _vectors(spark, folder, "chunk_id")
    return _shown(ivf.search(ivf.build(collection), _vectors(spark, folder, "query_id")))


QUERIES = {
    f.__name__: f
    for f in (
        chunk_metadata_clean,
        batch_embed,
        l2_normalize,
        topk_exact,
        topk_cells,
        topk_approx,
        topk_ivf,
        topk_retrieve,
        collection_upsert,
        collection_count,
    )
}

# Oracle --------------------------------------------------------------------------------

_DISTANCE = "list_distance({a}, {b}) * list_distance({a}, {b})"
_VECTORS = "select vec_id, embedding::double[] as e from embeddings"
_EXACT = f"""
    select query_id, rank, chunk_id, distance from (
        select *, row_number() over (partition by query_id order by distance, chunk_id) as rank from (
            select a.vec_id as query_id, b.vec_id as chunk_id, {_DISTANCE.format(a='a.e', b='b.e')} as distance
            from ({_VECTORS}) a cross join ({_VECTORS}) b))
    where rank <= {fixed.NEIGHBOURS}"""
_ROUNDED = f"select query_id, rank, chunk_id, round(distance, 6) as distance from ({_EXACT})"
_CHUNKS = """select d.doc_id as chunk_id, d.text, d.lang, d.source, d.n_chars::varchar as n_chars,
    l.quality::varchar as quality from documents d left join labels l using (doc_id)"""
_UPSERTED = """
    with docs as (select 'doc' || d.doc_id as chunk_id, d.text,
                         case when l.doc_id is null then 'old' else 'new' end as version
                  from documents d left join (select distinct doc_id from labels) l using (doc_id))
    select * from docs union all select 'page' || page_id, html, 'new' from pages"""

ORACLE = {
    "chunk_metadata_clean": f"""select chunk_id, 3 + (quality is not null)::bigint as n_entries,
        lang, source, n_chars, quality from ({_CHUNKS})""",
    "batch_embed": """
        with f as (select doc_id, length(text)::double as a,
                          (length(text) - length(replace(text, ' ', '')))::double as b,
                          (length(text) - length(replace(text, 'e', '')))::double as c from documents),
        n as (select *, sqrt(a * a + b * b + c * c + 1) as n from f)
        select doc_id, round(a / n, 6) as e0, round(b / n, 6) as e1, round(c / n, 6) as e2, round(1 / n, 6) as e3
        from n""",
    "l2_normalize": f"""
        with s as (select vec_id, [x * (vec_id + 1) for x in e] as v from ({_VECTORS})),
        n as (select vec_id, v, sqrt(list_sum([x * x for x in v])) as n from s)
        select vec_id, pos, round(v[pos + 1] / n, 6) as x
        from (select vec_id, v, n, unnest(range(len(v))) as pos from n)""",
    "topk_exact": _ROUNDED,
    "topk_cells": _ROUNDED,
    "topk_approx": f"""
        with v as ({_VECTORS}),
        p as (select e as pe, row_number() over (order by md5(vec_id::varchar), vec_id) as cell from v
              qualify cell <= {CELLS}),
        near as (select vec_id, e, cell,
                        row_number() over (partition by vec_id order by list_distance(e, pe), cell) as n
                 from v cross join p),
        found as (select a.vec_id as query_id, b.vec_id as chunk_id, {_DISTANCE.format(a='a.e', b='b.e')} as distance
                  from near a join near b using (cell) where a.n <= {PROBES} and b.n = 1)
        select query_id, rank, chunk_id, round(distance, 6) as distance from (
            select *, row_number() over (partition by query_id order by distance, chunk_id) as rank from found)
        where rank <= {fixed.NEIGHBOURS}""",
    "topk_retrieve": f"""
        select query_id, rank, chunk_id, round(distance, 6) as distance,
               substr(text, 1, {fixed.PREVIEW_CHARS}) as preview, lang
        from ({_EXACT}) join ({_CHUNKS}) using (chunk_id)""",
    "collection_upsert": f"select chunk_id, version, length(text) as chars from ({_UPSERTED})",
    "collection_count": f"select version, count(*) as n from ({_UPSERTED}) group by version",
}
