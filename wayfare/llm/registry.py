"""The registered queries of this subpackage and, where SQL can state them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import (
    centroids, elias_fano, packing, pii, prefix_bpe, repetition, secrets, simhash, substrings, turns,
    urls, vafile, weak_labels,
)
from wayfare.llm.common import table
from wayfare.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(configure(spark), folder)

        QUERIES[name] = run
        return run

    return add


@query("op1_pii_disclosure")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_spans(table(spark, folder, "documents"))
    return found.select(
        "doc_id", *(f"n_{kind}" for kind in pii.KINDS), F.sha2("base", 256).alias("base_sha256"), "spans"
    )


@query("op2_vector_approximation")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    asked = F.col("vec_id") % vafile.QUERY_STEP == 0
    return vafile.top_k(table(spark, folder, "embeddings"), asked)


ORACLE["op2_vector_approximation"] = vafile.SQL


@query("op3_best_fit_packing")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


@query("op4_repetition_rules")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = repetition.quality_figures(table(spark, folder, "documents"), "q")
    names = [name for name, _ in repetition.FIELDS]
    return found.select("doc_id", *(F.col(f"q.{name}").alias(name) for name in names))


@query("op5_prefix_bpe")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_bpe.round_trip_digests(table(spark, folder, "documents"))


@query("op6_simhash_bktree")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id", simhash.fingerprint_hex(F.col("_fp")).alias("fingerprint"), "component_id"
    )


@query("op7_secret_owners")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digests(table(spark, folder, "documents"))


ORACLE["op7_secret_owners"] = secrets.SQL


@query("op8_url_lists_as_of")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return urls.blocked(urls.captures_from(pages), urls.entries_from(pages)).select(
        "page_id", "host", F.col("fetched").cast("string").alias("fetched"), "n_entries", "categories",
        F.col("since").cast("string").alias("since"),
    )


ORACLE["op8_url_lists_as_of"] = urls.SQL


@query("op9_weak_label_classifier")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = weak_labels.classify(docs, table(spark, folder, "labels"), "s")
    return found.select(
        "doc_id", F.round("s.p_junk", 6).alias("p_junk"), F.round("s.p_toxic", 6).alias("p_toxic"),
        F.col("s.kept").alias("kept"),
    )


@query("op10_elias_fano_ids")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return elias_fano.write_and_read(spark, table(spark, folder, "documents"))


@query("op11_incremental_centroids")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    found = centroids.cluster_vectors(table(spark, folder, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256")
    )


ORACLE["op11_incremental_centroids"] = centroids.SQL


@query("op12_grammar_turn_repair")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return turns.repair(table(spark, folder, "conversations"), damage=True)


@query("op13_count_min_substrings")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op13_count_min_substrings"] = substrings.SQL
