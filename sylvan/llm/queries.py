"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fim, jpeg, kdtree, licences, linededup, mixing, neardup, packing, pii, secrets, spelling, toxicity, warc
from .work import table


def op1_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.NearDup(words=4))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.digest(licences.scan(table(spark, sf_dir, "documents")))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))[0].select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, conf = table(spark, sf_dir, "documents"), toxicity.Toxicity()
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), conf)
    return toxicity.scored(docs, model, conf).select("doc_id", toxicity.held_out(conf).alias("held_out"), "score", "predicted")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op7_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(linededup.repeats(table(spark, sf_dir, "documents")))


def op8_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.top_k(table(spark, sf_dir, "embeddings"))


def op9_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jpeg.features(jpeg.media(table(spark, sf_dir, "documents"))).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height", F.sha2("thumbnail", 256).alias("thumbnail_sha256")
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digest(pii.scan(docs, pii.train(docs)))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(fim.transformed(table(spark, sf_dir, "documents")))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_neardup, op2_licences, op3_warc, op4_secrets, op5_toxicity, op6_mixing, op7_linededup, op8_kdtree, op9_jpeg, op10_packing, op11_pii, op12_fim, op13_spelling)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op1_neardup": neardup.SQL, "op2_licences": licences.SQL, "op3_warc": warc.SQL, "op4_secrets": secrets.SQL, "op8_kdtree": kdtree.SQL, "op12_fim": fim.SQL, "op13_spelling": spelling.SQL}
