"""The given tables in the roles of files, events, pages and failures. Each view keeps every row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.binary import b64_encode
from folioflow.operators.chunks import line_blocks
from folioflow.sources.files import open_root
from folioflow.sources.tables import read_spread

BUCKET = "corpus"
# Extension by doc_id mod 6.
EXTENSIONS = [".pdf", ".PDF", ".png", ".xlsx", ".txt", ".pdf"]


# Tables with enough work per row to be worth spreading when they come in one split.
SPREAD = {"documents", "pages", "lineitem"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    path = f"{sf}/{name}.parquet"
    return read_spread(spark, path) if name in SPREAD else spark.read.parquet(path)


def files(spark: SparkSession, sf: str) -> DataFrame:
    """``bucket, name, doc_id, text``: documents as stored objects of all types."""
    kind = F.element_at(F.array(*[F.lit(e) for e in EXTENSIONS]), (F.col("doc_id") % 6 + 1).cast("int"))
    return table(spark, sf, "documents").select(
        F.lit(BUCKET).alias("bucket"),
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), kind).alias("name"),
        "doc_id",
        "text",
    )


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """Names of all objects, with a folder marker per source."""
    markers = table(spark, sf, "documents").select(F.lit(BUCKET).alias("bucket"), F.concat("source", F.lit("/")).alias("name"))
    return files(spark, sf).select("bucket", "name").unionByName(markers.distinct())


def envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, message``: one event per file. Of seven, one has no name, one no base64, one
    text after its JSON."""
    kind = F.col("doc_id") % 7
    whole = F.concat(F.lit('{"bucket":"'), F.col("bucket"), F.lit('","name":"'), F.col("name"), F.lit('"}'))
    payload = F.when(kind == 0, F.concat(F.lit('{"bucket":"'), F.col("bucket"), F.lit('"}'))).when(
        kind == 2, F.concat(whole, F.lit(" tail"))
    ).otherwise(whole)
    data = F.when(kind == 1, "!!!").otherwise(b64_encode(F.encode(payload, "UTF-8")))
    return files(spark, sf).select("doc_id", F.struct(data.alias("data")).alias("message"))


def pages(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, bucket, name, page_num, page_text``: all documents in pages of 20 lines."""
    return line_blocks(files(spark, sf))


def keyed_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the chunk key, as pages of whatever file."""
    return pages(spark, sf).select(
        F.concat(F.lit("gs://"), "bucket", F.lit("/"), "name").alias("source_file"), F.lit("").alias("part"), "page_num", "page_text"
    )


def failures(spark: SparkSession, sf: str) -> DataFrame:
    """``event_id, error``: the events table as outcomes of model calls."""
    kind = F.col("event_type")
    error = (
        F.when(kind == "error", "ServiceUnavailable: try later")
        .when(kind == "signup", "api.exceptions.ResourceExhausted: quota")
        .when(kind == "click", "ValueError: broken file")
        .when(kind == "view", "PermissionDenied: no access")
    )
    return table(spark, sf, "events").select("event_id", "user_id", error.alias("error"))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """``id, text_embedding, multimodal_embedding``: stored vectors, the second one reversed."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").alias("text_embedding"),
        F.reverse("embedding").alias("multimodal_embedding"),
        "label",
    )


def write_objects(objects: DataFrame, root: str) -> None:
    """``name, content`` as objects below ``root``, each written by the task that holds it."""

    def run(batches):
        system, base = open_root(root)
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist()):
                path = f"{base}/{name}"
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(path) as out:
                    out.write(content)
            yield batch.slice(0, 0)

    objects.select("name", "content").mapInArrow(run, "name string, content binary").write.format("noop").mode("overwrite").save()
