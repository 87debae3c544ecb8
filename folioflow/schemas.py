"""Record layouts shared by the batch and streaming jobs."""

from pyspark.sql import types as T

ENVELOPE = T.StructType([T.StructField("message", T.StructType([T.StructField("data", T.StringType())]))])

METADATA = T.StructType(
    [
        T.StructField("summary", T.StringType()),
        T.StructField("extracted_entities", T.ArrayType(T.StringType())),
        T.StructField("document_type", T.StringType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
    ]
)

# `part` and `object_name` widen the page record so that sheets fit in and the name survives
# in a column: Spark picks the names of its own part files.
PAGE_RECORD = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("page_num", T.IntegerType()),
        T.StructField("object_name", T.StringType()),
        T.StructField("chunk_description", T.StringType()),
        T.StructField("page_text", T.StringType()),
        T.StructField("image_base64", T.StringType()),
        T.StructField("metadata", METADATA),
    ]
)

CHUNK_KEY = ["source_file", "part", "page_num"]

TEXT_DIM = 768
IMAGE_DIM = 1408

STORE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("page_num", T.IntegerType()),
        T.StructField("chunk_description", T.StringType()),
        T.StructField("metadata", T.StringType()),
        T.StructField("text_embedding", T.ArrayType(T.FloatType())),
        T.StructField("multimodal_embedding", T.ArrayType(T.FloatType())),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

EVALUATION = T.StructType(
    [
        T.StructField("prompt", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("evaluation_score", T.LongType()),
        T.StructField("evaluation_reason", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
