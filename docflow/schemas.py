"""Every schema the package produces, declared once."""

from pyspark.sql import types as T

# One row per listed file, whether or not its bytes can be read.
LISTING_SCHEMA = T.StructType([
    T.StructField("document_path", T.StringType(), True),
    T.StructField("file_name", T.StringType(), True),
    T.StructField("file_size", T.LongType(), True),
    T.StructField("is_file", T.BooleanType(), True),
    T.StructField("exists", T.BooleanType(), True),
])

# The same with the time of each file's last change.
DATED_LISTING_SCHEMA = T.StructType([*LISTING_SCHEMA.fields, T.StructField("modified", T.TimestampType(), True)])

RESULT_SCHEMA = T.StructType([
    T.StructField("success", T.BooleanType(), False),
    T.StructField("content", T.StringType(), True),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("file_path", T.StringType(), False),
])

# Names and order of the fields. The flat form of a result, as written to JSON lines.
OUTPUT_SCHEMA = T.StructType([
    T.StructField("document_path", T.StringType(), True),
    T.StructField("success", T.BooleanType(), True),
    T.StructField("content", T.StringType(), True),
    T.StructField("metadata", T.StringType(), True),
    T.StructField("error_message", T.StringType(), True),
])

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), True),
    T.StructField("modificationTime", T.TimestampType(), True),
    T.StructField("length", T.LongType(), True),
    T.StructField("content", T.BinaryType(), True),
])
