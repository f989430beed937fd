"""Schemas and fixed value domains of the sentence tables."""

from pyspark.sql import types as T

SPLITS = ("train", "validation", "test")
SCRIPT_TYPES = ("roman_only", "mixed_script", "devanagari_only", "unknown")

SENTENCE = T.StructType(
    [
        T.StructField("sentence_id", T.LongType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("split", T.StringType(), True),
        T.StructField("text", T.StringType(), False),
        T.StructField("tokens", T.ArrayType(T.StringType()), True),
        T.StructField("lid_tags", T.ArrayType(T.StringType()), True),
    ]
)
FINAL = T.StructType(SENTENCE.fields + [T.StructField("script_type", T.StringType(), False)])

# Position of a row in load order.  ``rank`` is the place of its file in the
# manifest, ``block`` the byte offset of the file split it was read from and
# ``pos`` its place inside that split.
LOAD_ORDER = ("rank", "file", "block", "pos")

# What every reader returns: load order plus the unified columns, not yet numbered.
LOADED = T.StructType(
    [
        T.StructField("rank", T.LongType(), False),
        T.StructField("file", T.StringType(), False),
        T.StructField("block", T.LongType(), False),
        T.StructField("pos", T.LongType(), False),
    ]
    + SENTENCE.fields[1:]
)
