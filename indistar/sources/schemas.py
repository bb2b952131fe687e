"""Explicit read schemas of the two raw document shapes.

Reading with a fixed schema avoids an inference pass over every file and
lets the JSON reader prune columns that later steps never touch.
"""

from pyspark.sql import types as T

# The record shapes of the landed documents.
CATEGORY_MAP = T.MapType(T.StringType(), T.StringType())

CLASSIFICATION = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("nome", T.StringType()),
    T.StructField("categoria", CATEGORY_MAP),
])

PLACE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("nivel", T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("nome", T.StringType()),
    ])),
    T.StructField("nome", T.StringType()),
])

SERIES_ITEM = T.StructType([
    T.StructField("localidade", PLACE),
    T.StructField("serie", T.MapType(T.StringType(), T.StringType())),
])

RESULT = T.StructType([
    T.StructField("classificacoes", T.ArrayType(CLASSIFICATION)),
    T.StructField("series", T.ArrayType(SERIES_ITEM)),
])

# One element of the top-level array of a nested indicator document.
NESTED_VARIABLE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("variavel", T.StringType()),
    T.StructField("unidade", T.StringType()),
    T.StructField("resultados", T.ArrayType(RESULT)),
])

# One element of the top-level array of a flat daily-series document.
FLAT_ITEM_SCHEMA = T.StructType([
    T.StructField("serie", T.StringType()),
    T.StructField("codigo", T.IntegerType()),
    T.StructField("data", T.StringType()),
    T.StructField("valor", T.StringType()),
])
