"""Column types of the sources that Spark parses by schema; nothing is inferred from the data."""

from pyspark.sql import types as T

RATINGS = T.StructType(
    [
        T.StructField("rating_key", T.LongType()),
        T.StructField("movie_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("rating", T.IntegerType()),
        T.StructField("watch_date", T.DateType()),
    ]
)
