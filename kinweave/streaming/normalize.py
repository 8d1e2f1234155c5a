"""Streams of raw records, normalised and joined to static records by exact key."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import preprocess
from ..operators.blocking import compatible


def exact_matches(stream: DataFrame, static: DataFrame) -> DataFrame:
    """Stream of S1 records with static processed records of the same name and a compatible country."""
    s = preprocess(stream, ngrams=False).where("name_norm <> ''").select(F.col("entity_id").alias("s"), "name_norm", F.col("country_norm").alias("sc"))
    c = static.select(F.col("entity_id").alias("c"), "name_norm", F.col("country_norm").alias("cc"))
    return s.join(c, "name_norm").where(compatible(F.col("sc"), F.col("cc"))).select("s", "c")
