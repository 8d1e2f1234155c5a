"""Normalisation of names, addresses and countries."""
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..sources.tsv import RAW, require_columns

# Token replacements.
NAME_WORDS = {"pvt": "private", "ltd": "limited", "corp": "corporation", "co": "company", "inc": "incorporated"}
ADDRESS_WORDS = {"rd": "road", "st": "street", "ste": "suite", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "dr": "drive", "ln": "lane", "hwy": "highway", "pkwy": "parkway", "apt": "apartment", "no": "number"}


@F.pandas_udf(StringType())
def fold(s: pd.Series) -> pd.Series:
    """Trimmed text under NFKC and case folding; Spark has neither."""
    return s.fillna("").map(lambda t: unicodedata.normalize("NFKC", t.strip()).casefold())


def replace_words(c, words: dict[str, str]):
    """Whole tokens between white space, with or without a final point."""
    table = F.create_map(*[F.lit(x) for k, v in words.items() for x in (k, v, k + ".", v)])
    return F.array_join(F.transform(F.split(c, r"\s+"), lambda t: F.coalesce(F.try_element_at(table, t), t)), " ")


def plain(c):
    """Letters, digits and marks; everything else is one space between words."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[^\p{L}\p{N}\p{M}]", " "), r"\s+", " "))


def normalize_country(c):
    return plain(fold(c))


def normalize_name(c, words=NAME_WORDS):
    return plain(replace_words(F.regexp_replace(fold(c), r"\s*&\s*", " and "), words))


def normalize_address(c):
    return normalize_name(c, ADDRESS_WORDS)


def tokenize(c):
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, " "))


def char_ngrams(c, n: int = 3):
    """Character n-grams of ^text$, repeats kept; shorter text is one gram, empty text none."""
    p = F.concat(F.lit("^"), c, F.lit("$"))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(p) - n + 1, F.lit(1))), lambda i: F.substring(p, i, F.lit(n)))
    return F.when(c == "", F.array().cast("array<string>")).otherwise(grams)


def preprocess(df: DataFrame, ngram_size: int = 3, ngrams: bool = True) -> DataFrame:
    """Add normalised text, tokens, n-grams and source to raw records."""
    require_columns(df, RAW, "records")
    out = df.withColumns({"name_norm": normalize_name(F.col("business_name")), "address_norm": normalize_address(F.col("business_address")), "country_norm": normalize_country(F.col("country")), "source": F.regexp_extract(F.coalesce("entity_id", F.lit("")), "^(S[123])-", 1)})
    none = F.array().cast("array<string>")
    return out.withColumns({f"{f}_tokens": tokenize(F.col(f"{f}_norm")) for f in ("name", "address")} | {f"{f}_char_ngrams": char_ngrams(F.col(f"{f}_norm"), ngram_size) if ngrams else none for f in ("name", "address")})
