"""Small document tables with the awkward cases every operator must take."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string, row long, held_out string"


def words(rng, n, alphabet=("the", "and", "of", "tion", "ing", "er", "an", "re", "ou", "ble", "st", "ly")):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 4))) for _ in range(n))


def awkward(spark, extra=()):
    """Nulls, empty and long texts, ties and repeated rows, extra columns with clashing names."""
    rng = random.Random(5)
    base = [words(rng, rng.randint(8, 60)) for _ in range(24)]
    texts = [*base, base[0], base[0], base[1] + " more", None, "", " \t\n", "one", "!!! 123", "x" * 3000, words(rng, 4000),
             "Ünïcödé ▁ text\x00 with 😀", *extra]
    rows = [(i, t, ("en", "fr", None)[i % 3], None, None, 0.5, "z", 7, "h") for i, t in enumerate(texts)]
    rows += [(0, texts[0], "en", "s", 1, None, None, None, None), (None, "no id here at all", "en", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def write(frame, path, name):
    frame.write.mode("overwrite").parquet(f"{path}/{name}.parquet")


def labels_for(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int, toxic int")


def null_free(frame):
    return frame.where(F.col("doc_id").isNotNull())
