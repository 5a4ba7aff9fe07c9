"""Small inputs that every operator must handle."""

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts, lang="en", source="src0") -> DataFrame:
    """Documents numbered from 0; an item is a text or a tuple of columns."""
    rows = [
        t if isinstance(t, tuple) else (i, t, lang, source, None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def awkward(spark: SparkSession) -> DataFrame:
    """Null columns, empty and long texts, repeated rows, odd characters."""
    long = " ".join(f"word{i % 977} and" for i in range(30_000))
    rows = [
        (1, None, "en", "src0", None),
        (2, "", "en", "src0", 0),
        (3, "  \n\t\n ", None, None, 6),
        (4, long, "en", "src1", len(long)),
        (5, "one line\nand one more line here", "en", "src1", 31),
        (5, "one line\nand one more line here", "en", "src1", 31),
        (6, "one line\nand one more line here", None, "src2", 31),
        (None, "no id here at all", "de", None, 17),
        (8, "\U0001f600 éß 中文 \u0000 1234 !!", "fr", "src2", 18),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def clashing(df: DataFrame) -> DataFrame:
    """The same rows with extra columns named like those that operators make."""
    from pyspark.sql import functions as F

    names = "url u v unit h vector slice seq ghost spans key count n score rank bucket node tokens".split()
    return df.select("*", *[F.lit(1).alias(n) for n in names if n not in df.columns])
