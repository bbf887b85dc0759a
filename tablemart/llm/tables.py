"""Reading the tables and a few column expressions the operators share."""

from pyspark.sql import functions as F

#: Letters, digits and signs between these six separators make a word.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def doc_rows(documents):
    """doc_id and text only: other columns, whatever their names, stay out; null text is empty."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )


def ids_as_text(rows):
    """doc_id as text: pandas would turn whole numbers beside a null into rounded floats."""
    return rows.withColumn("doc_id", F.col("doc_id").cast("string"))


def ids_as_numbers(rows):
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def free_names(names, columns):
    """The names, made longer until no column has them."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def word_count(text):
    """Number of words of a text column, 0 for null: words start where the six separators end.

    Separators become spaces, runs of others vanish, so that one letter is left per word.
    """
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "w")
    return F.length(F.regexp_replace(marked, "[^w]", "")).cast("long")


def blocks_for(total, size):
    """How many blocks of `size` hold `total`, at least one."""
    return max(1, -(-int(total or 0) // size))
