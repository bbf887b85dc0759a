"""From raw documents to packed sequences: five stages, each on all that the one before it kept."""

import public_tokenizers
from pyspark.sql import functions as F

from tablemart.llm.jaccard_join import ngram_components
from tablemart.llm.mixing import mix_sources
from tablemart.llm.packing import pack_documents
from tablemart.llm.quality import keep_good
from tablemart.llm.substring_dedup import deduplicated_documents
from tablemart.llm.tables import free_names, read
from tablemart.session import apply_settings
from tablemart.storage import via_table

#: SQL can say neither a trained classifier nor token ids.
ORACLE_SQL = None


def quality(spark, docs, sf_dir):
    """Rows whose text the classifier does not reject, whatever their doc_id."""
    return keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    """One row of each group of linked rows: the one with the smallest doc_id (null last), and of equal
    ones one. Rows are told apart by a number stored with them, not by doc_id."""
    rows, row = _with_rows(docs)
    found = ngram_components(rows.select(F.col(row).alias("doc_id"), "text"))
    found = found.select(F.col("doc_id").alias(row), F.col("component_id").alias("_group"))
    members = via_table(found.join(rows.select(row, "doc_id"), row), "members")
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    groups = members.groupBy("_group").agg(F.min(first).alias("_first"), F.count("*").alias("_size")).filter("_size > 1")
    # Stored, so that the join shuffles both sides for itself and Spark can split a group of very many rows.
    dropped = members.join(via_table(groups, "groups"), "_group").filter(F.col(row) != F.col("_first.row")).select(row)
    return rows.join(dropped, row, "left_anti").select(*docs.columns)


def substrings(spark, docs, sf_dir):
    """Documents without the words that a smaller doc_id holds in the same windows; n_chars follows the
    new text. A document may lose all its words; the mix takes none of it then."""
    left = deduplicated_documents(docs)
    if "n_chars" in left.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left


def _with_rows(docs):
    """The documents stored once with a number for each row, and the name of that column. Numbers follow
    the input splits, so a second scan could give other ones: all that uses them reads the stored rows."""
    row = free_names(["_row"], docs.columns)[0]
    return via_table(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def mixed(spark, docs, sf_dir):
    """Each document as often as the mix takes it, as rows of its own with the same columns.

    Rows are told apart by a number stored with them, so that repeated and null ids count too.
    """
    rows, row = _with_rows(docs)
    copies, copy = free_names(["_copies", "_copy"], docs.columns)
    taken = mix_sources(rows.select(F.col(row).alias("doc_id"), "text", "source")).filter("taken > 0")
    taken = taken.select(F.col("doc_id").alias(row), (F.col("taken") / F.col("size")).cast("int").alias(copies))
    return rows.join(taken, row).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def packed(spark, docs, sf_dir):
    """Places of all pieces in sequences of 2048 tokens; copies of a document are numbered from 0."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


def _settled(stage):
    """The stage with the library's session settings."""
    return lambda spark, docs, sf_dir: stage(apply_settings(spark), docs, sf_dir)


STAGES = [
    ("quality classifier", _settled(quality)),
    ("n-gram Jaccard join", _settled(near_duplicates)),
    ("substring dedup", _settled(substrings)),
    ("mixing sources", _settled(mixed)),
    ("best-fit packing", _settled(packed)),
]


def run(spark, sf_dir):
    """The stages in turn over the documents of sf_dir, each written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = via_table(docs, f"stage-{number}")
    return docs
