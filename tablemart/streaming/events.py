"""New event documents as they arrive, with the result of the batch job."""

from tablemart.contracts import DEFAULT_SOURCE
from tablemart.jobs import cdc_lake
from tablemart.sources.files import DOCUMENT_GLOB


def document_stream(spark, path, files_per_batch=None, glob=DOCUMENT_GLOB):
    """One row per new document: per *.json file, or per line of the files of another glob.

    One file per event makes the listing grow with the events; sources with many of them should
    collect them as lines.
    """
    reader = (
        spark.readStream.schema("value string")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .option("wholetext", glob == DOCUMENT_GLOB)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format("text").load(path).selectExpr("value", "_metadata.file_path AS source_file")


def stream_cdc(
    spark, path, root, checkpoint, source=DEFAULT_SOURCE, files_per_batch=None, glob=DOCUMENT_GLOB
):
    """Run the batch job on every micro-batch of new files, then stop when none are left.

    The checkpoint remembers which files were taken. A batch that failed half way is given
    again with the same files; every step of the job absorbs the replay, so the tables end up
    as after one batch run over all files. State needs no watermark: a late event loses
    against the higher sequence already stored for its record.
    """

    def take(batch, _):
        cdc_lake(batch.sparkSession, batch, root, source, scope="touched")

    query = (
        document_stream(spark, path, files_per_batch, glob)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(take)
        .start()
    )
    return query
