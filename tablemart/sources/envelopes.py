"""Source rows in the raw envelope."""

from pyspark.sql import functions as F

from tablemart.operators.ranking import number_rows


def payload_text(columns):
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def wrap_rows(frame, key, run_id, ingested_at, start=0, payload=None):
    """Envelope rows with consecutive sequence numbers in key order from `start`.

    `payload` names a ready JSON text column; by default every column of the frame becomes a
    member. A NULL or empty key stops the job when the rows are read.
    """
    text = F.col(payload) if payload else payload_text(frame.columns)
    record_id = F.col(key).cast("string")
    rows = frame.select(
        F.when(
            F.coalesce(F.length(record_id), F.lit(0)) == 0,
            F.raise_error(F.lit("source row without a record key")).cast("string"),
        ).otherwise(record_id).alias("record_id"),
        text.alias("payload"),
    )
    numbered = number_rows(rows, ["record_id", "payload"], "sequence", start)
    return numbered.select(
        "record_id",
        "payload",
        F.lit(ingested_at).alias("ingested_at_utc"),
        F.lit(run_id).alias("run_id"),
        F.col("sequence").cast("bigint").alias("sequence"),
    )
