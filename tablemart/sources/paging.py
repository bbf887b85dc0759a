"""Keyset pages over an end-exclusive time window."""

from pyspark.sql import functions as F


def keyset_page(frame, id_column, time_column, start, end, cursor=None, size=5_000):
    """The `size` smallest ids after the cursor inside [start, end).

    Window and cursor reach the Parquet scan as filters, and each task keeps only its own
    `size` smallest rows.
    """
    if size < 1:
        raise ValueError("page size starts at 1")
    if str(start) >= str(end):
        raise ValueError("start must be before the exclusive end")
    rows = frame.filter((F.col(time_column) >= F.lit(start)) & (F.col(time_column) < F.lit(end)))
    if cursor is not None:
        rows = rows.filter(F.col(id_column) > F.lit(cursor))
    return rows.orderBy(id_column).limit(size)


def iterate_pages(fetch, id_column, size=5_000):
    """Pages from `fetch(cursor) -> DataFrame` until one is empty or short.

    Only each page's row count and last id reach the driver. A row without id, or a page that
    does not move the cursor on, is an error of the source.
    """
    cursor = None
    while True:
        page = fetch(cursor)
        found = page.agg(
            F.count("*").alias("rows"),
            F.max(id_column).alias("last"),
            F.count_if(F.col(id_column).isNull() | (F.col(id_column).cast("string") == "")).alias("bare"),
        ).first()
        if not found["rows"]:
            return
        if found["bare"]:
            raise ValueError(f"page row without {id_column}")
        if cursor is not None and found["last"] <= cursor:
            raise ValueError("paging did not advance")
        yield page
        cursor = found["last"]
        if found["rows"] < size:
            return
