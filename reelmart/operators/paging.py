"""Pages of landed events and what is known about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmart.functions.scalars import page_name
from reelmart.session import cut_lineage

# Rows per page and the safety limit of pages.
PER_PAGE = 100
MAX_PAGES = 10_000


def number_within(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Number the rows 1..n per key in ``order``, as column ``row_no``.

    No key is ever gathered in one task: the rows are cut into sorted slices of similar
    size, in which running ids follow the order, and an id becomes a number by the least id
    of its slice and key and the rows the key has in earlier slices. Wide rows are shuffled
    once. Slice bounds come from sampling, hence the written table in between. ``order``
    must be total within a key.
    """
    sliced = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    numbered = sliced.withColumn("_id", F.monotonically_increasing_id())
    frozen = cut_lineage(numbered.withColumn("_slice", F.shiftright("_id", 33)), "numbered")
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    runs = frozen.groupBy("_slice", key).agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_rows"))
    # a row per slice and key, written so that its size is known to whoever joins it
    shift = cut_lineage(
        runs.select(
            F.col("_slice").alias("_of"),
            F.col(key).alias("_key"),
            (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_least") + 1).alias("_shift"),
        ),
        "shifts",
    )
    same = (F.col("_slice") == F.col("_of")) & F.col(key).eqNullSafe(F.col("_key"))
    return (
        frozen.join(shift, same)
        .withColumn("row_no", F.col("_id") + F.col("_shift"))
        .drop("_slice", "_id", "_shift", "_of", "_key")
    )


def page_of(row_no: Column, per_page: int) -> Column:
    return F.ceil(row_no / F.lit(per_page)).cast("long")


def assign_pages(df: DataFrame, key: str, order: list[str], per_page: int = PER_PAGE) -> DataFrame:
    """The page of every row, as column ``page``."""
    return number_within(df, key, order).withColumn("page", page_of(F.col("row_no"), per_page))


def trailing_pages(keys: DataFrame, rows: DataFrame, key: str, per_page: int = PER_PAGE) -> DataFrame:
    """The empty last page of every key whose rows fill their pages exactly, or that has none.

    The last page is always short, so n rows make n div per_page + 1 pages. At most
    one page per key, however many rows it has.
    """
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = F.coalesce("_rows", F.lit(0).cast("long"))
    return (
        keys.select(key).distinct().join(sizes, key, "left")
        .filter(total % per_page == 0)
        .select(key, (F.floor(total / F.lit(per_page)) + 1).alias("page"))
    )


def page_spine(
    keys: DataFrame, rows: DataFrame, key: str, order: list[str], per_page: int = PER_PAGE
) -> DataFrame:
    """All pages of every key with their row counts, empty last pages included."""
    filled = assign_pages(rows.select(key, *order), key, order, per_page)
    counted = filled.groupBy(key, "page").agg(F.count(F.lit(1)).alias("records"))
    empty = trailing_pages(keys, filled, key, per_page).withColumn("records", F.lit(0).cast("long"))
    return counted.unionByName(empty)


def page_payloads(
    keys: DataFrame, rows: DataFrame, key: str, payload: list[str], order: list[str], per_page: int = PER_PAGE
) -> DataFrame:
    """One JSON array per page, empty pages included; at most ``per_page`` rows meet."""
    paged = assign_pages(rows, key, order, per_page)
    record = F.struct("row_no", F.struct(*payload).alias("record"))
    filled = paged.groupBy(key, "page").agg(
        F.count(F.lit(1)).alias("records"), F.array_sort(F.collect_list(record)).alias("_rows")
    )
    body = F.to_json(F.transform("_rows", lambda r: r["record"]), {"ignoreNullFields": "false"})
    bodies = filled.select(key, "page", "records", body.alias("body"))
    # counted in the numbered rows, which are written, so that ``rows`` are not made again
    empty = trailing_pages(keys, paged, key, per_page).select(
        key, "page", F.lit(0).cast("long").alias("records"), F.lit("[]").alias("body")
    )
    return bodies.unionByName(empty).withColumn("page", page_name(F.col("page")))


def page_completeness(
    pages: DataFrame, by: list[str], per_page: int = PER_PAGE, max_pages: int = MAX_PAGES
) -> DataFrame:
    """Per run and media, whether its pages are whole.

    ``pages`` holds one row per page file: number and records, and perhaps ``broken``.
    Complete means pages 1..n, each landed once and readable, all but the last one full,
    the last one short, none at or beyond the limit. A file without a page number is one
    page too many. All parts are plain aggregates, combined before the shuffle.
    """
    broken = F.col("broken") if "broken" in pages.columns else F.lit(False)
    single = pages.groupBy(*by, "page").agg(
        F.sum("records").alias("records"), F.count(F.lit(1)).alias("files"), F.max(broken).alias("broken")
    )
    seen = single.groupBy(*by).agg(
        F.min("page").alias("first_page"),
        F.max("page").alias("last_page"),
        F.sum("files").alias("pages"),
        F.count("page").alias("_numbers"),
        F.sum("records").alias("records"),
        F.count_if((F.col("records") == per_page) & (F.col("files") == 1)).alias("full_pages"),
        F.max_by("records", "page").alias("last_page_records"),
        F.max("broken").alias("_broken"),
    )
    gapless = (F.col("first_page") == 1) & (F.col("last_page") == F.col("_numbers")) & (F.col("_numbers") == F.col("pages"))
    filled = (F.col("full_pages") == F.col("pages") - 1) & (F.col("last_page_records") < per_page)
    at_limit = (F.col("last_page") == max_pages) & (F.col("last_page_records") >= per_page)
    over = F.coalesce((F.col("last_page") > max_pages) | at_limit, F.lit(False))
    whole = F.coalesce(gapless & filled, F.lit(False)) & ~F.col("_broken") & ~over
    return seen.withColumns({"complete": whole, "over_limit": over}).drop("_numbers", "_broken")


def require_complete(completeness: DataFrame) -> DataFrame:
    """J6 as a gate: a page limit that was hit is an error, never a cut."""
    if not completeness.filter(~F.col("complete")).isEmpty():
        raise ValueError("landed pages are incomplete or the page limit was reached")
    return completeness


def endpoint_audit(objects: DataFrame, by: list[str], windows: DataFrame | None = None) -> DataFrame:
    """Pages, records and objects per media and endpoint.

    ``objects`` holds one row per landed file, or one with the number of ``objects``:
    endpoint and records; only events have more than one file per media. Dates are filled
    only for the endpoints that take a date window.
    """
    # Endpoints that are asked for a date window.
    dated = F.col("endpoint").isin("media_daily_stats", "events")
    files = F.sum("objects") if "objects" in objects.columns else F.count(F.lit(1))
    counted = objects.groupBy(*by, "endpoint").agg(
        files.alias("pages_fetched"),
        F.sum("records").alias("records_fetched"),
        files.alias("bronze_object_count"),
    )
    if windows is not None:
        counted = counted.join(windows.select("media_id", "start_date", "end_date"), "media_id", "left").withColumns({
            "start_date": F.when(dated, F.col("start_date")),
            "end_date": F.when(dated, F.col("end_date")),
        })
    return counted.withColumn("status", F.lit("SUCCESS"))


def visitor_discovery(events: DataFrame) -> DataFrame:
    """The distinct, non-empty visitor keys of landed events, sorted."""
    return (
        events.filter(F.col("visitor_key") != "")
        .select("visitor_key")
        .distinct()
        .orderBy("visitor_key")
    )
