"""WARC not-modified revisits: as-of join to the latest earlier full response of the same canonical URL.

A capture record has an id, a url, a time, a flag (full response or not-modified revisit), validators (etag,
last_modified) and a header map. For each revisit the latest full response of its canonical URL that is strictly earlier is looked up and
its validators are checked: an etag in the revisit must equal the original's (``W/`` ignored: revalidation compares
weakly); without one its last_modified must equal the original's. The state is ``resolved``, ``unverified`` (the revisit has no
validator), ``mismatch`` or ``no_original``. Headers of a resolved or unverified revisit are the original's, with
those of the not-modified response laid over them, save the ones that describe the stored body or the connection.

The join is a sort, not a window over a URL: records are range-partitioned by (URL, time), so a URL with any share of
all records is spread over many tasks. Each task looks back within its own range; what crosses a border is the last full response of
each (range, URL), a small table that carries it on to the later ranges of that URL. Only record
metadata moves; a body is joined by the resolved id when it is wanted (``attach_body``).

Edge cases: a null url or time never resolves (``no_original``) and a full response with either is never an original.
Of full responses at one time the one with the largest id counts as the latest. Header names match in any case and keep
theirs; a null header map is empty. Page ids beyond 2^60 give record ids by hash. Repeated rows are resolved each on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finsight.llm.common import prepare, written

#: Header fields a not-modified response must not replace (body metadata and connection fields).
KEPT_FIELDS = ("connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type",
               "digest", "keep-alive", "proxy-authenticate", "proxy-connection", "te", "trailer", "transfer-encoding",
               "upgrade")


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port; no scheme, fragment, tracking parameter or last slash; sorted query."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.array_join(F.array_sort(F.filter(
        F.split(F.regexp_extract(bare, r"^[^?]*\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.startswith("utm_"))), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def merged_headers(original: Column, update: Column) -> Column:
    """The stored headers with the permitted ones of the not-modified response laid over them, whatever the case of their names."""
    none = F.create_map().cast("map<string,string>")
    stored = F.coalesce(original, none)
    laid = F.map_filter(F.coalesce(update, none), lambda k, v: ~F.lower(k).isin(*KEPT_FIELDS))
    names = F.transform(F.map_keys(laid), F.lower)
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.array_contains(names, F.lower(k))), laid)


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit record: record_id, canonical, ts, state, original_id, original_ts, headers.

    ``records``: record_id, url, ts, is_full, etag, last_modified, headers (map of names to values)."""
    spark = prepare(records.sparkSession)
    rec = records.select(
        F.col("record_id").alias("rid"), canonical_url(F.col("url")).alias("curl"), F.col("ts").alias("ts"),
        (F.coalesce(F.col("is_full"), F.lit(False)) & F.col("url").isNotNull() & F.col("ts").isNotNull()).alias("original"),
        F.coalesce(F.col("is_full"), F.lit(False)).alias("is_full"),
        F.col("etag").alias("etag"), F.col("last_modified").alias("lm"), F.col("headers").alias("headers"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # revisits before full responses of the same time: an original is strictly earlier
    ranged = written(rec.repartitionByRange(ranges, "curl", "ts", "original", "rid")
                     .withColumn("at", F.spark_partition_id()))
    held = F.when(F.col("original"), F.struct("rid", "ts", "etag", "lm", "headers"))
    within = Window.partitionBy("at", "curl").orderBy("ts", "original", "rid") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = ranged.withColumn("near", F.last(held, ignorenulls=True).over(within)).filter(~F.col("is_full"))
    last = ranged.filter("original").groupBy("at", "curl").agg(
        F.max_by(F.struct("rid", "ts", "etag", "lm", "headers"), F.struct("ts", "rid")).alias("full"))
    # one row for each range that a URL spans
    spans = ranged.select("at", "curl").distinct().join(last, ["at", "curl"], "left")
    before = Window.partitionBy("curl").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.withColumn("far", F.last("full", ignorenulls=True).over(before)) \
        .filter("far is not null").select("at", "curl", "far")
    found = near.join(carried, ["at", "curl"], "left") \
        .withColumn("full", F.when(F.col("curl").isNotNull() & F.col("ts").isNotNull(), F.coalesce("near", "far")))
    tag = lambda c: F.regexp_replace(c, r"^W/", "")
    same = F.when(F.col("etag").isNotNull(), tag(F.col("etag")).eqNullSafe(tag(F.col("full.etag")))) \
        .otherwise(F.col("lm").eqNullSafe(F.col("full.lm")))
    state = F.when(F.col("full").isNull(), "no_original") \
        .when(F.col("etag").isNull() & F.col("lm").isNull(), "unverified") \
        .when(same, "resolved").otherwise("mismatch")
    return found.withColumn("state", state).select(
        F.col("rid").alias("record_id"), F.col("curl").alias("canonical"), "ts", "state",
        F.when(F.col("state").isin("resolved", "unverified"), F.col("full.rid")).alias("original_id"),
        F.when(F.col("state").isin("resolved", "unverified"), F.col("full.ts")).alias("original_ts"),
        F.when(F.col("state").isin("resolved", "unverified"),
               merged_headers(F.col("full.headers"), F.col("headers"))).alias("headers"))


def attach_body(resolved: DataFrame, bodies: DataFrame, id_col: str = "record_id", body_col: str = "body") -> DataFrame:
    """Resolved revisits with the body of their original."""
    return resolved.join(bodies.select(F.col(id_col).alias("original_id"), F.col(body_col).alias(body_col)),
                         "original_id", "left")


FITS = (1 << 60) - 1


def captures_of(pages: DataFrame) -> DataFrame:
    """Capture records of a crawl that visits each page several times, derived from the page rows.

    A page is visited 1 + page_id % 5 times. The first visit is a full response (but for every seventh page, whose
    first one is lost), a later one in most cases a not-modified revisit; some miss a validator or have another etag."""
    wide = F.col("page_id").between(-FITS, FITS)  # eight times it is a long
    visits = pages.select(F.when(wide, F.col("page_id")).otherwise(F.col("page_id") % FITS).alias("page_id"),
                          F.when(~wide, F.col("page_id")).alias("far_id"), "url", F.md5(F.coalesce(F.col("html"), F.lit("")).cast("binary")).alias("digest"),
                          F.length(F.coalesce(F.col("html"), F.lit(""))).alias("size"),
                          F.explode(F.sequence(F.lit(0), F.coalesce(F.col("page_id") % 5, F.lit(0)))).alias("visit"))
    mark = (F.col("page_id") + F.col("visit")) % 11
    full = F.when(F.col("visit") == 0, F.col("page_id") % 7 != 0).otherwise(mark == 3)
    etag = F.concat(F.substring("digest", 1, 12), F.when(mark == 5, F.lit("-changed")).otherwise(F.lit("")))
    modified = F.concat(F.lit("day "), (F.col("page_id") % 365).cast("string"))
    date = F.concat(F.lit("visit "), F.col("visit").cast("string"))
    headers = F.create_map(
        F.lit("date"), date, F.lit("content-length"), F.when(full, F.col("size")).otherwise(F.lit(0)).cast("string"),
        F.lit("cache-control"), F.concat(F.lit("max-age="), (F.col("visit") * 60).cast("string")),
        F.when(full, F.lit("content-type")).otherwise(F.lit("x-cache")),
        F.when(full, F.lit("text/html")).otherwise(F.lit("hit")))
    return visits.select(
        F.when(F.col("far_id").isNull(), F.col("page_id") * 8 + F.col("visit"))
        .otherwise(F.xxhash64("far_id", "visit")).alias("record_id"), "url",
        (F.col("page_id") % 1000 * 10 + F.col("visit") * 3600).cast("long").alias("ts"), full.alias("is_full"),
        F.when(mark != 7, F.when(mark == 9, F.concat(F.lit("W/"), etag)).otherwise(etag)).alias("etag"),
        F.when(mark != 8, modified).alias("last_modified"), headers.alias("headers"))


def report(pages: DataFrame) -> DataFrame:
    """The revisits of the derived captures; headers as sorted ``name: value`` lines."""
    lines = F.array_join(F.array_sort(F.transform(
        F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")
    return resolve(captures_of(pages)).withColumn("headers", lines)
