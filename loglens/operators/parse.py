"""Parse family: envelope decode, access-log parse, typing, enrichment.

All operators are map-only ``DataFrame -> DataFrame`` projections and work
unchanged on batch and streaming input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.functions import parsing as fx
from loglens.functions import patterns as P


def decode(envelope: DataFrame) -> DataFrame:
    """Kafka record -> key/value as text, plus topic, partition, offset, timestamp.

    A lake partition column ``date`` is passed through so later time-range
    filters can prune partitions.
    """
    extra = ["date"] if "date" in envelope.columns else []
    return envelope.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp", *extra)


def parse_access(decoded: DataFrame, keep: tuple[str, ...] = ("key", "timestamp"),
                 single_pass: bool = True) -> DataFrame:
    """Extended access-log line -> seven string fields.

    A line that does not match yields '' in every field (it is kept, and
    counts in the metrics); a NULL line yields NULLs.
    """
    if single_pass:
        return fx.with_groups(decoded, "value", P.EXTENDED_PATTERN, P.EXTENDED_FIELDS, list(keep))
    return decoded.select(*keep, *fx.extract_groups_naive(
        F.col("value"), P.EXTENDED_PATTERN, P.EXTENDED_FIELDS))


def parse_access_matched(decoded: DataFrame, keep: tuple[str, ...] = ("key", "timestamp")
                         ) -> DataFrame:
    """``parse_access`` restricted to lines the extended pattern matches,
    with one regex pass per line (see ``parsing.with_groups_matched``)."""
    return fx.with_groups_matched(decoded, "value", P.EXTENDED_PATTERN, P.EXTENDED_FIELDS,
                                  list(keep))


def typed(parsed: DataFrame) -> DataFrame:
    """Add status_code_int, bytes_int (int, NULL if absent/overflowing), timestamp_ts."""
    return parsed.withColumns({
        "status_code_int": fx.to_int(F.col("status")),
        "bytes_int": fx.to_int(F.col("bytes")),
        "timestamp_ts": F.col("timestamp").cast("timestamp"),
    })


def parse_any(decoded: DataFrame, keep: tuple[str, ...] = ("offset",),
              single_pass: bool = True) -> DataFrame:
    """Common or extended line -> eight string fields (remote_user included)."""
    if single_pass:
        return fx.with_groups(decoded, "value", P.ANY_PATTERN, P.ANY_FIELDS, list(keep))
    return decoded.select(*keep, *fx.extract_groups_naive(
        F.col("value"), P.ANY_PATTERN, P.ANY_FIELDS))


def enrich(parsed: DataFrame, keep: tuple[str, ...] = ("offset",),
           drop_unparsed: bool = True) -> DataFrame:
    """Parsed rows only -> event time, method/uri/protocol, endpoint, status class, bytes.

    Unparsed rows are dropped through a generator, so the line is not parsed
    a second time for the filter. Pass ``drop_unparsed=False`` when the input
    is already restricted to matching lines (``parse_access_matched``).
    """
    src = fx.keep_where(parsed, F.col("status") != "") if drop_unparsed else parsed
    base = src.select(*keep, "ip", "datetime", "status", "bytes", "request")
    # method / uri / protocol in one regex pass over the request line
    split = fx.with_groups(base, "request", P.REQUEST_PATTERN, ("method", "uri", "protocol"),
                           list(keep) + ["ip", "datetime", "status", "bytes"], keep_source=True)
    return split.select(
        *keep,
        fx.access_time(F.col("datetime")).alias("event_time"),
        "ip", "method", "uri", "protocol",
        fx.endpoint_of(F.col("request")).alias("endpoint"),
        fx.status_class_of(F.col("status")).alias("status_class"),
        fx.to_long(F.col("bytes")).alias("bytes_long"),
    )


def line_class(decoded: DataFrame) -> DataFrame:
    """Tag each record: null / parsed_elf / parsed_other / unparsed."""
    elf = F.col("value").rlike(P.EXTENDED_PATTERN)
    other = F.col("value").rlike(P.ANY_PATTERN)
    cls = (F.when(F.col("value").isNull(), F.lit("null"))
           .when(elf, F.lit("parsed_elf"))
           .when(other, F.lit("parsed_other"))
           .otherwise(F.lit("unparsed")))
    return decoded.withColumn("line_class", cls)


def parse_quality(decoded: DataFrame) -> DataFrame:
    """Line counts per parse class (map-side combined, one tiny shuffle)."""
    return line_class(decoded).groupBy("line_class").agg(F.count(F.lit(1)).alias("line_count"))


def quarantine_split(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed extended lines, everything else) for a dead-letter sink."""
    tagged = line_class(decoded)
    good = tagged.where(F.col("line_class") == "parsed_elf").drop("line_class")
    bad = tagged.where(F.col("line_class") != "parsed_elf")
    return good, bad
