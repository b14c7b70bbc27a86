"""Text expressions: ids, time points, value lists."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, functions as F


def uuid5(name: Column, namespace: str | uuid.UUID = uuid.NAMESPACE_URL) -> Column:
    """RFC 9562 version-5 UUID of a text column, equal to Python's ``uuid.uuid5``."""
    digest = F.sha1(F.concat(F.unhex(F.lit(uuid.UUID(str(namespace)).hex)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def time_point(text: Column) -> Column:
    """ISO 8601 text of any precision -> ``yyyy-MM-ddTHH:mm:ss[.ffffff]Z`` in UTC.

    Text without an offset is taken as UTC. The result does not depend on the
    session time zone.
    """
    compact = F.regexp_replace(F.trim(text), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    zoned = compact.rlike(r"T.*(Z|[+-]\d{2}(:?\d{2})?)$")
    offset_fixed = F.regexp_replace(compact, r"([+-]\d{2})(\d{2})$", "$1:$2")
    # both branches avoid the session's wall clock, which skips and repeats hours
    micros = F.unix_micros(F.when(zoned, offset_fixed).try_cast("timestamp"))
    since_epoch = F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (micros.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    )
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    instant = F.when(zoned, epoch + since_epoch).otherwise(
        F.when(~zoned, compact).try_cast("timestamp_ntz")
    )
    written = F.split(instant.cast("string"), r"[ .]")
    fraction = F.get(written, F.lit(2))
    return F.concat(
        F.get(written, F.lit(0)),
        F.lit("T"),
        F.get(written, F.lit(1)),
        F.when(fraction.isNull(), "").otherwise(
            F.concat(F.lit("."), F.rpad(fraction, 6, "0"))
        ),
        F.lit("Z"),
    )


def list_items(text: Column) -> Column:
    return F.transform(F.split(text, ","), lambda part: F.trim(part))


def numeric_items(text: Column) -> Column:
    """The parts of a comma list that are numbers."""
    parsed = F.transform(list_items(text), lambda part: part.try_cast("double"))
    return F.filter(parsed, lambda v: v.isNotNull())


def text_items(text: Column) -> Column:
    """The parts of a comma list that are not numbers."""
    return F.filter(list_items(text), lambda part: part.try_cast("double").isNull())
