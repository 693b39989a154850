"""Fields derived from a crawl-state row."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlspark.fixed_values import LAST_MODIFIED_KEY, PROTOCOL_CODE_KEY, STATUS_NAMES


def status_name(status: Column) -> Column:
    """Public name of a status; null for every status without one."""
    named = F.lit(None).cast("string")
    for state, name in STATUS_NAMES.items():
        named = F.when(status == state, F.lit(name)).otherwise(named)
    return named


def status_code(metadata: Column) -> Column:
    return F.try_element_at(metadata, F.lit(PROTOCOL_CODE_KEY))


def last_modified_millis(metadata: Column) -> Column:
    """Number after the first `=` of the protocol status; 0 where there is none."""
    after = F.get(F.split(F.try_element_at(metadata, F.lit(LAST_MODIFIED_KEY)), "="), F.lit(1))
    return F.coalesce(after.try_cast("bigint"), F.lit(0).cast("bigint"))


def interval_days(seconds: Column) -> Column:
    """Whole days, cut towards zero."""
    return (seconds / 86_400).cast("int")
