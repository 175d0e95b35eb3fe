"""Publication of the newest file of each dataset family."""

from collections.abc import Sequence

from pyspark.sql import SparkSession

from stipend import fixed_values as fixed
from stipend.sinks.tables import publish_copies
from stipend.sources.snapshots import newest_snapshot


def publish_newest(
    spark: SparkSession, folder: str, out: str,
    families: Sequence[str] = tuple(fixed.SNAPSHOT_FAMILIES),
) -> dict[str, str]:
    """Publish the newest file of each family as `<family>.csv`; families without one are skipped.

    Returns the published path per family: one short row per family named by the caller. A family
    that fails does not stop the others; the errors are raised when all have had their turn.
    """
    newest = {row.family: row.path for row in newest_snapshot(spark, folder, families).collect()}
    failed = publish_copies(spark, newest, out)
    if failed:
        errors = [OSError(f"{family} from {newest[family]}: {text}") for family, text in failed.items()]
        raise ExceptionGroup("not all families were published", errors)
    return newest
