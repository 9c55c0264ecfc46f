"""Where iterative operators keep their tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from .bindings import Bound


#: What a table was shuffled through is gone once it is kept: nothing else reads it.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saver(b: Bound) -> Callable[[DataFrame, str], DataFrame]:
    """A function that writes a table to the shared scratch folder and reads it back, cutting the lineage."""
    made = [0]

    def save(df: DataFrame, name: str) -> DataFrame:
        made[0] += 1
        path = f"{b.scratch}/{name}-{made[0]}"
        conf, own = b.spark.conf, b.spark.conf.getAll
        if _CLEAN not in own:
            conf.set(_CLEAN, "true")
        try:
            df.write.parquet(path)
        finally:
            if _CLEAN not in own:
                conf.unset(_CLEAN)
        return b.spark.read.schema(df.schema).parquet(path)

    return save


def kept_calls(b: Bound, *more: str) -> DataFrame:
    """The genotypes as a table of their own (site_id, sample_id, alt, called and the columns named), for queries that read them several times."""
    return saver(b)(b.genotypes.select("site_id", "sample_id", "alt", "called", *more), "calls")
