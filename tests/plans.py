"""Text of physical plans."""

from __future__ import annotations

from contextlib import contextmanager


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    """Session settings for a block; ``__`` in a name stands for a dot."""
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for key, value in names.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def at_scale(spark, **more):
    """No side is small enough to broadcast, and skew shows at test size."""
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        **more,
    )
