"""A written boundary between the large expressions of two steps."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def settled(df: DataFrame) -> DataFrame:
    """``df`` as written to the checkpoint folder (``spark.checkpoint.dir``; a temporary one where it is
    unset and all runs on one machine, as in tests): what reads it more than once does not compute it again, predicates of later
    steps are not copied into the expressions of earlier ones, and lost executors cost no rework."""
    sc = df.sparkSession.sparkContext
    if not sc.getConf().get("spark.checkpoint.dir") and not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="blockfuse-checkpoint-"))
    return df.checkpoint()
