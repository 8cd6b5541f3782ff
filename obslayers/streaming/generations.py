"""Numbers that order the writers of a folder.

Epochs start at zero again with every new checkpoint, so what a stream writes is
filed under a generation as well. A generation belongs to one checkpoint and is noted
inside it: dropping the checkpoint to reset a stuck stream also starts a new one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from obslayers import storage


def open_generation(spark: SparkSession, path: str, checkpoint: str | None = None, note: str = "keyed") -> int:
    """The generation to write below ``path`` with.

    That of ``checkpoint`` when it has one, else the next that was never handed out.
    ``note`` tells apart several folders that one stream writes.
    """
    file = f"{checkpoint}/_generation_{note}" if checkpoint else None
    if file and storage.exists(spark, file):
        return int(storage.read_text(spark, file))
    taken = [int(name) for name in storage.children(spark, f"{path}/_generations")]
    generation = max(taken, default=0) + 1
    storage.write_text(spark, f"{path}/_generations/{generation}", "")
    if file:
        storage.write_text(spark, file, str(generation))
    return generation
