"""A record of finished stages beside the outputs of a job, so that a job that broke off can go on."""

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

RECORD = "_stages"


class StageRecord:
    """One small file per finished stage below ``out/_stages``, written after all outputs of the stage.

    Each file holds the settings of the job. With ``resume`` the stages of an earlier run with equal settings are
    skipped up to the first one that is not recorded; from there on every stage runs again. Without ``resume`` the
    records of earlier runs are removed first.
    """

    def __init__(self, spark: SparkSession, out: str, settings: dict, resume: bool = False):
        self.settings = json.dumps(settings, sort_keys=True)
        path = spark._jvm.org.apache.hadoop.fs.Path
        self._path = lambda name: path(f"{out}/{RECORD}/{name}")
        self._root = path(f"{out}/{RECORD}")
        self._files = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._going_on = resume
        if not resume:
            self._files.delete(self._root, True)

    def finished(self, name: str) -> bool:
        """Whether ``name`` is recorded under equal settings."""
        if not self._files.exists(self._path(name)):
            return False
        stream = self._files.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode() == self.settings
        finally:
            stream.close()

    def stage(self, name: str, run: Callable[[], None]) -> None:
        """Run a stage and record it, unless it and all before it are recorded."""
        self._going_on = self._going_on and self.finished(name)
        if self._going_on:
            return
        self._files.delete(self._path(name), False)
        run()
        stream = self._files.create(self._path(name), True)
        stream.write(self.settings.encode())
        stream.close()
