"""Models of this library as stages that pipelines write and read."""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from lintel.operators.state import Fitted

#: Modules whose classes may be named by a file that is read.
KNOWN = ("org.apache.spark.ml.", "pyspark.ml.", "lintel.")
#: Parts of a model that are written or read at a time. Each takes several small jobs, which one after the other leave the cores idle.
PARTS = 4


class Kept(MLWritable, MLReadable):
    """A model that writes itself as its parameters, what it tells of itself (JSON), and its parts: models, fitted states or tables."""

    def told(self) -> dict:
        return {}

    def parts(self) -> dict[str, object]:
        return {}

    @classmethod
    def made(cls, told: dict, part: Callable[[str], object]) -> Kept:
        """The model again, from what it told and its parts by name."""
        raise NotImplementedError

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, instance: Kept):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark, parts = self.sparkSession, self.instance.parts()
        kinds = {n: "table" if isinstance(p, DataFrame) else "fitted" if isinstance(p, Fitted) else "model" for n, p in parts.items()}
        DefaultParamsWriter.saveMetadata(self.instance, path, spark, extraMetadata={"told": self.instance.told(), "parts": kinds})

        def save(name: str) -> None:
            part = parts[name]
            if kinds[name] == "table":
                part.write.mode("overwrite").parquet(f"{path}/{name}")
            elif kinds[name] == "fitted":
                part.save(spark, f"{path}/{name}")
            else:
                part.write().session(spark).overwrite().save(f"{path}/{name}")

        with ThreadPool(PARTS) as pool:
            pool.map(save, parts, 1)


class _Reader(MLReader):
    def __init__(self, kind: type[Kept]):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)

        def read(name: str) -> object:
            at = f"{path}/{name}"
            kind = metadata["parts"][name]
            if kind == "table":
                return spark.read.parquet(at)
            return Fitted.load(spark, at) if kind == "fitted" else load_stage(spark, at)

        with ThreadPool(PARTS) as pool:
            parts = dict(zip(metadata["parts"], pool.map(read, metadata["parts"], 1), strict=True))
        model = self.kind.made(metadata["told"], parts.__getitem__)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def save_stage(model: MLWritable, path: str) -> None:
    """Any model, or pipeline of models, under one folder."""
    model.write().overwrite().save(path)


def load_stage(spark: SparkSession, path: str):
    """What `save_stage` wrote; its own metadata tell what it is."""
    kind = DefaultParamsReader.loadMetadata(path, spark)["class"]
    if not kind.startswith(KNOWN):
        raise ValueError(f"{kind} is no model of MLlib or of this library")
    return DefaultParamsReader.loadParamsInstance(path, spark)
