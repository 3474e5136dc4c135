"""Class labels of any kind, and the slots 0, 1, ... of probability vectors that stand for them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lintel.operators.encode import label_classes
from lintel.operators.neighbours import argmax
from lintel.plans.persist import Kept


@dataclass(frozen=True)
class LabelMap:
    """The classes by slot, in ascending order. Numbers may have gaps and start anywhere; texts are labels as well."""

    classes: tuple
    text: bool = False

    @classmethod
    def fit(cls, df: DataFrame, label: str) -> LabelMap:
        """The classes of a column, without null; they come to the driver, as a model has parameters for each."""
        text = not isinstance(df.schema[label].dataType, (T.NumericType, T.BooleanType))
        kind = "string" if text else "double"
        return cls(tuple(label_classes(df.select(F.col(label).cast(kind).alias(label)), label)), text)

    @classmethod
    def of(cls, classes: list) -> LabelMap:
        text = any(isinstance(y, str) for y in classes)
        return cls(tuple(classes if text else map(float, classes)), text)

    def __len__(self) -> int:
        return len(self.classes)

    def slot(self, label: str) -> Column:
        """The slot of a label as a double, as learners want it; null for null and for unknown labels."""
        if not self.classes:
            return F.lit(None).cast("double")
        cells = [x for i, y in enumerate(self.classes) for x in (F.lit(y), F.lit(float(i)))]
        return F.try_element_at(F.create_map(*cells), F.col(label).cast("string" if self.text else "double"))

    def pick(self, shares: list[str]) -> Column:
        """The label whose share (a column for each slot) is largest; the lower slot wins a tie. Numbers are given as doubles, as by MLlib."""
        return argmax(shares, list(self.classes)).cast("string" if self.text else "double")

    def label(self, slot: Column) -> Column:
        """The label that a slot stands for."""
        return F.element_at(F.array(*map(F.lit, self.classes)), slot.cast("int") + 1)


def slots_of(model) -> list | None:
    """The label that each place of a model's probability vector stands for; None where the model does not say."""
    if hasattr(model, "stages"):
        return slots_of(model.stages[-1])
    if hasattr(model, "classes"):
        return list(model.classes)
    n = getattr(model, "numClasses", None)
    return None if n is None else [float(i) for i in range(n)]


def aligned(shares: Column, model, classes: list) -> Column:
    """The array of a model's class shares in the order of the classes given: 0 for a class that the model has not met."""
    own = slots_of(model)
    # a model that does not say counts places from 0
    places = {y: i for i, y in enumerate(own)} if own is not None else {y: int(y) for y in classes if not isinstance(y, str)}
    zero = F.lit(0.0)
    return F.array(*[F.coalesce(F.get(shares, F.lit(places[y])), zero) if y in places else zero for y in classes])


class Labelled(Estimator):
    """A learner for labels of any kind: what `build` makes is fitted on slots, and the model answers in labels."""

    def __init__(self, build: Callable[[], Estimator], label: str = "label"):
        super().__init__()
        self.build, self.label = build, label

    def _fit(self, dataset: DataFrame) -> LabelledModel:
        known = LabelMap.fit(dataset, self.label)
        return LabelledModel(self.build().fit(dataset.withColumn(self.label, known.slot(self.label))), known)


class LabelledModel(Kept, Model):
    """A model fitted on slots. probability has one place a class, in the order of `classes`."""

    def __init__(self, model, known: LabelMap):
        super().__init__()
        self.model, self.known = model, known

    @property
    def classes(self) -> list:
        return list(self.known.classes)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        places = [float(i) for i in range(len(self.known))]
        scored = self.model.transform(dataset)
        shares = aligned(vector_to_array("probability"), self.model, places)
        return scored.withColumns({"probability": array_to_vector(shares), "prediction": self.known.label(F.col("prediction"))})

    def told(self) -> dict:
        return {"classes": self.classes}

    def parts(self) -> dict[str, object]:
        return {"model": self.model}

    @classmethod
    def made(cls, told, part):
        return cls(part("model"), LabelMap.of(told["classes"]))
