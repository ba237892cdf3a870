"""The whole way from stored inputs to training tables."""

from __future__ import annotations

import hashlib
import inspect
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.functions.keys import EVENT_COLUMNS, SENSOR_COLUMNS
from pulseframe.functions.naming import Feature, vector_map
from pulseframe.operators.geometry import feature_profile
from pulseframe.operators.reshape import reshape_features, reshape_truth
from pulseframe.operators.samples import event_features, events_features, one_sample, read_manifest, read_training, training_table, write_training
from pulseframe.operators.splits import PREDICATES, sample_index, split_all
from pulseframe.sources.reuse import build_or_reuse, fingerprint, fingerprint_of, reuse_or_write
from pulseframe.sources.tables import read_features, read_geometry, read_table

Tables = Mapping[str, DataFrame]
#: Reads named inputs (a folder or file each) and gives at least ``features`` (long readings) and ``truth``; other tables are stored beside them.
Extractor = Callable[[SparkSession, Mapping[str, str]], Tables]


@dataclass(frozen=True)
class Settings:
    """What shapes the derived tables, and the splits drawn from them.

    ``recipe`` names settings of the extractor and the converter that their code doesn't
    show; it is part of the fingerprint, as is their source. Predicates and labels only
    shape the training table, which has a fingerprint of its own.
    """

    features: Sequence[Feature]
    labels: Sequence[str]
    predicates: Mapping[str, str] = field(default_factory=lambda: dict(PREDICATES))
    event_columns: Sequence[str] = EVENT_COLUMNS
    sensor_columns: Sequence[str] = SENSOR_COLUMNS
    recipe: str = ""

    @property
    def names(self) -> list[str]:
        return vector_map(self.features)

    def shaping(self) -> str:
        return repr((self.names, list(self.event_columns), list(self.sensor_columns), self.recipe))

    def drawing(self, strict: bool) -> str:
        return repr((list(self.predicates.items()), list(self.labels), strict))


def read_inputs(spark: SparkSession, inputs: Mapping[str, str]) -> Tables:
    """Every input as it is, in the order of its files."""
    return {name: read_geometry(spark, path) if name == "geometry" else read_table(spark, path) for name, path in inputs.items()}


def convert(tables: Tables, settings: Settings) -> dict[str, DataFrame]:
    """Wide named features and keyed truth; other tables as they are."""
    return {
        **tables,
        "features": reshape_features(tables["features"], settings.names, settings.event_columns, settings.sensor_columns),
        "truth": reshape_truth(tables["truth"], settings.event_columns),
    }


@dataclass(frozen=True)
class Built:
    """Stored tables and the training table drawn from them, read as they are asked for."""

    spark: SparkSession
    folder: str
    draw: Callable[[], str]
    reused: bool
    settings: Settings

    @property
    def training_folder(self) -> str:
        """Where the training table is, which is drawn now unless somebody has asked for it before."""
        return self.draw()

    def table(self, name: str) -> DataFrame:
        """A stored table by name; of features the mapped columns in map order."""
        path = f"{self.folder}/{name}"
        return read_features(self.spark, path, self.settings.names) if name == "features" else self.spark.read.parquet(path)

    @property
    def training(self) -> DataFrame:
        return read_training(self.spark, self.training_folder)

    @property
    def manifest(self) -> DataFrame:
        """Which file has which samples: split, file, first, last, n."""
        return read_manifest(self.spark, self.training_folder)

    def split(self, name: str) -> DataFrame:
        if name not in self.settings.predicates:
            raise KeyError(name)
        return self.training.where(F.col("split") == name)

    def sample(self, split: str, idx: int) -> DataFrame:
        return one_sample(self.training, split, idx)

    def event(self, event_id: str) -> DataFrame:
        return event_features(self.table("features"), event_id)

    def events(self, event_ids: Sequence[str]) -> DataFrame:
        return events_features(self.table("features"), event_ids)

    def profile(self, feature: str) -> DataFrame:
        return feature_profile(self.table("features"), self.table("geometry"), feature, self.settings.names)


def _code(step: Callable[..., object]) -> str:
    """A step's name and a digest of the module that defines it, so that other code gives other tables."""
    step = getattr(step, "func", step)  # of a partial
    try:
        source = inspect.getsource(inspect.getmodule(step))
    except (OSError, TypeError):
        source = repr(step.__code__.co_code)  # typed in, or no Python
    return f"{step.__module__}.{step.__qualname__}:{hashlib.sha256(source.encode()).hexdigest()}"


def build(
    spark: SparkSession,
    inputs: Mapping[str, str],
    root: str,
    settings: Settings,
    extractor: Extractor = read_inputs,
    converter: Callable[[Tables, Settings], Tables] = convert,
    strict: bool = True,
    suffix: str = ".parquet",
) -> Built:
    """Extract and convert, or reuse an earlier conversion of the same input; the splits' samples are drawn when they are asked for.

    ``inputs`` are folders or files by name, all that the extractor may read: their files'
    names and bytes make the fingerprint, with ``settings`` and the source of extractor and
    converter, so tables never go with other input than they were made of. Digests of files
    are kept under ``root``, so a later build reads only new files for it. The training
    table is stored by split in the order of its samples, with a manifest; ``strict`` draws
    it at once, so events without features are an error of the build.
    """
    steps = [_code(f) for f in (extractor, converter)]
    parts = [f"{name}={fingerprint(spark, path, '', suffix, f'{root}/_digests/{fingerprint_of([path])}')}" for name, path in sorted(inputs.items())]
    key = fingerprint_of([*parts, *steps, settings.shaping()])
    folder, reused = build_or_reuse(spark, root, key, lambda: converter(extractor(spark, inputs), settings))
    drawn = f"training-{hashlib.sha256(settings.drawing(strict).encode()).hexdigest()}"

    def draw(path: str) -> None:
        truth = spark.read.parquet(f"{folder}/truth")
        indexed = sample_index(split_all(truth, settings.predicates).select("split", "event_id", "_ord"))
        write_training(training_table(indexed, truth, read_features(spark, f"{folder}/features", settings.names), settings.names, settings.labels, strict), path)

    built = Built(spark, folder, lambda: reuse_or_write(spark, f"{folder}/{drawn}", draw)[0], reused, settings)
    if strict:
        built.draw()
    return built
