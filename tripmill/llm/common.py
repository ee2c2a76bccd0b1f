"""Helpers shared by the operators: written tables, text batches, tokenizer files."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

import tripmill
from tripmill.session import checkpoint_folder

#: Words, as a Java and as a Python pattern; ``bytes.split()`` cuts at the same characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Parts that an operator does not spread further hold about this many rows.
PART_ROWS = 20_000
#: What is made of so many texts is held in a Python worker at once.
OUT_ROWS = 256
BATCH_ROWS_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file; every machine has the package that holds them."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Table:
    """Rows written to the shared checkpoint folder: computed once, safe from lost executors.

    They are deleted when the session's JVM ends, or before by ``drop`` when nothing reads them any more.
    """

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.path = f"{checkpoint_folder(self.spark)}/llm-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        files, path = self._files()
        files.deleteOnExit(path)
        self.rows = self.spark.read.schema(df.schema).parquet(self.path)

    def _files(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def drop(self) -> None:
        files, path = self._files()
        files.delete(path, True)


def written(df: DataFrame) -> DataFrame:
    return Table(df).rows


_held: dict = {}


def held(what: tuple, build: Callable[[], object]) -> object:
    """What a Python worker keeps for its next tasks; it lets go of what other operators kept there."""
    if what not in _held:
        _held.clear()
        gc.collect()
        _held[what] = build()
    return _held[what]


def hold_nothing() -> None:
    held(("nothing",), lambda: None)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each Spark context.

    They then import it wherever the driver was started and however it found the package. Rows with whole texts go to
    the workers in smaller batches than Spark's usual ones, unless the session sets a size of its own.
    """
    if spark.conf.get(BATCH_ROWS_KEY) == "10000":
        spark.conf.set(BATCH_ROWS_KEY, str(BATCH_ROWS))
    context = spark.sparkContext
    if any(name.startswith("tripmill-") for name in context._python_includes):
        return
    package = Path(tripmill.__file__).parent
    place = Path(tempfile.mkdtemp(prefix="tripmill-code-")) / f"tripmill-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(place, "w") as code:
        for file in sorted(package.rglob("*.py")):
            code.write(file, file.relative_to(package.parent))
    context.addPyFile(str(place))


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def per_text(
    df: DataFrame, text: str, keep: list[str], schema: str, make: Callable[[], Callable[[str | None], tuple]]
) -> DataFrame:
    """A row for each row: the columns ``keep`` and what a function makes of the whole text.

    ``make`` runs once in each task and gives the function, so that vocabularies are loaded there and not shipped. If the
    function has an attribute ``prepare``, that is called with the texts of each small batch first.
    Batches come through Arrow; texts are taken from a batch one at a time, and
    results leave in small batches.
    """
    made_fields = StructType.fromDDL(schema).fields
    kinds = [to_arrow_type(field.dataType) for field in made_fields]
    names = [*keep, *[field.name for field in made_fields]]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        prepare = getattr(one, "prepare", None)
        for batch in batches:
            for start in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(start, OUT_ROWS)
                if prepare is not None:
                    prepare(value.as_py() for value in part.column("text__"))
                made = list(zip(*[one(value.as_py()) for value in part.column("text__")], strict=True))
                kept = [part.column(f"keep{i}__") for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *[pa.array(column, kinds[i]) for i, column in enumerate(made)]], names)

    ship(df.sparkSession)
    narrow = df.select(*[F.col(name).alias(f"keep{i}__") for i, name in enumerate(keep)], F.col(text).alias("text__"))
    return narrow.mapInArrow(rows, StructType([*df.select(*keep).schema.fields, *made_fields]))
