"""Small helpers that several operators of this package share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.physical import materialize
from ..session import ensure_checkpoint_dir

__all__ = ["LATIN_MAX", "concat_spans", "materialize", "read_table", "scratch_column", "scratch_folder",
           "ship_package", "text_or_empty", "word_pattern"]

# Highest code point of the range for which ``word_pattern`` lists the letters and numbers itself.
LATIN_MAX = 0x24F


_SHIPPED: set[str] = set()

BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def ship_package(spark: SparkSession) -> None:
    """Send this library to the Python workers, once for each application, and bound what they get at once.

    Functions that run there are looked up by module, and a worker need not have the driver's path.  Batches of whole
    texts are bounded by bytes, unless the session chose a bound itself.
    """
    sc = spark.sparkContext
    if BATCH_BYTES[0] not in spark.conf.getAll:
        spark.conf.set(*BATCH_BYTES)
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="salesforge-package-"), "salesforge.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), os.path.dirname(root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus, read through Spark (the folder may be in any store Spark can open)."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder in the shared checkpoint folder; it goes when the block ends."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(column: Column | str) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def scratch_column(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (inputs may bring columns of any name)."""
    taken, name = {c.lower() for c in df.columns}, f"__{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def concat_spans(spans: Column) -> Column:
    """``kind:start:end`` items of an array of structs, comma-joined in the order of the array."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def word_pattern(pattern: str) -> tuple[re.Pattern, re.Pattern]:
    """(a) the pre-token pattern for ``re``, right where all characters are at most ``LATIN_MAX``;
    (b) a pattern that finds a character above it.

    The tokenizers' pattern uses ``\\p{L}`` and ``\\p{N}``, which ``re`` lacks.  Listing the letters and
    numbers of the Latin blocks from the Unicode tables makes the common case about twice as fast as the
    ``regex`` module; texts with other characters go to that module.
    """
    import unicodedata

    def ranges(kind: str) -> str:
        found = [chr(c) for c in range(LATIN_MAX + 1) if unicodedata.category(chr(c))[0] == kind]
        out, first, last = [], found[0], found[0]
        for c in found[1:]:
            if ord(c) != ord(last) + 1:
                out.append(f"{first}-{last}")
                first = c
            last = c
        return "".join([*out, f"{first}-{last}"])

    # ``re`` counts \x1c-\x1f as white space, Unicode's White_Space property does not
    white = "\\t-\\r \\x85\\xa0"
    own = (pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{white}{ranges('L')}{ranges('N')}]")
           .replace(r"\p{L}", f"[{ranges('L')}]").replace(r"\p{N}", f"[{ranges('N')}]")
           .replace(r"\S", f"[^{white}]").replace(r"\s", f"[{white}]"))
    return re.compile(own), re.compile(f"[^\\x00-{chr(LATIN_MAX)}]")
