"""Helpers shared by the operators of this subpackage.

Conventions of all operators:

* they select the columns they need under reserved ``_q_*`` names first, so
  extra columns of the input, whatever their names, never clash;
* a null text is an empty text, an empty table gives an empty result;
* repeated rows are separate rows unless the docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# fixed values of the data contract
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE = r"[\x20\x09-\x0D]"
TOKEN = r"[^\x20\x09-\x0D]+"

#: rows of an Arrow batch sent to Python; with texts of 100 kB this is 100 MB
ARROW_ROWS = 1000


def tune(spark: SparkSession) -> None:
    """Keep the Arrow batches of text columns small (a user's smaller setting stays)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Read a table of the data folder, pruned to ``cols`` when given."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def free(name: str, columns: list[str]) -> str:
    """``name``, or with ``_2``, ``_3``, ... added the first that no column has (in any case of letters)."""
    taken, out, k = {c.lower() for c in columns}, name, 2
    while out.lower() in taken:
        out, k = f"{name}_{k}", k + 1
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared scratch folder and read it back: cuts the
    lineage, and what was computed survives the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_az(text: Column) -> Column:
    """ASCII lower case only; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Words of letters, digits and non-ASCII characters, lower-cased in ASCII."""
    return F.filter(F.split(lower_az(text), WORD_BREAK), lambda w: w != "")


def let(value: Column, body) -> Column:
    """Bind ``value`` once for ``body``: a lambda that names an outer expression
    would evaluate it again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def held_out(doc_id: Column, remainder: int) -> Column:
    """crc32 of the id as text, modulo 5, equals ``remainder``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == remainder


def chunks(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[tuple[pa.Table, list[bytes]]]:
    """Regroup Arrow batches into pieces of about ``max_bytes`` of text: each
    piece with its texts as bytes (null: empty).  One text is never split."""
    rows: list[pa.RecordBatch] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        column_bytes = [x or b"" for x in batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()).to_pylist()]
        at = 0
        for i, x in enumerate(column_bytes):
            size += len(x)
            if size >= max_bytes:
                rows.append(batch.slice(at, i + 1 - at))
                yield pa.Table.from_batches(rows), texts + column_bytes[at : i + 1]
                rows, texts, size, at = [], [], 0, i + 1
        if at < batch.num_rows:
            rows.append(batch.slice(at))
            texts = texts + column_bytes[at:]
    if rows:
        yield pa.Table.from_batches(rows), texts


def with_row(df: DataFrame, name: str = "_q_row") -> DataFrame:
    """Number the rows; stable only once the result is stored."""
    return df.withColumn(name, F.monotonically_increasing_id())
