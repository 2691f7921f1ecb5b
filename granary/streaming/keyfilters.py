"""Key filters of written folders: what a batch is tested against before any old row is read.

A folder of a target has the smallest and largest of its keys (``bounds``) and a Bloom filter in words of 64
bits (``words``): a key sets ``PROBES`` bits of one word.  Both are tables below ``_filters``, which one
aggregation builds and one equality join probes, so neither keys nor filters pass the driver, whatever their
number.  A filter never misses a key; the keys that a folder may hold are verified with its rows.

Bounds are written last, so a folder whose filter is not complete has none and counts as one that may hold
every key.  Keys with a null are in no filter: a null equals nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A written folder: its run and batch.
Folder = tuple[str, int]
RUN, BATCH = "run", "batch_id"
#: Keys per word of a filter at most, and bits that a key sets: some 0.1 % of other keys pass.
KEYS_PER_WORD, PROBES = 4, 6
_WORDS, _WORD, _MASK, _BITS, _LOW, _HIGH = "_words", "_word", "_mask", "_bits", "_low", "_high"


def _path(target: str, keys: Sequence[str], kind: str, folder: Folder | None = None) -> str:
    base = f"{target.rstrip('/')}/_filters/{quote(','.join(keys), safe='')}/{kind}"
    return base if folder is None else f"{base}/{RUN}={folder[0]}/{BATCH}={folder[1]}"


def _place() -> list[T.StructField]:
    return [T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())]


def _bounds_schema(schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    key = T.StructType([schema[k] for k in keys])
    return T.StructType([T.StructField(_LOW, key), T.StructField(_HIGH, key), T.StructField(_WORDS, T.LongType())])


_WORD_SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in (_WORDS, _WORD, _BITS)])


def _word(keys: Sequence[str], words: Column) -> Column:
    """The word of a key in a filter of ``words`` words, a power of two."""
    return F.xxhash64(*keys).bitwiseAND(words - 1)


def _mask(keys: Sequence[str]) -> Column:
    """The bits that a key sets: six bits of a second hash name each of them."""
    second = F.xxhash64(F.lit(PROBES), *keys)
    places = [F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(PROBES)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in places])


def _filled(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key has no null; NaN is a value."""
    return df.where(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))


def _bounds(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    key = F.struct(*keys)
    return _filled(df, keys).agg(F.min(key).alias(_LOW), F.max(key).alias(_HIGH), F.count("*").alias("_n"))


def prepare_filters(spark: SparkSession, target: str, schema: T.StructType, keys: Sequence[str], none: Folder) -> None:
    """Make the filters of a target readable before the first one is written."""
    for kind, columns in (("words", _WORD_SCHEMA), ("bounds", _bounds_schema(schema, keys))):
        spark.createDataFrame([], columns).write.mode("ignore").parquet(_path(target, keys, kind, none))


def write_filter(rows: DataFrame, target: str, keys: Sequence[str], folder: Folder) -> None:
    """The filter of a folder from its rows; a replay overwrites it."""
    spark = rows.sparkSession
    bounds = _bounds(rows, keys).first()  # one row
    size = 1 << max(-(-bounds["_n"] // KEYS_PER_WORD) - 1, 0).bit_length()
    words = (
        _filled(rows, keys).select(_word(keys, F.lit(size)).alias(_WORD), _mask(keys).alias(_MASK))
        .groupBy(_WORD).agg(F.bit_or(_MASK).alias(_BITS)).select(F.lit(size).cast("bigint").alias(_WORDS), _WORD, _BITS)
    )
    words.write.mode("overwrite").parquet(_path(target, keys, "words", folder))
    row = [(bounds[_LOW], bounds[_HIGH], size)]
    spark.createDataFrame(row, _bounds_schema(rows.schema, keys)).coalesce(1).write.mode("overwrite").parquet(
        _path(target, keys, "bounds", folder))


def filters_of(spark: SparkSession, target: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Bounds, words and folder of every filter."""
    columns = T.StructType([*_bounds_schema(schema, keys).fields, *_place()])
    return spark.read.schema(columns).parquet(_path(target, keys, "bounds"))


def suspects(
    batch: DataFrame, target: str, keys: Sequence[str], folders: Iterable[Folder]
) -> tuple[DataFrame, list[Folder]]:
    """The keys of ``batch`` that some of the folders may hold, and the folders that may hold one.

    ``batch`` is read several times.  With a folder that has no filter, every key is suspect.
    """
    spark, folders = batch.sparkSession, set(folders)
    known = filters_of(spark, target, batch.schema, keys)
    here = _bounds(batch, keys).select(F.col(_LOW).alias("_first"), F.col(_HIGH).alias("_last"))
    near = F.coalesce((F.col(_LOW) <= F.col("_last")) & (F.col(_HIGH) >= F.col("_first")), F.lit(False))
    rows = known.join(here, F.lit(True)).select(RUN, BATCH, _WORDS, near.alias("near")).collect()  # one per folder
    filtered = {(r[RUN], r[BATCH]): r for r in rows}
    bare = folders - set(filtered)
    close = sorted(f for f in folders - bare if filtered[f]["near"])
    distinct = batch.select(*keys)
    hits = None
    if close:
        sizes = sorted({filtered[f][_WORDS] for f in close})
        columns = T.StructType([*_WORD_SCHEMA.fields, *_place()])
        words = spark.read.schema(columns).option("basePath", _path(target, keys, "words")).parquet(
            *[_path(target, keys, "words", f) for f in close])
        probes = (
            _filled(batch, keys).select(*keys, F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])).alias(_WORDS))
            .select(*keys, _WORDS, _word(keys, F.col(_WORDS)).alias(_WORD), _mask(keys).alias(_MASK))
        )
        hits = probes.join(words, [_WORDS, _WORD]).where(F.col(_BITS).bitwiseAND(F.col(_MASK)) == F.col(_MASK))
        close = sorted((r[RUN], r[BATCH]) for r in hits.select(RUN, BATCH).distinct().collect())
    if bare or hits is None:
        return (distinct if bare else distinct.limit(0)), sorted(bare) + close
    return hits.select(*keys), close
