"""Exactly one copy of each message, without shuffling the messages.

Only (identifier, delivery order, file, row position) is shuffled. The winner of
each identifier is its latest delivery; every other row is marked in a deletion
vector of its file: bitmaps of 32,768 row positions. The wide rows are then read
in place, each against the vector of its own file.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.ids import norm_id
from tidewell.operators.slices import HOT_ROWS, join_hot

#: Rows of one bitmap of Spark's bitmap functions, which hold 4,096 bytes.
BITMAP_ROWS = 32_768
BITMAP_BYTES = 4_096
#: Deletion vectors up to this size are broadcast to the scan.
BROADCAST_BYTES = 64 << 20


def file_number(path: Column) -> Column:
    """What stands for a file in the shuffle, instead of its long address: two
    independent hashes, 96 bits, which no two files of a table share."""
    return F.struct(F.xxhash64(path).alias("a"), F.crc32(path.cast("binary")).alias("b"))


def positions(df: DataFrame, key: str, order: str) -> DataFrame:
    """(id, at, file, row) of the rows that have an identifier. The scan reads
    these two columns only; ``df`` must be a plain file scan."""
    return df.select(
        norm_id(key).alias("id"),
        F.col(order).alias("at"),
        file_number(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.row_index").alias("row"),
    ).filter("id is not null")


def winners(slim: DataFrame) -> DataFrame:
    """(id, copies, winner): the winner is the latest delivery (null order last);
    ties go to the later position (file, row), so one row always wins."""
    order = F.struct(F.col("at"), F.col("file"), F.col("row"))  # null sorts first, so it loses a max
    return slim.groupBy("id").agg(F.count(F.lit(1)).alias("copies"), F.max(order).alias("winner"))


def repeated(slim: DataFrame) -> DataFrame:
    """The identifiers on more than one row, each once."""
    return winners(slim).filter("copies > 1").select("id")


def deletion_vectors(slim: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(file, bucket, bits): the losing rows, all positions of an identifier with
    several copies minus the winner's. An identifier with very many copies is
    reduced to its winner before it meets them again, and then meets them in
    several tasks."""
    won = winners(slim).filter("copies > 1")
    hit = join_hot(slim.drop("at"), won.select("id", "winner"), "id", won.select("id", F.col("copies").alias("n")), hot_rows=hot_rows)
    losers = hit.filter((F.col("file") != F.col("winner.file")) | (F.col("row") != F.col("winner.row")))
    return losers.groupBy("file", F.bitmap_bucket_number(F.col("row") + 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("row") + 1)).alias("bits")
    )


def _is_set(bits: Column, row: Column) -> Column:
    at = F.bitmap_bit_position(row + 1)
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def exactly_once(
    spark: SparkSession, path: str, key: str, order: str, columns: list[str] | None = None, broadcast_bytes: int = BROADCAST_BYTES, losers: bool = False
) -> DataFrame:
    """The rows of the Parquet table at ``path`` with one row for each identifier
    (spelling aside) and all rows without one. ``losers``: the marked rows instead,
    all others of the identifiers that have several.

    The vectors' size is counted first (bitmaps x 4 KB, one row to the driver).
    Up to ``broadcast_bytes`` they are broadcast and the payload isn't moved at
    all; beyond, files are taken in groups whose vectors keep the bound, and each
    group of files is read once against its own vectors. The bitmaps are written
    to the shared checkpoint folder, so a lost executor doesn't rerun the shuffle."""
    from tidewell.session import shared_dir

    shared_dir(spark)
    df = spark.read.parquet(path)
    names = columns or df.columns
    vectors = deletion_vectors(positions(df, key, order)).checkpoint()
    n_files, n_bitmaps = vectors.agg(F.count_distinct("file"), F.count(F.lit(1))).first()
    if not n_bitmaps:
        return df.select(*names).filter(F.lit(not losers))

    def kept(rows: DataFrame, marks: DataFrame) -> DataFrame:
        m = F.broadcast(marks.select(F.col("file").alias("__f"), F.col("bucket").alias("__b"), F.col("bits").alias("__bits")))
        at = rows.select(*names, file_number(F.col("_metadata.file_path")).alias("__file"), F.col("_metadata.row_index").alias("__row"))
        hit = at.join(m, (F.col("__file") == F.col("__f")) & (F.bitmap_bucket_number(F.col("__row") + 1) == F.col("__b")), "left")
        marked = F.coalesce(_is_set(F.col("__bits"), F.col("__row")), F.lit(False))
        return hit.filter(marked if losers else ~marked).select(*names)

    if n_bitmaps * BITMAP_BYTES <= broadcast_bytes:
        return kept(df, vectors)
    # Addresses, numbers and bitmap counts of the files, one row a file as in any file listing.
    # A listing and the metadata column may write one file's address differently.
    place = lambda u: unquote(urlparse(u).path)
    address = df.select(F.col("_metadata.file_path").alias("address")).distinct().withColumn("file", file_number(F.col("address")))
    counted = vectors.groupBy("file").agg(F.count(F.lit(1)).alias("n")).join(address, "file")
    marked = {place(f.address): (f.address, f.n) for f in counted.toLocalIterator()}
    groups: list[list[str]] = [[]]
    held = 0
    for f in sorted(df.inputFiles()):
        n = marked.get(place(f), ("", 0))[1] * BITMAP_BYTES
        if groups[-1] and held + n > broadcast_bytes:
            groups.append([])
            held = 0
        groups[-1].append(f)
        held += n
    parts = [kept(spark.read.schema(df.schema).parquet(*g), vectors.filter(F.col("file").isin([file_number(F.lit(marked[place(f)][0])) for f in g if place(f) in marked]))) for g in groups]
    return reduce(DataFrame.unionByName, parts)
