"""Exact duplicates by an extendible-hash index on shared files, built-in functions only.

A row's slot is the leading bits of its text's 64-bit hash, so a bucket of slots
is a range of keys. The directory doubles until every bucket holds a bounded
number of bytes; a bucket that still holds more when it is a single slot, such
as that of one text with very many copies, gets a chain of pages over which its
rows are dealt. A page is what one task owns: there texts of one hash are
compared byte by byte, and those that differ stand in a chain behind each other.
Texts are shuffled once, to their pages.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, stored

#: Bytes of normalised text in a bucket, and in a page of its chain.
CAPACITY = 16 << 20
#: Beyond so many full buckets (1 TB) their capacity grows instead.
MOST = 1 << 16
#: Doublings of the directory beyond what the bytes of all texts ask for.
SLACK = 3
BLANK = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, "")


def letters(text: str) -> Column:
    return F.coalesce(F.char_length(F.col(text)), F.lit(0))


def hashed(plain: Column, mask: int = -1) -> Column:
    """64-bit hash; a mask leaves fewer bits, so that hashes collide."""
    return F.xxhash64(plain).bitwiseAND(F.lit(mask))


def slot_of(hash: Column, depth: int) -> Column:
    return F.shiftrightunsigned(hash, 64 - depth) if depth else F.lit(0).cast("long")


def directory(slots: DataFrame, depth: int, start: int, capacity: int) -> DataFrame:
    """(slot, bucket, pages) of (slot, bytes) at the deepest level.

    From `start` bits on, overfull buckets are split in two until none is
    overfull or all such are single slots. A bucket is named by its first slot.
    """
    found = slots.withColumn("level", F.lit(start))
    while True:
        first = lambda level: F.expr(f"shiftleft(shiftright(slot, {depth} - {level}), {depth} - {level})")
        of_slot = found.withColumn("bucket", first("level"))
        sizes = of_slot.groupBy("level", "bucket").agg(F.sum("bytes").alias("held"))
        found = stored(of_slot.join(sizes, ["level", "bucket"]), "directory")
        overfull = (F.col("held") > capacity) & (F.col("level") < depth)
        if found.where(overfull).isEmpty():
            pages = F.greatest(F.ceil(F.col("held") / capacity), F.lit(1)).cast("int")
            return found.select("slot", "bucket", pages.alias("pages"))
        found = found.select("slot", "bytes", (F.col("level") + overfull.cast("int")).alias("level"))


def placed(rows: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """Rows (key, points, hash, ..) with their bucket and page; what is in a page depends on the rows alone."""
    with_slot = rows.withColumn("slot", slot_of(F.col("hash"), depth)).join(slots, "slot").drop("slot")
    page = F.when(F.col("pages") > 1, F.pmod(F.xxhash64("key", "points"), F.col("pages"))).otherwise(0)
    return with_slot.withColumn("page", page.cast("int"))


def grouped(rows: DataFrame, texts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(bucket, page, hash, text, n, best) of every page: the size and the row that stays of each group of equal texts.

    rows: (key, points, bytes, hash), texts: (key, points, hash, text), of the
    same rows. text is null where no other text has the same hash. best is
    (-points, key is null, key).
    """
    total = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    capacity = max(capacity, total // MOST)
    start = max(0, math.ceil(math.log2(max(1, total / capacity))))
    depth = min(start + SLACK, 40)
    slots = directory(rows.groupBy(slot_of(F.col("hash"), depth).alias("slot")).agg(F.sum("bytes").alias("bytes")), depth, start, capacity)
    best = F.struct((-F.col("points")).alias("points"), F.col("key").isNull().alias("missing"), F.col("key").alias("key"))
    # twice as many tasks as pages fill, so that few own several
    tasks = max(2 * math.ceil(total / capacity), int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    owned = placed(texts, slots, depth).repartition(tasks, "bucket", "page")
    # equal texts of a page are compared here, in the task that owns it
    heads = owned.groupBy("bucket", "page", "hash", "text", "pages").agg(F.count("*").alias("n"), F.min(best).alias("best"))
    several = F.count("*").over(Window.partitionBy("bucket", "page", "hash")) > 1
    heads = stored(heads.withColumn("several", several).withColumn("text", F.when(F.col("several") | (F.col("pages") > 1), F.col("text"))), "heads")
    # a chain's pages are put together, and each of them gets the result
    chain = heads.where("pages > 1").groupBy("bucket", "pages", "hash", "text").agg(F.sum("n").alias("n"), F.min("best").alias("best"))
    chain = chain.join(chain.groupBy("bucket", "hash").agg((F.count("*") > 1).alias("several")), ["bucket", "hash"])
    chain = chain.withColumn("page", F.explode(F.expr("sequence(0, pages - 1)"))).select("bucket", "page", "hash", "text", "n", "best", "several")
    both = heads.where("pages = 1").select("bucket", "page", "hash", "text", "n", "best", "several").unionByName(chain)
    answers = stored(both.withColumn("text", F.when(F.col("several"), F.col("text"))), "answers")
    columns = ("key", "points", "hash", "n", "best")
    index = ["bucket", "page", "hash"]
    found = placed(rows, slots, depth).join(answers.where("text is null").drop("text"), index).select(*columns, "digest")
    if not answers.where("text is not null").isEmpty():
        collided = placed(texts, slots, depth).join(answers.where("text is not null"), [*index, "text"])
        found = found.unionByName(collided.select(*columns, F.sha2("text", 256).alias("digest")))
    return found


def judged(df: DataFrame, key: str, text: str, capacity: int, mask: int) -> DataFrame:
    plain = df.select(F.col(key).alias("key"), letters(text).alias("points"), normalised(F.col(text)).alias("text"))
    texts = plain.withColumn("hash", hashed(F.col("text"), mask))
    rows = stored(texts.select("key", "points", "hash", F.octet_length("text").alias("bytes"), F.sha2("text", 256).alias("digest")), "rows")
    kept = F.col("key").eqNullSafe(F.col("best.key")) & (F.col("points") == -F.col("best.points"))
    return grouped(rows, texts, capacity).select("key", "points", F.col("best.key").alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"), "digest")


def duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, mask: int = -1) -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256) of every row of `df`.

    Texts are equal if they are when all ASCII white space is deleted; null
    counts as empty, so blank and missing texts are one group. Of equal texts
    the row with the most letters in its text stays, then the one of the
    smallest key; rows of null key come last. Rows that agree in key and length
    are not told apart: all of them are kept or none. Other columns of `df` are
    not looked at.
    """
    found = judged(df, key, text, capacity, mask)
    return found.select(F.col("key").alias(key), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def without_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The rows of `df` that are kept, with all their columns and no others."""
    names = [fresh(n, df.columns) for n in ("gone_key", "gone_points", "gone_digest")]
    gone = judged(df, key, text, capacity, -1).where(~F.col("kept")).select("key", "points", "digest").distinct().toDF(*names)
    same = F.col(key).eqNullSafe(F.col(names[0])) & (letters(text) == F.col(names[1])) & (F.sha2(normalised(F.col(text)), 256) == F.col(names[2]))
    return df.join(gone, same, "left_anti")


#: The same in SQL, for unique ids.
ORACLE = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents),
r AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size FROM n WINDOW w AS (PARTITION BY plain ORDER BY points DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256 FROM r"""
