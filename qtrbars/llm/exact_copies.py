"""Operator 12: exact dedup by skew-safe combining, in DataFrame functions alone.

Texts are equal when they are identical after lower-casing A-Z only. Of equal
texts the row with the largest id stays.

1. Local: every task groups its own rows by digest and full content (the
   partial aggregate), so a text that a third of all rows hold leaves a task
   as one row.
2. Salted: those rows are merged by (digest, salt, content); the salt is the
   task's number modulo ``SALTS``, so a hot text's rows are merged in that many
   places.
3. Global: the salts' winners are combined by (digest, content).

Content is compared whole in all three, never only its digest. A digest that
turns out to stand for one content alone identifies it from there on, so the
rows find their group by digest and text isn't shuffled again. Digests that
stand for several contents (with SHA-256 there are none; any ``digest`` may be
given) have their rows placed by digest and content.

Rows of groups with over a thousandth of all rows, of which there are fewer
than a thousand whatever the table, take their group from a broadcast; the
others from a join in which no key is hot.

Defined results: null text is empty text; null ids are smaller than all
others, and a group of null ids alone keeps a null id; of rows that repeat
both id and text exactly one has ``kept`` true; very long texts are handled
whole; an empty input gives no rows. Other columns play no part and may have
any name.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .jaccard import written
from .joins import join_heavy

#: Places in which the copies of one text are merged before the last step.
SALTS = 32


def normalised(text: Column) -> Column:
    """The text with A-Z lowered and nothing else changed; null is empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def _rows(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    content = normalised(docs[text_col])
    return docs.select(docs[id_col].alias("id"), digest(content).alias("digest"), content.alias("content"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """(digest, content, id, n) of each distinct content: the id that stays, and how many rows have it."""
    salted = (_rows(docs, id_col, text_col, digest)
              .withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
              .groupBy("digest", "salt", "content").agg(F.max("id").alias("id"), F.count("*").alias("n")))
    return salted.groupBy("digest", "content").agg(F.max("id").alias("id"), F.sum("n").alias("n"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """(id, digest, keep_id, group_size, kept) of every row, dropped ones too."""
    every = groups(docs, id_col, text_col, digest, salts)
    found = written(every.groupBy("digest").agg(
        F.max("id").alias("keep_id"), F.sum("n").alias("n"), F.count("*").alias("contents")), "copies-groups")
    rows = _rows(docs, id_col, text_col, digest)
    # each row's number is written with it, so that it is the same wherever it is used
    slim = written(rows.select("id", "digest", F.monotonically_increasing_id().alias("row")), "copies-rows")
    alone, several = found.where("contents = 1").drop("contents"), found.where("contents > 1").select("digest")
    placed = join_heavy(slim, alone, ["digest"], "n").withColumn("part", F.lit(0).cast("bigint"))
    if not several.isEmpty():
        mixed = written(rows.join(several, "digest", "left_semi")
                        .withColumn("row", -1 - F.monotonically_increasing_id()), "copies-mixed")
        each = written(every.join(several, "digest", "left_semi").withColumnRenamed("id", "keep_id")
                       .withColumn("part", F.monotonically_increasing_id()), "copies-contents")
        placed = placed.unionByName(mixed.join(each, ["digest", "content"]).drop("content"))
    placed = written(placed, "copies-placed")
    stays = placed.where(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("digest", "part").agg(F.min("row").alias("row"))
    return (placed.join(stays.select("row", F.lit(True).alias("stays")), "row", "left")
            .select("id", "digest", "keep_id", F.col("n").alias("group_size"),
                    F.coalesce("stays", F.lit(False)).alias("kept")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """The rows that stay, with all their columns: of equal texts the largest id's, of its repeats one."""
    winners = groups(docs, id_col, text_col, digest, salts)
    content = normalised(F.col(f"row.`{text_col}`"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row")).withColumns(
        {"id": F.col(f"row.`{id_col}`"), "digest": digest(content), "content": content})
    same = (rows["digest"] == winners["digest"]) & (rows["content"] == winners["content"]) & rows["id"].eqNullSafe(winners["id"])
    return rows.join(winners, same, "left_semi").dropDuplicates(["digest", "content", "id"]).select("row.*")
