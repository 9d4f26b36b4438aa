"""Exact dedup with a two-pass Bloom filter, in DataFrame functions only.

Pass 1 sets a few cells of a blocked Bloom filter for each row and counts the hits; pass 2 looks every row
up in the filter of cells that were hit twice or more. A row with a cell hit only once is certainly
unique and passes straight through; only the possibly repeated rows shuffle, grouped by SHA-256.

The filter never exceeds ``max_bits`` (its proven bound for the broadcast: max_bits / 64 rows of two
longs). Where documents far outnumber the bits it saturates: results stay whole, more rows shuffle.

Defined cases: null text is empty; null ids sort last (a group of null ids only has keep_id null); of rows
that repeat the same id and text exactly one is kept; an empty table gives an empty result; other
columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetlake.functions.storage import materialize
from facetlake.llm.text import SPACE, id_text

CELLS_A_ROW = 3


def normalized_sha256(text: Column) -> Column:
    return F.sha2(F.regexp_replace(text, SPACE, " "), 256)


def drop_rows(docs: DataFrame, lost: DataFrame, same: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 1 << 27) -> DataFrame:
    """``docs`` without the rows that ``lost`` names by (doc_id, text_key), the key being the text's 64-bit hash; of rows that ``same`` names one stays.

    A Bloom filter of the named rows, never larger than ``max_bits``, decides which rows shuffle to be looked up; the rest pass straight through.
    """
    key = F.xxhash64("doc_id", "text_key")
    lost, same = (materialize(d.select(F.col("doc_id").cast("long").alias("lost_id"), F.col("text_key").alias("lost_key")).distinct(), n) for d, n in ((lost, "lost"), (same, "same")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key")).withColumn("sha", key)
    named = lost.unionAll(same).select(F.xxhash64("lost_id", "lost_key").alias("key"))
    flagged = flag_ids(rows, named, max_bits)
    on = F.col("doc_id").eqNullSafe(F.col("lost_id")) & (F.col("text_key") == F.col("lost_key"))
    kept = flagged.where("candidate").join(lost.hint("merge"), on, "left_anti")
    if not same.isEmpty():
        kept = kept.join(same, on, "left_anti").unionByName(kept.join(same, on, "left_semi").dropDuplicates(["doc_id", "text_key"]))
    return flagged.where("not candidate").unionByName(kept).select("row.*")


def flag_ids(rows: DataFrame, ids: DataFrame, max_bits: int = 1 << 27) -> DataFrame:
    """Adds ``candidate``: false where the number in ``sha`` is certainly not in the one column of ``ids``."""
    words, n = 1 << 10, ids.count()
    while words * 4 < n and words * 64 < max_bits:
        words *= 2
    word, bits = _word_and_bits(F.col(ids.columns[0]), words)
    cells = ids.select(word.alias("word"), F.explode(bits).alias("bit"))
    return flag_candidates(rows, materialize(cells.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")), "filter"), words)


def _word_and_bits(key: Column, words: int) -> tuple[Column, Column]:
    """The filter's word for a key, and the bits in that word."""
    h = F.xxhash64(key)
    bits = [F.shiftrightunsigned(h, 58 - 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(CELLS_A_ROW)]
    return h.bitwiseAND(F.lit(words - 1)), F.array(*bits)


def repeated_filter(keyed: DataFrame, words: int) -> DataFrame:
    """Pass 1: rows (word, mask) of the cells that at least two rows have hit."""
    word, bits = _word_and_bits(F.col("sha"), words)
    cells = keyed.select(word.alias("word"), F.explode(F.array_distinct(bits)).alias("bit"))
    hits = cells.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("hits")).where("hits > 1")
    return hits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))


def flag_candidates(keyed: DataFrame, found: DataFrame, words: int) -> DataFrame:
    """Pass 2: adds ``candidate``, true where all cells of the row were hit more than once."""
    word, bits = _word_and_bits(F.col("sha"), words)
    need = F.lit(0).cast("long")
    for i in range(CELLS_A_ROW):
        need = need.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bits[i]))
    rows = keyed.withColumn("word", word).withColumn("need", need)
    return rows.join(F.broadcast(found), "word", "left").withColumn("candidate", F.coalesce(F.col("mask").bitwiseAND(F.col("need")) == F.col("need"), F.lit(False))).drop("word", "need", "mask")


def _prepare(docs: DataFrame, id_col: str, text_col: str, max_bits: int) -> tuple[DataFrame, DataFrame, int]:
    rows = id_text(docs, id_col, text_col).select("doc_id", normalized_sha256(F.col("text")).alias("sha"), F.monotonically_increasing_id().alias("row_no"))
    keyed = materialize(rows.select("doc_id", F.unhex("sha").alias("sha"), "row_no"), "keyed")
    words, n = 1 << 10, keyed.count()
    while words * 4 < n and words * 64 < max_bits:
        words *= 2
    return keyed, materialize(repeated_filter(keyed, words), "filter"), words


def _groups(again: DataFrame) -> DataFrame:
    # Written out, so that both sides of a later join are plain exchanges: AQE then splits a hot group.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_no"))
    found = again.groupBy("sha").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return materialize(found.select("sha", F.col("first.doc_id").alias("keep"), F.col("first.row_no").alias("keep_row"), "n"), "groups")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 1 << 27) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    keyed, found, words = _prepare(docs, id_col, text_col, max_bits)
    flagged = flag_candidates(keyed, found, words)
    again = flagged.where("candidate").drop("candidate")
    joined = again.join(_groups(again), "sha", "left").select("doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), F.coalesce(F.col("row_no") == F.col("keep_row"), F.lit(True)).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    alone = flagged.where("not candidate").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    return alone.unionAll(joined)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 1 << 27) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; texts of unique rows never shuffle."""
    keyed, found, words = _prepare(docs, id_col, text_col, max_bits)
    again = flag_candidates(keyed, found, words).where("candidate").drop("candidate")
    lost = materialize(again.join(_groups(again), "sha").where("row_no <> keep_row").select(F.col("doc_id").alias("lost_id"), F.col("sha").alias("lost_sha"), F.col("doc_id").eqNullSafe(F.col("keep")).alias("same")), "lost")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.unhex(normalized_sha256(F.coalesce(F.col(text_col), F.lit("")))).alias("sha"), F.col(id_col).cast("long").alias("own_id"))
    flagged = flag_candidates(rows, found, words)
    on = F.col("own_id").eqNullSafe(F.col("lost_id")) & (F.col("sha") == F.col("lost_sha"))
    some = flagged.where("candidate")
    kept = some.join(lost.where("not same"), on, "left_anti")
    if not lost.where("same").isEmpty():  # the same id and text in several rows: one of them stays
        same = lost.where("same").select("lost_id", "lost_sha").distinct()
        kept = kept.join(same, on, "left_anti").unionByName(kept.join(same, on, "left_semi").dropDuplicates(["own_id", "sha"]))
    return flagged.where("not candidate").unionByName(kept).select("row.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, CAST(min(doc_id) OVER g AS BIGINT) AS keep_id, CAST(count(*) OVER g AS BIGINT) AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
