"""Exact duplicates by a tree of merged digest runs.

Each input partition becomes a run: its digests in sorted order, one entry for each
digest. In every round the runs of `fan_in` neighbouring blocks are exchanged by
(block, digest), arrive sorted, and are merged in one linear pass that keeps the
identifier that stays and the number of rows. After a logarithmic number of rounds one
block is left, spread over all tasks by digest. A text that makes up a third of all rows
costs one entry for each run, and no more than `fan_in` entries meet in a merge.

What a digest stands for is verified at every level: entries are merged only where the
SHA-256 digest, the length in bytes and an independent 64-bit hash agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import free_name, map_arrow, table, whole_text
from cohortloom.sources.storage import materialize

KEY = ("digest", "size", "check")
RUN = "block int, digest binary, size int, check long, keep_id long, keep_row long, n long"


def merge_sorted_runs(largest: bool):
    """Merge equal neighbours of rows that arrive sorted by (block, digest, size, check)."""

    def better(a: tuple, b: tuple) -> tuple:
        # identifiers first, a missing one last; then the first row, so that ties are settled
        def rank(x: tuple) -> tuple:
            identifier, row = x
            if identifier is None:
                return (1, 0, row)
            return (0, -identifier if largest else identifier, row)

        return min(a, b, key=rank)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the entry that further rows may still belong to
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            out = []
            for block, digest, size, check, keep_id, keep_row, n in zip(*columns, strict=True):
                key = (block, digest, size, check)
                if held is not None and held[0] == key:
                    held = (key, better(held[1], (keep_id, keep_row)), held[2] + n)
                    continue
                if held is not None:
                    out.append((*held[0], *held[1], held[2]))
                held = (key, (keep_id, keep_row), n)
            if out:
                yield _batch(out)
        if held is not None:
            yield _batch([(*held[0], *held[1], held[2])])

    return merge


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["block", *KEY, "keep_id", "keep_row", "n"]
    arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _merged(runs: DataFrame, largest: bool) -> DataFrame:
    ordered = runs.sortWithinPartitions("block", *KEY)
    return map_arrow(ordered, merge_sorted_runs(largest), RUN)


def digest_groups(rows: DataFrame, largest: bool, fan_in: int) -> tuple[DataFrame, DataFrame]:
    """Entries of the leaf runs, and the merged groups, of a written table of digests."""
    leaf = materialize(
        _merged(
            rows.select(
                F.col("run").alias("block"),
                *KEY,
                F.col("id").alias("keep_id"),
                F.col("row").alias("keep_row"),
                F.lit(1).cast("long").alias("n"),
            ),
            largest,
        ),
        "digest-runs",
    )
    top = leaf.agg(F.max("block")).first()[0]
    merged, blocks = leaf, (top or 0) + 1
    while True:
        blocks = -(-blocks // fan_in)
        merged = merged.withColumn("block", F.floor(F.col("block") / fan_in).cast("int"))
        merged = _merged(merged.repartition("block", *KEY), largest)
        if blocks == 1:
            return leaf, merged


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    fan_in: int = 8,
) -> DataFrame:
    """One row for each row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; a null text counts as empty. The row with the
    largest (or smallest) identifier of its group stays; a null identifier stays only in
    a group that has no other; of rows that repeat the identifier that stays, one is
    kept. An empty table gives no rows. Other columns of `docs` are not read.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep must be largest or smallest")
    if fan_in < 2:
        raise ValueError("fan_in must be 2 at least")
    text = whole_text(text_col)
    rows = materialize(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
            F.octet_length(text).alias("size"),
            F.xxhash64(text).alias("check"),
        )
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("run", F.spark_partition_id()),
        "digests",
    )
    leaf, groups = digest_groups(rows, keep == "largest", fan_in)
    # Down the tree again: groups meet the entries of the leaf runs by digest, and these the
    # rows by (run, digest), so that no task gets more than one run's share of a group.
    repeated = groups.where("n > 1").drop("block")
    entries = (
        leaf.select(F.col("block").alias("run"), *KEY)
        .distinct()
        .join(repeated, list(KEY))
        .select("run", *KEY, "keep_id", "keep_row", "n")
    )
    joined = rows.join(entries, ["run", *KEY], "left")
    single = F.col("n").isNull()
    return joined.select(
        F.col("id").alias("doc_id"),
        F.when(single, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one(
    docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` that the result of `exact_duplicates` lets stay.

    Rows are found again by identifier and digest. Where rows repeat both, the first of
    them stays, in the order of their columns written as JSON, so columns of any name and
    type pass through. Null and empty texts are equal; an empty table gives no rows.
    """
    digest = free_name(docs, "digest")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumn(digest, F.sha2(whole_text(text_col).cast("binary"), 256))
    own_id, own_digest = F.col(id_col), F.col(digest)
    found_id, found_digest = free_name(marked, "found_id"), free_name(marked, "found_digest")
    keys = (
        decisions.groupBy(
            F.col("doc_id").alias(found_id), F.col("text_sha256").alias(found_digest)
        )
        .agg(F.max("kept").alias("stays"), F.count("*").alias("rows"))
        .where("stays")
    )
    met = own_id.eqNullSafe(F.col(found_id)) & (own_digest == F.col(found_digest))
    alone = marked.join(keys.where("rows = 1").drop("stays", "rows"), met, "left_semi")
    again = marked.join(keys.where("rows > 1").drop("stays", "rows"), met, "left_semi")
    whole = F.struct(*columns)
    first = (
        again.groupBy(own_id.alias(found_id), own_digest.alias(found_digest))
        .agg(F.min_by(whole, F.to_json(whole)).alias("first"))
        .select("first.*")
    )
    return alone.select(*columns).unionByName(first)


def op2_exact_dedup(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
"""
