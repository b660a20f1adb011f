"""Near duplicates by SimHash, found on a grid of segment bit counts.

A 64-bit fingerprint is cut into sixteen segments, and the numbers of bits set in them make
a point of a grid. One differing bit moves the point by one step, so the Manhattan distance
of two points is never more than the Hamming distance of the fingerprints. Two points at a
distance of two or less have a grid point in common that is at most one step from both: each
fingerprint visits the 33 points around its own, and the range join is an equality join.

A point that a single fingerprint visits is left. Fingerprints that meet are verified
exactly: at the shared point each names the fingerprints that differ from it by the bit of
that step. Those that name the same one differ in two bits at most, and any two that differ
in two bits at most name one in common. So members of such a bucket are linked to its first
member only: links grow with the fingerprints, never with their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import free_name, map_arrow, raw, slices, table
from cohortloom.llm.components import components
from cohortloom.sources.storage import materialize

SEED = 42
CHUNK = 1 << 15  # shingles whose bits are spread out at once


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each run of `size` words, repeats included; fewer words make one run."""
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_digest
    if size == 1:
        parts = [digest(w, SEED) for w in words]
    elif len(words) <= size:
        parts = [digest(b" ".join(words), SEED)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.append(0, ends[:-1] + 1)
        spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
        parts = [digest(line[a:b], SEED) for a, b in spans]
    return np.frombuffer(b"".join(parts), ">u8").astype(np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """A bit is one where more than half of the hashes have it; zero without hashes."""
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        part = hashes[i : i + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def fingerprints(
    docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and the fingerprint `fp` of each whole text.

    A-Z count as a-z, words are split at ASCII white space.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            found = [
                simhash(shingle_hashes(text.lower().split(), words))
                for text in raw(batch.column("text"))
            ]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(signed)], names=["doc_id", "fp"]
            )

    rows = docs.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"`{text_col}` AS text")
    return map_arrow(rows, run, "doc_id long, fp long")


def grid_point(fp: str) -> str:
    """SQL: the bits set in each half byte, as sixteen numbers of four bits."""
    ones = 0x1111111111111111
    return " + ".join(f"(shiftrightunsigned({fp}, {i}) & {ones}L)" for i in range(4))


def buckets_within_two(fps: DataFrame, fp: str) -> DataFrame:
    """Rows (point, name, *columns of `fps`): the verified buckets of each fingerprint.

    `fp` is the SQL of a fingerprint. Members of a bucket (point, name) differ
    in two bits at most, and any two rows that do share a bucket; its name is a fingerprint that
    all its members are within one bit of. Only the visits to grid points are shuffled: the
    buckets of a point are made where it is.
    """
    kept = fps.columns
    # step 0 stays; odd steps add one to a segment, even steps take one away
    segment = "cast(4 * ((step - 1) div 2) as int)"
    count, one = f"shiftrightunsigned(own, {segment}) & 15", f"shiftleft(1L, {segment})"
    visits = (
        fps.selectExpr(*kept, f"{grid_point(f'({fp})')} AS own")
        .selectExpr("*", f"explode(sequence(0, 32)) AS step")
        .where(
            f"CASE WHEN step = 0 THEN true WHEN step % 2 = 1 THEN ({count}) < 4"
            f" ELSE ({count}) > 0 END"
        )
        .selectExpr(
            *kept,
            "step",
            f"CASE WHEN step = 0 THEN own WHEN step % 2 = 1 THEN own + {one}"
            f" ELSE own - {one} END AS point",
        )
    )
    met = visits.withColumn("at", F.count("*").over(Window.partitionBy("point"))).where("at > 1")
    return (
        met.selectExpr(
            "point",
            *kept,
            f"({fp}) AS own",
            "step % 2 AS up",
            f"explode(CASE WHEN step = 0 THEN array(-1) ELSE sequence({segment}, {segment} + 3) END)"
            " AS bit",
        )
        .selectExpr(
            "point",
            *kept,
            "CASE WHEN bit < 0 THEN own"
            " WHEN (shiftrightunsigned(own, bit) & 1) <> up THEN own ^ shiftleft(1L, bit) END AS name",
        )
        .where("name IS NOT NULL")
    )


def _bucket():
    return Window.partitionBy("point", "name")


def links_within_two(fps: DataFrame) -> DataFrame:
    """Links (a, b) of the rows (node, fp) that connect all whose fingerprints differ in two

    bits at most: each bucket links its members to the smallest."""
    buckets = buckets_within_two(fps.select("node", "fp"), "fp")
    first = buckets.withColumn("b", F.min("node").over(_bucket()))
    return first.where("node <> b").selectExpr("node AS a", "b").distinct()


def near_duplicates(
    docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each row of `docs`: doc_id, fingerprint (hexadecimal), component_id.

    Documents are linked where their fingerprints over shingles of `words` words differ in
    two bits at most; component_id is the smallest identifier that links lead to. A text of
    fewer words is one shingle; null, empty and blank texts have fingerprint zero and are
    linked like others. Rows that repeat an identifier stay apart but share their component;
    null identifiers are passed over for component_id, which is null only where a component
    has no other. An empty table gives no rows; other columns are not read.
    """
    rows = materialize(fingerprints(docs, words, id_col, text_col), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links_within_two(nodes.selectExpr("fp AS node", "fp")))
    labelled = materialize(
        nodes.join(found, nodes["fp"] == found["node"], "left").selectExpr(
            "fp", "least", "coalesce(label, fp) AS label"
        ),
        "labels",
    )
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = labelled.join(least, "label").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(
    docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs`, with all their columns, that stay: one of each component.

    Components are those of `near_duplicates`. The row with the smallest identifier stays, a
    missing one last, and of rows that repeat it the first as the table was read; every row
    is judged by its own text, also where rows repeat an identifier. Null, empty and blank
    texts are copies of each other. An empty table gives no rows. Columns of any name and type
    pass through. The rows are written once, so that their numbers hold when a task runs anew.
    """
    row, judged = free_name(docs, "row"), free_name(docs, "judged")
    held = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-rows")
    found = near_duplicates(held, words, row, text_col)
    ids = held.select(F.col(row).alias("doc_id"), F.col(id_col).cast("long").alias("id"))
    stays = (
        found.join(ids, "doc_id")
        .groupBy("component_id")
        .agg(F.min(F.struct(F.col("id").isNull().alias("late"), "id", "doc_id")).alias("first"))
        .select(F.col("first.doc_id").alias(judged))
    )
    kept = held.join(stays, F.col(row) == F.col(judged), "left_semi")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_simhash_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words=3)
