"""Ids of rows that stages can join on."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ids import ordered_id
from ledgerloom.sources.workspace import Workspace


def distinct_ids(docs: DataFrame, space: Workspace, also: DataFrame | None = None, own: str | None = None) -> DataFrame:
    """The same rows with distinct, non-null ``doc_id``; ``own`` names a column to add with the id they came with.

    Of rows that share a ``doc_id`` the first by their other columns keeps it. The others, and rows with a
    null one, get new ids after the largest of ``docs`` and ``also``, in order of the old id (nulls last) and the
    other columns; so no row is lost or doubled, those rows meet no row of ``also``, and they count as later ones
    where the earlier stays. New ids must fit 64 bits, or there is an error.
    """
    repeated = space.write(docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_id")), "repeated")
    columns = docs.columns
    if own:
        docs = docs.withColumn(own, F.col("doc_id"))
    if repeated.isEmpty():
        return docs
    shared = docs["doc_id"].eqNullSafe(repeated["_id"])
    # equal rows may stand in any order, so the place they are read at breaks their ties
    again = space.write(docs.join(repeated, shared, "left_semi").withColumn("_at", F.monotonically_increasing_id()), "again")
    order = [F.col("doc_id").asc_nulls_last(), *(c for c in columns if c != "doc_id"), "_at"]
    numbered = ordered_id(again, order, "_number", space, start=1, stored=True)
    first = numbered.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("_number").alias("_first"))
    ids = docs.select("doc_id") if also is None else docs.select("doc_id").unionByName(also.select("doc_id"))
    largest = ids.agg(F.max("doc_id")).first()[0] or 0
    fresh = F.when(F.col("_number") == F.col("_first"), F.col("doc_id")).otherwise(F.lit(largest).cast("long") + F.col("_number"))
    rekeyed = numbered.join(first, "doc_id", "left").withColumn("doc_id", fresh).select(docs.columns)
    return space.write(docs.join(repeated, shared, "left_anti").unionByName(rekeyed), "keyed")
