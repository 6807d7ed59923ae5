"""Line dedup: explode normalised lines, hash, count documents per hash, drop lines over the threshold, reassemble.

Only (document, position, hash) rows are exploded and shuffled. The counting groups by hash with map-side combine, so a
line that a third of all documents hold is one row per task by the time it is shuffled. The positions to drop
come back to their document in one join, where the kept lines are joined again in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, ascii_lower, cut, digest, keeps_columns, text_of

FIRST_ID = -(2**63)


@keeps_columns
def drop_repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_key_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """docs with their kept lines as text, and n_lines (before), n_dropped.

    A line's key is the line stripped of ASCII white space with A-Z lower-cased. A key of at least min_key_chars code
    points in at least min_docs documents loses its lines everywhere but in the smallest document id that holds it.

    Null or empty text: one empty line, kept. Repeats of a line inside one document stay if the document keeps the key.
    Null id: one document, before all others. Rows that repeat an id are one document, each row with its own
    lines. Other columns pass through; input columns named n_lines or n_dropped are replaced.
    """
    docs = docs.drop("n_lines", "n_dropped")
    doc, row = F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST_ID)), F.xxhash64(text_of(text_col))
    # The text itself must not be carried along with each of its lines, so all that needs it comes before the explode.
    lines = docs.select(doc.alias("_doc"), row.alias("_row"), F.split(text_of(text_col), "\n").alias("_lines")).select("_doc", "_row", F.posexplode("_lines").alias("_at", "_line"))
    keys = lines.select("_doc", "_row", "_at", F.btrim(F.col("_line"), F.lit(SPACES)).alias("_bare")).where(F.length("_bare") >= min_key_chars)
    keys = keys.select("_doc", "_row", "_at", ascii_lower(F.col("_bare")).alias("_key"))
    one, two = digest(F.col("_key"))
    keys = keys.select("_doc", "_row", "_at", one.alias("_one"), two.alias("_two"))
    if min_docs <= 2:  # the first and the last document differ: no need to count distinct ones
        found = keys.groupBy("_one", "_two").agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last")).where((F.col("_first") != F.col("_last")) | F.lit(min_docs < 2))
    else:
        found = keys.groupBy("_one", "_two", "_doc").agg(F.lit(1).alias("_n")).groupBy("_one", "_two").agg(F.min("_doc").alias("_first"), F.count("*").alias("_n")).where(F.col("_n") >= min_docs)
    # Written out, so that the join below sees two plain exchanges, which Spark can split where a key is hot.
    found = cut(found.select("_one", "_two", "_first"))
    drops = keys.join(found, ["_one", "_two"]).where("_doc != _first").groupBy("_doc", "_row").agg(F.collect_set("_at").alias("_drops"))
    none = F.col("_drops").isNull()
    joined = docs.withColumns({"_doc": doc, "_row": row}).join(drops, ["_doc", "_row"], "left").withColumn("_lines", F.split(text_of(text_col), "\n"))
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drops"))  # in order, and in time linear in the lines
    kept = F.when(none, F.col(text_col)).otherwise(F.array_join(F.transform(places, lambda i: F.get("_lines", i)), "\n"))
    return joined.select(
        *[kept.alias(c) if c == text_col else F.col(c) for c in docs.columns],
        F.size("_lines").cast("long").alias("n_lines"),
        F.when(none, 0).otherwise(F.size("_drops")).cast("long").alias("n_dropped"),
    )
