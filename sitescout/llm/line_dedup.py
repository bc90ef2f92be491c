"""Line deduplication by overlapping three-line windows.

Every three consecutive lines of a text are a window, told by 128 bits of hash. The first of
equal windows, by document and then by place, stays; every line that any later one covers goes.
Each line that goes stands unchanged somewhere earlier, so one copy of each line remains.

Lines end at line feeds. Windows of blank lines only do not count, and texts of fewer than three
lines have no window. Null texts stay null. Rows equal in id and text are one document and are
cut alike; rows that share an id but not the text are ordered by a hash of the text. Columns
named like the added ones are replaced; all others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitescout.llm.common import brought_back, set_apart, stored

LINES = 3
ROW = ["doc_id", "_text_hash"]


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def line_windows(docs: DataFrame, text: str = "text", lines: int = LINES) -> DataFrame:
    """(doc_id, _text_hash, start, h1, h2) of each window that is not blank."""
    of = F.col("_lines")
    held = docs.select("doc_id", F.xxhash64(text).alias("_text_hash"), _lines(text).alias("_lines"))
    held = held.where(F.size(of) >= lines)

    def window(i: Column) -> Column:
        part = [F.get(of, i + k) for k in range(lines)]
        is_blank = F.trim(F.concat(*[F.regexp_replace(p, r"\s+", "") for p in part])) == ""
        return F.struct(
            i.cast("int").alias("start"),
            F.xxhash64(*part).alias("h1"),
            F.xxhash64(F.lit(lines), *part).alias("h2"),
            is_blank.alias("is_blank"),
        )

    windows = held.select(*ROW, F.explode(F.transform(F.sequence(F.lit(0), F.size(of) - lines), window)).alias("w"))
    return windows.where("not w.is_blank").select(*ROW, "w.start", "w.h1", "w.h2")


def later_windows(windows: DataFrame) -> DataFrame:
    """The windows that are not the first of their kind. ``windows`` are read twice."""
    place = F.struct("doc_id", "_text_hash", "start")
    repeated = (
        windows.groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .where("n > 1")
        .select("h1", "h2", "first")
    )
    return windows.join(repeated, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first"))).select(*ROW, "start")


def kept_lines(of: Column, starts: Column, lines: int = LINES) -> Column:
    """The lines outside the windows at ``starts`` (ascending), which are merged into runs."""
    last = F.size(starts) - 1
    begins = F.filter(starts, lambda s, i: (i == 0) | (s > F.get(starts, i - 1) + lines))
    ends = F.filter(starts, lambda s, i: (i == last) | (F.get(starts, i + 1) > s + lines))
    gaps = F.zip_with(
        F.concat(F.array(F.lit(0)), F.transform(ends, lambda e: e + lines)),
        F.concat(begins, F.array(F.size(of))),
        lambda a, b: F.slice(of, a + 1, b - a),
    )
    return F.flatten(gaps)


def dedup_lines(docs: DataFrame, text: str = "text", lines: int = LINES) -> DataFrame:
    """``docs`` with the text cut, and ``n_lines``, ``n_removed`` and ``n_spans`` (removed runs)."""
    given, docs = docs, set_apart(docs, "doc_id", text)
    later = later_windows(stored(line_windows(docs, text, lines)))
    per_doc = later.groupBy(*ROW).agg(F.array_sort(F.collect_set("start")).alias("_starts"))
    per_doc = per_doc.select(F.col("doc_id").alias("_doc"), F.col("_text_hash").alias("_hash"), "_starts")
    hashed = docs.withColumn("_text_hash", F.xxhash64(text))
    same = hashed["doc_id"].eqNullSafe(per_doc["_doc"]) & (hashed["_text_hash"] == per_doc["_hash"])
    of, starts = _lines(text), F.col("_starts")
    kept = F.when(starts.isNull(), of).otherwise(kept_lines(of, starts, lines))
    spans = F.filter(starts, lambda s, i: (i == 0) | (s > F.get(starts, i - 1) + lines))
    cut = (
        hashed.join(per_doc, same, "left")
        .withColumn("_kept", kept)
        .withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(F.size(of)))
        .withColumn("n_removed", F.when(starts.isNull(), 0).otherwise(F.col("n_lines") - F.size("_kept")))
        .withColumn("n_spans", F.when(starts.isNull(), 0).otherwise(F.size(spans)))
        .withColumn(text, F.when(starts.isNull(), F.col(text)).otherwise(F.array_join("_kept", "\n")))
    )
    return brought_back(cut, given, "n_lines", "n_removed", "n_spans")
