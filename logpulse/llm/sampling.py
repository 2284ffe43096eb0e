"""Bounded samples of labelled rows, for fitting classifiers on the driver."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Sample:
    """Pieces of text of each label, and the number of rows that have it."""

    texts: dict[object, list[str]] = field(default_factory=dict)
    rows: dict[object, int] = field(default_factory=dict)


def labelled_sample(df: DataFrame, label: str, text: str, per_label: int, *, salt: int, chars: int, key: str = "doc_id") -> Sample:
    """About `per_label` texts of each non-null label, or all if there are fewer; at most twice as many.

    Rows are chosen by a hash of key and text, so the choice does not depend on partitions. Of a text
    longer than `chars` a piece of that length from a place chosen by the hash is taken. Null texts
    are left out. Two scans, no shuffle of texts; the driver receives labels x per_label x 2 pieces at most.
    """
    place = F.xxhash64(key, text, F.lit(salt))
    rows = df.select(F.col(label).alias("label"), F.col(text).alias("piece"), place.alias("place")).where("label is not null and piece is not null")
    counts = {r["label"]: r["n"] for r in df.where(F.col(label).isNotNull() & F.col(text).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n")).collect()}
    out = Sample(rows=counts)
    if not counts:
        return out
    scale = 1 << 20
    limit = F.coalesce(*(F.when(F.col("label") == F.lit(x), F.lit(min(scale, -(-scale * per_label // n)))) for x, n in sorted(counts.items(), key=lambda x: str(x[0]))))
    at = 1 + F.pmod(F.shiftright("place", 20), F.greatest(F.length("piece") - chars, F.lit(1)))
    chosen = rows.where(F.pmod("place", F.lit(scale)) < limit).select("label", "place", F.when(F.length("piece") <= chars, F.col("piece")).otherwise(F.substring("piece", at, F.lit(chars))).alias("piece"))
    for r in sorted(chosen.limit(2 * per_label * len(counts)).collect(), key=lambda r: (str(r["label"]), r["place"], r["piece"])):
        out.texts.setdefault(r["label"], []).append(r["piece"])
    return out
