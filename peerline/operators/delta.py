"""Load only rows whose fingerprint the target does not hold yet.

Rows meet by the 32-byte digest of their fingerprint: the text itself is not shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerline.functions.text import FINGERPRINT, row_key
from peerline.operators.rows import fresh_name
from peerline.session import materialise


def fresh_rows(new: DataFrame, old: DataFrame, key: str = FINGERPRINT) -> DataFrame:
    """Rows of `new` whose fingerprint is absent from `old`; copies within `new` stay.

    `old` is cut to distinct digests first, so copies there collapse map-side. A second key, a hash of the
    digest, makes both sides meet in plain exchanges, which lets adaptive execution broadcast a small `old` or split a
    partition of `new` that one repeated row has swollen; it moves the distinct digests once more, 40 bytes each.
    """
    digest, lead = fresh_name("row_key", new), fresh_name("row_lead", new)
    seen = old.select(row_key(F.col(key)).alias(digest)).distinct().withColumn(lead, F.xxhash64(digest))
    tagged = new.withColumn(digest, row_key(F.col(key))).withColumn(lead, F.xxhash64(digest))
    return tagged.join(seen, [lead, digest], "left_anti").select(*new.columns)


def redundant_rows(new: DataFrame, old: DataFrame, key: str = FINGERPRINT) -> DataFrame:
    """Rows of `old` that no row of `new` confirms any more."""
    return fresh_rows(old, new, key)


def unmatched_keys(new: DataFrame, old: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """(key, in_new): keys that only one side holds, by one full outer join of distinct keys.

    Copies collapse on both sides before they meet. With `parts` the keys of `new` are dealt to as many
    tasks: where `old` is a table of so many buckets of the key, it is read bucket by bucket and not shuffled.
    """
    wanted = new.select(key).distinct()
    if parts:
        wanted = wanted.repartition(parts, key)
    left, right = wanted.withColumn("in_new", F.lit(True)), old.select(key).distinct().withColumn("in_old", F.lit(True))
    met = left.join(right, key, "full_outer").filter(F.col("in_new").isNull() | F.col("in_old").isNull())
    return met.select(key, F.col("in_new").isNotNull().alias("in_new"))


def compare_rows(new: DataFrame, old: DataFrame, key: str = FINGERPRINT) -> tuple[DataFrame, DataFrame]:
    """Fresh rows of `new` and redundant rows of `old` from one comparison of their distinct digests.

    The digests that one side alone holds are written; rows are then picked by them, and stay where they are if
    those are few.
    """
    digest = fresh_name(fresh_name("row_key", new), old)
    tagged = [side.withColumn(digest, row_key(F.col(key))) for side in (new, old)]
    found = materialise(unmatched_keys(*tagged, digest), "unmatched")
    sides = (F.col("in_new"), ~F.col("in_new"))
    picked = [t.join(found.filter(s).select(digest), digest, "left_semi") for t, s in zip(tagged, sides)]
    return picked[0].select(*new.columns), picked[1].select(*old.columns)
