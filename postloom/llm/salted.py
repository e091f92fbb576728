"""Look-ups of rows in a table with one row a key, where a key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key with more rows than this is hot: its rows are spread over salts.
HOT = 200_000


def lookup(rows: DataFrame, keyed: DataFrame, key: list[str], count: str, hot_rows: int, how: str = "inner", by: str | None = None) -> DataFrame:
    """rows joined with keyed on key. keyed has one row a key with its number of rows in `count`, which is dropped. The rows of a hot key
    are joined by (key, salt), with the key's row on every salt; all others have the one salt 0. Keys are compared as by =. A
    row's salt is a hash of all of it (or of the column `by`), so that a task that runs again gives the same rows; a million equal rows would share one
    salt. Rows with a null key match nothing; with how="left" they are spread, too.

    The hot keys are broadcast: they are fewer than rows / hot_rows, 5,000 for a billion rows at HOT.
    """
    salts = F.greatest(F.lit(1), F.ceil(F.col(count) / hot_rows)).cast("int")
    hot = keyed.where(F.col(count) > hot_rows).select(*key, salts.alias("_salts"))
    spread_by = F.xxhash64(by) if by else F.xxhash64(*rows.columns)
    no_key = F.greatest(*(F.col(k).isNull().cast("int") for k in key), F.lit(0)) == 1
    salt = F.when(no_key, F.pmod(spread_by, F.lit(1 << 20))).otherwise(F.coalesce(F.pmod(spread_by, F.col("_salts")), F.lit(0))).cast("int")
    salted = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_salts")
    spread = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop(count)
    return salted.join(spread, [*key, "_salt"], how).drop("_salt")
