"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is crowded with this share of the rows or more, of tables beyond this size; the sketch follows that many candidates.
SHARE, LEAST_ROWS, CANDIDATES = 1 / 64, 200_000, 1024


@dataclass(frozen=True)
class Crowd:
    """Hashes of a table's crowded keys, by the columns that make the key; no more than ``1 / SHARE`` each."""

    keys: dict[tuple[str, ...], tuple[int, ...]]

    def crowded(self, on: list[str]) -> Column | None:
        """Whether a row's key is crowded; nothing where none is, and for keys that were not measured all of them."""
        known = [own for own in self.keys if set(own) <= set(on)]
        if not known:
            return F.lit(True)
        # A key is at most as crowded as any part of it.
        hashes = {own: self.keys[own] for own in known}
        if not all(hashes.values()):
            return None
        condition = F.lit(True)
        for own, values in hashes.items():
            condition = condition & F.xxhash64(*own).isin(list(values))
        return condition


def measure(rows: DataFrame, *keys: tuple[str, ...], share: float = SHARE, least_rows: int = LEAST_ROWS) -> Crowd:
    """Crowded keys of ``rows``: one pass with a frequent-items sketch per key, filled per task and merged.

    The sketch never counts too low by more than its error, so no key with ``share`` of the rows is missed.
    """
    tops = [F.call_function("approx_top_k", F.xxhash64(*own), F.lit(CANDIDATES // 8), F.lit(CANDIDATES)).alias(f"k{i}") for i, own in enumerate(keys)]
    found = rows.agg(F.count(F.lit(1)).alias("n"), *tops).first()
    if found["n"] < least_rows:
        return Crowd(dict.fromkeys(keys, ()))
    crowded = [tuple(sorted(r["item"] for r in found[f"k{i}"] or () if r["count"] >= share * found["n"])) for i in range(len(keys))]
    return Crowd(dict(zip(keys, crowded, strict=True)))


def salted_lookup(
    many: DataFrame, one: DataFrame, on: list[str], spread: list[str], how: str = "left", salts: int = 8, crowd: Crowd | None = None
) -> DataFrame:
    """Join rows that may crowd on a key to narrow lookup rows.

    Rows of crowded keys are spread over ``salts`` sub-keys by a hash of their ``spread`` columns (the same on every attempt of a task), and
    the rows of ``one`` with such a key are repeated for each sub-key. ``crowd`` says which keys of ``many`` are crowded: others are neither
    spread nor repeated, and without any it is a plain join. Where nothing was measured, every key counts as crowded.
    """
    crowded = F.lit(True) if crowd is None else crowd.crowded(on)
    if crowded is None:
        return many.join(one, on, how)
    none = F.lit(0).cast("bigint")
    salted = many.withColumn("_salt", F.when(crowded, F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(none))
    every = F.sequence(none, F.lit(salts - 1).cast("bigint"))
    copies = one.withColumn("_salt", F.explode(F.when(crowded, every).otherwise(F.array(none))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
