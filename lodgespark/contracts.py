"""Table contracts: which columns a transform needs, resolved from the schema
on the driver (no job runs).  Optional columns are skipped when absent, as the
original code does; a missing required column is an error that names it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame


class ContractError(ValueError):
    pass


@dataclass(frozen=True)
class TableContract:
    name: str
    required: tuple[str, ...]
    keys: tuple[str, ...] = ()
    optional: tuple[str, ...] = field(default_factory=tuple)

    def check(self, df: DataFrame) -> DataFrame:
        missing = [c for c in self.required if c not in df.columns]
        if missing:
            raise ContractError(f"{self.name}: required column(s) missing: {missing}; present: {df.columns}")
        return df



# --- fixed values: hard-required columns of each raw table ---
LISTINGS = TableContract("listings", required=("id", "price", "amenities"), keys=("id",))
REVIEWS = TableContract("reviews", required=("date", "comments"), keys=("id",),
                        optional=("id", "listing_id", "reviewer_id"))
CALENDAR = TableContract("calendar", required=("listing_id", "date", "available", "minimum_nights"),
                         keys=("listing_id", "date"), optional=("maximum_nights",))
