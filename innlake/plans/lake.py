"""All layers over one set of RAW frames, declared lazily."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from innlake.constants import DATE_DIM_DAYS
from innlake.plans import dims, facts
from innlake.plans.domains import DOMAINS
from innlake.plans.validate import validate


class Frames(Mapping):
    """One DataFrame per domain, declared when first asked for."""

    def __init__(self, declare: Callable[[str], DataFrame]):
        self._declare = declare
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, domain: str) -> DataFrame:
        if domain not in DOMAINS:
            raise KeyError(domain)
        if domain not in self._known:
            self._known[domain] = self._declare(domain)
        return self._known[domain]

    def __iter__(self):
        return iter(DOMAINS)

    def __len__(self) -> int:
        return len(DOMAINS)


class Lake:
    """RAW to CURATED as unevaluated DataFrames.

    Nothing runs until a result is asked for, so each result computes just the
    layers and columns it needs. The scheduled jobs write the same layers out
    as tables instead.
    """

    n_days = DATE_DIM_DAYS

    def __init__(self, spark: SparkSession, raw: Callable[[str], DataFrame], as_of: datetime):
        self.spark = spark
        self.as_of = as_of
        self.raw = Frames(raw)
        self.valid = Frames(lambda domain: validate(domain, self.raw[domain]))

    @cached_property
    def dim_hotel(self) -> DataFrame:
        return dims.dim_hotel(self.valid["rooms"])

    @cached_property
    def dim_guest(self) -> DataFrame:
        return dims.dim_guest(self.valid["guests"], self.as_of)

    @cached_property
    def dim_room(self) -> DataFrame:
        return dims.dim_room(self.valid["rooms"], self.as_of)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.spark, n_days=self.n_days)

    @cached_property
    def stays(self) -> DataFrame:
        """Reservation facts with both keys."""
        return facts.fact_reservation(self.valid["reservations"], self.dim_guest, self.dim_room)

    @cached_property
    def stays_by_room(self) -> DataFrame:
        """Reservation facts for readers that only need the room."""
        return facts.fact_reservation(self.valid["reservations"], dim_room=self.dim_room)

    @cached_property
    def stays_by_guest(self) -> DataFrame:
        return facts.fact_reservation(self.valid["reservations"], dim_guest=self.dim_guest)

    @cached_property
    def stays_keyless(self) -> DataFrame:
        return facts.fact_reservation(self.valid["reservations"])

    @cached_property
    def tasks(self) -> DataFrame:
        return facts.fact_housekeeping(self.valid["housekeeping"], self.dim_room)

    @cached_property
    def tasks_keyless(self) -> DataFrame:
        return facts.fact_housekeeping(self.valid["housekeeping"])

    @cached_property
    def bills(self) -> DataFrame:
        return facts.fact_billing(self.valid["billing"], self.dim_guest)

    @cached_property
    def bills_keyless(self) -> DataFrame:
        return facts.fact_billing(self.valid["billing"])

    def layers(self) -> dict[str, DataFrame]:
        """Tables of the row-count check, under their labels."""
        labelled = {f"RAW {d.upper()}": self.raw[d] for d in DOMAINS}
        labelled |= {f"VAL {d.upper()}": self.valid[d] for d in DOMAINS}
        return labelled | {
            "FACT RESERVATION": self.stays,
            "FACT HOUSEKEEPING": self.tasks,
            "FACT BILLING": self.bills,
        }
