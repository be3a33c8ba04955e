"""Run configuration shared by every stage (period, anchor, backfill, spine)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from metricbook.functions import cycles


@dataclass(frozen=True)
class RunConfig:
    """What one run of the pipeline covers.

    ``backfill=True`` (or a first run) processes every period; otherwise only
    the last complete ``reporting_period`` before ``anchor_date`` is produced.
    ``spine_start`` / ``as_of`` bound the reporting calendar of the time series
    (``as_of`` inclusive).  ``aop_scope`` is ``"all"`` (join every plan row) or
    ``"last_complete"`` (plan restricted to the last complete period, as in
    the original model, which leaves older plan values empty on a backfill).
    ``strict_biweek`` keeps bi-weekly runs from coming out empty after a
    53-week year (see :func:`cycles.last_complete`).
    """

    reporting_period: str = "week"
    anchor_date: dt.date = field(default_factory=dt.date.today)
    backfill: bool = False
    spine_start: dt.date = dt.date(2018, 1, 1)
    as_of: dt.date | None = None
    aop_scope: str = "all"
    strict_biweek: bool = False

    def __post_init__(self):
        cycles.check_cycle(self.reporting_period)
        object.__setattr__(self, "anchor_date", cycles.as_date(self.anchor_date))
        object.__setattr__(self, "spine_start", cycles.as_date(self.spine_start))
        if self.as_of is not None:
            object.__setattr__(self, "as_of", cycles.as_date(self.as_of))
        if self.aop_scope not in ("all", "last_complete"):
            raise ValueError("aop_scope must be 'all' or 'last_complete'")

    @property
    def incremental(self) -> bool:
        return not self.backfill

    @property
    def last_complete(self) -> dt.datetime:
        return cycles.last_complete(self.reporting_period, self.anchor_date, self.strict_biweek)

    @property
    def spine_end(self) -> dt.date:
        return self.as_of or dt.date.today()

    def with_(self, **kw) -> "RunConfig":
        d = dict(self.__dict__)
        d.update(kw)
        return RunConfig(**d)
