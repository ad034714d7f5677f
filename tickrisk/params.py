"""Model parameters.

Fixed values of the modelled job (they must equal the original's for the
same results):

* effective sample count ``count = 1000``; every update divides by
  ``count + 1 = 1001``, so ``decay = 1000/1001`` and ``gain = 1/1001``;
* Sharpe annualisation ``periods = 52`` (weekly) and ``risk_free = 0.0018``;
* tumbling price window of 2 seconds, price watermark of 1 minute (on the
  last-traded time).
"""

from __future__ import annotations

import math
from dataclasses import dataclass


@dataclass(frozen=True)
class RiskParams:
    count: int = 1000
    periods: int = 52
    risk_free: float = 0.0018
    window: str = "2 seconds"
    # Out-of-orderness bound of the event-time option (windows on the
    # last-traded time) and of arrival-time windows (the default, standing in
    # for the original's processing-time windows, which lose no tick). A tick
    # later than the bound is dropped by Spark's aggregate, or stored
    # (``StreamingJob.keep_late``).
    watermark: str = "1 minute"
    arrival_watermark: str = "1 minute"
    # Rows of one (key, block) are scanned by one task; blocks are time
    # buckets of the order timestamp (see operators.scan). Per-portfolio
    # trigger scans use ``block_seconds``; per-(portfolio, ticker) statistics
    # series (at most one return per window) use ``series_block_seconds``.
    # The block table of one key (span / block length rows) is scanned by
    # one task at level 2.
    block_seconds: int = 3600
    series_block_seconds: int = 86400

    @property
    def n(self) -> int:
        return self.count + 1

    @property
    def decay(self) -> float:
        return self.count / self.n

    @property
    def gain(self) -> float:
        return 1.0 / self.n

    @property
    def sharpe_scale(self) -> float:
        return math.sqrt(self.periods)
