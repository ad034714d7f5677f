"""tickrisk: live portfolio risk analytics on PySpark.

Intraday price ticks become windowed log returns per ticker; exponentially
weighted mean returns and covariances are kept per portfolio; joined with the
latest portfolio weights they give expected return, risk and Sharpe ratio,
published whenever they change.

Every operator is a ``DataFrame -> DataFrame`` function that runs in batch on
tables; the same rules run as Structured Streaming queries in
``tickrisk.streaming``.

Entry points: ``tickrisk.plans.batch.RiskJob`` (batch job),
``tickrisk.streaming.job.StreamingJob`` (streaming job, also
``python -m tickrisk.streaming.job``), ``tickrisk.params.RiskParams``
(constants and execution parameters), ``tickrisk.schemas`` (wire records).
"""

from tickrisk.params import RiskParams

__all__ = ["RiskParams", "RiskJob", "StreamingJob"]


def __getattr__(name):
    """Lazy exports: the job classes import their modules on first use."""
    if name == "RiskJob":
        from tickrisk.plans.batch import RiskJob
        return RiskJob
    if name == "StreamingJob":
        from tickrisk.streaming.job import StreamingJob
        return StreamingJob
    raise AttributeError(name)
