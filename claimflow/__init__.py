"""claimflow — X12 837 claim onboarding as Spark DataFrame jobs.

Layers: landing files -> bronze rows -> silver claims -> gold tables -> ops
(audit, reconciliation, data quality, quarantine). Every operator is a
``DataFrame -> DataFrame`` function; only :mod:`claimflow.plans.pipeline`
and :mod:`claimflow.streaming` write tables.
"""

__version__ = "0.1.0"
