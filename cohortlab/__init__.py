"""cohortlab: cohort assembly, rule labelling, profiling, model evaluation,
batch scoring and activity analytics expressed as Spark DataFrame jobs.

Layout
------
- ``sources``    table readers/writers, module loading, stand-in tables
- ``functions``  column expressions: casts, text, dates, rules, risk bands
- ``operators``  DataFrame -> DataFrame operators (cohort, profile, metrics,
                 activity, access control, scale-safe ordered helpers)
- ``ml``         preprocessing, model training/evaluation, scoring
- ``plans``      the registered queries and their SQL oracles
- ``streaming``  Structured Streaming forms of the rate limit, cool-down
                 and scoring operators
"""

__version__ = "0.1.0"
