"""strata: cohort building, validation and model-evaluation operators on Spark.

Every operator takes and returns a DataFrame and is lazy; checks that must
stop a job come in two forms, ``*_findings`` (a lazy findings DataFrame) and
``assert_*`` (one action that raises).
"""

__version__ = "0.1.0"
