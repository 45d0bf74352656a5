"""tidemark: a Spark-native engine for web-archive retrieval collections.

Every stage is a plain function ``DataFrame -> DataFrame`` built from Spark
SQL expressions; Python runs only inside Arrow-batched tasks where no
built-in expression can do the work (archive parsing, HTML to markdown,
user-supplied models).
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Let Python tasks run without the package installed on executors:
    functions of this package are pickled by value into each task."""
    import sys

    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older pyspark without the hook
        pass


_ship_by_value()
