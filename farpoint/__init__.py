"""Text, class and point-set analytics as PySpark DataFrame operators.

Every operator is a function ``(DataFrame, params) -> DataFrame``: it never
creates a session, never prints, and is deterministic under explicit ids and
seeds.  Sub-packages:

* ``sources``   -- readers for text documents, class records and CSV points,
                  and loaders that shape the driver tables into those forms;
* ``functions`` -- column expressions (tokeniser, vector distance, keys);
* ``operators`` -- text, class, pairwise, sampling, center and diversity ops;
* ``plans``     -- the registered queries over the driver tables and their
                  independent SQL oracles;
* ``streaming`` -- the same counting operators over file streams.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value inside Spark closures.

    The numpy kernels run in Python workers; shipping them with the task
    means executors need numpy/pandas but not this package installed.
    """
    import sys

    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle: rely on --py-files
        pass


_ship_by_value()
