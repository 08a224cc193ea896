"""martspark: a Spark-native toolkit for a retail warehouse.

Every operator is a lazy ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function built from Spark's own functions.  Nothing reads the clock: run
dates and stamps are arguments.
"""

from martspark.session import get_session, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
