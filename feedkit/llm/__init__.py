"""Operators for preparing language-model training data at scale.

Nothing outside this folder, its tests and ``corpus_pipeline.py`` imports it.  Python here
runs inside Spark tasks on Arrow batches; a helper holds a bounded piece of a batch at a time.
The helpers travel with the tasks, so executors need no installation of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
