"""textloom: text corpus preparation, vocabulary learning and tokenization on Spark.

Sub-packages:

``sources``    tables, split directories, text files, finished results
``functions``  column expressions (words, hashes, fixed-length sequences)
``operators``  DataFrame to DataFrame steps
``plans``      whole jobs put together from the operators
``streaming``  the stateless steps and word counts over arriving files
"""

import sys

from pyspark import cloudpickle

# Functions sent to tasks carry their code along: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
