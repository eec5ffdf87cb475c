"""Operations of a large-scale training-data pipeline.

Nothing outside this subpackage imports it. Functions that run on executors
are shipped by value, so executors need not have the repository on their path.
"""

import vireo
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(vireo)
