"""callweave: telecom call, internet-session and device-event records on Spark.

Column functions, DataFrame transforms, sources, sinks and jobs that map messy
records to three fixed schemas, clean them in batch or as a stream, measure
their quality and hand them on as tables, messages or per-subscriber timelines.
"""

import sys

from pyspark import cloudpickle

from callweave.specs import CDR, EDR, IPDR, SPECS, RecordSpec, spec_for

__all__ = ["CDR", "EDR", "IPDR", "SPECS", "RecordSpec", "spec_for"]

# Tasks carry the few Python helpers they run, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
