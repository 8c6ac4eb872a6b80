"""cuespark: token annotation, negation-cue features, sequence labelling and
evaluation expressed as Spark DataFrame plans.

Layout
------
sources/    scans and sinks (documents -> tokens, token/feature/prediction tables, vectors)
functions/  column expressions (morphology, punctuation, n-grams) and fixed word lists
operators/  ordered context (lag/lead, sentences, corpus positions), lexicon counts,
            annotation joins, vector lookups, sentence assembly, evaluation
plans/      end-to-end relations (token, feature, prediction tables), ML pipelines,
            sequence tagger, ablation driver, query catalogue
streaming/  the stateless token features applied to a streaming source
"""

__version__ = "0.1.0"

import sys  # noqa: E402

from pyspark import cloudpickle  # noqa: E402

# Functions of this package that run in Python workers travel with the job,
# so executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
