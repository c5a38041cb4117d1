"""parcelkit: property-assessment data jobs as Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function (or a
``Column`` builder) made of native Spark expressions, so Catalyst can push
filters and projections into the scan and keep the work inside whole-stage
codegen.  Fitted state (imputation values, clip bounds, vocabularies) is a
small, column-count-bounded object produced by a ``fit_*`` function and
applied by the matching ``apply_*`` function.

Subpackages:

* ``sources``   -- scans and sinks (CSV, JSON records, rules, run log, models)
* ``functions`` -- Column builders (text, numeric, dates, JSON) and
                   distributed statistics helpers (exact quantiles, modes,
                   global row index)
* ``operators`` -- the DataFrame operators (cleaning, features, encoding,
                   profiling, quality, metrics, fairness, feedback, ML)
* ``plans``     -- bindings to the driver tables and the job chains
* ``streaming`` -- Structured Streaming forms of the feedback jobs
"""

__version__ = "0.1.0"
