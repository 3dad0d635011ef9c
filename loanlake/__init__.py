"""loanlake: consumer-loan portfolio analytics as Spark DataFrame plans.

Layers (each a pure DataFrame -> DataFrame function with an explicit ``as_of``):

* ``sources``   - raw schemas, binding of the driver tables, file readers, sinks, load state
* ``functions`` - column-expression helpers (trim/blank, safe percentages, aging, annuity)
* ``operators`` - staging, existence/anti-join flags, rollups, windows, quality checks, upserts
* ``plans``     - portfolio mart, analytic views, business questions, KPI report, job modes
* ``streaming`` - high-water-mark incremental load (bounded batch and AvailableNow stream)
"""

from loanlake.session import DEFAULT_AS_OF, get_session

__all__ = ["DEFAULT_AS_OF", "get_session"]
