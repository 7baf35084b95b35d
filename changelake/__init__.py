"""changelake: change-data-capture analytics expressed as Spark DataFrame plans.

Layers
------
* ``schemas``      explicit row schemas and ``TableSpec`` for every table
* ``functions``    column-level helpers (envelope parsing, ordering)
* ``sources``      readers and writers (Kafka or landing folder, Parquet, JSON)
* ``operators``    DataFrame -> DataFrame operators (parse, state, load, analytics, quality)
* ``streaming``    Structured Streaming jobs (normalise, archive, incremental state)
* ``plans``        composed job stages, registered queries and the mapping of the test tables
"""

from changelake.schemas import TABLES, TableSpec  # noqa: F401
from changelake.session import build_session, scratch_dir  # noqa: F401
