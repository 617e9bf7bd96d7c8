"""tillpoint: retail transaction analytics expressed as Spark DataFrame plans.

Every operator is a lazy ``DataFrame (+ params) -> DataFrame`` function built
from Spark SQL expressions; nothing row-level is collected to the driver.

Layers
------
``sources``    readers, table conformance, sinks (CSV / Parquet / SQL views)
``functions``  column-expression helpers (derived measures, calendar parts, formatting)
``operators``  cleaning, quality profiles, KPIs, trends, rankings, customers, products
``plans``      the end-to-end jobs: pipeline, report, dashboard panels
"""

__version__ = "0.1.0"
