"""All queries and their SQL."""

from tessella.plans import detections, layouts, profiles, properties, records, review, vectors, worklist

MODULES = (detections, layouts, vectors, records, profiles, properties, review, worklist)
QUERIES: dict = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLE_SQL: dict = {k: s for m in MODULES for k, s in m.ORACLE_SQL.items()}
