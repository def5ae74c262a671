"""Every registered query of the warehouse, with the SQL that gives the same rows."""

from . import q_changes, q_entities, q_facts, q_layouts, q_reads

PARTS = (q_facts, q_entities, q_changes, q_reads, q_layouts)
QUERIES = {name: run for part in PARTS for name, run in part.QUERIES.items()}
ORACLES = {name: sql for part in PARTS for name, sql in part.ORACLES.items()}
